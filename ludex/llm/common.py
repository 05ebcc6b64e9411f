"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text handled at once inside a task; larger Arrow batches are cut.
CHUNK_BYTES = 2 << 20
# Entries of a worker's word-hash table before it is started anew.
WORD_CACHE = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """128-bit key of the values of a row (NULLs included), as 16 bytes.
    Rows that are equal in ``cols`` have one key; it never is NULL."""
    parts = [F.coalesce(F.concat(F.lit("\x01"), F.col(c).cast("string")), F.lit("\x02"))
             for c in cols]
    return F.unhex(F.md5(F.concat(*parts)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, changed until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame, **new: Column) -> list[Column]:
    """All columns of ``df``, those named in ``new`` as given there."""
    return [new[c].alias(c) if c in new else F.col("`" + c.replace("`", "``") + "`")
            for c in df.columns]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``max_bytes`` of one column (a
    longer text is a slice of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        ends, start, held = np.cumsum(lengths), 0, 0
        while start < n:
            stop = int(np.searchsorted(ends, held + max_bytes, side="right"))
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            held, start = int(ends[stop - 1]), stop


def byte_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word seen; bounded, refilled on demand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def list_array(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
