"""Substring dedup: repeated token windows found by Rabin-Karp hashes.

A window is ``WINDOW`` consecutive words of one document. Its Rabin-Karp hash
comes from prefix sums of word hashes, modulo 2**64. Windows whose hash occurs
at two or more places are repeated; overlapping repeated windows of a document
merge into maximal intervals, which are removed.

Counting every window would shuffle a row for each word of the corpus. Most
windows can be ruled out exactly beforehand: each window has a representative
``GRAM``-word gram (the one of the least hash among its grams), and equal
windows have equal representatives at equal offsets. So a window can only
repeat when its representative gram is selected at two or more positions of
the corpus. Selected positions are a few percent of all; they are counted
first, and only the windows whose representative repeats are counted then.
Documents whose words are all equal are repeated whole; one of them stands for
the others where grams and windows are counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import (WordHashes, byte_texts, list_array, mix64, read_table, row_key,
                              text_chunks)
from ludex.session import stage_table

WINDOW = 35
# Words of a representative gram (less than a window).
GRAM = 8

_RADIX = np.uint64(0x9E3779B97F4A7C15)
_RADIX_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def rolling_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes (finalised) of all ``size``-word windows."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    down = np.full(len(words), _RADIX_INVERSE)
    down[0] = 1
    np.cumprod(down, out=down)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * down, out=total[1:])
    up = np.full(n, _RADIX)
    up[0] = 1
    np.cumprod(up, out=up)
    return mix64((total[size:] - total[:-size]) * up)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def representatives(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(representative gram hash of each window, gram hashes at the selected
    positions: those that represent some window)."""
    grams = rolling_hashes(words, gram)
    width = window - gram + 1
    if len(grams) < width:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    least = _sliding(grams, width, np.minimum)
    # A position is selected when its hash is the least of a window over it.
    pad = np.zeros(width - 1, np.uint64)
    covering = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    return least, grams[grams == covering]


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words are inside a window at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + window, n), -1)
    return np.cumsum(steps[:-1]) > 0


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _first_pass(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, "text"):
            counts, digests, picked = [], [], []
            for text in byte_texts(chunk.column("text")):
                words = _words(text)
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                picked.append(representatives(hashes.of(words), window, gram)[1]
                              if len(words) >= window else np.empty(0, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("rk"), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.string()),
                 list_array(np.concatenate(picked).view(np.int64), [len(p) for p in picked],
                            pa.int64())],
                names=["doc_id", "rk", "n_words", "sha", "grams"])

    return run


def _window_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, "text"):
            found, extra, starts = [], [], []
            for text, grams in zip(byte_texts(chunk.column("text")),
                                   chunk.column("grams"), strict=True):
                words = hashes.of(_words(text))
                least, _ = representatives(words, window, gram)
                repeated = grams.values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(least, repeated))
                whole = rolling_hashes(words, window)[at]
                found.append(whole)
                extra.append((mix64(whole ^ words[at]) ^ words[at + window - 1])
                             .astype(np.uint32))
                starts.append(at)
            sizes = [len(s) for s in starts]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("row"), chunk.column("rk"), chunk.column("text"),
                 list_array(np.concatenate(found).view(np.int64), sizes, pa.int64()),
                 list_array((np.concatenate(extra).astype(np.int64) << 32)
                            | np.concatenate(starts), sizes, pa.int64())],
                names=["row", "rk", "text", "hashes", "places"])

    return run


def _removal(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            removed, digests, texts, spans = [], [], [], []
            for text, starts in zip(byte_texts(chunk.column("text")), chunk.column("starts"),
                                    strict=True):
                words = _words(text)
                gone = covered(starts.values.to_numpy(), len(words), window)
                kept = b" ".join([w for w, out in zip(words, gone.tolist(), strict=True)
                                  if not out])
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "replace") if with_text else None)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append(edge.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("rk"), pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(texts, pa.string()),
                 list_array(np.concatenate(spans), [len(s) for s in spans], pa.int32())],
                names=["rk", "n_removed", "sha_kept", "kept_text", "spans"])

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    with_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per document: doc_id, n_words,
    n_removed, kept_sha256, removed (array of [start, end) word intervals,
    flat) and, if asked for, kept_text (NULL where nothing was removed).

    Cases: NULL and word-less texts have 0 words and the hash of the empty
    string. Documents under ``window`` words have no window. Repeated rows are
    places of their own, so the copies of a repeated document of ``window``
    words or more are removed whole, each. doc_id may be NULL or repeated.
    Other columns are ignored. An empty table gives an empty table."""
    if not 0 < gram < window:
        raise ValueError("a gram must be shorter than a window")
    docs = docs.select("doc_id", "text").withColumn("rk", row_key("doc_id", "text"))
    first = stage_table(docs.mapInArrow(
        _first_pass(window, gram),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, rk binary, n_words bigint, "
        "sha string, grams array<bigint>"), "grams")
    # Documents of one word sequence go whole; one of them stands for all below,
    # and whatever it holds is repeated already.
    copies = stage_table(first.where(F.col("n_words") >= window).groupBy("sha")
                         .agg(F.count(F.lit(1)).alias("n"), F.min("rk").alias("lead"))
                         .where("n > 1").select("sha", "lead"), "copies")
    marked = first.join(copies, "sha", "left")
    grams = marked.where("lead is null or rk = lead").select(
        "rk", F.col("lead").isNotNull().alias("copied"), F.explode("grams").alias("gram"))
    weight = F.sum(F.when(F.col("copied"), 2).otherwise(1)).alias("n")
    repeated = stage_table(grams.groupBy("gram").agg(weight).where("n > 1").select("gram"),
                           "repeated")
    wanted = (grams.join(repeated, "gram")
              .groupBy("rk", "copied").agg(F.collect_set("gram").alias("grams")))
    # Rows are numbered as they are written; a place is 32 more bits of the
    # window's hash and the start, in one number, to keep the counted rows short.
    # Rows that stand for copies have odd numbers.
    held = docs.join(wanted, "rk").select(
        (F.monotonically_increasing_id() * 2 + F.col("copied").cast("int")).alias("row"), "rk",
        "text", "grams")
    found = stage_table(held.mapInArrow(
        _window_rows(window, gram), "row bigint, rk binary, text string, hashes array<bigint>, "
        "places array<bigint>"), "windows")
    places = found.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("w"))
    places = places.select("row", F.col("w.hashes").alias("hash"), F.col("w.places").alias("place"))
    extra = F.shiftright("place", 32)
    odd = F.col("row").bitwiseAND(1)
    twice = stage_table(places.groupBy("hash", extra.alias("extra")).agg(F.sum(odd + 1).alias("n"))
                        .where("n > 1").select(F.col("hash").alias("h"), "extra"), "twice")
    starts = (places.where(odd == 0)
              .join(twice, (F.col("hash") == F.col("h")) & (extra == F.col("extra")))
              .groupBy("row").agg(F.collect_set(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int"))
                                  .alias("starts")))
    changed = (found.select("row", "rk", "text").join(starts, "row").select("rk", "text", "starts")
               .mapInArrow(_removal(window, with_text),
                           "rk binary, n_removed bigint, sha_kept string, kept_text string, "
                           "spans array<int>").dropDuplicates(["rk"]))
    out = marked.select("doc_id", "rk", "n_words", "sha", F.col("lead").isNotNull().alias("copied")) \
        .join(changed, "rk", "left")

    def whole(value, other):
        return F.when(F.col("copied"), value).otherwise(other)

    columns = ["doc_id", "n_words",
               whole(F.col("n_words"), F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
               whole(F.sha2(F.lit(""), 256), F.coalesce("sha_kept", "sha")).alias("kept_sha256"),
               whole(F.array(F.lit(0), F.col("n_words").cast("int")),
                     F.coalesce("spans", F.array().cast("array<int>"))).alias("removed")]
    return out.select(*columns, *([whole(F.lit(""), F.col("kept_text")).alias("kept_text")]
                                  if with_text else []))


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).drop("removed")


OP7_SQL = r"""
WITH doc AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM doc WHERE len(w) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, s + o AS p
  FROM win JOIN rep USING (h), (SELECT unnest(range(0, 35)) AS o)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""
