"""Token-ID output: documents as token ids in range-coded block files.

Format: Parquet files of frames, in ascending doc_id order over the files. A
frame holds whole documents of about ``FRAME_TOKENS`` tokens (one document at
least): their ids and lengths, the start of its blocks (frequencies and usual
followers of its ids, see ``rangecoder``), and the concatenated ids cut into blocks
of ``BLOCK`` ids, each coded independently and kept with its length and crc32. Columns first_doc and last_doc let a reader skip frames, and
a frame can be decoded alone. The frames go through Spark's writer, so only
files of committed tasks appear, in any file system.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ludex.llm.common import read_table, text_chunks
from ludex.llm.rangecoder import BLOCK, Start, checksum, decode_blocks, encode_blocks
from ludex.operators.ranged import PART, part_offsets
from ludex.session import shared_path, shuffle_partitions

FRAME_TOKENS = 1 << 22
END_ID = 2
MAGIC = b"LXT2"
# Entries of a worker's table of words and their ids, in two generations.
WORD_CACHE = 600_000

# White space next to white space, or a space at an end of the text.
_BLANK = r"[\s\x1c-\x1f\x85\u180e\u200b\ufeff]"
_ANY_BLANK = re.compile(_BLANK)
_ODD_SPACE = re.compile(f"{_BLANK}{_BLANK}|^ | $|\x00")
# Marks cut off a letter or digit in front of them (no apostrophe: it may start a
# contraction).
_MARKS = ".,;:!?|$%&*#)"
# A word of letters that every version of Unicode knows, with a space in front.
_WORD = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af]+")
_IS_MARK = np.zeros(256, bool)
_IS_MARK[np.frombuffer(_MARKS.encode(), np.uint8)] = True


def _byte_letters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(i) if i in shown else chr(next(other)) for i in range(256)]


# NUL is in no part that is looked up; it separates them.
_BYTE_LETTERS = str.maketrans(dict(enumerate(_byte_letters())) | {0: " "})
# New words encoded as one text: longer texts take more time a word.
_TOGETHER = 64


def _bounds(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, where each starts and the last ends) of an array of
    large strings or binaries without nulls."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


class Encoder:
    """The ids of whole texts, as of ``tokenizer.encode``.

    The pre-tokenizer of a byte-level vocabulary starts a new piece at a single
    space or line break between other characters, and between a letter or digit
    and a mark. The parts between such places are coded independently, so their
    ids can be kept by part and looked up: a batch is cut and its distinct parts
    are found by array operations. A text in which white space touches
    white space, or that holds an added token (which then gets its own id), is
    encoded whole."""

    def __init__(self, path: str):
        # Tasks run side by side already; threads would only cost memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            split = json.load(f).get("pre_tokenizer") or {}
        self.by_part = (split.get("type") == "ByteLevel" and split.get("use_regex", True)
                        and not split.get("add_prefix_space"))
        # The tokenizer finds added tokens such as <|endoftext|> anywhere in a text.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_part = self.by_part and not any(_ANY_BLANK.search(t) for t in self.added)
        (self.line_break,) = self.tokenizer.encode("\n").ids if self.by_part else (None,)
        # The same tokenizer for parts that are one piece each: it cuts at spaces only,
        # which the letters of the vocabulary do not have.
        self.words = None
        if (self.by_part and self.tokenizer.normalizer is None
                and all(re.search("[!-/:-@[-`{-~]", t) for t in self.added)):
            self.words = Tokenizer.from_file(path)
            self.words.pre_tokenizer = WhitespaceSplit()
            vocabulary = self.words.get_vocab()
            self.spelt = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.spelt[list(vocabulary.values())] = list(map(len, vocabulary))
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of parts that are one piece each, encoded in the letters of the
        vocabulary as words of texts of a few each."""
        letters = "\x00".join(words)
        if letters.isascii():
            letters = letters.replace(" ", _BYTE_LETTERS[32]).replace("\x00", " ").split(" ")
        else:
            letters = letters.encode().decode("latin-1").translate(_BYTE_LETTERS).split(" ")
        texts = [" ".join(letters[a: a + _TOGETHER]) for a in range(0, len(letters), _TOGETHER)]
        found = self.words.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable([e.ids for e in found])), "<u4")
        # The ids of a word spell it.
        reached = np.cumsum(self.spelt[ids])
        ends = np.cumsum(list(map(len, letters)))
        stops = np.searchsorted(reached, ends)
        if stops[-1] + 1 != len(ids) or (reached[stops] != ends).any():
            return self._encode(words)
        raw, stops = ids.tobytes(), (4 * stops + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _encode_lines(self, parts: list[str]) -> list[bytes]:
        """The ids of parts without white space (but a space in front): they are
        encoded as lines of one text, as a line break is a piece of its own."""
        (found,) = self.tokenizer.encode_batch_fast(["\n".join(parts)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        breaks = (np.flatnonzero(ids == self.line_break) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(b + 4 for b in breaks)], [*breaks, len(raw)],
                                         strict=True)]

    def _learn(self, new: list[str]) -> None:
        """Add the ids of parts."""
        known, words, accented, plain, rest = self.parts, [], [], [], []
        for part in new:
            if self.words and _WORD.fullmatch(part):
                (words if part.isascii() else accented).append(part)
            elif (w := part.removeprefix(" ")) and not _ANY_BLANK.search(w):
                plain.append(part)
            else:
                rest.append(part)
        for parts, encode in ((words, self._encode_words), (accented, self._encode_words),
                              (plain, self._encode_lines),
                              (rest, self._encode)):
            for at in range(0, len(parts), 4096):
                some = parts[at: at + 4096]
                known.update(zip(some, encode(some), strict=True))

    def _look_up(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts. Those not met for a generation are forgotten."""
        if len(self.parts) > WORD_CACHE // 2:
            self.parts, self.older = {}, self.parts
        known, older = self.parts, self.older
        found = list(map(known.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for part in [parts[i] for i in missing]:
            if part in older:
                known[part] = older[part]
            else:
                new.append(part)
        self._learn(new)
        for i in missing:
            found[i] = known[parts[i]]
        return found

    def _whole(self, column: pa.Array) -> np.ndarray:
        """Which texts have to be encoded whole."""
        if not self.by_part:
            return np.ones(len(column), bool)
        data, at = _bounds(column)
        # Two bytes up to the space side by side, NUL, and the first bytes of characters
        # that may be white space: what is flagged here is looked at below.
        low = data <= 32
        flag = data == 0
        flag[1:] |= low[1:] & low[:-1]
        for first in (0xE1, 0xE2, 0xE3, 0xEF):
            flag |= data == first
        # Of the characters of two bytes, U+0085 and U+00A0 are white space.
        two = np.flatnonzero(data[:-1] == 0xC2)
        flag[two] = (data[two + 1] == 0x85) | (data[two + 1] == 0xA0)
        some = at[:-1] < at[1:]
        maybe = np.zeros(len(column), bool)
        maybe[np.searchsorted(at, np.flatnonzero(flag), side="right") - 1] = True
        maybe[some] |= (data[at[:-1][some]] == 32) | (data[at[1:][some] - 1] == 32)
        for i in np.flatnonzero(maybe).tolist():
            maybe[i] = _ODD_SPACE.search(column[i].as_py()) is not None
        for token in self.added:
            maybe |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        return maybe

    def _by_part(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where those of each start and the last end)."""
        data, at = _bounds(column)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(column) + 1, np.int64)
        cut = data == 32
        breaks = data == 10
        cut |= breaks
        cut[1:] |= breaks[:-1]
        # Letters and digits: ASCII, or of U+00C0 to U+00FF. A mark behind one starts a part.
        alnum = ((data | 32) - np.uint8(97) < 26) | (data - np.uint8(48) < 10)
        alnum[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        ends = np.flatnonzero(alnum[:-1] > alnum[1:]) + 1
        cut[ends[_IS_MARK[data[ends]]]] = True
        cut[at[:-1][at[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(data))
        parts = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        found = self._look_up(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        held, at_bytes = _bounds(pa.array(found, pa.large_binary()).take(parts.indices))
        return held.view("<u4"), at_bytes[np.searchsorted(starts, at)] >> 2

    def encode(self, texts: list[str | None] | pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text (null: empty), with ``end_id`` at its end."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        whole = self._whole(column)
        odd = np.flatnonzero(whole)
        others = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), column) \
            if len(odd) else column
        ids, at = self._by_part(others)
        end = np.array([end_id], "<u4")
        out = [np.concatenate([ids[a:b], end]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        for i, raw in zip(odd.tolist(), self._encode([column[i].as_py() for i in odd.tolist()]),
                          strict=True):
            out[i] = np.concatenate([np.frombuffer(raw, "<u4"), end])
        return out


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, so that a task finds the parts that
    earlier ones have learnt."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack_frame(docs: list[tuple[int | None, np.ndarray]]) -> dict:
    """A frame row of documents (doc_id, ids)."""
    ids = np.concatenate([d[1] for d in docs]).astype(np.uint32)
    blocks = [ids[a:a + BLOCK] for a in range(0, len(ids), BLOCK)]
    start = Start.fit(ids)
    head = start.to_bytes()
    coded = encode_blocks(blocks, start)
    payload = b"".join([MAGIC, struct.pack("<II", len(blocks), len(head)), head, *[
        struct.pack("<III", len(b), len(c), checksum(b)) + c
        for b, c in zip(blocks, coded, strict=True)]])
    present = [d[0] for d in docs if d[0] is not None]
    return {"first_doc": min(present, default=None), "last_doc": max(present, default=None),
            "n_tokens": len(ids), "doc_ids": [d[0] for d in docs],
            "lengths": [len(d[1]) for d in docs], "payload": payload}


def unpack_frame(payload: bytes) -> np.ndarray:
    """The ids of a frame. Damage anywhere in it raises ValueError."""
    if payload[:4] != MAGIC:
        raise ValueError("not a frame")
    n, size = struct.unpack_from("<II", payload, 4)
    at = 12 + size
    start = Start.from_bytes(payload[12:at])
    coded, lengths, sums = [], [], []
    for _ in range(n):
        length, held, crc = struct.unpack_from("<III", payload, at)
        coded.append(payload[at + 12: at + 12 + held])
        lengths.append(length)
        sums.append(crc)
        at += 12 + held
    return np.concatenate(decode_blocks(coded, lengths, sums, start))


_FRAME = pa.schema([
    ("part", pa.int32()), ("frame", pa.int64()), ("first_doc", pa.int64()),
    ("last_doc", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])
_FRAME_SQL = ("part int, frame bigint, first_doc bigint, last_doc bigint, n_tokens bigint, "
              "doc_ids array<bigint>, lengths array<bigint>, payload binary")


def _frames(tokenizer: str, end_id: int, frame_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        held: list[tuple[int | None, np.ndarray]] = []
        size, part, number = 0, TaskContext.get().partitionId(), 0

        def frame(docs):
            row = pack_frame(docs) | {"part": part, "frame": number}
            return pa.RecordBatch.from_pylist([row], _FRAME)

        for chunk in text_chunks(batches, "text"):
            ids = encoder.encode(chunk.column("text"), end_id)
            for doc_id, doc in zip(chunk.column("doc_id").to_pylist(), ids, strict=True):
                if held and size + len(doc) > frame_tokens:
                    yield frame(held)
                    held, size, number = [], 0, number + 1
                held.append((doc_id, doc))
                size += len(doc)
        if held:
            yield frame(held)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 frame_tokens: int = FRAME_TOKENS) -> None:
    """Write ``docs`` (doc_id, text) as token ids under ``path``, by ascending
    doc_id (NULL first), ``end_id`` after each document. ``tokenizer`` is a
    file of the tokenizers library that every executor has. NULL text counts
    as empty; repeated rows are documents of their own."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("salt").asc()]
    # The salt spreads an id that many rows share; a task that runs again deals
    # its rows the same way. Each partition is one task.
    placed = (docs.select(F.col("doc_id").cast("bigint"), "text",
                          F.xxhash64("doc_id", "text").alias("salt"))
              .repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
              .sortWithinPartitions(*order))
    frames = placed.select("doc_id", "text").mapInArrow(
        _frames(tokenizer, end_id, frame_tokens), _FRAME_SQL)
    frames.write.option("compression", "uncompressed").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            ids = unpack_frame(row["payload"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            pieces = [p.tobytes() for p in np.split(ids, ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(ends), pa.int32()),
                 pa.array([row["frame"]] * len(ends), pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()),
                 pa.array(ends - row["lengths"], pa.int64()),
                 pa.array(row["lengths"], pa.int64()),
                 pa.array(list(map(zlib.crc32, pieces)), pa.int64()),
                 pa.array(pieces, pa.binary())],
                names=["part", "frame", "doc_id", "offset", "n_tokens", "ids_crc32", "ids"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files under ``path``: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) and, unless not wanted, ids (those bytes)."""
    frames = spark.read.schema(_FRAME_SQL).parquet(path)
    sizes = frames.select(F.col("part").alias(PART), "frame", "n_tokens")
    before = part_offsets(sizes, F.col("n_tokens"), "part_start").select(
        F.col(PART).alias("part"), "part_start")
    inside = Window.partitionBy("part").orderBy("frame").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (frames.select("part", "frame", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
                            .alias("frame_start")).join(before, "part")
              .select("part", "frame", (F.col("part_start") + F.col("frame_start")).alias("base")))
    docs = frames.select("part", "frame", "doc_ids", "lengths", "payload").mapInArrow(
        _documents if with_ids else _without_ids,
        "part int, frame bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
        + (", ids binary" if with_ids else ""))
    out = docs.join(starts, ["part", "frame"])
    return out.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens",
                      "ids_crc32", *(["ids"] if with_ids else []))


def _without_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _documents(batches):
        yield batch.select(batch.schema.names[:-1])


def token_output(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` into the shared folder and read the files back."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path, with_ids=False)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_output(spark, sf_dir: str) -> DataFrame:
    return token_output(read_table(spark, sf_dir, "documents"), default_tokenizer())

