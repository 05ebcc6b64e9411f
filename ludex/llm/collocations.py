"""Phrase collocation mining by mergeable Misra-Gries summaries.

Phrases are runs of words inside a piece of text. Which phrases occur at least
``threshold`` times is found in two passes:

1. The n-grams are dealt by their hash to partitions, each of which keeps one
   Misra-Gries summary: at most ``capacity`` counters, all reduced by the
   largest surplus one whenever there are more. The reductions of a summary add
   up to at most mass / (capacity + 1), whatever the order in which its parts
   are merged, so with a capacity above mass / threshold every frequent n-gram
   is still in it. Counters that cannot reach the threshold even with all
   reductions added back are left out.
2. What survives is counted exactly, by its words.

The first pass runs for words, then for pairs of surviving words, then for longer
runs of surviving pairs (a phrase is at most as frequent as its parts), which
keeps the mass small. Survivors reach the tasks as a bit filter of bounded
size; what it lets through by mistake costs time and is counted exactly too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludex.llm.common import byte_texts, mix64, read_table, text_chunks
from ludex.session import shuffle_partitions, stage_table

THRESHOLD = 100
MAX_WORDS = 5
TOP = 2000
TOP_SHARES = 32
# Words that a task turns into arrays at once.
BUFFER_WORDS = 1 << 20
# Counters that a summary has at least.
LEAST_COUNTERS = 1 << 12
# Counters or phrases of a task's own part before it is passed on.
PART_ROWS = 1 << 20
# Bits of the survivors' filter: about 16 each, between these bounds.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

# A-Z in lower case, tabs as spaces, ends of pieces as full stops.
_CLEAN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz .........")
_RADIX = np.uint64(0x9E3779B97F4A7C15)


class MisraGries:
    """Counts of 64-bit keys in about ``capacity`` counters. ``lost`` is the most
    by which a count can be too low, and stays below ``threshold``: a reduction
    that would take it there (only possible where the keys hold more mass
    than capacity * threshold) is put off and the capacity doubled instead."""

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.lost = capacity, threshold, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        counts = np.concatenate([self.counts, counts])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.counts = np.zeros(len(self.keys), np.int64)
        np.add.at(self.counts, at, counts)
        while len(self.keys) > self.capacity:
            cut = len(self.counts) - self.capacity - 1
            least = int(np.partition(self.counts, cut)[cut])
            if self.lost + least >= self.threshold:
                self.capacity *= 2
                continue
            keep = self.counts > least
            self.keys, self.counts = self.keys[keep], self.counts[keep] - least
            self.lost += least

    def merge(self, other: MisraGries) -> None:
        if self.lost + other.lost >= self.threshold:
            raise ValueError("the reductions of both reach the threshold")
        self.lost += other.lost
        self.add(other.keys, other.counts)

    def frequent(self) -> np.ndarray:
        """All keys that may occur ``threshold`` times."""
        return self.keys[self.counts + self.lost >= self.threshold]


class _Ids(dict):
    """Numbers of the words of a buffer; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Words:
    """A buffer of texts: ``ids`` of their words (0: end of a piece), the
    ``vocabulary`` they number, the index of the lang of each, and hashes of
    (lang, word)."""

    def __init__(self, parts: list[list[bytes]], langs: list[str]):
        numbers, self.langs = _Ids(), sorted(set(langs))
        at = {lang: k for k, lang in enumerate(self.langs)}
        self.ids = np.concatenate([np.fromiter(map(numbers.__getitem__, p), np.int64, len(p))
                                   for p in parts])
        self.lang = np.repeat([at[x] for x in langs], [len(p) for p in parts])
        self.vocabulary = list(numbers)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.vocabulary), np.uint64,
                             len(self.vocabulary))
        seeds = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        self.hashes = mix64(hashes[self.ids] ^ seeds[self.lang])
        # Places of surviving words and pairs, once known (see _places).
        self.good = self.pairs = None

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place on."""
        n = max(len(self.ids) - size + 1, 0)
        out = self.hashes[:n].copy()
        for k in range(1, size):
            out = out * _RADIX + self.hashes[k:k + n]
        return out

    def inside(self, good: np.ndarray, width: int) -> np.ndarray:
        """Places from which on ``width`` neighbours are all ``good``."""
        n = max(len(good) - width + 1, 0)
        total = np.concatenate([[0], np.cumsum(good)])
        return total[width:width + n] - total[:n] == width


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    parts, langs, held = [], [], 0
    for chunk in text_chunks(batches, "text"):
        for text, lang in zip(byte_texts(chunk.column("text")), chunk.column("lang").to_pylist(),
                              strict=True):
            words = (text or b"").translate(_CLEAN).replace(b".", b" . ").split()
            words.append(b".")
            parts.append(words)
            langs.append(lang)
            held += len(words)
            if held >= BUFFER_WORDS:
                yield Words(parts, langs)
                parts, langs, held = [], [], 0
    if parts:
        yield Words(parts, langs)


class Filter:
    """Keys that survived, as bits; lets all of them through and few others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & self.mask
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _places(words: Words, size: int, filters: dict[int, Filter]) -> np.ndarray:
    """Where ``size`` words of one piece start whose words and pairs survived."""
    if size == 1 or 1 not in filters:
        return words.inside(words.ids > 0, size)
    if words.good is None:
        words.good = (words.ids > 0) & filters[1].has(words.hashes)
    if size == 2 or 2 not in filters:
        return words.inside(words.good, size)
    if words.pairs is None:
        words.pairs = words.inside(words.good, 2)
        words.pairs &= filters[2].has(words.grams(2))
    return words.inside(words.pairs, size - 1)


def _partial_counts(sizes: tuple[int, ...], filters, parts: int):
    """Counts of n-grams inside a task, dealt by hash: (part, keys, counts)."""
    def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        part = (keys % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, keys, counts = part[order], keys[order], counts[order].astype(np.uint32)
        edge = np.flatnonzero(np.diff(part)) + 1
        starts = np.concatenate([[0], edge]) if len(part) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts]),
             pa.array([k.tobytes() for k in np.split(keys, edge)][:len(starts)], pa.binary()),
             pa.array([c.tobytes() for c in np.split(counts, edge)][:len(starts)], pa.binary())],
            names=["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = filters.value
        held, total, mass = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for words in _buffers(batches):
            found = [words.grams(size)[_places(words, size, chosen)] for size in sizes]
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            mass += int(counts.sum())
            held, at = np.unique(np.concatenate([held, keys]), return_inverse=True)
            total = np.bincount(at, np.concatenate([total, counts]), len(held)).astype(np.int64)
            if len(held) >= PART_ROWS or mass >= 1 << 31:
                yield rows(held, total)
                held, total, mass = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        if len(held):
            yield rows(held, total)

    return run


def _summaries(capacity: int, threshold: int):
    """One summary for each part, merged from the tasks' counts: the keys that may
    reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, MisraGries] = {}
        for batch in batches:
            for part, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part not in found:
                    found[part] = MisraGries(capacity, threshold)
                found[part].add(np.frombuffer(keys, np.uint64),
                                np.frombuffer(counts, np.uint32).astype(np.int64))
        for summary in found.values():
            yield pa.RecordBatch.from_arrays([pa.array(summary.frequent().view(np.int64))],
                                             names=["key"])

    return run


def _filter_of(survivors: DataFrame) -> Filter:
    """At most MOST_BITS / 64 rows reach the driver, however many survive."""
    n, bits = survivors.count(), LEAST_BITS
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    slot = F.col("key").bitwiseAND(bits - 1)
    held = (survivors.groupBy(F.shiftright(slot, 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("b")).toPandas())
    out = np.zeros(bits // 64, np.int64)
    out[held["w"].to_numpy(np.int64)] = held["b"].to_numpy(np.int64)
    return Filter(out.view(np.uint8))


def survivors(docs: DataFrame, sizes: tuple[int, ...], filters: dict[int, Filter],
              threshold: int, words: int) -> DataFrame:
    """Keys of the n-grams of ``sizes`` that may occur ``threshold`` times: all
    that do and some that nearly do. ``words`` is a bound of the words of ``docs``;
    the counters of all parts exceed the mass divided by the threshold."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    capacity = 2 * len(sizes) * words // (threshold * parts) + LEAST_COUNTERS
    held = docs.mapInArrow(_partial_counts(sizes, spark.sparkContext.broadcast(filters), parts),
                           "part int, keys binary, counts binary")
    return stage_table(held.repartition(parts, "part").mapInArrow(
        _summaries(capacity, threshold), "key bigint"), "survivors")


def _exact_counts(filters, max_words: int):
    def rows(count: Counter) -> pa.RecordBatch:
        langs, phrases, sizes = zip(*count, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
             pa.array(sizes, pa.int32()), pa.array(list(count.values()), pa.int64())],
            names=["lang", "phrase", "m", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, count = filters.value, Counter()
        for words in _buffers(batches):
            for lang, n in enumerate(np.bincount(words.lang[words.ids > 0]).tolist()):
                if n:
                    count[words.langs[lang], b"", 0] += n
            # Numbers of the phrases one word shorter: no hash decides a count.
            shorter = words.lang.astype(np.int64)
            for size in range(1, max_words + 1):
                here = _places(words, size, chosen) & (shorter[:len(words.ids) - size + 1] >= 0)
                here[here] = chosen[min(size, 3)].has(words.grams(size)[here])
                at = np.flatnonzero(here)
                code = (shorter[at] << 32) | words.ids[at + size - 1]
                _, first, number, times = np.unique(code, return_index=True, return_inverse=True,
                                                    return_counts=True)
                shorter = np.full(len(here), -1, np.int64)
                shorter[at] = number
                for start, n in zip(at[first].tolist(), times.tolist(), strict=True):
                    phrase = b" ".join([words.vocabulary[w] for w in
                                        words.ids[start:start + size].tolist()])
                    count[words.langs[words.lang[start]], phrase, size] += n
            if len(count) >= PART_ROWS:
                yield rows(count)
                count = Counter()
        if count:
            yield rows(count)

    return run


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD,
                     max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` (text, lang) -> (lang, phrase, m words, f occurrences) of all
    phrases of at most ``max_words`` words with f >= ``threshold``, and one row
    (lang, '', 0, all words) per lang. Eager."""
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    # A word has at least a byte and one that ends it.
    most = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    filters: dict[int, Filter] = {}
    for level, sizes in ((1, (1,)), (2, (2,)), (3, tuple(range(3, max_words + 1)))):
        filters[level] = _filter_of(survivors(docs, sizes, filters, threshold,
                                                most // 2))
    counts = docs.mapInArrow(
        _exact_counts(docs.sparkSession.sparkContext.broadcast(filters), max_words),
        "lang string, phrase string, m int, f bigint")
    total = counts.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f"))
    return stage_table(total.where((F.col("f") >= threshold) | (F.col("m") == 0)), "phrases")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, max_words: int = MAX_WORDS,
                 top: int = TOP) -> DataFrame:
    """``docs`` (text, lang) -> the best ``top`` phrases of each lang: lang, rank,
    phrase, a, l, r, n, score (the lowest floor(1000 * a * n / (l * r)) over the
    cuts of the phrase in two). Phrases inside a longer one that occurs as
    often are left out.

    Cases: NULL, empty and word-less texts have no phrases; a NULL lang is
    ``und``. Repeated rows count each. Ties go by a descending, then by the bytes
    of the phrase. An empty table, or one without frequent phrases, gives an
    empty table. Other columns are ignored. Eager (see ``frequent_phrases``)."""
    known = frequent_phrases(docs, threshold, max_words)
    phrases = known.where("m > 0")
    totals = known.where("m = 0").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ", -1)

    def some(first, length):
        return F.array_join(F.slice(words, first, length), " ")

    # A longer phrase holds both of its parts of one word less; equal counts carry
    # over from length to length.
    parts = phrases.where("m > 2").select("lang", "f", F.explode(F.array(
        some(F.lit(1), F.col("m") - 1), some(F.lit(2), F.col("m") - 1))).alias("phrase"))
    longer = parts.groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    kept = (phrases.where("m > 1").join(longer, ["lang", "phrase"], "left")
            .where("above is null or above < f").drop("above"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k",
                       some(F.lit(1), F.col("k")).alias("left"),
                       some(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side),
                                        F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(totals, "lang").withColumn(
        "score", F.expr("(1000 * cast(a as decimal(38, 0)) * cast(n as decimal(38, 0))) div "
                        "(cast(l as decimal(38, 0)) * cast(r as decimal(38, 0)))"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First the best of each of some shares of a lang, then those of the lang.
    share = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SHARES))
    first = Window.partitionBy("lang", share).orderBy(*order)
    some = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l",
                         "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS t
  FROM documents),
seq AS (
  SELECT lang, list_filter(string_split_regex(t, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM seq GROUP BY lang),
gram AS (
  SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM seq, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, a
  FROM (SELECT lang, w, a, m2 AS m, unnest(range(1, cand.m - m2 + 2)) AS s
        FROM cand, (SELECT unnest(range(2, 5)) AS m2) WHERE m2 < cand.m)),
kept AS (
  SELECT c.* FROM cand c
  WHERE NOT EXISTS (SELECT 1 FROM inside i
                    WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 100 * c.a)),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, k, p.a AS l, q.a AS r, n,
         (1000::HUGEINT * cut.a * n) // (p.a::HUGEINT * q.a) AS score
  FROM cut JOIN f p ON p.lang = cut.lang AND p.phrase = cut.p
  JOIN f q ON q.lang = cut.lang AND q.phrase = cut.q JOIN total ON total.lang = cut.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
