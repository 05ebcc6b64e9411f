"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct word shingles. Register j of its sketch is

    K_j = clip(floor(1 - log_b(min over shingles of E_j)), 0, q + 1)

with E_j exponential values drawn from the shingle's hash: exponentially
spaced, truncated minima. Sketches of a union are the register-wise maxima
(``merge_sketches``), and equal registers are the more likely the more similar
the sets, so groups of registers serve as locality-sensitive bands. For a
candidate pair the similarity is estimated from the numbers of larger, smaller
and equal registers by maximum likelihood, given both set sizes; pairs whose
estimate lies far below the threshold are dropped, the others are confirmed
on their full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import (WordHashes, byte_texts, columns_of, free_name, list_array, mix64,
                              read_table, row_key, text_chunks)
from ludex.llm.components import connected_components
from ludex.session import stage_table

SHINGLE = 5
PERCENT = 85
# 40 bands of 6 registers: a pair at similarity 0.85 shares no band with
# probability (1 - 0.85 ** 6) ** 40 < 1e-8.
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
# Register base, rate and truncation (16-bit registers).
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
# A pair is dropped when its estimate is this far below the threshold: 6.5
# standard deviations of an estimate from 240 registers at 0.85.
SLACK = 0.15
# Bands whose stars are confirmed first.
FIRST_BANDS = 4
# Shingles of a block in the comparison of nodes that stars left apart.
BLOCK_SHINGLES = 1 << 16

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) << np.uint64(1)
_MUL = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a word-hash array."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    total = words[: n - k + 1].copy()
    for i in range(1, k):
        total = total * _STEP + words[i: n - k + 1 + i]
    return np.unique(mix64(total + np.uint64(k)))


def registers(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, REGISTERS) register values; ``starts`` are the offsets of the
    non-empty sets within ``shingles``."""
    least = np.empty((REGISTERS, len(starts)), np.uint64)
    for j in range(REGISTERS):
        drawn = shingles ^ _XOR[j]
        drawn *= _MUL[j]
        least[j] = np.minimum.reduceat(drawn, starts)
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0 ** 64
    value = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    """p_b(x) = -log_b(1 - x (b - 1) / b)."""
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def estimate(more: np.ndarray, less: np.ndarray, size_a: np.ndarray,
             size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from the numbers of registers
    that are larger and smaller in a than in b, and the set sizes."""
    u = size_a / (size_a + size_b)
    v = 1 - u
    equal = REGISTERS - more - less
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(jaccard):
        p_more = np.maximum(_p(u - v * jaccard), 1e-12)
        p_less = np.maximum(_p(v - u * jaccard), 1e-12)
        p_equal = np.maximum(1 - p_more - p_less, 1e-12)
        return more * np.log(p_more) + less * np.log(p_less) + equal * np.log(p_equal)

    golden = (math.sqrt(5) - 1) / 2
    for _ in range(30):  # the likelihood has one maximum
        left, right = high - golden * (high - low), low + golden * (high - low)
        better = likelihood(left) > likelihood(right)
        high, low = np.where(better, right, high), np.where(better, low, left)
    return (low + high) / 2


def _sets(texts: list[bytes | None], hashes: WordHashes, size: int) -> list[np.ndarray]:
    return [shingle_set(hashes.of(t.lower().split()) if t else np.empty(0, np.uint64), size)
            for t in texts]


def _sketch_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, "text"):
            sets = _sets(byte_texts(chunk.column("text")), hashes, size)
            full = [s for s in sets if len(s)]
            sketches: Iterator[bytes] = iter(())
            if full:
                starts = np.cumsum([0, *map(len, full[:-1])])
                sketches = (row.astype(">u2").tobytes()
                            for row in registers(np.concatenate(full), starts))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("tk"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None
                           for s in sets], pa.binary()),
                 pa.array([next(sketches) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "tk", "n", "fp", "sketch"])

    return run


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for chunk in text_chunks(batches, "text"):
            sets = _sets(byte_texts(chunk.column("text")), hashes, size)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("fp"),
                 list_array(np.concatenate(sets).view(np.int64), [len(s) for s in sets],
                            pa.int64())], names=["fp", "shingles"])

    return run


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), ">u2")
                        .reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b"))
                guess = estimate((a > b).sum(1), (a < b).sum(1),
                                 part.column("n_a").to_numpy().astype(np.float64),
                                 part.column("n_b").to_numpy().astype(np.float64))
                keep = pa.array(guess >= percent / 100 - SLACK)
                yield (part.filter(keep).select(["a", "b", "n_a", "n_b"]))

    return run


def _confirm(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that are linked: sizes, then the estimate
    from the sketches, then the full sets."""
    side = lambda s: members.select(*[F.col(c).alias(f"{new}_{s}" if new else s)
                                      for c, new in (("fp", ""), ("n", "n"),
                                                     ("sketch", "sketch"))])
    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"))
    likely = stage_table(near.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
                         .mapInArrow(_likely(percent),
                                     "a binary, b binary, n_a bigint, n_b bigint"), "likely")
    full = lambda s: sets.select(F.col("fp").alias(s), F.col("shingles").alias(f"s_{s}"))
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return stage_table(likely.join(full("a"), "a").join(full("b"), "b")
                       .select("a", "b", "n_a", "n_b", shared.alias("shared"))
                       .where(f"100 * shared >= {percent} * (n_a + n_b - shared)")
                       .select("a", "b").distinct(), "links")


def _block_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """The pairs of components that links between nodes of two blocks
        join (as many as it takes to connect them)."""
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        comps = table.column("comp").to_pylist()
        sets = [x.values.to_numpy() for x in table.column("shingles")]
        left, right = np.flatnonzero(block == i).tolist(), np.flatnonzero(block == j).tolist()
        sizes = np.array([len(sets[r]) for r in right])
        values, where = np.unique(np.concatenate([sets[r] for r in right]), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes[:-1])])
        lead: dict[bytes, bytes] = {}

        def top(c: bytes) -> bytes:
            while c in lead:
                c = lead[c]
            return c

        a, b = [], []
        for x in left:
            mark = np.zeros(len(values) + 1, np.int32)
            at = np.searchsorted(values, sets[x])
            at[at == len(values)] = 0
            mark[at[values[at] == sets[x]]] = 1
            shared = np.add.reduceat(mark[where], starts)
            linked = 100 * shared >= percent * (len(sets[x]) + sizes - shared)
            for k in np.flatnonzero(linked).tolist():
                y = right[k]
                one, two = top(comps[x]), top(comps[y])
                if one != two:
                    lead[one] = two
                    a.append(min(comps[x], comps[y]))
                    b.append(max(comps[x], comps[y]))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _across(open_: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of components (``comp``) joined by links of nodes that share a
    bucket of ``open_`` (band, fp, comp, hub). Nodes connected through buckets
    are a family; a family is cut into blocks of about ``BLOCK_SHINGLES``
    shingles, and each pair of its blocks is compared on full sets in a task
    of its own, which puts out pairs of components only."""
    ties = open_.where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    family = connected_components(ties.distinct())
    nodes = (open_.select("fp", "comp").distinct()
             .join(family.select(F.col("node").alias("fp"), F.col("comp").alias("family")), "fp")
             .join(members.select("fp", "n"), "fp"))
    blocks = nodes.groupBy("family").agg(
        F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    nodes = stage_table(nodes.join(blocks, "family").withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")), "nodes")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (nodes.select("fp", "comp", "family", "block", other.alias("other")).join(sets, "fp")
             .select("comp", "family", "block", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j"), "shingles"))
    return stage_table(pairs.groupBy("family", "i", "j").applyInArrow(
        _block_links(percent), "a binary, b binary").distinct(), "links")


def _grouped(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """One row per document: doc_id, tk (row key), n, fp (set id, NULL without
    words), comp (set id of its component), least (its least doc_id)."""
    docs = docs.select("doc_id", "text").withColumn("tk", row_key("doc_id", "text"))
    sketched = stage_table(docs.select(F.col("doc_id").cast("bigint"), "tk", "text").mapInArrow(
        _sketch_rows(size), "doc_id bigint, tk binary, n bigint, fp binary, sketch binary"),
        "sketches")
    nodes = sketched.where("fp is not null").groupBy("fp").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.min("doc_id").alias("low"), F.min("tk").alias("rep_tk"))
    width = 2 * ROWS
    bands = nodes.select("fp", F.posexplode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width))
        for i in range(BANDS)])).alias("nth", "band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    buckets = stage_table(bands.join(shared, "band"), "buckets")
    weight = buckets.groupBy("fp").agg(F.sum("met").alias("weight"))
    members = stage_table(nodes.join(weight, "fp"), "members")
    # The full sets of the nodes that share a bucket, from one document each.
    sets = stage_table(docs.join(members.select("fp", F.col("rep_tk").alias("tk")), "tk")
                       .select("fp", "text")
                       .mapInArrow(_set_rows(size), "fp binary, shingles array<bigint>"), "sets")
    weighed = buckets.select("band", "fp").join(members.select("fp", "weight"), "fp")
    hubs = (weighed.groupBy("band").agg(
        F.max(F.struct("weight", "fp"))["fp"].alias("centre"),
        F.min(F.struct(F.xxhash64("fp", "band").alias("h"), "fp"))["fp"].alias("other"))
        .withColumn("other", F.when(F.pmod("band", F.lit(4)) == 0, F.col("other"))
                    .otherwise(F.col("centre"))))
    stars = stage_table(buckets.join(hubs, "band")
                        .select("nth", "fp", F.explode(F.array("centre", "other")).alias("hub"))
                        .where("fp <> hub").groupBy("fp", "hub").agg(F.min("nth").alias("nth")),
                        "stars")
    ordered = [F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")]
    early = _confirm(stars.where(F.col("nth") < FIRST_BANDS).select(*ordered).distinct(),
                     members, sets, percent)
    first = connected_components(early)
    # Of the other bands, pairs of nodes that are still apart, one for each
    # component among a node's hubs.
    of = first.select(F.col("node").alias("fp"), F.col("comp").alias("mine"))
    to = first.select(F.col("node").alias("hub"), F.col("comp").alias("its"))
    apart = (stars.where(F.col("nth") >= FIRST_BANDS).join(of, "fp", "left").join(to, "hub", "left")
             .withColumn("its", F.coalesce("its", "hub"))
             .where(F.col("its") != F.coalesce("mine", "fp"))
             .groupBy("fp", "its").agg(F.min("hub").alias("hub")))
    late = _confirm(apart.select(*ordered).distinct(), members, sets, percent)
    first = connected_components(early.unionByName(late))

    # Buckets whose nodes are not all in one component yet.
    placed = buckets.select("band", "fp").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("band", "fp", F.coalesce("comp", "fp").alias("comp"))
    parts = placed.groupBy("band", "comp").agg(F.min("fp").alias("hub"))
    mixed = parts.groupBy("band").agg(F.count(F.lit(1)).alias("parts"),
                                      F.min("hub").alias("hub")).where("parts > 1")
    open_ = stage_table(placed.join(mixed.select("band", "hub"), "band"), "open")
    more = _across(open_, members, sets, percent)
    joined = connected_components(more)

    # Least doc_id of each component, back to the documents by set id.
    of_node = nodes.select("fp", "low").join(first.withColumnRenamed("node", "fp"), "fp", "left")
    of_node = (of_node.select("fp", "low", F.coalesce("comp", "fp").alias("node"))
               .join(joined, "node", "left")
               .select("fp", "low", F.coalesce("comp", "node").alias("comp")))
    least = of_node.groupBy("comp").agg(F.min("low").alias("least"))
    ids = of_node.join(least, "comp").select("fp", "comp", "least")
    return sketched.select("doc_id", "tk", "n", "fp").join(ids, "fp", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per document: doc_id, n_shingles,
    component_id (least doc_id reachable over links) and kept (doc_id =
    component_id). Two documents are linked when 100 * shared shingles >=
    ``percent`` * shingles of both.

    1. One pass over the texts writes set size, set id (a 128-bit hash of the
       set) and sketch of each document. Documents of equal sets are one node.
    2. The bands of the nodes' sketches are grouped; nodes sharing a band
       are candidates. In each bucket the nodes are paired with two of its
       members only: the one whose bands meet the most nodes over all bands
       (the likely original) and, in a quarter of the buckets, a
       pseudo-random one. Links confirmed on full
       sets make first components: those of the first ``FIRST_BANDS`` bands,
       then those of the others between nodes that are still apart.
    3. The nodes of buckets that still hold several components are compared
       on full sets, in pairs of blocks of bounded size; only links between
       different components are put out. Pairs inside a component cannot
       change it, so the outcome is that of testing all pairs of each bucket.

    Cases: NULL and word-less texts have no shingles and are linked with
    nothing (component_id is their own doc_id). Texts of fewer than ``size``
    words have one shingle. A NULL doc_id takes part; a component's id is its
    least non-NULL doc_id (NULL if there is none, then kept is true). Repeated
    rows give repeated rows. Other columns are ignored. An empty table gives
    an empty table."""
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return _grouped(docs, percent, size).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one_per_group(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` (all columns) that lead their group: the one of
    the least doc_id (NULL last), of equal rows one. Documents without words
    all stay."""
    found = stage_table(_grouped(docs, percent, size), "groups")
    key = free_name(docs, "_lx_tk")
    lead = (found.where("fp is not null").groupBy("comp")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk"))["tk"]
                 .alias(key)).select(key))
    empty = found.where("fp is null").select(F.col("tk").alias(key)).distinct()
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    kept = keyed.join(lead, key, "left_semi")
    again = found.where("fp is not null").groupBy("tk").count().where("count > 1")
    if again.limit(1).count():  # only then is the shuffle of whole rows needed
        kept = kept.dropDuplicates([key])
    return kept.unionByName(keyed.join(empty, key, "left_semi")).select(*columns_of(docs))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least(len(w), 5) - 1], ' ') AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s
        FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sh a JOIN sh b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT a AS node, a AS seen FROM edge
  UNION SELECT node, b FROM reach JOIN edge ON seen = a),
comp AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT doc.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, doc.doc_id) AS component_id,
       doc.doc_id = coalesce(c, doc.doc_id) AS kept
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN comp ON node = doc.doc_id
"""
