"""Benchmark decontamination with a generalised suffix automaton.

The normalised items of a block of the benchmark form one automaton over
words; it accepts every run of consecutive words of any item. Streaming the
words of a document through it gives, at each word, the longest run that ends
there and occurs in an item. Where that run is at least ``WINDOW`` words long
its last ``WINDOW`` words are a window of an item, and where a whole shorter
item is a suffix of the run that item occurs.

The benchmark is the stated query set: it is cut by item hash into blocks of
about ``BLOCK_WORDS`` words, so what is sent to the tasks at once is bounded
however large the benchmark grows; every document streams past every block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import (byte_texts, columns_of, free_name, list_array, read_table, row_key,
                              text_chunks)
from ludex.session import stage_table

WINDOW = 10
# Words of a benchmark block; WORD_BYTES bytes of text count as a word at least.
BLOCK_WORDS, WORD_BYTES = 500_000, 8
# Cleaning: longer hit spans are removed; a document covered more is dropped.
MIN_SPAN, MAX_COVERAGE = 10, 0.5
# Hit spans shorter than a window are whole short items; removed from this many
# words on.
MIN_ITEM = 4

# Upper-case ASCII to lower case, every byte outside a word to a space.
_NORMAL = bytes(c + 32 if 0x41 <= c <= 0x5A else
                c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                for c in range(256))


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words])
                 for name, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # Items by the state that holds their windows: (window words, items).
        self.ends: dict[int, dict[int, set[str]]] = {}
        for name, words in coded:
            size = min(window, len(words))
            state = held = 0
            for word in words:
                state, held = self.step(state, held, word)
                if held >= size:
                    self.ends.setdefault(self.holder(state, size), {}).setdefault(
                        size, set()).add(name)
        self.shortest = min((min(window, len(w)) for _, w in coded), default=0)
        bigrams = {a << 32 | b for _, w in coded for a, b in zip(w, w[1:], strict=False)}
        self.bigrams = np.array(sorted(bigrams), np.int64)

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        state = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return state

    def _clone(self, p: int, word: int, q: int) -> int:
        """A state for the runs of q that are one word longer than p's."""
        nxt, link, length = self.next, self.link, self.length
        state = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = state
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = state
            p = link[p]
        return state

    def step(self, state: int, held: int, word: int) -> tuple[int, int]:
        """Longest matching run after one more word."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            held = self.length[state]
        return self.next[state][word], held + 1

    def holder(self, state: int, size: int) -> int:
        """The state that holds the last ``size`` words of a run at state."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """(positions of hit words, items with occurring windows)."""
        n = len(words)
        if not self.shortest or n < self.shortest:
            return np.empty(0, np.int32), set()
        known = self.ids.get
        coded = np.fromiter((known(w, -1) for w in words), np.int64, n)
        # Runs through which a match can go: known words, joined by known pairs.
        joined = (coded[:-1] >= 0) & (coded[1:] >= 0)
        if n > 1:
            pairs = coded[:-1] << 32 | np.maximum(coded[1:], 0)
            at = np.searchsorted(self.bigrams, pairs)
            at[at == len(self.bigrams)] = 0
            joined &= (self.bigrams[at] == pairs) if len(self.bigrams) else False
        breaks = np.flatnonzero(~joined) + 1
        starts, stops = np.concatenate([[0], breaks]), np.concatenate([breaks, [n]])
        long = stops - starts >= self.shortest
        hit, items = np.zeros(n, bool), set()
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            if coded[a] >= 0:
                self._walk(coded[a:b].tolist(), a, hit, items)
        return np.flatnonzero(hit).astype(np.int32), items

    def _walk(self, words: list[int], base: int, hit: np.ndarray, items: set[str]) -> None:
        state = held = 0
        for i, word in enumerate(words):
            state, held = self.step(state, held, word)
            at, reach = state, held
            while at > 0 and reach >= self.shortest:
                for size, names in self.ends.get(at, {}).items():
                    if size <= reach:
                        items |= names
                        hit[base + i + 1 - size: base + i + 1] = True
                at = self.link[at]
                reach = min(reach, self.length[at])


_built: dict[int, SuffixAutomaton] = {}


def _automaton(block, window: int) -> SuffixAutomaton:
    """The block's automaton, built once per worker process."""
    key = block.value["key"]
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton([(n, normal_words(t)) for n, t in block.value["items"]],
                                      window)
    return _built[key]


def _scan(block, window: int, everything: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block, window)
        for chunk in text_chunks(batches, "text"):
            counts, hits, items = [], [], []
            for text in byte_texts(chunk.column("text")):
                words = normal_words(text)
                hit, found = automaton.occurrences(words)
                counts.append(len(words))
                hits.append(hit)
                items.append(sorted(found))
            out = pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("rk"), pa.array(counts, pa.int64()),
                 list_array(np.concatenate(hits), [len(h) for h in hits], pa.int32()),
                 pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "rk", "n_words", "hits", "items"])
            yield out if everything else out.filter(pa.array([len(h) > 0 for h in hits]))

    return run


def _blocks(benchmark: DataFrame, block_words: int):
    """The benchmark in blocks: broadcasts of at most about ``block_words``
    words (or one item, if longer) each."""
    spark = benchmark.sparkSession
    items = (benchmark.where("item_id is not null and text is not null")
             .select(F.col("item_id").cast("string").alias("item_id"), "text").distinct())
    words = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    total = items.agg(F.sum(F.greatest(words, F.ceil(F.octet_length("text") / WORD_BYTES)))) \
        .first()[0] or 0
    n = max(1, -(-int(total) // block_words))
    keyed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for i in range(n):
        rows = [(r[0], r[1].encode()) for r in
                keyed.where(F.col("block") == i).select("item_id", "text").collect()]
        key = hashlib.sha256(repr(sorted(rows)).encode()).hexdigest()
        yield spark.sparkContext.broadcast({"key": key, "items": rows})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (doc_id, text), ``benchmark`` (item_id, text) -> one row per
    document: doc_id, rk (row key), n_words, hits (sorted positions of the
    words inside an occurring window), items (sorted ids of the items whose
    windows occur).

    Cases: NULL and word-less texts have no words; items of NULL id or text
    or without words have no window. Equal items are one; items of one id and
    several texts count once for a document. A repeated document is reported
    as often as it is in the table. Other columns are ignored. Empty tables
    give an empty table or no hits."""
    docs = docs.select("doc_id", "text").withColumn("rk", row_key("doc_id", "text"))
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, rk binary, "
              "n_words bigint, hits array<int>, items array<string>")
    first = merged = None
    for block in _blocks(benchmark, block_words):
        scan = stage_table(docs.mapInArrow(_scan(block, window, first is None), schema), "scan")
        block.unpersist()
        slim = scan.select("rk", "hits", "items").where("size(hits) > 0")
        merged = slim if first is None else merged.unionByName(slim)
        first = scan if first is None else first
    merged = merged.groupBy("rk").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("all_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("all_items"))
    return first.join(merged, "rk", "left").select(
        "doc_id", "rk", "n_words", F.coalesce("all_hits", "hits").alias("hits"),
        F.coalesce("all_items", "items").alias("items"))


def _clean(min_span: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text"):
            cleaned = []
            for text, hits in zip(byte_texts(chunk.column("text")), chunk.column("hits"),
                                  strict=True):
                cleaned.append(remove_words(text, hits.values.to_numpy(), min_span, window))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("rk"), pa.array(cleaned, pa.string())], names=["rk", "clean"])

    return run


def remove_words(text: bytes, hits: np.ndarray, min_span: int = MIN_SPAN,
                 window: int = WINDOW) -> str:
    """The text without its hit spans of ``min_span`` words or more, and without
    shorter ones of whole items of MIN_ITEM words or more, from the first byte
    of a span's first word to the last byte of its last."""
    plain = text.translate(_NORMAL)
    spans, at, bounds = [], 0, []
    for word in plain.split():
        start = plain.index(word, at)
        at = start + len(word)
        bounds.append((start, at))
    cuts = np.flatnonzero(np.diff(hits) > 1) + 1
    for run in np.split(hits, cuts):
        if len(run) >= min_span or MIN_ITEM <= len(run) < window:
            spans.append((bounds[run[0]][0], bounds[run[-1]][1]))
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at:start])
        at = stop
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` (all columns) with hit spans of ``min_span`` words or more, and
    whole short items of MIN_ITEM words or more, cut out of ``text``; documents of which more than ``max_coverage`` of the
    words are hit go. ``n_chars``, if there is such a column, follows the
    text. Documents without hits stay as they are."""
    found = contamination(docs, benchmark, window).where("size(hits) > 0").dropDuplicates(["rk"])
    key, other, cleaned = (free_name(docs, f"_lx_{n}") for n in ("rk", "key", "clean"))
    covered = F.size("hits") > F.lit(max_coverage) * F.col("n_words")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    hit = keyed.select(F.col(key).alias("rk"), "text").join(
        found.where(~covered).select("rk", "hits"), "rk")
    clean = (hit.mapInArrow(_clean(min_span, window), "rk binary, clean string").dropDuplicates(["rk"])
             .select(F.col("rk").alias(other), F.col("clean").alias(cleaned)))
    gone = found.where(covered).select(F.col("rk").alias(key))
    out = (keyed.join(gone, key, "left_anti")
           .join(clean, F.col(key) == F.col(other), "left"))
    new = {"text": F.coalesce(cleaned, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = (F.when(F.col(cleaned).isNull(), F.col("n_chars"))
                          .otherwise(F.length(cleaned)).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns_of(docs, **new))


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


OP5_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS t
  FROM (SELECT item_id, w, least(10, len(w)) AS k,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
occ AS (SELECT place.doc_id, place.k, place.s, win.item_id FROM place JOIN win USING (k, t)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS t
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
       coalesce(named.n, 0) AS n_items, sha256(coalesce(named.t, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
