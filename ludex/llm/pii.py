"""Information-theoretic sanitisation of personal data.

Protected entities are the values of e-mail addresses, IP addresses, card and
phone numbers. Masking them is not enough where the words around them give
them away. Over the whole corpus, with document frequencies,

    IC(c)   = -log2 p(c)                 what there is to know about entity c
    PMI(c;t) = log2 p(c, t) / p(c) p(t)  what term t tells about it

a term discloses the entity to the degree PMI / IC = 1 + log2 p(c | t) / IC(c):
1 when the term occurs with that entity only. p(c | t) is shrunken towards p(c)
by a few documents' weight, so that less evidence gives a lower degree, but no
pair is left out for its count. In every document that names the
entity, all occurrences of the terms that exceed the disclosure threshold
become spans too. They are generalised to their class (number, name, word) where the
class does not exceed the threshold itself, and removed otherwise.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import columns_of, free_name, read_table, row_key, text_chunks
from ludex.session import stage_table

# A term is a span from this degree of disclosure on; ln(SUPPORT) documents in
# which the entity is as frequent as in the corpus are added to those of a term
# (none for a support of 1).
THRESHOLD, SUPPORT = 0.85, 3
# Bits of a filter of terms: 16 a term, 128 KB to 16 MB.
FILTER_LOAD, MIN_FILTER_BITS, MAX_FILTER_BITS = 16, 1 << 20, 1 << 27
# Terms a worker adds up before it puts them out.
TERMS_HELD = 100_000

# The kinds in their order, and their patterns. The lookbehind
# of ip changes no match (a match inside a run of digits could start earlier).
KINDS = ["email", "ip", "card", "phone", "term"]
CLASSES = ["<number>", "<name>", "<word>"]
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind."""
    found = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
                   for part in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _entity(text: str, span: tuple[int, int, str]) -> str:
    value = text[span[0]:span[1]]
    if span[2] in ("card", "phone"):
        value = "".join(c for c in value if c.isdigit())
    return f"{span[2]}:{value.lower()}"


def term_class(word: str) -> str:
    if not word.isalpha() and any(c.isdigit() for c in word):
        return "<number>"
    return "<name>" if word[0].isupper() else "<word>"


def words_of(text: str, spans: list[tuple[int, int, str]],
             wanted=None) -> dict[tuple[str, str], list]:
    """(term, class) -> the (start, end) of its occurrences outside the spans,
    for all words of the document (of those terms that ``wanted`` holds true)."""
    found: dict[tuple[str, str], list] = {}
    held = bytearray(len(text))
    for a, b, _ in spans:
        held[a:b] = b"\x01" * (b - a)
    for m in _WORD.finditer(text):
        term = m[0].lower()
        if wanted is None or wanted[term]:
            at = found.setdefault((term, term_class(m[0])), [])
            if held.find(1, m.start(), m.end()) < 0:
                at.append(m.span())
    return found


def span_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_SPAN = pa.struct([("start", pa.int32()), ("order", pa.int32()), ("end", pa.int32()),
                   ("kind", pa.string())])
_AT = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _base_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batches, "text"):
        spans, entities, held, counts, digests = [], [], [], {k: [] for k in KINDS[:4]}, []
        for text in chunk.column("text").to_pylist():
            found = base_spans(text or "")
            spans.append([{"start": a, "order": KINDS.index(k), "end": b, "kind": k}
                          for a, b, k in found])
            entities.append(sorted({_entity(text, s) for s in found}))
            held.append(text if found else None)
            for kind, n in counts.items():
                n.append(sum(s[2] == kind for s in found))
            digests.append(hashlib.sha256(span_text(found).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), chunk.column("rk"),
             *[pa.array(counts[k], pa.int64()) for k in KINDS[:4]],
             pa.array(digests, pa.string()), pa.array(spans, pa.list_(_SPAN)),
             pa.array(entities, pa.list_(pa.string())), pa.array(held, pa.string())],
            names=["doc_id", "rk", *[f"n_{k}" for k in KINDS[:4]], "base_sha256", "base",
                   "entities", "text"])


class _Candidates(dict):
    """Whether a term may be in the table that the bit filter was made of."""

    def __init__(self, bits: bytes):
        super().__init__()
        self.bits, self.last = bits, 8 * len(bits) - 1

    def __missing__(self, term: str) -> int:
        if len(self) > 400_000:
            self.clear()
        at = xxhash.xxh64_intdigest(term.encode(), seed=42) & self.last
        value = self[term] = self.bits[at >> 3] >> (at & 7) & 1
        return value


def _terms_in(words: set[str], classes: list[str]) -> set[str]:
    """The terms of a document's words: in lower case, and their ``classes``."""
    terms = set(map(str.lower, words))
    if classes:
        terms.update({term_class(w) for w in words}.intersection(classes))
    return terms


def _held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents, largest cap) over the documents that hold an entity,
    added up over TERMS_HELD terms at a time."""
    counts, caps = Counter(), {}

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()),
             pa.array([caps[t] for t in counts], pa.float64())], names=["term", "n", "cap"])
        counts.clear()
        caps.clear()
        return out

    for chunk in text_chunks(batches, "text"):
        for text, cap in zip(chunk.column("text").to_pylist(), chunk.column("cap").to_pylist(),
                             strict=True):
            terms = _terms_in(set(_WORD.findall(text)), CLASSES)
            counts.update(terms)
            for t in terms:
                if caps.get(t, -1.0) < cap:
                    caps[t] = cap
            if len(counts) >= TERMS_HELD:
                yield rows()
    yield rows()


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                       pa.array(list(counts.values()), pa.int64())],
                                      names=["term", "n"])


def _term_rows(filter_):
    """(term, documents) of the candidate terms, added up over TERMS_HELD terms
    at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates, counts = _Candidates(filter_.value), Counter()
        classes = [c for c in CLASSES if candidates[c]]
        for chunk in text_chunks(batches, "text"):
            for text in chunk.column("text").to_pylist():
                terms = _terms_in(set(_WORD.findall(text or "")), classes)
                counts.update([t for t in terms if candidates[t]])
                if len(counts) >= TERMS_HELD:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    return run


def _met_rows(filter_):
    """(rk, groups, term, class, at) of the candidate terms of the documents that
    hold an entity; candidate classes are rows of their own without places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = _Candidates(filter_.value)
        classes = [c for c in CLASSES if candidates[c]]
        for chunk in text_chunks(batches, "text"):
            source, terms, kinds, places = [], [], [], []
            spans = chunk.column("base").to_pylist()
            for i, text in enumerate(chunk.column("text").to_pylist()):
                found = words_of(text, [(s["start"], s["end"], s["kind"]) for s in spans[i]],
                                 candidates)
                if classes:
                    have = {term_class(w) for w in set(_WORD.findall(text))}
                    found |= {(c, c): [] for c in classes if c in have}
                for (term, kind), at in found.items():
                    source.append(i)
                    terms.append(term)
                    kinds.append(kind)
                    places.append([{"start": a, "end": b} for a, b in at])
            at = pa.array(source, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("rk").take(at), chunk.column("row").take(at),
                 pa.array(terms, pa.string()), pa.array(kinds, pa.string()),
                 pa.array(places, pa.list_(_AT))], names=["rk", "row", "term", "class", "at"])

    return run


def _filter_of(terms: DataFrame):
    """A broadcast bit set of the hashes of ``terms``, about FILTER_LOAD bits a
    term and at most MAX_FILTER_BITS; built with Spark's bitmap aggregates, 4 KB
    a row. With more terms than it is made for it only lets more through."""
    spark, bits = terms.sparkSession, MIN_FILTER_BITS
    n = terms.count()
    while bits < min(FILTER_LOAD * n, MAX_FILTER_BITS):
        bits *= 2
    # xxhash64 is signed: the unsigned value modulo a power of two is the same.
    at = F.pmod(F.xxhash64("term"), F.lit(bits))
    rows = (terms.select(at.alias("bit"))
            .groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("map"))
            .toLocalIterator())
    whole = np.zeros((bits // 32768, 4096), np.uint8)
    for row in rows:
        whole[row["bucket"] - 1] = np.frombuffer(bytes(row["map"]), np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def find(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` (doc_id, text) -> one row per document: doc_id, rk (row key),
    n_<kind>, base_sha256, base (spans of the patterns) and terms (spans of
    disclosing terms with the replacement: a class, or empty for removal).
    Spans count code points, the end is exclusive.

    A degree of ``threshold`` or more means that the term occurs in at most
    (n(c, t) + k p(c)) p(c)^(threshold - 1) - k documents (k = ln(support)),
    which n(c) in place of n(c, t) bounds before any pair is counted. So a term
    leaves once its documents exceed the largest bound of the entities it meets:
    first by its documents with an entity, then by those of the corpus. Only what
    stays is paired. Entities of the same documents have the same degrees and are
    one group, told by its count and two sums of hashes: a list of ten
    thousand addresses meets its words once.

    Cases: NULL and empty texts have no spans. Copies and repeated rows are
    documents of their own in the statistics. A term that meets several
    entities is a span if it discloses one of them; it is generalised only if
    its class discloses none of those. doc_id may be NULL; other columns are
    ignored. An empty table gives an empty table."""
    docs = docs.select("doc_id", "text").withColumn("rk", row_key("doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = stage_table(docs.mapInArrow(
        _base_rows, f"doc_id {kind}, rk binary, " + ", ".join(f"n_{k} bigint" for k in KINDS[:4])
        + ", base_sha256 string, base array<struct<start:int,order:int,end:int,kind:string>>, "
        "entities array<string>, text string"), "base")
    total, doubt = float(max(base.count(), 1)), math.log(support)
    named = base.where("size(entities) > 0").select("rk", F.explode("entities").alias("entity"))
    parts = [F.sum(F.xxhash64("rk", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}")
             for i in range(2)]
    share = F.col("n") / F.lit(total)
    entities = stage_table(
        named.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), *parts)
        .select("entity", "n", F.unhex(F.md5(F.concat_ws(":", "n", "s0", "s1"))).alias("grp"),
                # A little above the bound: the degree itself decides.
                F.when(share < 1, (F.col("n") + doubt * share) * F.pow(share, F.lit(threshold - 1.0))
                       * (1 + 1e-9) - doubt + 1e-6).otherwise(-1.0).alias("cap")), "entities")
    group = F.struct("grp", "n")
    held = stage_table(
        base.where("size(entities) > 0").select("rk", "base", "text")
        .withColumn("row", F.monotonically_increasing_id())
        .join(named.join(entities, "entity").groupBy("rk")
              .agg(F.collect_set(group).alias("groups"), F.max("cap").alias("cap")), "rk"), "held")
    likely = stage_table(
        held.select("text", "cap").mapInArrow(_held_terms, "term string, n bigint, cap double")
        .groupBy("term").agg(F.sum("n").alias("n"), F.max("cap").alias("cap"))
        .where("n <= cap").select("term", "cap"), "likely")
    rare = stage_table(
        docs.select("text").mapInArrow(_term_rows(_filter_of(likely)), "term string, n bigint")
        .groupBy("term").agg(F.sum("n").alias("n_term")).join(likely, "term")
        .where("n_term <= cap").select("term", "n_term"), "rare")
    met = stage_table(
        held.select("rk", "row", "base", "text").mapInArrow(
            _met_rows(_filter_of(rare)), "rk binary, row bigint, term string, class string, "
            "at array<struct<start:int,end:int>>")
        .join(rare, "term"), "met")
    groups = held.select("row", F.explode("groups").alias("g")).select("row", "g.*")
    ic = -F.log2(share)
    degree = F.when(ic > 0, 1 + F.log2((F.col("both") + doubt * share)
                                       / (F.col("n_term") + doubt)) / ic)
    told = stage_table(
        met.select("row", "term", "n_term").distinct().join(groups, "row")
        .groupBy("grp", "n", "term", "n_term").agg(F.count(F.lit(1)).alias("both"))
        .where(degree >= threshold).select("grp", "term"), "told")
    classes = told.where(F.col("term").isin(CLASSES)).select(
        "grp", F.col("term").alias("class"), F.lit(True).alias("class_tells"))
    spans = (met.where("size(at) > 0").join(groups.select("row", "grp"), "row")
             .join(told, ["grp", "term"]).join(classes, ["grp", "class"], "left")
             .groupBy("rk", "term", "class")
             .agg(F.max(F.coalesce("class_tells", F.lit(False))).alias("remove"),
                  F.first("at").alias("at"))
             .select("rk", "class", "remove", F.explode("at").alias("w"))
             .select("rk", "class", "remove", "w.*")
             .groupBy("rk").agg(F.array_sort(F.collect_list(F.struct(
                 "start", F.lit(KINDS.index("term")).alias("order"), "end",
                 F.lit("term").alias("kind"),
                 F.when(F.col("remove"), "").otherwise(F.col("class")).alias("to")))).alias("t")))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,to:string>>")
    with_, without = (base.where(c).drop("entities", "text")
                      for c in ("size(entities) > 0", "size(entities) = 0"))
    return without.withColumn("terms", none).unionByName(
        with_.join(spans, "rk", "left").withColumn("terms", F.coalesce("t", none)).drop("t"))


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batches, "text"):
        out = []
        for text, spans in zip(chunk.column("text").to_pylist(),
                               chunk.column("spans").to_pylist(), strict=True):
            parts, at = [], 0
            for s in spans or ():
                if s["start"] >= at:  # of overlapping spans the first counts
                    parts += [text[at:s["start"]], s["to"]]
                at = max(at, s["end"])
            out.append("".join(parts) + text[at:] if parts else text)
        yield pa.RecordBatch.from_arrays(
            [chunk.column("rk"), pa.array(out, pa.string())], names=["rk", "clean"])


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` (all columns) with base spans in ``text`` replaced by their
    kind (``<email>``) and disclosing terms generalised or removed."""
    marks = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"),
        s["kind"].alias("kind"), F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("to")))
    found = (find(docs, threshold, support)
             .select("rk", F.array_sort(F.concat(marks, "terms")).alias("spans"))
             .where("size(spans) > 0").dropDuplicates(["rk"]))
    key, cleaned = free_name(docs, "_lx_rk"), free_name(docs, "_lx_clean")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    clean = (keyed.select(F.col(key).alias("rk"), "text").join(found, "rk")
             .mapInArrow(_replaced, "rk binary, clean string").dropDuplicates(["rk"])
             .select(F.col("rk").alias(key), F.col("clean").alias(cleaned)))
    return keyed.join(clean, key, "left").select(
        *columns_of(docs, text=F.coalesce(cleaned, "text")))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    plain = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    all_ = F.array_sort(F.concat("base", plain("terms")))
    return find(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{k}" for k in KINDS[:4]], "base_sha256",
        F.array_join(F.transform(all_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
                     ",").alias("spans"), F.size("terms").cast("bigint").alias("n_term"))
