"""Language identification by string kernels.

The blended-spectrum presence kernel of two texts is the number of character
n-grams of 1 to 3 letters that both hold, over the root of the product of their
numbers of n-grams. It is approximated on landmark texts (Nyström): a text's
features are its kernel values with the landmarks times K_mm^(-1/2), and one
ridge regression per language, that language against the rest, is fitted on
them. The value of a language is thus K(x, landmarks) @ A. As K(x, landmarks) is
itself a product of presence matrices, texts are scored in batches as
(presence of the landmarks' n-grams) @ (landmarks' presence @ A).

Texts are lower-cased; a run of characters that are not letters is a blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludex.llm.common import read_table, text_chunks

# Labelled texts per language that the regressions are fitted on (the first by
# hash of their id), and how many of them are landmarks.
PER_LANG = 400
LANDMARKS = 64
RIDGE = 1e-3
# One document in HELD_OUT is never learned from.
HELD_OUT = 5
UNKNOWN = "und"
# Characters of a text handled at once; texts scored by one matrix product.
SLICE = 1 << 20
BATCH = 64
# Places that values are rounded to, as sums in a batch vary in the last bits.
DIGITS = 9

_SHIFT = 21  # bits of a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])]


def grams(text: str | None) -> np.ndarray:
    """The distinct n-grams of a text as ascending numbers; none without a
    letter. An n-gram is the code points, 21 bits each (a blank alone is none)."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    # Every run of other characters leaves the one after a letter, as a blank.
    first = np.concatenate([[False], letter[:-1]])
    codes = np.where(letter, codes, 32)[letter | first].astype(np.int64)
    codes = np.concatenate([[32], codes, [32] if codes[-1] != 32 else []]).astype(np.int64)
    three = np.lib.stride_tricks.sliding_window_view(codes, 3)
    found = np.unique(np.concatenate([np.unique(
        (three[s:s + SLICE, 0] << 2 * _SHIFT) | (three[s:s + SLICE, 1] << _SHIFT)
        | three[s:s + SLICE, 2]) for s in range(0, len(three), SLICE)]))
    pairs = _distinct(np.sort(np.append(found >> _SHIFT, (codes[-2] << _SHIFT) | codes[-1])))
    single = _distinct(pairs >> _SHIFT)
    return np.concatenate([single[single != 32], pairs, found])


def kernel(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Kernel values of two lists of n-gram sets, by one matrix product."""
    names = np.unique(np.concatenate([np.empty(0, np.int64), *right]))
    return _presence(left, names) @ _presence(right, names).T


def _presence(sets: list[np.ndarray], names: np.ndarray) -> np.ndarray:
    """Which of ``names`` (ascending) each set holds, over the root of its size."""
    out = np.zeros((len(sets), len(names)))
    for row, held in zip(out, sets, strict=True):
        at = np.minimum(np.searchsorted(names, held), max(len(names) - 1, 0))
        if len(held) and len(names):
            row[at[names[at] == held]] = 1 / np.sqrt(len(held))
    return out


@dataclass
class Model:
    langs: list[str]      # ascending by bytes
    names: np.ndarray     # n-grams of the landmarks
    weights: np.ndarray   # names x langs: landmarks' presence times the coefficients

    def values(self, sets: list[np.ndarray]) -> np.ndarray:
        return _presence(sets, self.names) @ self.weights


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> Model:
    """Nyström kernel ridge regression, one language against the rest. The first
    ``landmarks`` texts of each language are landmarks."""
    known = sorted(set(langs), key=str.encode)
    own = np.array([known.index(x) for x in langs], np.int64)
    marks = [k for c in range(len(known)) for k in np.flatnonzero(own == c)[:landmarks].tolist()]
    chosen = [sets[k] for k in marks]
    names = np.unique(np.concatenate([np.empty(0, np.int64), *chosen]))
    if not known:
        return Model([], names, np.zeros((0, 0)))
    held = _presence(chosen, names)
    value, vector = np.linalg.eigh(held @ held.T)
    # Copies among the landmarks leave directions without weight.
    real = value > 1e-6 * value.max()
    root = vector[:, real] / np.sqrt(value[real])
    # The sample's features, a batch of texts at a time.
    features = np.concatenate([(_presence(sets[s:s + BATCH], names) @ held.T) @ root
                               for s in range(0, len(sets), BATCH)])
    target = (own[:, None] == np.arange(len(known))).astype(np.float64)
    # Each language weighs the same, however many texts it has.
    share = 1 / (len(known) * np.bincount(own)[own])
    gram = features.T @ (features * share[:, None]) + ridge * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, features.T @ (target * share[:, None]))
    return Model(known, names, held.T @ (root @ beta))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT == 0, F.lit(False))


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batches, "text"):
        sets = [grams(t) for t in chunk.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [chunk.column("lang"), chunk.column("place"), pa.array(sets, pa.list_(pa.int64()))],
            names=["lang", "place", "grams"])


def learn(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS,
          ridge: float = RIDGE) -> Model:
    """The model of ``docs`` (doc_id, text, lang): of each language the first
    ``per_lang`` ids by hash, of documents that are not held out and have a
    letter. Only their sets of n-grams reach the driver."""
    usable = docs.select("doc_id", "text", "lang").where(
        "doc_id is not null and lang is not null and text rlike '\\\\p{L}'").where(
        ~held_out(F.col("doc_id")))
    place = F.md5(F.col("doc_id").cast("string"))
    order = Window.partitionBy("lang").orderBy("place")
    ids = (usable.select("lang", place.alias("place"))
           .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_lang)
           .select("lang", "place").distinct())
    texts = (usable.withColumn("place", place).join(ids, ["lang", "place"], "left_semi")
             .groupBy("lang", "place").agg(F.min("text").alias("text")))
    rows = texts.mapInArrow(_gram_rows, "lang string, place string, grams array<bigint>").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("place", "ascending")])
    sets = [g.values.to_numpy() for g in rows.column("grams")]
    some = [k for k, g in enumerate(sets) if len(g)]
    langs = rows.column("lang").to_pylist()
    return fit([sets[k] for k in some], [langs[k] for k in some], landmarks, ridge)


def _predictions(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for chunk in text_chunks(batches, "text"):
            for start in range(0, chunk.num_rows, BATCH):
                part = chunk.slice(start, BATCH)
                sets = [grams(t) for t in part.column("text").to_pylist()]
                known = np.array([len(s) > 0 for s in sets])
                if m.langs:
                    values = np.round(m.values(sets), DIGITS)
                    best = values.argmax(axis=1)
                    score = np.clip(values.max(axis=1), 0, 1) * known
                    names = [m.langs[b] if k else UNKNOWN
                             for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                else:
                    score, names = np.zeros(len(sets)), [UNKNOWN] * len(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()),
                     pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict_lang(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, held_out, lang_pred, score (the value of
    the language, cut to 0..1). Only the text enters a prediction.

    Cases: NULL texts and texts without a letter are ``und`` with score 0, as is
    every text if nothing could be learned. Equal values go to the first language
    by bytes. Repeated rows and a NULL or repeated doc_id stay as they are; equal
    texts get equal predictions. Other columns are ignored. An empty table
    gives an empty table."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _predictions(docs.sparkSession.sparkContext.broadcast(model)),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict_lang(docs, learn(docs))
