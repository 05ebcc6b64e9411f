import random
import re
from collections import Counter

import numpy as np
import pytest

from ludex.llm import collocations as co

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, max_words, top):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, max_words + 1):
                for s in range(len(words) - m + 1):
                    count[lang, tuple(words[s:s + m])] += 1
    cand = {k: a for k, a in count.items() if a >= threshold and len(k[1]) > 1}
    out = []
    for lang in {k[0] for k in cand}:
        rows = []
        for (g, w), a in cand.items():
            if g != lang or any(
                    h == lang and len(v) > len(w) and b >= a
                    and any(v[s:s + len(w)] == w for s in range(len(v)))
                    for (h, v), b in cand.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = count[lang, w[:k]], count[lang, w[k:]]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                  for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(1, t, g, "p", 0) for t, g in rows],
                                 "doc_id bigint, text string, lang string, phrase string, m int")


@pytest.mark.parametrize("top", [3, 2000])
def test_equals_brute_force(spark, top):
    rnd = random.Random(5)
    words = ["a", "B", "the", "é", "new", "york", "x\x00y", " ", "#", "\U0001f600"]
    rows = [(None, "en"), ("", None), (" \t .,", "en"), ("one", "")]
    for _ in range(150):
        text = ""
        for _ in range(rnd.randint(0, 40)):
            text += rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ":"])
            if rnd.random() < .2:
                text += "New York City "
        rows.append((text, rnd.choice(["en", "en", "de", None, "und"])))
    rows += [("same words here again", "fr")] * 12 + [("q " * 3000, "es")]
    got = result(co.collocations(table(spark, rows), 8, 5, top))
    assert got == brute(rows, 8, 5, top)
    assert any("same words here again" == r[2] for r in got)


def test_empty_and_nothing_frequent(spark):
    assert co.collocations(table(spark, [])).count() == 0
    assert co.collocations(table(spark, [("one two three", "en")])).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_summaries_keep_every_frequent_key(parts):
    rng = np.random.default_rng(2)
    keys = np.minimum(rng.zipf(1.3, 40_000), 5000).astype(np.uint64)
    threshold = 60
    capacity = len(keys) // threshold + 1
    merged = co.MisraGries(capacity, threshold)
    for share in np.array_split(rng.permutation(keys), parts):
        one = co.MisraGries(capacity, threshold)
        for some in np.array_split(share, 40):
            one.add(*np.unique(some, return_counts=True))
            assert len(one.keys) <= one.capacity == capacity
        merged.merge(one)
    assert 0 < merged.lost < threshold and merged.capacity == capacity
    check(merged, keys, threshold)


def check(summary, keys, threshold):
    true = Counter(keys.tolist())
    held = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert all(held.get(k, 0) <= n <= held.get(k, 0) + summary.lost for k, n in true.items())
    assert {k for k, n in true.items() if n >= threshold} <= set(summary.frequent().tolist())


def test_summary_with_too_few_counters_grows():
    keys = np.random.default_rng(4).integers(0, 500, 30_000).astype(np.uint64)
    summary = co.MisraGries(8, 50)
    for some in np.array_split(keys, 30):
        summary.add(*np.unique(some, return_counts=True))
    assert summary.lost < 50 and summary.capacity > 8
    check(summary, keys, 50)


def test_small_summaries_suffice(spark, monkeypatch):
    # Far more distinct words than counters: the summaries have to reduce.
    monkeypatch.setattr(co, "LEAST_COUNTERS", 4)
    monkeypatch.setattr(co, "BUFFER_WORDS", 500)
    rows = [(" ".join(f"w{i}_{k}" for k in range(400)) + " often met", "en") for i in range(60)]
    assert [r[2] for r in result(co.collocations(table(spark, rows), 50))] == ["often met"]
