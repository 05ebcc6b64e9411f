import re
from collections import Counter

import pytest

from ludex.llm import quality as qu

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = set()
    for i in range(len(words) - 2):
        if wins[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
TEXTS = ["", None, "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\ny\nx", "|| a | b <>",
         "a\x1fb c\x0bd\x0ce", "one two three\none two three four\r\none two", "é 😀 é 😀 é 😀 é"]


def test_measures(make_docs, edge_docs, edge_rows):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in qu.measures(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    got = sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS))
                 for r in qu.measures(edge_docs).collect())
    assert got == sorted((str(i), *brute(t)) for i, t in edge_rows)


def test_fixture_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in qu.op10_quality_rules(spark, sf_small).collect():
        want = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in COLUMNS) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_fit_recovers_accuracies(spark):
    import random

    rnd = random.Random(4)
    accuracy = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.7, 0.65]
    rows, truth = [], []
    for _ in range(4000):
        good = rnd.random() < 0.7
        truth.append(good)
        rows.append([0 if rnd.random() < 0.2 else (1 if (rnd.random() < a) == good else -1)
                     for a in accuracy])
    voted = spark.createDataFrame(rows, ", ".join(f"vote_{r[0]} int" for r in qu.RULES))
    model = qu.fit(voted)
    assert model["good"] == pytest.approx(0.7, abs=0.05)
    for a, (name, *_) in zip(accuracy, qu.RULES, strict=True):
        p = model["p", name, 1][0] / (model["p", name, 1][0] + model["p", name, -1][0])
        assert p == pytest.approx(a, abs=0.06)


def test_held_out_labels(spark):
    """Labels are not used in the fit; the verdict should agree with them."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    both = qu.op10_quality_rules(spark, d).join(labels, "doc_id").where("not base_failed").collect()
    agree = sum(r["kept"] == (r["quality"] == 1) for r in both) / len(both)
    clean = [r for r in both if r["quality"] == 1]
    assert agree > 0.95 and sum(r["kept"] for r in clean) / len(clean) > 0.98


def test_edges(edge_docs, edge_rows, no_docs):
    assert qu.judge(edge_docs).count() == len(edge_rows)
    assert qu.judge(no_docs).count() == 0
    kept = qu.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    assert all(r["rk"] == "x" and r["_lx_rk"] == "k" for r in kept.collect())
    assert qu.keep_good(no_docs).count() == 0


def plain_votes(text):
    """The eight votes of a document, from its text."""
    import unicodedata

    text = text or ""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = brute(text)
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    kinds = [unicodedata.category(c) for c in text]
    letters, upper = sum(k[0] == "L" for k in kinds), kinds.count("Lu")
    given = [(n_symbols, n_words, None, 0.10), (text.count("|"), n_words, None, 0.15),
             (word_chars - letters, word_chars, 0.06, 0.12), (upper, letters, None, 0.40),
             (sum(c in "!?.,;:" for c in text), n_words, None, 0.80),
             (n_repeat, n_words, None, 0.30), (n_dup_lines, len(lines), None, 0.30),
             (n_words - len(set(words)), n_words, None, 0.85)]
    return [0 if not whole else -1 if part / whole >= bad else
            1 if good is not None and part / whole <= good else 0
            for part, whole, good, bad in given]


def plain_em(votes, rounds=30):
    """P(good) per document by expectation-maximisation over the documents
    themselves; returns a scorer."""
    import numpy as np

    v = np.array(votes)
    prior = {1: (0.4, 0.1), -1: (0.1, 0.4)}
    p_good = 0.8
    p = {(j, x): prior[x] for j in range(8) for x in prior}

    def score(v):
        total = np.full(len(v), np.log(p_good / (1 - p_good)))
        for j in range(8):
            up, down = p[j, 1], p[j, -1]
            none = [1 - up[k] - down[k] for k in (0, 1)]
            for x, (a, b) in ((1, up), (-1, down), (0, none)):
                total[v[:, j] == x] += np.log(a / b)
        return 1 / (1 + np.exp(-total))

    for _ in range(rounds):
        g = score(v)
        was = [p_good, *(x for k in p.values() for x in k)]
        new = {}
        for j, x in p:
            at = v[:, j] == x
            new[j, x] = ((g[at].sum() + 20 * prior[x][0]) / (g.sum() + 20),
                         ((1 - g[at]).sum() + 20 * prior[x][1]) / ((1 - g).sum() + 20))
        p_good, p = (g.sum() + 16) / (len(v) + 20), new
        if max(abs(a - b) for a, b in zip(was, [p_good, *(x for k in p.values() for x in k)],
                                          strict=True)) < 1e-5:
            break
    return score


def test_verdict_against_brute_force(spark, sf_small):
    import numpy as np

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    given = {i: plain_votes(t) for i, t in texts.items()}
    score = plain_em([v for i, v in given.items() if brute(texts[i])[0] >= 50])
    rows = qu.op10_quality_rules(spark, sf_small).collect()
    want = score(np.array([given[r["doc_id"]] for r in rows]))
    assert [r["p_good"] for r in rows] == pytest.approx(list(want), abs=1e-6)
    assert [r["kept"] for r in rows] == [not r["base_failed"] and w >= 0.5
                                         for r, w in zip(rows, want, strict=True)]
    assert len({r["kept"] for r in rows if not r["base_failed"]}) == 2
