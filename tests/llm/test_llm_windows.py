import hashlib
import random
from collections import Counter

import numpy as np

from ludex.llm import windows as wi


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[s:s + window]) for w in words for s in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - window + 1):
            if count[tuple(w[s:s + window])] > 1:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def test_edge_cases(edge_docs, edge_rows):
    # The long run of one word goes by a shorter brute force below.
    got = result(wi.substring_dedup(edge_docs))
    assert got == sorted(brute(edge_rows, 35), key=lambda r: tuple((x is None, x) for x in r))


def test_random_overlaps(make_docs):
    rnd = random.Random(3)
    passages = [[f"p{k}w{i}" for i in range(rnd.randint(8, 60))] for k in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rnd.randint(0, 6)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else \
                [rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 20))]
        rows.append((i, " ".join(words)))
    for window, gram in ((12, 5), (35, 8), (3, 1)):
        got = result(wi.substring_dedup(make_docs(rows), window, gram))
        assert got == sorted(brute(rows, window))


def test_removed_and_text(make_docs):
    same = " ".join(f"s{i}" for i in range(12))
    out = {r["doc_id"]: r for r in wi.substring_dedup(
        make_docs([(1, f"a b {same} c"), (2, f"{same} d"), (3, "q r")]), 10, 4,
        with_text=True).collect()}
    assert out[1]["kept_text"] == "a b c" and out[1]["removed"] == [2, 14]
    assert out[2]["kept_text"] == "d" and out[3]["kept_text"] is None


def test_empty(no_docs):
    assert wi.substring_dedup(no_docs).count() == 0


def test_rolling_hashes_agree_on_equal_windows():
    words = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    doubled = np.concatenate([words, words])
    h = wi.rolling_hashes(doubled, 35)
    assert (h[:400] == h[500:900]).all() and len(set(h[:500].tolist())) == 500
