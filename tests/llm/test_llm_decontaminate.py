import random

import pytest

from ludex.llm import decontaminate as de


def brute(rows, items, window=10):
    wins = {}
    for name, text in items:
        w = de.normal_words((text or "").encode())
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w and name is not None else 0):
            wins.setdefault(tuple(w[s:s + k]), set()).add(str(name))
    out = []
    for doc_id, text in rows:
        w = de.normal_words((text or "").encode())
        hit, found = set(), set()
        for k in {len(x) for x in wins}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in wins:
                    hit |= set(range(s, s + k))
                    found |= wins[tuple(w[s:s + k])]
        out.append((doc_id, len(w), sorted(hit), sorted(found)))
    return out


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in df.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "k") for i, t in items],
                                 "item_id bigint, text string, doc_id string")


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_random(spark, make_docs, block_words):
    rnd = random.Random(7)
    words = lambda n: [rnd.choice("abc") for _ in range(n)]
    items = [(i, " ".join(words(rnd.choice([1, 2, 4, 9, 10, 11, 25]) + 3 * (i % 2))))
             for i in range(12)] + [(99, ""), (98, None), (None, "a b c d e f g h i j k"),
                                    (50, "A, b; C d"), (51, "a b c d")]
    rows = [(i, " ".join(words(rnd.randint(0, 80)))) for i in range(40)]
    rows += [(100, None), (None, items[3][1]), (101, items[5][1].upper().replace(" ", "!! "))]
    got = result(de.contamination(make_docs(rows), benchmark(spark, items),
                                  block_words=block_words))
    assert got == sorted(brute(rows, items), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_edges(spark, edge_docs, edge_rows, no_docs):
    items = [(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (2, "é ü"), (3, "one two")]
    got = result(de.contamination(edge_docs, benchmark(spark, items)))
    assert got == sorted(brute(edge_rows, items), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert de.contamination(no_docs, benchmark(spark, items)).count() == 0
    assert all(r["hits"] == [] for r in
               de.contamination(edge_docs, benchmark(spark, [])).collect())


def test_cleaning(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda"
    filler = " ".join(f"f{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, f"{filler} {item}. End", 7, "en"), (2, f"x {item}", 8, "en"), (3, filler, 9, None),
         (4, None, None, "en")], "doc_id bigint, text string, n_chars bigint, _lx_rk string")
    out = {r["doc_id"]: r for r in de.decontaminate(docs, benchmark(spark, [(1, item)])).collect()}
    assert set(out) == {1, 3, 4}
    assert out[1]["text"] == f"{filler} . End" and out[1]["n_chars"] == len(out[1]["text"])
    assert out[3]["n_chars"] == 9 and out[1]["_lx_rk"] == "en" and out[4]["text"] is None


def test_short_items_are_cut_out(spark):
    filler = " ".join(f"f{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{filler} Who wrote the Odyssey? End"), (2, f"{filler} yes")],
                                 "doc_id bigint, text string")
    items = benchmark(spark, [(1, "who wrote the odyssey"), (2, "Yes")])
    out = {r["doc_id"]: r["text"] for r in de.decontaminate(docs, items).collect()}
    assert out == {1: f"{filler} ? End", 2: f"{filler} yes"}


def test_blocks_of_texts_without_spaces(spark):
    items = benchmark(spark, [(i, "a\nb,c\td;e.f\n" * 10) for i in range(10)] + [(10, "x" * 4800)])
    assert len(list(de._blocks(items, 600))) == 2
