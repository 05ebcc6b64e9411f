import random

import numpy as np
import pytest

from ludex.llm import langid as li

WORDS = {"en": "the and of with night house about there", "fr": "le et de avec nuit maison où été",
         "de": "der und von mit nacht haus über für", None: "lorem ipsum"}


def sentences(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        rows.append((i, " ".join(rnd.choices(WORDS[lang].split(), k=rnd.randint(6, 30))), lang))
    return rows


def brute_grams(text):
    text = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not text.strip():
        return set()
    text = " " + " ".join(text.split()) + " "
    return {text[s:s + n] for n in (1, 2, 3) for s in range(len(text) - n + 1)} - {" "}


def as_text(gram):
    codes = [(gram >> shift) & ((1 << 21) - 1) for shift in (42, 21, 0)]
    return "".join(chr(c) for c in codes if c)


TEXTS = ["one", "a", "ß!", "The  END; 12 the", "é\x00ü \U0001f600 x", "ÀÉ\n\t.z", "日本語 テスト",
         "q " * 50, "ab" * 3000, "", None, " .;12\U0001f600"]


def test_grams(monkeypatch):
    for text in TEXTS:
        assert {as_text(g) for g in li.grams(text).tolist()} == brute_grams(text), text
    monkeypatch.setattr(li, "SLICE", 7)
    for text in TEXTS:
        assert {as_text(g) for g in li.grams(text).tolist()} == brute_grams(text), text


def test_kernel_and_values():
    rows = [r for r in sentences(60, 1) if r[2]]
    sets = [li.grams(t) for _, t, _ in rows]
    bare = [brute_grams(t) for _, t, _ in rows]
    exact = np.array([[len(a & b) / (len(a) * len(b)) ** .5 for b in bare] for a in bare])
    assert np.allclose(li.kernel(sets, sets), exact, atol=1e-5)
    # All texts are landmarks: the values are those of exact ridge regression.
    langs = [r[2] for r in rows]
    model = li.fit(sets, langs, landmarks=len(sets), ridge=1e-3)
    own = np.array([model.langs.index(x) for x in langs])
    share = np.diag(1 / (len(model.langs) * np.bincount(own)[own]))
    target = (own[:, None] == np.arange(len(model.langs))).astype(float)
    alpha = np.linalg.solve(share @ exact + 1e-3 * np.eye(len(rows)), share @ target)
    assert np.allclose(model.values(sets), exact @ alpha, atol=2e-2)


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", "x") for i, t, g in rows],
                                 "doc_id bigint, text string, lang string, source string, "
                                 "place string")


@pytest.fixture(scope="module")
def model(spark):
    return li.learn(table(spark, sentences(400, 2)), per_lang=40, landmarks=10)


def test_learns_from_the_right_rows(spark, model):
    rows = sentences(400, 2)
    ids = spark.createDataFrame([(i,) for i in range(400)], "doc_id bigint")
    out = {r[0]: r[1] for r in ids.select("doc_id", li.held_out(ids.doc_id)).collect()}
    other = [(i, "zzz", "fr") if out[i] else (i, t, g) for i, t, g in rows]
    other += [(None, "zzz yyy", "en"), (2000, None, "en"), (2001, "12 !", "xx"), (2002, "abc", None)]
    again = li.learn(table(spark, other), per_lang=40, landmarks=10)
    assert again.langs == model.langs == ["de", "en", "fr"]
    assert np.array_equal(again.names, model.names)
    assert np.allclose(again.weights, model.weights)


def test_predictions(spark, model):
    rows = [(1, "the house and the night", "fr"), (1, "the house and the night", None),
            (None, "für über haus", None), (3, None, "en"), (4, "", "en"), (5, "12 \U0001f600", "en"),
            (6, "avec la maison " * 20000, "en")]
    got = [(r["doc_id"], r["lang_pred"]) for r in li.predict_lang(table(spark, rows), model).collect()]
    assert got == [(1, "en"), (1, "en"), (None, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "fr")]
    scores = [r["score"] for r in li.predict_lang(table(spark, rows), model).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] and scores[3:6] == [0, 0, 0]


def test_nothing_to_learn(spark):
    none = li.learn(table(spark, []))
    assert li.predict_lang(table(spark, []), none).count() == 0
    row = li.predict_lang(table(spark, [(1, "the", "en")]), none).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    found = li.op11_language_id(spark, sf_small).join(docs.select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.where("held_out").collect()]
    assert len(rows) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.9
