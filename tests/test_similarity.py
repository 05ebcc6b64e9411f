"""Golden table T2 (FIXTURES.md) and similarity invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludex.operators import recommend as rc
from ludex.operators import similarity as si

A, B, C = 1, 2, 3
T2 = [(1, A, 4), (1, B, 2), (2, A, 2), (2, B, 1), (2, C, 5), (3, A, 3), (3, C, 3)]

EXPECTED = {  # pair: (co-rated cosine, damped intended, damped faithful, full cosine)
    (A, B): (1.000000, 0.039179, 0.742857, 0.830455),
    (B, A): (1.000000, 0.039179, 0.883117, 0.830455),
    (A, C): (0.903738, -0.756757, 0.470588, 0.605083),
    (C, A): (0.903738, -0.756757, 0.915888, 0.605083),
    (B, C): (1.000000, -0.886076, 0.847458, 0.383482),
    (C, B): (1.000000, -0.886076, 0.915888, 0.383482),
}


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(T2, "user_id bigint, item bigint, rating int")


def sims(df):
    return {(r.i1, r.i2): round(r.similarity, 6) for r in df.select("i1", "i2", "similarity").collect()}


def test_co_rated_cosine(ratings):
    got = sims(si.co_rated_cosine(ratings))
    assert got == {k: v[0] for k, v in EXPECTED.items()}


def test_damped_intended(ratings):
    got = sims(si.damped_pearson(ratings, "intended"))
    assert got == {k: v[1] for k, v in EXPECTED.items()}


def test_damped_faithful(ratings):
    got = sims(si.damped_pearson(ratings, "faithful"))
    assert got == {k: v[2] for k, v in EXPECTED.items()}


def test_full_vector_cosine(ratings):
    got = sims(si.full_cosine(ratings))
    assert got == {k: v[3] for k, v in EXPECTED.items()}


def test_repeated_rows_match_row_pairs(spark):
    """Cells (n, sum, sum of squares) give the same sums as row pairs."""
    rows = [(1, A, 4), (1, A, 2), (1, B, 3), (2, A, 1), (2, B, 5), (2, B, 1)]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, rating int")
    got = {(r.i1, r.i2): (r.sx, r.sy, r.sxy) for r in si.pair_sums(df, "rating").collect()}
    a = df.alias("a").join(df.alias("b"), (F.col("a.user_id") == F.col("b.user_id"))
                           & (F.col("a.item") < F.col("b.item")))
    ref = a.groupBy(F.col("a.item").alias("i1"), F.col("b.item").alias("i2")).agg(
        F.sum(F.col("a.rating") * F.col("a.rating")).alias("sx"),
        F.sum(F.col("b.rating") * F.col("b.rating")).alias("sy"),
        F.sum(F.col("a.rating") * F.col("b.rating")).alias("sxy")).collect()
    assert got == {(r.i1, r.i2): (float(r.sx), float(r.sy), float(r.sxy)) for r in ref}


def test_zero_co_ratings_give_zero(spark):
    df = spark.createDataFrame([(1, A, 0), (1, B, 0), (2, A, 0), (2, B, 3)],
                               "user_id bigint, item bigint, rating int")
    got = sims(si.co_rated_cosine(df))
    assert got == {(A, B): 0.0, (B, A): 0.0}


def test_single_item_user_makes_no_pair(spark):
    df = spark.createDataFrame([(1, A, 3), (2, B, 4)], "user_id bigint, item bigint, rating int")
    assert si.co_rated_cosine(df).count() == 0


def test_topk_tie_breaks_on_item(spark):
    sims_df = spark.createDataFrame(
        [(1, 5, 0.5), (1, 3, 0.5), (1, 4, 0.9), (1, 2, 0.5), (1, 6, 0.1), (1, 7, 0.5)],
        "i1 bigint, i2 bigint, similarity double")
    got = [(r.i2, r.rank) for r in si.top_k(sims_df, k=3).orderBy("rank").collect()]
    assert got == [(4, 1), (2, 2), (3, 3)]


def test_similarity_invariants(spark, sf_small):
    from ludex.plans.queries import knn_train_test
    train, _ = knn_train_test(spark, sf_small)
    cos = si.co_rated_cosine(train)
    assert cos.filter((F.col("similarity") < -1 - 1e-9) | (F.col("similarity") > 1 + 1e-9)).count() == 0
    assert cos.filter(F.col("i1") == F.col("i2")).count() == 0
    a = cos.select("i1", "i2", "similarity")
    b = cos.select(F.col("i2").alias("i1"), F.col("i1").alias("i2"), F.col("similarity").alias("s2"))
    assert a.join(b, ["i1", "i2"]).filter(F.abs(F.col("similarity") - F.col("s2")) > 1e-12).count() == 0
    pea = si.damped_pearson(train, "intended")
    assert pea.filter(F.abs("similarity") >= 1).count() == 0
    nn = si.top_k(cos)
    assert nn.groupBy("i1").count().filter(F.col("count") > si.TOP_K).count() == 0


def test_recommendations_exclude_owned(spark, sf_small):
    from ludex.plans.queries import log, recommend
    recs = recommend(spark, sf_small)
    owned = log(spark, sf_small).select("user_id", "item")
    assert recs.join(owned, ["user_id", "item"]).count() == 0
    assert recs.groupBy("user_id").count().filter(F.col("count") > rc.TOP_N).count() == 0
    assert recs.count() > 0


@pytest.mark.parametrize("slice_items", [1, 2, 5])
def test_salted_pairs_equal_unsalted(spark, sf_small, slice_items):
    """Cut every user's items into tiny slices (many salts per user): the
    pair rows must be exactly those of the one-slice join."""
    from ludex.plans.queries import knn_train_test
    train, _ = knn_train_test(spark, sf_small)
    c = si.cells(train, "rating")
    cols = ["user_id", "i1", "i2", "xx", "yy", "xy"]
    a = si.pair_rows(c, slice_items=slice_items).select(*cols)
    b = si.pair_rows(c, slice_items=10**9).select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_salted_pairs_hot_user(spark):
    """One user rating every item (a hot user, cut into 13 slices of 3)
    next to light users: same pair rows as the one-slice join."""
    rows = [(1, i, (i % 5) + 1) for i in range(1, 40)] + \
           [(u, i, (u + i) % 5) for u in range(2, 12) for i in range(u, u + 4)]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, rating int")
    a = si.pair_rows(si.cells(df, "rating"), slice_items=3)
    b = si.pair_rows(si.cells(df, "rating"), slice_items=10**9)
    assert a.count() == b.count() == 39 * 38 // 2 + 10 * 6
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("kind", ["cosine", "pearson"])
def test_bounded_top_k_equals_top_k(spark, kind):
    """Sparse items that close early, dense ones that stay open, zero ratings,
    ties at 1, NULL users and items, a hot user."""
    import random
    rnd = random.Random(8)
    rows = [(u, rnd.randint(0, 39), rnd.randint(0, 5)) for u in range(120) for _ in range(2)]
    rows += [(u, 100 + rnd.randint(0, 9), rnd.randint(0, 5)) for u in range(60) for _ in range(6)]
    rows += [(999, i, rnd.randint(1, 5)) for i in range(60)] + [(None, 3, 4), (5, None, 4)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item bigint, rating bigint")
    plain = si.co_rated_cosine(ratings) if kind == "cosine" else si.damped_pearson(ratings)
    want = {(r.i1, r.rank): (r.i2, round(r.similarity, 8)) for r in si.top_k(plain, 3).collect()}
    for share in (0.02, 0.3, 1.0):
        got = {(r.i1, r.rank): (r.i2, round(r.similarity, 8))
               for r in si.top_k_bounded(ratings, kind, 3, share).collect()}
        assert got == want, share


def test_bounded_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "user_id bigint, item bigint, rating bigint")
    assert si.top_k_bounded(none).count() == 0
    with pytest.raises(ValueError):
        si.top_k_bounded(none, "jaccard")


def _sums(df):
    return {(r.i1, r.i2): tuple(round(x, 6) for x in (r.sx, r.sy, r.sxy, r.n_users)) for r in df.collect()}


@pytest.mark.parametrize("centre", [False, True])
@pytest.mark.parametrize("limits", [{}, {"slice_items": 3}, {"item_rows": 40}, {"item_rows": 0},
                                    {"task_rows": 7}])
def test_summed_pairs_equal_sums_of_pair_rows(spark, centre, limits):
    """Items by lists, by partial sums and by both, lists in slices, repeated
    ratings, NULL users and items: the sums of the plain pair rows."""
    rows = [(u, (u * 7 + j * j) % 23, (u + j) % 6) for u in range(30) for j in range(4)]
    rows += [(77, i, i % 5) for i in range(20)] + [(77, 3, 4), (None, 3, 4), (5, None, 4), (5, 2, 1)]
    c = si.cells(spark.createDataFrame(rows, "user_id bigint, item bigint, rating int"), "rating")
    plain = si.pair_rows(c, centre=centre).groupBy("i1", "i2").agg(
        F.sum("xx").alias("sx"), F.sum("yy").alias("sy"), F.sum("xy").alias("sxy"),
        F.count(F.lit(1)).alias("n_users"))
    want = _sums(plain)
    assert _sums(si.summed_pairs(c, centre, **limits)) == want
    both = _sums(si.summed_pairs(c, centre, only="all", **limits))
    assert both == want | {(b, a): (y, x, p, n) for (a, b), (x, y, p, n) in want.items()}


def test_sparse_pairs_are_not_shuffled(spark):
    """Items of few users: behind the pairs no exchange; only lists are sent."""
    import contextlib
    import io
    rows = [(u, (u * 13 + j * 7) % 400, 1 + j % 5) for u in range(60) for j in range(8)]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, rating int")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        si.pair_sums(df, "rating").explain("simple")
    plan = text.getvalue()
    assert "explode" in plan and "Exchange" not in plan[:plan.index("explode")]


def test_bounded_pairs_grow_with_the_rows(spark, monkeypatch):
    """Copies of the rows with other users and items leave the share of items
    that stay open as it is: the second pass is no larger than the copies."""
    made = {}
    plain = si.summed_pairs

    def counted(c, centre=False, only="half", keep=None, **more):
        out = plain(c, centre, only, keep, **more)
        made[only] = made.get(only, 0) + out.count()
        return out

    monkeypatch.setattr(si, "summed_pairs", counted)
    base = [(u, (u * u * 3 + j * 17) % 300, 1 + (u + j) % 5) for u in range(60) for j in range(12)]
    seen = []
    for copies in (1, 6):
        rows = [(u + 1000 * x, i + 1000 * x, r) for x in range(copies) for u, i, r in base]
        si.top_k_bounded(spark.createDataFrame(rows, "user_id bigint, item bigint, rating bigint"))
        seen.append(dict(made))
        made.clear()
    assert seen[1] == {kind: 6 * n for kind, n in seen[0].items()}
    assert seen[0]["far"] < 60 * 12 * 11 / 2


def test_lists_are_packed(spark):
    """A pair takes few bytes on its way to the task that sums it."""
    rows = [(u, (u * 7919 + j * j * 104729) % 1_000_003, 1 + j % 5) for u in range(300) for j in range(30)]
    c = si.cells(spark.createDataFrame(rows, "user_id bigint, item bigint, rating int"), "rating")
    made = si.pair_lists(c)
    sent = made.lists.mapInArrow(si.pairlists.send("half", 4, made.low, False), si.pairlists.SENT)
    size, pairs = sent.agg(F.sum(F.length("blob")), F.sum("pairs")).first()
    assert pairs == 300 * 30 * 29 / 2
    assert size < 4 * pairs


@pytest.mark.parametrize("centre", [False, True])
def test_pairs_of_odd_rows(spark, centre):
    """Names as items, far apart and negative items, fractions, NULL ratings."""
    rows = [(u, (u * 7 + j * j) % 23, None if (u + j) % 9 == 0 else (u * j % 7) / 3) for u in range(30)
            for j in range(5)]
    for kind, name in (("string", "i{}".format), ("bigint", lambda i: (i - 11) * 2 ** 58),
                       ("smallint", lambda i: i - 11)):
        for part in (rows, [r for r in rows if r[2] is not None]):
            c = si.cells(spark.createDataFrame([(u, name(i), v) for u, i, v in part],
                                               f"user_id bigint, item {kind}, rating double"), "rating")
            want = si.pair_rows(c, centre=centre).groupBy("i1", "i2").agg(
                F.sum("xx").alias("sx"), F.sum("yy").alias("sy"), F.sum("xy").alias("sxy"),
                F.count(F.lit(1)).alias("n_users"))
            got = si.summed_pairs(c, centre)
            assert got.schema["i1"].dataType == c.schema["item"].dataType
            assert _nulls(got) == _nulls(want)


def _nulls(df):
    return {(r.i1, r.i2): tuple(None if x is None else round(x, 6) for x in (r.sx, r.sy, r.sxy, r.n_users))
            for r in df.collect()}


def test_best_pairs_are_those_of_top_k():
    """The k largest of each group, the first of equal ones."""
    import numpy as np
    i1 = np.array([0, 0, 0, 0, 2, 3, 3, 3])
    key = np.array([1., 5, 5, 5, -3, 2, np.inf, 2])
    assert si.pairlists._best(i1, key.copy(), 2).tolist() == [1, 2, 4, 5, 6]


def test_shuffle_files_go_with_the_write(spark):
    """A staged table leaves no shuffle files behind."""
    from ludex.session import stage_table
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    import os
    dirs = [str(d) for d in manager.localDirs()]

    def files():
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = files()
    staged = stage_table(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    assert files() <= before
    assert staged.count() == 7
