"""LSH neighbours, ALS model search, behaviour classifier, bootstrap, stable
codes, rejected CSV lines, medians per group."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludex.operators import classify, evaluate as ev, lsh, profile as pr, similarity as si, tuning
from ludex.operators.indexing import dense_index, extend_index
from ludex.plans import queries as q
from ludex.sources.adapters import csv_log
from ludex.sources.readers import read_behaviour_lines

RATINGS = "user_id bigint, item bigint, rating bigint"


# ------------------------------------------------------------------ LSH

def test_lsh_finds_similar_items_among_many(spark):
    """Groups of four similar items among unrelated ones: nearly all links
    are found, few other pairs are looked at, similarities are exact."""
    rnd = random.Random(1)
    rows = []
    for group in range(60):
        users = rnd.sample(range(3000), 40)
        for k in range(4):
            rows += [(u, group * 4 + k, rnd.randint(3, 5)) for u in rnd.sample(users, 37)]
    ratings = spark.createDataFrame(rows, RATINGS)
    want = {(r.i1, r.i2): r.similarity for r in si.full_cosine(ratings).collect()}
    got = {(r.i1, r.i2): r.similarity
           for r in lsh.lsh_cosine(ratings, bits=12, tables=40).collect()}
    assert all(math.isclose(want[p], s, abs_tol=1e-9) for p, s in got.items())
    close = {p for p, s in want.items() if s > .8}
    assert len(close) == 60 * 4 * 3 and len(close & set(got)) >= .95 * len(close)
    vectors = si.l2_normalised(ratings).select("item", "user_id", F.col("norm_value").alias("v"))
    looked_at = lsh.candidates(lsh.signatures(vectors, 12, 40)).count()
    assert looked_at < .05 * 240 * 239 / 2


def test_lsh_recall_on_the_log(spark, sf_small):
    exact = si.top_k(si.full_cosine(q.rated(spark, sf_small, "als"))).select("i1", "i2")
    found = q.q53_lsh_neighbours(spark, sf_small).select("i1", "i2")
    assert exact.join(found, ["i1", "i2"]).count() >= .9 * exact.count() > 0


def test_lsh_edge_cases(spark):
    assert lsh.lsh_cosine(spark.createDataFrame([], RATINGS)).count() == 0
    rows = [(1, 1, 0), (2, 1, 0), (1, 2, 3), (2, 2, 4), (1, 3, 3), (2, 3, 4), (None, 3, 5),
            (7, None, 5), (8, 3, None), (1, 3, 3)]
    got = {(r.i1, r.i2): r.similarity
           for r in lsh.lsh_cosine(spark.createDataFrame(rows, RATINGS)).collect()}
    assert set(got) == {(2, 3), (3, 2)} and math.isclose(got[2, 3], 1, abs_tol=1e-9)
    with pytest.raises(ValueError):
        lsh.signatures(spark.createDataFrame([], "item int, user_id int, v double"), bits=3)


# --------------------------------------------------------- model search

def test_search_picks_the_least_error(spark, sf_small):
    grid = ((2, 0.1), (2, 50.0))
    rows = q.rated(spark, sf_small, "knn")
    trials, run, best = tuning.search(rows, grid, folds=2, max_iter=2)
    assert [(t.fold, t.rank, t.reg) for t in trials] == [(k, *p) for k in range(2) for p in grid]
    train = rows.where("is_train").select("user_id", "item", "rkey")
    scored = {r.fold: r.n_scored for r in tuning.fold_rows(train, 2).collect()}
    assert all(t.n == scored[t.fold] for t in trials)
    error = {p: sum(t.rmse ** 2 * t.n for t in trials if (t.rank, t.reg) == p) for p in grid}
    assert (best.rank, best.reg) == min(error, key=error.get) and best.n > 0
    assert run.model.rank == best.rank


def test_fold_rows_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 1, 1, 2, 3, 4, 5]), rnd.randint(1, 6), f"k{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, rkey string")
    fold = {r.rkey: r.f for r in df.select("rkey", tuning.fold_of(F.col("rkey"), 4).alias("f")).collect()}
    want = set()
    for k in set(fold.values()):
        held, rest = [r for r in rows if fold[r[2]] == k], [r for r in rows if fold[r[2]] != k]
        users, items = {r[0] for r in rest}, {r[1] for r in rest}
        want.add((k, len(rest), len(held), sum(r[0] in users and r[1] in items for r in held)))
    assert {tuple(r) for r in tuning.fold_rows(df, 4).collect()} == want
    assert tuning.fold_rows(df.limit(0)).count() == 0


# ----------------------------------------------------------- classifier

def test_classifier_beats_the_larger_class(spark, sf_small):
    rows = {(r.behaviour, r.predicted): r.n for r in q.q57_behaviour_confusion(spark, sf_small).collect()}
    total, right = sum(rows.values()), sum(n for (a, b), n in rows.items() if a == b)
    larger = max(sum(n for (a, _), n in rows.items() if a == c) for c in ("purchase", "play"))
    assert right > larger and right > .9 * total


def test_sequence_features_of_null_and_first_rows(spark):
    rows = [(1, 5, "purchase", 1.0, "2024-01-01 00:00:00", 1), (1, 5, "play", None, "2024-01-01 01:30:00", 2),
            (1, 6, "play", 2.5, None, 3), (None, 5, "play", 3.0, "2024-01-02 00:00:00", 4)]
    log = spark.createDataFrame(rows, "user_id bigint, item bigint, behaviour string, hours double, "
                                      "ts string, event_id bigint")
    log = log.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("rkey", F.lit("k"))
    got = {r.event_id: tuple(r[c] for c in classify.FEATURES)
           for r in classify.sequence_features(log).collect()}
    # The row without a time is the user's first.
    assert got == {3: (2.5, -1, -1, -1, -1), 1: (1, 0, -1, 2.5, -1), 2: (-1, 1, 0, 1, 1.5),
                   4: (3, -1, -1, -1, -1)}
    assert classify.sequence_features(log.limit(0)).count() == 0


# ------------------------------------------------------------ bootstrap

def test_bootstrap_equals_brute_force(spark):
    import hashlib
    rng = np.random.default_rng(5)
    rows = [(f"r{i}", float(a), float(b)) for i, (a, b) in enumerate(
        zip(rng.normal(0, 1, 80), rng.normal(0, 1.6, 80), strict=True))]
    df = spark.createDataFrame(rows, "rkey string, a double, b double")
    got = ev.compare_rmse(df, "a", "b", replicates=40).first()
    limits = ev.poisson_limits()

    def rmse(weights, column):
        return math.sqrt(sum(w * r[column] ** 2 for w, r in zip(weights, rows, strict=True)) / sum(weights))

    diffs = []
    for k in range(1, 41):
        bits = [int(hashlib.md5(f"{r[0]}|{k}".encode()).hexdigest()[:8], 16) for r in rows]
        weights = [sum(b >= x for x in limits) for b in bits]
        diffs.append(rmse(weights, 1) - rmse(weights, 2))
    diffs.sort()
    ones = [1] * len(rows)
    want = (80, rmse(ones, 1), rmse(ones, 2), rmse(ones, 1) - rmse(ones, 2), diffs[0], diffs[-1])
    assert np.allclose(got[:6], want) and got["differ"] == (diffs[0] > 0 or diffs[-1] < 0)
    assert got["differ"] and abs(np.mean(diffs) - got["difference"]) < .2


def test_bootstrap_of_equal_models_and_empty(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("rkey"), F.col("id").alias("a"),
                                F.col("id").alias("b"))
    row = ev.compare_rmse(df, "a", "b", replicates=20).first()
    assert row["difference"] == row["low"] == row["high"] == 0 and not row["differ"]
    assert ev.compare_rmse(df.limit(0), "a", "b", replicates=20).count() == 0


def test_poisson_weights(spark):
    df = spark.range(20_000).select(ev.bootstrap_weight(F.col("id").cast("string"), F.lit(3)).alias("w"))
    row = df.agg(F.avg("w"), F.var_pop("w")).first()
    assert abs(row[0] - 1) < .03 and abs(row[1] - 1) < .06


# --------------------------------------------------------- stable codes

def test_codes_stay_when_titles_are_added(spark):
    def titles(*names):
        return spark.createDataFrame([(n,) for n in names], "title string")

    first = dense_index(titles("b", "d", "b", None), "title")
    second = extend_index(first, titles("a", "d", "e", None, "a"), "title")
    third = extend_index(second, titles("c"), "title")
    rows = lambda df: {r.title: r.code for r in df.collect()}
    assert rows(first) == {"b": 0, "d": 1}
    assert rows(second) == {"b": 0, "d": 1, "a": 2, "e": 3}
    assert rows(third) == {"b": 0, "d": 1, "a": 2, "e": 3, "c": 4}
    assert rows(extend_index(third, titles(), "title")) == rows(third)
    assert rows(extend_index(titles().withColumn("code", F.lit(1).cast("bigint")),
                             titles("x"), "title")) == {"x": 0}


# ------------------------------------------------------- rejected lines

def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    lines = ['1,"Game, One",purchase,1.0,0', "2,Two,play,3.5", "x3,Two,play,1.0,0", "4,Two,sold,1.0,0",
             "5,Two,play,much,0", "6,Two", "", "   ", "7,,play,2", "8,Two,play,", "x,,y,z", '9,"open,play,1']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rows, rejects = read_behaviour_lines(spark, str(tmp_path))
    assert sorted((r.user_id, r.item, r.behaviour, r.hours) for r in rows.collect()) == [
        (1, "Game, One", "purchase", 1.0), (2, "Two", "play", 3.5)]
    got = {r.value: r.reason for r in rejects.collect()}
    assert got["x3,Two,play,1.0,0"] == "user_id" and got["4,Two,sold,1.0,0"] == "behaviour"
    assert got["5,Two,play,much,0"] == "hours" and got["6,Two"] == "behaviour,hours"
    assert got[""] == got["   "] == "empty line" and got["7,,play,2"] == "item"
    assert got["8,Two,play,"] == "hours" and got["x,,y,z"] == "user_id,item,behaviour,hours"
    assert rows.count() + rejects.count() == len(lines)
    assert all(r._file.endswith("a.csv") and r._block == 0 for r in rejects.collect())
    assert csv_log(rows).select("user_id", "item").orderBy("user_id").collect() == [(1, 0), (2, 1)]


# ------------------------------------------------------------- medians

def test_grouped_quantile_and_fill(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice([None, 1.0, 2.0, 2.5, 7.0, 9.0]),
             rnd.random() < .7) for _ in range(3000)] + [(9, None, True), (8, 4.0, False)]
    df = spark.createDataFrame(rows, "g int, v double, known boolean")
    for p in (0.0, 0.5, 0.9, 1.0):
        values = defaultdict(list)
        for g, v, _ in rows:
            if v is not None:
                values[g].append(v)
        want = {g: sorted(v)[max(1, math.ceil(p * len(v))) - 1] for g, v in values.items()}
        got = pr.grouped_quantile(df, "g", "v", p, "m").collect()
        assert {r.g: r.m for r in got} == want and len(got) == len(want)
    filled = pr.fill_by_group(df, "g", "v", F.col("known"), "f")
    assert filled.columns == ["g", "v", "known", "f"] and filled.count() == len(rows)
    kept = defaultdict(list)
    for g, v, known in rows:
        if known and v is not None:
            kept[g].append(v)
    for r in filled.distinct().collect():
        if r.known and r.v is not None:
            assert r.f == r.v
        else:
            mine = sorted(kept[r.g])
            assert r.f == (mine[math.ceil(len(mine) / 2) - 1] if mine else None)
    assert pr.grouped_quantile(df.limit(0), "g", "v", .5, "m").count() == 0
