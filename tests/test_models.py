"""Model queries (no SQL oracle): rows, schema, finiteness, owned items,
and RMSE against the trivial global-mean predictor."""

import math

from pyspark.sql import functions as F

from ludex.operators import als as als_op
from ludex.operators import evaluate as ev
from ludex.plans import queries as q


def test_als_predictions_and_rmse(spark, sf_small):
    run = als_op.fit(q.rated_basket(spark, sf_small))
    p = als_op.predictions(run)
    assert p.count() > 0
    assert set(p.columns) >= {"user_id", "item", "rating", "prediction", "residual_prediction"}
    rmse = ev.rmse(p, "prediction", "rating").first().rmse
    assert math.isfinite(rmse)
    # On train rows the model must beat predicting the global mean.
    tr = run.model.transform(run.train)
    tr = tr.withColumn("p", F.col("prediction") + F.col("user_mean") + F.col("item_mean")
                       - F.col("global_mean"))
    fit_rmse = ev.rmse(tr, "p", "rating").first().rmse
    base = ev.rmse(tr.withColumn("g", F.col("global_mean")), "g", "rating").first().rmse
    assert fit_rmse < base


def test_als_named_topn_excludes_owned(spark, sf_small):
    top = q.q29_als_topn_named(spark, sf_small)
    owned = q.basket_log(spark, sf_small).select("user_id", "item")
    assert top.count() > 0
    assert top.join(owned, ["user_id", "item"]).count() == 0
    assert top.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5
    assert top.filter(F.col("p_name").isNull()).count() == 0


def test_als_topn_shape(spark, sf_small):
    t = q.q28_als_topn(spark, sf_small)
    assert t.columns == ["user_id", "item", "score", "rank"]
    assert t.groupBy("user_id").agg(F.max("rank").alias("m")).filter("m > 5").count() == 0


def test_als_on_the_log(spark, sf_small):
    (row,) = q.q47_als_rmse_log(spark, sf_small).collect()
    assert row.model == "als" and row.n > 0 and math.isfinite(row.rmse)


def test_scored_rows_are_those_als_scores(spark, sf_small):
    scored = q.q48_als_scored(spark, sf_small).select("user_id", "item", "rkey")
    als = q.q26_als_predict(spark, sf_small).select("user_id", "item", "rkey")
    assert scored.count() == als.count() > 0
    assert scored.exceptAll(als).count() == 0


def test_block_count():
    assert als_op.block_count(0, 8) == 8
    assert als_op.block_count(2_000_000_000, 8) == 200
    assert als_op.block_count(10**12, 400) < 46_340


def test_blocks_are_no_more_than_the_ratings_need():
    assert als_op.block_count(40_000_000, 12) == 12
    assert als_op.block_count(216_000_000, 12) == 21


def test_dense_encoding_is_a_bijection(spark, sf_small):
    base = q.rated_basket(spark, sf_small)
    coded, n = als_op.encode(base), base.count()
    assert coded.count() == n
    users = coded.select("user_id", "ucode").distinct()
    items = coded.select("item", "icode").distinct()
    nu = coded.select("user_id").distinct().count()
    ni = coded.select("item").distinct().count()
    assert users.count() == nu and users.select("ucode").distinct().count() == nu
    assert items.count() == ni and items.select("icode").distinct().count() == ni
    assert items.agg(F.min("icode"), F.max("icode")).first() == (0, ni - 1)


def test_als_topn_matches_brute_force(spark, sf_small):
    """q28's path (bounded search, explode, id mapping) against a brute-force
    scoring of every (user, item) from the model's factors."""
    import numpy as np
    run = als_op.fit(q.rated_basket(spark, sf_small))
    got = {}
    for r in als_op.recommend_all(run, 5).collect():
        got.setdefault(r.user_id, {})[r.rank] = r.item
    uf = {r.id: np.array(r.features, dtype=np.float64) for r in run.model.userFactors.collect()}
    itf = {r.id: np.array(r.features, dtype=np.float64) for r in run.model.itemFactors.collect()}
    ucode = {r.ucode: r.user_id for r in run.users.collect()}
    icode = {r.icode: r.item for r in run.items.collect()}
    items = sorted(itf)
    mat = np.stack([itf[i] for i in items])
    checked = 0
    for u, vec in uf.items():
        scores = mat @ vec
        best = [icode[items[j]] for j in np.argsort(-np.round(scores, 9), kind="stable")[:5]]
        assert [got[ucode[u]][k] for k in range(1, 6)] == best
        checked += 1
    assert checked == len(got) > 0


def test_als_unseen_topn_matches_brute_force(spark, sf_small):
    """Unseen top-n against brute force: add the item mean to the score of every
    item, drop owned ones, keep 5."""
    import numpy as np
    rb = q.rated_basket(spark, sf_small)
    run = als_op.fit(rb)
    owned_df = rb.select("user_id", "item")
    top = als_op.recommend_unseen(run, owned_df, 5)
    got = {}
    for r in top.collect():
        got.setdefault(r.user_id, {})[r.rank] = r.item
    owned = {}
    for r in owned_df.distinct().collect():
        owned.setdefault(r.user_id, set()).add(r.item)
    uf = {r.id: np.array(r.features, dtype=np.float64) for r in run.model.userFactors.collect()}
    itf = {r.id: np.array(r.features, dtype=np.float64) for r in run.model.itemFactors.collect()}
    ucode = {r.ucode: r.user_id for r in run.users.collect()}
    icode = {r.icode: r.item for r in run.items.collect()}
    means = {r.icode: r.item_mean for r in run.item_means.collect()}
    items = sorted(itf)
    mat = np.stack([itf[i] for i in items])
    mean = np.array([means[i] for i in items])
    for u, vec in uf.items():
        user = ucode[u]
        score = mat @ vec + mean
        unseen = [j for j in range(len(items)) if icode[items[j]] not in owned[user]]
        best = sorted((score[j] for j in unseen), reverse=True)[:5]
        at = {icode[items[j]]: score[j] for j in unseen}
        # Factors are 32-bit floats: scores decide, not the order of ties.
        mine = [at[got[user][k]] for k in range(1, len(best) + 1)]
        assert np.allclose(mine, best, atol=1e-5)


def test_fit_leaves_its_tables_behind(spark, sf_small):
    """The factors are read back and the fit's own rows are gone: only what is read
    later stays; train rows carry no key where nothing asks for it."""
    import glob
    from ludex.session import ensure_checkpoint_dir

    def held():
        return {p.rsplit("/", 1)[1].rsplit("-", 1)[0] + p[-32:]
                for p in glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables/*")}

    before = held()
    run = als_op.fit(q.rated_basket(spark, sf_small, materialize=False, train_keys=False))
    kinds = {p[:-32] for p in held() - before}
    assert "coded" in kinds and not kinds & {"ratings", "half", "fit"}
    assert run.train.where("rkey is not null").isEmpty()
    assert run.test.where("rkey is null").isEmpty()
    assert "FileScan parquet" in run.model.userFactors._jdf.queryExecution().toString()
