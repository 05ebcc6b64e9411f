"""Plan shape checks: the operators stay JVM-side, the top-k is limited
before the shuffle, filters reach the scan, and no big window runs in a
single partition."""

import pytest

from ludex.plans import queries as q
from ludex.sources.adapters import behaviour_log


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df):
    """Every physical node, descending into AQE and subquery wrappers."""
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        n = stack.pop()
        out.append(n)
        for seq in (n.children(), n.innerChildren()):
            for i in range(seq.size()):
                stack.append(seq.apply(i))
        try:
            subs = n.subqueries()
            for i in range(subs.size()):
                stack.append(subs.apply(i))
        except Exception:
            pass
    return out


@pytest.mark.parametrize("name", ["q15_prev_behaviour", "q33_item_history", "q35_cosine_pairs",
                                  "q36_cosine_topk", "q40_damped_pearson", "q43_pearson_rmse",
                                  "q45_recommend"])
def test_no_python_and_no_unpartitioned_window(spark, sf_small, name):
    df = q.QUERIES[name](spark, sf_small)
    p = plan(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    windows = [n for n in nodes(df) if n.nodeName() == "Window"]
    # The only windows over all rows run on one row per partition.
    assert all(w.partitionSpec().size() > 0 or "_rg_part" in w.orderSpec().toString()
               for w in windows)


@pytest.mark.parametrize("name", ["q36_cosine_topk", "q41_pearson_topk", "q45_recommend"])
def test_topk_uses_window_group_limit(spark, sf_small, name):
    assert "WindowGroupLimit" in plan(q.QUERIES[name](spark, sf_small))


def test_scan_pushdown_and_pruning(spark, sf_small):
    p = plan(behaviour_log(spark, sf_small).select("user_id", "item"))
    assert "PushedFilters: [In(event_type, [purchase,view])" in p
    # Only the columns the projection needs are read.
    read = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "value" not in read and "ts" not in read


def test_lag_is_one_shuffle(spark, sf_small):
    """Without users larger than a window, the log is shuffled once; the rows of
    larger users come from a range-partitioned table."""
    from ludex.operators.features import with_previous
    log = behaviour_log(spark, sf_small)
    p = plan(with_previous(log))
    assert p.count("Exchange hashpartitioning(user_id") == 1 and "rangepartitioning" not in p
    heavy = plan(with_previous(log, window_rows=0))
    assert "_rg_part" in heavy


@pytest.fixture
def skewed(spark):
    """Settings under which a join key with many rows is split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split(spark, skewed):
    """A hot item and a hot user: the joins of rows with per-item and per-user
    tables are split by AQE."""
    from pyspark.sql import functions as F

    from ludex.operators import features as fe
    rows = spark.range(60_000, numPartitions=12).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("user_id"),
        F.when(F.col("id") % 2 > 0, F.lit(5)).otherwise(F.col("id")).alias("item"),
        (F.col("id") % 11).cast("double").alias("hours"), (F.col("id") % 6).alias("rating"),
        F.lit(1).alias("weight"), F.md5(F.col("id").cast("string")).alias("rkey"))
    assert "skew=true" in executed(fe._rated(rows))
    assert "skew=true" in executed(fe.centred(rows))
    assert executed(fe.residuals(rows)).count("skew=true") >= 2


def test_tables_on_the_way_are_deleted(spark):
    import os

    from pyspark.sql import functions as F

    from ludex import session as se
    root = se.ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"

    def build():
        first = se.stage_table(spark.range(10), "first")
        second = se.stage_only(lambda: se.stage_table(first, "inner").where("id > 2"), "second")
        return second.select((F.col("id") * 2).alias("id"))

    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = se.stage_only(build, "out")
    (left,) = set(os.listdir(root)) - before
    assert left.startswith("out-") and out.count() == 7


@pytest.mark.parametrize("name", ["q37_knn_scores", "q38_cosine_rmse", "q40_damped_pearson",
                                  "q42_pearson_items", "q43_pearson_rmse", "q45_recommend"])
def test_no_join_shares_a_stage_with_a_final_aggregate(spark, sf_small, name):
    """Without broadcasts: rows joined by item or user are not aggregated by
    that key in the same stage, where a hot key could not be split."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q.QUERIES[name](spark, sf_small)
        for node in nodes(df):
            if node.nodeName() != "HashAggregate":
                continue
            below, rows = node.child(), "functions=[partial" in node.toString().split("\n")[0]
            while below.nodeName() in ("Project", "Filter", "HashAggregate", "WholeStageCodegen",
                                       "InputAdapter", "Sort", "Generate"):
                below = below.child()
            if below.nodeName() == "SortMergeJoin" and not rows:
                keys = [below.leftKeys().apply(i).toString() for i in range(below.leftKeys().size())]
                groups = node.groupingExpressions().toString()
                assert not all(k.split("#")[0] in groups for k in keys), (keys, groups)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_user_pairs_are_bounded(spark):
    """One user with 10 000 items: no key of the pair join holds more than
    slice * slice pairs."""
    from pyspark.sql import functions as F

    from ludex.operators import similarity as si
    c = spark.range(10_000).select(F.lit(1).alias("user_id"), F.col("id").alias("item"),
                                   F.lit(1).alias("n"), F.lit(1.0).alias("s"), F.lit(1.0).alias("q"))
    j = si.salted_self_join(c, [F.col("item").alias("i1")], [F.col("item").alias("i2")],
                            slice_items=500)
    most, total = j.groupBy("user_id", "_a", "_b").count().agg(F.max("count"), F.sum("count")).first()
    assert most <= 500 * 500 and total == 10_000 * 10_000


def test_pair_join_is_cut(spark, sf_small):
    p = plan(q.q35_cosine_pairs(spark, sf_small))
    assert "hashpartitioning(user_id" in p and "_a#" in p and "_b#" in p
