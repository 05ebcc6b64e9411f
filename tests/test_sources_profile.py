"""CSV reader, adapters, splits, dense codes, exact quantiles."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ludex.operators import profile as pr
from ludex.operators.indexing import dense_index
from ludex.operators.split import capped_per_key, train_test, with_split
from ludex.sources.adapters import basket_log, behaviour_log, csv_log
from ludex.sources.readers import read_behaviour_csv

CSV = (
    '1001,"Title One, Deluxe",purchase,1.0,0\n'
    'abc,Title Two,play,x,0\n'
    '1002,Title Three,play,0.5,0\n'
    '1003,Title Four,purchase,1.0\n'
)


def test_csv_reader(spark):
    d = tempfile.mkdtemp(prefix="ludex-csv-")
    p = os.path.join(d, "log.csv")
    with open(p, "w") as f:
        f.write(CSV)
    df = read_behaviour_csv(spark, p)
    assert df.columns == ["user_id", "item", "behaviour", "hours"]
    rows = df.collect()
    assert len(rows) == 4
    assert rows[0].item == "Title One, Deluxe" and rows[0].hours == 1.0
    assert rows[1].user_id is None and rows[1].hours is None
    assert rows[3].user_id == 1003 and rows[3].behaviour == "purchase"
    log = csv_log(read_behaviour_csv(spark, p, ordered=True))
    assert log.count() == 4 and "title" in log.columns


def test_adapters(spark, sf_small):
    log = behaviour_log(spark, sf_small)
    assert set(r[0] for r in log.select("behaviour").distinct().collect()) == {"purchase", "play"}
    assert log.filter((F.col("behaviour") == "purchase") & (F.col("hours") != 1.0)).count() == 0
    assert log.filter(F.col("item").isNull()).count() == 0
    b = basket_log(spark, sf_small)
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    assert b.count() == li


def test_split_is_a_partition(spark, sf_small):
    log = behaviour_log(spark, sf_small)
    tr, te = train_test(log)
    n, a, b = log.count(), tr.count(), te.count()
    assert a + b == n and 0.7 * n < a < 0.9 * n
    assert tr.join(te, "event_id").count() == 0
    s = with_split(log)
    assert s.filter(F.col("split") == "train").count() == a


def test_split_matches_duckdb_hash(spark):
    import duckdb
    from ludex.functions.columns import hash_bucket
    keys = ["1", "1|2", "abc", "987654321|7"]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string")
           .select(hash_bucket(F.col("k"))).collect()]
    want = [duckdb.sql(f"SELECT CAST('0x' || substr(md5('{k}'), 1, 8) AS BIGINT) % 100").fetchall()[0][0]
            for k in keys]
    assert got == want


def test_cap_per_item(spark, sf_small):
    from ludex.plans.queries import rated
    r = rated(spark, sf_small, "knn")
    c = capped_per_key(r, "item", 3)
    assert c.groupBy("item").count().agg(F.max("count")).first()[0] <= 3
    per_item = r.groupBy("item").agg(F.least(F.count(F.lit(1)), F.lit(3)).alias("m"))
    assert c.count() == per_item.agg(F.sum("m")).first()[0]


def test_dense_index(spark):
    vals = [5, 3, 3, 100, -2, 7, 7, 7, 42]
    df = spark.createDataFrame([(v,) for v in vals], "item bigint")
    got = {r.item: r.code for r in dense_index(df, "item").collect()}
    want = {v: i for i, v in enumerate(sorted(set(vals)))}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 9, 10, 101])
def test_exact_quantiles_match_percentile_disc(spark, n):
    df = spark.range(n).select(((F.col("id") * 7919) % 97).cast("double").alias("x"))
    got = pr.exact_quantiles(df, "x", {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    ref = df.selectExpr("percentile_disc(0.25) WITHIN GROUP (ORDER BY x) AS a",
                        "percentile_disc(0.5) WITHIN GROUP (ORDER BY x) AS b",
                        "percentile_disc(0.75) WITHIN GROUP (ORDER BY x) AS c").first()
    assert tuple(got) == tuple(ref)


def test_profile_shapes(spark, sf_small):
    from ludex.plans import queries as q
    assert q.q02_null_profile(spark, sf_small).count() == 6 + 5 + 4
    sp = q.q06_sparsity(spark, sf_small).collect()
    assert all(0 <= r.sparsity_pct <= 100 for r in sp)
    flags = q.q12_outlier_flags(spark, sf_small)
    assert flags.count() == q.q04_distinct_rows(spark, sf_small).count()


def test_outlier_flag_null_hours_is_no(spark):
    rows = [(1, 1, "play", float(h)) for h in (1, 2, 3, 4, 5, 6, 7, 8, 100)] + \
           [(2, 2, "play", None)]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, behaviour string, hours double")
    flags = {(r.user_id, r.hours): r.hours_outlier
             for r in pr.outlier_flags(df, "hours", ["user_id"]).collect()}
    assert flags[(2, None)] == "no"
    assert flags[(1, 100.0)] == "yes"
    assert sum(v == "yes" for v in flags.values()) == 1
    b = pr.quartile_bounds(df, "hours").first()
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)


def test_csv_log_rates_in_file_order(spark):
    """A CSV log has no time column: the lag follows the file order."""
    from ludex.operators import features as fe
    d = tempfile.mkdtemp(prefix="ludex-csv-")
    p = os.path.join(d, "log.csv")
    lines = ["1,A,purchase,1.0", "1,A,play,10.0", "1,B,purchase,1.0",
             "2,A,purchase,1.0", "2,A,play,4.0", "2,C,purchase,1.0", "2,D,purchase,1.0"]
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    log = csv_log(read_behaviour_csv(spark, p, ordered=True))
    got = {(r.user_id, r.title, r.behaviour): (r.prev, r.rating)
           for r in fe.rated_log(log, "als").collect()}
    # Golden table T1 of FIXTURES.md, keyed by (user, title, behaviour).
    assert got == {(1, "A", "play"): ("purchase", 4), (1, "B", "purchase"): ("play", 1),
                   (2, "A", "play"): ("purchase", 2), (2, "C", "purchase"): ("play", 1),
                   (2, "D", "purchase"): ("purchase", 1)}


def test_csv_order_over_files_null_titles_and_codes(spark):
    """Files of different sizes: lines keep their order whatever the splits;
    a NULL title stays NULL; codes are alphabetical."""
    d = tempfile.mkdtemp(prefix="ludex-csv-")
    rows = [("1,Zed,purchase,1.0\n",), ("1,Zed,play,2.0\n",), ("1,,play,3.0\n",)]
    pad = "".join(f"{9 + i},Game {i:05d},purchase,1.0\n" for i in range(3000))
    for name, text in (("a.csv", rows[0][0]), ("b.csv", pad + rows[1][0]), ("c.csv", rows[2][0])):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        log = csv_log(read_behaviour_csv(spark, d, ordered=True))
        mine = log.where("user_id = 1").orderBy("event_id").collect()
        assert [(r.title, r.behaviour) for r in mine] == [
            ("Zed", "purchase"), ("Zed", "play"), (None, "play")]
        assert mine[0].event_id == 0 and mine[1].event_id == 3001 and mine[2].event_id == 3002
        assert mine[0].item == 3000 and mine[2].item is None and log.count() == 3003
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_to_recommendations_with_titles(spark):
    """CSV -> rating -> neighbours -> unseen titles."""
    from ludex.operators import features as fe
    from ludex.operators import recommend as rc
    from ludex.operators import similarity as si
    from ludex.sources.adapters import titles
    d = tempfile.mkdtemp(prefix="ludex-csv-")
    lines = []
    for u in range(30):
        for k, t in enumerate(["Ash", "Birch", "Cedar", "Doum", "Elm"]):
            if (u + k) % 3:
                lines += [f"{u},{t},purchase,1.0", f"{u},{t},play,{(u * (k + 2)) % 9 + 1}.5"]
    with open(os.path.join(d, "log.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    log = csv_log(read_behaviour_csv(spark, d, ordered=True))
    train, _ = train_test(fe.rated_log(log, "knn"))
    scores = rc.neighbour_scores(train, si.top_k(si.co_rated_cosine(train)))
    named = rc.unseen_top_n(scores, log, 5).join(titles(log), "item").collect()
    owned = {tuple(x.split(",")[:2]) for x in lines}
    assert named and all((str(r.user_id), r.title) not in owned for r in named)


def test_codes_of_text(spark):
    df = spark.createDataFrame([("pear",), ("fig",), (None,), ("fig",), ("apple",)], "t string")
    assert {r.t: r.code for r in dense_index(df, "t").collect()} == {
        "apple": 0, "fig": 1, "pear": 2}


def test_job_wrapper_writes_parquet(spark, sf_small):
    """S4: a query result written by the job wrapper reads back whole."""
    from ludex.plans import queries as q
    from ludex.plans.run import run
    out = os.path.join(tempfile.mkdtemp(prefix="ludex-out-"), "recs")
    run(spark, "q45_recommend", sf_small, out)
    back = spark.read.parquet(out)
    want = q.q45_recommend(spark, sf_small)
    assert back.columns == want.columns
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
