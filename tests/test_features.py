"""Golden table T1 (FIXTURES.md): transitions, weights, item means, ladder."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ludex.operators import features as fe

T1 = [  # seq, user, item, behaviour, hours
    (1, 1, 1, "purchase", 1.0),
    (2, 1, 1, "play", 10.0),
    (3, 1, 2, "purchase", 1.0),
    (4, 2, 1, "purchase", 1.0),
    (5, 2, 1, "play", 4.0),
    (6, 2, 3, "purchase", 1.0),
    (7, 2, 4, "purchase", 1.0),
]


def t1_log(spark, same_day=True):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for seq, u, i, b, h in T1:
        # same_day=False spreads each user's rows over days so the lag has
        # to carry the previous behaviour across slices.
        ts = base + (dt.timedelta(minutes=seq) if same_day else dt.timedelta(days=seq))
        rows.append((u, i, b, h, ts, seq, f"{seq}|{u}"))
    return spark.createDataFrame(
        rows, "user_id bigint, item bigint, behaviour string, hours double, ts timestamp, "
              "event_id bigint, rkey string")


def result(df):
    return {r.event_id: (r.prev, r.weight, r.mean_hours, r.rating)
            for r in df.select("event_id", "prev", "weight", "mean_hours", "rating").collect()}


@pytest.mark.parametrize("same_day", [True, False])
def test_t1_als_profile(spark, same_day):
    got = result(fe.rated_log(t1_log(spark, same_day), "als"))
    assert got == {2: ("purchase", 2, 7.0, 4), 3: ("play", 1, 1.0, 1),
                   5: ("purchase", 2, 7.0, 2), 6: ("play", 1, 1.0, 1),
                   7: ("purchase", 1, 1.0, 1)}


@pytest.mark.parametrize("same_day", [True, False])
def test_t1_knn_profile(spark, same_day):
    got = result(fe.rated_log(t1_log(spark, same_day), "knn"))
    assert got == {2: ("purchase", 2, 7.0, 4), 5: ("purchase", 2, 7.0, 2),
                   7: ("purchase", 1, 1.0, 1)}


def test_keep_first_keeps_opening_purchases(spark):
    got = result(fe.rated_log(t1_log(spark), "als", keep_first=True))
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}
    assert got[1][0] is None and got[4][0] is None


def test_lag_equals_plain_window(spark, sf_small):
    from ludex.sources.adapters import behaviour_log
    same_as_window(behaviour_log(spark, sf_small))


def same_as_window(log):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = log.withColumn("p2", F.lag("behaviour").over(w))
    # All users by the window; the larger ones by range; all by range.
    for rows in (1 << 20, 700, 0):
        both = fe.with_previous(log, window_rows=rows).join(plain.select("event_id", "p2"),
                                                            "event_id")
        assert both.filter(~F.col("prev").eqNullSafe(F.col("p2"))).count() == 0
        assert both.count() == log.count()


def test_lag_with_null_users_null_times_and_one_time(spark):
    """A hot user whose 1000 rows share one time, NULL times and NULL users;
    the hot rows are spread over several partitions."""
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        user = (None, 1, 1, 2, 3)[i % 5]
        ts = None if i % 7 == 0 else base if user == 1 else base + dt.timedelta(hours=i % 50)
        rows.append((user, i, ("purchase", "play")[(i * 7919) % 3 % 2], ts))
    log = spark.createDataFrame(rows, "user_id bigint, event_id bigint, behaviour string, "
                                      "ts timestamp").repartition(5)
    same_as_window(log)
    from ludex.operators.ranged import PART, range_parts
    cut = range_parts(log.where("user_id = 1"), [F.col("user_id").asc(), F.col("ts").asc()])
    assert cut.select(PART).distinct().count() > 2


def test_tiny_and_huge_hours(spark):
    """Means are not cut to decimal places: hours equal to the mean rate 1,
    in DuckDB's plain average too."""
    import duckdb
    rows = [(u, 1, "purchase", 4e-7) for u in range(7)] + [(u, 2, "purchase", 2e12) for u in range(7)] \
        + [(u, 3, "purchase", h) for u, h in enumerate((0.1, 0.1, 0.1))]
    df = spark.createDataFrame([(*r, dt.datetime(2024, 1, 1), i, f"{i}")
                                for i, r in enumerate(rows)],
                               "user_id bigint, item bigint, behaviour string, hours double, "
                               "ts timestamp, event_id bigint, rkey string")
    got = {(r.item, r.rating) for r in fe.rated_log(df, "als", keep_first=True).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
    for item, hours in ((1, 4e-7), (2, 2e12)):
        mean = duckdb.sql(f"SELECT avg(h) FROM (SELECT CAST({hours} AS DOUBLE) h FROM range(7))")
        assert abs(mean.fetchall()[0][0] / hours - 1) < 1e-12


def test_null_hours_rate_zero(spark):
    rows = [(1, 1, "purchase", 1.0, dt.datetime(2024, 1, 1), 1, "a"),
            (1, 1, "purchase", None, dt.datetime(2024, 1, 2), 2, "b")]
    df = spark.createDataFrame(rows, "user_id bigint, item bigint, behaviour string, "
                                     "hours double, ts timestamp, event_id bigint, rkey string")
    got = result(fe.rated_log(df, "als"))
    assert got[2][3] == 0


def test_empty_input(spark):
    df = t1_log(spark).limit(0)
    assert fe.rated_log(df, "knn").count() == 0


def test_ratings_in_range(spark, sf_small):
    from ludex.plans.queries import rated
    r = rated(spark, sf_small, "knn")
    lo, hi = r.agg(F.min("rating"), F.max("rating")).first()
    assert 0 <= lo <= hi <= 5


def test_residuals_average_zero(spark, sf_small):
    from ludex.operators.split import train_test
    from ludex.plans.queries import rated_basket
    train, _ = train_test(rated_basket(spark, sf_small))
    m = fe.residuals(train).agg(F.avg("interaction")).first()[0]
    assert abs(m) < 0.5


def test_purchase_log_fast_path_equals_general_pipeline(spark, sf_small):
    from ludex.sources.adapters import basket_log
    b = basket_log(spark, sf_small)
    cols = ["rkey", "user_id", "item", "hours", "weight", "mean_hours", "rating"]
    fast = fe.rated_purchases(b).select(*cols)
    full = fe.rated_log(b, "als", keep_first=True, materialize=False).select(*cols)
    assert fast.count() == full.count() == b.count()
    near = lambda df: df.withColumn("mean_hours", F.round("mean_hours", 9))
    assert near(fast).exceptAll(near(full)).count() == 0
    assert near(full).exceptAll(near(fast)).count() == 0
