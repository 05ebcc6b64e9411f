"""Feature operators: previous behaviour, weights, transition filters, item
means, the rating ladder, user-mean centring and ALS residuals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludex.functions.columns import (
    conversion_weight, in_train, rating_ladder, steady_mean, transition_keep,
)
from ludex.operators.ranged import PART, SEQ, range_parts
from ludex.session import stage_only, stage_table

# Rows of a user up to which its lag is a plain window.
WINDOW_ROWS = 1 << 20


def with_previous(log: DataFrame, value: str = "behaviour", out: str = "prev",
                  part: tuple[str, ...] = ("user_id",),
                  order: tuple[str, ...] = ("ts", "event_id"),
                  window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``lag(value)`` inside each user, ordered by time then event id: equal to
    ``lag(value) OVER (PARTITION BY user ORDER BY ts, event_id)``, NULL users
    and NULL times included (rows that are equal in user and order may follow
    each other either way, as in the window).

    Users of at most ``window_rows`` rows go through the window: one shuffle of
    the log. The rows of larger users, if there are any, go by range
    (``ranged_previous``), which spreads a user over partitions. Eager: the
    larger users (a count per user, map-side combined) are written."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    lag = F.lag(value).over(Window.partitionBy(*part).orderBy(*keys))
    heavy = stage_table(log.groupBy(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(part)])
                        .agg(F.count(F.lit(1)).alias("_hn")).where(F.col("_hn") > window_rows),
                        "heavy")
    if heavy.isEmpty():
        return log.select("*", lag.alias(out))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_h{i}"))
                                       for i, c in enumerate(part)))
    few = log.join(heavy, same, "left_anti").select("*", lag.alias(out))
    many = ranged_previous(log.join(heavy, same, "left_semi"), value, out, part, order)
    return few.unionByName(many)


def ranged_previous(log: DataFrame, value: str, out: str, part: tuple[str, ...],
                    order: tuple[str, ...]) -> DataFrame:
    """The lag of ``with_previous`` by range partitioning: rows are
    range-partitioned by (user, order), so a user of any size is spread over
    partitions, as are rows of one time. The lag runs inside a partition; the
    first row of a partition takes the last value of the one before (one row per
    partition). Eager: the partitioned log is written to the shared folder."""
    keys = [F.col(c).asc_nulls_first() for c in (*part, *order)]
    cut = range_parts(log, keys, "lag")
    inside = Window.partitionBy(PART).orderBy(SEQ)
    user = F.struct(*part)
    last = cut.groupBy(PART).agg(F.max_by(F.struct(user.alias("u"), F.col(value).alias("v")),
                                          SEQ).alias("_last"))
    # At most one row per partition.
    carry = F.broadcast(last.select(
        F.col(PART).alias("_at"), F.lag("_last").over(Window.orderBy(PART)).alias("_carry")))
    rows = (cut.withColumn("_before", F.lag(F.struct(user.alias("u"), F.col(value).alias("v")))
                           .over(inside))
            .join(carry, F.col(PART) == F.col("_at"), "left")
            .withColumn("_before", F.coalesce("_before", "_carry")))
    same = F.col("_before").isNotNull()
    for c in part:
        same &= F.col(f"_before.u.{c}").eqNullSafe(F.col(c))
    return rows.select(*log.columns, F.when(same, F.col("_before.v")).alias(out))


def lagged_log(log: DataFrame) -> DataFrame:
    """Log + ``prev`` (previous behaviour of the user) + ``weight`` (1 or 2)."""
    lg = with_previous(log)
    return lg.withColumn("weight", conversion_weight(F.col("prev"), F.col("behaviour")))


def transitions(lagged: DataFrame, profile: str, keep_first: bool = False) -> DataFrame:
    """Rows whose (prev, behaviour) transition the profile keeps."""
    return lagged.filter(transition_keep(F.col("prev"), F.col("behaviour"),
                                         profile, keep_first))


def with_train_flag(rows: DataFrame, key: str = "rkey") -> DataFrame:
    """Add ``is_train`` (md5 bucket of the row key < 80) once, before the
    rows are materialised, so later splits read a flag instead of hashing
    the key on every pass."""
    if key not in rows.columns:
        return rows
    return rows.withColumn("is_train", in_train(F.col(key)))


def item_means(rows: DataFrame, value: str = "hours", out: str = "mean_hours") -> DataFrame:
    """Mean of ``value`` per item (partial + final aggregate)."""
    return rows.groupBy("item").agg(steady_mean(F.col(value)).alias(out),
                                    F.count(F.lit(1)).alias("n_rows"))


def _rated(kept: DataFrame) -> DataFrame:
    # The means are written before they are joined back: AQE splits the rows of a
    # hot item only in a join whose sides are both read from tables or shuffles.
    means = stage_table(item_means(kept).drop("n_rows"), "means")
    return (kept.join(means, "item", "inner")
            .withColumn("rating", rating_ladder(F.col("hours"), F.col("mean_hours"),
                                                F.col("weight"))))


def rated_log(log: DataFrame, profile: str = "knn", keep_first: bool = False,
              materialize: bool = True) -> DataFrame:
    """Lag -> weight -> transition filter -> item mean hours -> 0..5 rating.

    Eager: the lagged rows are written, as the means and the join read them, and
    with ``materialize`` the rated rows, which every model reads several times;
    the tables on the way then go. The item means are written and joined back
    (one row per item): AQE broadcasts them when they are small and otherwise
    keeps a sort-merge join whose hot items it can split."""
    def build() -> DataFrame:
        kept = with_train_flag(transitions(lagged_log(log), profile, keep_first).drop("ts"))
        return _rated(stage_table(kept, "kept"))

    return stage_only(build, "rated") if materialize else build()


def rated_purchases(log: DataFrame, materialize: bool = True, train_keys: bool = True) -> DataFrame:
    """``rated_log(log, 'als', keep_first=True)`` for a log whose rows are
    all purchases (the basket adapter): every transition is then kept and
    every weight is 1, so the lag is skipped. Same ratings, no window. Without
    ``train_keys`` the rows of the train side have no ``rkey`` (NULL)."""
    def build() -> DataFrame:
        rows = with_train_flag(log.drop("ts").withColumn("weight", F.lit(1)))
        if not train_keys:
            rows = rows.withColumn("rkey", F.when(~F.col("is_train"), F.col("rkey")))
        return _rated(rows)

    return stage_only(build, "rated") if materialize else build()


def user_means(ratings: DataFrame, value: str = "rating", out: str = "user_mean") -> DataFrame:
    """One row per user, written (see ``_rated``)."""
    return stage_table(ratings.groupBy("user_id").agg(F.avg(value).alias(out)), "means")


def centred(ratings: DataFrame) -> DataFrame:
    """Ratings + ``user_mean`` + ``deviation = rating - user_mean``."""
    um = user_means(ratings)
    return (ratings.join(um, "user_id", "inner")
            .withColumn("deviation", F.col("rating") - F.col("user_mean")))


def train_means(train: DataFrame, item_col: str = "item"):
    """Per-user mean, per-item mean (both written, see ``_rated``) and the
    global mean (a scalar subquery column) of the train ratings."""
    um = user_means(train)
    im = stage_table(train.groupBy(item_col).agg(F.avg("rating").alias("item_mean")), "means")
    gm = train.select(F.avg("rating")).scalar()
    return um, im, gm


def residuals(train: DataFrame, item_col: str = "item", means=None) -> DataFrame:
    """``rating - (user_mean + item_mean - global_mean)`` over the train rows.

    The global mean is a scalar subquery, evaluated once; no cross join.
    """
    um, im, gm = means or train_means(train, item_col)
    out = (train.join(um, "user_id", "inner").join(im, item_col, "inner")
           .withColumn("global_mean", gm))
    return out.withColumn(
        "interaction",
        F.col("rating") - (F.col("user_mean") + F.col("item_mean") - F.col("global_mean")))
