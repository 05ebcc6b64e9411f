"""Error measures. RMSE is one aggregate; no evaluator round trip needed."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludex.functions.columns import safe_div
from ludex.session import stage_table

# Bootstrap replicates, and the share of them outside the interval.
REPLICATES = 200
OUTSIDE = 0.05


def rmse(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """sqrt(mean((prediction - label)^2)) and the row count; one row."""
    d = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def side_sums(df: DataFrame, key: str, value: str, times: F.Column | None = None) -> DataFrame:
    """Per key: number of rows, sum and sum of squares of ``value``, each row
    counted ``times`` times (a column that is constant per key)."""
    v = F.col(value).cast("double")
    t = F.lit(1) if times is None else times
    return df.groupBy(key).agg(F.sum(t).alias("n"), F.sum(v * t).alias("s"),
                               F.sum(v * v * t).alias("q"))


def rmse_of_sums(pred: DataFrame, label: DataFrame, key: str) -> DataFrame:
    """RMSE over every (prediction, label) pair that shares ``key``, from the
    ``side_sums`` of both sides, without making the pairs:
    sum (p - t)^2 = n_t * Sp2 - 2 * Sp * St + n_p * St2 per key.
    One row: rmse, n (the number of pairs)."""
    p = pred.select(key, *[F.col(c).alias(f"p{c}") for c in "nsq"])
    j = p.join(label, key, "inner")
    sq = (F.col("n") * F.col("pq") - F.lit(2.0) * F.col("ps") * F.col("s")
          + F.col("pn") * F.col("q"))
    agg = j.agg(F.sum(sq).alias("_sq"), F.sum(F.col("pn") * F.col("n")).alias("n"))
    return agg.select(F.sqrt(F.greatest(safe_div(F.col("_sq"), F.col("n").cast("double")),
                                        F.lit(0.0))).alias("rmse"),
                      F.col("n").cast("bigint").alias("n"))


def rmse_all_pairs(pred: DataFrame, label: DataFrame, key: str,
                   prediction: str, target: str) -> DataFrame:
    """``rmse_of_sums`` of two tables of rows."""
    return rmse_of_sums(side_sums(pred, key, prediction), side_sums(label, key, target), key)


def poisson_limits(bits: int = 32, most: int = 12) -> list[int]:
    """Upper limits of a ``bits``-bit number for the values 0, 1, ... of a
    Poisson(1) variable: the number is below as many of them as it gives less."""
    cdf = accumulate(math.exp(-1) / math.factorial(k) for k in range(most))
    return [round(p * 2 ** bits) for p in cdf]


def bootstrap_weight(key: Column, replicate: Column) -> Column:
    """How often a row is drawn in a replicate: Poisson(1) from 32 bits of
    md5(key | replicate), so no draw depends on the layout of the rows."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", key, replicate.cast("string"))), 1, 8),
                  16, 10).cast("bigint")
    return sum((F.when(bits >= limit, 1).otherwise(0) for limit in poisson_limits()), F.lit(0))


def compare_rmse(errors: DataFrame, first: str, second: str, key: str = "rkey",
                 replicates: int = REPLICATES, outside: float = OUTSIDE) -> DataFrame:
    """``errors`` (key and the errors of two models on the same rows) -> one row:
    n, the RMSE of both, their difference (first - second), the interval
    [low, high] that holds 1 - ``outside`` of the bootstrap replicates of it, and
    ``differ``: whether that interval leaves out 0.

    Every row is weighted in every replicate and summed per replicate in the
    task that reads it: what is shuffled are ``replicates`` rows per task. A
    replicate without any weight (tiny tables) counts as no difference. Eager:
    the sums are written."""
    e1, e2 = F.col(first).cast("double"), F.col(second).cast("double")
    rows = errors.select(F.col(key).alias("_k"), (e1 * e1).alias("_a"), (e2 * e2).alias("_b"))
    # Replicate 0 is the sample itself.
    drawn = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("r"))
    weight = F.when(F.col("r") == 0, F.lit(1)).otherwise(bootstrap_weight(F.col("_k"), F.col("r")))
    sums = stage_table(drawn.withColumn("_w", weight).groupBy("r").agg(
        F.sum("_w").alias("n"), F.sum(F.col("_a") * F.col("_w")).alias("a"),
        F.sum(F.col("_b") * F.col("_w")).alias("b")), "replicates")
    root = [F.sqrt(safe_div(F.col(c), F.col("n").cast("double"))) for c in "ab"]
    parts = sums.select("r", "n", root[0].alias("x"), root[1].alias("y"),
                        F.coalesce(root[0] - root[1], F.lit(0.0)).alias("d"))
    # ``replicates`` rows.
    place = F.row_number().over(Window.orderBy("d"))
    low = max(1, math.ceil(replicates * outside / 2))
    ends = parts.where("r > 0").withColumn("p", place).agg(
        F.max(F.when(F.col("p") == low, F.col("d"))).alias("low"),
        F.max(F.when(F.col("p") == replicates + 1 - low, F.col("d"))).alias("high"))
    return (parts.where("r = 0").withColumn("low", ends.select("low").scalar())
            .withColumn("high", ends.select("high").scalar())
            .select("n", F.col("x").alias(f"rmse_{first}"), F.col("y").alias(f"rmse_{second}"),
                    F.col("d").alias("difference"), "low", "high",
                    ((F.col("low") > 0) | (F.col("high") < 0)).alias("differ")))
