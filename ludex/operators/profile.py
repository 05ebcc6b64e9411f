"""Profiling operators: nulls, duplicates, cardinality, sparsity, popularity,
describe, quartile bounds and outliers, correlation, rating skew.

Every operator is one or two aggregate passes; global figures are one-row
aggregates, joined to rows through scalar subqueries, never collected.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludex.functions.columns import rnd
from ludex.operators.ranged import PART, SEQ, part_offsets, range_parts
from ludex.session import stage_table

# Fixed value: the whisker / outlier multiple of the interquartile range.
IQR_FACTOR = 1.5

def null_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, n_missing): NULL, plus NaN on float columns.

    One aggregate pass over the table, then unpivoted to one row per column.
    """
    aggs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cond = c.isNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cond = cond | F.isnan(c)
        aggs.append(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f.name))
    wide = df.agg(*aggs)
    return (wide.unpivot([], [f.name for f in df.schema.fields], "column_name", "n_missing")
            .select(F.lit(table).alias("table_name"), "column_name", "n_missing"))


def duplicate_groups(df: DataFrame, cols: list[str]) -> DataFrame:
    """Groups of equal ``cols`` that occur more than once, with their count."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > F.lit(1)))


def cardinalities(log: DataFrame, cols: tuple[str, ...] = ("user_id", "item", "hours")) -> DataFrame:
    """Row count, distinct-row count and distinct values per column, one pass.

    ``distinct().count()`` counts NULL as a value and ``count(DISTINCT)`` does
    not, so the NULL indicator of each column is added.
    """
    rows = log.select("user_id", "item", "behaviour", "hours")
    n_distinct_rows = rows.distinct().select(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append((F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("bigint")
                    .alias(f"n_{c}"))
    return rows.agg(*aggs).withColumn("n_distinct_rows", n_distinct_rows)


def sparsity(log: DataFrame, dataset: str) -> DataFrame:
    """(1 - rows / (users * items)) * 100 on the distinct rows."""
    d = log.select("user_id", "item", "behaviour", "hours").distinct()
    agg = d.agg(F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("user_id").alias("n_users"),
                F.count_distinct("item").alias("n_items"))
    pct = (F.lit(1.0) - F.col("n_rows") / (F.col("n_users") * F.col("n_items"))) * F.lit(100.0)
    return agg.select(F.lit(dataset).alias("dataset"), "n_rows", "n_users", "n_items",
                      rnd(pct).alias("sparsity_pct"))


def top_items(rows: DataFrame, n: int = 10) -> DataFrame:
    """Items by number of rows with hours (desc), with their total hours."""
    g = rows.groupBy("item").agg(F.count("hours").alias("n_rows"),
                                 F.sum("hours").alias("total_hours"))
    return (g.orderBy(F.desc("n_rows"), F.asc("item")).limit(n)
             .select("item", "n_rows", rnd(F.col("total_hours")).alias("total_hours")))


def top_by_behaviour(rows: DataFrame, behaviour: str, n: int = 10) -> DataFrame:
    """Most frequent items among rows of one behaviour."""
    g = (rows.filter(F.col("behaviour") == F.lit(behaviour))
             .groupBy("item", "behaviour").agg(F.count(F.lit(1)).alias("n")))
    return g.orderBy(F.desc("n"), F.asc("item")).limit(n)


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, stddev (sample), min, max of one column, long form."""
    c = F.col(col)
    wide = df.agg(F.count(c).cast("double").alias("count"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("stddev"), F.min(c).cast("double").alias("min"),
                  F.max(c).cast("double").alias("max"))
    long = wide.unpivot([], ["count", "mean", "stddev", "min", "max"], "statistic", "value")
    return long.select("statistic", rnd(F.col("value")).alias("value"))


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float]) -> DataFrame:
    """Exact discrete quantiles (``percentile_disc``) of ``col``; one row with
    a column per entry of ``probs`` (NULL without values).

    The built-in exact percentile merges a map of every distinct value in one
    final task. Here the distinct values with their counts are
    range-partitioned; the running count inside a partition is a window per
    partition, and a table of one row per partition gives what earlier ones
    hold. The value of rank ``max(1, ceil(p * n))`` is picked in one
    aggregate. Eager: the partitioned values are written."""
    c = F.col(col)
    values = df.where(c.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    parts = range_parts(values, [c.asc()], "quantiles")
    # At most one row per partition.
    before = part_offsets(parts, F.col("_c"), "_off")
    total = parts.agg(F.sum("_c")).scalar()
    inside = Window.partitionBy(PART).orderBy(SEQ).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run = (parts.withColumn("_run", F.sum("_c").over(inside)).join(F.broadcast(before), PART)
           .select(c, "_c", (F.col("_off") + F.col("_run")).alias("_cum"))
           .withColumn("_n", total))
    aggs = []
    for name, p in probs.items():
        k = F.greatest(F.lit(1).cast("double"), F.ceil(F.lit(float(p)) * F.col("_n")).cast("double"))
        hit = (F.col("_cum") >= k) & ((F.col("_cum") - F.col("_c")) < k)
        aggs.append(F.min(F.when(hit, c)).alias(name))
    return run.agg(*aggs)


def grouped_quantile(df: DataFrame, group: str, col: str, p: float, out: str) -> DataFrame:
    """Exact discrete quantile of ``col`` per ``group`` (NULL is a group): the
    value of rank ``max(1, ceil(p * n))``. Groups without a value have no row.

    Distinct values with their counts are range-partitioned by (group, value),
    so a group of any size is spread over partitions; a table of one row per
    (partition, group) carries the counts of earlier partitions. Eager."""
    values = (df.where(F.col(col).isNotNull()).groupBy(F.col(group).alias("_g"), F.col(col).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    parts = range_parts(values, [F.col("_g").asc_nulls_first(), F.col("_v").asc()], "quantiles")
    runs = parts.groupBy(F.col(PART).alias("_p"), F.col("_g").alias("_h")).agg(F.sum("_c").alias("_s"))
    mine = Window.partitionBy("_h")
    earlier = mine.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage_table(runs.select("_p", "_h", F.sum("_s").over(mine).alias("_n"),
                                   F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off")),
                       "runs")
    inside = Window.partitionBy(PART, "_g").orderBy(SEQ).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = (parts.withColumn("_run", F.sum("_c").over(inside))
            .join(runs, (F.col(PART) == F.col("_p")) & F.col("_g").eqNullSafe(F.col("_h"))))
    rank = F.greatest(F.lit(1.0), F.ceil(F.lit(float(p)) * F.col("_n")).cast("double"))
    upto = F.col("_off") + F.col("_run")
    return rows.where((upto >= rank) & (upto - F.col("_c") < rank)).select(
        F.col("_g").alias(group), F.col("_v").alias(out))


def fill_by_group(df: DataFrame, group: str, col: str, known: Column, out: str,
                  p: float = 0.5) -> DataFrame:
    """``df`` with ``out``: ``col`` where ``known`` holds, else the median
    (quantile ``p``) of the known values of the row's group, NULL if it has
    none. Eager: the medians (one row per group) are written."""
    held = df.where(known).select(F.col(group), F.col(col))
    middle = stage_table(grouped_quantile(held, group, col, p, "_middle"), "medians")
    middle = middle.withColumnRenamed(group, "_of")
    return (df.join(middle, F.col(group).eqNullSafe(F.col("_of")), "left")
            .withColumn(out, F.when(known & F.col(col).isNotNull(), F.col(col))
                        .otherwise(F.col("_middle"))).drop("_of", "_middle"))


def quartile_bounds(df: DataFrame, col: str) -> DataFrame:
    """Exact quartiles (values of the data, no interpolation) and the
    Tukey fences ``q1 - 1.5 iqr`` / ``q3 + 1.5 iqr``; one row."""
    q = exact_quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select("q1", "median", "q3", iqr.alias("iqr"),
                    (F.col("q1") - iqr * F.lit(IQR_FACTOR)).alias("lower"),
                    (F.col("q3") + iqr * F.lit(IQR_FACTOR)).alias("upper"))


def outlier_flags(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """Every row, with ``{col}_outlier`` = 'yes' outside the fences else 'no'.

    The fences are one scalar subquery. NULL values compare to NULL and fall
    to 'no'."""
    b = quartile_bounds(df, col).select(F.struct("lower", "upper")).scalar()
    rows = df.select(*keep, col).withColumn("_b", b)
    flag = F.when(~F.col(col).between(F.col("_b.lower"), F.col("_b.upper")), F.lit("yes")) \
        .otherwise(F.lit("no"))
    return rows.select(*keep, col, flag.alias(f"{col}_outlier"))


def box_summary(df: DataFrame, col: str) -> DataFrame:
    """Figures of a box plot: quartiles, whiskers (most extreme values
    inside the fences), outlier count and row count; one row."""
    c = F.col(col)
    b = quartile_bounds(df, col).select(F.struct("*")).scalar()
    rows = df.select(col).withColumn("_b", b)
    inside = c.between(F.col("_b.lower"), F.col("_b.upper"))
    return rows.agg(
        *[F.max(f"_b.{q}").alias(q) for q in ("q1", "median", "q3")],
        F.min(F.when(inside, c)).alias("whisker_low"),
        F.max(F.when(inside, c)).alias("whisker_high"),
        F.sum(F.when(c.isNotNull() & ~inside, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("n_outliers"),
        F.count(c).alias("n"))


def low_hours(df: DataFrame, col: str = "hours", below: float = 1.0) -> DataFrame:
    """Rows with ``col < below`` and all rows; kept in the data, only counted."""
    return df.agg(
        F.sum(F.when(F.col(col) < F.lit(below), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("n_low"),
        F.count(F.lit(1)).alias("n_rows"))


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for each pair of numeric columns, one aggregate pass,
    long form (a, b, r)."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                    for a, b in pairs])
    long = wide.unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", "__").getItem(0).alias("a"),
                       F.split("pair", "__").getItem(1).alias("b"),
                       rnd(F.col("r")).alias("r"))


def rating_skew(ratings: DataFrame) -> DataFrame:
    """Ratings per user and per item, sorted by count (desc) then key.

    Two grouped counts; the order is a distributed range sort, not a rank
    window (a window ordered over all users would be one task).
    """
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ratings")) \
        .select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), "n_ratings")
    per_item = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n_ratings")) \
        .select(F.lit("item").alias("kind"), F.col("item").alias("key"), "n_ratings")
    return (per_user.unionByName(per_item)
            .orderBy(F.asc("kind"), F.desc("n_ratings"), F.asc("key")))
