"""Positions of rows inside their groups, by range partitioning: a group of any
size is spread over partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludex.operators.ranged import PART, SEQ, range_parts


def group_positions(df: DataFrame, group: list[str], order: list[Column], name: str,
                    label: str = "ranged") -> DataFrame:
    """``df`` with the 0-based position of each row among the rows of its
    group (``group`` columns, NULLs are a group) in ``order``, as ``name``.

    Rows are cut by (group, order); inside a partition the position follows
    from the row's rank and the group's first rank there, and a table of one
    row per (partition, group) gives what earlier partitions hold."""
    parts = range_parts(df, [*[F.col(g).asc_nulls_first() for g in group], *order], label)
    runs = parts.groupBy(PART, *group).agg(F.min(SEQ).alias("_rg_first"),
                                           F.count(F.lit(1)).alias("_rg_n"))
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.withColumn("_rg_before", F.coalesce(F.sum("_rg_n").over(earlier), F.lit(0)))
    runs = runs.select(F.col(PART).alias("_rg_p"), "_rg_first", "_rg_before",
                       *[F.col(g).alias(f"_rg_g{i}") for i, g in enumerate(group)])
    match = F.col(PART) == F.col("_rg_p")
    for i, g in enumerate(group):
        match &= F.col(g).eqNullSafe(F.col(f"_rg_g{i}"))
    joined = parts.join(runs, match)
    return joined.select(*df.columns, (F.col(SEQ) - F.col("_rg_first") + F.col("_rg_before"))
                         .alias(name))
