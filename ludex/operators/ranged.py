"""Positions in an order, by range partitioning: no global or per-group window
ever holds more than one partition, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludex.session import shuffle_partitions, stage_table

PART, SALT, SEQ = "_rg_part", "_rg_salt", "_rg_seq"


def range_parts(df: DataFrame, order: list[Column], label: str = "ranged") -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with ``PART`` (the
    partition, in order) and ``SEQ`` (the row's rank inside it). Rows that are
    equal in ``order`` may lie in neighbouring partitions, in an order given by
    a hash of all their columns, so the rows of a value that holds a large share
    are spread as well, and a task that runs again deals them the same way."""
    salted = df.withColumn(SALT, F.xxhash64(*df.columns))
    keys = [*order, F.col(SALT).asc()]
    cut = (salted.repartitionByRange(shuffle_partitions(df.sparkSession), *keys)
           .sortWithinPartitions(*keys)
           .withColumn(SEQ, F.monotonically_increasing_id())
           .withColumn(PART, F.shiftright(SEQ, 33).cast("int"))
           .withColumn(SEQ, F.col(SEQ).bitwiseAND(F.lit((1 << 33) - 1))).drop(SALT))
    return stage_table(cut, label)


def part_offsets(parts: DataFrame, value: Column, name: str = "_rg_offset") -> DataFrame:
    """One row per partition of ``range_parts``: PART and the sum of ``value``
    over all earlier partitions (as many rows as there are partitions)."""
    totals = parts.groupBy(PART).agg(F.sum(value).alias("_rg_sum"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(PART, F.coalesce(F.sum("_rg_sum").over(earlier), F.lit(0)).alias(name))
