"""Dense 0-based codes in sort order, computed without a one-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.operators.ranged import PART, SEQ, part_offsets, range_parts
from ludex.session import stage_only, stage_table


def dense_index(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """Distinct non-NULL values of ``col`` (of any orderable type: numbers,
    titles) with ``out`` = dense rank - 1.

    The distinct values are range-partitioned; a value's code is its rank in
    its partition plus the number of values in earlier partitions (one row per
    partition). Eager: the codes are written, so a join with them can be split."""
    def build() -> DataFrame:
        values = df.select(col).where(F.col(col).isNotNull()).distinct()
        parts = range_parts(values, [F.col(col).asc()], "codes")
        # At most one row per partition.
        before = F.broadcast(part_offsets(parts, F.lit(1), "_before"))
        return parts.join(before, PART).select(
            col, (F.col("_before") + F.col(SEQ)).cast("bigint").alias(out))

    return stage_only(build, "codes")


def extend_index(known: DataFrame, df: DataFrame, col: str, out: str = "code") -> DataFrame:
    """``known`` (col, out: an earlier ``dense_index`` or ``extend_index``) with
    the values of ``df`` that it lacks: known codes stay as they are, new values
    follow in sort order after the largest of them. NULLs have no code. Eager."""
    def build() -> DataFrame:
        held = stage_table(known.select(col, out), "known")
        fresh = df.select(col).where(F.col(col).isNotNull()).distinct().join(held, col, "left_anti")
        first = held.select(F.coalesce(F.max(out) + 1, F.lit(0))).scalar()
        return held.unionByName(dense_index(fresh, col, out).withColumn(out, F.col(out) + first))

    return stage_only(build, "codes")
