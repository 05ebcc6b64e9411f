"""Deterministic splits and per-key sampling caps (no seeds, no RNG state)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ludex.functions.columns import in_train


def train_test(rows: DataFrame, key: str = "rkey", train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """80/20 split by the md5 bucket of a row key.

    A row lands on the same side in every recomputation and in every engine,
    so the split survives executor loss and can be checked against SQL. A
    precomputed ``is_train`` flag (see ``features.with_train_flag``) is used
    when present and the split is the default 80/20.
    """
    flag = _flag(rows, key, train_pct)
    return rows.filter(flag).drop("is_train"), rows.filter(~flag).drop("is_train")


def _flag(rows: DataFrame, key: str, train_pct: int):
    if "is_train" in rows.columns and key == "rkey" and train_pct == 80:
        return F.col("is_train")
    return in_train(F.col(key), train_pct)


def with_split(rows: DataFrame, key: str = "rkey", train_pct: int = 80) -> DataFrame:
    return rows.withColumn(
        "split", F.when(_flag(rows, key, train_pct), F.lit("train")).otherwise(F.lit("test")))


def capped_per_key(rows: DataFrame, group: str, cap: int, key: str = "rkey") -> DataFrame:
    """At most ``cap`` rows per ``group``: a hash-ordered sample without
    replacement (order by md5 of the row key, then the key).

    Spark plans ``row_number() <= cap`` with a WindowGroupLimit before the
    shuffle, so even a hot group sends at most ``cap`` rows per map task.
    """
    w = Window.partitionBy(group).orderBy(F.md5(F.col(key)), F.col(key))
    return (rows.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") <= F.lit(cap)).drop("_rn"))
