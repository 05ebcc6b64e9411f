"""Approximate item neighbours by locality-sensitive hashing.

A table is a number of random projections of the item vectors; each gives one
bit, the sign. Items that agree in all bits of some table are candidates, whose
similarity is then summed exactly, so what is returned is right and only
pairs that never meet can be missing. Two vectors of cosine s agree in a bit with
probability 1 - arccos(s) / pi.

The coefficients are +1 or -1, taken from the bits of md5(user | round): the same
in every run and on every executor, and never stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludex.operators.similarity import l2_normalised, mirror, salted_self_join
from ludex.session import stage_table

# Projections of a table (a hexadecimal digit of md5 each four), and tables.
BITS = 4
TABLES = 48


def signatures(vectors: DataFrame, bits: int = BITS, tables: int = TABLES) -> DataFrame:
    """``vectors`` (item, user_id, v) -> (item, tab, sig): one row per item and
    table. The sums are combined map-side; they are rounded to nine places, so
    that a sum of zero is zero in any order (and gives bit 0)."""
    if bits % 4 or not 0 < bits <= 32:
        raise ValueError("bits come in fours, at most 32")
    digits = bits // 4
    per_round = 32 // digits
    rounds = -(-tables // per_round)
    user = F.col("user_id").cast("string")
    noise = F.concat(*[F.md5(F.concat_ws("|", user, F.lit(str(r)))) for r in range(rounds)])
    rows = vectors.select("item", "v", noise.alias("_noise")).select(
        "item", "v", "_noise", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("tab"))
    start = F.col("tab") * digits + 1
    value = F.conv(F.substring(F.col("_noise"), start, F.lit(digits)), 16, 10).cast("bigint")
    rows = rows.select("item", "tab", "v", value.alias("_d"))
    sums = [F.sum(F.when(F.shiftright("_d", b).bitwiseAND(1) == 1, F.col("v"))
                  .otherwise(-F.col("v"))).alias(f"_s{b}") for b in range(bits)]
    sig = sum((F.when(F.round(F.col(f"_s{b}"), 9) > 0, F.lit(1 << b)).otherwise(F.lit(0))
               for b in range(bits)), F.lit(0)).cast("bigint")
    return rows.groupBy("item", "tab").agg(*sums).select(
        "item", F.col("tab").cast("bigint").alias("tab"), sig.alias("sig"))


def candidates(sigs: DataFrame) -> DataFrame:
    """Distinct pairs i1 < i2 that share a bucket. The members of a large bucket
    meet in pairs of slices (``salted_self_join``), so no task holds one."""
    bucket = sigs.select(F.struct("tab", "sig").alias("user_id"), "item")
    pairs = salted_self_join(bucket, [F.col("item").alias("i1")], [F.col("item").alias("i2")])
    return pairs.where("i1 < i2").select("i1", "i2").distinct()


def lsh_cosine(ratings: DataFrame, bits: int = BITS, tables: int = TABLES) -> DataFrame:
    """(i1, i2, similarity), both orders, of the candidate pairs that share a
    user: the values of ``full_cosine`` on them. NULL users, items and ratings
    are left out, a zero vector has no neighbours, an empty table gives an empty
    one. Eager: vectors and candidates are written."""
    vectors = stage_table(l2_normalised(ratings).where("norm > 0").select(
        "item", "user_id", F.col("norm_value").alias("v")), "vectors")
    pairs = stage_table(candidates(signatures(vectors, bits, tables)), "candidates")
    # The cells of the first item go to its candidates; the second's meet them there.
    left = pairs.join(vectors.select(F.col("item").alias("i1"), "user_id",
                                     F.col("v").alias("v1")), "i1")
    right = vectors.select(F.col("item").alias("i2"), "user_id", F.col("v").alias("v2"))
    half = (left.join(right, ["i2", "user_id"]).groupBy("i1", "i2")
            .agg(F.sum(F.col("v1") * F.col("v2")).alias("similarity")))
    return mirror(half)
