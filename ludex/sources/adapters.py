"""Adapters that turn fixture tables into a normalised behaviour log.

Every adapter returns the columns of ``LOG_COLUMNS`` (plus optional extra
dimensions), so the feature and model operators never see source names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludex.operators.indexing import dense_index
from ludex.operators.ranged import PART, SEQ, part_offsets, range_parts
from ludex.sources.readers import read_table


def behaviour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1: ``events`` as a purchase / play log.

    purchase events stay purchases (hours 1.0); view events become plays with
    ``value`` as hours; the item is the integer ``k`` of the ``props`` JSON.
    Order inside a user is (ts, event_id).
    """
    ev = read_table(spark, sf_dir, "events")
    is_purchase = F.col("event_type") == F.lit("purchase")
    return (ev.filter(F.col("event_type").isin("purchase", "view"))
            .select(
                F.col("user_id"),
                F.get_json_object("props", "$.k").try_cast("bigint").alias("item"),
                F.when(is_purchase, F.lit("purchase")).otherwise(F.lit("play")).alias("behaviour"),
                F.when(is_purchase, F.lit(1.0)).otherwise(F.col("value")).alias("hours"),
                F.col("ts"),
                F.col("event_id"),
                F.concat_ws("|", F.col("event_id"), F.col("user_id")).alias("rkey"),
            ))


def basket_log(spark: SparkSession, sf_dir: str, with_priority: bool = False) -> DataFrame:
    """I2: ``orders`` joined to ``lineitem`` as a purchase log.

    user = customer, item = part, hours = quantity, every row a purchase.
    (l_orderkey, l_linenumber) is not unique in the fixtures, so the row key
    also carries part and supplier; equal keys mean equal rows.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        *(["o_orderpriority"] if with_priority else []))
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    cols = [
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item"),
        F.lit("purchase").alias("behaviour"),
        F.col("l_quantity").alias("hours"),
        F.col("o_orderdate").alias("ts"),
        (F.col("l_orderkey") * F.lit(1000) + F.col("l_linenumber")).alias("event_id"),
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rkey"),
    ]
    if with_priority:
        cols.append(F.col("o_orderpriority").alias("priority"))
    return j.select(*cols)


def csv_log(raw: DataFrame) -> DataFrame:
    """Normalise a behaviour CSV read with ``read_behaviour_csv(..., ordered=
    True)``: item titles become alphabetical 0-based codes (NULL stays NULL),
    ``title`` keeps them.

    The CSV has no time column; the order of the files (by path) and of the
    lines in them stands in for it: ``event_id`` is the line's number over all
    files, whatever the splits. ``rkey`` comes from the row's values, so the
    80/20 split does not depend on the file layout. Eager: the ordered lines
    and the codes are written to the shared folder."""
    order = [F.col("_file").asc(), F.col("_block").asc(), F.col("_line").asc()]
    lines = range_parts(raw, order, "lines")
    before = F.broadcast(part_offsets(lines, F.lit(1), "_before"))
    codes = dense_index(lines, "item", "_code").withColumnRenamed("item", "_title")
    rows = (lines.join(before, PART).withColumn("event_id", F.col("_before") + F.col(SEQ))
            .join(codes, F.col("item") == F.col("_title"), "left"))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x01"))
    return rows.select(
        "user_id", F.col("_code").alias("item"), "behaviour", "hours",
        F.lit(None).cast("timestamp").alias("ts"), F.col("event_id").cast("bigint"),
        F.concat_ws("|", *map(value, ("user_id", "item", "behaviour", "hours"))).alias("rkey"),
        F.col("item").alias("title"))


def titles(log: DataFrame) -> DataFrame:
    """The lookup of a ``csv_log``: item code and title."""
    return log.where("item is not null").select("item", "title").distinct()
