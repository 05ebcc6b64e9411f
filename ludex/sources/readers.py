"""Scans. Schemas are always explicit; Parquet gets pushdown and pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludex.functions.columns import PLAY, PURCHASE
from ludex.sources.schemas import BEHAVIOUR_CSV_SCHEMA


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the fixture tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_behaviour_csv(spark: SparkSession, path: str,
                       schema: T.StructType = BEHAVIOUR_CSV_SCHEMA,
                       ordered: bool = False) -> DataFrame:
    """Headerless behaviour CSV with a fixed schema.

    PERMISSIVE mode: a field that does not parse becomes NULL; surplus fields
    are cut off by the schema, missing trailing fields are NULL. ``ordered``
    adds _file, _block (start of the split in the file) and _line (grows
    inside a split), which together give the order of the lines.
    """
    raw = (spark.read.schema(schema)
           .option("header", "false")
           .option("mode", "PERMISSIVE")
           .csv(path))
    if not ordered:
        return raw
    return raw.select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_line"))


def read_behaviour_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A behaviour CSV as (rows, rejects). Every line is in exactly one of them.

    ``rows`` has the columns of ``read_behaviour_csv(..., ordered=True)``. A line
    is rejected if it lacks one of the four fields, or its user id or hours are no
    numbers or its behaviour is not known; ``rejects`` has the line as ``value``,
    ``reason`` (the fields at fault, comma-joined, or ``empty line``) and its
    place: ``_file``, ``_block`` (start of the split) and ``_line`` (grows inside
    a split). A fifth field is ignored. Quoted line breaks are not supported."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    fields = [f.name for f in BEHAVIOUR_CSV_SCHEMA]
    # Strings at first: a field that is no number must not be lost in the parser.
    text = F.from_csv("value", ", ".join(f"{f} string" for f in fields), {"mode": "PERMISSIVE"})
    parsed = lines.withColumn("_f", text)
    typed = {f.name: F.col(f"_f.{f.name}").try_cast(f.dataType) for f in BEHAVIOUR_CSV_SCHEMA}
    behaviour = F.col("_f.behaviour")
    typed["behaviour"] = F.when(behaviour.isin(PURCHASE, PLAY), behaviour)
    faults = F.concat_ws(",", *[F.when(typed[f].isNull(), F.lit(f)) for f in fields])
    reason = F.when(F.trim("value") == "", F.lit("empty line")).otherwise(faults)
    checked = parsed.withColumn("reason", reason)
    rows = checked.where("reason = ''").select(
        *[typed[f].alias(f) for f in fields], "_file", "_block", "_line")
    return rows, checked.where("reason <> ''").select("value", "reason", "_file", "_block", "_line")
