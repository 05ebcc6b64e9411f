"""A corpus pipeline over ``documents`` made of the numbered operators: quality
rules, near-dedup, benchmark decontamination, mixing to target weights, token
output. Each stage takes (spark, docs, sf_dir) and works on all its predecessor
kept; all but the last return the columns of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ludex.llm.common import read_table
from ludex.llm.decontaminate import decontaminate
from ludex.llm.mixing import mixed_docs
from ludex.llm.quality import keep_good
from ludex.llm.setsketch import keep_one_per_group
from ludex.llm.tokens import default_tokenizer, token_output
from ludex.session import stage_only

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules reject go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts; documents that are
    mostly benchmark go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the fitted rates say."""
    return mixed_docs(docs, read_table(spark, sf_dir, "labels"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as range-coded token ids, written and read back."""
    return token_output(docs, default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup),
    ("decontamination", decontamination), ("mixing", mixing), ("token_ids", token_ids),
]

# Sketches, fitted models and the coder are not expressible in SQL; the
# pipeline is tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # What a stage wrote on its way goes once its result is written.
        docs = stage_only(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
