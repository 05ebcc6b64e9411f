"""The registered queries of the numbered operators, over whole tables with
production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ludex.llm.collocations import op13_collocations
from ludex.llm.decontaminate import op5_decontamination
from ludex.llm.langid import op11_language_id
from ludex.llm.licenses import op1_license_scan
from ludex.llm.merkle import op12_merkle_manifest
from ludex.llm.mixing import op8_mixing
from ludex.llm.perspectives import op4_chat_perspectives
from ludex.llm.pii import op9_pii
from ludex.llm.quality import op10_quality_rules
from ludex.llm.setsketch import op3_near_dedup
from ludex.llm.tokens import op2_token_output
from ludex.llm.warc import op6_warc
from ludex.llm.windows import op7_substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_token_output, op3_near_dedup, op4_chat_perspectives,
        op5_decontamination, op6_warc, op7_substring_dedup, op8_mixing, op9_pii,
        op10_quality_rules, op11_language_id,
        op12_merkle_manifest, op13_collocations)
}
