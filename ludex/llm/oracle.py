"""DuckDB SQL of the operators that SQL can express on whole tables. The
others have none: 1 (zstandard), 2 (tokenizer and coder), 8 (classifier), 9 (Luhn
test and corpus statistics over offsets), 10 (the verdict comes from fitted
accuracies), 11 (fitted regressions). They are tested against brute force in tests/llm."""

from __future__ import annotations

from ludex.llm.collocations import OP13_SQL
from ludex.llm.decontaminate import OP5_SQL
from ludex.llm.merkle import OP12_SQL
from ludex.llm.perspectives import OP4_SQL
from ludex.llm.setsketch import OP3_SQL
from ludex.llm.warc import OP6_SQL
from ludex.llm.windows import OP7_SQL

ORACLE_SQL: dict[str, str] = {
    "op3_near_dedup": OP3_SQL,
    "op4_chat_perspectives": OP4_SQL,
    "op5_decontamination": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
