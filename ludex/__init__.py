"""ludex: behaviour-log analytics and item recommenders as Spark DataFrame plans.

Layout
------
sources/    schemas, CSV / Parquet readers, table adapters, Parquet sink
functions/  column-expression helpers (hash split, safe division, rating ladder)
operators/  profiling, features, splits, similarity, scoring, evaluation, ALS
plans/      the registered queries (Spark builders and their DuckDB oracle SQL)
streaming/  nothing: the behaviour log is batch-only
"""

from ludex.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
