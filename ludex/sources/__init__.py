from ludex.sources.schemas import BEHAVIOUR_CSV_SCHEMA, LOG_COLUMNS
from ludex.sources.readers import read_behaviour_csv, read_table
from ludex.sources.adapters import behaviour_log, basket_log
from ludex.sources.sinks import write_parquet

__all__ = [
    "BEHAVIOUR_CSV_SCHEMA", "LOG_COLUMNS", "read_behaviour_csv", "read_table",
    "behaviour_log", "basket_log", "write_parquet",
]
