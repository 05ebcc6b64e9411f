"""Registered queries (Spark) and their SQL oracle (DuckDB)."""
