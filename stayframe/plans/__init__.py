"""Registered queries (Spark plans) and their independent DuckDB oracles."""
