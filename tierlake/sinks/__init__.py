"""Sinks: partitioned Parquet, relational tables, keyed tables with upsert."""
