"""Sources and sinks: parquet test tables, raw/clean CSV, matrix text, JSON."""
