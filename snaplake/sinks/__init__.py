"""Sinks: versioned Parquet tables, extraction series, JDBC export."""
