"""Readers: text, JSON, Parquet, CSV, XML rows, JDBC, catalog tables, sharded folders."""
