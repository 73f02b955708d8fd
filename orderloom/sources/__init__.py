"""Readers and writers: CSV, day-partitioned Parquet, mart tables."""
