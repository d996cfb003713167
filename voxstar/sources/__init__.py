"""Readers and the Parquet table store."""
