"""Readers and writers: driver parquet tables, CSV / JSON inputs, CSV / JSON / parquet / graph-snapshot outputs."""
