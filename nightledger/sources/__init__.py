"""Reading and writing tables kept as Parquet folders partitioned by ``dt`` (yyyymmdd)."""
