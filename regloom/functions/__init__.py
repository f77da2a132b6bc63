"""Column expressions; every one is built from native Spark functions."""
