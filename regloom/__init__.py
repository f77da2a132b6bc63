"""regloom: loading and maintaining company-register snapshots with Spark DataFrames."""
