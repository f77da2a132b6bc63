"""Reading register files and writing tables, fragments and staging data."""
