"""Columns that an operator does not touch, carried as one struct so that no name can clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wrapped(documents: DataFrame, *apart: str) -> DataFrame:
    """``row``, a struct of all columns but ``text``; ``text``; and copies of columns asked for."""
    rest = [documents[c] for c in documents.columns if c != "text"]
    return documents.select(F.struct(*rest, F.lit(0).alias("_none")).alias("row"), documents["text"].alias("text"), *[documents[c].alias(c) for c in apart])


def unwrapped(rows: DataFrame, documents: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``documents`` again, some of them changed."""
    plain = {"text": F.col("text")} | changed
    return rows.select(*[(plain[c] if c in plain else F.col("row").getField(c)).alias(c) for c in documents.columns])
