"""Snapshot labels and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label suffix and base-name pattern.
LABEL_SUFFIX = "_utf8"
BASENAME_PATTERN = r".*/([^/]+)$"


def snapshot_label(day: Column, dataset: str, extension: str = "") -> Column:
    """First of the month and dataset name, such as 2024-08-01-StockUniteLegale_utf8."""
    month = F.date_format(F.trunc(day, "MM"), "yyyy-MM-dd")
    return F.concat(month, F.lit(f"-{dataset}{LABEL_SUFFIX}{extension}"))


def snapshot_month(day: Column) -> Column:
    """First of the month without padding, such as 2024-8-01."""
    return F.concat(F.year(day).cast("string"), F.lit("-"), F.month(day).cast("string"), F.lit("-01"))


def path_basename(path: Column) -> Column:
    """Text after the last slash; the whole path if nothing follows one."""
    return F.when(path.rlike(BASENAME_PATTERN), F.regexp_extract(path, BASENAME_PATTERN, 1)).otherwise(path)
