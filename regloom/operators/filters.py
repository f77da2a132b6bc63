"""Row filters of the two cleaning flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.missing import UNNAMED

# Closed establishments, natural persons, commercial companies.
CLOSED = "F"
NATURAL_PERSON = "0000"
COMMERCIAL_PREFIX = "5"


def is_open(status: Column) -> Column:
    """Not closed; a missing status counts as open."""
    return ~status.eqNullSafe(CLOSED)


def is_named(name: Column) -> Column:
    """Named and not undisclosed; null for a missing name, so a filter drops it."""
    return name != UNNAMED


def is_commercial(category: Column) -> Column:
    """A commercial company, which rules out natural persons."""
    return (category != NATURAL_PERSON) & category.startswith(COMMERCIAL_PREFIX)


def open_establishments(df: DataFrame, status: str = "AdministrativeStatus") -> DataFrame:
    return df.filter(is_open(F.col(status)))


def named(df: DataFrame, name: str = "LegalEntityName") -> DataFrame:
    return df.filter(is_named(F.col(name)))


def commercial_companies(df: DataFrame, category: str = "LegalCategory") -> DataFrame:
    return df.filter(is_commercial(F.col(category)))
