"""Company-number checks: split the rows, or stop the run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.functions.register import valid_company_number


class InvalidRows(ValueError):
    """Rows break a rule the run was told to enforce."""


def valid_rows(df: DataFrame, number: str = "company_number") -> DataFrame:
    return df.filter(valid_company_number(F.col(number)))


def quarantined_rows(df: DataFrame, number: str = "company_number") -> DataFrame:
    return df.filter(~valid_company_number(F.col(number)))


def require_none(violations: DataFrame, rule: str) -> None:
    """Raise if there is any violation.

    The check is a count of its own over unfiltered input. An error raised from
    within a projection could be pruned away or skipped by a filter moved below it.
    """
    count = violations.count()
    if count:
        raise InvalidRows(f"{count} rows break the rule: {rule}")
