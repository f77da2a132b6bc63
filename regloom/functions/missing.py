"""Markers for missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for a missing value in establishment files.
MISSING_TOKENS = ("[ND]", "NN")
UNNAMED = "[ND]"


def without_tokens(name: str, tokens: Sequence[str] = MISSING_TOKENS) -> str:
    """Select expression of a column with null in place of a missing-value token."""
    listed = ", ".join(f"'{token}'" for token in tokens)
    return f"case when {name} not in ({listed}) then {name} end as {name}"


def present(column: Column) -> Column:
    """Null in place of an empty or undisclosed part."""
    return F.when(~column.isin("", UNNAMED), column)
