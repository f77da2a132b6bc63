"""Bring raw register rows to the cleaned names, types and missing-value rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from regloom.functions.missing import MISSING_TOKENS, without_tokens
from regloom.sources.layouts import Field, Layout


def _columns_of(df: DataFrame, kind) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, kind)}


def quoted(name: str) -> str:
    """A column name as SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def drop_tokens(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Null in place of the tokens, in every string column."""
    strings = _columns_of(df, T.StringType)
    return df.selectExpr(*[without_tokens(n, tokens) if n in strings else quoted(n) for n in df.columns])


def rename_headers(df: DataFrame, layout: Layout) -> DataFrame:
    """Published headers to cleaned names; headers a vintage lacks are skipped."""
    return df.withColumnsRenamed(layout.renames)


def conform(
    df: DataFrame, layout: Layout, *, strict: bool, keep: Sequence[str] = ()
) -> DataFrame:
    """Renamed rows with every column of the layout, in order and typed.

    Columns absent from the vintage become null. A cell that does not parse is
    null, or an error under ``strict``. ``keep`` names further columns to carry.
    """
    headers = set(df.columns)
    cast = "cast" if strict else "try_cast"

    def typed(field: Field) -> str:
        source = quoted(field.header) if field.header in headers else "null"
        if source == "null" or field.type != "string":
            source = f"{cast}({source} as {field.type})"
        return f"{source} as {field.name}"

    return df.selectExpr(*map(quoted, keep), *[typed(field) for field in layout.fields])


def fill_missing(df: DataFrame, identifiers: Sequence[str] = ()) -> DataFrame:
    """Empty text in place of null, and null in place of NaN; identifiers stay null."""
    strings = _columns_of(df, T.StringType) - set(identifiers)
    floats = _columns_of(df, (T.DoubleType, T.FloatType))

    def filled(name: str) -> str:
        if name in strings:
            return f"coalesce({quoted(name)}, '') as {quoted(name)}"
        return f"nanvl({quoted(name)}, null) as {quoted(name)}" if name in floats else quoted(name)

    return df.selectExpr(*[filled(name) for name in df.columns])
