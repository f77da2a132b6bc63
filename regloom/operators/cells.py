"""Cells that break a rule, each named by its column, its text and the rule, beside the typed row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.register import valid_company_number
from regloom.operators.conform import quoted
from regloom.operators.lookups import type_code
from regloom.sources.layouts import Layout

FAILED = "failed_cells"
#: Names of rules that are not types.
IDENTIFIER, REQUIRED, CODE = "identifier", "required", "code list"


@dataclass(frozen=True)
class CellRule:
    """A rule for the cells under one header; ``broken`` is true of a cell that breaks it."""

    header: str
    column: str
    rule: str
    broken: Column


def type_rules(layout: Layout, headers: Sequence[str]) -> list[CellRule]:
    """A cell of a typed column is empty or reads as that type; the rule bears the type's name."""
    found = []
    for field in layout.fields:
        if field.type != "string" and field.header in headers:
            cell = F.col(quoted(field.header))
            found.append(CellRule(field.header, field.name, field.type, cell.isNotNull() & cell.try_cast(field.type).isNull()))
    return found


def identifier_rule(layout: Layout, column: str) -> CellRule:
    """A company number has its fixed length and is never missing."""
    header = _header(layout, column)
    return CellRule(header, column, IDENTIFIER, ~valid_company_number(F.col(quoted(header))))


def required_rule(layout: Layout, column: str) -> CellRule:
    header = _header(layout, column)
    return CellRule(header, column, REQUIRED, F.coalesce(F.trim(F.col(quoted(header))) == "", F.lit(True)))


def code_rule(layout: Layout, column: str, codes: Mapping[str, str], *, prefix: bool = False) -> CellRule:
    """A code that is given is in the list; with ``prefix``, its first two characters are."""
    header = _header(layout, column)
    cell = F.col(quoted(header))
    code = type_code(cell) if prefix else cell
    return CellRule(header, column, CODE, code.isNotNull() & ~code.isin(list(codes)))


def _header(layout: Layout, column: str) -> str:
    return next(f.header for f in layout.fields if f.name == column)


def with_failed_cells(raw: DataFrame, rules: Sequence[CellRule]) -> DataFrame:
    """Adds an array of (column, text, rule), empty for a row without fault."""
    cells = [
        F.when(r.broken, F.struct(F.lit(r.column).alias("column"), F.col(quoted(r.header)).cast("string").alias("text"), F.lit(r.rule).alias("rule")))
        for r in rules
    ]
    none = F.array().cast("array<struct<column:string,text:string,rule:string>>")
    return raw.withColumn(FAILED, F.array_compact(F.array(*cells)) if cells else none)


def failure_report(rows: DataFrame, *by: str) -> DataFrame:
    """Failed cells counted by rule and column, and by further columns such as the file."""
    cells = rows.select(*by, F.explode(FAILED).alias("cell"))
    return cells.groupBy(*by, "cell.column", "cell.rule").agg(
        F.count(F.lit(1)).alias("cells"), F.count_distinct("cell.text").alias("texts"), F.min("cell.text").alias("least_text")
    )


def first_failure(rows: DataFrame, order: str, *by: str) -> str | None:
    """Where the first row with a failed cell is, in words; None if there is none."""
    found = rows.where(F.size(FAILED) > 0).orderBy(order).select(*by, FAILED).first()
    if found is None:
        return None
    cell, place = found[FAILED][0], ", ".join(f"{b} {found[b]}" for b in by)
    return f"{place}{': ' if place else ''}column {cell.column} has {cell.text!r}, which breaks the rule {cell.rule}"
