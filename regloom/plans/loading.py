"""Load cleaned rows into the target tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from regloom.operators.lookups import join_dimension
from regloom.operators.upsert import inserts, upsert
from regloom.plans import targets
from regloom.streaming.loader import Feed

SEQUENCE = "seq"


def location_rows(clean: DataFrame, as_of: date) -> DataFrame:
    """Cleaned establishments in the columns of ``geo_location``."""
    return inserts(clean, targets.geo_location(as_of))


def organisation_rows(clean: DataFrame) -> DataFrame:
    """Cleaned legal units in the columns of ``organisation``."""
    return inserts(clean, targets.organisation())


def with_activity_names(clean: DataFrame, translations: DataFrame) -> DataFrame:
    """Legal units whose activity code has a translation, with its two names."""
    return join_dimension(clean, translations, "NAFCategory", "code")


def activity_rows(clean: DataFrame, translations: DataFrame, as_of: date) -> DataFrame:
    """Cleaned legal units in the columns of ``naf_code``."""
    return inserts(with_activity_names(clean, translations), targets.naf_code(as_of))


def load_establishments(
    clean: DataFrame,
    current: Mapping[str, DataFrame | None],
    as_of: date,
    sequence: str = SEQUENCE,
) -> dict[str, DataFrame]:
    """New contents of ``geo_location`` and ``stock_etab``."""
    specs = (targets.geo_location(as_of), targets.stock_etab())
    return {s.table: upsert(current.get(s.table), clean, s, sequence) for s in specs}


def load_legal_units(
    clean: DataFrame,
    translations: DataFrame,
    current: Mapping[str, DataFrame | None],
    as_of: date,
    sequence: str = SEQUENCE,
) -> dict[str, DataFrame]:
    """New contents of ``organisation``, ``naf_code`` and ``stock_legal``."""
    sources = (
        (targets.organisation(), clean),
        (targets.naf_code(as_of), with_activity_names(clean, translations)),
        (targets.stock_legal(), clean),
    )
    return {s.table: upsert(current.get(s.table), rows, s, sequence) for s, rows in sources}


def establishment_feeds(as_of: date) -> list[Feed]:
    """What a batch of cleaned establishments feeds."""
    return [Feed(targets.geo_location(as_of)), Feed(targets.stock_etab())]


def legal_unit_feeds(translations: DataFrame, as_of: date) -> list[Feed]:
    """What a batch of cleaned legal units feeds."""

    def named(batch: DataFrame) -> DataFrame:
        return with_activity_names(batch, translations)

    return [
        Feed(targets.organisation()),
        Feed(targets.naf_code(as_of), named),
        Feed(targets.stock_legal()),
    ]
