"""The two cleaning flows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regloom.functions.register import (
    activity_label,
    address_line,
    location_key,
    office_type,
    organisation_id,
    valid_company_number,
)
from regloom.operators.conform import conform, drop_tokens, fill_missing
from regloom.operators.filters import commercial_companies, is_open, named, open_establishments
from regloom.operators.lookups import with_company_type, with_employee_count
from regloom.operators.report import RowCounts
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS

# Constants of the cleaned tables.
INSERTED_SUFFIX = " - insert"
LEGAL_COUNTRY = "FRANCE"
LEGAL_COUNTRY_CODE = "FR"

# Identifiers: never filled, so that a missing one is not taken for a key.
IDENTIFIERS = ("company_number", "siret")

# Column with the text of a record that has not as many fields as its header.
MALFORMED = "malformed_record"

OUTCOME, CLEAN, QUARANTINED = "outcome", "clean", "quarantined"


def with_provenance(df: DataFrame, source: str | Column, as_of: datetime) -> DataFrame:
    """Who wrote the row and when; one moment for the whole run.

    ``source`` is one name for all rows, or a column with the name of each.
    """
    name = F.lit(source) if isinstance(source, str) else source
    return df.withColumns(
        {
            "last_modified_by": F.concat(name, F.lit(INSERTED_SUFFIX)),
            "last_modified_date": F.lit(as_of),
        }
    )


def read_establishments(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Named, typed rows with missing values made uniform; nothing dropped yet."""
    typed = conform(drop_tokens(raw), ESTABLISHMENTS, strict=False, keep=keep)
    return fill_missing(typed, identifiers=[*IDENTIFIERS, *keep])


def identified(company_number: Column, establishment: Column) -> Column:
    """Whether a row has a valid company number and an establishment number."""
    return valid_company_number(company_number) & F.coalesce(F.trim(establishment) != "", F.lit(False))


def with_establishment_columns(df: DataFrame) -> DataFrame:
    """Organisation id, location key, address lines and office type."""
    organisation = organisation_id(F.col("company_number"))
    return df.withColumns(
        {
            "id": organisation,
            "geo_md5": location_key(organisation, F.col("AddressPostcode")),
            "address_line_1": address_line(
                F.col("AddressBuildingBlock"), F.col("AddressNumber"), F.col("AddressNumberSubUnit")
            ),
            "address_line_2": address_line(F.col("AddressUniqueIdentifier"), F.col("AddressLabel")),
            "registered_office_type": office_type(F.col("RegisteredOfficeBool")),
        }
    )


def clean_establishments(
    raw: DataFrame, source: str | Column, as_of: datetime, keep: Sequence[str] = ()
) -> DataFrame:
    """Open establishments with valid identifiers, 60 columns and ``keep``."""
    return (
        read_establishments(raw, keep)
        .filter(identified(F.col("company_number"), F.col("siret")))
        .transform(open_establishments)
        .transform(with_establishment_columns)
        .transform(with_provenance, source, as_of)
    )


def sort_out_establishments(
    raw: DataFrame, source: str | Column, as_of: datetime, keep: Sequence[str], counts: RowCounts
) -> DataFrame:
    """Cleaned and quarantined establishments in one pass, told apart by ``outcome``.

    Records that the scan marked as ``MALFORMED`` are quarantined and counted too.
    """
    rows = read_establishments(raw, keep)
    whole = F.col(MALFORMED).isNull() if MALFORMED in keep else F.lit(True)
    valid = whole & identified(F.col("company_number"), F.col("siret"))
    still_open = is_open(F.col("AdministrativeStatus"))
    rows = counts.count(
        rows,
        rows_before=valid,
        rows_after=valid & still_open,
        rows_quarantined=~valid,
        rows_malformed=~whole,
    )
    return (
        rows.filter(~valid | still_open)
        .withColumn(OUTCOME, F.when(valid, CLEAN).otherwise(QUARANTINED))
        .transform(with_establishment_columns)
        .transform(with_provenance, source, as_of)
    )


def read_legal_units(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Named, typed rows; markers stay, and a cell that does not parse is an error."""
    return conform(raw, LEGAL_UNITS, strict=True, keep=keep)


def kept_legal_units(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Named commercial companies.

    The filters run on the raw headers, so they reach the scan as they are.
    """
    header = {f.name: f.header for f in LEGAL_UNITS.fields}
    return (
        raw.transform(named, header["LegalEntityName"])
        .transform(commercial_companies, header["LegalCategory"])
        .transform(read_legal_units, keep)
    )


def with_legal_unit_columns(df: DataFrame) -> DataFrame:
    """Organisation id, country and activity label."""
    return df.withColumns(
        {
            "id": organisation_id(F.col("company_number")),
            "country": F.lit(LEGAL_COUNTRY),
            "country_code": F.lit(LEGAL_COUNTRY_CODE),
            "company_status": activity_label(F.col("AdministrativeStatus")),
        }
    )


def clean_legal_units(
    raw: DataFrame, source: str | Column, as_of: datetime, keep: Sequence[str] = ()
) -> DataFrame:
    """Named commercial companies with known codes, 42 columns and ``keep``."""
    return (
        kept_legal_units(raw, keep)
        .transform(with_company_type)
        .transform(with_employee_count)
        .filter("company_type is not null and EmployeeCount is not null and company_number is not null")
        .transform(with_legal_unit_columns)
        .transform(with_provenance, source, as_of)
    )


def sort_out_legal_units(
    raw: DataFrame, source: str | Column, as_of: datetime, keep: Sequence[str], counts: RowCounts
) -> DataFrame:
    """Cleaned and quarantined legal units in one pass, told apart by ``outcome``.

    ``unknown_codes`` names the code lists that lack the code of a quarantined unit, and
    the company number where that is missing.
    """
    rows = kept_legal_units(counts.count(raw, rows_before=F.lit(True)), keep)
    rows = rows.transform(with_company_type).transform(with_employee_count)
    no_type, no_count = F.col("company_type").isNull(), F.col("EmployeeCount").isNull()
    nameless = F.col("company_number").isNull()
    unlisted = no_type | no_count | nameless
    rows = counts.count(rows, rows_after=~unlisted, rows_quarantined=unlisted)
    unknown = F.concat_ws(
        ",", F.when(no_type, "company_type"), F.when(no_count, "employee_count"), F.when(nameless, "company_number")
    )
    return (
        rows.withColumn("unknown_codes", unknown)
        .withColumn(OUTCOME, F.when(unlisted, QUARANTINED).otherwise(CLEAN))
        .transform(with_legal_unit_columns)
        .transform(with_provenance, source, as_of)
    )
