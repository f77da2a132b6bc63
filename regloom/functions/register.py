"""Identifiers, address parts and status labels of the register."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regloom.functions.missing import present

# Identifier format and labels.
COUNTRY_PREFIX = "FR"
COMPANY_NUMBER_LENGTH = 9
HEAD_OFFICE = "HEAD_OFFICE"
SUB_OFFICE = "SUB_OFFICE"
ACTIVITY_LABELS = {"A": "Active", "C": "Inactive"}


def organisation_id(company_number: Column) -> Column:
    return F.concat(F.lit(COUNTRY_PREFIX), company_number)


def valid_company_number(company_number: Column) -> Column:
    """True or false, never null: a missing number is invalid too."""
    return F.coalesce(F.length(company_number) == COMPANY_NUMBER_LENGTH, F.lit(False))


def location_key(organisation: Column, postcode: Column) -> Column:
    """MD5 of organisation id and postcode: one location per company and postcode."""
    return F.md5(F.concat(organisation, F.coalesce(postcode, F.lit(""))))


def address_line(*parts: Column) -> Column:
    """The parts that are there, joined by a space; empty when none is."""
    return F.concat_ws(" ", *[present(part) for part in parts])


def office_type(is_registered_office: Column) -> Column:
    return F.when(is_registered_office, F.lit(HEAD_OFFICE)).otherwise(F.lit(SUB_OFFICE))


def activity_label(status: Column) -> Column:
    """Label of a known status, null for any other."""
    active, inactive = ACTIVITY_LABELS.items()
    return F.when(status == active[0], F.lit(active[1])).when(
        status == inactive[0], F.lit(inactive[1])
    )
