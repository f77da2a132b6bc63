"""Target tables: what each inserts, what it updates and by which key.

Keys are complete: cleaning sets rows without an identifier aside.
"""

from __future__ import annotations

from datetime import date

from regloom.operators.upsert import Constant, Upsert
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS

# Constants written by inserts and updates.
LOCATION_COUNTRY = "France"
LOCATION_INSERTED = "sirene_etab insert"
LOCATION_UPDATED = "sirene_etab update"
ORGANISATION_COUNTRY_CODE = "FR"
ACTIVITY_UPDATED = "stock legal pipeline update"

# Derived columns of the two cleaned tables.
ESTABLISHMENT_DERIVED = (
    "id",
    "geo_md5",
    "address_line_1",
    "address_line_2",
    "registered_office_type",
    "last_modified_by",
    "last_modified_date",
)
LEGAL_UNIT_DERIVED = (
    "company_type",
    "id",
    "country",
    "country_code",
    "company_status",
    "EmployeeCount",
    "last_modified_by",
    "last_modified_date",
)

# Columns of the two stock tables that only an insert writes.
ESTABLISHMENT_INSERT_ONLY = (
    "LastAddressNumber",
    "DateOfLastAddressNumber",
    "InstitutionAddressID",
    "LambertCoordinateX",
    "LambertCoordinateY",
    "id",
    "address_line_1",
    "address_line_2",
    "registered_office_type",
)
LEGAL_UNIT_INSERT_ONLY = ("company_type", "id", "company_status", "EmployeeCount")


def geo_location(as_of: date, name_source: bool = False) -> Upsert:
    """Locations; marked with two constants, or with the source of the rows if asked."""
    inserted, updated = Constant.text(LOCATION_INSERTED), Constant.text(LOCATION_UPDATED)
    if name_source:
        inserted = updated = "last_modified_by"
    today = Constant(f"date '{as_of:%Y-%m-%d}'")
    return Upsert(
        table="geo_location",
        keys=("md5_key",),
        complete=True,
        insert={
            "address_1": "address_line_1",
            "address_2": "address_line_2",
            "town": "AddressMunicipalityLabel",
            "country": Constant.text(LOCATION_COUNTRY),
            "post_code": "AddressPostcode",
            "address_type": "registered_office_type",
            "organisation_id": "id",
            "post_code_formatted": "AddressPostcode",
            "md5_key": "geo_md5",
            "date_last_modified": today,
            "last_modified_by": inserted,
        },
        update={
            "address_1": "address_line_1",
            "address_2": "address_line_2",
            "town": "AddressMunicipalityLabel",
            "post_code": "AddressPostcode",
            "address_type": "registered_office_type",
            "post_code_formatted": "AddressPostcode",
            "date_last_modified": today,
            "last_modified_by": updated,
        },
    )


def organisation() -> Upsert:
    return Upsert(
        table="organisation",
        keys=("id",),
        complete=True,
        insert={
            "id": "id",
            "company_number": "company_number",
            "company_name": "LegalEntityName",
            "company_status": "company_status",
            "country": "country",
            "date_formed": "DateCreated",
            "company_type": "company_type",
            "last_modified_by": "last_modified_by",
            "last_modified_date": "last_modified_date",
            "country_code": Constant.text(ORGANISATION_COUNTRY_CODE),
        },
        update={
            "company_name": "LegalEntityName",
            "company_status": "company_status",
            "company_type": "company_type",
            "last_modified_by": "last_modified_by",
            "last_modified_date": "last_modified_date",
        },
    )


def naf_code(as_of: date) -> Upsert:
    return Upsert(
        table="naf_code",
        keys=("code", "organisation_id"),
        complete=True,
        insert={
            "code": "NAFCategory",
            "organisation_id": "id",
            "name_en": "name_en",
            "name_fr": "name_fr",
            "last_modified_date": "last_modified_date",
            "last_modified_by": "last_modified_by",
        },
        update={
            "last_modified_date": Constant(f"timestamp '{as_of:%Y-%m-%d} 00:00:00'"),
            "last_modified_by": Constant.text(ACTIVITY_UPDATED),
        },
    )


def _stock(table: str, key: str, columns: list[str], insert_only: tuple[str, ...]) -> Upsert:
    return Upsert(
        table=table,
        keys=(key,),
        complete=True,
        insert={c: c for c in columns},
        update={c: c for c in columns if c not in insert_only},
    )


def stock_etab() -> Upsert:
    columns = [*ESTABLISHMENTS.names, *ESTABLISHMENT_DERIVED]
    return _stock("stock_etab", "siret", columns, ESTABLISHMENT_INSERT_ONLY)


def stock_legal() -> Upsert:
    columns = [*LEGAL_UNITS.names, *LEGAL_UNIT_DERIVED]
    return _stock("stock_legal", "company_number", columns, LEGAL_UNIT_INSERT_ONLY)
