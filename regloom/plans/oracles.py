"""The registered queries in SQL, written without the library.

Upserts are expressed by ranking rows within a key, where the library aggregates.
"""

from __future__ import annotations

# Code lists, headers and cleaned names, written out so that the SQL does not
# depend on what it checks.
COMPANY_TYPES = {
    "00": "Collective Investment",
    "10": "Entrepreneur",
    "21": "Joint Ownership",
    "22": "De facto Corporation",
    "23": "Joint-stock Company",
    "24": "Trust",
    "27": "Parish",
    "28": "Subject to VAT",
    "29": "Private Law Group without legal personality",
    "31": "Legal Entity Under Foreign Law, RCS registered",
    "32": "Legal Entity Under Foreign Law, not RCS registered",
    "41": "Public Company of industrial/commercial nature",
    "51": "Limited Liability Co-operative",
    "52": "SNC (General Partnership)",
    "53": "SCA (Limited Partnership)",
    "54": "SARL (Limited Liability Company)",
    "55": "SA (Limited Company with Board of Directors)",
    "56": "SA (Limited Company with Management Board)",
    "57": "SAS (Joint-Stock Company)",
    "58": "SE (EU Registered Company)",
    "61": "Pension Funds",
    "62": "Economic Interest Group",
    "63": "Agricultural Co-operative",
    "64": "Mutual Insurance",
    "65": "SC (Civil Company)",
    "69": "Other Registered Private Company",
    "71": "State Administration",
    "72": "Territorial Authority",
    "73": "Public Administration",
    "74": "Other Public Entity",
    "81": "Social Security",
    "82": "Mutual Organisation",
    "83": "Council",
    "84": "Professional Organisation",
    "85": "Non-compulsory pension",
    "91": "Union",
    "92": "1901 Association",
    "93": "Foundation",
    "99": "Other Legal Entity",
}

HEADCOUNTS = {
    "0": "0 fulltime employees",
    "00": "0 fulltime employees",
    "1": "1-2 employees",
    "01": "1-2 employees",
    "2": "2-3 employees",
    "02": "2-3 employees",
    "3": "6-9 employees",
    "03": "6-9 employees",
    "11": "10-19 employees",
    "12": "20-49 employees",
    "21": "50-99 employees",
    "22": "100-199 employees",
    "31": "200-249 employees",
    "32": "250-499 employees",
    "41": "500-999 employees",
    "42": "1000-1999 employees",
    "51": "2000-4999 employees",
    "52": "5000-9999 employees",
    "53": ">10000 employees",
    "null": "no number provided",
    "NN": "no number submitted",
}

ETAB_EXTRA = {
    "statutDiffusionEtablissement": ("distributionStatus", "string"),
    "dateCreationEtablissement": ("EstablishmentDate", "string"),
    "trancheEffectifsEtablissement": ("EmployeeCountCategory", "string"),
    "anneeEffectifsEtablissement": ("EmployeeCountCategoryYear", "int"),
    "activitePrincipaleRegistreMetiersEtablissement": ("mainNAF", "string"),
    "dateDernierTraitementEtablissement": ("LastNAFUpdate", "string"),
    "dernierNumeroVoieEtablissement": ("LastAddressNumber", "string"),
    "indiceRepetitionDernierNumeroVoieEtablissement": ("DateOfLastAddressNumber", "string"),
    "identifiantAdresseEtablissement": ("InstitutionAddressID", "string"),
    "coordonneeLambertAbscisseEtablissement": ("LambertCoordinateX", "double"),
    "coordonneeLambertOrdonneeEtablissement": ("LambertCoordinateY", "double"),
    "libelleCommuneEtrangerEtablissement": ("AddressForeignMunicipality", "string"),
    "distributionSpecialeEtablissement": ("AddressPOBox", "string"),
    "codeCommuneEtablissement": ("AddressCommuneCode", "string"),
    "codeCedexEtablissement": ("AddressCEDEXCode", "string"),
    "libelleCedexEtablissement": ("AddressCEDEXLabel", "string"),
    "codePaysEtrangerEtablissement": ("AddressOverseasCountryCode", "string"),
    "libellePaysEtrangerEtablissement": ("AddressOverseasCountryLabel", "string"),
    "complementAdresse2Etablissement": ("AddressBuildingBlock2", "string"),
    "numeroVoie2Etablissement": ("AddressNumber2", "string"),
    "indiceRepetition2Etablissement": ("AddressNumberSubUnit2", "string"),
    "typeVoie2Etablissement": ("AddressUniqueIdentifier2", "string"),
    "libelleVoie2Etablissement": ("AddressLabel2", "string"),
    "codePostal2Etablissement": ("AddressPostcode2", "string"),
    "libelleCommune2Etablissement": ("AddressMunicipalityLabel2", "string"),
    "libelleCommuneEtranger2Etablissement": ("AddressForeignMunicipality2", "string"),
    "distributionSpeciale2Etablissement": ("AddressPOBox2", "string"),
    "codeCommune2Etablissement": ("AddressCommuneCode2", "string"),
    "codeCedex2Etablissement": ("AddressCEDEXCode2", "string"),
    "libelleCedex2Etablissement": ("AddressCEDEXLabel2", "string"),
    "codePaysEtranger2Etablissement": ("AddressOverseasCountryCode2", "string"),
    "libellePaysEtranger2Etablissement": ("AddressOverseasCountryLabel2", "string"),
    "dateDebut": ("DateOfBusinessStart", "string"),
    "enseigne1Etablissement": ("EstablishmentSign1", "string"),
    "enseigne2Etablissement": ("EstablishmentSign2", "string"),
    "enseigne3Etablissement": ("EstablishmentSign3", "string"),
    "denominationUsuelleEtablissement": ("CommonCompanyName", "string"),
    "activitePrincipaleEtablissement": ("APETCode", "string"),
    "nomenclatureActivitePrincipaleEtablissement": ("APETCodeCategory", "string"),
    "caractereEmployeurEtablissement": ("EmploymentType", "string"),
}

LEGAL_EXTRA = {
    "statutDiffusionUniteLegale": ("LegalUnitBroadcastID", "string"),
    "unitePurgeeUniteLegale": ("PurgeStatus", "string"),
    "sigleUniteLegale": ("LegalAcronym", "string"),
    "sexeUniteLegale": ("GenderOfPerson", "string"),
    "prenom1UniteLegale": ("NaturalName1", "string"),
    "prenom2UniteLegale": ("NaturalName2", "string"),
    "prenom3UniteLegale": ("NaturalName3", "string"),
    "prenom4UniteLegale": ("NaturalName4", "string"),
    "prenomUsuelUniteLegale": ("PreferredName", "string"),
    "pseudonymeUniteLegale": ("pseudonym", "string"),
    "identifiantAssociationUniteLegale": ("RNANumber", "string"),
    "anneeEffectifsUniteLegale": ("EmployeeCountCategoryDateUpdated", "int"),
    "dateDernierTraitementUniteLegale": ("LegalUnitUpdated", "string"),
    "nombrePeriodesUniteLegale": ("TimeAsLegalUnit", "int"),
    "categorieEntreprise": ("BusinessCategory", "string"),
    "anneeCategorieEntreprise": ("YearOfBusinessCategoryAssignment", "int"),
    "dateDebut": ("DateOfBusinessStart", "string"),
    "nomUniteLegale": ("PersonBirthName", "string"),
    "nomUsageUniteLegale": ("PersonUsedName", "string"),
    "denominationUsuelle1UniteLegale": ("LegalEntityName1", "string"),
    "denominationUsuelle2UniteLegale": ("LegalEntityName2", "string"),
    "denominationUsuelle3UniteLegale": ("LegalEntityName3", "string"),
    "nomenclatureActivitePrincipaleUniteLegale": ("ActiveLegalUnit", "string"),
    "nicSiegeUniteLegale": ("NICAssignment", "string"),
    "economieSocialeSolidaireUniteLegale": ("SSEBool", "string"),
    "societeMissionUniteLegale": ("MissionDrivenCompanyBool", "string"),
    "caractereEmployeurUniteLegale": ("EmployerNature", "string"),
}



def _filled(extra: dict, seq: str, shift: int) -> list[str]:
    def value(i: int, kind: str) -> str:
        if kind == "int":
            return f"cast(2000 + ({seq} + {shift}) % 20 as varchar)"
        if kind == "double":
            return f"cast({seq} + {shift} as varchar)"
        return f"'e{i}-' || cast(({seq} + {shift}) % {7 + i} as varchar)"

    return [f"{value(i, kind)} as {header}" for i, (header, (_, kind)) in enumerate(extra.items())]


def _etab_raw(shift: int = 0) -> str:
    office, other = ("false", "true") if shift else ("true", "false")
    k = f"(o_orderkey + {shift})"
    return f"""
select o_orderkey as seq,
 lpad(cast(o_custkey + {shift} as varchar), 9, '0') as siren,
 lpad(cast({k} % 100000 as varchar), 5, '0') as nic,
 case when o_orderkey % 23 = 0 then null else lpad(cast(o_orderkey as varchar), 14, '0') end as siret,
 case o_orderstatus when 'F' then 'F' when 'O' then 'A' end as etatAdministratifEtablissement,
 case o_orderpriority when '1-URGENT' then '{office}' when '5-LOW' then null else '{other}' end
  as etablissementSiege,
 case o_orderkey % 9 when 0 then 'NN' when 1 then 'x' else cast(1 + {k} % 4 as varchar) end
  as nombrePeriodesEtablissement,
 case {k} % 5 when 0 then '[ND]' when 1 then '' when 2 then null else c_mktsegment end
  as complementAdresseEtablissement,
 case when o_orderkey % 3 = 0 then null else cast({k} % 200 as varchar) end
  as numeroVoieEtablissement,
 case {k} % 7 when 0 then 'B' when 1 then 'NN' end as indiceRepetitionEtablissement,
 case when {k} % 4 = 0 then null else 'RUE' end as typeVoieEtablissement,
 n_name as libelleVoieEtablissement,
 n_name || '{" B" * shift}' as libelleCommuneEtablissement,
 case when o_orderkey % 11 = 0 then null else lpad(cast({k} % 4 as varchar), 5, '0') end
  as codePostalEtablissement,
 {", ".join(_filled(ETAB_EXTRA, "o_orderkey", shift))}
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def _legal_raw(shift: int = 0) -> str:
    k = f"(c_custkey + {shift})"
    return f"""
select c_custkey as seq,
 case when c_custkey % 29 = 0 then null else lpad(cast(c_custkey as varchar), 9, '0') end as siren,
 case c_custkey % 13 when 0 then '[ND]' when 1 then null else c_name || '{" B" * shift}' end
  as denominationUniteLegale,
 case {k} % 6 when 0 then '5499' when 1 then '5710' when 2 then '5505' when 3 then '1000'
  when 4 then '0000' end as categorieJuridiqueUniteLegale,
 case {k} % 7 when 0 then '00' when 1 then '01' when 2 then '2' when 3 then '53'
  when 4 then 'NN' when 5 then 'null' end as trancheEffectifsUniteLegale,
 case {k} % 5 when 0 then 'A' when 1 then 'C' end as etatAdministratifUniteLegale,
 case when c_custkey % 8 = 0 then '99' else lpad(cast(c_nationkey as varchar), 2, '0') end
  as activitePrincipaleUniteLegale,
 cast(1990 + {k} % 30 as varchar) || '-01-01' as dateCreationUniteLegale,
 {", ".join(_filled(LEGAL_EXTRA, "c_custkey", shift))}
from customer
"""


ETAB_RAW, LEGAL_RAW = _etab_raw(), _legal_raw()

NAF_DIM = """
select lpad(cast(n_nationkey as varchar), 2, '0') as code, n_name as name_en,
 'FR_' || n_name as name_fr
from nation
"""

SIREN_RAW = """
select c_custkey as seq,
 case when c_custkey % 17 = 0 then lpad(cast(c_custkey as varchar), 8, '0')
  when c_custkey % 19 = 0 then null else lpad(cast(c_custkey as varchar), 9, '0') end as siren
from customer
"""

# Raw header and cleaned name of the establishment columns the inputs fill.
ETAB_FILLED = {
    "siren": "company_number",
    "nic": "localnic",
    "siret": "siret",
    "etatAdministratifEtablissement": "AdministrativeStatus",
    "complementAdresseEtablissement": "AddressBuildingBlock",
    "numeroVoieEtablissement": "AddressNumber",
    "indiceRepetitionEtablissement": "AddressNumberSubUnit",
    "typeVoieEtablissement": "AddressUniqueIdentifier",
    "libelleVoieEtablissement": "AddressLabel",
    "libelleCommuneEtablissement": "AddressMunicipalityLabel",
    "codePostalEtablissement": "AddressPostcode",
}
ETAB_STRINGS_MORE = {h: n for h, (n, kind) in ETAB_EXTRA.items() if kind == "string"}
ETAB_NUMBERS = {h: (n, kind) for h, (n, kind) in ETAB_EXTRA.items() if kind != "string"}
LEGAL_FILLED = {
    "siren": "company_number",
    "denominationUniteLegale": "LegalEntityName",
    "categorieJuridiqueUniteLegale": "LegalCategory",
    "trancheEffectifsUniteLegale": "EmployeeCountCategory",
    "etatAdministratifUniteLegale": "AdministrativeStatus",
    "activitePrincipaleUniteLegale": "NAFCategory",
    "dateCreationUniteLegale": "DateCreated",
}

def _list(items) -> str:
    return ",\n ".join(items)


def _values(codes: dict[str, str]) -> str:
    return "(values " + ", ".join(f"('{c}', '{label}')" for c, label in codes.items()) + ")"


def _token_free(column: str) -> str:
    return f"case when {column} in ('[ND]', 'NN') then null else {column} end"


def _etab_clean(month: str = "2024-08", shift: int = 0) -> str:
    """Full cleaned establishments, modification time as a date."""
    strings = {**ETAB_FILLED, **ETAB_STRINGS_MORE}
    filled = [f"coalesce({_token_free(raw)}, '') as {name}" for raw, name in strings.items()]
    numbers = [f"try_cast({raw} as {kind}) as {name}" for raw, (name, kind) in ETAB_NUMBERS.items()]
    return f"""
with n as (
 select seq, {_list(filled)},
  {_list(numbers)},
  try_cast({_token_free('nombrePeriodesEtablissement')} as integer) as PeriodNumber,
  cast(etablissementSiege as boolean) as RegisteredOfficeBool
 from ({_etab_raw(shift)}) raw where siret is not null)
select n.*,
 'FR' || company_number as id,
 md5('FR' || company_number || AddressPostcode) as geo_md5,
 concat_ws(' ', nullif(AddressBuildingBlock, ''), nullif(AddressNumber, ''),
  nullif(AddressNumberSubUnit, '')) as address_line_1,
 concat_ws(' ', nullif(AddressUniqueIdentifier, ''), nullif(AddressLabel, '')) as address_line_2,
 case when RegisteredOfficeBool then 'HEAD_OFFICE' else 'SUB_OFFICE' end as registered_office_type,
 '{month}-01-StockEtablissement_utf8.csv - insert' as last_modified_by,
 date '{month}-01' as last_modified_date
from n where AdministrativeStatus <> 'F' and length(company_number) = 9
"""


def _legal_kept(shift: int = 0) -> str:
    return f"""
select * from ({_legal_raw(shift)}) raw
where denominationUniteLegale <> '[ND]' and categorieJuridiqueUniteLegale <> '0000'
 and substring(categorieJuridiqueUniteLegale, 1, 1) = '5'
"""


LEGAL_KEPT = _legal_kept()


def _legal_columns() -> list[str]:
    more = [h if kind == "string" else f"cast({h} as {kind})" for h, (_, kind) in LEGAL_EXTRA.items()]
    names = [n for n, _ in LEGAL_EXTRA.values()]
    return [f"{raw} as {name}" for raw, name in (*LEGAL_FILLED.items(), *zip(more, names))]


def _legal_clean(month: str = "2024-08", shift: int = 0) -> str:
    return f"""
select seq, {_list(_legal_columns())},
 t.label as company_type,
 'FR' || siren as id,
 'FRANCE' as country,
 'FR' as country_code,
 case etatAdministratifUniteLegale when 'A' then 'Active' when 'C' then 'Inactive' end
  as company_status,
 case when trancheEffectifsUniteLegale is null then 'NA' else e.label end as EmployeeCount,
 '{month}-01-StockUniteLegale_utf8.csv - insert' as last_modified_by,
 date '{month}-01' as last_modified_date
from ({_legal_kept(shift)}) kept
join {_values(COMPANY_TYPES)} t(code, label) on substring(categorieJuridiqueUniteLegale, 1, 2) = t.code
left join {_values(HEADCOUNTS)} e(code, label) on trancheEffectifsUniteLegale = e.code
where (trancheEffectifsUniteLegale is null or e.code is not null) and siren is not null
"""


def _named(clean: str) -> str:
    return f"select c.*, name_en, name_fr from ({clean}) c join ({NAF_DIM}) d on NAFCategory = d.code"


def _upsert(
    earlier: str,
    newer: str,
    keys: dict[str, str],
    insert_only: dict[str, str],
    updated: dict[str, str],
    relabelled: dict[str, tuple[str, str]] = {},
) -> str:
    """Load ``earlier`` into an empty table, then ``newer`` on top.

    Each argument maps a target column to an expression over the source; the pair
    in ``relabelled`` is what an insert and what an update writes.
    """
    by = ", ".join(keys.values())

    def folded(source: str) -> str:
        first = {**insert_only, **{c: pair[0] for c, pair in relabelled.items()}}
        last = {**updated, **{c: pair[1] for c, pair in relabelled.items()}}
        k = ", ".join(keys)
        return f"""
 select {", ".join(f"f.{c}" for c in keys)}, f.n,
  {_list([f"f.{c} as first_{c}" for c in first] + [f"l.{c} as last_{c}" for c in last])}
 from (select {_list(f"{e} as {c}" for c, e in {**keys, **first}.items())},
   count(*) over (partition by {by}) as n
  from ({source}) s qualify row_number() over (partition by {by} order by seq) = 1) f
 join (select {_list(f"{e} as {c}" for c, e in {**keys, **last}.items())}
  from ({source}) s qualify row_number() over (partition by {by} order by seq desc) = 1) l
 using ({k})"""

    def seen_once(c: str) -> str:
        return f"case when n > 1 then last_{c} else first_{c} end"

    table = [*keys]
    table += [f"first_{c} as {c}" for c in insert_only]
    table += [f"last_{c} as {c}" for c in updated]
    table += [f"{seen_once(c)} as {c}" for c in relabelled]
    merged = [f"coalesce(t.{c}, s.{c}) as {c}" for c in keys]
    merged += [f"case when t.known then t.{c} else first_{c} end as {c}" for c in insert_only]
    merged += [f"case when n is null then t.{c} else last_{c} end as {c}" for c in updated]
    merged += [
        f"case when n is null then t.{c} when t.known then last_{c} else {seen_once(c)} end as {c}"
        for c in relabelled
    ]
    on = " and ".join(f"t.{c} = s.{c}" for c in keys)
    return f"""
with old as (select {_list(table)}, true as known from ({folded(earlier)}) a),
new as ({folded(newer)})
select {_list(merged)} from old t full join new s on {on}
"""


def _part(clean: str, table: str, key: str, condition: str) -> str:
    return f"select * from ({clean}) c where seq {condition} * (select max({key}) from {table})"


GEO_UPDATED = {
    "address_1": "address_line_1",
    "address_2": "address_line_2",
    "town": "AddressMunicipalityLabel",
    "post_code": "AddressPostcode",
    "address_type": "registered_office_type",
    "post_code_formatted": "AddressPostcode",
    "date_last_modified": "date '2024-08-01'",
}
GEO_INSERT_ONLY = {"country": "'France'", "organisation_id": "id"}
GEO_RELABELLED = {"last_modified_by": ("'sirene_etab insert'", "'sirene_etab update'")}
GEO = ({"md5_key": "geo_md5"}, GEO_INSERT_ONLY, GEO_UPDATED, GEO_RELABELLED)

STOCK_ETAB_INSERT_ONLY = {
    c: c
    for c in """
    LastAddressNumber DateOfLastAddressNumber InstitutionAddressID LambertCoordinateX
    LambertCoordinateY id address_line_1 address_line_2 registered_office_type
    """.split()
}
STOCK_ETAB_UPDATED = {
    c: c
    for c in (
        *ETAB_FILLED.values(),
        *(name for name, _ in ETAB_EXTRA.values()),
        *("PeriodNumber", "RegisteredOfficeBool", "geo_md5", "last_modified_by", "last_modified_date"),
    )
    if c != "siret" and c not in STOCK_ETAB_INSERT_ONLY
}
STOCK_LEGAL_INSERT_ONLY = {c: c for c in ("company_type", "id", "company_status", "EmployeeCount")}
STOCK_LEGAL_UPDATED = {
    c: c
    for c in (
        *LEGAL_FILLED.values(),
        *(name for name, _ in LEGAL_EXTRA.values()),
        *("country", "country_code", "last_modified_by", "last_modified_date"),
    )
    if c != "company_number"
}


ETAB_PARTS = (
    _part(_etab_clean("2024-07"), "orders", "o_orderkey", "<= 0.6"),
    _part(_etab_clean(shift=1), "orders", "o_orderkey", "> 0.3"),
)


def _trade_names(raw: str, condition: str) -> str:
    number = "cast(seq % 500 as varchar)"
    return f"""
select seq, siren, case seq % 4 when 0 then 'Société Générale ' || {number} when 1 then 'SOCIETE GENERALE ' || {number}
 when 2 then 'SOCIÉTÉ générale ' || {number} || ' ' when 3 then 'societe generale ' || {number} end as name
from ({_part(raw, "orders", "o_orderkey", condition)}) p"""


def _etab_upsert(*parts) -> str:
    return _upsert(*ETAB_PARTS, *parts)


def _legal_upsert(*parts, named: bool = False) -> str:
    wrap = _named if named else str
    earlier = _part(wrap(_legal_clean("2024-07")), "customer", "c_custkey", "<= 0.7")
    newer = _part(wrap(_legal_clean(shift=1)), "customer", "c_custkey", "> 0.3")
    return _upsert(earlier, newer, *parts)


def _report(dataset: str, raw: str, kept: str) -> str:
    return f"""
select '{dataset}' as dataset, count(*) as rows_before, count_if({kept}) as rows_after,
 round((count(*) - count_if({kept})) / count(*) * 100, 2) as pct_removed
from ({raw}) r"""


TYPED_ETAB = f"""
select seq, siren as company_number, nic as localnic, siret,
 etatAdministratifEtablissement as AdministrativeStatus,
 cast(etablissementSiege as boolean) as RegisteredOfficeBool,
 try_cast({_token_free('nombrePeriodesEtablissement')} as integer) as PeriodNumber,
 nullif({_token_free('complementAdresseEtablissement')}, '') as AddressBuildingBlock,
 numeroVoieEtablissement as AddressNumber,
 {_token_free('indiceRepetitionEtablissement')} as AddressNumberSubUnit,
 typeVoieEtablissement as AddressUniqueIdentifier,
 libelleVoieEtablissement as AddressLabel,
 libelleCommuneEtablissement as AddressMunicipalityLabel,
 codePostalEtablissement as AddressPostcode
from ({ETAB_RAW}) r"""

ETAB_STRINGS = [*ETAB_FILLED, *ETAB_EXTRA, "etablissementSiege", "nombrePeriodesEtablissement"]
CATEGORY = "substring(categorieJuridiqueUniteLegale, 1, 2)"
SHORT_LIST = _values({c: label for c, label in COMPANY_TYPES.items() if c not in ("10", "55")})
STAGED = "seq, siret, id, geo_md5, address_line_1, address_line_2"

ORACLES: dict[str, str] = {
    "scan_csv_permissive": TYPED_ETAB,
    "scan_csv_strict": f"""
select seq, {_list(f"{raw} as {name}" for raw, name in LEGAL_FILLED.items())} from ({LEGAL_RAW}) r""",
    "fragment_roundtrip": f"""
select 'etab' as dataset, seq, company_number, id, AdministrativeStatus, EmployeeCountCategory,
 last_modified_by from ({_etab_clean()}) e
union all
select 'legal', seq, company_number, id, AdministrativeStatus, EmployeeCountCategory,
 last_modified_by from ({_legal_clean()}) l""",
    "fragment_glob_scan": f"select seq, {', '.join(LEGAL_FILLED)} from ({LEGAL_RAW}) r",
    "fragment_split": f"""
select count(*) as total_rows, cast(sum(seq) as bigint) as total_seq,
 cast(0 as bigint) as fragments_over_limit, true as within_limit,
 cast(ceil(count(*) / 2000.0) as bigint) as fragments from ({_etab_clean()}) e""",
    "scan_quoted_lines": f"""
select seq, siret, libelleVoieEtablissement || chr(10) || '"' || seq || '",' || chr(10) || libelleCommuneEtablissement
 as libelleVoieEtablissement, libelleCommuneEtablissement
from ({ETAB_RAW}) r""",
    "cell_errors": f"""
select dataset, "column", rule, count(*) as cells, count(distinct text) as texts, min(text) as least_text from (
 select 'etab' as dataset, 'PeriodNumber' as "column", 'int' as rule, nombrePeriodesEtablissement as text
 from ({ETAB_RAW}) r where {_token_free('nombrePeriodesEtablissement')} is not null
  and try_cast({_token_free('nombrePeriodesEtablissement')} as integer) is null
 union all
 select 'etab', 'siret', 'required', siret from ({ETAB_RAW}) r where siret is null
 union all
 select 'legal', 'company_number', 'identifier', siren from ({LEGAL_RAW}) r where siren is null
 union all
 select 'legal', 'LegalCategory', 'code list', categorieJuridiqueUniteLegale from ({LEGAL_RAW}) r
 where {CATEGORY} is not null and not exists (select 1 from {SHORT_LIST} t(code, label) where t.code = {CATEGORY}))
group by all""",
    "snapshot_label": """
select o_orderkey,
 strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '-StockEtablissement_utf8' as etab_label,
 strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '-StockUniteLegale_utf8.zip' as legal_file,
 year(o_orderdate) || '-' || month(o_orderdate) || '-01' as month_label
from orders""",
    "schema_vintage_union": f"""
select seq, siren as company_number, siret, numeroVoieEtablissement as AddressNumber,
 cast(null as double) as LambertCoordinateX, cast(null as double) as LambertCoordinateY
from ({ETAB_RAW}) a
union all
select seq, siren, siret, null, case when seq % 10 = 0 then null else cast(seq * 1.5 as double) end,
 null
from ({ETAB_RAW}) b""",
    "header_vintages": f"""
select seq, siren as company_number, siret, numeroVoieEtablissement as AddressNumber,
 cast(null as double) as LambertCoordinateX
from ({ETAB_RAW}) a where seq % 6 < 3
union all
select seq, siren, siret, null, case when seq % 10 = 0 then null else cast(seq * 1.5 as double) end
from ({ETAB_RAW}) b where seq % 6 >= 3""",
    "staging_append": f"select {STAGED} from ({ETAB_PARTS[0]}) e union all select {STAGED} from ({ETAB_PARTS[1]}) f",
    "staging_replace": f"select {STAGED} from ({ETAB_PARTS[1]}) e",
    "staging_clear": f"select {STAGED} from ({ETAB_PARTS[1]}) e",
    "rename_etab": f"""
select seq, {_list(f"{raw} as {name}" for raw, name in ETAB_FILLED.items())},
 {_list(f"{raw} as {name}" for raw, (name, _) in ETAB_EXTRA.items())},
 etablissementSiege as RegisteredOfficeBool, nombrePeriodesEtablissement as PeriodNumber
from ({ETAB_RAW}) r""",
    "rename_legal": f"""
select seq, {_list(f"{raw} as {name}" for raw, name in LEGAL_FILLED.items())},
 {_list(f"{raw} as {name}" for raw, (name, _) in LEGAL_EXTRA.items())} from ({LEGAL_RAW}) r""",
    "provenance_columns": f"""
select seq, siret, last_modified_by, last_modified_date from ({_etab_clean()}) e""",
    "geo_projection": f"""
select address_line_1 as address_1, address_line_2 as address_2, AddressMunicipalityLabel as town,
 'France' as country, AddressPostcode as post_code, registered_office_type as address_type,
 id as organisation_id, AddressPostcode as post_code_formatted, geo_md5 as md5_key,
 date '2024-08-01' as date_last_modified, 'sirene_etab insert' as last_modified_by
from ({_etab_clean()}) e""",
    "organisation_projection": f"""
select id, company_number, LegalEntityName as company_name, company_status, country,
 DateCreated as date_formed, company_type, last_modified_by, last_modified_date,
 'FR' as country_code
from ({_legal_clean()}) l""",
    "null_tokens": f"""
select seq, {_list(f"{_token_free(c)} as {c}" for c in ETAB_STRINGS)} from ({ETAB_RAW}) r""",
    "fill_missing": f"""
select seq, {_list(f"coalesce({c}, '') as {c}" for c in ETAB_STRINGS)},
 case when seq % 2 = 0 then null else cast(seq as double) end as LambertCoordinateX
from ({ETAB_RAW}) r""",
    "filter_open_etab": f"""
select seq, siret, etatAdministratifEtablissement from ({ETAB_RAW}) r
where etatAdministratifEtablissement is distinct from 'F'""",
    "filter_named": f"""
select * from ({LEGAL_RAW}) r
where denominationUniteLegale is not null and denominationUniteLegale <> '[ND]'""",
    "filter_category": f"""
select * from ({LEGAL_RAW}) r where categorieJuridiqueUniteLegale <> '0000'
 and substring(categorieJuridiqueUniteLegale, 1, 1) = '5'""",
    "validate_siren": f"""
select * from ({SIREN_RAW}) r where coalesce(length(siren) = 9, false)""",
    "quarantine_siren": f"""
select * from ({SIREN_RAW}) r where not coalesce(length(siren) = 9, false)""",
    "unknown_codes": f"""
select seq, siren, categorieJuridiqueUniteLegale, {CATEGORY} as code from ({LEGAL_RAW}) r
where {CATEGORY} is not null
 and not exists (select 1 from {SHORT_LIST} t(code, label) where t.code = {CATEGORY})""",
    "org_id": f"select seq, 'FR' || siren as id from ({ETAB_RAW}) r",
    "geo_md5": f"""
select seq, md5('FR' || siren || coalesce(codePostalEtablissement, '')) as geo_md5
from ({ETAB_RAW}) r""",
    "address_line_1": f"""
select seq, concat_ws(' ', nullif({_token_free('complementAdresseEtablissement')}, ''),
 nullif({_token_free('numeroVoieEtablissement')}, ''),
 nullif({_token_free('indiceRepetitionEtablissement')}, '')) as address_line_1
from ({ETAB_RAW}) r""",
    "address_line_2": f"""
select seq, concat_ws(' ', nullif(typeVoieEtablissement, ''), nullif(libelleVoieEtablissement, ''))
 as address_line_2
from ({ETAB_RAW}) r""",
    "office_type": f"""
select seq, case when etablissementSiege = 'true' then 'HEAD_OFFICE' else 'SUB_OFFICE' end
 as registered_office_type
from ({ETAB_RAW}) r""",
    "company_status": f"""
select seq, case etatAdministratifUniteLegale when 'A' then 'Active' when 'C' then 'Inactive' end
 as company_status
from ({LEGAL_RAW}) r""",
    "lookup_company_type": f"""
select seq, categorieJuridiqueUniteLegale as LegalCategory, label as company_type
from ({LEGAL_KEPT}) k left join {_values(COMPANY_TYPES)} t(code, label) on {CATEGORY} = code""",
    "lookup_employee_count": f"""
select seq, trancheEffectifsUniteLegale as EmployeeCountCategory,
 case when trancheEffectifsUniteLegale is null then 'NA' else label end as EmployeeCount
from ({LEGAL_KEPT}) k
left join {_values(HEADCOUNTS)} t(code, label) on trancheEffectifsUniteLegale = code""",
    "naf_join": f"""
select NAFCategory as code, id as organisation_id, name_en, name_fr, last_modified_date,
 last_modified_by
from ({_named(_legal_clean())}) l""",
    "naf_join_split": f"""
select seq, company_number, l.code as NAFCategory, d.code, name_en, name_fr
from (select *, case when seq % 3 = 0 then '07' else NAFCategory end as code from ({_legal_clean()}) c) l
join ({NAF_DIM}) d on l.code = d.code""",
    "naf_join_collated": f"""
select seq, company_number,
 case seq % 3 when 0 then 'É' || NAFCategory when 1 then 'e' || NAFCategory else 'E' || NAFCategory || '  ' end
  as NAFCategory,
 'é' || d.code as code, name_en, name_fr
from ({_legal_clean()}) l join ({NAF_DIM}) d on NAFCategory = d.code""",
    "etab_clean": _etab_clean(),
    "legal_clean": _legal_clean(),
    "clean_report": _report("etab", ETAB_RAW, "etatAdministratifEtablissement is distinct from 'F'")
    + " union all "
    + _report(
        "legal",
        LEGAL_RAW,
        "denominationUniteLegale <> '[ND]' and substring(categorieJuridiqueUniteLegale, 1, 1) = '5'",
    ),
    "collapse_by_key": f"""
select geo_md5, count(*) as rows, min(seq) as first_seq, max(seq) as last_seq,
 arg_min_null(id, seq) as first_id, arg_max_null(address_line_1, seq) as last_address_1,
 arg_max_null(address_line_2, seq) as last_address_2
from ({_etab_clean()}) e group by geo_md5""",
    "upsert_geo_location": _etab_upsert(*GEO),
    "upsert_stock_etab": _etab_upsert({"siret": "siret"}, STOCK_ETAB_INSERT_ONLY, STOCK_ETAB_UPDATED),
    "upsert_collated": _upsert(
        _trade_names(_etab_raw(), "<= 0.6"),
        _trade_names(_etab_raw(shift=1), "> 0.3"),
        {"name_folded": "strip_accents(lower(rtrim(name)))"},
        {"name": "name", "first_siren": "siren"},
        {"last_seq": "seq"},
        {"origin": ("'insert'", "'update'")},
    ),
    "upsert_organisation": _legal_upsert(
        {"id": "id"},
        {
            "company_number": "company_number",
            "country": "country",
            "date_formed": "DateCreated",
            "country_code": "'FR'",
        },
        {
            "company_name": "LegalEntityName",
            "company_status": "company_status",
            "company_type": "company_type",
            "last_modified_by": "last_modified_by",
            "last_modified_date": "last_modified_date",
        },
    ),
    "upsert_naf_code": _legal_upsert(
        {"code": "NAFCategory", "organisation_id": "id"},
        {"name_en": "name_en", "name_fr": "name_fr"},
        {},
        {
            "last_modified_date": ("last_modified_date", "date '2024-08-01'"),
            "last_modified_by": ("last_modified_by", "'stock legal pipeline update'"),
        },
        named=True,
    ),
    "upsert_stock_legal": _legal_upsert(
        {"company_number": "company_number"}, STOCK_LEGAL_INSERT_ONLY, STOCK_LEGAL_UPDATED
    ),
    "stream_fragment_upsert": _upsert(f"select * from ({_etab_clean()}) e where false", _etab_clean(), *GEO),
    "stream_published": _upsert(f"select * from ({_etab_clean()}) e where false", _etab_clean(), *GEO),
    "upsert_touched_buckets": _upsert(
        _etab_clean("2024-07"),
        f"""select e.* from ({_etab_clean(shift=1)}) e join orders on o_orderkey = seq
         where o_orderdate >= (select date_trunc('month', max(o_orderdate)) from orders)""",
        {"siret": "siret"},
        STOCK_ETAB_INSERT_ONLY,
        STOCK_ETAB_UPDATED,
    ),
    "compacted_batches": _upsert(f"select * from ({_etab_clean()}) e where false", _etab_clean(), *GEO),
    "late_fragments": _etab_upsert(*GEO),
    "load_establishments": _etab_upsert({"siret": "siret"}, STOCK_ETAB_INSERT_ONLY, STOCK_ETAB_UPDATED),
    "load_legal_units": _legal_upsert(
        {"company_number": "company_number"}, STOCK_LEGAL_INSERT_ONLY, STOCK_LEGAL_UPDATED
    ),
    "monthly_establishment_files": _etab_upsert(
        {"siret": "siret"}, STOCK_ETAB_INSERT_ONLY, STOCK_ETAB_UPDATED
    ),
    "batch_duration_stats": """
select event_type as flow, count(*) as batches,
 cast(sum(cast(value as decimal(18,2))) as double) as total_seconds,
 round(cast(sum(cast(value as decimal(18,2))) as double) / count(value), 2) as mean_seconds
from events group by event_type""",
    "path_basename": r"""
select page_id, case when regexp_matches(url, '.*/([^/]+)$')
 then regexp_extract(url, '.*/([^/]+)$', 1) else url end as basename
from pages""",
}
