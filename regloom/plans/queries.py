"""The registered queries: every operator over the derived register inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.functions import naming, register
from regloom.functions.codes import COMPANY_TYPES
from regloom.operators import cells, collation, conform, filters, lookups, report, validate
from regloom.operators.upsert import Constant, Upsert, apply_changes, collapse, upsert
from regloom.plans import cleaning, inputs, jobs, loading, targets
from regloom.plans.inputs import AS_OF, BEFORE, ETAB_FILE, ETAB_FILE_BEFORE, LEGAL_FILE, LEGAL_FILE_BEFORE
from regloom.session import WIDE_ROWS, scratch_path, with_settings
from regloom.sources import csv, tables
from regloom.sources.buckets import BucketStore
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS
from regloom.sources.records import scan_quoted
from regloom.streaming import loader

Query = Callable[[SparkSession, str], DataFrame]
TODAY = AS_OF.date()

def _dated(df: DataFrame) -> DataFrame:
    """Modification times as dates, which read the same in every engine."""
    return df.withColumn("last_modified_date", F.to_date("last_modified_date"))


# Scans and sinks


def scan_csv_permissive(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan-permissive")
    csv.write_csv(inputs.etab_raw(spark, folder), path)
    raw = conform.drop_tokens(csv.scan_csv(spark, path))
    typed = conform.conform(raw, ESTABLISHMENTS, strict=False, keep=["seq"])
    columns = ["company_number", "localnic", "siret", "AdministrativeStatus", "RegisteredOfficeBool"]
    columns += ["PeriodNumber", "AddressBuildingBlock", "AddressNumber", "AddressNumberSubUnit"]
    columns += ["AddressUniqueIdentifier", "AddressLabel", "AddressMunicipalityLabel", "AddressPostcode"]
    return typed.select(F.col("seq").cast("bigint").alias("seq"), *columns)


def scan_quoted_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Establishments with line breaks and quotes in their addresses, read in parts."""
    path = scratch_path(spark, "scan-quoted")
    address = F.concat("libelleVoieEtablissement", F.lit('\n"'), F.col("seq").cast("string"), F.lit('",\n'), "libelleCommuneEtablissement")
    csv.write_csv(inputs.etab_raw(spark, folder).withColumn("libelleVoieEtablissement", address), path)
    read = scan_quoted(spark, path)
    return read.select(F.col("seq").cast("bigint").alias("seq"), "siret", "libelleVoieEtablissement", "libelleCommuneEtablissement")


def cell_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that break a rule, counted by snapshot, column and rule."""
    etab, legal = conform.drop_tokens(inputs.etab_raw(spark, folder)), inputs.legal_raw(spark, folder)
    short = {c: label for c, label in COMPANY_TYPES.items() if c not in ("10", "55")}
    rules = (
        (etab, [*cells.type_rules(ESTABLISHMENTS, etab.columns), cells.required_rule(ESTABLISHMENTS, "siret")]),
        (legal, [cells.identifier_rule(LEGAL_UNITS, "company_number"), cells.code_rule(LEGAL_UNITS, "LegalCategory", short, prefix=True)]),
    )
    names = ("etab", "legal")
    marked = [cells.with_failed_cells(raw, r).select(F.lit(n).alias("dataset"), cells.FAILED) for n, (raw, r) in zip(names, rules)]
    return cells.failure_report(marked[0].unionByName(marked[1]), "dataset")


def scan_csv_strict(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan-strict")
    csv.write_csv(inputs.legal_raw(spark, folder), path)
    raw = csv.scan_csv(spark, path, mode="FAILFAST")
    typed = conform.conform(raw, LEGAL_UNITS, strict=True, keep=["seq"])
    columns = ["company_number", "LegalEntityName", "LegalCategory", "EmployeeCountCategory"]
    columns += ["AdministrativeStatus", "NAFCategory", "DateCreated"]
    return typed.select(F.col("seq").cast("bigint").alias("seq"), *columns)


def fragment_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    etab, legal = scratch_path(spark, "clean-etab"), scratch_path(spark, "clean-legal")
    inputs.etab_clean(spark, folder).write.parquet(etab)
    inputs.legal_clean(spark, folder).write.parquet(legal)
    shared = ["seq", "company_number", "id", "AdministrativeStatus", "EmployeeCountCategory"]
    shared += ["last_modified_by"]
    return (
        spark.read.parquet(etab)
        .select(F.lit("etab").alias("dataset"), *shared)
        .unionByName(spark.read.parquet(legal).select(F.lit("legal").alias("dataset"), *shared))
    )


def fragment_glob_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "fragments")
    for layout, raw in (
        (ESTABLISHMENTS, inputs.etab_raw(spark, folder)),
        (LEGAL_UNITS, inputs.legal_raw(spark, folder)),
    ):
        tables.write_fragments(raw, path, name=f"{layout.dataset}_clean", file_format="csv")
    scan = csv.scan_csv(spark, path, name_glob="*Legal*")
    return scan.select(F.col("seq").cast("bigint").alias("seq"), *LEGAL_RAW_STRINGS)


LEGAL_RAW_STRINGS = [
    "siren",
    "denominationUniteLegale",
    "categorieJuridiqueUniteLegale",
    "trancheEffectifsUniteLegale",
    "etatAdministratifUniteLegale",
    "activitePrincipaleUniteLegale",
    "dateCreationUniteLegale",
]


# Rows in a fragment and fragments in a batch, so that small inputs have several of both.
FRAGMENT_ROWS, FILES_PER_BATCH = 2_000, 8

# Streams that take in fragments side by side, each in batches of its own.
LANES = 5


def fragment_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after the split into full fragments, fragments, and those beyond the limit (none)."""
    path, staged = scratch_path(spark, "split"), scratch_path(spark, "unsplit")
    tables.write_full_fragments(inputs.etab_clean(spark, folder), path, FRAGMENT_ROWS, staged)
    per_file = (
        spark.read.parquet(path)
        .select("seq", F.col("_metadata.file_path").alias("file"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seqs"))
    )
    return per_file.agg(
        F.sum("rows").alias("total_rows"),
        F.sum("seqs").alias("total_seq"),
        F.count_if(F.col("rows") > FRAGMENT_ROWS).alias("fragments_over_limit"),
        (F.max("rows") <= FRAGMENT_ROWS).alias("within_limit"),
        F.count(F.lit(1)).alias("fragments"),
    )


def staging_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    earlier, newer = inputs.etab_snapshots(spark, folder)
    tables.append_staging(_staged(earlier), path)
    tables.append_staging(_staged(newer), path)
    return spark.read.parquet(path)


def staging_replace(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    earlier, newer = inputs.etab_snapshots(spark, folder)
    tables.append_staging(_staged(earlier), path)
    tables.replace_staging(_staged(newer), path)
    return spark.read.parquet(path)


def staging_clear(spark: SparkSession, folder: str) -> DataFrame:
    """What is appended after the staging table was emptied."""
    path = scratch_path(spark, "staging")
    earlier, newer = inputs.etab_snapshots(spark, folder)
    tables.append_staging(_staged(earlier), path)
    tables.clear_staging(spark, path)
    tables.append_staging(_staged(newer), path)
    return spark.read.parquet(path)


def _staged(raw: DataFrame) -> DataFrame:
    return cleaning.clean_establishments(raw, ETAB_FILE, AS_OF, keep=["seq"]).select(*STAGED)


STAGED = ["seq", "siret", "id", "geo_md5", "address_line_1", "address_line_2"]


def snapshot_label(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    return inputs.table(spark, folder, "orders").select(
        "o_orderkey",
        naming.snapshot_label(day, "StockEtablissement").alias("etab_label"),
        naming.snapshot_label(day, "StockUniteLegale", ".zip").alias("legal_file"),
        naming.snapshot_month(day).alias("month_label"),
    )


def schema_vintage_union(spark: SparkSession, folder: str) -> DataFrame:
    early, late = scratch_path(spark, "vintage-48"), scratch_path(spark, "vintage-53")
    csv.write_csv(inputs.etab_raw_early(spark, folder), early)
    csv.write_csv(inputs.etab_raw_late(spark, folder), late)
    raw = conform.drop_tokens(csv.scan_csv(spark, [early, late]))
    typed = conform.conform(raw, ESTABLISHMENTS, strict=False, keep=["seq"])
    return typed.select(
        F.col("seq").cast("bigint").alias("seq"),
        "company_number",
        "siret",
        "AddressNumber",
        "LambertCoordinateX",
        "LambertCoordinateY",
    )


MONTHS = 6


def header_vintages(spark: SparkSession, folder: str) -> DataFrame:
    """Six monthly folders, three of each header vintage, whose headers are read in one job."""
    base, month = scratch_path(spark, "months"), F.col("seq") % MONTHS
    early, late = inputs.etab_raw_early(spark, folder), inputs.etab_raw_late(spark, folder)
    csv.write_csv(early.where(month < MONTHS // 2).withColumn("month", month), base, partition="month")
    csv.write_csv(late.where(month >= MONTHS // 2).withColumn("month", month), base, mode="append", partition="month")
    raw = conform.drop_tokens(csv.scan_csv(spark, [f"{base}/month={m}" for m in range(MONTHS)]))
    typed = conform.conform(raw, ESTABLISHMENTS, strict=False, keep=["seq"])
    columns = ["company_number", "siret", "AddressNumber", "LambertCoordinateX"]
    return typed.select(F.col("seq").cast("bigint").alias("seq"), *columns)


def path_basename(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "pages").select(
        "page_id", naming.path_basename(F.col("url")).alias("basename")
    )


# Projections


def rename_etab(spark: SparkSession, folder: str) -> DataFrame:
    return conform.rename_headers(inputs.etab_raw(spark, folder), ESTABLISHMENTS)


def rename_legal(spark: SparkSession, folder: str) -> DataFrame:
    return conform.rename_headers(inputs.legal_raw(spark, folder), LEGAL_UNITS)


def provenance_columns(spark: SparkSession, folder: str) -> DataFrame:
    clean = inputs.etab_clean(spark, folder).select("seq", "siret")
    return _dated(cleaning.with_provenance(clean, ETAB_FILE, AS_OF))


def geo_projection(spark: SparkSession, folder: str) -> DataFrame:
    return loading.location_rows(inputs.etab_clean(spark, folder), TODAY)


def organisation_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(loading.organisation_rows(inputs.legal_clean(spark, folder)))


def naf_join(spark: SparkSession, folder: str) -> DataFrame:
    translations = inputs.naf_translations(spark, folder)
    rows = loading.activity_rows(inputs.legal_clean(spark, folder), translations, TODAY)
    return _dated(rows)


def naf_join_split(spark: SparkSession, folder: str) -> DataFrame:
    """Activity names where one code holds a third of the legal units."""
    clean = inputs.legal_clean(spark, folder).select("seq", "company_number", "NAFCategory")
    facts = clean.withColumn("NAFCategory", F.expr("case when seq % 3 = 0 then '07' else NAFCategory end"))
    return lookups.join_dimension_split(facts, inputs.naf_translations(spark, folder), "NAFCategory", "code")


def naf_join_collated(spark: SparkSession, folder: str) -> DataFrame:
    """Activity names by codes that differ in case, accents and spaces at the end."""
    code = "case seq % 3 when 0 then 'É' || NAFCategory when 1 then 'e' || NAFCategory else 'E' || NAFCategory || '  ' end"
    facts = inputs.legal_clean(spark, folder).selectExpr("seq", "company_number", f"{code} as NAFCategory")
    names = inputs.naf_translations(spark, folder).selectExpr("'é' || code as code", "name_en", "name_fr")
    return collation.join_collated(facts, names, "NAFCategory", "code", "ci_ai")


# Missing values, filters and validation


def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return conform.drop_tokens(inputs.etab_raw(spark, folder))


def fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    even = F.col("seq") % 2 == 0
    numbers = F.when(even, F.lit(float("nan"))).otherwise(F.col("seq").cast("double"))
    raw = inputs.etab_raw(spark, folder).withColumn("LambertCoordinateX", numbers)
    return conform.fill_missing(raw)


def filter_open_etab(spark: SparkSession, folder: str) -> DataFrame:
    raw = inputs.etab_raw(spark, folder)
    kept = filters.open_establishments(raw, "etatAdministratifEtablissement")
    return kept.select("seq", "siret", "etatAdministratifEtablissement")


def filter_named(spark: SparkSession, folder: str) -> DataFrame:
    return filters.named(inputs.legal_raw(spark, folder), "denominationUniteLegale")


def filter_category(spark: SparkSession, folder: str) -> DataFrame:
    raw = inputs.legal_raw(spark, folder)
    return filters.commercial_companies(raw, "categorieJuridiqueUniteLegale")


def validate_siren(spark: SparkSession, folder: str) -> DataFrame:
    return validate.valid_rows(inputs.siren_raw(spark, folder), "siren")


def quarantine_siren(spark: SparkSession, folder: str) -> DataFrame:
    return validate.quarantined_rows(inputs.siren_raw(spark, folder), "siren")


def unknown_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Categories outside a list that lacks entrepreneurs and one company type."""
    shortened = {c: label for c, label in COMPANY_TYPES.items() if c not in ("10", "55")}
    category = "categorieJuridiqueUniteLegale"
    raw = inputs.legal_raw(spark, folder).select("seq", "siren", category)
    return lookups.unknown_codes(raw, lookups.type_code(F.col(category)), shortened)


# Scalar functions


def org_id(spark: SparkSession, folder: str) -> DataFrame:
    raw = inputs.etab_raw(spark, folder)
    return raw.select("seq", register.organisation_id(F.col("siren")).alias("id"))


def geo_md5(spark: SparkSession, folder: str) -> DataFrame:
    key = register.location_key(
        register.organisation_id(F.col("siren")), F.col("codePostalEtablissement")
    )
    return inputs.etab_raw(spark, folder).select("seq", key.alias("geo_md5"))


def address_line_1(spark: SparkSession, folder: str) -> DataFrame:
    line = register.address_line(
        F.col("complementAdresseEtablissement"),
        F.col("numeroVoieEtablissement"),
        F.col("indiceRepetitionEtablissement"),
    )
    raw = conform.drop_tokens(inputs.etab_raw(spark, folder))
    return raw.select("seq", line.alias("address_line_1"))


def address_line_2(spark: SparkSession, folder: str) -> DataFrame:
    line = register.address_line(F.col("typeVoieEtablissement"), F.col("libelleVoieEtablissement"))
    return inputs.etab_raw(spark, folder).select("seq", line.alias("address_line_2"))


def office_type(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("etablissementSiege").try_cast("boolean")
    return inputs.etab_raw(spark, folder).select(
        "seq", register.office_type(flag).alias("registered_office_type")
    )


def company_status(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("etatAdministratifUniteLegale")
    return inputs.legal_raw(spark, folder).select(
        "seq", register.activity_label(status).alias("company_status")
    )


def lookup_company_type(spark: SparkSession, folder: str) -> DataFrame:
    kept = cleaning.kept_legal_units(inputs.legal_raw(spark, folder), ["seq"])
    return lookups.with_company_type(kept).select("seq", "LegalCategory", "company_type")


def lookup_employee_count(spark: SparkSession, folder: str) -> DataFrame:
    kept = cleaning.kept_legal_units(inputs.legal_raw(spark, folder), ["seq"])
    labelled = lookups.with_employee_count(kept)
    return labelled.select("seq", "EmployeeCountCategory", "EmployeeCount")


# Composite cleaning and reports


def etab_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(inputs.etab_clean(spark, folder))


def legal_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(inputs.legal_clean(spark, folder))


def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    etab, legal = inputs.etab_raw(spark, folder), inputs.legal_raw(spark, folder)
    is_open = filters.is_open(F.col("etatAdministratifEtablissement"))
    company = filters.is_named(F.col("denominationUniteLegale")) & filters.is_commercial(
        F.col("categorieJuridiqueUniteLegale")
    )
    return (
        report.removal_report(etab, is_open)
        .withColumn("dataset", F.lit("etab"))
        .unionByName(report.removal_report(legal, company).withColumn("dataset", F.lit("legal")))
    )


def batch_duration_stats(spark: SparkSession, folder: str) -> DataFrame:
    return report.duration_stats(inputs.batch_durations(spark, folder))


# Upserts


def collapse_by_key(spark: SparkSession, folder: str) -> DataFrame:
    clean = inputs.etab_clean(spark, folder)
    changes = collapse(clean, targets.geo_location(TODAY), "seq")
    return changes.select(
        F.col("md5_key").alias("geo_md5"),
        F.col("_rows").alias("rows"),
        F.col("_first_seq").alias("first_seq"),
        F.col("_last_seq").alias("last_seq"),
        F.col("_first_organisation_id").alias("first_id"),
        F.col("_last_address_1").alias("last_address_1"),
        F.col("_last_address_2").alias("last_address_2"),
    )


def _upsert_etab(spark: SparkSession, folder: str, spec: Upsert) -> DataFrame:
    earlier, newer = inputs.etab_snapshots(spark, folder)
    old = cleaning.clean_establishments(earlier, ETAB_FILE_BEFORE, BEFORE, keep=["seq"])
    new = cleaning.clean_establishments(newer, ETAB_FILE, AS_OF, keep=["seq"])
    return upsert(upsert(None, old, spec, "seq"), new, spec, "seq")


def upsert_geo_location(spark: SparkSession, folder: str) -> DataFrame:
    return _upsert_etab(spark, folder, targets.geo_location(TODAY))


def upsert_stock_etab(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(_upsert_etab(spark, folder, targets.stock_etab()))


def _upsert_legal(spark: SparkSession, folder: str, spec: Upsert, named: bool = False) -> DataFrame:
    earlier, newer = inputs.legal_snapshots(spark, folder)
    old = cleaning.clean_legal_units(earlier, LEGAL_FILE_BEFORE, BEFORE, keep=["seq"])
    new = cleaning.clean_legal_units(newer, LEGAL_FILE, AS_OF, keep=["seq"])
    if named:
        translations = inputs.naf_translations(spark, folder)
        old, new = (loading.with_activity_names(clean, translations) for clean in (old, new))
    return _dated(upsert(upsert(None, old, spec, "seq"), new, spec, "seq"))


def upsert_organisation(spark: SparkSession, folder: str) -> DataFrame:
    return _upsert_legal(spark, folder, targets.organisation())


def upsert_naf_code(spark: SparkSession, folder: str) -> DataFrame:
    return _upsert_legal(spark, folder, targets.naf_code(TODAY), named=True)


TRADE_NAMES = Upsert(
    "trade_name",
    keys=("name",),
    insert={"name": "name", "first_siren": "siren", "last_seq": "seq", "origin": Constant.text("insert")},
    update={"last_seq": "seq", "origin": Constant.text("update")},
)


def upsert_collated(spark: SparkSession, folder: str) -> DataFrame:
    """Trade names, some hundred rows each, in spellings that differ in case, accents and spaces."""
    number = "string(seq % 500)"
    name = (
        f"case seq % 4 when 0 then 'Société Générale ' || {number} when 1 then 'SOCIETE GENERALE ' || {number}"
        f" when 2 then 'SOCIÉTÉ générale ' || {number} || ' ' when 3 then 'societe generale ' || {number} end"
    )
    spec, parts = collation.collated(TRADE_NAMES), inputs.etab_snapshots(spark, folder)
    old, new = (
        collation.with_folded_keys(p.selectExpr("seq", "siren", f"{name} as name"), TRADE_NAMES, "ci_ai") for p in parts
    )
    return upsert(upsert(None, old, spec, "seq"), new, spec, "seq")


def upsert_stock_legal(spark: SparkSession, folder: str) -> DataFrame:
    return _upsert_legal(spark, folder, targets.stock_legal())


def load_establishments(spark: SparkSession, folder: str) -> DataFrame:
    """Stock of establishments after two months of the load, each on top of the last."""
    earlier, newer = inputs.etab_snapshots(spark, folder)
    months = ((earlier, ETAB_FILE_BEFORE, BEFORE), (newer, ETAB_FILE, AS_OF))
    current: dict[str, DataFrame | None] = {}
    for raw, file, as_of in months:
        clean = cleaning.clean_establishments(raw, file, as_of, keep=["seq"])
        current = loading.load_establishments(clean, current, as_of.date())
    return _dated(current["stock_etab"])


def load_legal_units(spark: SparkSession, folder: str) -> DataFrame:
    """Stock of legal units after two months of the load, each on top of the last."""
    earlier, newer = inputs.legal_snapshots(spark, folder)
    months = ((earlier, LEGAL_FILE_BEFORE, BEFORE), (newer, LEGAL_FILE, AS_OF))
    names, current = inputs.naf_translations(spark, folder), {}
    for raw, file, as_of in months:
        clean = cleaning.clean_legal_units(raw, file, as_of, keep=["seq"])
        current = loading.load_legal_units(clean, names, current, as_of.date())
    return _dated(current["stock_legal"])


def monthly_establishment_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stock of establishments after two monthly runs over files, through the manifest."""
    store, files = scratch_path(spark, "store"), scratch_path(spark, "files")
    months = ((ETAB_FILE_BEFORE, BEFORE), (ETAB_FILE, AS_OF))
    for version, (raw, (file, as_of)) in enumerate(zip(inputs.etab_snapshots(spark, folder), months), 1):
        csv.write_csv(raw.drop("seq"), f"{files}/{version}")
        run = jobs.Run(spark, store, version, as_of)
        jobs.load_establishment_files(run, f"{files}/{version}", file)
    specs = (targets.geo_location(TODAY), targets.stock_etab())
    after = jobs.Run(spark, store, len(months) + 1, AS_OF)
    return _dated(after.current(jobs.ESTABLISHMENT_FLOW, specs)["stock_etab"])


def _arrivals(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "arrivals")
    with with_settings(spark, WIDE_ROWS):
        tables.write_fragments(inputs.etab_clean(spark, folder), path, rows=FRAGMENT_ROWS)
    return path


def _lanes(spark: SparkSession, path: str, schema: T.StructType, when_done: str = "off") -> list[DataFrame]:
    return [
        loader.fragment_stream(
            spark, path, schema, name_glob=glob, files_per_batch=FILES_PER_BATCH, when_done=when_done
        )
        for glob in loader.lane_globs(LANES)
    ]


def stream_fragment_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Establishments arriving as fragments, taken in by micro-batches and merged."""
    path = _arrivals(spark, folder)
    schema = spark.read.parquet(path).schema
    spec, intake = targets.geo_location(TODAY), loader.Intake(scratch_path(spark, "intake"))
    loader.take_in_lanes(_lanes(spark, path, schema), [loader.Feed(spec)], intake, "seq")
    return loader.merged(spark, None, spec, intake.lanes(LANES), [-1] * LANES)


def stream_published(spark: SparkSession, folder: str) -> DataFrame:
    """The same into a published table; the second run finds nothing new and changes nothing.

    Fragments are deleted once they are taken in.
    """
    path = _arrivals(spark, folder)
    schema = spark.read.parquet(path).schema
    store, intake = scratch_path(spark, "store"), loader.Intake(scratch_path(spark, "intake"))
    spec, flow = targets.geo_location(TODAY), "arrivals"
    for version in (1, 2):
        streams = _lanes(spark, path, schema, when_done="delete")
        run = jobs.Run(spark, store, version, AS_OF)
        jobs.load_fragments(run, flow, streams, [loader.Feed(spec)], intake)
    return jobs.Run(spark, store, 3, AS_OF).current(flow, [spec])[spec.table]


# Buckets of the tables that are merged by touched buckets.
BUCKETS = 64


def upsert_touched_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Stock of establishments after a merge of the last month's, about a hundredth of all.

    Only buckets with one of their keys are read and written again.
    """
    orders = inputs.table(spark, folder, "orders").select(F.col("o_orderkey").alias("seq"), "o_orderdate")
    month = F.date_trunc("month", orders.agg(F.max("o_orderdate")).scalar())
    recent = orders.where(F.col("o_orderdate") >= month).select("seq")
    old = cleaning.clean_establishments(inputs.etab_raw(spark, folder), ETAB_FILE_BEFORE, BEFORE, keep=["seq"])
    new = cleaning.clean_establishments(inputs.etab_raw(spark, folder, shift=1), ETAB_FILE, AS_OF, keep=["seq"])
    spec, store = targets.stock_etab(), BucketStore(spark, scratch_path(spark, "store"), jobs.ESTABLISHMENT_FLOW)
    for rows in (old, new.join(recent, "seq", "left_semi")):
        store.merge(
            {spec.table: collapse(rows, spec, "seq")},
            {spec.table: spec.keys},
            {spec.table: lambda before, changes: apply_changes(before, changes, spec)},
            buckets=BUCKETS,
        )
    return _dated(store.read(spec.table))


#: Batches that arrive before one publish.
BATCHES = 11


def compacted_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Establishments from many small batches, compacted into runs as they come, then merged."""
    path = scratch_path(spark, "arrivals")
    with with_settings(spark, WIDE_ROWS):
        inputs.etab_clean(spark, folder).repartition(BATCHES, "seq").write.parquet(path)
    spec, intake = targets.geo_location(TODAY), loader.Intake(scratch_path(spark, "intake"))
    stream = loader.fragment_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    store = BucketStore(spark, scratch_path(spark, "store"), "arrivals")
    jobs.merge_fragments(store, stream, [loader.Feed(spec)], intake, "seq", BUCKETS)
    return jobs.merged_table(store, spec)


def late_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Locations after fragments of two months in the wrong order, the newer of them twice."""
    snapshots = zip(inputs.etab_snapshots(spark, folder), ((ETAB_FILE_BEFORE, BEFORE), (ETAB_FILE, AS_OF)))
    months = [cleaning.clean_establishments(raw, *source, keep=["seq"]) for raw, source in snapshots]
    # The position of a row: the month, then its place in it.
    earlier, newer = (rows.withColumn("seq", F.struct(F.lit(n).alias("month"), "seq")) for n, rows in enumerate(months))
    path, spec = scratch_path(spark, "arrivals"), targets.geo_location(TODAY)
    store, intake = BucketStore(spark, scratch_path(spark, "store"), "arrivals"), loader.Intake(scratch_path(spark, "intake"))
    for rows in (newer, earlier, newer):
        with with_settings(spark, WIDE_ROWS):
            rows.write.mode("append").parquet(path)
        stream = loader.fragment_stream(spark, path, newer.schema, files_per_batch=1000)
        jobs.merge_fragments(store, stream, [loader.Feed(spec)], intake, "seq", BUCKETS)
    return jobs.merged_table(store, spec)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        upsert_geo_location,
        scan_csv_permissive,
        scan_csv_strict,
        scan_quoted_lines,
        cell_errors,
        fragment_roundtrip,
        fragment_glob_scan,
        fragment_split,
        snapshot_label,
        schema_vintage_union,
        header_vintages,
        staging_append,
        staging_replace,
        staging_clear,
        rename_etab,
        rename_legal,
        provenance_columns,
        geo_projection,
        organisation_projection,
        null_tokens,
        fill_missing,
        filter_open_etab,
        filter_named,
        filter_category,
        validate_siren,
        quarantine_siren,
        unknown_codes,
        org_id,
        geo_md5,
        address_line_1,
        address_line_2,
        office_type,
        company_status,
        lookup_company_type,
        lookup_employee_count,
        naf_join,
        naf_join_split,
        naf_join_collated,
        etab_clean,
        legal_clean,
        clean_report,
        collapse_by_key,
        upsert_stock_etab,
        upsert_organisation,
        upsert_naf_code,
        upsert_stock_legal,
        upsert_collated,
        load_establishments,
        load_legal_units,
        monthly_establishment_files,
        stream_fragment_upsert,
        stream_published,
        upsert_touched_buckets,
        compacted_batches,
        late_fragments,
        batch_duration_stats,
        path_basename,
    )
}
