"""Two monthly runs from CSV files to published tables."""

import os
import subprocess
import sys
from dataclasses import replace
from datetime import datetime

import duckdb
import pytest

from regloom.operators.upsert import upsert
from regloom.operators.validate import InvalidRows
from regloom.plans import inputs, jobs, targets
from regloom.plans.oracles import ORACLES
from regloom.plans.queries import _upsert_etab, _upsert_legal
from regloom.sources import tables
from regloom.streaming import loader
from tests.conftest import TABLES
from tests.test_parity import rows_by_name

ETAB = {
    "2024-07": """siren,siret,etatAdministratifEtablissement,etablissementSiege,numeroVoieEtablissement,typeVoieEtablissement,libelleVoieEtablissement,codePostalEtablissement,libelleCommuneEtablissement
000000001,00000000100001,A,true,1,RUE,ALPHA,01000,BOURG
000000001,00000000100002,A,false,2,RUE,BETA,01000,BOURG
000000002,00000000200001,F,true,3,RUE,GAMMA,75001,PARIS
12345678,00000000300001,A,true,4,RUE,DELTA,75001,PARIS
000000004,00000000400001,,true,[ND],NN,EPSILON,,PARIS
""",
    "2024-08": """siren,siret,etatAdministratifEtablissement,etablissementSiege,numeroVoieEtablissement,typeVoieEtablissement,libelleVoieEtablissement,codePostalEtablissement,libelleCommuneEtablissement,coordonneeLambertAbscisseEtablissement
000000001,00000000100001,A,true,9,RUE,ALPHA,01000,BOURG,1.5
000000005,00000000500001,A,false,5,RUE,ZETA,69001,LYON,[ND]
""",
}
LEGAL = {
    "2024-07": """siren,denominationUniteLegale,categorieJuridiqueUniteLegale,trancheEffectifsUniteLegale,etatAdministratifUniteLegale,activitePrincipaleUniteLegale,dateCreationUniteLegale
000000001,"ALPHA, SA",5505,01,A,62.01Z,2001-01-01
000000002,[ND],5710,NN,A,62.01Z,2002-01-01
000000003,GAMMA,0000,,A,62.01Z,2003-01-01
000000004,DELTA,5010,,A,62.01Z,2004-01-01
000000006,ETA,5499,NN,C,99.99Z,2006-01-01
""",
    "2024-08": """siren,denominationUniteLegale,categorieJuridiqueUniteLegale,trancheEffectifsUniteLegale,etatAdministratifUniteLegale,activitePrincipaleUniteLegale,dateCreationUniteLegale
000000001,ALPHA SE,5800,,C,62.01Z,2001-01-01
""",
}


def test_two_months(spark, tmp_path):
    names = spark.createDataFrame(
        [("62.01Z", "Programming", "Programmation")], "code string, name_en string, name_fr string"
    )
    reports = {}
    for version, month in enumerate(("2024-07", "2024-08"), start=1):
        run = jobs.Run(spark, str(tmp_path / "store"), version, datetime.fromisoformat(f"{month}-01"))
        for kind, text in (("etab", ETAB[month]), ("legal", LEGAL[month])):
            folder = tmp_path / kind / month
            folder.mkdir(parents=True)
            (folder / "a.csv").write_text(text)
        etab, legal = str(tmp_path / "etab" / month), str(tmp_path / "legal" / month)
        reports[month] = (
            jobs.load_establishment_files(run, etab, f"{month}-etab"),
            jobs.load_legal_unit_files(run, legal, names),
        )

    assert reports["2024-07"][0] == {
        "rows_before": 4,
        "rows_after": 3,
        "rows_quarantined": 1,
        "rows_malformed": 0,
        "pct_removed": 25.0,
    }
    assert reports["2024-07"][1] == {
        "rows_before": 5,
        "rows_after": 2,
        "rows_quarantined": 1,
        "pct_removed": 60.0,
    }

    places = {(r.organisation_id, r.post_code): r for r in spark.table("geo_location").collect()}
    assert set(places) == {("FR000000001", "01000"), ("FR000000004", ""), ("FR000000005", "69001")}
    first = places["FR000000001", "01000"]
    assert (first.address_1, first.last_modified_by) == ("9", "sirene_etab update")
    assert first.date_last_modified.isoformat() == "2024-08-01"
    untouched = places["FR000000004", ""]
    assert (untouched.address_1, untouched.address_2) == ("", "EPSILON")
    assert untouched.date_last_modified.isoformat() == "2024-07-01"
    assert places["FR000000005", "69001"].last_modified_by == "sirene_etab insert"

    stock = {r.siret: r for r in spark.table("stock_etab").collect()}
    assert len(stock) == 4
    updated = stock["00000000100001"]
    assert (updated.AddressNumber, updated.address_line_1) == ("9", "1")
    assert (updated.LambertCoordinateX, updated.last_modified_by) == (None, "2024-08-etab - insert")

    companies = {r.id: r for r in spark.table("organisation").collect()}
    assert set(companies) == {"FR000000001", "FR000000006"}
    alpha = companies["FR000000001"]
    assert (alpha.company_name, alpha.company_status) == ("ALPHA SE", "Inactive")
    assert (alpha.company_type, alpha.country) == ("SE (EU Registered Company)", "FRANCE")

    codes = spark.table("naf_code").collect()
    assert [(r.code, r.organisation_id, r.last_modified_by) for r in codes] == [
        ("62.01Z", "FR000000001", "stock legal pipeline update")
    ]
    legal = {r.company_number: r for r in spark.table("stock_legal").collect()}
    assert legal["000000001"].company_type.startswith("SA ")
    assert (legal["000000001"].EmployeeCount, legal["000000001"].EmployeeCountCategory) == ("1-2 employees", None)

    kept_aside = f"{tmp_path}/store/{{}}/version=1/outcome=quarantined"
    broken = spark.read.parquet(kept_aside.format("establishments"))
    assert [r.company_number for r in broken.collect()] == ["12345678"]
    broken = spark.read.parquet(kept_aside.format("legal_units"))
    assert [(r.company_number, r.unknown_codes) for r in broken.collect()] == [
        ("000000004", "company_type")
    ]
    assert legal["000000001"].last_modified_by == "a.csv - insert"
    clean = spark.read.parquet(f"{tmp_path}/store/establishments/version=2/outcome=clean")
    named = upsert(None, clean, targets.geo_location(datetime(2024, 8, 1), name_source=True), "seq")
    assert {r.last_modified_by for r in named.collect()} == {"2024-08-etab - insert"}
    assert spark.table("geo_location_v1").count() == 2

    with pytest.raises(ValueError, match="already has a version"):
        jobs.load_establishment_files(run, etab, "again")
    strict = jobs.Run(spark, str(tmp_path / "store"), 3, datetime(2024, 7, 1), jobs.STOP)
    with pytest.raises(InvalidRows):
        jobs.load_establishment_files(strict, str(tmp_path / "etab" / "2024-07"), "strict")


MONTH = """
import sys
from datetime import datetime
from regloom.plans import jobs, targets
from regloom.session import local_session

store, path, version = sys.argv[1:]
spark = local_session(2, **{"spark.sql.warehouse.dir": store + "/warehouse"})
run = jobs.Run(spark, store, int(version), datetime(2024, int(version), 1))
jobs.load_establishment_files(run, path)
for table in ("stock_etab", "geo_location"):
    print(table, spark.table(table).count())
first = spark.table("stock_etab").where("siret = '00000000100001'").first()
print(first.AddressNumber, first.address_line_1)
"""


def month_in_a_process(store, path, version):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root}
    run = [sys.executable, "-c", MONTH, store, path, str(version)]
    done = subprocess.run(run, env=env, cwd=store, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.split("\n")


def written(tmp_path, month):
    folder = tmp_path / "in" / month
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(ETAB[month])
    return str(folder)


def test_the_next_month_in_another_process_keeps_the_last(tmp_path):
    store = tmp_path / "store"
    store.mkdir()
    july = month_in_a_process(str(store), written(tmp_path, "2024-07"), 7)
    assert {"stock_etab 3", "geo_location 2", "1 1"} <= set(july)
    august = month_in_a_process(str(store), written(tmp_path, "2024-08"), 8)
    # The changed number is updated, the line made from it was written by the insert.
    assert {"stock_etab 4", "geo_location 3", "9 1"} <= set(august)


def test_a_failed_publish_is_repeated_with_the_same_version(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    run = jobs.Run(spark, store, 11, datetime(2024, 7, 1))
    jobs.load_establishment_files(run, written(tmp_path, "2024-07"))
    path = written(tmp_path, "2024-08")
    wrote = []

    def once(*args, **options):
        if wrote:
            raise OSError("the second table fails")
        wrote.append(tables.write_version(*args, **options))

    later = jobs.Run(spark, store, 12, datetime(2024, 8, 1))
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_version", once)
        with pytest.raises(OSError):
            jobs.load_establishment_files(later, path)
    assert spark.table("geo_location").count() == 2
    assert {r.version for r in later.manifest.current(jobs.ESTABLISHMENT_FLOW).values()} == {11}
    jobs.load_establishment_files(later, path)
    assert (spark.table("geo_location").count(), spark.table("stock_etab").count()) == (3, 4)
    with pytest.raises(ValueError, match="already has a version 12"):
        jobs.load_establishment_files(later, path)


def test_files_that_no_manifest_names_stop_a_run(spark, tmp_path):
    store = str(tmp_path / "store")
    spec = targets.stock_etab()
    spark.range(1).write.parquet(tables.version_path(f"{store}/tables", spec.table, 1))
    with pytest.raises(ValueError, match="manifest does not name"):
        jobs.Run(spark, store, 2).current(jobs.ESTABLISHMENT_FLOW, [spec])


def test_establishments_without_a_number_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    text = "siren,siret,etatAdministratifEtablissement\n000000001,,A\n000000002,,A\n000000003,00000000300001,A\n"
    text += "000000004,00000000400001\n000000005,00000000500001,A,more\n"
    (folder / "a.csv").write_text(text)
    run = jobs.Run(spark, str(tmp_path / "store"), 21, datetime(2024, 7, 1))
    report = jobs.load_establishment_files(run, str(folder))
    assert (report["rows_after"], report["rows_quarantined"], report["rows_malformed"]) == (1, 4, 2)
    assert [r.siret for r in spark.table("stock_etab").collect()] == ["00000000300001"]
    aside = spark.read.parquet(f"{tmp_path}/store/establishments/version=21/outcome=quarantined")
    rows = {(r.company_number, r.siret): r.malformed_record for r in aside.collect()}
    assert rows[("000000001", None)] is None and rows[("000000002", None)] is None
    assert rows[("000000004", "00000000400001")] == "000000004,00000000400001"
    assert rows[("000000005", "00000000500001")] == "000000005,00000000500001,A,more"


def swapped(spec, column):
    """The spec with a column moved from the insert-only list to the updates, or back."""
    update = {c: s for c, s in spec.update.items() if c != column}
    return replace(spec, update=update if column in spec.update else {**spec.update, column: spec.insert[column]})


@pytest.mark.parametrize(
    "name,spec,column",
    [
        ("upsert_stock_etab", targets.stock_etab(), "AddressNumber"),
        ("upsert_stock_etab", targets.stock_etab(), "LambertCoordinateX"),
        ("upsert_stock_etab", targets.stock_etab(), "registered_office_type"),
        ("upsert_organisation", targets.organisation(), "company_name"),
        ("upsert_organisation", targets.organisation(), "date_formed"),
        ("upsert_stock_legal", targets.stock_legal(), "LegalAcronym"),
        ("upsert_stock_legal", targets.stock_legal(), "company_status"),
    ],
)
def test_swapping_a_column_between_the_lists_is_noticed(spark, name, spec, column):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    relation = db.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    expected = rows_by_name(names, relation.fetchall())
    load = _upsert_etab if name == "upsert_stock_etab" else _upsert_legal
    result = load(spark, folder, swapped(spec, column))
    if "last_modified_date" in result.columns:
        result = result.withColumn("last_modified_date", result.last_modified_date.cast("date"))
    assert rows_by_name(result.columns, [tuple(r) for r in result.collect()]) != expected


@pytest.mark.parametrize("load,spec", [(_upsert_legal, targets.organisation()), (_upsert_legal, targets.stock_legal())])
def test_merges_of_legal_units_have_one_aggregate_for_each_source(spark, load, spec):
    plan = load(spark, "/root/testdata/sf0.001", spec)._jdf.queryExecution().executedPlan().toString()
    locations = _upsert_etab(spark, "/root/testdata/sf0.001", targets.geo_location(datetime(2024, 8, 1)))
    model = locations._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == model.count("SortAggregate")


def test_a_stream_publishes_and_a_repeat_changes_nothing(spark, tmp_path):
    arrivals, store = str(tmp_path / "in"), str(tmp_path / "store")
    clean = inputs.etab_clean(spark, "/root/testdata/sf0.001")
    schema, intake = clean.schema, loader.Intake(str(tmp_path / "intake"))
    spec = targets.geo_location(datetime(2024, 8, 1))
    low, high = clean.where("seq % 2 = 0"), clean.where("seq % 2 = 1")
    counts, batches = [], []
    for version, part in enumerate((low, None, high), 31):
        if part is not None:
            tables.write_fragments(part, arrivals, rows=100)
        stream = loader.fragment_stream(spark, arrivals, schema, files_per_batch=2)
        run = jobs.Run(spark, store, version, datetime(2024, 8, 1))
        batches.append(jobs.load_fragments(run, "arrivals", stream, [loader.Feed(spec)], intake))
        counts.append(spark.table("geo_location").count())
    assert counts[0] == counts[1] < counts[2] == clean.select("geo_md5").distinct().count()
    assert batches[0] == batches[1] < batches[2]
