"""Line breaks inside quotes in files read in parts, and cells that break a rule."""

import csv
import io
import random
from datetime import datetime

import pytest

from regloom.functions.codes import COMPANY_TYPES
from regloom.operators import cells, conform
from regloom.operators.validate import InvalidRows
from regloom.plans import jobs
from regloom.sources.csv import scan_csv
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS
from regloom.sources.records import parts_inside_quotes, records, scan_quoted, _lines


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def written(path, seed, end, n=60):
    r = random.Random(seed)
    pieces = ["a", "é", '"', "\n", ",", " ", "", "xyz", "\n\n", '""', "漢"]
    text = io.StringIO()
    out = csv.writer(text, lineterminator=end)
    out.writerow(["id", "first name", "v"])
    for i in range(n):
        long = "\n".join("line" * 9 for _ in range(40)) if r.random() < 0.05 else ""
        out.writerow([i, "".join(r.choice(pieces) for _ in range(r.randint(1, 9))) + long, r.choice(["", "z", 'q"q', "w\nw"])])
    path.write_bytes(text.getvalue().encode())


@pytest.fixture
def small_parts(spark):
    names = {"spark.sql.files.maxPartitionBytes": "150b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_parts_give_what_a_whole_read_gives(spark, tmp_path, small_parts, seed, end):
    for n in range(3):
        written(tmp_path / f"f{n}.csv", seed * 10 + n, end)
    path = str(tmp_path)
    assert _lines(spark, path, None).select("file", "block").distinct().count() > 10
    assert parts_inside_quotes(_lines(spark, path, None))
    whole = scan_csv(spark, path, multiline=True)
    found = scan_quoted(spark, path, file_order="o", file_name="n")
    assert found.columns == [*whole.columns, "o", "n"]
    assert rows(found.drop("o", "n")) == rows(whole)
    # Rows keep the order of the file.
    for name in ("f0.csv", "f2.csv"):
        ids = [int(r.id) for r in found.where(found.n == name).orderBy("o").collect()]
        assert ids == list(range(60))


def test_files_without_line_breaks_and_one_left_open(spark, tmp_path, small_parts):
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.csv").write_text("k,v\n" + "".join(f"{i},w{i}\n" for i in range(200)) + "\n\n200,last")
    assert parts_inside_quotes(_lines(spark, str(plain), None)) == set()
    assert rows(scan_quoted(spark, str(plain))) == rows(scan_csv(spark, str(plain)))
    (plain / "b.csv").write_text("k,v\n1,2\n3,\"never\n" + "closed\n" * 100)
    texts = {r.record for r in records(spark, str(plain / "b.csv")).collect()}
    assert texts == {"k,v", "1,2", '3,"never\n' + "\n".join(["closed"] * 100)}
    (plain / "c.csv").write_text("k,w\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        scan_quoted(spark, str(plain))


def test_failed_cells_are_named(spark):
    raw = spark.createDataFrame(
        [(1, "f", "000000001", "x", "1.5"), (2, "f", "12", "3", "y"), (3, "g", None, None, None), (4, "g", "000000002", "7", "2")],
        "row int, file string, siren string, nombrePeriodesEtablissement string, coordonneeLambertAbscisseEtablissement string",
    )
    rules = [cells.identifier_rule(ESTABLISHMENTS, "company_number"), *cells.type_rules(ESTABLISHMENTS, raw.columns)]
    marked = cells.with_failed_cells(raw, rules)
    found = {r.row: [tuple(c) for c in r.failed_cells] for r in marked.collect()}
    assert found == {
        1: [("PeriodNumber", "x", "int")],
        2: [("company_number", "12", "identifier"), ("LambertCoordinateX", "y", "double")],
        3: [("company_number", None, "identifier")],
        4: [],
    }
    report = {(r.file, r.column): (r.rule, r.cells, r.texts, r.least_text) for r in cells.failure_report(marked, "file").collect()}
    assert report["f", "PeriodNumber"] == ("int", 1, 1, "x") and report["g", "company_number"] == ("identifier", 1, 0, None)
    assert cells.first_failure(marked, "row", "file") == "file f: column PeriodNumber has 'x', which breaks the rule int"
    assert cells.first_failure(marked.where("row = 4"), "row") is None
    typed = conform.conform(marked, ESTABLISHMENTS, strict=False, keep=[cells.FAILED])
    assert [r.PeriodNumber for r in typed.orderBy("company_number").collect()] == [None, None, 7, 3]
    assert cells.with_failed_cells(raw, []).where("size(failed_cells) > 0").isEmpty()


def test_codes_outside_a_list(spark):
    raw = spark.createDataFrame([("5499",), ("x100",), (None,), ("5",)], "categorieJuridiqueUniteLegale string")
    rule = cells.code_rule(LEGAL_UNITS, "LegalCategory", COMPANY_TYPES, prefix=True)
    found = [[c.text for c in r.failed_cells] for r in cells.with_failed_cells(raw, [rule]).collect()]
    assert found == [[], ["x100"], [], ["5"]]


def test_a_strict_run_names_the_cell_it_stops_at(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = "siren,denominationUniteLegale,categorieJuridiqueUniteLegale,trancheEffectifsUniteLegale,etatAdministratifUniteLegale,activitePrincipaleUniteLegale,dateCreationUniteLegale,nombrePeriodesUniteLegale\n"
    (folder / "a.csv").write_text(head + "000000001,ALPHA,5505,01,A,62.01Z,2001-01-01,1\n000000002,BETA,5505,01,A,62.01Z,2001-01-01,one\n")
    names = spark.createDataFrame([("62.01Z", "P", "P")], "code string, name_en string, name_fr string")
    run = jobs.Run(spark, str(tmp_path / "store"), 1, datetime(2024, 7, 1))
    with pytest.raises(InvalidRows, match="a.csv: column .* has 'one', which breaks the rule int"):
        jobs.load_legal_unit_files(run, str(folder), names)
