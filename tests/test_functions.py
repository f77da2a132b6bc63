"""Hand-written edge rows for expressions, filters, lookups and validation."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from regloom.functions import naming, register
from regloom.functions.codes import COMPANY_TYPES, HEADCOUNTS
from regloom.operators import conform, filters, lookups, report, validate
from regloom.plans import cleaning, targets
from regloom.sources.layouts import ESTABLISHMENTS, LEGAL_UNITS


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


def test_address_lines(spark):
    rows = [(None, "", "[ND]"), (None, "12", ""), ("BAT A", "12", "B"), ("", None, None)]
    line = register.address_line(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, rows, "a string, b string, c string", line) == ["", "12", "BAT A 12 B", ""]
    line = register.address_line(F.col("a"), F.col("b"))
    assert values(spark, [("RUE", None), (None, "X")], "a string, b string", line) == ["RUE", "X"]


def test_location_key(spark):
    key = register.location_key(F.col("id"), F.col("cp"))
    got = values(spark, [("FR1", None), ("FR1", "é1")], "id string, cp string", key)
    assert got == ["34d1cf1496d544eb35e3461a5235f7e9", hashlib.md5("FR1é1".encode()).hexdigest()]


def test_labels(spark):
    office = register.office_type(F.col("v"))
    got = values(spark, [(True,), (False,), (None,)], "v boolean", office)
    assert got == ["HEAD_OFFICE", "SUB_OFFICE", "SUB_OFFICE"]
    status = register.activity_label(F.col("v"))
    assert values(spark, [("A",), ("C",), ("X",), (None,)], "v string", status) == [
        "Active",
        "Inactive",
        None,
        None,
    ]


def test_company_number(spark):
    rows = [("12345678",), ("123456789",), ("",), (None,), ("1234567890",)]
    valid = register.valid_company_number(F.col("n"))
    assert values(spark, rows, "n string", valid) == [False, True, False, False, False]
    df = spark.createDataFrame(rows, "company_number string")
    good, bad = validate.valid_rows(df), validate.quarantined_rows(df)
    assert good.count() + bad.count() == len(rows)
    with pytest.raises(validate.InvalidRows):
        validate.require_none(bad, "length")
    validate.require_none(validate.quarantined_rows(good), "length")


def test_filters(spark):
    df = spark.createDataFrame([("F",), ("A",), (None,), ("",)], "AdministrativeStatus string")
    assert {r[0] for r in filters.open_establishments(df).collect()} == {"A", None, ""}
    df = spark.createDataFrame([("[ND]",), ("X",), (None,), ("",)], "LegalEntityName string")
    assert {r[0] for r in filters.named(df).collect()} == {"X", ""}
    df = spark.createDataFrame([("0000",), ("5499",), ("1000",), (None,), ("5",)], "LegalCategory string")
    assert {r[0] for r in filters.commercial_companies(df).collect()} == {"5499", "5"}


def test_lookups(spark):
    df = spark.createDataFrame(
        [(None, "5499"), ("NN", "5010"), ("null", "9300"), ("99", None), ("0", "10")],
        "EmployeeCountCategory string, LegalCategory string",
    )
    counts = {r[0]: r.EmployeeCount for r in lookups.with_employee_count(df).collect()}
    assert counts == {
        None: "NA",
        "NN": "no number submitted",
        "null": "no number provided",
        "99": None,
        "0": "0 fulltime employees",
    }
    types = {r.LegalCategory: r.company_type for r in lookups.with_company_type(df).collect()}
    assert types == {
        "5499": "SARL (Limited Liability Company)",
        "5010": None,
        "9300": "Foundation",
        None: None,
        "10": "Entrepreneur",
    }
    unknown = lookups.unknown_codes(df, F.col("EmployeeCountCategory"), HEADCOUNTS)
    assert [r.code for r in unknown.collect()] == ["99"]
    unknown = lookups.unknown_codes(df, lookups.type_code(F.col("LegalCategory")), COMPANY_TYPES)
    assert [r.code for r in unknown.collect()] == ["50"]
    assert (len(HEADCOUNTS), len(COMPANY_TYPES)) == (21, 39)


def test_labels_and_names(spark):
    days = [(datetime.date(2024, 8, 17),), (datetime.date(2023, 12, 1),)]
    label = naming.snapshot_label(F.col("d"), "StockUniteLegale", ".zip")
    assert values(spark, days, "d date", label) == [
        "2024-08-01-StockUniteLegale_utf8.zip",
        "2023-12-01-StockUniteLegale_utf8.zip",
    ]
    month = naming.snapshot_month(F.col("d"))
    assert values(spark, days, "d date", month) == ["2024-8-01", "2023-12-01"]
    paths = [("a/b/c.csv",), ("c.csv",), ("a/b/",), ("/x",)]
    base = naming.path_basename(F.col("p"))
    assert values(spark, paths, "p string", base) == ["c.csv", "c.csv", "a/b/", "x"]


def test_missing_values(spark):
    df = spark.createDataFrame([("NN", "[ND]", 1), ("n", "", None)], "a string, b string, n int")
    assert conform.drop_tokens(df).collect() == [(None, None, 1), ("n", "", None)]
    df = spark.createDataFrame(
        [(None, float("nan"), None), ("x", 1.5, 2)], "a string, d double, n int"
    )
    assert conform.fill_missing(df).collect() == [("", None, None), ("x", 1.5, 2)]


def test_dimension_join_is_plain_and_leaves_the_choice_to_spark(spark):
    facts = spark.range(3000).selectExpr(
        "id as seq", "case when id % 3 = 0 then 'hot' else string(id % 50) end as code_used"
    )
    codes = spark.range(40).selectExpr("string(id) as code", "'n' || id as name")
    codes = codes.unionByName(spark.sql("select 'hot' as code, 'n-hot' as name"))
    names = {str(i): f"n{i}" for i in range(40)} | {"hot": "n-hot"}
    used = ["hot" if i % 3 == 0 else str(i % 50) for i in range(3000)]
    expected = sorted((i, u, names[u]) for i, u in enumerate(used) if u in names)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for value, join in ((threshold, "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        try:
            joined = lookups.join_dimension(facts, codes, "code_used", "code")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert join in plan and "Generate" not in plan
            rows = joined.select("seq", "code_used", "name").collect()
            assert sorted(tuple(r) for r in rows) == expected
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_report(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "i int")
    assert report.removal_report(df, F.col("i") > 0).collect() == [(3, 2, 33.33)]
    assert report.removal_report(df.limit(0), F.col("i") > 0).collect() == [(0, 0, None)]
    log = spark.createDataFrame([("a", 1.0), ("a", 2.25), ("b", 0.1)], "flow string, seconds double")
    got = {r.flow: (r.batches, r.total_seconds, r.mean_seconds) for r in report.duration_stats(log).collect()}
    assert got == {"a": (2, 3.25, 1.63), "b": (1, 0.1, 0.1)}


def test_widths(spark):
    assert (len(ESTABLISHMENTS.fields), len(ESTABLISHMENTS.early_headers)) == (53, 48)
    assert len(LEGAL_UNITS.fields) == 34
    as_of = datetime.datetime(2024, 8, 1)
    etab = spark.createDataFrame([("123456789",)], "siren string")
    assert len(cleaning.clean_establishments(etab, "f", as_of).columns) == 60
    legal = spark.createDataFrame(
        [("1", "X", "5499", None, None)],
        "siren string, denominationUniteLegale string, categorieJuridiqueUniteLegale string, "
        "trancheEffectifsUniteLegale string, etatAdministratifUniteLegale string",
    )
    clean = cleaning.clean_legal_units(legal, "f", as_of)
    assert len(clean.columns) == 42 and clean.count() == 1
    assert len(targets.stock_etab().update) == 51 and len(targets.stock_legal().update) == 38


def test_strict_cells_fail_and_lenient_cells_are_null(spark):
    df = spark.createDataFrame([("x",)], "nombrePeriodesEtablissement string")
    assert conform.conform(df, ESTABLISHMENTS, strict=False).first().PeriodNumber is None
    df = spark.createDataFrame([("x",)], "nombrePeriodesUniteLegale string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.conform(df, LEGAL_UNITS, strict=True).collect()
