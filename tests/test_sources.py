"""CSV scans, fragments, staging and published versions."""

import os

import pytest
from pyspark.sql import functions as F

from regloom.operators import conform
from regloom.operators.upsert import Constant, Upsert, upsert
from regloom.sources import csv, tables
from regloom.sources.layouts import ESTABLISHMENTS

EDGE_ROWS = '''siren,nom,cp,flag,n
005520135,"LE ""BON"" COIN, SA",01000,true,NN
123456789,[ND],,false,3
987654321,café,"",true,
'''


def write_text(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_edge_rows(spark, tmp_path):
    path = write_text(tmp_path / "in", "a.csv", EDGE_ROWS)
    raw = csv.scan_csv(spark, path)
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    rows = {r.siren: r for r in conform.drop_tokens(raw).collect()}
    assert rows["005520135"].nom == 'LE "BON" COIN, SA' and rows["005520135"].cp == "01000"
    assert rows["005520135"].n is None and rows["123456789"].nom is None
    assert (rows["123456789"].cp, rows["987654321"].cp, rows["987654321"].n) == (None, None, None)
    assert rows["987654321"].nom == "café"
    assert {r.nom for r in raw.collect()} >= {"[ND]"}


def test_failfast_stops_on_a_malformed_record(spark, tmp_path):
    path = write_text(tmp_path / "in", "a.csv", "a,b\n1,2\n3\n")
    assert csv.scan_csv(spark, path).count() == 2
    with pytest.raises(Exception, match="MALFORMED"):
        csv.scan_csv(spark, path, mode="FAILFAST").collect()


def test_vintages_become_one_scan_each(spark, tmp_path):
    early = write_text(tmp_path / "m1", "a.csv", "siren,siret\n1,10\n")
    again = write_text(tmp_path / "m2", "a.csv", "siren,siret\n2,20\n")
    late = write_text(
        tmp_path / "m3", "a.csv", "coordonneeLambertAbscisseEtablissement,siret,siren\n1.5,30,3\n"
    )
    raw = csv.scan_csv(spark, [early, again, late])
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2
    typed = conform.conform(raw, ESTABLISHMENTS, strict=False)
    rows = {r.company_number: (r.siret, r.LambertCoordinateX) for r in typed.collect()}
    assert rows == {"1": ("10", None), "2": ("20", None), "3": ("30", 1.5)}
    assert typed.columns == ESTABLISHMENTS.names


def test_header_mismatch_in_one_folder_fails(spark, tmp_path):
    write_text(tmp_path / "in", "a.csv", "siren,siret\n1,10\n")
    path = write_text(tmp_path / "in", "b.csv", "siret,siren\n20,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.scan_csv(spark, path).collect()


def test_line_breaks_inside_quotes_on_request(spark, tmp_path):
    path = write_text(tmp_path / "in", "a.csv", 'a,b\n1,"x\ny"\n')
    scan = csv.scan_csv(spark, path, multiline=True, file_name="source")
    assert scan.collect() == [("1", "x\ny", "a.csv")]


def test_row_order_follows_files_across_splits(spark, tmp_path):
    for name, start in (("a.csv", 0), ("b.csv", 20_000)):
        lines = "\n".join(f"{i},{'x' * 20}" for i in range(start, start + 20_000))
        path = write_text(tmp_path / "in", name, "i,text\n" + lines + "\n")
        os.utime(tmp_path / "in" / name, (1_700_000_000 + start, 1_700_000_000 + start))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = csv.scan_csv(spark, path, file_order="seq")
        assert raw.rdd.getNumPartitions() > 8
        ordered = raw.orderBy("seq").select(F.col("i").cast("int")).collect()
        assert [r[0] for r in ordered] == list(range(40_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_fragments_and_globs(spark, tmp_path):
    path = str(tmp_path / "fragments")
    one = spark.range(120).coalesce(1)
    tables.write_fragments(one, path, rows=50, name="StockEtablissement_clean", file_format="csv")
    tables.write_fragments(spark.range(7), path, name="StockUniteLegale_clean", file_format="csv")
    assert csv.scan_csv(spark, path, name_glob="*Legal*").count() == 7
    scan = csv.scan_csv(spark, path, name_glob="*Etablissement*")
    sizes = scan.groupBy(F.col("_metadata.file_name")).count().collect()
    assert sorted(r[1] for r in sizes) == [20, 50, 50]


def test_staging(spark, tmp_path):
    path = str(tmp_path / "staging")
    tables.append_staging(spark.range(3), path)
    tables.append_staging(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    tables.replace_staging(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1
    tables.clear_staging(spark, path)
    cleared = spark.read.parquet(path)
    assert (cleared.count(), cleared.columns) == (0, ["id"])


SPEC = Upsert(
    "published", ("k",), {"k": "key", "v": "value", "by": Constant.text("i")}, {"v": "value"}
)


def test_published_version_has_one_file_per_bucket(spark, tmp_path):
    rows = spark.range(1000).selectExpr("string(id) as key", "string(id) as value", "id as seq")
    spec = Upsert("buckets", ("k",), SPEC.insert, SPEC.update)
    tables.publish(upsert(None, rows, spec, "seq"), "buckets", 1, ["k"], location=str(tmp_path))
    target = upsert(spark.table("buckets"), rows, spec, "seq")
    tables.publish(target, "buckets", 2, ["k"], location=str(tmp_path))
    files = list((tmp_path / "buckets" / "version=2").glob("*.parquet"))
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.table("buckets").count() == 1000


def test_upsert_reads_a_published_version_where_it_lies(spark, tmp_path):
    def source(low, high):
        rows = spark.range(low, high)
        return rows.selectExpr("string(id % 50) as key", "string(id) as value", "id as seq")

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        where = {"location": str(tmp_path)}
        first = tables.publish(upsert(None, source(0, 40), SPEC, "seq"), "published", 1, ["k"], **where)
        assert first.count() == 40
        new = upsert(spark.table("published"), source(30, 130), SPEC, "seq")
        plan = new._jdf.queryExecution().executedPlan().toString()
        # One exchange, of the collapsed source; the target is neither shuffled nor null-split.
        assert plan.count("Exchange hashpartitioning") == 1
        assert "Bucketed: true" in plan and "PythonUDF" not in plan
        second = tables.publish(new, "published", 2, ["k"], **where)
        assert second.count() == 50
        assert {r.k: r.v for r in second.collect()}["7"] == "107"
        # The older version is still whole.
        assert spark.table("published_v1").count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_full_fragments_come_from_several_tasks(spark, tmp_path):
    path = str(tmp_path / "full")
    df = spark.range(0, 1050, 1, 7)
    tables.write_full_fragments(df, path, 100, str(tmp_path / "staged"))
    files = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("file"))
    sizes = sorted(r["count"] for r in files.groupBy("file").count().collect())
    assert sizes == [50] + [100] * 10
    assert sorted(r.id for r in files.collect()) == list(range(1050))
    assert len({r.file.split("-")[1] for r in files.collect()}) > 1
