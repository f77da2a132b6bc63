"""Headers of many files, hot codes in a dimension join, and keys under a collation."""

import pytest
from pyspark.sql import functions as F

from regloom.operators import collation, lookups
from regloom.operators.upsert import Upsert, upsert
from regloom.sources import csv, headers

EARLY, LATE = "siren,siret\n", "coordonneeLambertAbscisseEtablissement,siret,siren\n"


def write(folder, name, text):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def jobs_of(spark, work):
    """What the work returns, and how many jobs it ran."""
    context = spark.sparkContext
    group = f"count-{id(work)}"
    context.setJobGroup(group, "")
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_1000_paths_are_one_job(spark, tmp_path):
    paths = []
    for i in range(1000):
        text = EARLY + f"{i},{i}0\n" if i % 2 else LATE + f"1.5,{i}0,{i}\n"
        paths.append(write(tmp_path / f"m {i}", "a+[1].csv", text))
    _, few = jobs_of(spark, lambda: csv.scan_csv(spark, paths[:4]))
    # A listing of many paths is a job as well: one for the headers, one for each vintage.
    scan, jobs = jobs_of(spark, lambda: csv.scan_csv(spark, paths))
    assert few <= 4 and jobs <= 12
    rows = {r.siren: (r.siret, r.coordonneeLambertAbscisseEtablissement) for r in scan.collect()}
    assert rows == {str(i): (f"{i}0", None if i % 2 else "1.5") for i in range(1000)}
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_files_that_drift_from_their_folder(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        write(tmp_path / "one", name, EARLY + "1,10\n")
    one = write(tmp_path / "one", "c.csv", "\n" + LATE + "2.5,20,2\n")
    write(tmp_path / "two", "empty.csv", "")
    two = write(tmp_path / "two", "d.csv", '"siren","siret"\r\n3,30\r\n')
    report = headers.header_report(headers.file_headers(spark, [one, two]))
    found = {(r.folder.rsplit("/", 1)[1], r.header): (r.files, r.first_file.rsplit("/", 1)[1], r.drifts) for r in report.collect()}
    assert found == {
        ("one", EARLY.strip()): (2, "a.csv", False),
        ("one", LATE.strip()): (1, "c.csv", True),
        ("two", '"siren","siret"'): (1, "d.csv", False),
    }
    rows = csv.scan_csv(spark, [one, two]).select("siren", "siret").collect()
    assert sorted(map(tuple, rows)) == [("1", "10"), ("1", "10"), ("2", "20"), ("3", "30")]


def test_headers_do_not_read_on(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", EARLY + "1,10\n" * 2_000_000)
    assert [r.header for r in headers.file_headers(spark, path).collect()] == [EARLY.strip()]
    assert headers.file_headers(spark, [path]).rdd.getNumPartitions() == 1


@pytest.fixture(scope="module")
def hot_facts(spark):
    code = "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null when id % 50 = 2 then 'lost' else 'c' || id % 400 end"
    return spark.range(0, 40_000, 1, 8).selectExpr("id", f"{code} as code", "id % 7 as other")


@pytest.fixture(scope="module")
def names(spark):
    rows = [("hot", "Hot"), ("hot", "Hot again"), (None, "nothing"), *[(f"c{i}", f"C {i}") for i in range(400)]]
    return spark.createDataFrame(rows, "number string, name string")


def same_rows(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_split_join_is_the_plain_join(spark, hot_facts, names, most_bytes):
    assert lookups.hot_codes(hot_facts, "code", 0.2) == ["hot"]
    plain = lookups.join_dimension(hot_facts, names, "code", "number")
    split = lookups.join_dimension_split(hot_facts, names, "code", "number", most_bytes=most_bytes)
    assert split.columns == plain.columns and same_rows(split, plain)
    none = lookups.join_dimension_split(hot_facts.where("code is null"), names, "code", "number")
    assert none.count() == 0
    assert lookups.join_dimension_split(hot_facts, names.where("false"), "code", "number").count() == 0


def test_no_task_of_a_split_join_has_the_hot_code(spark, hot_facts, names):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for most_bytes, joins in ((1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            split = lookups.join_dimension_split(hot_facts, names, "code", "number", salts=16, most_bytes=most_bytes)
            plan = split._jdf.queryExecution().executedPlan().toString()
            assert joins in plan
            shares = split.groupBy(F.spark_partition_id()).count().select("count").collect()
            assert max(r[0] for r in shares) < 0.25 * sum(r[0] for r in shares)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SPEC = Upsert("t", ("k",), {"k": "name", "a": "a", "b": "b"}, {"b": "b"})
SPELLINGS = ["Élan ", "ELAN", "élan", "Élan", "elan  ", "Øre", "øre", "", None, "Maß", "maß"]


@pytest.mark.parametrize("spelling", ["first", "last"])
def test_collated_upsert_is_the_fold_of_rows(spark, spelling):
    rows = [(i, SPELLINGS[i * 7 % len(SPELLINGS)], i, i * 10) for i in range(60)]
    table = {}
    for _, name, a, b in rows:
        if name is None:
            continue
        key = name.rstrip(" ").lower().replace("́", "").replace("é", "e")
        old = table.get(key)
        shown = name if old is None or spelling == "last" else old[0]
        table[key] = (shown, a if old is None else old[1], b)
    spec = collation.collated(SPEC, spelling)
    source = collation.with_folded_keys(spark.createDataFrame(rows, "seq long, name string, a long, b long"), SPEC, "ci_ai")
    half = upsert(None, source.where("seq < 30"), spec, "seq")
    result = upsert(half, source.where("seq >= 30"), spec, "seq").where("k is not null").collect()
    assert {r.k_folded: (r.k, r.a, r.b) for r in result} == table and len(result) == len(table)


def test_case_alone_keeps_accents_apart(spark):
    words = spark.createDataFrame([("É ", "é"), ("E", "e"), (None, None)], "x string, y string")
    ci = words.select(collation.folded(F.col("x"), "ci").alias("x")).collect()
    assert [r.x for r in ci] == ["é", "e", None]
    facts, codes = words.select("x"), words.select("y")
    assert collation.join_collated(facts, codes, "x", "y", "ci").count() == 2
    assert collation.join_collated(facts, codes, "x", "y", "ci_ai").count() == 4
    with pytest.raises(ValueError, match="collation"):
        collation.folded(F.col("x"), "de")
