"""Fragments taken in as micro-batches give what one batch gives."""

import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import DataFrameWriter

from regloom import session
from regloom.operators.report import duration_stats
from regloom.operators.upsert import Constant, Upsert, upsert
from regloom.plans import inputs, jobs, loading, queries
from regloom.sources import tables
from regloom.streaming import loader

SPEC = Upsert(
    "t",
    ("k",),
    {"k": "key", "first": "value", "v": "value", "by": Constant.text("i")},
    {"v": "value", "by": Constant.text("u")},
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def source(spark, low, high):
    return spark.range(low, high).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else string(id % 40) end as key",
        "string(id) as value",
        "id as seq",
    )


def run(spark, arrivals, intake, schema, **options):
    stream = loader.fragment_stream(spark, arrivals, schema, files_per_batch=1, **options)
    query = loader.take_in(stream, [loader.Feed(SPEC)], intake, "seq")
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_continues_from_its_checkpoint(spark, tmp_path):
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    # The newest rows arrive first.
    for low, high in ((200, 300), (0, 100), (100, 200)):
        source(spark, low, high).coalesce(1).write.mode("append").parquet(arrivals)
    schema = spark.read.parquet(arrivals).schema
    run(spark, arrivals, intake, schema)
    assert len([d for d in os.listdir(intake.changes("t")) if d.startswith("batch_id=")]) == 3
    expected = rows(upsert(None, source(spark, 0, 300), SPEC, "seq"))
    assert rows(loader.merged(spark, None, SPEC, intake)) == expected

    # Nothing is taken twice; a later fragment is.
    run(spark, arrivals, intake, schema)
    assert rows(loader.merged(spark, None, SPEC, intake)) == expected
    source(spark, 300, 330).coalesce(1).write.mode("append").parquet(arrivals)
    run(spark, arrivals, intake, schema)
    expected = rows(upsert(None, source(spark, 0, 330), SPEC, "seq"))
    assert rows(loader.merged(spark, None, SPEC, intake)) == expected

    # On top of an existing target.
    target = upsert(None, source(spark, 0, 50), SPEC, "seq")
    expected = rows(upsert(target, source(spark, 0, 330), SPEC, "seq"))
    assert rows(loader.merged(spark, target, SPEC, intake)) == expected

    # A target that already holds the first three batches needs only the fourth.
    held = upsert(None, source(spark, 0, 300), SPEC, "seq")
    expected = rows(upsert(held, source(spark, 300, 330), SPEC, "seq"))
    assert rows(loader.merged(spark, held, SPEC, intake, after_batch=2)) == expected

    stats = duration_stats(loader.batch_log(spark, intake)).first()
    assert (stats.flow, stats.batches) == ("t", 4) and stats.total_seconds > 0


def test_only_named_fragments_are_taken_in(spark, tmp_path):
    arrivals, intake = tmp_path / "in", loader.Intake(str(tmp_path / "intake"))
    arrivals.mkdir()
    for name, key in (("StockEtablissement_1.csv", "e"), ("StockUniteLegale_1.csv", "l")):
        (arrivals / name).write_text(f"key,value,seq\n{key},1,1\n")
    run(
        spark,
        str(arrivals),
        intake,
        "key string, value string, seq bigint",
        name_glob="*Legal*",
        file_format="csv",
    )
    assert rows(loader.merged(spark, None, SPEC, intake)) == [("l", "1", "1", "i")]


def test_legal_units_feed_three_targets(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    names, day = inputs.naf_translations(spark, folder), inputs.AS_OF.date()
    clean = inputs.legal_clean(spark, folder)
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    tables.write_fragments(clean, arrivals, rows=20)
    stream = loader.fragment_stream(spark, arrivals, clean.schema, files_per_batch=2)
    feeds = loading.legal_unit_feeds(names, day)
    loader.take_in(stream, feeds, intake, "seq").awaitTermination()
    expected = loading.load_legal_units(clean, names, {}, day)
    assert set(expected) == {"organisation", "naf_code", "stock_legal"}
    for feed in feeds:
        got = rows(loader.merged(spark, None, feed.spec, intake))
        assert got and got == rows(expected[feed.spec.table])


def test_fragments_taken_in_are_deleted_on_request(spark, tmp_path):
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    for low in (0, 100, 200):
        source(spark, low, low + 100).coalesce(1).write.mode("append").parquet(arrivals)
    schema = spark.read.parquet(arrivals).schema
    expected = rows(upsert(None, source(spark, 0, 300), SPEC, "seq"))
    run(spark, arrivals, intake, schema, when_done="delete")
    assert rows(loader.merged(spark, None, SPEC, intake)) == expected
    # The source deletes the files of a batch once a later one has begun.
    for _ in range(100):
        left = [f for f in os.listdir(arrivals) if f.endswith(".parquet")]
        if len(left) == 1:
            break
        time.sleep(0.1)
    assert len(left) == 1


def test_a_small_batch_is_one_stage_of_one_task(spark, tmp_path):
    """The columns a target reads, without a shuffle, however many fragments a batch has."""
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    wide = source(spark, 0, 300).selectExpr("*", "repeat(value, 9) as unread")
    wide.repartition(6, "seq").write.parquet(arrivals)
    seen = []

    def watched(batch):
        seen.append((batch.columns, batch.rdd.getNumPartitions()))
        return batch

    stream = loader.fragment_stream(spark, arrivals, spark.read.parquet(arrivals).schema, files_per_batch=3)
    narrow = loader._narrowed(stream, [loader.Feed(SPEC)], "seq")
    assert narrow.columns == ["key", "value", "seq"]
    loader.take_in(narrow, [loader.Feed(SPEC, watched)], intake, "seq").awaitTermination()
    assert seen == [(narrow.columns, 1)] * 2
    batch = source(spark, 0, 300).coalesce(1)
    changes = loader._changes(loader.Feed(SPEC), batch, "seq", single=True)
    assert "Exchange" not in changes._jdf.queryExecution().executedPlan().toString()
    assert rows(changes) == rows(loader._changes(loader.Feed(SPEC), source(spark, 0, 300).repartition(5), "seq"))
    assert rows(loader.merged(spark, None, SPEC, intake)) == rows(upsert(None, source(spark, 0, 300), SPEC, "seq"))
    # What a feed prepares may need any column, and so may one whose sources the stream does not name.
    assert loader._narrowed(stream, [loader.Feed(SPEC, watched)], "seq").columns == stream.columns


def test_a_batch_is_one_job(spark, tmp_path):
    """Its changes; what is logged of it is written without another."""
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    source(spark, 0, 300).coalesce(1).write.option("maxRecordsPerFile", 100).parquet(arrivals)
    query = run(spark, arrivals, intake, spark.read.parquet(arrivals).schema)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))) == 3
    assert loader.last_batch(spark, intake) == 2
    assert [r.flow for r in loader.batch_log(spark, intake).collect()] == ["t"] * 3


def test_every_name_is_dealt_to_one_lane(spark):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    written = [f"part-00007-5bb1-c{n:03}.snappy.parquet" for n in range(30)]
    odd = ["a", "x.csv", "fifteen-letters", "sixteen-letters_", "no ending but long enough", "Z.snappy.parquet"]
    odd += ["é-[,]{}^!.snappy.parquet", "part-0-c000.zstd.parquet", "Stock_12.csv", "ABC^.snappy.parquet", "a,b"]
    for count in (1, 2, 3, 5, 10):
        filters = [hadoop.GlobFilter(glob) for glob in loader.lane_globs(count)]
        dealt = {n: [f.accept(hadoop.Path(f"/in/{n}")) for f in filters] for n in written + odd}
        assert {n: sum(fits) for n, fits in dealt.items()} == dict.fromkeys(written + odd, 1)
        shares = [sum(dealt[n][lane] for n in written) for lane in range(count)]
        assert max(shares) == 3 * -(-10 // count)
    with pytest.raises(ValueError, match="11 streams"):
        loader.lane_globs(11)


def test_lanes_publish_what_one_stream_does(spark, tmp_path):
    arrivals, store = str(tmp_path / "in"), str(tmp_path / "store")
    spec, intake = replace(SPEC, table="dealt_to_lanes"), loader.Intake(str(tmp_path / "intake"))

    def load(version, count=3):
        schema = spark.read.parquet(arrivals).schema
        streams = [
            loader.fragment_stream(spark, arrivals, schema, name_glob=glob, files_per_batch=1)
            for glob in loader.lane_globs(count)
        ]
        last = jobs.load_fragments(jobs.Run(spark, store, version), "lanes", streams, [loader.Feed(spec)], intake)
        return last, rows(jobs.Run(spark, store, version + 1).current("lanes", [spec])[spec.table])

    # A lane has one fragment, another two, the third none.
    for low, high, each in ((0, 100, 100), (100, 150, 25)):
        source(spark, low, high).coalesce(1).write.mode("append").option("maxRecordsPerFile", each).parquet(arrivals)
    assert load(1) == (1, rows(upsert(None, source(spark, 0, 150), spec, "seq")))
    assert load(2) == (1, rows(upsert(None, source(spark, 0, 150), spec, "seq")))
    # The second lane's next batch has a lower number than what the first one has already published.
    source(spark, 150, 350).coalesce(1).write.mode("append").option("maxRecordsPerFile", 50).parquet(arrivals)
    assert load(3) == (3, rows(upsert(None, source(spark, 0, 350), spec, "seq")))
    entry = jobs.Run(spark, store, 4).manifest.current("lanes")[spec.table]
    assert (entry.batch, entry.batches) == (None, [3, 1, 0])
    # What one stream has taken in would be new to others.
    for count in (1, 2):
        with pytest.raises(ValueError, match="streams"):
            load(4, count)


def test_the_session_keeps_its_settings(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with session.with_settings(spark, session.WIDE_ROWS):
        assert spark.conf.get(key) == "8000"
        other = session.session_with(spark, loader.FEW_TASKS)
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert other.conf.get(key) == "8000" and other.conf.get("spark.sql.files.minPartitionNum") == "1"
    assert other.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_wide_arrivals_are_written_by_compiled_code(spark, monkeypatch):
    """Beyond the JVM's limit one method for a whole stage would be interpreted."""
    key, (expected,) = "spark.sql.codegen.hugeMethodLimit", session.WIDE_ROWS.values()
    before, seen = spark.conf.get(key), []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *_: seen.append(spark.conf.get(key)))
    monkeypatch.setattr(jobs, "merge_fragments", lambda *_: seen.append(spark.conf.get(key)))
    monkeypatch.setattr(jobs, "merged_table", lambda *_: None)
    monkeypatch.setattr(loader, "fragment_stream", lambda *_, **__: None)
    queries.late_fragments(spark, "/root/testdata/sf0.001")
    assert seen == [expected, before] * 3
