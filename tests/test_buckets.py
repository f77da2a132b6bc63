"""Tables kept by bucket, optimistic publishing, runs of batches and late fragments."""

import itertools
import os
import random
import threading

import pytest

from regloom.operators.upsert import Constant, Upsert, apply_changes, collapse, combine, merge_changes, upsert
from regloom.plans import jobs
from regloom.sources.buckets import BucketStore, Conflict
from regloom.sources.ledger import Folder, Ledger
from regloom.streaming import loader
from regloom.streaming.compaction import Runs

SPEC = Upsert(
    "t",
    ("k",),
    {"k": "key", "first": "value", "v": "value", "by": Constant.text("i")},
    {"v": "value", "by": Constant.text("u")},
    complete=True,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def source(spark, low, high, keys=200):
    return spark.range(low, high).selectExpr(f"string(id % {keys}) as key", "'v' || id as value", "id as seq")


def changes(spark, low, high):
    return {"t": collapse(source(spark, low, high), SPEC, "seq")}


KEYS, APPLY = {"t": SPEC.keys}, {"t": lambda old, new: apply_changes(old, new, SPEC)}


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), "flow")
    assert store.read("t") is None
    assert store.merge(changes(spark, 0, 1000), KEYS, APPLY, buckets=16) == 1
    before, entry = files(tmp_path / "buckets"), store.ledger.newest()[1]
    assert len(before) == 16
    store.merge(changes(spark, 1000, 1003), KEYS, APPLY, buckets=4)
    after = files(tmp_path / "buckets")
    # Nothing that was there has changed, and as many files are new as there are touched buckets.
    assert {f: after[f] for f in before} == before
    live = store.ledger.newest()[1]["tables"]["t"]["live"]
    new = [len(some) for attempt, some in live.items() if attempt not in entry["tables"]["t"]["live"]]
    assert new == [len(after) - len(before)] and 0 < new[0] <= 3
    assert sorted(b for some in live.values() for b in some) == list(range(16))
    expected = upsert(upsert(None, source(spark, 0, 1000), SPEC, "seq"), source(spark, 1000, 1003), SPEC, "seq")
    assert rows(store.read("t")) == rows(expected)
    # The version of before is still there for who reads it.
    assert rows(store.read("t", entry=entry)) == rows(upsert(None, source(spark, 0, 1000), SPEC, "seq"))


def test_the_touched_part_is_not_shuffled(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), "flow")
    store.merge(changes(spark, 0, 1000), KEYS, APPLY, buckets=16)
    path = str(tmp_path / "changes")
    changes(spark, 0, 5)["t"].write.parquet(path)
    plan = apply_changes(store.read("t", [3, 5]), spark.read.parquet(path), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(k" in plan
    assert "InMemoryFileIndex(2 paths)" in plan or "PartitionFilters: [concat_ws" in plan


def test_no_changes_and_new_keys(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), "flow")
    store.merge(changes(spark, 0, 0), KEYS, APPLY, buckets=8)
    assert store.read("t").count() == 0
    store.merge(changes(spark, 0, 40), KEYS, APPLY)
    store.merge(changes(spark, 0, 0), KEYS, APPLY)
    assert rows(store.read("t")) == rows(upsert(None, source(spark, 0, 40), SPEC, "seq"))


class Late(BucketStore):
    """A store in which another run publishes while this one merges."""

    others: list = []

    def _written(self, *args):
        done = super()._written(*args)
        if self.others:
            self.others.pop(0)()
        return done


@pytest.mark.parametrize("low,high", [(0, 1000), (1001, 1002)])
def test_the_loser_of_a_race_merges_on_top(spark, tmp_path, low, high):
    """Once with all buckets in common, once with one key in another bucket."""
    first = BucketStore(spark, str(tmp_path), "flow")
    first.merge(changes(spark, 0, 500), KEYS, APPLY, buckets=16)
    late = Late(spark, str(tmp_path), "flow")
    late.others = [lambda: first.merge(changes(spark, low, high), KEYS, APPLY, batch=5)]
    assert late.merge(changes(spark, 2000, 2001), KEYS, APPLY, batch=3) == 3
    expected = upsert(None, source(spark, 0, 500), SPEC, "seq")
    for part in ((low, high), (2000, 2001)):
        expected = upsert(expected, source(spark, *part), SPEC, "seq")
    assert rows(late.read("t")) == rows(expected)
    assert late.ledger.newest()[1]["batch"] == 5


def test_a_run_that_always_loses_gives_up(spark, tmp_path):
    first = BucketStore(spark, str(tmp_path), "flow")
    first.merge(changes(spark, 0, 50), KEYS, APPLY, buckets=2)
    late = Late(spark, str(tmp_path), "flow")
    late.others = [lambda: first.merge(changes(spark, 0, 50), KEYS, APPLY)] * 2
    with pytest.raises(Conflict):
        late.merge(changes(spark, 0, 9), KEYS, APPLY, tries=2)
    assert rows(late.read("t")) == rows(first.read("t"))


def test_one_of_many_writers_gets_a_number(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"))
    assert ledger.newest() == (0, {})
    won = []

    def write(n):
        for number in range(1, 6):
            if ledger.put(number, {"by": n}):
                won.append((number, n))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(number for number, _ in won) == [1, 2, 3, 4, 5]
    assert all(ledger.get(number) == {"by": n} for number, n in won)
    # What else is in the folder, such as entries left half-written, is no entry.
    Folder(spark, str(tmp_path / "l")).create(".0000000009.json-x", "{")
    assert ledger.newest()[0] == 5
    ledger.forget(2)
    assert ledger.numbers() == [4, 5]


def test_a_rename_does_not_replace(spark, tmp_path):
    folder = Folder(spark, str(tmp_path))
    (tmp_path / "a").write_text("1")
    (tmp_path / "b").write_text("2")
    assert not folder._rename("a", "b") and (tmp_path / "b").read_text() == "2"
    assert folder._rename("a", "c") and (tmp_path / "c").read_text() == "1"


def test_files_no_entry_names_are_collected(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), "flow")
    for n in range(4):
        store.merge(changes(spark, 100 * n, 100 * n + 100), KEYS, APPLY, buckets=4)

    def fail(old, new):
        store._written("t", new, SPEC.keys, lambda o, c: apply_changes(o, c, SPEC), store.ledger.newest()[1], 9, 4)
        raise OSError("after the write")

    with pytest.raises(OSError):
        store.merge(changes(spark, 0, 100), KEYS, {"t": fail})
    expected = rows(store.read("t"))
    assert store.collect(older_than=3600) == []
    gone = store.collect(keep=1, older_than=-10)
    # Three versions of four buckets, and what the failed run left.
    assert len(gone) == 16 and store.collect(keep=1, older_than=-10) == []
    assert rows(store.read("t")) == expected and len(files(tmp_path / "buckets")) == 4


def batch(spark, path, n, spec=SPEC):
    folder = f"changes/t/batch_id={n}"
    collapse(source(spark, 10 * n, 10 * n + 10, 17), spec, "seq").write.mode("overwrite").parquet(f"{path}/{folder}")
    return folder


def test_runs_double(spark, tmp_path):
    runs, sizes = Runs(spark, str(tmp_path), "t"), []
    assert runs.changes() is None
    for n in range(13):
        runs.add(n, batch(spark, tmp_path, n), SPEC)
        sizes.append([r.batches for r in runs.current()])
    assert sizes[:8] == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1], [8]] and sizes[-1] == [8, 4, 1]
    expected = rows(upsert(None, source(spark, 0, 130, 17), SPEC, "seq"))
    assert rows(apply_changes(None, combine(runs.changes(), SPEC), SPEC)) == expected
    # A batch again changes nothing.
    before = runs.current()
    runs.add(12, batch(spark, tmp_path, 12), SPEC)
    runs.add(3, batch(spark, tmp_path, 3), SPEC)
    assert runs.current() == before
    with pytest.raises(ValueError, match="both sides"):
        runs.changes(after=3)
    # Batches that are published leave the runs; later ones start anew.
    runs.add(13, batch(spark, tmp_path, 13), SPEC, held=12)
    assert [(r.low, r.high) for r in runs.current()] == [(13, 13)]
    gone = runs.collect(older_than=-10)
    assert len(gone) > 13 and runs.changes(12).count() == 10


def test_a_crash_between_write_and_switch_keeps_the_runs(spark, tmp_path, monkeypatch):
    runs = Runs(spark, str(tmp_path), "t")
    for n in range(3):
        runs.add(n, batch(spark, tmp_path, n), SPEC)
    before = runs.current()
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "put", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            runs.add(3, batch(spark, tmp_path, 3), SPEC)
    assert runs.current() == before and any("0-3-" in f for f in os.listdir(tmp_path / "merged" / "t"))
    runs.add(3, batch(spark, tmp_path, 3), SPEC)
    assert [r.batches for r in runs.current()] == [4]
    assert rows(apply_changes(None, combine(runs.changes(), SPEC), SPEC)) == rows(upsert(None, source(spark, 0, 40, 17), SPEC, "seq"))


def test_a_run_combines_what_it_takes_with_incomplete_keys(spark, tmp_path):
    spec = Upsert(SPEC.table, SPEC.keys, SPEC.insert, SPEC.update)
    odd = source(spark, 0, 40, 5).selectExpr("nullif(key, '3') as key", "value", "seq")
    runs = Runs(spark, str(tmp_path), "t")
    for n in range(4):
        part = odd.where(f"seq div 10 = {n}")
        folder = f"changes/t/batch_id={n}"
        loader._changes(loader.Feed(spec), part, "seq").write.parquet(f"{tmp_path}/{folder}")
        runs.add(n, folder, spec)
    found = runs.changes()
    assert found.where("k is null").count() == 8 and found.where("k is not null").count() == 4


def test_any_order_of_delivery_gives_the_ordered_fold(spark):
    parts = [source(spark, 0, 30, 7), source(spark, 30, 33, 7), source(spark, 33, 60, 7)]
    made = [collapse(p, SPEC, "seq") for p in parts]
    expected = rows(upsert(None, source(spark, 0, 60, 7), SPEC, "seq"))
    for order in [*itertools.permutations(range(3)), (2, 2, 0, 1, 0), (1, 0, 2, 1)]:
        stored = None
        for n in order:
            stored = merge_changes(stored, made[n], SPEC)
        assert rows(apply_changes(None, stored, SPEC)) == expected, order


def test_one_row_delivered_twice_is_still_an_insert(spark):
    once = collapse(source(spark, 0, 1), SPEC, "seq")
    twice = merge_changes(merge_changes(None, once, SPEC), once, SPEC)
    assert rows(apply_changes(None, twice, SPEC)) == [("0", "v0", "v0", "i")]


def test_late_and_repeated_fragments_in_streams(spark, tmp_path):
    """Fragments in a random order over several runs, half of them again."""
    arrivals, intake = str(tmp_path / "in"), loader.Intake(str(tmp_path / "intake"))
    store = BucketStore(spark, str(tmp_path / "store"), "arrivals")
    schema = source(spark, 0, 1).schema
    os.makedirs(arrivals)
    feeds = [loader.Feed(SPEC)]

    def run():
        stream = loader.fragment_stream(spark, arrivals, schema, files_per_batch=1)
        return jobs.merge_fragments(store, stream, feeds, intake, "seq", 8)

    assert run() == -1 and jobs.merged_table(store, SPEC) is None
    order = [*range(8), *range(0, 8, 2)]
    random.Random(7).shuffle(order)
    for third in (order[:4], order[4:8], order[8:]):
        for n in third:
            source(spark, 20 * n, 20 * n + 20, 33).coalesce(1).write.mode("append").parquet(arrivals)
        run()
    assert run() == len(order) - 1
    assert rows(jobs.merged_table(store, SPEC)) == rows(upsert(None, source(spark, 0, 160, 33), SPEC, "seq"))
    # A run reads the batches since the last publish as few runs.
    assert len(Runs(spark, intake.path, "t").current()) <= 3
    loose = Upsert(SPEC.table, SPEC.keys, SPEC.insert, SPEC.update)
    with pytest.raises(ValueError, match="complete key"):
        jobs.merge_fragments(store, None, [loader.Feed(loose)], intake)
