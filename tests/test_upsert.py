"""The upsert against a row-by-row model, and its plan."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from regloom.operators.upsert import (
    Constant,
    Upsert,
    apply_changes,
    collapse,
    combine,
    single_changes,
    split_by_key,
    upsert,
)

SPEC = Upsert(
    table="t",
    keys=("k",),
    insert={
        "k": "key",
        "kept": "a",
        "moved": "b",
        "by": Constant.text("ins'ert"),
        "origin": Constant.text("first"),
        "touched": "b",
    },
    update={"moved": "b", "by": Constant.text("update"), "touched": Constant.text("again")},
)
SOURCE = "key string, a string, b string, seq bigint"
TARGET = "k string, kept string, moved string, by string, origin string, touched string"


def model(target, source):
    """Apply rows one by one; a missing key never conflicts."""
    table = {row[0]: list(row) for row in target if row[0] is not None}
    loose = [tuple(row) for row in target if row[0] is None]
    for key, a, b, _ in sorted(source, key=lambda r: r[3]):
        if key is None:
            loose.append((None, a, b, "ins'ert", "first", b))
        elif key in table:
            table[key][2], table[key][3], table[key][5] = b, "update", "again"
        else:
            table[key] = [key, a, b, "ins'ert", "first", b]
    return order([tuple(r) for r in table.values()] + loose)


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def run(spark, target, source):
    source_df = spark.createDataFrame(source, SOURCE)
    target_df = None if target is None else spark.createDataFrame(target, TARGET)
    return order(upsert(target_df, source_df, SPEC, "seq").collect())


def test_hand_written_cases(spark):
    target = [("t", "t0", "t1", "old", "o", "x"), ("only", "o0", "o1", "old", "o", "x"), (None, "n", "n", "n", "n", "n")]
    source = [
        ("twice", "a", "p", 1),
        ("twice", "b", "q", 2),
        ("once", "a", "p", 3),
        ("t", "a", "p", 4),
        ("nullfirst", None, "p", 5),
        ("nullfirst", "b", None, 6),
        (None, "x", "y", 7),
        (None, "x", "y", 8),
    ]
    got = {r[0]: r for r in run(spark, target, source) if r[0]}
    assert got["twice"] == ("twice", "a", "q", "update", "first", "again")
    assert got["once"] == ("once", "a", "p", "ins'ert", "first", "p")
    assert got["t"] == ("t", "t0", "p", "update", "o", "again")
    assert got["only"] == target[1]
    assert got["nullfirst"] == ("nullfirst", None, None, "update", "first", "again")
    assert run(spark, target, source) == model(target, source)


texts = st.one_of(st.none(), st.sampled_from("pqr"))
keys = st.one_of(st.none(), st.sampled_from(["k1", "k2", "k3", ""]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(keys, texts, texts), max_size=12),
    old=st.sets(st.sampled_from(["k1", "k2", ""])),
    empty=st.booleans(),
)
def test_equals_row_by_row_model(spark, rows, old, empty):
    source = [(*row, i) for i, row in enumerate(rows)]
    target = None if empty else [(k, "t0", "t1", "old", "o", "x") for k in sorted(old)]
    assert run(spark, target, source) == model(target or [], source)


def test_any_split_gives_the_same_and_rerun_changes_provenance_only(spark):
    rng = random.Random(7)
    # One key holds a third of the rows.
    source = [
        (rng.choice(["hot", rng.choice("abcdef"), f"k{i}"]), rng.choice("xyz"), rng.choice("uvw"), i)
        for i in range(300)
    ]
    whole = run(spark, None, source)
    assert whole == model([], source)
    for cut in (1, 90, 299):
        first, rest = source[:cut], source[cut:]
        df = upsert(None, spark.createDataFrame(first, SOURCE), SPEC, "seq")
        df = upsert(df, spark.createDataFrame(rest, SOURCE), SPEC, "seq")
        assert order(df.collect()) == whole
    again = run(spark, whole, source)
    assert [(r[0], r[1], r[2], r[4]) for r in again] == [(r[0], r[1], r[2], r[4]) for r in whole]
    assert len({r[0] for r in whole}) == len(whole)


def test_changes_of_batches_combine_in_any_order(spark):
    source = [("a", "1", "2", 5), ("b", "3", "4", 1), ("a", "5", "6", 2), ("a", None, "7", 9), (None, "z", "z", 4)]
    parts = [spark.createDataFrame(source[i::3], SOURCE) for i in (2, 0, 1)]
    changes = None
    for part in parts:
        keyed, loose = split_by_key(part, ["key"])
        new = collapse(keyed, SPEC, "seq").unionByName(single_changes(loose, SPEC, "seq"))
        changes = new if changes is None else changes.unionByName(new)
    keyed, loose = split_by_key(changes, ["k"])
    rows = apply_changes(None, combine(keyed, SPEC), SPEC).unionByName(apply_changes(None, loose, SPEC))
    assert order(rows.collect()) == model([], source)


def test_updating_all(spark):
    source = spark.createDataFrame([("a", "1", "2", 1), ("a", "3", "4", 2)], SOURCE)
    row = upsert(None, source, SPEC.updating_all(), "seq").first()
    assert (row.k, row.kept, row.moved, row.by) == ("a", "3", "4", "update")


def test_composite_key(spark):
    spec = Upsert("t", ("x", "y"), {"x": "key", "y": "a", "v": "b"}, {"v": "b"})
    rows = [("k", "1", "p", 1), ("k", "2", "q", 2), ("k", "1", "r", 3), ("k", None, "s", 4), ("k", None, "t", 5)]
    got = upsert(None, spark.createDataFrame(rows, SOURCE), spec, "seq")
    expected = [("k", "1", "r"), ("k", "2", "q"), ("k", None, "s"), ("k", None, "t")]
    assert order(got.collect()) == order(expected)
