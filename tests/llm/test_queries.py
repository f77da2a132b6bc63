"""The registered queries of the operators, and the pipeline, on the driver tables."""

import re

import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from regloom.llm import quality, simhash, substrings
from regloom.llm.oracles import ORACLES
from regloom.llm.queries import QUERIES
from regloom.session import scratch_path
from tests.llm import data
from tests.test_parity import rows_by_name

FOLDER = "/root/testdata/sf0.001"


def test_one_query_each():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, parity, name):
    folder, db = parity
    result = QUERIES[name](spark, folder)
    relation = db.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    expected = rows_by_name(names, relation.fetchall())
    assert rows_by_name(result.columns, [tuple(r) for r in result.collect()]) == expected
    assert expected[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_whole_table(spark, name):
    table, key = ("pages", "page_id") if name == "op2_warc" else ("documents", "doc_id")
    result = QUERIES[name](spark, FOLDER)
    ids = {r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in result.select(key).collect()} == ids


def simhash_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_pipeline_stage_by_stage(spark):
    """Each stage against a plain version of what it promises, on what the one before kept."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in rows.collect()}
        path = scratch_path(spark, name)
        stage(spark, rows, FOLDER).write.parquet(path)
        columns = rows.columns
        rows = spark.read.parquet(path)
        kept[name] = (before, rows.collect())
        if name != "packing":
            assert rows.columns == columns

    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stay = {r.doc_id for r in after}
    known = [i for i in before if i in labels]
    assert sum((i in stay) == (labels[i] == 1) for i in known) >= 0.97 * len(known)

    before, after = kept["near_duplicates"]
    prints = {i: simhash_of(r.text) for i, r in before.items()}
    root = {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(before)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert {r.doc_id for r in after} == {i for i in ids if find(i) == i}

    before, after = kept["suffix_dedup"]
    seen, expected = set(), {}
    for i in sorted(before):
        raw, gone = (before[i].text or "").encode(), set()
        for at in range(len(raw) - 99):
            w = raw[at : at + 100]
            if w in seen:
                gone |= set(range(at, at + 100))
            seen.add(w)
        text, at = "", 0
        for ch in before[i].text or "":
            n = len(ch.encode())
            text += "" if gone & set(range(at, at + n)) else ch
            at += n
        if text or not raw:
            expected[i] = text
    assert {r.doc_id: r.text for r in after} == expected
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = kept["decontamination"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for w in items for k in range(len(w) - 9)}
    clean = {i for i, r in before.items() if not any(tuple(words(r.text)[k : k + 10]) in windows for k in range(len(words(r.text)) - 9))}
    assert {r.doc_id for r in after} == clean and len(clean) < len(before)

    before, after = kept["packing"]
    tokens = {}
    for r in after:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {r.doc_id: r.doc_tokens for r in after} and set(tokens) == set(before)


def test_stages_handle_odd_and_empty_tables(spark):
    for docs in (data.documents(spark), data.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            assert stage(spark, docs, FOLDER).count() >= 0
    assert corpus_pipeline.keep_quality(spark, data.documents(spark), FOLDER).columns == data.SCHEMA.names


def test_empty_tables(spark):
    none = data.empty(spark)
    assert simhash.near_duplicates(none).count() == 0
    assert substrings.dedup_substrings(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(none, quality.train(none, labels)).count() == 0
