"""The operators on vectors, and importance resampling, against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from regloom.llm import codebooks, importance, quantised
from regloom.llm.hot import join_values
from tests.llm import data

SCHEMA = "vec_id long, embedding array<float>, label int, kept string, code string, error string, n_links string"


def table(spark, vectors, ids=None, labels=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], None if n % 5 == 0 else n % 3, "k", "c", "e", "n") for n, (i, v) in enumerate(zip(ids, vectors))]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


ODD = [None, [], [0.0] * 16, [None] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [0.0] * 15]


def links_of(vectors, least=0.9):
    """Links and the least index reachable, over all pairs."""
    n, root = [0] * len(vectors), list(range(len(vectors)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def sound(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    exact = [np.array(v, np.float32).astype(float) if sound(v) else None for v in vectors]
    pairs = set()
    for i, a in enumerate(exact):
        for j in range(i):
            b = exact[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                n[i] += 1
                n[j] += 1
                pairs.add((j, i))
                root[max(find(i), find(j))] = min(find(i), find(j))
    return n, [find(i) for i in range(len(vectors))], pairs


def planted(size=16):
    r = np.random.default_rng(3)
    base = r.normal(size=(60, size))
    near = base[:20] + 0.05 * r.normal(size=(20, size))
    crowd = base[0] + 0.02 * r.normal(size=(30, size))
    chain = [base[50] + k * 0.35 * base[51] for k in range(6)]
    return [*base, *near, *crowd, *chain, *base[5:9], *([list(base[9])] * 12), 3 * base[10], *ODD, [1.0, 2.0], [1.0, 2.0], [2.0, 4.1], [5.0]]


def test_near_duplicates(spark):
    vectors = [None if v is None else list(v) for v in planted()]
    n, root, pairs = links_of(vectors)
    found = {r.vec_id: r for r in quantised.near_duplicates(table(spark, vectors)).collect()}
    assert len(pairs) > 500
    for i in range(len(vectors)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (n[i], root[i], root[i] == i), i
    assert found[0].label is None and found[1].code == "c"


def test_tiles_make_no_difference(spark, monkeypatch):
    """The dealing of a list over several tiles, by numbers of nodes that tiles do not show."""
    vectors = [list(v) for v in planted()[:116]]
    rows = table(spark, vectors)
    whole = sorted(map(tuple, quantised.near_duplicates(rows, keep=["vec_id"]).collect()))
    monkeypatch.setattr(quantised, "ENTRIES", 7)
    monkeypatch.setattr(quantised, "QUERIES", 5)
    assert sorted(map(tuple, quantised.near_duplicates(rows, keep=["vec_id"]).collect())) == whole


def test_recall_at_the_least_cosine(spark):
    """Pairs that only just link, in random directions: the hardest for lists of centres."""
    r = np.random.default_rng(8)
    base = r.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    aside = r.normal(size=(500, 64))
    aside -= (aside * base[:500]).sum(1)[:, None] * base[:500]
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    cosine = r.uniform(0.9005, 0.93, 500)[:, None]
    vectors = [*base, *(cosine * base[:500] + np.sqrt(1 - cosine**2) * aside)]
    found = {r.vec_id: r for r in quantised.near_duplicates(table(spark, vectors), keep=["vec_id"]).collect()}
    caught = sum(found[1500 + i].component_id == i for i in range(500))
    assert caught >= 0.95 * 500
    assert sum(f.n_links for f in found.values()) == 2 * caught


def test_repeated_and_missing_ids(spark):
    rows = table(spark, [[1.0, 0.1], [1.0, 0.0], [0.0, 1.0], [0.0, 1.0], [-1.0, 0.0], [-1.0, 0.2]], [4, 4, None, None, None, 2])
    found = sorted((r.vec_id is None, r.vec_id, r.n_links, r.component_id, r.kept) for r in quantised.near_duplicates(rows).collect() if r.vec_id is not None)
    assert found == [(False, 2, 1, 2, True), (False, 4, 1, 4, True), (False, 4, 1, 4, True)]
    nameless = sorted((r.n_links, r.component_id or 0, r.kept) for r in quantised.near_duplicates(rows).collect() if r.vec_id is None)
    assert nameless == [(1, 0, True), (1, 0, True), (1, 2, False)]


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert quantised.near_duplicates(none).count() == 0
    odd = quantised.near_duplicates(table(spark, ODD)).collect()
    assert all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in odd) and len(odd) == len(ODD)
    compressed, books = codebooks.compress(none)
    assert compressed.count() == 0 and books is None
    compressed, books = codebooks.compress(table(spark, [v for v in ODD if v != [0.0] * 16]))
    assert compressed.count() == 0 and books is None


def plain_codes(rows, parts, entries, rounds):
    """Lloyd's rounds in Python's whole numbers, all distances computed."""
    size = -(-len(rows[0][1]) // parts)
    cut = []
    for i, v in rows:
        ints = [math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (size * parts - len(v))
        cut.append((i, [ints[p * size : (p + 1) * size] for p in range(parts)]))
    books = [[list(v[p]) for _, v in cut[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    for n in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)] for _, v in cut]
        if n < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [v[p] for (_, v), c in zip(cut, codes) if c[p] == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, bytes(c).hex(), sum(far(v[p], books[p][c[p]]) for p in range(parts))) for (i, v), c in zip(cut, codes)]
    numbers = [x for book in books for e in book for x in e]
    return found, hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (4, 3, 9), (5, 1, 2), (2, 40, 12), (8, 2, 3)])
def test_codebooks(spark, parts, entries, rounds):
    r = np.random.default_rng(6)
    vectors = [*r.normal(size=(150, 16)), *([[0.25] * 16] * 30), *(np.round(r.normal(size=(60, 16))) / 4), [-0.0] * 16, [1e-5] * 16]
    ids = [*range(5, len(vectors) + 5)]
    odd = [v for v in ODD if v != [0.0] * 16] + [[1.0] * 15, [4e4] * 16, [-1e30] * 16]
    rows = table(spark, [*vectors, *odd], [*ids, *range(1000, 1000 + len(odd))])
    coded, books = codebooks.compress(rows, parts=parts, entries=entries, rounds=rounds)
    expected, digest = plain_codes(list(zip(ids, vectors)), parts, entries, rounds)
    found = coded.collect()
    assert sorted((r.vec_id, r.code, r.error) for r in found) == expected
    assert books.sha256 == digest
    assert {r.kept for r in found} == {"k"}


def test_bounds_hold_and_save_distances():
    """Bounds against all distances, through rounds of small moves."""
    r = np.random.default_rng(1)
    x = r.integers(-3000, 3000, (2000, 6))
    entries = r.integers(-3000, 3000, (24, 6))
    _, state = codebooks.from_distances(codebooks.squared(x, entries), 5)
    computed = []
    for n in range(8):
        new = entries + r.integers(-60, 60, entries.shape) // (n + 1)
        moved = np.sqrt(((new - entries) ** 2).sum(1).astype(float))
        entries = new
        distance, state, needed = codebooks.reassigned(x, state, entries, moved, max(2, 5 - n))
        d2 = codebooks.squared(x, entries)
        d = np.sqrt(d2)
        assert (state.entry == d2.argmin(1)).all()
        assert (state.upper >= d.min(1) - 1e-6).all()
        for i in range(0, len(x), 37):
            shown = [state.entry[i], *state.near[i]]
            assert len(set(shown)) == len(shown)
            behind = set(range(24)) - {state.entry[i]}
            for k, e in enumerate(state.near[i]):
                assert all(state.lower[i, k] <= d[i, o] + 1e-6 for o in behind)
                behind -= {e}
            assert all(state.outer[i] <= d[i, o] + 1e-6 for o in behind)
        computed.append((distance >= 0).mean())
    assert computed[-1] < 0.9 and needed <= 5


def test_missing_and_repeated_ids_in_codebooks(spark):
    rows = table(spark, [[2.0, 2.0], [1.0, 1.0], [5.0, 5.0], [3.0, 3.0]], [7, 7, None, 9])
    coded, books = codebooks.compress(rows, parts=2, entries=2, rounds=0)
    assert books.entries[0].ravel().tolist() == [4096, 8192]
    assert sorted((r.vec_id or 0, r.code) for r in coded.collect()) == [(0, "0101"), (7, "0000"), (7, "0101"), (9, "0101")]


def test_values_joined_to_hot_keys(spark):
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else 0 if i % 4 == 1 else i) for i in range(4000)], "i int, k int")
    values = rows.groupBy("k").agg({"i": "sum", "*": "count"}).withColumnsRenamed({"sum(i)": "s", "count(1)": "n"})
    sums = Counter()
    for i in range(4000):
        sums[None if i % 4 == 0 else 0 if i % 4 == 1 else i] += i
    found = join_values(rows, values, "k", "n").collect()
    assert len(found) == 4000 and all(r.s == sums[r.k] for r in found)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def drawn(docs, target, run, buckets, seed, least, percent):
    def features(w):
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, run + 1) for i in range(len(w) - n + 1)]

    words = [(i, plain_words(t)) for i, t in docs]
    found = [(i, len(w), features(w)) for i, w in words]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(plain_words(x)))
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)]
    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], importance.NO_ID if r[0] is None else r[0]))
    won = fit[: percent * len(fit) // 100]
    return sorted([(*r, k + 1) for k, r in enumerate(won)] + [(*r, None) for r in [*fit[len(won) :], *(r for r in rows if r[1] < least)]], key=str)


@pytest.mark.parametrize("run,buckets,least,percent", [(1, 10_000, 20, 10), (3, 50, 0, 35), (2, 7, 1, 100), (1, 100, 20, 1)])
def test_importance(spark, run, buckets, least, percent):
    docs = data.documents(spark).withColumnRenamed("fingerprint", "rank")
    target = ["a b zz", None, "", data.texts()[15], "é " * 30]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    done = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), run=run, buckets=buckets, least_words=least, percent=percent)
    found = sorted([(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in done.collect()], key=str)
    assert found == drawn(rows, target, run, buckets, 2024, least, percent)
    assert "lang" in done.columns and len(done.columns) == len(set(done.columns))


def test_importance_of_long_words_null_ids_and_ties(spark):
    long = "x" * 5_000_000 + " y" * 30
    docs = [(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "漢" * 100), (5, long), (6, None), (7, "q" * 47 + " " + "q" * 48 + " " + "q" * 49)]
    done = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("a",), ("y y",)], "text string"), run=2, least_words=1, percent=60, keep=["doc_id"])
    found = sorted([(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in done.collect()], key=str)
    assert found == drawn(docs, ["a", "y y"], 2, 10_000, 2024, 1, 60)


def test_importance_of_nothing(spark):
    none, target = data.empty(spark), spark.createDataFrame([], "text string")
    assert importance.resample(none, target).count() == 0
    some = importance.resample(data.plain(spark), target).collect()
    assert sum(r["rank"] is not None for r in some) == sum(r.n_words >= 20 for r in some) // 10


def test_cutoff_in_blocks(spark, monkeypatch):
    """Selection over many small blocks, written anew on the way, with many equal scores."""
    monkeypatch.setattr(importance, "BLOCK", 8)
    r = random.Random(2)
    keys = [(r.choice([r.randint(-9, 9), r.randint(-10**12, 10**12)]), r.randint(0, 400)) for _ in range(1500)]
    rows = spark.createDataFrame(keys, "score long, id long").repartition(6)
    ordered = sorted(keys, key=lambda k: (-k[0], k[1]))
    for draw in (1, 2, 700, 1499, 1500):
        assert importance.cutoff(rows, draw) == ordered[draw - 1]
    assert importance.cutoff(rows, 0) is None and importance.cutoff(rows, 1501) is None
