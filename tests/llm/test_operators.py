"""The operators of training data against brute-force versions."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from regloom.llm import chat, decontaminate, packing, quality, simhash, substrings, suffix_levels, urlfilter, warc, winnow
from regloom.llm.components import components
from regloom.llm.queries import tokenizer_path
from tests.llm import data


def ordered(rows):
    return sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: r[0])




@pytest.fixture(scope="module")
def docs(spark):
    return data.plain(spark)


def first_seen_cover(sequences, length):
    """Whether each unit lies in a window of so many units that also starts earlier."""
    seen, covers = set(), []
    for s in sequences:
        cover = [False] * len(s)
        for at in range(len(s) - length + 1):
            w = tuple(s[at : at + length]) if isinstance(s, list) else s[at : at + length]
            if w in seen:
                cover[at : at + length] = [True] * length
            seen.add(w)
        covers.append(cover)
    return covers


@pytest.mark.parametrize("length,seed", [(20, 10), (6, 3)])
def test_substrings(docs, length, seed):
    rows = ordered(docs.collect())
    split = [re.findall(r"[^\x20\x09-\x0D]+", t) for _, t in rows]
    covers = first_seen_cover(split, length)
    done = {r.doc_id: r for r in substrings.dedup_substrings(docs, length=length, seed=seed).collect()}
    assert sum(map(sum, covers)) > 0
    for (i, _), w, c in zip(rows, split, covers):
        r = done[i]
        assert (r.n_words, r.n_removed) == (len(w), sum(c))
        assert r.kept == " ".join(x for x, gone in zip(w, c) if not gone)
        spans = [p for s, e in zip(r.repeats[::2], r.repeats[1::2]) for p in range(s, e)]
        assert spans == [p for p, gone in enumerate(c) if gone]
        assert (r.lang, r.fingerprint) == ("en", "f")


@pytest.mark.parametrize("length,seed,batches", [(100, 24, 4), (100, 24, 1), (30, 8, 6)])
def test_suffix_levels(docs, length, seed, batches):
    rows = ordered(docs.collect())
    covers = first_seen_cover([t.encode() for _, t in rows], length)
    done = {r.doc_id: r for r in suffix_levels.dedup_suffixes(docs, length=length, seed=seed, batches=batches).collect()}
    assert sum(map(sum, covers)) > 0
    for (i, t), c in zip(rows, covers):
        assert (done[i].n_bytes, done[i].n_removed) == (len(t.encode()), sum(c))
        assert bytes(done[i].kept) == bytes(b for b, gone in zip(t.encode(), c) if not gone)


def test_suffix_levels_keep_characters_whole(docs):
    rows = ordered(docs.collect())
    covers = first_seen_cover([t.encode() for _, t in rows], 30)
    done = {r.doc_id: bytes(r.kept).decode() for r in suffix_levels.dedup_suffixes(docs, length=30, seed=8, characters=True).collect()}
    for (i, t), c in zip(rows, covers):
        kept, at = "", 0
        for ch in t:
            n = len(ch.encode())
            kept += "" if any(c[at : at + n]) else ch
            at += n
        assert done[i] == kept


def test_levels_merge_geometrically(spark, docs):
    family = suffix_levels.SuffixLevels(spark, id="doc_id", text="text")
    sizes = []
    for i in range(5):
        family.append(docs.where(F.col("doc_id") % 5 == i))
        sizes.append([n for n, _ in family.levels])
    family.close()
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1]]


def test_repeated_ids_and_rows(spark):
    docs = data.documents(spark)
    both = docs.unionByName(docs.limit(10))
    assert substrings.dedup_substrings(both).count() == both.count()
    assert suffix_levels.dedup_suffixes(both).count() == both.count()


def brute_components(prints, distance):
    n = len(prints)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= distance)
    return simhash._roots(n, a, b)


def test_simhash(docs):
    rows = ordered(docs.collect())
    expected = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxh64_intdigest(s, 42) for s in shingles]
        expected.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert [found[i].fingerprint & (2**64 - 1) for i, _ in rows] == expected
    root = brute_components(np.array(expected, np.uint64), 4)
    assert [found[i].component_id for i, _ in rows] == [rows[r][0] for r in root]


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_long_lists_equal_all_pairs(distance):
    rng = np.random.default_rng(1)
    values = np.unique(np.array([sum(1 << int(b) for b in rng.choice(32, rng.integers(0, 8), replace=False)) for _ in range(400)], np.uint64))
    near = simhash._roots(len(values), *simhash._meeting_pairs(values, distance, np.arange(32)))
    assert np.array_equal(near, brute_components(values, distance))


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(400, 460)]
    a, b = np.array(pairs).T
    root = simhash._roots(500, a, b)
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {n: int(root[n]) for p in pairs if p[0] != p[1] for n in p}


def test_one_of_each_group_of_fingerprints_stays(spark):
    """Kept rows against all pairs of fingerprints, with ties, repeats, null ids and ids that are no numbers."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for c in range(5):
            w = list(base)
            for at in rng.choice(300, c, replace=False):
                w[at] = f"changed{at}"
            rows.append((len(rows), " ".join(w)))
    rows += [(100, None), (101, ""), (102, "short"), (103, "short"), (104, "other"), (104, "other"), (None, "short"), (None, "alone"), (None, "alone")]
    values = simhash.fingerprints(*simhash.shingle_hashes(pa.array([t for _, t in rows])))
    root = brute_components(values, simhash.DISTANCE)
    groups = {}
    for (i, _), r in zip(rows, root.tolist()):
        groups.setdefault(r, []).append(i)
    expected = sorted(min((i for i in g if i is not None), default=-1) for g in groups.values())
    assert 12 < len(expected) < 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("x")).repartition(6)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == expected
    named = docs.where("doc_id is not null").withColumn("doc_id", F.format_string("%05d", "doc_id"))
    assert sorted(int(r.doc_id) for r in simhash.drop_near_duplicates(named).collect()) == [i for i in expected if i >= 0]


def test_wu_manber(spark, docs):
    rows = ordered(docs.collect())
    pick = [t for _, t in rows if len(t) > 200][:6]
    items = [(1, pick[0][20:180]), (2, pick[1][:90]), (10, "one TWO"), (3, None), (4, ""), (5, "..."), (6, pick[0][20:180]), (7, "x" * 300)]
    items = [*items, (8, " ".join(pick[2].split()[3:11]))]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 100):
        found = {r.doc_id: r for r in decontaminate.find_occurrences(docs, benchmark, block_bytes=block_bytes).collect()}
        for i, t in rows:
            w, hit, names = split(t), set(), set()
            for item, u in items:
                u = split(u)
                n = min(10, len(u))
                windows = {tuple(u[k : k + n]) for k in range(len(u) - n + 1)} if n else set()
                for k in range(len(w) - n + 1):
                    if n and tuple(w[k : k + n]) in windows:
                        hit |= set(range(k, k + n))
                        names.add(str(item))
            spans = found[i].spans
            assert {p for s, e in zip(spans[::2], spans[1::2]) for p in range(s, e)} == hit
            assert (found[i].n_words, sorted(found[i].items)) == (len(w), sorted(names))
            assert found[i].score == "s"
    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows if not found[i].spans}
    assert decontaminate.decontaminate(docs, benchmark.where("false")).count() == docs.count()


def test_winnowing_guarantee_and_positions():
    rng = np.random.default_rng(2)
    shared = "".join(rng.choice(list("abcd"), winnow.K + winnow.WINDOW - 1))
    texts = ["".join(rng.choice(list("efgh"), n)) + shared + "".join(rng.choice(list("ijkl"), n)) for n in (0, 7, 300)]
    values, places, cut = winnow.winnow([*texts, "", "tiny", "twelve chars"])
    sets = [set(values[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:])]
    assert sets[0] & sets[1] & sets[2]
    assert [len(s) for s in sets[3:]] == [0, 1, 1]
    # Plain winnowing of one text: least hash of each window, the rightmost of equals.
    one = "abab" * 40 + texts[2]
    v, p, _ = winnow.winnow([one])
    hashes = []
    for i in range(len(one) - winnow.K + 1):
        x, _, _ = winnow.winnow([one[i : i + winnow.K]])
        hashes.append(int(x[0]))
    expected = {max(range(s, s + winnow.WINDOW), key=lambda i: (-hashes[i], i)) for s in range(len(hashes) - winnow.WINDOW + 1)}
    assert p.tolist() == sorted(expected) and v.tolist() == [hashes[i] for i in sorted(expected)]


def test_edited_texts(spark, docs):
    rows = ordered(docs.collect())
    done = {r.doc_id: r for r in winnow.map_with_next(docs, winnow.compare_edited, winnow.EDITED).collect()}
    texts = [t for _, t in rows]
    for (i, t), after in zip(rows, texts[1:] + texts[:1]):
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        r = done[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        prints = winnow.winnow([t, edited, after])
        strings = winnow.fingerprint_strings(prints[0], prints[2])
        assert (r.fingerprint, r.edited_fingerprint) == (strings[0], strings[1])
        sets = [{s[k : k + 8] for k in range(0, len(s), 8)} for s in strings]
        for other, value in ((1, r.near_edited), (2, r.near_next)):
            either = sets[0] | sets[other]
            assert value == pytest.approx(len(sets[0] & sets[other]) / len(either) if either else 1)
    assert winnow.fingerprint_documents(docs).count() == len(rows)


def test_packing(docs):
    from tokenizers import Tokenizer

    rows = ordered(docs.collect())
    whole = Tokenizer.from_file(tokenizer_path())
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    for size, windows in ((2048, 32), (64, 3)):
        pieces = packing.pack_documents(docs, tokenizer_path(), size=size, open_windows=windows).collect()
        for i, expected in ids.items():
            own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
            got = [x for p in own for x in np.frombuffer(bytes(p.ids), "<u4").tolist()]
            assert got == expected and all(p.doc_tokens == len(expected) for p in own)
            assert all(p.length == len(p.ids) // 4 and p.ids_crc32 == zlib.crc32(bytes(p.ids)) for p in own)
        used = {}
        for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
            assert p.offset == used.get(p.sequence_id, 0)
            used[p.sequence_id] = p.offset + p.length
        assert max(used.values()) <= size
        assert len(used) <= -(-sum(map(len, ids.values())) // (size - packing.LEAST_PIECE)) + 2


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(tokenizer_path()), packing.Encoder(tokenizer_path())
    odd = ["a  b", "a   b", " x", " x ", "x \n\n y", "a \n b", "it's fine. ok's!! a##b", "", "  ", "\n", "<|endoftext|> a <|endoftext|>b. c"]
    odd += ["a. b,, c|| ñandú. é! x's. 12. 12 ab12.", "\t a\t b", "a.\nB c.\n\nD e", "hello.) (a) 'b'", "a b   c", "漢字. 漢 😀! 😀"]
    assert own.encode(odd) == [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(odd, add_special_tokens=False)]


def test_quality(spark):
    rng = np.random.default_rng(3)
    prose = lambda: " ".join("".join(rng.choice(list("abcdefg"), rng.integers(2, 8))) for _ in range(rng.integers(5, 200)))
    junk = [lambda: prose().upper().replace(" ", "!! "), lambda: prose().replace(" ", " | "), lambda: "again " * 50]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, junk[i % 3]() if bad else prose(), "x"))
        labels.append((i, 0 if bad else 1))
    rows += [(400, None, "x"), (401, "", "x"), (402, " \n", "x"), (403, rows[1][1], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = quality.train(docs, spark.createDataFrame([*labels, (5, None), (6, 7)], "doc_id long, quality int"))
    found = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(found[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert found[400].score == found[401].score and found[403].score == found[1].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs.limit(3), none).collect()} == {0.5}


def test_quality_gradients():
    rng = np.random.default_rng(0)
    model = quality.fit([], np.zeros(0))
    for k, v in model.weights.items():
        model.weights[k] = rng.normal(0, 0.5, v.shape)
    x, bags, y = rng.normal(0, 1, (9, quality.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.forward(x, bags)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, g in quality.gradients(model, x, bags, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = model.weights[name][at]
        values = []
        for step in (1e-5, -1e-5):
            model.weights[name][at] = old + step
            values.append(loss())
        model.weights[name][at] = old
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(g[at], rel=1e-3, abs=1e-7)


def test_warc(spark, tmp_path):
    rows = [(5, "http://a/x?q=1#f", "<p>é</p>"), (2, "https://b", "<p>é</p>"), (9, None, None), (8, "no scheme", ""), (7, "http://c/\r\nd", "a\r\n\r\nb"), (1, "http://e", "x" * 100_000), (3, "http://f", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    captures = {r.capture_id: r for r in warc.assemble_captures(warc.read_records(spark, path)).collect()}
    assert set(captures) == {r[0] for r in rows}
    for i, url, html in rows:
        body, r = (html or "").encode(), captures[i]
        same = min(j for j, _, h in rows if (h or "") == (html or ""))
        assert r.record_type == ("response" if same == i else "revisit")
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (bytes(r.payload) == body) if same == i else (r.original.capture_id, r.original.payload_bytes) == (same, len(body))
        assert r.request.http_head is not None and r.metadata.record_id
        assert r.target_uri == (None if url is None else url.replace("\r\n", "%0D%0A"))
    with pytest.raises(ValueError):
        list(warc.members(warc.member(b"abc")[:-1]))
    empty = str(tmp_path / "none")
    warc.write_archives(pages.where("false"), empty)
    assert warc.assemble_captures(warc.read_records(spark, empty)).count() == 0


def test_url_filter(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es/", "block"), (None, "/", "block"), ("org", None, "block"), ("x.org", "/p", "allow")]
    urls = [None, "", "plain", "http://example.com", "http://EXAMPLE.com/en/a?b#c", "http://www.example.com/en/", "https://a.b.net/es/x", "https://a.b.net/esx", "ftp://x.org/page", "ftp://X.ORG/q", "http://notexample.com/en/", "://net/es/", "http://a..com/", "http://é.com/é"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(3, "http://example.com", "h")], "page_id long, url string, host string")
    got = urlfilter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower() if m else ""), (m[2] if m else "")
        fit = [(h + (p or ""), v) for h, p, v in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        best = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *best)
    nothing = urlfilter.filter_urls(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {(r.rule, r.verdict) for r in nothing.collect()} == {(None, "allow")}


def test_bloom_filter_has_no_false_negatives(spark):
    rules = spark.range(3000).select(F.concat(F.lit("h"), F.col("id"), F.lit(".com")).alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))
    pages = spark.range(6000).select("id", F.concat(F.lit("http://h"), F.col("id"), F.lit(".com/x")).alias("url"))
    assert urlfilter.filter_urls(pages, rules).where("verdict = 'block'").agg(F.max("id"), F.count("*")).first()[:] == (2999, 3000)


def test_chat_round_trip(spark):
    odd = ["", None, "plain", "</s>", r"\</s>", r"\\[INST] x", "a <s> b </s> c", "[ROLE 61] q [/ROLE]", "ends with \\", "[INST] [/INST]", "<<SYS>>\n<</SYS>>", "[[INST]]", "é漢😀 </s>", "$1 \\1 $0"]
    roles = ["user", "assistant", "system", None, "tool]", "ü"]
    rows = [(c, t, roles[(c + t) % 6], odd[(c * 5 + t) % len(odd)]) for c in range(14) for t in range(7)]
    rows += [(None, 0, "user", "x"), (20, None, "user", "first"), (20, 1, "user", "b"), (20, 1, "user", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.format_conversations(table).collect()}
    assert set(got) == {r[0] for r in rows}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for c, r in got.items():
        own = sorted((x for x in rows if x[0] == c), key=key)
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3] or "") for x in own]
        assert r.escaped or "\\" not in r.formatted.replace("ends with \\", "").replace("$1 \\1 $0", "")
