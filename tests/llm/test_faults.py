"""Inputs that once broke an operator or its result."""

import random
import re
import time

from pyspark.sql import functions as F

from regloom.llm import chat, substrings, text, urlfilter, warc
from regloom.session import scratch_path


def formatted(spark, turns):
    rows = [(i, n, role, said) for i, some in enumerate(turns) for n, (role, said) in enumerate(some)]
    done = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.escaped) for r in done.collect()}


def test_chat_with_control_strings_that_name_no_role(spark):
    said = [" </s>[ROLE FF] x [/ROLE]", "x </s>[ROLE ABC] y [/ROLE]", "</s>[ROLE A] [/ROLE]", "[ROLE C3] [ROLE ] [/ROLE]", r"\\[ROLE FFFF] \</s>"]
    turns = [[(role, t), ("assistant", t[::-1])] for t in said for role in ("assistant", "user", None, "x", "")]
    found = formatted(spark, turns)
    assert [found[i][0] for i in range(len(turns))] == turns


def test_chat_over_the_control_alphabet(spark):
    r = random.Random(12)
    pieces = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE ", "[/ROLE]", "[ROLE FF]", "[ROLE -]", "[ROLE 61]", "[ROLE 616]", "]", "\\", "\\\\", " ", "\n", "a", "é", "F", "0"]
    roles = ["system", "user", "assistant", None, "", "a", "]", "-", "[ROLE 61]"]
    turns = [[(r.choice(roles), "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))) for _ in range(r.randint(1, 4))] for _ in range(600)]
    found = formatted(spark, turns)
    assert [found[i][0] for i in range(len(turns))] == turns


def test_chat_with_long_runs_of_backslashes(spark):
    turns = [[("user", "\\" * 40_000), ("assistant", "\\" * 20_000 + "</s>" + "\\" * 40_000 + "x")]]
    started = time.monotonic()
    assert formatted(spark, turns)[0][0] == turns[0]
    assert time.monotonic() - started < 60


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_polynomials_do_not_tell_apart(spark):
    rest = " ".join(f"w{i}" for i in range(19))
    for n in (64, 256, 1024, 4096):
        docs = [(1, f"{thue_morse(n, 'a', 'b')} {rest}"), (2, f"{thue_morse(n, 'b', 'a')} {rest}"), (3, f"{thue_morse(n, 'b', 'a')} {rest}")]
        done = {r.doc_id: r.n_removed for r in substrings.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        assert done == {1: 0, 2: 0, 3: 20}, n


def test_substrings_of_long_words(spark):
    """A text of five MB whose words are of all lengths, against sets of windows."""
    r = random.Random(3)
    words = [r.choice("ab") * r.choice([1, 2, 63, 64, 65, 700]) for _ in range(38_000)]
    whole = " ".join(words)
    assert len(whole) > 5_000_000
    done = substrings.dedup_substrings(spark.createDataFrame([(1, whole), (2, "x " + " ".join(words[100:150]))], "doc_id long, text string"))
    found = {r.doc_id: (r.n_words, r.n_removed) for r in done.collect()}
    seen, hit = set(), set()
    for i in range(len(words) - 19):
        w = tuple(words[i : i + 20])
        if w in seen:
            hit |= set(range(i, i + 20))
        seen.add(w)
    assert found == {1: (38_000, len(hit)), 2: (51, 50)}


def test_word_hashes_differ():
    import numpy as np

    data = np.frombuffer(b"a" * 63 + b" " + b"a" * 64 + b" " + b"a" * 64 + b" " + b"a" * 65, np.uint8)
    starts, ends, _ = text.word_bounds(data, np.array([0, len(data)]), text.SPACE)
    h = text.word_hashes(data, starts, ends)
    assert h[1] == h[2] and len(set(h.tolist())) == 3


def test_pages_without_a_possible_hit_are_not_moved(spark):
    rules = spark.createDataFrame([("bad.example", "/x", "block"), ("com", "", "allow")], "host string, path string, verdict string")
    urls = [None, "", "http://" + "a." * 3000 + "org/", "http://www.bad.example/xy", "http://bad.example/y", "http://q.com", *[f"http://h{i}.org/p" for i in range(300)]]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = urlfilter.filter_urls(pages, rules)
        plan = done._jdf.queryExecution().executedPlan().toString()
        found = {r.page_id: (r.rule, r.verdict) for r in done.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == {i: ("bad.example/x", "block") if i == 3 else ("com", "allow") if i == 5 else (None, "allow") for i in range(len(urls))}
    union = re.split(r"\n(?=[: +-]*Union)", plan)[-1]
    branch = re.split(r"\n   [:+]- ", union)[1]
    assert "Exchange hashpartitioning(key" not in branch and "hashpartitioning(row" not in branch
    assert "hashpartitioning(key" in plan


def test_more_labels_than_any_rule(spark):
    keys = urlfilter.candidate_keys(F.col("h"), F.lit("/"), [0], 2)
    found = spark.createDataFrame([("a.b.c.d",), ("d",), ("",)], "h string").select(keys.alias("k")).collect()
    assert [r.k for r in found] == [["c.d", "d"], ["d"], [""]]


def test_captures_that_refer_to_nothing_are_dealt_evenly(spark):
    rows = [(i, f"http://h{i}.org/p", "same" if i % 3 == 0 else f"page {i}") for i in range(600)]
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        captures = warc.assemble_captures(warc.read_records(spark, path)).withColumn("task", F.spark_partition_id())
        found = captures.select("capture_id", "record_type", "original.capture_id", "task").toDF("id", "kind", "of", "task").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.id, r.kind, r.of) for r in found) == [(i, "revisit", 0) if i % 3 == 0 and i else (i, "response", None) for i in range(600)]
    tasks = [r.task for r in found if r.kind == "response"]
    assert max(map(tasks.count, set(tasks))) < 0.3 * len(tasks)
