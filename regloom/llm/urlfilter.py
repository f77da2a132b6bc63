"""URL filtering: a blocked Bloom filter in front of an exact join with the rules.

A rule is a canonical URL without its scheme: a host and the beginning of a path. It fits
every URL on that host or on a subdomain whose path begins with the rule's; of several
fitting rules the longest decides. For each URL the few strings that a fitting rule could
have (its host suffixes times the path lengths in use) are tested against the filter;
those that pass meet the rules in an equi-join, which removes false positives.

Defined results: a null URL, or one without ``://``, has empty host and path. A rule with a
null host is ignored, a null path is empty. Repeated rules count once; of rules that differ
in the verdict only, ``block`` wins. Repeated rows each get a verdict. Without rules every
URL gets the default verdict. Extra columns are kept unless they bear a name of a result
column, which replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each rule, and the most bytes a filter may have. Beyond that size
#: the filter passes more false positives; results stay the same.
BITS_PER_RULE = 16
MAX_FILTER_BYTES = 8 << 20
#: A block is eight 64-bit words, each with one bit of every key.
WORDS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next of ``/?#``, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def canonical_path(url: Column) -> Column:
    """What follows the host, up to a query or fragment."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: Column) -> Column:
    """The bit of a key in a word of its block: six bits of a second hash for each word."""
    second = F.xxhash64(F.lit("bits"), key)
    place = F.call_function("shiftrightunsigned", second, (word * 6).cast("int")).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row for each distinct rule: ``key``, ``path_length``, ``labels`` of its host and ``rule_verdict``."""
    key = F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit("")))
    return (
        rules.where(F.col("host").isNotNull())
        .groupBy(key.alias("key"), F.length(F.coalesce("path", F.lit(""))).alias("path_length"))
        .agg(F.max("verdict").alias("rule_verdict"), F.max(F.size(F.split("host", r"\.", -1))).alias("labels"))
    )


def filter_blocks(n_rules: int) -> int:
    """Blocks for so many rules, within the size limit."""
    wanted = max(1, -(-n_rules * BITS_PER_RULE // (64 * WORDS)))
    return min(wanted, MAX_FILTER_BYTES // (8 * WORDS))


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """The filter as one row with an array of ``blocks * 8`` words."""
    spark = rules.sparkSession
    words = (
        rules.select(_block(F.col("key"), blocks).alias("block"), "key", F.explode(F.sequence(F.lit(0), F.lit(WORDS - 1))).alias("word"))
        .groupBy((F.col("block") * WORDS + F.col("word")).alias("place"))
        .agg(F.bit_or(_bit(F.col("key"), F.col("word"))).alias("bits"))
    )
    everywhere = spark.range(blocks * WORDS).select(F.col("id").alias("place"))
    dense = everywhere.join(words, "place", "left").select("place", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "bits")))
    return dense.groupBy().agg(F.transform(ordered, lambda x: x["bits"]).alias("filter"))


def may_contain(filter_words: Column, key: Column, blocks: int) -> Column:
    """Whether all eight bits of a key are set in its block."""
    first = _block(key, blocks) * WORDS
    found = F.lit(True)
    for word in range(WORDS):
        bit = _bit(key, F.lit(word))
        found = found & (F.element_at(filter_words, (first + word + 1).cast("int")).bitwiseAND(bit) != 0)
    return found


def candidate_keys(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    """Every rule that could fit: each suffix of the host with each beginning of the path in use.

    A suffix of more labels than any rule's host has is none.
    """
    whole = F.split(host, r"\.", -1)
    labels = F.slice(whole, -F.least(F.size(whole), F.lit(most_labels)), F.lit(most_labels))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    usable = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: F.length(path) >= n)
    return F.flatten(F.transform(suffixes, lambda s: F.transform(usable, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))


def filter_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null without one) and ``verdict`` to every row.

    ``rules`` has the columns ``host``, ``path`` and ``verdict``. Its number of rows and the
    distinct lengths of its paths, which are bounded by the longest rule, go to the driver.
    """
    keys = prepare_rules(rules)
    sizes = keys.groupBy("path_length").agg(F.count(F.lit(1)).alias("count"), F.max("labels").alias("labels")).collect()
    lengths = sorted(r["path_length"] for r in sizes)
    blocks = filter_blocks(sum(r["count"] for r in sizes))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    # The table's columns travel as one struct, so that no name of theirs can clash.
    parsed = pages.select(
        F.struct(*[pages[c] for c in kept], F.lit(0).alias("_none")).alias("kept"),
        canonical_host(pages[url]).alias("host"),
        canonical_path(pages[url]).alias("path"),
    )
    if not lengths:
        return _named(parsed.select("kept", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")), kept)
    words, most_labels = bloom_filter(keys, blocks).scalar(), max(r["labels"] for r in sizes)
    hits = F.filter(candidate_keys(F.col("host"), F.col("path"), lengths, most_labels), lambda k: may_contain(F.col("filter"), k, blocks))
    tested = parsed.withColumn("filter", words).select("kept", "host", "path", hits.alias("hits"))
    # Rows without a possible hit need no rule: they leave here and are not moved.
    passed = tested.where(F.size("hits") == 0).select("kept", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # One row for each possible hit.
    possible = tested.where(F.size("hits") > 0).withColumn("row", F.monotonically_increasing_id()).select("kept", "host", "path", "row", F.explode("hits").alias("key"))
    exact = keys.select("key", "rule_verdict")
    best = F.max(F.when(F.col("rule_verdict").isNotNull(), F.struct(F.length("key").alias("n"), F.col("key"), F.col("rule_verdict"))))
    judged = (
        possible.join(exact, "key", "left")
        .groupBy("row")
        .agg(F.first("kept").alias("kept"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
        .select("kept", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
    )
    return _named(passed.unionByName(judged), kept)


def _named(rows: DataFrame, kept: list[str]) -> DataFrame:
    return rows.select(*[F.col("kept").getField(c).alias(c) for c in kept], "host", "path", "rule", "verdict")
