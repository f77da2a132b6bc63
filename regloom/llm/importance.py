"""Target-distribution importance resampling: documents drawn by how much they look like a target.

Features are runs of words, hashed into buckets. A bucket's gain is the scaled log of its share
in the target over its share in the corpus, both smoothed; a document's weight is the sum of the
gains of its features, looked up in one array. Weight plus Gumbel noise, fixed by seed and id,
is the score; the highest scores are drawn, which samples without replacement in proportion to
the exponential of the weights.

The cutoff is found by weighted median-of-medians selection. Keys (score, id) lie in sorted
blocks. Each round every block gives the median of its keys that are still open; the median of
these, weighted by how many keys each block has open, is the pivot. At least a quarter of the
open keys lie on either side of it, so each round discards at least that share, until the pivot
is the cutoff key itself. Once most keys are discarded the open ones are written anew. Only the
winners are sorted.

Defined results: A-Z are lowered, words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a null or empty
text has none, and weight 0. Ids are integers. A null id counts as above all others. Of documents
with equal keys (repeated rows) as many are drawn as fit. Empty tables, on either side, are no
bar: gains then come from smoothing alone. A text is read whole by one task, in one piece.
Columns named as results are replaced.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm import text as tx
from regloom.llm.ship import ship
from regloom.session import scratch_path

RUN, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
#: Keys in a block.
BLOCK = 1 << 16
#: Bytes of a run hashed for many runs at once; longer runs are hashed one by one.
STEPS = 48
#: The id that stands for none.
NO_ID = 2**63 - 1

RESULTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score")])


def _crc_table() -> np.ndarray:
    """The effect of each byte on a crc32, from its polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


CRC = _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of every stretch of bytes."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, STEPS + 1), kind="stable")
    place, size = starts[order], sizes[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    short = int(np.searchsorted(-np.minimum(size, STEPS + 1), -STEPS))
    for k in range(STEPS):
        # Sorted from long to short: those with a byte at k come first.
        n = int(np.searchsorted(-size[short:], -k)) + short
        if n == short:
            break
        part = crc[short:n]
        crc[short:n] = CRC[(part ^ data[place[short:n] + k]) & np.uint32(255)] ^ (part >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(short):
        crc[i] = zlib.crc32(data[place[i] : place[i] + size[i]])
    found = np.empty_like(crc)
    found[order] = crc
    return found


def features_of(column: pa.Array, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of every feature, the text it belongs to, and the words of each text."""
    data, offsets = tx.utf8(column)
    data = tx.LOWERED[data]
    starts, ends, firsts = tx.word_bounds(data, offsets, tx.PUNCTUATION)
    words = np.diff(firsts)
    owner = np.repeat(np.arange(len(words)), words)
    if run > 1 and len(starts):
        # Words end to end with one space between, so that a run is a stretch of bytes.
        sizes = ends - starts
        now = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        joined = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        joined[np.repeat(now, sizes) + within] = data[np.repeat(starts, sizes) + within]
        data, starts, ends = joined, now, now + sizes
    found, owners = [], []
    for n in range(1, run + 1):
        begin = np.arange(len(starts) - n + 1)
        begin = begin[owner[begin] == owner[begin + n - 1]]
        found.append(crc32_of(data, starts[begin], ends[begin + n - 1]) % np.uint32(buckets))
        owners.append(owner[begin])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), words


def bucket_counts(rows: DataFrame, text: str, run: int, buckets: int) -> DataFrame:
    """How many features of all texts each bucket holds; buckets without any are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.entering("importance")
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in tx.slices(batch, text):
                counts += np.bincount(features_of(part.column(text), run, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    return rows.select(text).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, *, text: str = "text", run: int = RUN, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket; the driver holds two numbers for each."""
    here = bucket_counts(documents, text, run, buckets).withColumn("side", F.lit(0))
    there = bucket_counts(target, text, run, buckets).withColumn("side", F.lit(1))
    s, t = [0] * buckets, [0] * buckets
    for r in here.unionByName(there).collect():
        (t if r.side else s)[r.bucket] = r.n
    total_s, total_t = sum(s), sum(t)
    return [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]


def noise(id: int | None, seed: int) -> int:
    """Scaled Gumbel noise, the same for an id at every run."""
    h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(documents: DataFrame, gain: list[int], *, id: str = "doc_id", text: str = "text", run: int = RUN, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """Adds to the kept columns (all, unless named) words, features, weight and score."""
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in (*RESULTS.names, "rank")]
    lookup, buckets = np.array(gain, np.int64), len(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.entering("importance")
        for batch in batches:
            for part in tx.slices(batch, text):
                bucket, owner, words = features_of(part.column(text), run, buckets)
                features = np.bincount(owner, minlength=len(words))
                # Sums of whole numbers, taken as differences of running sums: exact.
                order = np.argsort(owner, kind="stable")
                sums = np.concatenate([[0], np.cumsum(lookup[bucket[order]])])
                ends = np.cumsum(features)
                weight = sums[ends] - sums[ends - features]
                score = weight + np.array([noise(i, seed) for i in part.column(id).to_pylist()], np.int64)
                results = [pa.array(x.astype(np.int64)) for x in (words, features, weight, score)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in wanted), *results], [*wanted, *RESULTS.names])

    schema = T.StructType([*(documents.schema[c] for c in wanted), *RESULTS.fields])
    return documents.select(*dict.fromkeys([*wanted, id, text])).mapInArrow(work, schema)


# Selection. A key is (score, id); it comes before another with a lower score, or with the same
# and a larger id. Blocks hold keys in that order.


def _sorted(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.lexsort((ids, -score))


def key_blocks(keys: DataFrame) -> DataFrame:
    """Keys in sorted blocks; ``keys`` has columns ``score`` and ``id``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            score, ids = (np.concatenate(x) for x in zip(*held))
            order = _sorted(score, ids)
            columns = [pa.array([x[order]], pa.list_(pa.int64())) for x in (score, ids)]
            return pa.RecordBatch.from_arrays(columns, ["score", "id"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                if held and sum(len(x) for x, _ in held) + part.num_rows > BLOCK:
                    yield block()
                    held = []
                held.append(tuple(part.column(c).to_numpy(zero_copy_only=False) for c in ("score", "id")))
        if held:
            yield block()

    return keys.mapInArrow(work, "score array<bigint>, id array<bigint>")


def _before(score: np.ndarray, ids: np.ndarray, key: tuple[int, int], through: bool) -> int:
    """How many of a block's keys come before a key, or up to it."""
    low, high = np.searchsorted(-score, -key[0], "left"), np.searchsorted(-score, -key[0], "right")
    return int(low + np.searchsorted(ids[low:high], key[1], "right" if through else "left"))


Bounds = tuple[tuple[int, int] | None, tuple[int, int] | None]


def _open(score: np.ndarray, ids: np.ndarray, after: tuple[int, int] | None, before: tuple[int, int] | None) -> tuple[int, int]:
    """Where a block's open keys, after one key and before another, begin and end."""
    return (0 if after is None else _before(score, ids, after, True), len(score) if before is None else _before(score, ids, before, False))


def _block_arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for score, ids in zip(batch.column("score"), batch.column("id")):
        yield score.values.to_numpy(zero_copy_only=False), ids.values.to_numpy(zero_copy_only=False)


def _halves(blocks: DataFrame, bounds: Bounds, pivot: tuple[int, int] | None) -> list:
    """Of every block: open keys before the pivot, equal to it and after it, and the medians of both sides.

    Without a pivot all open keys count as after it. One row of numbers for each block of
    ``BLOCK`` keys comes to the driver.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for score, ids in _block_arrays(batch):
                begin, end = _open(score, ids, *bounds)
                low = begin if pivot is None else max(begin, min(end, _before(score, ids, pivot, False)))
                high = begin if pivot is None else max(begin, min(end, _before(score, ids, pivot, True)))
                row = [low - begin, high - low, end - high]
                for a, b in ((begin, low), (high, end)):
                    m = (a + b) // 2
                    row += [int(score[m]), int(ids[m])] if b > a else [0, 0]
                if end > begin:
                    rows.append(row)
        names = ["before", "same", "after", "low_score", "low_id", "high_score", "high_id"]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, names)

    schema = "before long, same long, after long, low_score long, low_id long, high_score long, high_id long"
    return blocks.mapInArrow(work, schema).collect()


def weighted_median(medians: list[tuple[tuple[int, int], int]]) -> tuple[int, int]:
    """The key at which half of the weight is reached, in the order of keys."""
    ordered = sorted(medians, key=lambda m: (-m[0][0], m[0][1]))
    half, reached = sum(w for _, w in ordered), 0
    for key, weight in ordered:
        reached += weight
        if 2 * reached >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, draw: int) -> tuple[int, int] | None:
    """The last key drawn, if so many are drawn from the first on; None if there are not so many.

    ``keys`` has columns ``score`` and ``id``, neither null.
    """
    spark = keys.sparkSession

    def written(rows: DataFrame) -> DataFrame:
        path = scratch_path(spark, "keys")
        key_blocks(rows).write.parquet(path)
        return spark.read.parquet(path)

    blocks = written(keys)
    bounds: Bounds = (None, None)
    rows = _halves(blocks, bounds, None)
    stored = left = sum(r.after for r in rows)
    if draw < 1 or draw > left:
        return None
    medians = [((r.high_score, r.high_id), r.after) for r in rows if r.after]
    while True:
        pivot = weighted_median(medians)
        rows = _halves(blocks, bounds, pivot)
        before, same = sum(r.before for r in rows), sum(r.same for r in rows)
        if before < draw <= before + same:
            return pivot
        if draw <= before:
            bounds, left = (bounds[0], pivot), before
            medians = [((r.low_score, r.low_id), r.before) for r in rows if r.before]
        else:
            bounds, draw, left = (pivot, bounds[1]), draw - before - same, left - before - same
            medians = [((r.high_score, r.high_id), r.after) for r in rows if r.after]
        if 8 * left < stored and stored > 16 * BLOCK:
            blocks, stored, bounds = written(_remaining(blocks, bounds)), left, (None, None)


def _remaining(blocks: DataFrame, bounds: Bounds) -> DataFrame:
    """The open keys as rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for score, ids in _block_arrays(batch):
                begin, end = _open(score, ids, *bounds)
                yield pa.RecordBatch.from_arrays([pa.array(score[begin:end]), pa.array(ids[begin:end])], ["score", "id"])

    return blocks.mapInArrow(work, "score long, id long")


def ranked(winners: DataFrame, order: list[Column], path: str) -> DataFrame:
    """Adds ``rank``, 1, 2, 3... in an order over all rows, without bringing them to one task.

    Rows are written range by range; only the number of rows of each range comes to the driver.
    """
    spark = winners.sparkSession
    winners.orderBy(*order).withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = sorted((r["_range"], r.n) for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    first, firsts = 0, []
    for part, n in counts:
        firsts.append((part, first))
        first += n
    offsets = spark.createDataFrame(firsts, "_range int, _first long")
    # One row for each range: as few as there are partitions of a shuffle.
    rank = F.col("_first") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(offsets), "_range").withColumn("rank", rank).drop("_range", "_place", "_first")


def resample(
    documents: DataFrame,
    target: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds to the kept columns (all, unless named) ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of N documents with at least ``least_words`` words, floor(``percent`` * N / 100) are drawn;
    ``rank`` is their place by falling score, then by id, and null for all others.
    """
    spark = documents.sparkSession
    ship(spark)
    keep = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in (*RESULTS.names, "rank")]
    gain = gains(documents, target, text=text, run=run, buckets=buckets)
    path = scratch_path(spark, "weighed")
    source = documents.withColumn("_id", F.col(id).cast("long"))
    weighed(source, gain, id="_id", text=text, run=run, seed=seed, keep=[*keep, "_id"]).write.parquet(path)
    rows = spark.read.parquet(path)
    key = F.coalesce("_id", F.lit(NO_ID))
    eligible = F.col("n_words") >= least_words
    draw = percent * rows.where(eligible).count() // 100
    last = cutoff(rows.where(eligible).select("score", key.alias("id")), draw)
    none = F.lit(None).cast("long")
    if last is None:
        return rows.drop("_id").withColumn("rank", none)
    won = eligible & ((F.col("score") > last[0]) | ((F.col("score") == last[0]) & (key <= last[1])))
    winners = ranked(rows.where(won), [F.desc("score"), key.asc()], scratch_path(spark, "winners"))
    # Rows with the cutoff's own key may be more than are drawn.
    winners = winners.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return winners.unionByName(rows.where(~won).withColumn("rank", none)).drop("_id")
