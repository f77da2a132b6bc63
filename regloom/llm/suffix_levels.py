"""Suffix-array dedup over a logarithmic family of indexes: no run of ``length`` bytes stays that starts earlier.

Each new batch of documents gets a suffix array, which is scanned against the arrays of the
levels that exist, and becomes a level itself. Before the next batch, levels of equal size
merge, so there is at most one of each size 1, 2, 4, ... batches, and a suffix is rewritten
a logarithmic number of times.

The arrays are sparse: of every ``length`` bytes at least one suffix is in them, the one that
begins with the anchor (the ``seed`` bytes of least hash). The order of suffixes is that of
the hashes of their first ``seed`` bytes, not of the bytes: a scan looks for equal beginnings
only, which any order brings together, and this one splits an array into buckets of even
size. A bucket of a level is one row, its entries sorted, so a scan merges sorted arrays of
the same bucket; levels are bucketed tables and are not shuffled for it.

An entry stands for all windows of ``length`` bytes with its anchor, compared by hash: equal
entries repeat as a whole. An anchor that begins different entries is marked as such in the
level; the windows of its entries, of old documents too, are compared when ``resolve`` is
called: first groups of eight by the bytes that all of them hold, then, where these are met
again, one by one. See ``repeats`` for how that stays even under hot passages.

"Earlier" is an earlier batch, in a batch a smaller id, in a document an earlier start.

Defined results: null and empty texts have no bytes; a text of fewer than ``length`` bytes
loses nothing. Null ids come first, rows with equal ids are in the order of their blocks.
``kept`` is binary, since a removed run may begin or end inside a character, unless
``characters`` are kept whole. Result columns
replace columns of the same name, other columns are kept. A text is held in memory whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm import repeats
from regloom.llm import text as tx
from regloom.llm.repeats import Shape
from regloom.session import scratch_path

LENGTH, SEED, GROUP = 100, 24, 8

RESULTS = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("repeats", T.ArrayType(T.LongType())),
        T.StructField("kept", T.BinaryType()),
    ]
)

#: An entry of a level: anchor, content, block, first window, windows (0: several contents), reach.
LEVEL = ("<u8", "<u8", "<i8", "<u4", "<u2", "<u2")


def _scan_bucket(sent_rows: list[dict], levels: list[bytes]) -> tuple[list[np.ndarray], repeats.Found]:
    """The new level's entries for a bucket, and what its suffixes repeat."""
    (anchor, content, order, at, n, reach), block, found = repeats.received(sent_rows)
    sort = np.lexsort((at, block, order, content, n == 0, anchor))
    anchor, content, at, n, reach, block = (x[sort] for x in (anchor, content, at, n, reach, block))
    first = np.flatnonzero(repeats.changes(anchor))
    sizes = np.diff(np.append(first, len(anchor)))
    heads = anchor[first]
    # Of each anchor, what the levels know: nothing, one content, or that there are several.
    known, several = np.zeros(len(heads), bool), np.zeros(len(heads), bool)
    old_content, old_block = np.zeros(len(heads), np.uint64), np.zeros(len(heads), np.int64)
    old_at, old_n, old_reach = np.zeros(len(heads), np.uint32), np.zeros(len(heads), np.uint16), np.zeros(len(heads), np.uint16)
    for blob in levels:
        l_anchor, l_content, l_block, l_at, l_n, l_reach = repeats.unpack(LEVEL, blob)
        if not len(l_anchor):
            continue
        place = np.minimum(np.searchsorted(l_anchor, heads), len(l_anchor) - 1)
        met = np.flatnonzero(l_anchor[place] == heads)
        place = place[met]
        several[met] |= l_n[place] == 0
        one = l_n[place] > 0
        met, place = met[one], place[one]
        known[met] = True
        old_content[met], old_block[met] = l_content[place], l_block[place]
        old_at[met], old_n[met], old_reach[met] = l_at[place], l_n[place], l_reach[place]
    # Several contents in a newer level: the old entry was asked for then.
    known &= ~several
    whole = n > 0
    fresh = (repeats.changes(anchor, content) | ~whole) & ~(np.repeat(known, sizes) & whole & (content == np.repeat(old_content, sizes)))
    again = ~fresh
    found.add(block[again], at[again], n[again])
    kinds = (np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first) + known
    split = (kinds > 1) | several
    # A single mark of several contents within one block counts as several.
    split |= np.logical_or.reduceat(~whole, first) if len(first) else split
    wanted = np.repeat(split, sizes) & fresh & whole
    found.want(block[wanted], at[wanted], n[wanted], reach[wanted])
    ask = known & split
    found.want(old_block[ask], old_at[ask], old_n[ask], old_reach[ask])
    # New anchors, and those that have just got several contents.
    enter = np.flatnonzero(~several & (~known | split))
    rows = first[enter]
    return [heads[enter], content[rows], block[rows], at[rows], np.where(split[enter], 0, n[rows]), reach[rows]], found


def _merged(older: bytes, newer: bytes) -> bytes:
    """Two sorted arrays as one; where both have an anchor the newer knows of several contents."""
    a, b = repeats.unpack(LEVEL, older), repeats.unpack(LEVEL, newer)
    stay = ~np.isin(a[0], b[0], assume_unique=True)
    columns = [np.concatenate([x[stay], y]) for x, y in zip(a, b)]
    sort = np.argsort(columns[0], kind="stable")
    return repeats.pack(LEVEL, [c[sort] for c in columns])


class SuffixLevels:
    """The family of indexes over all batches appended so far."""

    def __init__(self, spark: SparkSession, *, id: str, text: str, length: int = LENGTH, seed: int = SEED):
        self.spark, self.id, self.text = spark, id, text
        self.shape = Shape(True, length, seed, GROUP)
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = repeats.BUCKETS_PER_PARTITION * self.parts
        #: (batches in it, table) from the largest to the smallest.
        self.levels: list[tuple[int, str]] = []
        self.blocks: list[DataFrame] = []
        self.found: list[DataFrame] = []

    def _save(self, rows: DataFrame) -> str:
        name = f"regloom_level_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.parts, "bucket").option("compression", "zstd").saveAsTable(name)
        return name

    def _level(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _merge_equal(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, older), (_, newer) = self.levels[-2:]

            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for bucket, a, b in zip(*(tx.values(batch.column(i)) for i in range(3))):
                        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([_merged(a or b"", b or b"")], pa.binary())], ["bucket", "level"])

            both = self._level(older).join(self._level(newer).withColumnRenamed("level", "newer"), "bucket", "full")
            name = self._save(both.select("bucket", "level", "newer").mapInArrow(tx.tidy(work), "bucket long, level binary"))
            self.levels[-2:] = [(2 * size, name)]
            for gone in (older, newer):
                self.spark.sql(f"drop table {gone}")

    def append(self, batch: DataFrame) -> None:
        """Builds the suffix array of a batch, scans it against the levels and adds it to them."""
        self._merge_equal()
        blocks = repeats.write_blocks(batch, self.id, self.text, len(self.blocks))
        rows = repeats.gathered(repeats.seed_entries(blocks, self.shape, self.id, self.text, self.buckets))
        names = []
        for i, (_, table) in enumerate(self.levels):
            names.append(f"level_{i}")
            rows = rows.join(self._level(table).withColumnRenamed("level", names[-1]), "bucket", "left")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = [("bucket", pa.int64()), ("level", pa.binary()), ("block", pa.int64()), ("spans", pa.binary()), ("wanted", pa.binary())]
            for batch in batches:
                for bucket, entries, *levels in zip(*(tx.values(batch.column(i)) for i in range(2 + len(names)))):
                    new, found = _scan_bucket(entries, [x for x in levels if x])
                    out = [(bucket, repeats.pack(LEVEL, new), None, None, None)]
                    out += [(bucket, None, block, spans, wanted) for _, block, _, spans, wanted in found.rows]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(kinds)], [x for x, _ in kinds])

        path = scratch_path(self.spark, "scan")
        rows.select("bucket", "sent", *names).mapInArrow(tx.tidy(work), "bucket long, level binary, block long, spans binary, wanted binary").write.parquet(path)
        scanned = self.spark.read.parquet(path)
        self.blocks.append(blocks)
        self.found.append(scanned.where("level is null").select("block", "spans", "wanted"))
        level = scanned.where("level is not null").select("bucket", "level").repartition(self.parts, "bucket")
        self.levels.append((1, self._save(level)))

    def resolve(self, result, schema: T.StructType) -> DataFrame:
        """Compares the windows still open and applies ``result`` to every block of every batch."""
        found = reduce(DataFrame.unionByName, self.found)
        options = (self.shape, self.id, self.text, self.buckets)
        narrow, path = scratch_path(self.spark, "cores"), scratch_path(self.spark, "windows")
        cores = reduce(DataFrame.unionByName, [repeats.core_entries(b, found, *options) for b in self.blocks])
        repeats.repeated_cores(cores).write.parquet(narrow)
        close = self.spark.read.parquet(narrow)
        windows = reduce(DataFrame.unionByName, [repeats.window_entries(b, close, *options) for b in self.blocks])
        repeats.repeated_windows(windows).write.parquet(path)
        spans = found.select("block", "spans").unionByName(self.spark.read.parquet(path))
        done = [repeats.finish(b, spans, self.shape, self.id, self.text, result, schema) for b in self.blocks]
        return reduce(DataFrame.unionByName, done)

    def close(self) -> None:
        """Drops the levels; results of ``resolve`` stay valid."""
        for _, table in self.levels:
            self.spark.sql(f"drop table {table}")
        self.levels = []


def _whole_characters(data: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Covers all bytes of a character of which one is covered."""
    if not len(data):
        return covered
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return (np.bincount(character, covered) > 0)[character]


def _result(rows: pa.RecordBatch, units: repeats.Units, covered: np.ndarray, keep: list[str], characters: bool) -> pa.RecordBatch:
    if characters:
        covered = _whole_characters(units.data, covered)
    starts, ends, firsts = repeats.runs(covered, units.offsets)
    begin = np.repeat(units.offsets[:-1], np.diff(firsts))
    flat = np.stack([starts - begin, ends - begin], 1).reshape(-1)
    place = np.concatenate([[0], np.cumsum(~covered)])[units.offsets]
    results = [
        pa.array(np.diff(units.offsets), pa.int64()),
        pa.array(np.diff(units.offsets) - np.diff(place), pa.int64()),
        pa.ListArray.from_arrays(pa.array(firsts * 2, pa.int32()), pa.array(flat, pa.int64())),
        pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(place.astype(np.int32)), pa.py_buffer(units.data[~covered])]),
    ]
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *results], [*keep, *RESULTS.names])


def dedup_suffixes(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, batches: int = 4, length: int = LENGTH,
    seed: int = SEED, characters: bool = False,
) -> DataFrame:
    """Adds ``n_bytes``, ``n_removed``, ``repeats`` (flat pairs of start and end, in bytes) and ``kept``.

    With ``characters``, runs are widened to whole characters in the end, so ``kept`` is UTF-8.

    The documents are appended in so many batches of about equal size, by ascending id.
    """
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in RESULTS.names]
    rows = documents.select(*dict.fromkeys([*wanted, id, text]))
    cuts = sorted(set(rows.approxQuantile(id, [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    number = reduce(lambda a, b: a + b, [F.coalesce((F.col(id) > c).cast("int"), F.lit(0)) for c in cuts], F.lit(0))
    family = SuffixLevels(documents.sparkSession, id=id, text=text, length=length, seed=seed)
    try:
        for i in range(len(cuts) + 1):
            family.append(rows.where(number == i))
        schema = T.StructType([*(documents.schema[c] for c in wanted), *RESULTS.fields])
        return family.resolve(lambda r, units, covered: _result(r, units, covered, wanted, characters), schema)
    finally:
        family.close()

