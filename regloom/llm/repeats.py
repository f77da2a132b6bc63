"""What the two substring operators share: blocks of documents, segments around anchors, windows.

A *unit* is a word or a byte, a *window* any run of ``length`` units of one text. In every
window one seed (a run of ``seed`` units) is the anchor: the one of least hash, the rightmost
of equals. Windows next to each other mostly have the same anchor; such a stretch is a
*segment*. Equal windows have equal anchors, so repeats are sought among segments with equal
anchors only, and two equal segments have all their windows in common.

Documents are kept as *blocks*: rows of about ``BLOCK_BYTES`` of text, written once to a
table that is bucketed by block. Everything found about a block comes back to it by a join
that does not move the texts. Within a block, equal entries are merged before they leave it,
so that a passage that a third of all documents hold is one entry of each block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regloom.llm import text as tx
from regloom.llm.ship import ship
from regloom.session import scratch_path

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Entries are dealt out by so many buckets for each shuffle partition.
BUCKETS_PER_PARTITION = 8
NO_ID = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Shape:
    """What is compared: ``bytes_`` or else words, windows of ``length`` and seeds of ``seed`` units.

    ``group``: so many windows next to each other are first compared by what they all hold.
    """

    bytes_: bool
    length: int
    seed: int
    group: int = 1


@dataclass
class Units:
    """The units of a block: a value each, where each text begins, the texts' order."""

    values: np.ndarray
    offsets: np.ndarray
    order: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def units_of(rows: pa.RecordBatch, shape: Shape, id: str, text: str) -> Units:
    data, offsets = tx.utf8(rows.column(text))
    ids = rows.column(id).cast(pa.int64())
    order = ids.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    if shape.bytes_:
        return Units(tx.BYTE_VALUES[data], offsets, order, data, np.zeros(0, np.int64), np.zeros(0, np.int64))
    starts, ends, firsts = tx.word_bounds(data, offsets, tx.SPACE)
    return Units(tx.word_hashes(data, starts, ends), firsts, order, data, starts, ends)


@dataclass
class Segments:
    """Stretches of windows with one anchor: first window, number of windows, how far from
    the first to the anchor, hashes, text."""

    at: np.ndarray
    n: np.ndarray
    reach: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    text: np.ndarray


def least_of_runs(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of so many keys."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if span < width else keys


def segments_of(units: Units, shape: Shape) -> Segments:
    none = np.zeros(0, np.int64)
    if len(units.values) < shape.length:
        return Segments(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    seeds = tx.Rolling(units.values).every(shape.seed)
    low = np.uint64(0xFFFFFFFF)
    keys = (seeds & ~low) | (low - np.arange(len(seeds), dtype=np.uint64))
    picks = (low - (least_of_runs(keys, shape.length - shape.seed + 1) & low)).astype(np.int64)
    del keys
    # Windows that would reach into the next text are none.
    begin, end = units.offsets[:-1], units.offsets[1:]
    count = np.maximum(0, end - begin - shape.length + 1)
    text = np.flatnonzero(count)
    at = np.repeat(begin[text] - np.concatenate([[0], np.cumsum(count[text])])[:-1], count[text]) + np.arange(count.sum())
    if not len(at):
        return Segments(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    picks = picks[at]
    first = np.flatnonzero(np.concatenate([[True], (picks[1:] != picks[:-1]) | (at[1:] != at[:-1] + 1)]))
    n = np.diff(np.append(first, len(at)))
    at, picks = at[first], picks[first]
    content = tx.Rolling(units.values, 2).of(at, at + n + shape.length - 1)
    content = tx.mix(content + (picks - at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return Segments(at, n, picks - at, seeds[picks], content, np.searchsorted(units.offsets, at, "right") - 1)


# Arrays of entries as binary values, column by column.

ENTRY = ("<u8", "<u8", "<i8", "<u4", "<u2", "<u2")  # anchor, content, order of the text, first window, windows (0: several), reach
SPAN = ("<u4", "<u2")  # first window, windows
WANTED = ("<u4", "<u2", "<u2")  # first window, windows, reach


def pack(kinds: tuple[str, ...], columns: list[np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(c).astype(k, copy=False).tobytes() for k, c in zip(kinds, columns))


def unpack(kinds: tuple[str, ...], blob: bytes) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, result, at = len(blob) // sum(sizes), [], 0
    for kind, size in zip(kinds, sizes):
        result.append(np.frombuffer(blob, kind, n, at))
        at += n * size
    return result


def unpack_all(kinds: tuple[str, ...], blobs: list[bytes]) -> list[np.ndarray]:
    parts = [unpack(kinds, b) for b in blobs]
    return [np.concatenate(c) if parts else np.zeros(0, k) for c, k in zip(zip(*parts) if parts else [()] * len(kinds), kinds)]


def by_key(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each distinct key."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else []
    for s, e in zip(starts, [*starts[1:], len(keys)]):
        yield keys[order[s]], order[s:e]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before in any of the columns."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return new


# Blocks


def write_blocks(documents: DataFrame, id: str, text: str, batch: int = 0) -> DataFrame:
    """The documents as rows ``block``, ``rows`` (an Arrow stream), bucketed by block.

    The number of a block holds its batch, its task and its place there.
    """
    spark = documents.sparkSession
    ship(spark)
    first, path, name = batch << 48, scratch_path(spark, "blocks"), f"regloom_blocks_{uuid.uuid4().hex}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = first + (TaskContext.get().partitionId() << 20)
        for batch in batches:
            for part in tx.slices(batch, text, BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])
                number += 1

    blocks = documents.mapInArrow(tx.tidy(work), "block long, rows binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(parts, "block").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


def read_block(rows: bytes) -> pa.RecordBatch:
    tx.entering("repeats")
    table = pa.ipc.open_stream(rows).read_all().combine_chunks()
    return table.to_batches()[0]


# What tasks send: one row for each bucket, or for each block, with packed entries.

SENT = "bucket long, block long, entries binary, spans binary, wanted binary"


def sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "block", "entries", "spans", "wanted"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def bucket_count(documents: DataFrame) -> int:
    return BUCKETS_PER_PARTITION * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def seed_entries(blocks: DataFrame, shape: Shape, id: str, text: str, buckets: int) -> DataFrame:
    """The segments of each block as entries for the buckets of their anchors.

    Of equal segments in a block the first is an entry, the others are repeats already. An
    anchor with different segments in the block is one entry that says so (of 0 windows); its
    segments are wanted window by window.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                units = units_of(read_block(rows.as_buffer()), shape, id, text)
                s = segments_of(units, shape)
                order = units.order[s.text]
                # By anchor, content, order of the text, place.
                sort = np.lexsort((order, s.content, s.anchor))
                at, n, reach, anchor, content, order = s.at[sort], s.n[sort], s.reach[sort], s.anchor[sort], s.content[sort], order[sort]
                fresh = changes(anchor, content)
                spans = pack(SPAN, [at[~fresh], n[~fresh]])
                at, n, reach, anchor, content, order = (x[fresh] for x in (at, n, reach, anchor, content, order))
                first = np.flatnonzero(changes(anchor))
                several = np.diff(np.append(first, len(anchor))) > 1
                each = np.repeat(several, np.diff(np.append(first, len(anchor))))
                wanted = pack(WANTED, [at[each], n[each], reach[each]])
                n = np.where(each, 0, n)
                columns = [x[first] for x in (anchor, content, order, at, n, reach)]
                bucket = (tx.mix(columns[0]) % np.uint64(buckets)).astype(np.int64)
                out = [(int(b), block, pack(ENTRY, [c[places] for c in columns]), None, None) for b, places in by_key(bucket)]
                out.append((int(block) % buckets, block, None, spans, wanted))
                yield sent(out)

    return blocks.select("block", "rows").mapInArrow(tx.tidy(work), SENT)


def gathered(entries: DataFrame) -> DataFrame:
    """One row for each bucket, with all that was sent to it."""
    return entries.groupBy("bucket").agg(F.collect_list(F.struct("block", "entries", "spans", "wanted")).alias("sent"))


@dataclass
class Found:
    """Repeated and wanted segments by block."""

    rows: list[tuple]

    def add(self, block: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        for b, places in by_key(block):
            self.rows.append((None, int(b), None, pack(SPAN, [at[places], n[places]]), None))

    def want(self, block: np.ndarray, at: np.ndarray, n: np.ndarray, reach: np.ndarray) -> None:
        for b, places in by_key(block):
            self.rows.append((None, int(b), None, None, pack(WANTED, [at[places], n[places], reach[places]])))


def received(sent_rows: list[dict]) -> tuple[list[np.ndarray], np.ndarray, Found]:
    """The entries sent to a bucket, their blocks, and what the blocks found themselves."""
    own = [r for r in sent_rows if r["entries"]]
    columns = unpack_all(ENTRY, [r["entries"] for r in own])
    size = sum(np.dtype(k).itemsize for k in ENTRY)
    blocks = np.repeat(np.array([r["block"] for r in own], np.int64), [len(r["entries"]) // size for r in own])
    kept = [(None, r["block"], None, r["spans"], r["wanted"]) for r in sent_rows if r["spans"] or r["wanted"]]
    return columns, blocks, Found(kept)


def by_block(found: DataFrame, column: str) -> DataFrame:
    """One row for each block with all its spans, or wanted segments."""
    return found.where(F.col(column).isNotNull()).groupBy("block").agg(F.collect_list(column).alias("found")).withColumnRenamed("block", "found_block")


CORE = ("<u8", "<u4", "<u2", "<u2")  # hash, first window, windows (0: several), reach


def core_entries(blocks: DataFrame, found: DataFrame, shape: Shape, id: str, text: str, buckets: int) -> DataFrame:
    """Of wanted segments, what groups of windows next to each other have in common, as entries.

    Windows are grouped by their distance to the anchor, so equal windows are in groups with
    equal cores. Cores that a block has several times are wanted at once.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                units = units_of(read_block(rows.as_buffer()), shape, id, text)
                at, n, reach = unpack_all(WANTED, wanted)
                # An earlier batch's segment may be wanted by several later ones.
                at, once = np.unique(at.astype(np.int64), return_index=True)
                n, reach = n[once].astype(np.int64), reach[once].astype(np.int64)
                low, high = (reach - n + 1) // shape.group, reach // shape.group
                count = high - low + 1
                owner = np.repeat(np.arange(len(at)), count)
                group = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1] - low, count)
                far = np.minimum(reach[owner], group * shape.group + shape.group - 1)
                near = np.maximum((reach - n + 1)[owner], group * shape.group)
                start = (at + reach)[owner] - group * shape.group
                hashes = tx.mix(tx.Rolling(units.values, 3).of(start, start + shape.length - shape.group + 1) + group.astype(np.uint64))
                columns = [hashes, at[owner] + reach[owner] - far, far - near + 1, far]
                sort = np.argsort(hashes, kind="stable")
                columns = [c[sort] for c in columns]
                first = np.flatnonzero(changes(columns[0]))
                sizes = np.diff(np.append(first, len(sort)))
                several = np.repeat(sizes > 1, sizes)
                wanted_here = pack(WANTED, [c[several] for c in columns[1:]])
                columns[2] = np.where(several, 0, columns[2])
                columns = [c[first] for c in columns]
                bucket = (tx.mix(columns[0]) % np.uint64(buckets)).astype(np.int64)
                out = [(int(b), block, pack(CORE, [c[places] for c in columns]), None, None) for b, places in by_key(bucket)]
                out.append((int(block) % buckets, block, None, None, wanted_here))
                yield sent(out)

    return _wanted_blocks(blocks, found).mapInArrow(tx.tidy(work), SENT)


def repeated_cores(entries: DataFrame) -> DataFrame:
    """The groups of windows whose cores are met again, as wanted by their blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sum(np.dtype(k).itemsize for k in CORE)
        for batch in batches:
            for rows in tx.values(batch.column(1)):
                own = [r for r in rows if r["entries"]]
                hashes, at, n, reach = unpack_all(CORE, [r["entries"] for r in own])
                block = np.repeat(np.array([r["block"] for r in own], np.int64), [len(r["entries"]) // size for r in own])
                sort = np.argsort(hashes, kind="stable")
                first = np.flatnonzero(changes(hashes[sort]))
                sizes = np.diff(np.append(first, len(sort)))
                met = sort[np.repeat(sizes > 1, sizes)]
                met = met[n[met] > 0]
                found = Found([(None, r["block"], None, None, r["wanted"]) for r in rows if r["wanted"]])
                found.want(block[met], at[met], n[met], reach[met])
                if found.rows:
                    yield sent(found.rows)

    return gathered(entries).mapInArrow(tx.tidy(work), SENT).select("block", "wanted")


WINDOW = ("<u8", "<u4", "<i8", "<u4")  # hash, second hash, order of the text, place


def _wanted_blocks(blocks: DataFrame, found: DataFrame) -> DataFrame:
    wanted = by_block(found, "wanted")
    return blocks.join(wanted, blocks["block"] == wanted["found_block"]).select("block", "rows", "found")


def window_entries(blocks: DataFrame, found: DataFrame, shape: Shape, id: str, text: str, buckets: int) -> DataFrame:
    """The windows of wanted segments as entries for the buckets of their hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                units = units_of(read_block(rows.as_buffer()), shape, id, text)
                at, n, _ = unpack_all(WANTED, wanted)
                at, once = np.unique(at.astype(np.int64), return_index=True)
                n = n[once].astype(np.int64)
                at = np.repeat(at - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
                hashes = tx.Rolling(units.values, 3).of(at, at + shape.length)
                second = tx.Rolling(units.values, 2).of(at, at + shape.length).astype(np.uint32)
                order = units.order[np.searchsorted(units.offsets, at, "right") - 1]
                sort = np.lexsort((at, order, second, hashes))
                columns = [x[sort] for x in (hashes, second, order, at)]
                fresh = changes(columns[0], columns[1])
                spans = pack(SPAN, [columns[3][~fresh], np.ones((~fresh).sum())])
                columns = [c[fresh] for c in columns]
                bucket = (tx.mix(columns[0]) % np.uint64(buckets)).astype(np.int64)
                out = [(int(b), block, pack(WINDOW, [c[places] for c in columns]), None, None) for b, places in by_key(bucket)]
                out.append((int(block) % buckets, block, None, spans, None))
                yield sent(out)

    return _wanted_blocks(blocks, found).mapInArrow(tx.tidy(work), SENT)


def repeated_windows(entries: DataFrame) -> DataFrame:
    """Of equal windows all but the first, as spans of their blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = sum(np.dtype(k).itemsize for k in WINDOW)
        for batch in batches:
            for rows in tx.values(batch.column(1)):
                own = [r for r in rows if r["entries"]]
                hashes, second, order, at = unpack_all(WINDOW, [r["entries"] for r in own])
                block = np.repeat(np.array([r["block"] for r in own], np.int64), [len(r["entries"]) // size for r in own])
                sort = np.lexsort((at, block, order, block >> 48, second, hashes))
                again = sort[~changes(hashes[sort], second[sort])]
                found = Found([(None, r["block"], None, r["spans"], None) for r in rows if r["spans"]])
                found.add(block[again], at[again], np.ones(len(again)))
                if found.rows:
                    yield sent(found.rows)

    return gathered(entries).mapInArrow(tx.tidy(work), SENT).select("block", "spans")


def covered_units(spans: list[bytes], shape: Shape, n_units: int) -> np.ndarray:
    """Whether each unit of a block lies in any of its repeated windows."""
    at, n = unpack_all(SPAN, spans)
    change = np.zeros(n_units + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at.astype(np.int64) + n + shape.length - 1, -1)
    return np.cumsum(change[:-1]) > 0


def finish(blocks: DataFrame, found: DataFrame, shape: Shape, id: str, text: str, result: Callable, schema) -> DataFrame:
    """Applies ``result(rows, units, covered)`` to every block; it returns a record batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, spans in zip(batch.column(0), batch.column(1).to_pylist()):
                documents = read_block(rows.as_buffer())
                units = units_of(documents, shape, id, text)
                yield result(documents, units, covered_units(spans or [], shape, len(units.values)))

    spans = by_block(found, "spans")
    joined = blocks.join(spans, blocks["block"] == spans["found_block"], "left").select("rows", "found")
    return joined.mapInArrow(tx.tidy(work), schema)


def runs(covered: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of covered runs within texts, and where those of each text begin."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], covered[:-1]]) if len(covered) else covered
    after = np.concatenate([covered[1:], [False]]) if len(covered) else covered
    starts = np.flatnonzero(covered & (~before | edge[:-1]))
    ends = np.flatnonzero(covered & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)
