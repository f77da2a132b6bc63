"""Vector code compression: one codebook for each part of a vector, fitted in whole numbers.

Components become integers, vectors are cut into equal parts, and each part is replaced by the
index of the nearest entry of its position's codebook. Codebooks are fitted by rounds of
assigning and averaging, all in 64-bit integers, so results do not depend on how rows are dealt.

Assignment keeps adaptive distance bounds (Drake and Hamerly). For every part a written table
holds its entry, an upper bound of the distance to it, the ``b`` entries next in distance with
a lower bound for each, in order, and one outer bound for all other entries. When entries move,
bounds are loosened by how far. A part whose upper bound is below all lower bounds keeps its
entry unseen. Else its own distance is computed, and the entries before the first bound that
this distance stays under; only where it passes the outer bound too, all entries are. Every
decision that bounds leave open is made on integers, ties to the lower index. After each round
``b`` becomes the largest number of entries that had to be looked at, an eighth of all at least.

Defined results: vectors that are null or empty, or hold null or non-finite components, are
dropped; so are those with a component beyond 32768 in size, whose squares would not fit. The
length of all vectors is that of the vector with the smallest id (of equal ids, the least by
its components); others are dropped. A length that does not divide evenly is filled up with
zeros. A null id counts as above all others. Fewer vectors than entries give as many entries as
there are vectors. Repeated rows count each. Columns named as results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm.ship import ship
from regloom.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: The largest component, in size, that is kept.
LARGEST = 32768.0
#: Room for rounding in bounds, as a share of the distance and in units.
SLACK, UNIT = 1e-9, 1e-6
#: Vectors worked on at once.
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries``: position, entry, component."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole_vectors(rows: DataFrame, vector: str, id: str, scale: int, parts: int) -> DataFrame:
    """The vectors kept, as column ``ints``, filled up to a multiple of ``parts``."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    kept = rows.where((F.size(v) > 0) & fine)
    first = kept.orderBy(F.col(id).asc_nulls_last(), v).select(F.size(vector)).first()
    if not first:
        return rows.where("false").withColumn("ints", F.lit(None).cast("array<bigint>"))
    filled = -first[0] % parts
    ints = F.transform(v, lambda x: F.floor(x * scale).cast("bigint"))
    if filled:
        ints = F.concat(ints, F.array_repeat(F.lit(0).cast("bigint"), filled))
    return kept.where(F.size(vector) == first[0]).withColumn("ints", ints)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to all entries of a codebook, in integers."""
    # x.x - 2 x.e + e.e would round in floats; in integers it is exact and needs no cube.
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]


@dataclass
class Bounds:
    """Of the parts at one position: entry, upper bound, nearest others, lower bounds, outer bound."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def from_distances(d2: np.ndarray, b: int) -> tuple[np.ndarray, Bounds]:
    """The nearest entries by all squared distances, and fresh bounds."""
    d = np.sqrt(d2.astype(np.float64))
    # A stable sort of integers puts the lower of equal indexes first.
    order = np.argsort(d2, axis=1, kind="stable")
    rows = np.arange(len(d2))[:, None]
    near = order[:, 1 : b + 1]
    rest = order[:, b + 1 : b + 2]
    outer = d[rows, rest][:, 0] if rest.shape[1] else np.full(len(d2), np.inf)
    entry = order[:, 0]
    return d2[rows[:, 0], entry], Bounds(entry, d[rows[:, 0], entry], near, d[rows, near], outer)


def reassigned(x: np.ndarray, old: Bounds, entries: np.ndarray, moved: np.ndarray, b: int) -> tuple[np.ndarray, Bounds, int]:
    """Entries and bounds after the codebook has moved, and how many others a part had to look at.

    Also squared distances to the new entries; -1 where none was computed.
    """
    far = moved.max() if len(moved) else 0.0
    upper = (old.upper + moved[old.entry]) * (1 + SLACK) + UNIT
    lower = (old.lower - moved[old.near]) * (1 - SLACK) - UNIT
    outer = np.where(np.isinf(old.outer), np.inf, (old.outer - far) * (1 - SLACK) - UNIT)
    # A bound holds for its own entry and for all behind it.
    lower = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1]
    near, lower, outer = old.near[:, :b], lower[:, : old.near.shape[1]], lower[:, -1]
    outer = np.minimum(outer, lower[:, b]) if lower.shape[1] > b else outer
    lower = lower[:, :b]
    found = Bounds(old.entry.copy(), upper, near.copy(), lower.copy(), outer.copy())
    distance = np.full(len(x), -1, np.int64)
    if len(entries) < 2:
        return distance, found, 0
    first = lower[:, 0] if lower.shape[1] else outer
    open_ = np.flatnonzero(~(upper < first))
    if not len(open_):
        return distance, found, 0
    diff = x[open_] - entries[found.entry[open_]]
    own = (diff * diff).sum(1)
    distance[open_] = own
    found.upper[open_] = np.sqrt(own.astype(np.float64))
    tight = found.upper[open_] * (1 + SLACK) + UNIT
    all_bounds = np.column_stack([lower[open_], outer[open_]])
    # The first bound above the distance: entries from there on are farther for certain.
    above = tight[:, None] < all_bounds
    reach = np.where(above.any(1), above.argmax(1), all_bounds.shape[1])
    needed = 0
    for n in np.unique(reach[reach > 0]).tolist():
        these = open_[reach == n]
        if n > lower.shape[1]:
            distance[these], new = from_distances(squared(x[these], entries), lower.shape[1])
            found.entry[these], found.upper[these], found.near[these] = new.entry, new.upper, new.near
            found.lower[these], found.outer[these] = new.lower, new.outer
            needed = lower.shape[1]
            continue
        needed = max(needed, n)
        among = np.sort(np.column_stack([found.entry[these], found.near[these, :n]]), axis=1)
        delta = x[these][:, None, :] - entries[among]
        d2 = (delta * delta).sum(2)
        order = np.argsort(d2, axis=1, kind="stable")
        rows = np.arange(len(these))[:, None]
        among, d2 = among[rows, order], d2[rows, order]
        distance[these], found.entry[these] = d2[:, 0], among[:, 0]
        d = np.sqrt(d2.astype(np.float64))
        found.upper[these], found.near[these, :n], found.lower[these, :n] = d[:, 0], among[:, 1:], d[:, 1:]
        # What comes next may be nearer than those looked at were known to be.
        later = np.column_stack([found.lower[these, n:], found.outer[these]])
        found.lower[these, :n] = np.minimum(found.lower[these, :n], later[:, :1])
    return distance, found, needed


# A vector's bounds at all positions travel as three binary columns.

STATE = T.StructType([T.StructField("entries", T.BinaryType()), T.StructField("near", T.BinaryType()), T.StructField("bounds", T.BinaryType()), T.StructField("needed", T.IntegerType())])


def _matrix(column: pa.Array, kind: type, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind).reshape(rows, -1)


def _binary(matrix: np.ndarray) -> pa.Array:
    raw, size = np.ascontiguousarray(matrix).tobytes(), matrix.shape[1] * matrix.itemsize
    return pa.array([raw[i * size : (i + 1) * size] for i in range(len(matrix))], pa.binary())


def _ints(column: pa.Array, rows: int, parts: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, parts, -1)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def assigned(rows: DataFrame, books: Codebooks, b: int, before: Codebooks | None) -> DataFrame:
    """Rows with new entries and bounds; from all distances if there was no codebook before."""
    kept = [c for c in rows.columns if c not in STATE.names]
    parts, k = books.entries.shape[:2]
    moved = None if before is None else np.sqrt(((books.entries - before.entries) ** 2).sum(2).astype(np.float64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            n = batch.num_rows
            x = _ints(batch.column("ints"), n, parts)
            new, most = [], 0
            if moved is not None:
                # Entries are of one byte, so a codebook has 256 at most.
                entry = _matrix(batch.column("entries"), np.uint8, n).astype(np.int64)
                near = _matrix(batch.column("near"), np.uint8, n).reshape(n, parts, -1).astype(np.int64)
                bounds = _matrix(batch.column("bounds"), np.float64, n).reshape(n, parts, -1)
            for p in range(parts):
                if moved is None:
                    new.append(from_distances(squared(x[:, p], books.entries[p]), b)[1])
                    continue
                old = Bounds(entry[:, p], bounds[:, p, 0], near[:, p], bounds[:, p, 2:], bounds[:, p, 1])
                _, found, needed = reassigned(x[:, p], old, books.entries[p], moved[p], b)
                new.append(found)
                most = max(most, needed)
            columns = [
                _binary(np.column_stack([s.entry for s in new]).astype(np.uint8)),
                _binary(np.column_stack([s.near for s in new]).astype(np.uint8)),
                _binary(np.column_stack([np.column_stack([s.upper, s.outer, s.lower]) for s in new])),
                pa.array(np.full(n, most if moved is not None else b, np.int32)),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *STATE.names])

    return rows.mapInArrow(work, T.StructType([*(rows.schema[c] for c in kept), *STATE.fields]))


def averaged(state: DataFrame, books: Codebooks) -> tuple[Codebooks, int]:
    """Each entry replaced by the mean of its parts, rounded down, and the most entries looked at.

    Sums are made for each batch, then by key: as many rows as there are entries come to the driver.
    """
    parts, k, size = books.entries.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, most = np.zeros((parts, k, size), np.int64), np.zeros((parts, k), np.int64), 0
        for batch in _small(batches):
            x = _ints(batch.column("ints"), batch.num_rows, parts)
            entry = _matrix(batch.column("entries"), np.uint8, batch.num_rows)
            most = max(most, int(np.max(batch.column("needed").to_numpy())))
            for p in range(parts):
                np.add.at(sums[p], entry[:, p], x[:, p])
                counts[p] += np.bincount(entry[:, p], minlength=k)
        p, e = np.nonzero(counts)
        values = pa.array(list(sums[p, e]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), values, pa.array(np.full(len(p), most, np.int32))], ["p", "e", "n", "sums", "most"])

    partial = state.select("ints", "entries", "needed").mapInArrow(work, "p long, e long, n long, sums array<bigint>, most int")
    totals = partial.groupBy("p", "e").agg(F.sum("n").alias("n"), F.max("most").alias("most"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size)])
    entries, most = books.entries.copy(), 0
    for r in totals.collect():
        entries[r.p, r.e] = [r[f"s{i}"] // r.n for i in range(size)]
        most = max(most, r.most)
    return Codebooks(entries), most


def fit(vectors: DataFrame, id: str, parts: int, entries: int, rounds: int) -> tuple[Codebooks, DataFrame] | None:
    """Codebooks and the last written table of bounds; None if there are no vectors.

    ``vectors`` has ``ints`` and whatever columns are to be kept.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    first = vectors.orderBy(F.col(id).asc_nulls_last(), "ints").select("ints").limit(entries).collect()
    if not first:
        return None
    start = np.array([r.ints for r in first], np.int64)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2)))
    before, rows, b = None, vectors, max(1, entries // 4)
    for n in range(rounds + 1):
        path = scratch_path(spark, "bounds")
        assigned(rows, books, b, before).write.parquet(path)
        rows = spark.read.parquet(path)
        if n < rounds:
            before = books
            books, needed = averaged(rows, books)
            b = min(b, max(-(-entries // 8), needed))
    return books, rows


RESULTS = T.StructType([T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``code``, two hex digits for each part, and ``error``, the squared distances of all parts."""
    kept = [c for c in rows.columns if c not in (*STATE.names, *RESULTS.names, "ints")]
    parts = books.entries.shape[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            x = _ints(batch.column("ints"), batch.num_rows, parts)
            entry = _matrix(batch.column("entries"), np.uint8, batch.num_rows)
            delta = x - books.entries[np.arange(parts)[None], entry]
            error = (delta * delta).sum((1, 2))
            code = [bytes(e).hex() for e in entry]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(code, pa.string()), pa.array(error)], [*kept, *RESULTS.names])

    return rows.mapInArrow(work, T.StructType([*(rows.schema[c] for c in kept), *RESULTS.fields]))


def compress(
    vectors: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    keep: list[str] | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """The kept columns (all, unless named) with ``code`` and ``error``, and the codebooks."""
    ship(vectors.sparkSession)
    keep = [c for c in (keep if keep is not None else vectors.columns) if c not in RESULTS.names]
    # Other columns travel as one, so that no name can clash.
    rows = whole_vectors(vectors, vector, id, scale, parts).select(F.struct(*keep, F.lit(0).alias("_none")).alias("row"), F.col(id).alias("_id"), "ints")
    found = fit(rows, "_id", parts, entries, rounds)
    names = [F.col("row").getField(c).alias(c) for c in keep]
    if found is None:
        return rows.select(*names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in RESULTS]), None
    books, state = found
    return coded(state, books).select(*names, *RESULTS.names), books
