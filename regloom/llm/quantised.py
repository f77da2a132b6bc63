"""Embedding near-duplicates by product quantisation: inverted lists, residual codes, exact rerank.

Equal vectors are one node with a number of copies. Nodes are put into the inverted list of the
coarse centre they point to most. What a centre leaves is cut into subspaces of ``WIDTH`` components,
each replaced by one of ``CODES`` codes. Every node is also a query, dealt to all lists in which
a vector at the least cosine may well lie: those whose centre is, for the query, no farther behind
the best than ``SPREAD`` standard deviations of what a difference of that size moves, ``PROBES``
at most. In a list a query adds up one table look-up for each code (asymmetric distance). A code's
rounding is known exactly for its own vector, so the sum plus a bound stored with the code can't
fall short of the least cosine for a pair that reaches it: within a list no link is lost. What
passes is judged by the cosine in double precision.

Long lists are cut both ways, into tiles of entries and queries, so no list is one task's work,
however many rows point one way. A tile returns numbers of links and one edge for each of its
nodes to the least node it is connected to, never pairs: rows grow with nodes even where all are
alike. Where many different vectors lie within the least cosine of each other, the comparisons
themselves are as many as the pairs: their number of links is asked for, and is counted one by one.

A pair counts once for either side, whichever of the two found the other. The index is fitted on
about ``SAMPLE`` numbers of a hashed sample of nodes, and holds every node.

Defined results: a vector that is null or empty, holds nulls or non-finite components, or has
length zero or beyond double range links with nothing. Vectors of different lengths don't link;
the index covers the commonest length of the sample, others are compared within a list for each
length. Copies link with each other. Rows are told apart even if ids repeat; a row without an id
has links like any other, and gives no name to a component: it takes the component's, or null.
Columns named as results are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm.components import components
from regloom.llm.hot import join_values
from regloom.llm.ship import ship
from regloom.session import scratch_path

LEAST, PROBES, SPREAD = 0.9, 12, 2.0
#: Numbers (components) of the sample that the index is fitted on, and lists at most.
SAMPLE, MOST_LISTS = 1 << 21, 4096
WIDTH, CODES, ROUNDS = 4, 64, 8
#: Entries and queries of a tile, and queries compared at once.
ENTRIES, QUERIES, AT_ONCE = 1024, 2048, 256
RESULTS = T.StructType([T.StructField("n_links", T.LongType()), T.StructField("component_id", T.LongType()), T.StructField("kept", T.BooleanType())])


def means(x: np.ndarray, k: int, random: np.random.Generator, unit: bool) -> np.ndarray:
    """Lloyd's rounds from rows drawn at random; an empty cluster keeps its centre."""
    centres = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = np.concatenate([(x[at : at + 4096] @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1) for at in range(0, len(x), 4096)])
        order = np.argsort(nearest, kind="stable")
        used, first = np.unique(nearest[order], return_index=True)
        centres[used] = np.add.reduceat(x[order], first) / np.diff([*first, len(x)])[:, None]
        if unit:
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


@dataclass
class Index:
    """``centres`` of unit length; ``codes``: subspace, code, component. ``size``: components indexed."""

    size: int
    centres: np.ndarray
    codes: np.ndarray

    @staticmethod
    def fit(vectors: list[np.ndarray], lists: int) -> Index:
        sizes, counts = np.unique([len(v) for v in vectors], return_counts=True)
        size = int(sizes[counts.argmax()])
        x = unit(np.stack([v for v in vectors if len(v) == size]))
        random = np.random.default_rng(17)
        centres = means(x, min(lists, len(x)), random, True)
        index = Index(size, centres, np.zeros((0, 0, 0), np.float32))
        rest = index.subspaces(x - centres[(x @ centres.T).argmax(1)])
        index.codes = np.stack([means(rest[:, m], min(CODES, len(x)), random, False) for m in range(rest.shape[1])])
        return index

    def subspaces(self, x: np.ndarray) -> np.ndarray:
        filled = -x.shape[1] % WIDTH
        return np.pad(x, ((0, 0), (0, filled))).reshape(len(x), -1, WIDTH)

    def probes(self, x: np.ndarray, least: float) -> np.ndarray:
        """The lists to search for each vector, the best first; -1 for none."""
        dots = x @ self.centres.T
        n = min(PROBES, dots.shape[1])
        top = np.argpartition(-dots, n - 1, axis=1)[:, :n]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(dots, top, 1), axis=1, kind="stable"), 1)
        behind = np.take_along_axis(dots, top[:, :1], 1) - np.take_along_axis(dots, top, 1)
        apart = np.linalg.norm(self.centres[top] - self.centres[top[:, :1]], axis=2)
        reach = SPREAD * np.sqrt((2 - 2 * least) / self.size) * apart
        return np.where(behind <= reach, top, -1)

    def encoded(self, x: np.ndarray, lists: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the most by which the true product with a linked query exceeds the coded one."""
        rest = self.subspaces(x - self.centres[lists])
        code = np.empty(rest.shape[:2], np.uint8)
        for m, book in enumerate(self.codes):
            code[:, m] = (rest[:, m] @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
            rest[:, m] -= book[code[:, m]]
        lost = rest.reshape(len(x), -1)
        # q.v - q.coded = v.lost + (q - v).lost, and |q - v| is bounded where q and v are linked.
        own = (self.subspaces(x).reshape(len(x), -1) * lost).sum(1)
        return code, own + np.sqrt(2 - 2 * least) * np.linalg.norm(lost, axis=1) + 1e-5

    def tables(self, x: np.ndarray) -> np.ndarray:
        """The product of each query with each code: subspace, query, code."""
        return np.einsum("qmw,mcw->mqc", self.subspaces(x), self.codes, optimize=True)


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """Vectors of a column without nulls, as doubles."""
    values, offsets = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def sound(vector: str) -> F.Column:
    """Whether a vector can link: its square sum is a positive, finite number."""
    v = F.col(vector).cast("array<double>")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    return F.coalesce((total > 0) & (total < float("inf")), F.lit(False))


PLACED = "node long, copies long, home int, probes array<int>, code binary, bound float, vector "
TILE = f"list int, across int, down int, query boolean, {PLACED}"


def _vector_type(rows: DataFrame) -> str:
    """Single floats stay as they are: half the bytes to move."""
    return rows.schema["vector"].dataType.simpleString()


def placed(nodes: DataFrame, index: Index, least: float) -> DataFrame:
    """Every node with its list, the lists to search for it, and its code."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _arrays(batch.column("vector"))
            home, probes = [-len(v) - 1 for v in vectors], [[-len(v) - 1] for v in vectors]
            code, bound = [b""] * len(vectors), np.zeros(len(vectors), np.float32)
            same = np.flatnonzero([len(v) == index.size for v in vectors])
            for at in range(0, len(same), AT_ONCE):
                these = same[at : at + AT_ONCE]
                x = unit(np.stack([vectors[i] for i in these]))
                lists = index.probes(x, least)
                codes, bounds = index.encoded(x, lists[:, 0], least)
                for i, row, c, b in zip(these.tolist(), lists.tolist(), codes, bounds):
                    home[i], probes[i], code[i], bound[i] = row[0], [p for p in row if p >= 0], c.tobytes(), b
            columns = [batch.column("node"), batch.column("copies"), pa.array(home, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array(code, pa.binary()), pa.array(bound), batch.column("vector")]
            yield pa.RecordBatch.from_arrays(columns, ["node", "copies", "home", "probes", "code", "bound", "vector"])

    return nodes.select("node", "copies", "vector").mapInArrow(work, PLACED + _vector_type(nodes))


def dealt(rows: DataFrame, across: dict[int, int], down: dict[int, int]) -> DataFrame:
    """Entries and queries of all tiles. ``across`` and ``down``: tiles of the lists that have several.

    An entry stands in one column of tiles of its list, a query in one row of each list it searches.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, home = batch.column("node").to_pylist(), batch.column("home").to_pylist()
            # Spreads consecutive numbers of nodes evenly.
            spread = [(n * 0x9E3779B97F4A7C15 >> 20) & 0xFFFFFFFF for n in node]
            at: list[int] = []
            keys: list[tuple[int, int, int, bool]] = []
            for i, (l, probes) in enumerate(zip(home, batch.column("probes").to_pylist())):
                column = spread[i] % across.get(l, 1)
                keys += [(l, column, d, False) for d in range(down.get(l, 1))]
                at += [i] * down.get(l, 1)
                for p in probes:
                    row = (spread[i] >> 8) % down.get(p, 1)
                    keys += [(p, a, row, True) for a in range(across.get(p, 1))]
                    at += [i] * across.get(p, 1)
            for start in range(0, len(at), 8192):
                part = batch.take(pa.array(at[start : start + 8192]))
                some = list(zip(*keys[start : start + 8192]))
                named = [pa.array(some[k], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*named, *part.columns], ["list", "across", "down", "query", *part.schema.names])

    return rows.mapInArrow(work, TILE + _vector_type(rows))


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the pairs are connected: each the least of its component so far."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


class Tile:
    """The entries of one tile; queries come in batches."""

    def __init__(self, index: Index, least: float, entries: pa.RecordBatch):
        self.index, self.least = index, least
        order = np.argsort(entries.column("node").to_numpy())
        entries = entries.take(pa.array(order))
        self.list = entries.column("list")[0].as_py()
        self.nodes = entries.column("node").to_numpy()
        self.copies = entries.column("copies").to_numpy()
        self.vectors = np.stack(_arrays(entries.column("vector")))
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        probes = entries.column("probes").to_pylist()
        self.probes = np.full((len(probes), max(map(len, probes))), -1, np.int64)
        for i, p in enumerate(probes):
            self.probes[i, : len(p)] = p
        if self.list >= 0:
            self.codes = np.frombuffer(b"".join(entries.column("code").to_pylist()), np.uint8).reshape(len(self.nodes), -1).astype(np.intp)
            self.bounds = entries.column("bound").to_numpy()
        self.links = np.zeros(len(self.nodes), np.int64)
        self.label = np.arange(len(self.nodes))
        self.extra: list[tuple[np.ndarray, np.ndarray]] = []

    def search(self, queries: pa.RecordBatch) -> None:
        for at in range(0, queries.num_rows, AT_ONCE):
            self._search(queries.slice(at, AT_ONCE))

    def _candidates(self, x: np.ndarray) -> np.ndarray:
        """Which entries may be linked, by the sums of look-ups."""
        if self.list < 0:
            return np.ones((len(x), len(self.nodes)), bool)
        q = unit(x)
        total = np.add.outer(q @ self.index.centres[self.list], self.bounds)
        part = np.empty_like(total)
        for table, code in zip(self.index.tables(q), self.codes.T):
            np.take(table, code, axis=1, out=part)
            total += part
        return total >= self.least

    def _search(self, queries: pa.RecordBatch) -> None:
        node, copies, home = (queries.column(c).to_numpy() for c in ("node", "copies", "home"))
        x = np.stack(_arrays(queries.column("vector")))
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        maybe = self._candidates(x)
        maybe &= node[:, None] != self.nodes[None]
        if maybe.sum() * 4 > maybe.size:
            q, e = np.nonzero(maybe & ((x @ self.vectors.T) / (norms[:, None] * self.norms[None]) >= self.least))
        else:
            q, e = np.nonzero(maybe)
            near = [np.zeros(0, bool)]
            for at in range(0, len(q), 8192):
                a, b = q[at : at + 8192], e[at : at + 8192]
                near.append(np.einsum("ij,ij->i", x[a], self.vectors[b]) / (norms[a] * self.norms[b]) >= self.least)
            near = np.concatenate(near)
            q, e = q[near], e[near]
        found = np.bincount(q, self.copies[e], len(node)).astype(np.int64)
        # An entry whose own search does not come to the query's list counts the link here.
        unseen = (self.probes[e] != home[q][:, None]).all(1)
        self.links += np.bincount(e[unseen], copies[q[unseen]], len(self.nodes)).astype(np.int64)
        # Queries that are no entries get labels behind those of the entries.
        place = np.searchsorted(self.nodes, node)
        own = (place < len(self.nodes)) & (self.nodes[np.minimum(place, len(self.nodes) - 1)] == node)
        linked = np.flatnonzero(found > 0)
        new = linked[~own[linked]]
        place[new] = len(self.label) + np.arange(len(new))
        self.label = unite(np.concatenate([self.label, len(self.label) + np.arange(len(new))]), place[q], e)
        self.extra.append((node[new], found[new]))
        np.add.at(self.links, place[linked[own[linked]]], found[linked[own[linked]]])

    def result(self) -> pa.RecordBatch:
        """Of every linked node: its links found here, and a node it is connected to."""
        nodes = np.concatenate([self.nodes, *(n for n, _ in self.extra)])
        links = np.concatenate([self.links, *(n for _, n in self.extra)])
        other = nodes[self.label]
        some = np.flatnonzero((links > 0) | (other != nodes))
        return pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (nodes, links, other)], ["node", "links", "other"])


def searched(tiles: DataFrame, index: Index, least: float) -> DataFrame:
    """Partial numbers of links and edges of all tiles; a tile's rows come in a row, entries first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, tile = None, [], None

        def start() -> Tile:
            return Tile(index, least, pa.Table.from_batches(held).combine_chunks().to_batches()[0])

        for batch in batches:
            marks = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("list", "across", "down", "query")])
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                now = tuple(marks[a, :3].tolist())
                if now != key:
                    if tile is not None:
                        yield tile.result()
                    key, held, tile = now, [], None
                if not marks[a, 3]:
                    held.append(batch.slice(a, b - a))
                elif held:
                    if tile is None:
                        tile = start()
                    tile.search(batch.slice(a, b - a))
        if tile is not None:
            yield tile.result()

    order = ["list", "across", "down"]
    return tiles.repartition(*order).sortWithinPartitions(*order, "query").mapInArrow(work, "node long, links long, other long")


def fitted(nodes: DataFrame, lists: int) -> Index:
    """An index fitted in one task on a sample of nodes, by their hashes."""
    total = nodes.agg(F.sum(F.size("vector"))).first()[0]
    share = min(1.0, SAMPLE / total)
    sample = nodes.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else nodes

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = sorted((v for b in batches for v in _arrays(b.column("vector"))), key=lambda v: v.tobytes())
        # A sample that came out empty is no index: every length is then compared within a list.
        index = Index.fit(vectors, lists) if vectors else Index(-1, np.zeros((1, 1), np.float32), np.zeros((0, 0, 0), np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(index)], pa.binary())], ["index"])

    return pickle.loads(sample.select("vector").repartition(1).mapInArrow(work, "index binary").first()["index"])


def _several(rows: DataFrame, list_: F.Column, most: int) -> dict[int, int]:
    """Into how many tiles the lists with more rows than one takes are cut."""
    counts = rows.select(list_.alias("list")).groupBy("list").count().where(F.col("count") > most)
    return {r.list: -(-r["count"] // most) for r in counts.collect()}


def linked(nodes: DataFrame, least: float) -> DataFrame:
    """Links and components of nodes that have any: ``node``, ``links``, ``root``."""
    spark = nodes.sparkSession

    def written(rows: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        rows.write.parquet(path)
        return spark.read.parquet(path)

    index = fitted(nodes, max(1, min(MOST_LISTS, int(nodes.count() ** 0.5))))
    rows = written(placed(nodes, index, least), "placed")
    across = _several(rows, F.col("home"), ENTRIES)
    down = _several(rows, F.explode("probes"), QUERIES)
    found = written(searched(dealt(rows, across, down), index, least), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    return links.join(roots, "node")


def near_duplicates(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", least: float = LEAST, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all, unless named) with ``n_links``, ``component_id`` and ``kept``.

    ``n_links``: other vectors at a cosine of ``least`` or more. ``component_id``: the smallest id
    that links lead to. ``kept``: whether the row's own id is that.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine lies above 0, up to 1")
    spark = vectors.sparkSession
    ship(spark)
    keep = [c for c in (keep if keep is not None else vectors.columns) if c not in RESULTS.names]
    # Other columns travel as one, so that no name can clash.
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    exact = F.col(vector).cast("array<float>" if single else "array<double>").alias("vector")
    rows = vectors.select(F.struct(*keep, F.lit(0).alias("_none")).alias("row"), F.col(id).cast("long").alias("id"), exact, sound(vector).alias("sound"))
    path = scratch_path(spark, "nodes")
    same = rows.where("sound").groupBy("vector").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    same.withColumn("node", F.monotonically_increasing_id()).write.parquet(path)
    nodes = spark.read.parquet(path)
    if nodes.isEmpty():
        return _named(rows.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("id")}), keep)
    path = scratch_path(spark, "linked")
    linked(nodes, least).write.parquet(path)
    found = nodes.join(spark.read.parquet(path), "node", "left")
    members = found.where("root is not null").select("node", "root", "least_id")
    by_root = members.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = join_values(members.select("node", "root"), by_root, "root", "members").select("node", "component_id")
    values = found.drop("root").join(named, "node", "left").select(
        "vector",
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("links").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    path = scratch_path(spark, "values")
    values.write.parquet(path)
    done = join_values(rows.where("sound"), spark.read.parquet(path), "vector", "copies")
    rest = rows.where("not sound").withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("id")})
    return _named(done.unionByName(rest), keep)


def _named(rows: DataFrame, keep: list[str]) -> DataFrame:
    own = F.col("id").eqNullSafe(F.col("component_id"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in keep], "n_links", "component_id", own.alias("kept"))
