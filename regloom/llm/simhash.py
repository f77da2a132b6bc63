"""SimHash near-duplicates: an inverted index over bytes at positions, with count filtering.

The 64-bit fingerprint of a text has a bit set where more than half of its shingles' hashes
have it. Two fingerprints at most ``distance`` bits apart differ in at most that many of
their eight bytes, so they share at least ``8 - distance`` bytes at the same positions: the
guaranteed minimum. The index therefore lists each fingerprint under the bytes it has at
every choice of that many positions; two fingerprints that meet in a list are tallied (the
bytes that they share at the same positions), kept from the guaranteed minimum on, and
verified by their differing bits. Every link is found, and of the pairs that meet in a list
only a spanning forest of the verified links leaves the task.

Only distinct fingerprints enter the index, so copies cost nothing. A list is held as eight
bytes for each fingerprint. Short lists compare all pairs as arrays; in a long one, of near
copies by the thousand, links are found through common neighbours at half the distance,
which grows with the list and not with its square.

Defined results: a null or empty text, or one without words, has fingerprint zero and is
linked like any other. A text of fewer words than a shingle has one shingle, all its words.
A null id never names a component while another id does. Equal rows each appear.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from regloom.llm import repeats
from regloom.llm import text as tx
from regloom.llm.components import components
from regloom.llm.ship import ship
from regloom.session import scratch_path

#: Words in a shingle, most bits between linked fingerprints, seed of the hash.
WORDS, DISTANCE, SEED = 4, 4, 42
#: Pairs of a list are compared directly up to this length.
ALL_PAIRS = 4096
#: The lists of a choice of positions are dealt to tasks in buckets of about so many entries.
BUCKET_ENTRIES = 1 << 18


def joined_words(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts as words with one space behind each, their bounds, and the texts' first words."""
    data, offsets = tx.utf8(column)
    starts, ends, firsts = tx.word_bounds(data, offsets, tx.SPACE)
    sizes = ends - starts + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(places[-1]) + np.repeat(starts - places[:-1], sizes)
    joined = tx.LOWERED[np.append(data, np.uint8(32))[source]]
    joined[places[1:] - 1] = 32
    return joined.tobytes(), places[:-1], places[1:] - 1, firsts


def shingle_hashes(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The XXH64 of all shingles of each text, repeats included, and the offsets of texts."""
    joined, starts, ends, firsts = joined_words(column)
    n = np.diff(firsts)
    counts = np.where(n == 0, 0, np.maximum(1, n - words + 1))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    first = np.repeat(firsts[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    last = np.minimum(first + words, np.repeat(firsts[1:], counts)) - 1
    bounds = zip(starts[first].tolist(), ends[last].tolist()) if len(first) else ()
    return np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in bounds), np.uint64, len(first)), offsets


def fingerprints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A bit is set where more than half of a text's hashes have it."""
    counts = np.diff(offsets)
    result = np.zeros(len(counts), np.uint64)
    sums = np.zeros(len(hashes) + 1, np.int32)
    for bit in range(64):
        np.cumsum((hashes >> np.uint64(bit)).astype(np.uint8) & 1, dtype=np.int32, out=sums[1:])
        ones = sums[offsets[1:]] - sums[offsets[:-1]]
        result |= (2 * ones > counts).astype(np.uint64) << np.uint64(bit)
    return result


def add_fingerprints(documents: DataFrame, *, text: str = "text", keep: list[str], words: int = WORDS) -> DataFrame:
    """The kept columns and ``fingerprint`` as a (signed) long."""
    ship(documents.sparkSession)
    schema = documents.select(*keep, F.lit(0).cast("bigint").alias("fingerprint")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, text):
                prints = fingerprints(*shingle_hashes(part.column(text), words))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(prints.view(np.int64))], [*keep, "fingerprint"])

    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(work, schema)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest node linked, directly or not, to each of n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _verified(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Whether pairs share enough bytes at equal positions and differ in few bits."""
    differ = a ^ b
    shared = 8 - np.count_nonzero(differ.view(np.uint8).reshape(*differ.shape, 8), axis=-1)
    return (shared >= 8 - distance) & (np.bitwise_count(differ) <= distance)


def _close_pairs(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """All links in a short list of distinct fingerprints."""
    left, right = [], []
    step = max(1, (1 << 20) // len(values))
    for at in range(0, len(values), step):
        i, j = np.nonzero(_verified(values[at : at + step, None], values[None, :], distance))
        up = j > i + at
        left.append(i[up] + at)
        right.append(j[up])
    return np.concatenate(left), np.concatenate(right)


def _meeting_pairs(values: np.ndarray, distance: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a long list, each fingerprint with the next that has a common neighbour.

    Two are at most ``distance`` apart just if a value is at most half of that from both (with
    an odd distance, one of the two a bit nearer); differing bits lie among ``free``.
    """
    near, far = distance // 2, distance - distance // 2
    masks = [np.uint64(0)] + [np.uint64(sum(1 << int(b) for b in bits)) for n in range(1, far + 1) for bits in combinations(free, n)]
    close = sum(1 for m in masks if int(m).bit_count() <= near)
    left, right = [], []
    # Neighbours are dealt to rounds by their hash, so that a round fits in memory.
    rounds = max(1, len(values) * len(masks) >> 22)
    for r in range(rounds):
        neighbours, owners = [], []
        for k, mask in enumerate(masks):
            x = values ^ mask
            mine = np.flatnonzero(tx.mix(x) % np.uint64(rounds) == r)
            neighbours.append(x[mine])
            owners.append(mine * 2 + (k < close))
        x, o = np.concatenate(neighbours), np.concatenate(owners)
        order = np.lexsort((-(o & 1), x))
        x, o = x[order], o[order]
        starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        lead = np.repeat(o[starts], np.diff(np.append(starts, len(x))))
        # All that meet at a value are close to the first, which is a near one of it.
        linked = (lead & 1 == 1) & (lead >> 1 != o >> 1)
        left.append(lead[linked] >> 1)
        right.append(o[linked] >> 1)
    return np.concatenate(left), np.concatenate(right)


def _list_links(values: np.ndarray, distance: int, positions: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one list, as pairs (member, root)."""
    if len(values) <= ALL_PAIRS:
        left, right = _close_pairs(values, distance)
    else:
        free = np.array([8 * p + b for p in range(8) if p not in positions for b in range(8)])
        left, right = _meeting_pairs(values, distance, free)
    root = _roots(len(values), left, right)
    member = np.flatnonzero(root != np.arange(len(values)))
    return values[member], values[root[member]]


def links(prints: DataFrame, rows: int, distance: int = DISTANCE) -> DataFrame:
    """Edges ``a``, ``b`` that connect what links of at most so many bits connect.

    ``prints`` has distinct fingerprints, about ``rows`` of them; at most seven bits may differ.
    """
    choices = list(combinations(range(8), 8 - distance))
    buckets = max(32, rows // BUCKET_ENTRIES)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            octets = values.view(np.uint8).reshape(-1, 8).astype(np.uint64)
            for n, choice in enumerate(choices):
                key = np.zeros(len(values), np.uint64)
                for p in choice:
                    key = (key << np.uint64(8)) | octets[:, p]
                bucket = (tx.mix(key + np.uint64(n << 56)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                places = np.searchsorted(bucket[order], np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(places))
                data = values[order].tobytes()
                blobs = [data[8 * s : 8 * e] for s, e in zip(places[some].tolist(), places[some + 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.full(len(some), n), pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "choice", "entries"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, n), blobs in _runs(batches):
            values = np.unique(np.frombuffer(b"".join(blobs), np.uint64))
            octets = values.view(np.uint8).reshape(-1, 8).astype(np.uint64)
            key = np.zeros(len(values), np.uint64)
            for p in choices[n]:
                key = (key << np.uint64(8)) | octets[:, p]
            order = np.argsort(key, kind="stable")
            values, key = values[order], key[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            found = [_list_links(values[s : s + m], distance, choices[n]) for s, m in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist())]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = prints.select("fingerprint").mapInArrow(index, "bucket int, choice int, entries binary")
    return lists.repartition(parts, "bucket", "choice").sortWithinPartitions("bucket", "choice").mapInArrow(meet, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[bytes]]]:
    """The blobs of each (bucket, choice) of rows sorted by both."""
    now, blobs = None, []
    for batch in batches:
        for bucket, choice, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (bucket, choice) != now:
                if blobs:
                    yield now, blobs
                now, blobs = (bucket, choice), []
            blobs.append(blob)
    if blobs:
        yield now, blobs


def near_duplicates(documents: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``id``, ``fingerprint`` (a signed long) and ``component_id`` (the smallest id reachable) of every row."""
    spark = documents.sparkSession
    path = scratch_path(spark, "fingerprints")
    add_fingerprints(documents, text=text, keep=[id], words=words).write.parquet(path)
    prints = spark.read.parquet(path)
    rooted = _rooted(prints, F.col(id), distance)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select(F.col("fingerprint").alias("class"), "component_id")
    return prints.join(classes, prints["fingerprint"] == classes["class"]).select(id, "fingerprint", "component_id")


def _rooted(prints: DataFrame, first: Column, distance: int) -> DataFrame:
    """Each distinct fingerprint, ``least`` (the least ``first`` of its rows) and the ``root`` of its component."""
    least = prints.groupBy("fingerprint").agg(F.min(first).alias("least"))
    roots = components(links(least.select("fingerprint"), prints.count(), distance))
    return least.join(roots, least["fingerprint"] == roots["node"], "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))


def drop_near_duplicates(documents: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of which each component of linked fingerprints keeps one: that of least id.

    Documents are written once as blocks (see ``repeats``); what is shuffled is places in them.
    Null ids come last; of rows with equal ids in a component one stays, whichever is stored
    first. Ids may be of any type that can be ordered; columns stay as they are.
    """
    spark = documents.sparkSession
    blocks = repeats.write_blocks(documents, id, text)
    schema = T.StructType().add("id", documents.schema[id].dataType).add("fingerprint", "long").add("block", "long").add("row", "integer")

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = repeats.read_block(data.as_buffer())
                prints = fingerprints(*shingle_hashes(rows.column(text), words))
                places = [pa.array(np.full(len(prints), block)), pa.array(np.arange(len(prints), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([rows.column(id), pa.array(prints.view(np.int64)), *places], schema.names)

    path = scratch_path(spark, "fingerprints")
    blocks.select("block", "rows").mapInArrow(tx.tidy(fingerprint), schema).write.parquet(path)
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "block", "row")
    kept = _rooted(spark.read.parquet(path), place, distance).groupBy("root").agg(F.min("least").alias("place"))
    stay = kept.groupBy(F.col("place.block").alias("at")).agg(F.collect_list("place.row").alias("stay"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, rows in zip(batch.column(0), batch.column(1).to_pylist()):
                yield repeats.read_block(data.as_buffer()).take(pa.array(sorted(rows), pa.int64()))

    return blocks.join(stay, blocks["block"] == stay["at"]).select("rows", "stay").mapInArrow(tx.tidy(pick), documents.schema)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
