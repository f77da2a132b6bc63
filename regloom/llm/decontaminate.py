"""Benchmark decontamination: Wu-Manber search for many test strings at once.

The test strings are the windows of ``window`` consecutive words of every item, or the whole
item where it has fewer words. Strings of one length share three tables over blocks of two
words: the shift table says how far the search may move on from a block that it sees at the
end of its window (a block of no string: past it), the buckets list the strings that end in
a block, and the first words of these are compared before the whole. Documents are searched
in lanes that move in step, so each round of table look-ups is one array operation; only the
positions that the shifts do not skip are ever looked at. A match is confirmed by comparing
the bytes of its words.

The test strings go to all executors, at most ``block_bytes`` of items (or one item) at a
time: a larger benchmark is searched in several passes, each of which adds to the spans and
items of the one before.

Defined results: a null or empty text, or one without words, has none and no hits; so has an
item. Items with a null id are searched under the id ``""``. Equal rows get equal results.
Result columns replace columns of the same name; other columns are kept as asked for. Empty
documents give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm import text as tx
from regloom.llm.ship import ship
from regloom.llm.wrapping import unwrapped, wrapped
from regloom.session import scratch_path

#: Words in a test string, and words in a block.
WINDOW, BLOCK = 10, 2
#: Bytes of benchmark items searched for in one pass.
BLOCK_BYTES = 16 << 20
#: Start positions in a lane.
LANE = 256

RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Words:
    """The words of many texts: their hashes, and the texts as words with one space between."""

    hashes: np.ndarray
    firsts: np.ndarray
    joined: bytes
    starts: np.ndarray
    ends: np.ndarray


def words_of(column: pa.Array) -> Words:
    data, offsets = tx.utf8(column)
    data = tx.LOWERED[data]
    starts, ends, firsts = tx.word_bounds(data, offsets, tx.PUNCTUATION)
    hashes = tx.Rolling(tx.BYTE_VALUES[data]).of(starts, ends)
    # Every word with one byte behind it, which becomes a space.
    sizes = ends - starts + 1
    new_starts = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(new_starts[-1]) + np.repeat(starts - new_starts[:-1], sizes)
    joined = np.append(data, tx.U64(32).astype(np.uint8))[source] if len(starts) else np.zeros(0, np.uint8)
    joined[new_starts[1:] - 1] = 32
    return Words(hashes, firsts, joined.tobytes(), new_starts[:-1], new_starts[1:] - 1)


def block_hash(hashes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """The hash of the block of words that ends at each place."""
    value = hashes[ends]
    if size > 1:
        value = value + tx.mix(hashes[ends - 1] + tx.U64(1))
    return tx.mix(value)


class Matcher:
    """The tables for all test strings of one length."""

    def __init__(self, length: int, strings: list[bytes], hashes: np.ndarray):
        self.length, self.size = length, min(BLOCK, length)
        self.bits = max(12, (len(strings) * length * 8).bit_length())
        self.shift = np.full(1 << self.bits, length - self.size + 1, np.uint8 if length < 250 else np.int64)
        for end in range(self.size - 1, length):
            places = self._blocks(hashes, end) & tx.U64((1 << self.bits) - 1)
            np.minimum.at(self.shift, places, self.shift.dtype.type(length - 1 - end))
        suffix = self._blocks(hashes, length - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.strings, self.hashes = suffix[order], [strings[i] for i in order], hashes[order]

    def _blocks(self, hashes: np.ndarray, end: int) -> np.ndarray:
        flat = hashes.reshape(-1)
        return block_hash(flat, np.arange(len(hashes)) * self.length + end, self.size)

    def search(self, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of arrays: places of occurrences in the words, numbers of the strings."""
        counts = np.maximum(0, np.diff(words.firsts) - self.length + 1)
        lanes = -(-counts // LANE)
        first = np.repeat(words.firsts[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        last = np.minimum(first + LANE, np.repeat(words.firsts[:-1] + counts, lanes))
        at, mask = first, tx.U64((1 << self.bits) - 1)
        while len(at):
            blocks = block_hash(words.hashes, at + self.length - 1, self.size)
            step = self.shift[blocks & mask].astype(np.int64)
            stop = np.flatnonzero(step == 0)
            if len(stop):
                yield from self._confirm(words, at[stop], blocks[stop])
                step[stop] = 1
            at = at + step
            on = at < last
            at, last = at[on], last[on]

    def _confirm(self, words: Words, at: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low, high = np.searchsorted(self.suffix, blocks, "left"), np.searchsorted(self.suffix, blocks, "right")
        while True:
            on = np.flatnonzero(low < high)
            if not len(on):
                return
            at, low, high = at[on], low[on], high[on]
            same = words.hashes[at] == self.hashes[low, 0]
            near = np.flatnonzero(same)
            starts, ends = words.starts[at[near]], words.ends[at[near] + self.length - 1]
            sure = [i for i, s, e, n in zip(near.tolist(), starts.tolist(), ends.tolist(), low[near].tolist()) if words.joined[s:e] == self.strings[n]]
            if sure:
                yield at[sure], low[sure]
            low = low + 1


@dataclass
class Patterns:
    """Everything that a pass searches for; ``owners`` lists the items of each string."""

    matchers: list[Matcher]
    owners: list[list[list[str]]]


def compile_patterns(items: list[tuple[str, str | None]], window: int) -> Patterns:
    words = words_of(pa.array([x or "" for _, x in items], pa.string()))
    by_length: dict[int, dict[bytes, tuple[int, set[str]]]] = {}
    for (item, _), first, end in zip(items, words.firsts[:-1].tolist(), words.firsts[1:].tolist()):
        length = min(window, end - first)
        for at in range(first, end - length + 1) if length else ():
            string = words.joined[words.starts[at] : words.ends[at + length - 1]]
            by_length.setdefault(length, {}).setdefault(string, (at, set()))[1].add(item)
    matchers, owners = [], []
    for length, strings in sorted(by_length.items()):
        places = np.array([at for at, _ in strings.values()])
        matcher = Matcher(length, list(strings), words.hashes[places[:, None] + np.arange(length)])
        matchers.append(matcher)
        owners.append([sorted(strings[s][1]) for s in matcher.strings])
    return Patterns(matchers, owners)


def search_texts(column: pa.Array, patterns: Patterns) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """For each text: its words, the places of words inside occurrences, the items found."""
    tx.entering("decontaminate")
    words = words_of(column)
    covered = np.zeros(len(words.hashes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(column))]
    for matcher, owners in zip(patterns.matchers, patterns.owners):
        for at, strings in matcher.search(words):
            np.add.at(covered, at, 1)
            np.add.at(covered, at + matcher.length, -1)
            texts = np.searchsorted(words.firsts, at, "right") - 1
            for text, string in set(zip(texts.tolist(), strings.tolist())):
                items[text].update(owners[string])
    hit = np.cumsum(covered[:-1]) > 0
    counts = np.diff(words.firsts)
    places = np.flatnonzero(hit)
    cut = np.searchsorted(places, words.firsts)
    return counts, [places[a:b] - f for a, b, f in zip(cut[:-1], cut[1:], words.firsts[:-1])], items


def _runs(places: np.ndarray) -> np.ndarray:
    """Places as flat pairs of start and end."""
    if not len(places):
        return places
    breaks = np.flatnonzero(np.diff(places) > 1)
    starts = np.concatenate([places[:1], places[breaks + 1]])
    ends = np.concatenate([places[breaks], places[-1:]]) + 1
    return np.stack([starts, ends], 1).reshape(-1)


def _scan(shared, text: str, keep: list[str], first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in batches:
            for part in tx.slices(batch, text):
                counts, hits, items = search_texts(part.column(text), patterns)
                if not first:
                    before = part.column("spans").to_pylist()
                    hits = [np.union1d(h, np.concatenate([np.arange(s, e) for s, e in zip(b[::2], b[1::2])])) if b else h for h, b in zip(hits, before)]
                    items = [x | set(b) for x, b in zip(items, part.column("items").to_pylist())]
                spans, offsets = tx.packed([_runs(h) for h in hits])
                results = [
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(spans, pa.int64())),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *results], [*keep, *RESULTS.names])

    return scan


def find_occurrences(
    documents: DataFrame, benchmark: DataFrame, *, text: str = "text", keep: list[str] | None = None, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Adds to the kept columns (all, unless named) what was found in each text.

    ``n_words``: its words. ``spans``: the runs of words inside occurrences, as flat pairs of
    start and end. ``items``: the ids, as strings in order, of the items with occurrences.
    """
    spark = documents.sparkSession
    ship(spark)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // block_bytes))
    share = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in RESULTS.names]
    rows = documents
    for n in range(passes):
        found = [tuple(r) for r in items.where(share == n).collect()]
        shared = spark.sparkContext.broadcast(compile_patterns(found, window))
        inner = wanted if n == passes - 1 or text in wanted else [*wanted, text]
        fields = [documents.schema[c] for c in inner]
        needed = list(dict.fromkeys([*inner, text])) + (RESULTS.names if n else [])
        rows = rows.select(*needed).mapInArrow(_scan(shared, text, inner, n == 0), T.StructType([*fields, *RESULTS.fields]))
        if n < passes - 1:
            path = scratch_path(spark, "occurrences")
            rows.write.parquet(path)
            rows = spark.read.parquet(path)
    return rows.select(*wanted, *RESULTS.names)


def hit_words(spans: str = "spans"):
    """The number of words in flat pairs of start and end."""
    signs = F.transform(F.col(spans), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signs, F.lit(0).cast("bigint"), lambda a, b: a + b)


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any occurrence, with the columns that they came with."""
    found = find_occurrences(wrapped(documents), benchmark, keep=["row", "text"], **options)
    return unwrapped(found.where(F.size("spans") == 0), documents)
