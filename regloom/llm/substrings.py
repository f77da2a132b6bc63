"""Substring dedup by seed and extend: no run of ``length`` words stays that starts earlier.

Seeds: every window of ``length`` words has an anchor, winnowed from its runs of ``seed``
words. Documents are joined on equal anchors. Extend: around an anchor the match is extended
to both sides, first over the whole segment of windows that share the anchor, compared by
hashes of 128 bits, then, where segments of one anchor differ, window by window, so that
the extension ends at the very word where the texts part. What the windows cover grows
together to maximal repeats; all have at least ``length`` words.

"Earlier" is a smaller id, or the same document and an earlier start; rows with equal ids are
in the order of their blocks and places. Windows are judged on the input, not on what is left.

A hot passage is one entry of each block of documents (see ``repeats``), so no group meets in
one task and no pairs of documents are listed.

Defined results: a null text has no words, and neither has an empty one; a text of fewer than
``length`` words loses nothing. Null ids come before all others. Result columns replace
columns of the same name, other columns are kept. A text is held in memory whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from regloom.llm import repeats
from regloom.llm import text as tx
from regloom.llm.repeats import Shape
from regloom.session import scratch_path

LENGTH, SEED = 20, 10

RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("repeats", T.ArrayType(T.LongType())),
        T.StructField("kept", T.StringType()),
    ]
)


def _matched(entries: DataFrame) -> DataFrame:
    """Extends the seeds of a bucket over their segments: repeated ones, and those to be looked at closer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in tx.values(batch.column(1)):
                (anchor, content, order, at, n, reach), block, found = repeats.received(rows)
                sort = np.lexsort((at, block, order, content, n == 0, anchor))
                anchor, content, at, n, reach, block = (x[sort] for x in (anchor, content, at, n, reach, block))
                whole = n > 0
                fresh = repeats.changes(anchor, content) | ~whole
                again = ~fresh
                found.add(block[again], at[again], n[again])
                # Segments of an anchor that has others, in any block.
                first = np.flatnonzero(repeats.changes(anchor))
                kinds = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first
                sizes = np.diff(np.append(first, len(anchor)))
                wanted = np.repeat(kinds > 1, sizes) & fresh & whole
                found.want(block[wanted], at[wanted], n[wanted], reach[wanted])
                if found.rows:
                    yield repeats.sent(found.rows)

    return repeats.gathered(entries).mapInArrow(tx.tidy(work), repeats.SENT).select("block", "spans", "wanted")


def _result(rows: pa.RecordBatch, units: repeats.Units, covered: np.ndarray, keep: list[str]) -> pa.RecordBatch:
    starts, ends, firsts = repeats.runs(covered, units.offsets)
    begin = np.repeat(units.offsets[:-1], np.diff(firsts))
    flat = np.stack([starts - begin, ends - begin], 1).reshape(-1)
    # The kept words of each text with one space between.
    word = np.flatnonzero(~covered)
    sizes = units.ends[word] - units.starts[word] + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(places[-1]) + np.repeat(units.starts[word] - places[:-1], sizes)
    data = np.append(units.data, np.uint8(32))[source]
    data[places[1:] - 1] = 32
    cut = np.searchsorted(word, units.offsets)
    joined, bounds = data.tobytes(), places[cut].tolist()
    kept = [joined[s : max(s, e - 1)] for s, e in zip(bounds[:-1], bounds[1:])]
    n_words = np.diff(units.offsets)
    results = [
        pa.array(n_words, pa.int64()),
        pa.array(n_words - np.diff(cut), pa.int64()),
        pa.ListArray.from_arrays(pa.array(firsts * 2, pa.int32()), pa.array(flat, pa.int64())),
        pa.array(kept, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *results], [*keep, *RESULTS.names])


def dedup_substrings(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """Adds ``n_words``, ``n_removed``, ``repeats`` (flat pairs of start and end, in words) and ``kept`` (text)."""
    spark = documents.sparkSession
    shape = Shape(False, length, seed)
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in RESULTS.names]
    blocks = repeats.write_blocks(documents.select(*dict.fromkeys([*wanted, id, text])), id, text)
    buckets = repeats.bucket_count(documents)
    first, second = scratch_path(spark, "segments"), scratch_path(spark, "windows")
    _matched(repeats.seed_entries(blocks, shape, id, text, buckets)).write.parquet(first)
    found = spark.read.parquet(first)
    repeats.repeated_windows(repeats.window_entries(blocks, found, shape, id, text, buckets)).write.parquet(second)
    spans = found.select("block", "spans").unionByName(spark.read.parquet(second))
    schema = T.StructType([*(documents.schema[c] for c in wanted), *RESULTS.fields])
    return repeats.finish(blocks, spans, shape, id, text, lambda rows, units, covered: _result(rows, units, covered, wanted), schema)
