"""Document fingerprints by winnowing.

The hashes of all runs of ``k`` characters are rolled over a text; of every ``window`` of
consecutive hashes the least is chosen, the rightmost of equals. The chosen hashes with their
positions are the fingerprint. Any run of ``window + k - 1`` characters that two texts share
leaves at least one hash in both fingerprints, and none comes from fewer than ``k``.

Defined results: a null or empty text has an empty fingerprint. A text shorter than ``k`` has
one hash, of all of it, at position 0; one with fewer hashes than a window has its least.
Equal texts have equal fingerprints. Two empty fingerprints are alike (1), an empty one and
another are not (0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.llm import text as tx
from regloom.llm.repeats import least_of_runs
from regloom.llm.ship import ship

K, WINDOW = 12, 40


def winnow(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen hashes (32 bits) of all texts, their positions, and the offsets of texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    rolled = tx.Rolling(tx.mix(points.astype(np.uint64) + np.uint64(1)))
    grams = np.maximum(0, sizes - k + 1)
    picks = []
    if len(points) >= k:
        hashes = rolled.every(k) >> np.uint64(32)
        low = np.uint64(0xFFFFFFFF)
        keys = (hashes << np.uint64(32)) | (low - np.arange(len(hashes), dtype=np.uint64))
        # Texts with a whole window: its pick for every start.
        count = np.maximum(0, grams - window + 1)
        full = np.flatnonzero(count)
        if len(full):
            starts = np.repeat(offsets[:-1][full] - np.concatenate([[0], np.cumsum(count[full])])[:-1], count[full]) + np.arange(count.sum())
            chosen = least_of_runs(keys, window)[starts]
            fresh = np.ones(len(chosen), bool)
            fresh[1:] = chosen[1:] != chosen[:-1]
            picks.append(chosen[fresh])
        some = np.flatnonzero((grams > 0) & (count == 0))
        if len(some):
            bounds = np.stack([offsets[:-1][some], offsets[:-1][some] + grams[some]], 1).reshape(-1)
            picks.append(np.minimum.reduceat(np.append(keys, ~np.uint64(0)), bounds)[::2])
        picks = [np.concatenate(picks)] if picks else []
    place = (np.uint64(0xFFFFFFFF) - (picks[0] & np.uint64(0xFFFFFFFF))).astype(np.int64) if picks else np.zeros(0, np.int64)
    value = (picks[0] >> np.uint64(32)).astype(np.uint32) if picks else np.zeros(0, np.uint32)
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        place = np.concatenate([place, offsets[:-1][short]])
        value = np.concatenate([value, (rolled.of(offsets[:-1][short], offsets[1:][short]) >> np.uint64(32)).astype(np.uint32)])
    order = np.argsort(place, kind="stable")
    place, value = place[order], value[order]
    cut = np.searchsorted(place, offsets)
    return value, place - np.repeat(offsets[:-1], np.diff(cut)), cut


def likeness(a: np.ndarray, a_cut: np.ndarray, b: np.ndarray, b_cut: np.ndarray) -> np.ndarray:
    """The share of common hashes in the sets of hashes of two rows of fingerprints, pair by pair."""
    n = len(a_cut) - 1
    sets = [np.unique((np.repeat(np.arange(n, dtype=np.uint64), np.diff(c)) << np.uint64(32)) | x.astype(np.uint64)) for x, c in ((a, a_cut), (b, b_cut))]
    sizes = [np.bincount((s >> np.uint64(32)).astype(np.int64), minlength=n) for s in sets]
    both = np.intersect1d(*sets, assume_unique=True)
    common = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=n)
    either = sizes[0] + sizes[1] - common
    return np.where(either == 0, 1.0, common / np.maximum(either, 1))


def fingerprint_strings(values: np.ndarray, cut: np.ndarray) -> list[str]:
    """Each fingerprint as the hexadecimal of its hashes, in order of position."""
    digits = values.astype(">u4").tobytes().hex()
    return [digits[8 * s : 8 * e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]


def fingerprint_documents(documents: DataFrame, *, text: str = "text", keep: list[str] | None = None, k: int = K, window: int = WINDOW) -> DataFrame:
    """Adds ``hashes`` and ``positions`` (of code points), in order of position."""
    ship(documents.sparkSession)
    wanted = [c for c in (keep if keep is not None else documents.columns) if c.lower() not in ("hashes", "positions")]
    schema = T.StructType([*(documents.schema[c] for c in wanted), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("positions", T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, text):
                values, places, cut = winnow([t or "" for t in part.column(text).to_pylist()], k, window)
                lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.astype(np.int64))) for x in (values, places)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in wanted), *lists], [*wanted, "hashes", "positions"])

    return documents.select(*dict.fromkeys([*wanted, text])).mapInArrow(work, schema)


def map_with_next(documents: DataFrame, work: Callable[[list, list[str]], pa.RecordBatch], schema, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Calls ``work(ids, texts)`` on runs of documents in order of their ids.

    ``texts`` has one more than ``ids``: the text after the last one (after the greatest id,
    that of the least). Documents are dealt out by ranges of ids; the first of every range
    also goes to the range before it. Of the ids only the bounds of the ranges and the least
    of each come to the driver, as many as there are shuffle partitions.
    """
    spark = documents.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.coalesce(F.col(id).cast("bigint"), F.lit(-(2**63))).alias("order"), F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = sorted({int(c) for c in rows.select(F.col("order").cast("double").alias("order")).approxQuantile("order", [i / parts for i in range(1, parts)], 0.2 / parts)})
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda c: c < F.col("order")))
    least = sorted((r["part"], r["least"]) for r in rows.groupBy(part.alias("part")).agg(F.min("order").alias("least")).collect())
    # By range: its least id, and the range before it (that of the least is after the last).
    heads, before = [None] * (len(cuts) + 1), [None] * (len(cuts) + 1)
    for i, (number, head) in enumerate(least):
        heads[number], before[number] = head, least[i - 1][0]
    of_part = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), part + 1)
    guest = F.when(F.col("order") == of_part(heads, "bigint"), of_part(before, "int"))
    # 0: in its own range, 1: as the one after the last of another.
    places = F.filter(F.array(F.struct(part.alias("part"), F.lit(0).alias("guest")), F.struct(guest.alias("part"), F.lit(1).alias("guest"))), lambda p: p["part"].isNotNull())
    dealt = rows.select(F.explode(places).alias("place"), "order", "id", "text").select("place.part", "place.guest", "order", "id", "text")
    ordered = dealt.repartitionByRange(parts, "part").sortWithinPartitions("part", "guest", "order", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, ids, texts, size = None, False, [], [], 0
        for batch in batches:
            for place, is_guest, key, value in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "id", "text"))):
                if place != now:
                    now, done, ids, texts, size = place, False, [], [], 0
                if done:
                    continue
                texts.append(value)
                if is_guest:
                    # Of rows with one id the first is the next document.
                    done = True
                    if ids:
                        yield work(ids, texts)
                    continue
                if size > tx.SLICE_BYTES and ids:
                    yield work(ids, texts)
                    ids, texts, size = [], [value], 0
                ids.append(key)
                size += len(value)

    return ordered.select("part", "guest", "id", "text").mapInArrow(run, schema)


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edited(ids: list, texts: list[str]) -> pa.RecordBatch:
    """The fingerprints of texts, of the same with their last quarter from the next, and their likeness."""
    own, after = texts[:-1], texts[1:]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(own, after)]
    values, _, cut = winnow(texts)
    e_values, _, e_cut = winnow(edited)
    own_values, own_cut = values[: cut[-2]], cut[:-1]
    next_values, next_cut = values[cut[1] :], cut[1:] - cut[1]
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(fingerprint_strings(own_values, own_cut), pa.string()),
        pa.array(fingerprint_strings(e_values, e_cut), pa.string()),
        pa.array(likeness(own_values, own_cut, e_values, e_cut)),
        pa.array(likeness(own_values, own_cut, next_values, next_cut)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
