"""Take in fragments as micro-batches and merge them into their targets.

The checkpoint of the file source decides which fragments are new. For every target
a batch is collapsed to one change per key and written under its batch id, so its
cost follows the batch and not the target, and a batch run again overwrites its own
output. The changes of all batches are applied to a target in one merge.

A batch has a fixed cost, and a stream runs its batches one after another. The fragments of a
directory may therefore be dealt to several streams by their names: lanes, each with a
checkpoint and batches of its own, that run side by side.
"""

from __future__ import annotations

import json
import string
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regloom.operators.conform import quoted
from regloom.operators.upsert import Upsert, apply_changes, collapse, combine, merge, single_changes, split_by_key
from regloom.session import session_with
from regloom.sources.ledger import Folder
from regloom.streaming.compaction import Runs

BATCH, LOG_ENTRY = "batch_id", "entry.json"

#: A task reads as many small fragments as it can, so that a small batch takes one task.
FEW_TASKS = {
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "1m",
}


@dataclass(frozen=True)
class Intake:
    """Where batches are kept, on storage every executor can reach."""

    path: str

    def changes(self, table: str) -> str:
        return f"{self.path}/changes/{table}"

    @property
    def log(self) -> str:
        return f"{self.path}/log"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    def lanes(self, count: int) -> list[Intake]:
        """Where each of several streams keeps its batches; a single one keeps them here."""
        return [self] if count == 1 else [Intake(f"{self.path}/lane={lane}-of-{count}") for lane in range(count)]


def _unchanged(batch: DataFrame) -> DataFrame:
    return batch


@dataclass(frozen=True)
class Feed:
    """A target, and how a batch of fragments becomes source rows of its upsert."""

    spec: Upsert
    prepare: Callable[[DataFrame], DataFrame] = _unchanged


def fragment_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    name_glob: str | None = None,
    files_per_batch: int = 1000,
    file_format: str = "parquet",
    when_done: str = "off",
) -> DataFrame:
    """Fragments of a directory as a stream, optionally only names matching a glob.

    ``when_done="delete"`` removes fragments some batches after they were taken in;
    what counts as new is decided by the checkpoint alone.
    """
    reader = session_with(spark, FEW_TASKS).readStream.format(file_format).schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch).option("cleanSource", when_done)
    if file_format == "csv":
        reader = reader.options(header="true", escape='"', enforceSchema="false")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)


def lane_globs(count: int, ending: str = ".snappy.parquet") -> list[str]:
    """Patterns that deal fragments to streams by the character before an ending of that length.

    Every name fits exactly one, whatever its ending is. Files that Spark writes are numbered there,
    so they are dealt evenly; any other character, and a name too short, goes to the first.
    """
    if count == 1:
        return ["*"]
    known = string.digits + string.ascii_lowercase
    if not 1 < count <= len(string.digits):
        raise ValueError(f"fragments cannot be dealt to {count} streams")
    rest = "?" * len(ending)
    short = ["?" * n for n in range(1, len(ending) + 1)]
    others = "".join(c for lane in range(1, count) for c in known[lane::count])
    return ["{" + ",".join([f"*[^{others}]{rest}", *short]) + "}", *[f"*[{known[n::count]}]{rest}" for n in range(1, count)]]


def take_in(
    stream: DataFrame, feeds: Sequence[Feed], intake: Intake, sequence: str, held: int | None = None
) -> StreamingQuery:
    """Start collecting everything that has arrived; stops by itself when done.

    Fragments carry ``sequence``, so the order in which they arrive does not matter.
    With ``held``, the last batch that is published (-1 before the first), batches after it are
    compacted into runs as they come.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        part = f"{BATCH}={batch_id}"
        started = time.monotonic()
        # Of small batches there may be very many: what one task reads is not shuffled.
        single = batch.rdd.getNumPartitions() == 1
        if len(feeds) > 1:
            # Several targets read the batch; its fragments are parsed once.
            batch = batch.persist()
        for feed in feeds:
            table = feed.spec.table
            _changes(feed, batch, sequence, single).write.mode("overwrite").parquet(f"{intake.changes(table)}/{part}")
            if held is not None:
                runs = Runs(batch.sparkSession, intake.path, table)
                runs.add(batch_id, f"changes/{table}/{part}", feed.spec, held)
        flow = "+".join(feed.spec.table for feed in feeds)
        entry = {"flow": flow, "seconds": round(time.monotonic() - started, 2)}
        # A line of text is not worth a job.
        log = Folder(batch.sparkSession, f"{intake.log}/{part}")
        log.delete(LOG_ENTRY)
        log.create(LOG_ENTRY, json.dumps(entry))
        if len(feeds) > 1:
            batch.unpersist()

    return (
        _narrowed(stream, feeds, sequence)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", intake.checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def take_in_lanes(streams: Sequence[DataFrame], feeds: Sequence[Feed], intake: Intake, sequence: str) -> None:
    """Collect everything that has arrived by several streams side by side, and wait for all.

    The streams share no fragment, see ``lane_globs``. An intake keeps the number it began with:
    with another one, fragments would be new to streams that have not seen them.
    """
    lanes, root = intake.lanes(len(streams)), Folder(streams[0].sparkSession, intake.path)
    kept = {name for name in root.names() if name == "checkpoint" or name.startswith("lane=")}
    if not kept <= {"checkpoint"} if len(streams) == 1 else not kept <= {lane.path.rpartition("/")[2] for lane in lanes}:
        raise ValueError(f"{intake.path} was begun with another number of streams than {len(streams)}")
    started: list[StreamingQuery] = []
    try:
        for stream, lane in zip(streams, lanes):
            started.append(take_in(stream, feeds, lane, sequence))
        for query in started:
            query.awaitTermination()
    finally:
        # If one failed, the others stop; what they have not committed is taken in again.
        for query in started:
            query.stop()


def _narrowed(stream: DataFrame, feeds: Sequence[Feed], sequence: str) -> DataFrame:
    """The columns of a stream that its feeds read: a batch is a scan already, and reads all it is given."""
    specs = [feed.spec for feed in feeds]
    sources = (source for spec in specs for part in (spec.insert, spec.update) for source in part.values())
    read = {sequence, *(source for source in sources if isinstance(source, str))}
    if any(feed.prepare is not _unchanged for feed in feeds) or not read <= set(stream.columns):
        return stream
    return stream.select(*[quoted(c) for c in stream.columns if c in read])


def _changes(feed: Feed, batch: DataFrame, sequence: str, single: bool = False) -> DataFrame:
    source, spec = feed.prepare(batch), feed.spec
    if single:
        source = source.coalesce(1)
    keyed, loose = split_by_key(source, [spec.insert[k] for k in spec.keys], spec.complete)
    changes = collapse(keyed, spec, sequence)
    if loose is None:
        return changes
    return changes.unionByName(single_changes(loose, spec, sequence))


def merged(
    spark: SparkSession,
    target: DataFrame | None,
    spec: Upsert,
    intake: Intake | Sequence[Intake],
    after_batch: int | Sequence[int] = -1,
) -> DataFrame:
    """The target after every batch beyond the last one it already holds.

    Of several lanes, each has a last batch.
    """
    if isinstance(intake, Intake):
        intake, after_batch = [intake], [after_batch]
    held = list(zip(intake, after_batch, strict=True))
    # A lane to which no fragment was dealt has no changes.
    held = [lane for lane in held if any_batch(spark, lane[0])] or held[:1]
    stored = reduce(DataFrame.unionByName, [_stored(spark, spec.table, *lane) for lane in held])
    keyed, loose = split_by_key(stored, list(spec.keys), spec.complete)
    unkeyed = None if loose is None else apply_changes(None, loose, spec)
    return merge(target, combine(keyed, spec), unkeyed, spec)


def _stored(spark: SparkSession, table: str, intake: Intake, after_batch: int) -> DataFrame:
    return spark.read.parquet(intake.changes(table)).filter(F.col(BATCH) > after_batch).drop(BATCH)


def any_batch(spark: SparkSession, intake: Intake) -> bool:
    """Whether anything was ever taken in."""
    return bool(Folder(spark, intake.path).names("log"))


def last_batch(spark: SparkSession, intake: Intake) -> int:
    """The highest batch taken in; -1 before the first."""
    names = Folder(spark, intake.log).names(f"{BATCH}=*")
    return max((int(name.rpartition("=")[2]) for name in names), default=-1)


def batch_log(spark: SparkSession, intake: Intake) -> DataFrame:
    """Flow and seconds of every batch, one row each."""
    return spark.read.schema("flow string, seconds double").json(f"{intake.log}/{BATCH}=*/{LOG_ENTRY}")
