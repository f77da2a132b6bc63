"""Monthly loads: from published files to new versions of the target tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from regloom.operators import cells
from regloom.operators.report import RowCounts
from regloom.operators.upsert import Upsert, apply_changes, combine, merge_changes
from regloom.operators.validate import InvalidRows
from regloom.plans import cleaning, loading, targets
from regloom.plans.cleaning import CLEAN, MALFORMED, OUTCOME
from regloom.plans.loading import SEQUENCE
from regloom.sources.buckets import BucketStore
from regloom.sources.csv import scan_csv
from regloom.sources.layouts import LEGAL_UNITS
from regloom.sources.tables import Manifest, attach, switch, write_version
from regloom.streaming.compaction import Runs
from regloom.streaming.loader import Feed, Intake, any_batch, last_batch, merged, take_in, take_in_lanes

# Column with the name of the file a row is from.
FILE = "source_file"
QUARANTINE, STOP = "quarantine", "stop"


@dataclass(frozen=True)
class Run:
    """One monthly run.

    ``store`` is a folder on shared storage for cleaned rows, quarantine, table
    versions and the manifest that says which version is current; a later run may be
    another process. ``version`` names the table versions to write and must be higher
    than the current one. A run that failed may be repeated with the same version.
    ``as_of`` is the start of the run unless given. ``on_invalid`` says whether rows
    that break a rule are only set aside, or also stop the run before any merge.
    """

    spark: SparkSession
    store: str
    version: int
    as_of: datetime = field(default_factory=datetime.now)
    on_invalid: str = QUARANTINE

    def path(self, *parts: str) -> str:
        return "/".join([self.store.rstrip("/"), *parts, f"version={self.version}"])

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, self.store)

    def current(self, flow: str, specs: Sequence[Upsert]) -> dict[str, DataFrame | None]:
        """The tables as the last whole version of the flow left them; None before the first."""
        manifest = self.manifest
        known = manifest.current(flow)
        for spec in specs:
            entry = known.get(spec.table)
            if entry and entry.version >= self.version:
                raise ValueError(f"{spec.table} already has a version {entry.version}")
            if not entry and manifest.unnamed(spec.table, self.version):
                raise ValueError(f"{spec.table} has files that the manifest does not name")
        return {
            s.table: attach(self.spark, s.table, e.version, e["keys"], e.buckets, manifest.location)
            if (e := known.get(s.table))
            else None
            for s in specs
        }

    def publish(
        self,
        flow: str,
        contents: dict[str, DataFrame],
        specs: Sequence[Upsert],
        batch: int | Sequence[int] | None = None,
    ) -> None:
        """Write all tables, then switch all of them with one entry of the manifest."""
        manifest = self.manifest
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for s in specs:
            write_version(
                contents[s.table], s.table, self.version, s.keys, location=manifest.location, buckets=buckets
            )
        manifest.record(flow, self.version, [(s.table, buckets, list(s.keys), batch) for s in specs])
        for s in specs:
            switch(self.spark, s.table, self.version)


# Flows: tables that are switched together.
ESTABLISHMENT_FLOW, LEGAL_UNIT_FLOW = "establishments", "legal_units"


def load_establishment_files(
    run: Run, paths: str | Sequence[str], source: str | None = None
) -> dict:
    """Clean establishment files and merge them into their two tables.

    Rows are marked with ``source``, or else with the name of the file they are from.
    Returns the row counts of the cleaning step.
    """
    specs = (targets.geo_location(run.as_of.date()), targets.stock_etab())
    current = run.current(ESTABLISHMENT_FLOW, specs)
    raw = scan_csv(run.spark, paths, file_order=SEQUENCE, file_name=FILE, malformed=MALFORMED)
    path = run.path("establishments")
    sort_out = cleaning.sort_out_establishments
    clean, report = _cleaned(run, raw, source, sort_out, path, [MALFORMED])
    contents = loading.load_establishments(clean, current, run.as_of.date())
    run.publish(ESTABLISHMENT_FLOW, contents, specs)
    return report


def load_legal_unit_files(
    run: Run, paths: str | Sequence[str], translations: DataFrame, source: str | None = None
) -> dict:
    """Clean legal-unit files and merge them into their three tables.

    Rows are marked with ``source``, or else with the name of the file they are from.
    Returns the row counts of the cleaning step. A cell that does not read as its type stops
    the run with ``InvalidRows``, which names the first such cell.
    """
    specs = (targets.organisation(), targets.naf_code(run.as_of.date()), targets.stock_legal())
    current = run.current(LEGAL_UNIT_FLOW, specs)
    raw = scan_csv(run.spark, paths, mode="FAILFAST", file_order=SEQUENCE, file_name=FILE)
    path = run.path("legal_units")
    try:
        clean, report = _cleaned(run, raw, source, cleaning.sort_out_legal_units, path)
    except PySparkException as e:
        # The files are read again for the place only once there is an error.
        lenient = scan_csv(run.spark, paths, file_order=SEQUENCE, file_name=FILE)
        marked = cells.with_failed_cells(lenient, cells.type_rules(LEGAL_UNITS, lenient.columns))
        place = cells.first_failure(marked, SEQUENCE, FILE)
        if place is None:
            raise
        raise InvalidRows(place) from e
    contents = loading.load_legal_units(clean, translations, current, run.as_of.date())
    run.publish(LEGAL_UNIT_FLOW, contents, specs)
    return report


def load_fragments(
    run: Run,
    flow: str,
    stream: DataFrame | Sequence[DataFrame],
    feeds: Sequence[Feed],
    intake: Intake,
    sequence: str = SEQUENCE,
) -> int:
    """Take in the fragments that have arrived and publish their targets; returns the last batch.

    The manifest records the last batch that a version holds, so a repeat merges
    nothing twice, and changes held by the version before are not read again. Several
    streams are lanes that run side by side; the manifest records a last batch for each.
    """
    streams = [stream] if isinstance(stream, DataFrame) else list(stream)
    specs, lanes = [feed.spec for feed in feeds], intake.lanes(len(streams))
    current = run.current(flow, specs)
    entries = run.manifest.current(flow)
    after = {s.table: _held(entries.get(s.table), len(lanes)) for s in specs}
    take_in_lanes(streams, feeds, intake, sequence)
    last = [last_batch(run.spark, lane) for lane in lanes]
    contents = {s.table: merged(run.spark, current[s.table], s, lanes, after[s.table]) for s in specs}
    run.publish(flow, contents, specs, last[0] if len(last) == 1 else last)
    return max(last)


def _held(entry: Row | None, lanes: int) -> list[int]:
    """The last batch of each lane that a version holds."""
    held = None if entry is None else entry.batches or (None if entry.batch is None else [entry.batch])
    if held is not None and len(held) != lanes:
        raise ValueError(f"{entry.table} holds batches of {len(held)} streams, not of {lanes}")
    return [-1] * lanes if held is None else held


def merge_fragments(
    tables: BucketStore, stream: DataFrame, feeds: Sequence[Feed], intake: Intake, sequence: str = SEQUENCE, buckets: int | None = None
) -> int:
    """Take in the fragments that have arrived and merge them into touched buckets; returns the last batch.

    Rows count by their position, not by when they arrive: a late fragment does not overwrite
    what later rows wrote, and gives a key its inserted values if its row is the first one.
    A fragment may come twice. Tables hold a change for each key, with both positions;
    ``merged_table`` shows them as the target.
    """
    if any(not feed.spec.complete for feed in feeds):
        raise ValueError("rows without a complete key have no position to be merged by")
    spark = tables.spark
    held = tables.ledger.newest()[1].get("batch", -1)
    take_in(stream, feeds, intake, sequence, held).awaitTermination()
    last = last_batch(spark, intake) if any_batch(spark, intake) else -1
    if last <= held:
        return held
    specs = {feed.spec.table: feed.spec for feed in feeds}
    changes = {t: combine(Runs(spark, intake.path, t).changes(held), s) for t, s in specs.items()}
    tables.merge(
        changes,
        {t: s.keys for t, s in specs.items()},
        {t: lambda old, new, s=s: merge_changes(old, new, s) for t, s in specs.items()},
        batch=last,
        buckets=buckets,
    )
    return last


def merged_table(tables: BucketStore, spec: Upsert) -> DataFrame | None:
    """A table of ``merge_fragments`` in the columns of its target; None before the first merge."""
    stored = tables.read(spec.table)
    return None if stored is None else apply_changes(None, stored, spec)


def _cleaned(
    run: Run,
    raw: DataFrame,
    source: str | None,
    sort_out: Callable[..., DataFrame],
    path: str,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, dict]:
    """Cleaned rows, and what became of the others.

    The text is parsed once. Cleaned and quarantined rows go to partitions of one
    dataset, so every merge reads only columns it needs of the cleaned partition.
    """
    counts = RowCounts()
    rows = sort_out(raw, source or F.col(FILE), run.as_of, [SEQUENCE, FILE, *keep], counts)
    rows.write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    report = counts.report()
    if run.on_invalid == STOP and report["rows_quarantined"]:
        raise InvalidRows(f"{report['rows_quarantined']} rows are set aside in {path}")
    stored = run.spark.read.schema(rows.schema).parquet(path)
    return stored.filter(F.col(OUTCOME) == CLEAN).drop(OUTCOME), report
