"""Target tables kept by bucket: a merge reads and rewrites the buckets whose keys change, no others.

A table is a folder of ``bucket=.../attempt=...`` folders. Which attempt of each bucket is current
stands in a ledger entry that covers all tables of a flow, so they switch together; all other
buckets are carried over by name. The table is bucketed for Spark as well, so the touched part
is joined where it lies and only the changes are shuffled.

Publishing is optimistic. A merge writes its attempt without any lock and then competes for
the next entry. If another run was first, buckets that it did not touch stay as merged; a
table with a bucket that both changed is merged once more, on top of the winner's.

The session must read partitions from the folders; with a metastore, set
``spark.sql.hive.manageFilesourcePartitions`` to false.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.session import scratch_path
from regloom.sources.ledger import Folder, Ledger

BUCKET, ATTEMPT = "_bucket", "_attempt"
#: Seconds after which files that no entry names are nobody's work in progress.
ABANDONED = 24 * 3600

#: What a table becomes: its touched part before (None if the table is new) and changes, to its touched part after.
Apply = Callable[[DataFrame | None, DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Other runs were first each time."""


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


class BucketStore:
    """The tables of a flow, under a folder on shared storage."""

    def __init__(self, spark: SparkSession, store: str, flow: str):
        self.spark, self.store = spark, store.rstrip("/")
        self.ledger = Ledger(spark, f"{self.store}/entries/{flow}")

    def folder(self, table: str) -> str:
        return f"{self.store}/buckets/{table}"

    def _attached(self, table: str, held: Mapping) -> str:
        """The name under which the session's catalog knows all files of a table."""
        columns = T.StructType.fromJson(held["schema"])
        mark = hashlib.md5(f"{self.folder(table)} {held}".encode(), usedforsecurity=False).hexdigest()[:10]
        name = f"{table}_files_{mark}"
        if not self.spark.catalog.tableExists(name):
            Folder(self.spark, self.folder(table)).files.mkdirs(Folder(self.spark, self.folder(table))._path(""))
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            keys = ", ".join(f"`{k}`" for k in held["keys"])
            self.spark.sql(
                f"CREATE TABLE {name} ({listed}, {BUCKET} int, {ATTEMPT} string) USING parquet PARTITIONED BY ({BUCKET}, {ATTEMPT})"
                f" CLUSTERED BY ({keys}) INTO {held['buckets']} BUCKETS LOCATION '{self.folder(table)}'"
            )
        return name

    def read(self, table: str, only: Iterable[int] | None = None, entry: Mapping | None = None) -> DataFrame | None:
        """A table as the newest entry has it, or some of its buckets; None before the first."""
        state = (self.ledger.newest()[1] if entry is None else entry).get("tables", {}).get(table)
        if state is None:
            return None
        wanted = None if only is None else set(only)
        current = [f"{b}/{attempt}" for attempt, buckets in state["live"].items() for b in buckets if wanted is None or b in wanted]
        name = self._attached(table, {k: state[k] for k in ("schema", "keys", "buckets")})
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name).where(F.concat_ws("/", F.col(BUCKET).cast("string"), ATTEMPT).isin(current or ["-"])).drop(BUCKET, ATTEMPT)

    def merge(
        self,
        changes: Mapping[str, DataFrame],
        keys: Mapping[str, Sequence[str]],
        apply: Mapping[str, Apply],
        *,
        batch: int | None = None,
        buckets: int | None = None,
        tries: int = 10,
    ) -> int:
        """Merge changes into the tables of the flow; returns the number of the entry.

        A table that is new gets ``buckets`` buckets, as many as a shuffle has partitions unless
        given, and keeps them. The highest ``batch`` is noted in the entry. Raises ``Conflict`` after too many tries.
        """
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        staged: dict[str, DataFrame] = {}
        for table, rows in changes.items():
            # Changes are made once, and then read for their buckets and for each try.
            path = scratch_path(self.spark, f"changes-{table}")
            rows.write.parquet(path)
            staged[table] = self.spark.read.parquet(path)
        done: dict[str, dict] = {}
        for _ in range(tries):
            number, entry = self.ledger.newest()
            tables = dict(entry.get("tables", {}))
            for table, rows in staged.items():
                before = tables.get(table)
                if table not in done or done[table]["based_on"] != _attempts(before, done[table]["touched"]):
                    done[table] = self._written(table, rows, keys[table], apply[table], entry, number + 1, buckets)
                tables[table] = _switched(before, done[table])
            after = {**entry, "tables": tables}
            if batch is not None:
                after["batch"] = max(batch, entry.get("batch", -1))
            if self.ledger.put(number + 1, after):
                return number + 1
        raise Conflict(f"{', '.join(staged)}: other runs were first {tries} times")

    def _written(self, table: str, rows: DataFrame, keys: Sequence[str], apply: Apply, entry: Mapping, number: int, buckets: int) -> dict:
        """Write the touched buckets of a table, changed, as an attempt that no entry names yet."""
        before = entry.get("tables", {}).get(table)
        buckets = before["buckets"] if before else buckets
        touched = sorted(r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect())
        result = apply(self.read(table, touched, entry), rows)
        schema = before["schema"] if before else result.schema.jsonValue()
        state = {"schema": schema, "keys": list(keys), "buckets": buckets}
        attempt = f"{number:010d}-{uuid.uuid4().hex[:12]}"
        name = self._attached(table, state)
        names = [f["name"] for f in schema["fields"]]
        result.select(*names, bucket_of(keys, buckets).alias(BUCKET), F.lit(attempt).alias(ATTEMPT)).write.insertInto(name)
        return {**state, "attempt": attempt, "touched": touched, "based_on": _attempts(before, touched)}

    def collect(self, keep: int = 2, older_than: float = ABANDONED) -> list[str]:
        """Delete all but the last entries, and files that none of these names; returns the folders.

        Files younger than ``older_than`` seconds may be a merge under way, and stay.
        """
        self.ledger.forget(keep)
        entries = [self.ledger.get(n) for n in self.ledger.numbers()]
        now, gone = time.time(), []
        for table in {t for e in entries for t in e["tables"]}:
            live = {(b, a) for e in entries for a, some in e["tables"].get(table, {"live": {}})["live"].items() for b in some}
            folder = Folder(self.spark, self.folder(table))
            for name in folder.names(f"{BUCKET}=*/{ATTEMPT}=*"):
                bucket, attempt = (part.split("=", 1)[1] for part in name.split("/"))
                if (int(bucket), attempt) not in live and folder.modified(name) <= now - older_than:
                    folder.delete(name)
                    gone.append(f"{table}/{name}")
        return sorted(gone)


def _attempts(state: Mapping | None, buckets: Sequence[int]) -> dict[int, str]:
    """The current attempt of each of some buckets, where there is one."""
    wanted = set(buckets)
    return {b: a for a, some in (state or {"live": {}})["live"].items() for b in some if b in wanted}


def _switched(state: Mapping | None, done: Mapping) -> dict:
    """The table's part of the next entry: touched buckets from the new attempt, others as before."""
    touched = set(done["touched"])
    carried = {a: [b for b in some if b not in touched] for a, some in (state or {"live": {}})["live"].items()}
    live = {a: some for a, some in carried.items() if some}
    if done["touched"]:
        live[done["attempt"]] = done["touched"]
    return {"schema": done["schema"], "keys": done["keys"], "buckets": done["buckets"], "live": live}
