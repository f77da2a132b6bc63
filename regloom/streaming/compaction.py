"""Changes of many batches kept as few runs, so a publish reads a logarithmic number of them.

The changes of batches that no published table holds yet form runs, oldest first. A new batch
is a run of one; as long as the run before is of no more batches than what is being added, the
two become one. Runs thus hold 2**k batches, each change is rewritten once for each doubling,
and n batches are at most log2(n) + 1 runs. Which runs are current stands in a ledger: a run is
written whole before an entry names it, so a crash in between leaves the runs of before.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from regloom.operators.upsert import Upsert, combine, split_by_key
from regloom.sources.ledger import Folder, Ledger


@dataclass(frozen=True)
class Run:
    """Changes of the batches ``low`` to ``high``, of which there were ``batches``, in one folder."""

    low: int
    high: int
    batches: int
    folder: str


def combined(changes: DataFrame, spec: Upsert) -> DataFrame:
    """One change per key; changes without a complete key stay as they are."""
    keyed, loose = split_by_key(changes, list(spec.keys), spec.complete)
    done = combine(keyed, spec)
    return done if loose is None else done.unionByName(loose)


class Runs:
    """The runs of one target, under the folder where its batches are kept."""

    def __init__(self, spark: SparkSession, path: str, table: str):
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self.ledger = Ledger(spark, f"{self.path}/runs/{table}")

    def current(self) -> list[Run]:
        return [Run(**r) for r in self.ledger.newest()[1].get("runs", [])]

    def add(self, batch: int, folder: str, spec: Upsert, held: int = -1) -> None:
        """Take a batch in. Runs up to ``held``, the last batch that is published, are dropped.

        A batch that is in a run already changes nothing.
        """
        while True:
            number, entry = self.ledger.newest()
            known = [Run(**r) for r in entry.get("runs", [])]
            runs = [r for r in known if r.high > held]
            if known and known[-1].high >= batch:
                return
            joined, count = [Run(batch, batch, 1, folder)], 1
            while runs and runs[-1].batches <= count:
                joined.insert(0, runs.pop())
                count += joined[0].batches
            if self.ledger.put(number + 1, {"runs": [asdict(r) for r in (*runs, self._one(joined, spec))]}):
                self.ledger.forget(2)
                return

    def _one(self, runs: list[Run], spec: Upsert) -> Run:
        if len(runs) == 1:
            return runs[0]
        low, high = runs[0].low, runs[-1].high
        folder = f"merged/{self.table}/{low}-{high}-{uuid.uuid4().hex[:12]}"
        combined(self._read(runs), spec).write.parquet(f"{self.path}/{folder}")
        return Run(low, high, sum(r.batches for r in runs), folder)

    def _read(self, runs: list[Run]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/{r.folder}") for r in runs])

    def changes(self, after: int = -1) -> DataFrame | None:
        """The changes of all batches after one, still to be combined; None if there are none."""
        runs = [r for r in self.current() if r.high > after]
        if runs and runs[0].low <= after:
            raise ValueError(f"a run of {self.table} holds batches on both sides of {after}")
        return self._read(runs) if runs else None

    def collect(self, older_than: float) -> list[str]:
        """Delete runs and batches that have gone into later runs and are older than so many seconds."""
        current, now, gone = self.current(), time.time(), []
        live, newest = {r.folder for r in current}, max((r.high for r in current), default=-1)
        folder = Folder(self.spark, self.path)
        batches = [n for n in folder.names(f"changes/{self.table}/batch_id=*") if int(n.rpartition("=")[2]) <= newest]
        for name in (*folder.names(f"merged/{self.table}/*"), *batches):
            if name not in live and folder.modified(name) <= now - older_than:
                folder.delete(name)
                gone.append(name)
        return sorted(gone)
