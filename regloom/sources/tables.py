"""Staging writes, fragments and published table versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from regloom.sources.csv import CSV_OPTIONS

# Fixed value: rows per fragment file.
FRAGMENT_ROWS = 50_000


def write_fragments(
    df: DataFrame,
    path: str,
    rows: int = FRAGMENT_ROWS,
    name: str | None = None,
    file_format: str = "parquet",
) -> None:
    """Add files of at most ``rows`` rows each; every task splits its own output.

    File names start with ``name``, by which a scan can tell datasets apart.
    """
    writer = df.write.mode("append").format(file_format).option("maxRecordsPerFile", rows)
    if name:
        writer = writer.option("mapreduce.output.basename", name)
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)


def write_full_fragments(df: DataFrame, path: str, rows: int, staged: str) -> None:
    """Add files of exactly ``rows`` rows, but for the last, from as many tasks as a shuffle has.

    ``staged`` is a folder for the rows while they are numbered: only the number of rows of
    each of its partitions comes to the driver.
    """
    spark = df.sparkSession
    df.write.parquet(staged)
    # The upper bits are the partition, the lower 33 the row's place in it.
    placed = spark.read.parquet(staged).withColumn("_place", F.monotonically_increasing_id())
    part = F.shiftright("_place", 33)
    counts = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    firsts, total = [], 0
    for p in range(max(counts, default=0) + 1):
        firsts.append(total)
        total += counts.get(p, 0)
    fragments = max(1, -(-total // rows))
    each = -(-fragments // int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = F.get(F.array(*map(F.lit, firsts)).cast("array<bigint>"), part.cast("int"))
    number = first + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    task = F.floor(number / F.lit(rows * each)).cast("int")
    dealt = placed.repartitionById(-(-fragments // each), task).drop("_place")
    write_fragments(dealt, path, rows=rows)


def append_staging(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_staging(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def clear_staging(spark: SparkSession, path: str) -> None:
    """Empty a staging table and keep its columns."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_version(
    df: DataFrame,
    table: str,
    version: int,
    keys: Sequence[str],
    *,
    location: str | None = None,
    buckets: int | None = None,
) -> str:
    """Write one version of a target table, not yet seen by its readers; returns its name.

    A version is bucketed by the merge key. The next upsert then reads it where it
    lies: only the collapsed source is shuffled, to as many partitions as there are
    buckets. The bucket count therefore follows ``spark.sql.shuffle.partitions``
    unless given. A merged result is already partitioned that way, so each task
    writes the one file of its bucket. A version that was never switched to may be
    written again; the one being read is never overwritten.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = f"{table}_v{version}"
    writer = df.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys)
    if location:
        writer = writer.option("path", version_path(location, table, version))
    writer.saveAsTable(name)
    return name


def version_path(location: str, table: str, version: int) -> str:
    return f"{location.rstrip('/')}/{table}/version={version}"


def switch(spark: SparkSession, table: str, version: int) -> DataFrame:
    """Point the view ``table`` at a version that is whole."""
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {table}_v{version}")
    return spark.table(table)


def publish(
    df: DataFrame,
    table: str,
    version: int,
    keys: Sequence[str],
    *,
    location: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write one version of a target table and point the view ``table`` at it."""
    write_version(df, table, version, keys, location=location, buckets=buckets)
    return switch(df.sparkSession, table, version)


def attach(
    spark: SparkSession, table: str, version: int, keys: Sequence[str], buckets: int, location: str
) -> DataFrame:
    """Make a version written by another session known to this one's catalog."""
    path, name = version_path(location, table, version), f"{table}_v{version}"
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return switch(spark, table, version)


class Manifest:
    """Which version of each table is current, kept under the store beside the tables.

    An entry is one file, written after all tables of a flow and so switching them
    together. Until it is there, the version may be written again.
    """

    SCHEMA = "table string, buckets int, keys array<string>, batch bigint, batches array<bigint>, flow string, version int"

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")

    @property
    def location(self) -> str:
        return f"{self.store}/tables"

    def _read(self, path: str) -> list[Row]:
        try:
            return self.spark.read.schema(self.SCHEMA).json(path).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []

    def current(self, flow: str) -> dict[str, Row]:
        """The entry of each table in the newest whole version of a flow."""
        rows = [r for r in self._read(f"{self.store}/manifest") if r.flow == flow]
        newest = max((r.version for r in rows), default=None)
        return {r.table: r for r in rows if r.version == newest}

    def unnamed(self, table: str, version: int) -> bool:
        """Whether there are files of the table of another version than this."""
        try:
            files = self.spark.read.option("recursiveFileLookup", "true").format("binaryFile")
            found = files.load(f"{self.location}/{table}").select("path")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return False
        return not found.filter(~F.col("path").contains(f"/version={version}/")).isEmpty()

    def record(self, flow: str, version: int, entries: Sequence[tuple]) -> None:
        """Entries are (table, buckets, keys, last batch, or that of each lane, or None)."""
        placed = [(*e[:3], None, list(e[3])) if isinstance(e[3], Sequence) else (*e, None) for e in entries]
        rows = self.spark.createDataFrame(
            placed, "table string, buckets int, keys array<string>, batch bigint, batches array<bigint>"
        )
        path = f"{self.store}/manifest/flow={flow}/version={version}"
        rows.coalesce(1).write.mode("overwrite").json(path)
