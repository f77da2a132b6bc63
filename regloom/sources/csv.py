"""Scans of register CSV files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regloom.sources.headers import file_headers

# Quotes inside a field are doubled, in reading and in writing.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    mode: str = "PERMISSIVE",
    name_glob: str | None = None,
    multiline: bool = False,
    file_order: str | None = None,
    file_name: str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Read register files as strings, by header name.

    Nothing is inferred, so identifiers keep their leading zeros. Headers of several
    paths are read in one job and grouped: each vintage becomes one scan however many
    snapshots it spans, and the vintages are united by name. A file is then read by its
    own header; ``headers.header_report`` names those that differ from their folder. In
    a single path all files must have the same header. ``mode="FAILFAST"`` stops on a malformed record. ``multiline`` admits
    line breaks inside quotes at the price of unsplittable files.

    ``file_order`` and ``file_name`` name columns to add: one that orders rows as the
    files do, and one with the name of the file a row is from. ``malformed`` names one
    that holds the text of a record with too few or too many fields, else null.
    """
    options = CSV_OPTIONS | {"mode": mode, "multiLine": str(multiline).lower()}
    if name_glob:
        options["pathGlobFilter"] = name_glob
    by_header = _by_header(spark, [paths] if isinstance(paths, str) else list(paths), options, name_glob)

    scans = []
    for header, group in by_header.items():
        names = [*header, malformed] if malformed else header
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = spark.read.options(**options, enforceSchema="false").schema(schema)
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
        scan = reader.csv(group)
        extra = [row_order().alias(file_order)] if file_order else []
        extra += [F.col("_metadata.file_name").alias(file_name)] if file_name else []
        scans.append(scan.select("*", *extra))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _by_header(
    spark: SparkSession, paths: list[str], options: Mapping[str, str], name_glob: str | None
) -> dict[tuple[str, ...], list[str]]:
    """Which columns to read from which paths; what is gathered are names of files, as in any listing."""

    def columns(path: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**options).csv(path).columns)

    if len(paths) == 1:
        return {columns(paths[0]): paths}
    by_line: dict[str, list[str]] = {}
    for row in file_headers(spark, paths, name_glob).collect():
        by_line.setdefault(row["header"], []).append(_literal_path(row["file"]))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for files in by_line.values():
        by_header.setdefault(columns(min(files)), []).extend(files)
    if len(by_header) < 2:
        return {header: paths for header in by_header} or {columns(paths[0]): paths}
    return by_header


def _literal_path(file: str) -> str:
    """A file's path as Spark reports it, for a reader that expects patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def row_order() -> Column:
    """Position of a row in its input: file, block, then row within the block.

    Files are ordered by modification time, so what arrived later counts as later.
    Blocks are read by one task from start to end, so ids grow within a block and no
    global sort or single task is needed. Valid directly on a file scan only. All
    parts are of fixed width, which keeps the shuffle of a merge narrow.
    """
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition: str | None = None) -> None:
    writer = df.write.options(**CSV_OPTIONS).mode(mode)
    (writer.partitionBy(partition) if partition else writer).csv(path)
