"""Records with line breaks inside quotes, from files that are read in parts nonetheless.

A line break ends a record where the number of quotes before it in the file is even. The lines
of each part (byte range) of a file are counted for quotes, and sums over the parts of a file
say which parts begin inside quotes. Each part is then read again and cut into records from
its true first one; records across the borders of parts are put together from their pieces.

Quotes inside a field are doubled; an unquoted field holds none. Files are UTF-8 with lines ending
in ``\\n`` or ``\\r\\n``. A quote that is never closed makes one record of all that follows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regloom.operators.conform import quoted
from regloom.sources.csv import CSV_OPTIONS

WHOLE, OPENED, CONTINUED = 0, 1, 2
RECORD = "file string, modified timestamp, block long, row long, part int, record string"


def _lines(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)).alias("odd"),
        "value",
    )


def parts_inside_quotes(lines: DataFrame) -> set[tuple[str, int]]:
    """Parts of files that begin inside quotes: as many as parts at most, mostly none."""
    parts = lines.groupBy("file", "block").agg(F.sum("odd").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = parts.withColumn("before", F.sum("quotes").over(before)).where("before % 2 = 1")
    return {(r.file, r.block) for r in inside.collect()}


def records(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """Every record as text, with its file, part and the number of its first line there."""
    lines = _lines(spark, paths, name_glob)
    inside = parts_inside_quotes(lines)

    # All that workers need is in here, so they need no copy of this package.
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, modified, odd, held, first, row, joins = None, None, 0, [], 0, 0, False

        def piece(part: int) -> pa.RecordBatch:
            values = [[key[0]], [modified], [key[1]], [first], [part], ["\n".join(held)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        def whole(rows, texts: list[str]) -> pa.RecordBatch:
            n = len(texts)
            values = [[key[0]] * n, [modified] * n, [key[1]] * n, rows, [WHOLE] * n, texts]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        names = ["file", "modified", "block", "row", "part", "record"]
        kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        for batch in batches:
            files, blocks = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
            coded = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((coded[1:] != coded[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                now = (files[a].as_py(), int(blocks[a]))
                if now != key:
                    if held:
                        yield piece(CONTINUED if joins else OPENED)
                    key, modified, held, row = now, batch.column("modified")[a].as_py(), [], 0
                    joins = now in inside
                    odd = int(joins)
                quotes = batch.column("odd").to_numpy(zero_copy_only=False)[a:b]
                state = (odd + np.cumsum(quotes)) & 1
                values = batch.column("value").slice(a, b - a)
                at = 0
                # Lines that end outside quotes; those between two of them belong to the second.
                ends = np.flatnonzero(state == 0)
                if not held and len(ends) == len(state) and not joins:
                    yield whole(row + ends, values.to_pylist())
                    at = b - a
                else:
                    done: list[tuple[int, str]] = []
                    texts = values.to_pylist()
                    for end in ends.tolist():
                        if not held:
                            first = row + at
                        held += texts[at : end + 1]
                        if joins:
                            yield piece(CONTINUED)
                            joins = False
                        else:
                            done.append((first, "\n".join(held)))
                        held, at = [], end + 1
                    if at < b - a:
                        if not held:
                            first = row + at
                        held += texts[at:]
                    if done:
                        yield whole([r for r, _ in done], [t for _, t in done])
                odd, row = int(state[-1]), row + b - a
        if held:
            yield piece(CONTINUED if joins else OPENED)

    cut = lines.mapInArrow(work, RECORD)
    whole = cut.where(F.col("part") == WHOLE)
    if not inside:
        # No record crosses a border; what stays open to the end of a file is a record as it is.
        return _ended(cut)
    # A piece that continues a record belongs to the last part before in which one was left open.
    order = Window.partitionBy("file").orderBy("block", F.desc("part"))
    opened = F.last(F.when(F.col("part") == OPENED, F.col("block")), ignorenulls=True).over(order)
    pieces = cut.where(F.col("part") != WHOLE).withColumn("owner", opened)
    texts = F.array_sort(F.collect_list(F.struct("block", "record")))
    crossing = pieces.groupBy("file", "modified", "owner").agg(
        F.max(F.when(F.col("part") == OPENED, F.col("row"))).alias("row"), F.array_join(F.transform(texts, lambda t: t["record"]), "\n").alias("record")
    )
    crossing = crossing.select("file", "modified", F.col("owner").alias("block"), "row", F.lit(WHOLE).alias("part"), "record")
    return _ended(whole.unionByName(crossing))


def _ended(rows: DataFrame) -> DataFrame:
    return rows.withColumn("record", F.regexp_replace("record", "\r$", "")).drop("part")


def scan_quoted(
    spark: SparkSession, paths: str | Sequence[str], *, name_glob: str | None = None, file_order: str | None = None, file_name: str | None = None
) -> DataFrame:
    """Register files as strings by header name, with line breaks inside quotes, in parts.

    All files have the same header. ``file_order`` and ``file_name`` are as in ``scan_csv``.
    """
    found = records(spark, paths, name_glob)
    first = (F.col("block") == 0) & (F.col("row") == 0)
    headers = [r.record for r in found.where(first).select("record").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers[0][:200]!r} and {headers[1][:200]!r}")
    if not headers:
        raise ValueError(f"no records under {paths}")
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    columns = ", ".join(f"{quoted(n)} string" for n in _fields(spark, headers[0], options))
    place = F.struct("modified", F.xxhash64("file").alias("file"), "block", "row")
    extra = [place.alias(file_order)] if file_order else []
    extra += [F.url_decode(F.element_at(F.split("file", "/"), -1)).alias(file_name)] if file_name else []
    parsed = found.where(~first & (F.col("record") != "")).withColumn("cells", F.from_csv("record", columns, options))
    return parsed.select("cells.*", *extra)


def _fields(spark: SparkSession, header: str, options: dict[str, str]) -> list[str]:
    """The names in a header record."""
    many = ", ".join(f"c{i} string" for i in range(header.count(",") + 1))
    row = spark.range(1).select(F.from_csv(F.lit(header), many, options).alias("h")).first().h
    return [n for n in row if n is not None]
