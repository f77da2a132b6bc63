"""Header lines of many files, read in one job.

Each file is one task, which reads its first lines and stops: neither the number of rows nor the
size of a file counts. Nothing is opened from the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A file is never split and never shares a task: its first row is then its header.
ONE_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": "1t",
    "spark.sql.files.openCostInBytes": "1t",
    # Few rows are handed over at once, so that a task stops soon after the header.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}
#: Batches read to the end of a small file: a worker that stops before the end is not used again.
READ_ON = 64


def file_headers(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """The first line that is not blank of each file: ``file``, its ``folder``, ``header``.

    Files without such a line have no row. Headers hold no line breaks.
    """
    session = spark.newSession()
    for key, value in ONE_FILE_A_TASK.items():
        session.conf.set(key, value)
    reader = session.read.option("pathGlobFilter", name_glob) if name_glob else session.read
    lines = reader.text([paths] if isinstance(paths, str) else list(paths)).select("_metadata.file_path", "value")

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for n, batch in enumerate(batches):
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if found is None else ():
                header = line.lstrip("\ufeff").rstrip("\r\n")
                if header.strip():
                    found = {"file": [file], "header": [header]}
                    break
            if found is not None and n >= READ_ON:
                break
        if found is not None:
            yield pa.RecordBatch.from_pydict(found)

    found = lines.mapInArrow(first_line, "file string, header string")
    return found.select("file", F.regexp_replace("file", "/[^/]*$", "").alias("folder"), "header")


def header_report(headers: DataFrame) -> DataFrame:
    """For each folder and header: how many files have it, the first of them, and whether it drifts.

    A folder's usual header is the one most of its files have, of equals the least; all others drift.
    """
    counted = headers.groupBy("folder", "header").agg(F.count(F.lit(1)).alias("files"), F.min("file").alias("first_file"))
    usual = Window.partitionBy("folder").orderBy(F.desc("files"), "header")
    return counted.withColumn("drifts", F.row_number().over(usual) > 1)
