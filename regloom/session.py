"""Session settings and the scratch location shared by jobs and queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A strict scan relies on casts that fail.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Write to a few buckets or partitions at once instead of sorting rows by them.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Do not look up the Python call site of every expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: The JVM interprets a method of more bytes of code, however often it runs. Beyond the limit
#: Spark makes a method for a few columns each instead of one for a whole stage.
WIDE_ROWS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings for what runs or starts within the block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def session_with(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """Another session with all settings of this one, and with some changed."""
    session = spark.newSession()
    known = session.conf.getAll
    for key, value in {**spark.conf.getAll, **settings}.items():
        if known.get(key) != value:
            session.conf.set(key, value)
    return session


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("regloom")
    defaults = SETTINGS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (defaults | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory name every executor can reach.

    It lies under the shared folder named by ``spark.checkpoint.dir``. Only a
    local master may go without that setting, because there driver and executors
    share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="regloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
