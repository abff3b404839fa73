"""Intermediate tables that cut lineage, in the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of a method that the Java machine still compiles; longer ones are interpreted.
_COMPILED_BYTES = 8000
_SCAN_LIMIT = "spark.sql.files.maxPartitionBytes"
#: Rows of one file, and bytes of one scan task, of tables that learners turn into wide rows.
_ROWS_PER_FILE = 1_000_000
_SCAN_BYTES = 16 << 20


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder from the session; a temporary one only for a local master."""
    shared = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(_CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tabwright-")
    spark.conf.set(_CHECKPOINT_DIR, own)
    return own


def written(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write once, read back: survives lost executors and is scanned column by column."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.parquet(path)


def written_for_learners(df: DataFrame, name: str) -> DataFrame:
    """Rows that many fits will read inside ``small_scans``: files of few rows, so that no task gets many.

    A row takes few bits in a file and some hundred bytes as vectors, so bytes alone do not bound a task.
    """
    return written(df, name, _ROWS_PER_FILE)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even partitions by a near-unique key, for tables that many passes will read.

    No number is given, so adaptive execution keeps small tables in few partitions.
    """
    return df.repartition(*[F.col(k) for k in keys])


@contextmanager
def small_scans(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside read tables in small tasks."""
    before = spark.conf.get(_SCAN_LIMIT)
    own = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(_SCAN_LIMIT, str(min(own, _SCAN_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_SCAN_LIMIT, before)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside cut long selects into short methods instead of one that is interpreted."""
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, str(_COMPILED_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_METHOD_LIMIT)
        else:
            spark.conf.set(_METHOD_LIMIT, before)
