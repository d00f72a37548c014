"""Tables in the shared folder: the cluster's, from ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows below which a table of a few narrow columns (under 100 bytes a row) may be broadcast.
BROADCAST_ROWS = 50_000
#: Rows that one task is dealt by ``spread``, whatever the table.
DEALT = 10_000


#: Temporary folders of local masters, by application.
_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset and all runs on this machine, a temporary one of it."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None)
    root = root or _LOCAL.get(context.applicationId)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="parkwright-")
        context.setCheckpointDir(root)
        _LOCAL[context.applicationId] = root
    return root.rstrip("/")


#: Paths given out so far, in order.
_GIVEN: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    _GIVEN.append(f"{shared_root(spark)}/parkwright/{name}-{uuid.uuid4().hex}")
    return _GIVEN[-1]


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Delete all that ``cut`` and others have put in the shared folder; no DataFrame read from there works after it."""
    _delete(spark, f"{shared_root(spark)}/parkwright")
    _GIVEN.clear()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends, and lost executors cost no rerun."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows that ``make`` gives, written and read back; every other table that it left in the shared folder is deleted."""
    since = len(_GIVEN)
    rows = cut(make(), name)
    for path in _GIVEN[since:-1]:
        _delete(spark, path)
    _GIVEN[since:] = _GIVEN[-1:]
    return rows


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most BROADCAST_ROWS rows; else as it is, for a shuffled join."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all cores, and to no task more than about DEALT rows, if its files alone would not do so: for rows that cost much more than they weigh.

    For tables read from files, whose rows are counted by their footers; tables of as many partitions stay as they are.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, ceil(df.count() / DEALT))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow batches of at most ``rows`` rows: Python objects are made of so many rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
