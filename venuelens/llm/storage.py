"""Tables written between steps, in the folder that all machines share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEPT: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset (a local session, as in tests) a temporary one is set."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def no_leftovers(spark: SparkSession) -> Iterator[None]:
    """While it lasts, the shuffle files of an execution and what the driver knows of them go when it has ended, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def short_plans(spark: SparkSession) -> Iterator[None]:
    """While it lasts, plans are described in few words. The driver keeps a description of every execution and of each of its adaptive changes;
    whole ones of large plans would fill it. What is executed stays the same."""
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "8192")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = 2 << 20) -> Iterator[None]:
    """While it lasts, rows go to Python in batches of about `most_bytes` in place of 10,000 rows: their buffers, one or more in the executor and in each
    Python worker, don't grow with the texts. For maps whose rows don't depend on the batch they are in."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a side of a join is broadcast only once its bytes are known from its shuffle. Before that Spark goes by the compressed bytes of the files read,
    whatever a map makes of their rows: a table of some MB in files, of which a map makes many rows, would be gathered on the driver. The limit stays the same."""
    first, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key, None) for key in (first, measured)}
    spark.conf.set(measured, before[measured] or spark.conf.get(first))
    spark.conf.set(first, "-1")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def keep(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation.

    The files go when the session ends, or earlier with `release`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    with short_plans(spark), no_leftovers(spark):
        df.write.parquet(path)
    _KEPT.append(path)
    _path(spark, path)[1].deleteOnExit(_path(spark, path)[0])
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Have Spark drop the broadcasts of ended executions, on the executors too. It does that when the driver has collected its garbage, which one with
    room left seldom does by itself: over a long run of small steps, executors would hold the broadcasts of all of them."""
    gc.collect()
    spark._jvm.System.gc()


def release(spark: SparkSession, since: int = 0, to: int | None = None) -> None:
    """Delete the tables kept after the first `since` ones, up to the first `to`; no frame that reads them may be used any more."""
    for path in _KEPT[since:to]:
        hadoop, fs = _path(spark, path)
        fs.delete(hadoop, True)
    del _KEPT[since:to]


def mark() -> int:
    """How many tables are kept now, for `release`."""
    return len(_KEPT)


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
