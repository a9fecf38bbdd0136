"""Keep a frame that several jobs read, in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEPT: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every machine must see.

    Where it is unset, a local session is given a temporary one; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="venuelens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to Parquet once and read it back.

    Later passes then prune columns and survive lost executors. The table goes with ``release``, or when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/venuelens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _KEPT.append(path)
    target, files = _target(spark, path)
    files.deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables kept so far; to be called when no result that reads them is needed any more."""
    while _KEPT:
        target, files = _target(spark, _KEPT.pop())
        files.delete(target, True)


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
