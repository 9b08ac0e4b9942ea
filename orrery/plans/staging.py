"""Written intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder and runs on one machine, as in tests.
LOCAL_SCRATCH = "/tmp/checkpoints"
_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


class NoSharedFolder(Exception):
    """On a cluster, scratch tables need ``spark.checkpoint.dir``."""


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, read from the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.conf.get("spark.master", "local").startswith("local"):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
    return (root or LOCAL_SCRATCH).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to; it goes when
    the application ends."""
    path = f"{scratch_root(spark)}/orrery/{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return f"{path}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: ends lineage and plan growth."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The staged table ``name`` of an input folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = staged(make(), name)
    return _WRITTEN[key]
