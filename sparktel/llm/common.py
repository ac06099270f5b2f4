"""What the operators share: input tables, the shared work folder and small column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktel.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors see; a folder of this machine only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="sparktel-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Workspace:
    """The work tables of one call: a folder under the shared one, removed on leaving, whether or not the call succeeds."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.name = spark, work_dir(spark, name), name

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)
        release(self.spark)

    def path(self, name: str) -> str:
        """A fresh path in the folder."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """df as a Parquet table of the workspace, read again: cuts lineage and survives lost executors."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def kept(self, df: DataFrame) -> DataFrame:
        """df as a table that outlives the workspace: what a call returns if it depends on work tables."""
        return written(self.spark, df, f"{self.name}-result")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts lineage and survives lost executors."""
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of plans that are done: it does so when the driver's references die."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: What a worker keeps between tasks, by the operator that uses it.
KEPT: dict[str, dict] = {}


def forget(owner: str) -> None:
    """Drop what operators other than the owner keep in this process."""
    for name, kept in KEPT.items():
        if name != owner:
            kept.clear()


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """A task's function that first drops what other operators keep, and afterwards gives freed memory back: workers live
    on between stages."""

    def tidy(batches: Iterator) -> Iterator:
        forget(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(docs: DataFrame, key: str, body: str) -> Column:
    """64-bit key of a row for regrouping: equal rows share it, so whatever is computed from the row alone agrees."""
    return F.xxhash64(F.lit(7), F.col(key).cast("string"), F.col(body))


def fits_broadcast(df: DataFrame, row_bytes: int, most_bytes: int) -> bool:
    """Whether df has at most most_bytes; counts no further than the limit."""
    limit = max(1, most_bytes // row_bytes)
    return df.limit(limit + 1).count() <= limit
