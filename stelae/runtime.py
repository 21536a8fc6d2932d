"""Session helpers that every subpackage may use."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors once per application, through the
    shared folder, so that functions that run there import it from wherever they are."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = context._jvm.org.apache.hadoop.fs.Path(new_shared_path(spark, "sources") + "/stelae_sources.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(held.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local
    mode only (tests), one of our own where the session names none."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not conf:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """Write df as a table of the shared folder and go on from its files: lineage is
    cut, every executor can read them, and later joins are free to deal rows anew."""
    path = new_shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over all cores by these columns, before rows of small files are blown up: a
    file is read by as many tasks as it has row groups, be they ever so few."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: what was made of them has to be
    stored itself."""
    for table in tables:
        path = getattr(table, "stored_path", None)
        if path:
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def trim_memory() -> None:
    """Return what this process has freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def give_back_memory() -> None:
    """The same, and what stands in circles: the driver's Python outlives the training
    that it does."""
    gc.collect()
    trim_memory()


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow, with what a task has freed given back as it ends: Python workers
    outlive their tasks, and what they keep counts beside all later work of their executor."""

    def until_given_back(batches):
        from stelae import runtime

        yield from run(batches)
        runtime.trim_memory()

    return until_given_back
