"""Session helpers: reading tables and cutting lineage durably."""

from __future__ import annotations

import atexit
import contextlib
import gc
import json
import shutil
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its optimizer estimate is at most this many bytes.
BROADCAST_LIMIT = 2 << 20
#: Seconds between two collections of the driver's garbage, see ``drop_garbage``.
GARBAGE_EVERY = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table (file or folder) of a scale folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where the setting is absent and the master is local (tests), a temporary
    folder is made and stored in the session; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = getattr(spark.sparkContext, "_springfloor_folder", None)
        if not folder:
            folder = tempfile.mkdtemp(prefix="springfloor-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            spark.sparkContext._springfloor_folder = folder
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts lineage so that a costly stage (tokenising, parsing) feeding several
    later ones runs once and survives lost executors. Parquet rather than RDD
    checkpoints: later readers prune columns and the planner learns the size.
    """
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    drop_garbage(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._springfloor_path = path
    return out


def drop_garbage(spark: SparkSession) -> None:
    """Collect the garbage of the driver, if that was not done in the last seconds.

    Shuffle files stay on disk until the driver collects the plan of a finished stage,
    which it does by itself only when its heap is full. The driver's own peak of memory
    did not change by this (see README).
    """
    now, last = time.monotonic(), getattr(spark.sparkContext, "_springfloor_collected", None)
    if last is None or now - last >= GARBAGE_EVERY:
        gc.collect()  # frames in a ring hold their plans
        spark._jvm.System.gc()
        spark.sparkContext._springfloor_collected = time.monotonic()


def release(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote; nothing that reads it may run any more."""
    path = getattr(df, "_springfloor_path", None)
    if path:
        fs, p = file_system(df.sparkSession, path)
        fs.delete(p, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, in this application's own part of it, which goes
    when the application ends (or with ``clean``)."""
    root = shared_folder(spark)
    if not getattr(spark.sparkContext, "_springfloor_cleans", False):
        spark.sparkContext._springfloor_cleans = True
        atexit.register(clean, spark)
    return f"{root}/springfloor/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def clean(spark: SparkSession) -> None:
    """Delete all that this application wrote to the shared folder. What reads from it must be done."""
    with contextlib.suppress(Exception):  # the JVM may be gone already
        fs, p = file_system(spark, f"{shared_folder(spark)}/springfloor/{spark.sparkContext.applicationId}")
        fs.delete(p, True)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of parameters (rules, aliases, seeds) as a literal in the plan, so that the
    planner knows that it is small. Values are texts, numbers, booleans or null."""
    fields = [f.strip().split() for f in schema.split(",")]
    text = json.dumps([{n: v for (n, _), v in zip(fields, r)} for r in rows])
    kind = "array<struct<" + ",".join(f"{n}:{t}" for n, t in fields) + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def size_in_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (exact file size for plain scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the estimate is within ``limit``; else leave the
    choice (sort-merge with AQE skew splitting) to Spark."""
    return F.broadcast(df) if size_in_bytes(df) <= limit else df


def fresh(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
