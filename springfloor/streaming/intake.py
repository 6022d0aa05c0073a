"""Structured Streaming: files taken in once, first row wins, late data bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType



def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the files of a folder; each file is read once (checkpointed)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_wins(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first row of each key; state is dropped ``late`` after the key's last event."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts per window and keys, final once the watermark has passed."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def run_available(stream: DataFrame, name: str, path: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None, every: str | None = None) -> StreamingQuery:
    """Process what is there and stop; output and checkpoint go under ``path``, which all
    executors share. A restart takes up where the last run ended. With ``every`` (as
    ``10 minutes``) it goes on in scheduled micro-batches instead, one at a time: one
    that is still running when the next is due makes that wait, and the running query is
    returned."""
    w = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint-{name}")
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    q = w.foreachBatch(each).start() if each else w.format("parquet").start(f"{path}/{name}")
    if not every:
        q.awaitTermination()
    return q


def run_until_idle(start: Callable[[], StreamingQuery], rounds: int = 1000) -> int:
    """Run a restartable query again until a run finds nothing new; how many runs read something."""
    for n in range(rounds):
        if not sum(p["rows"] for p in progress(start())):
            return n
    raise RuntimeError("new input in every round")


def progress(query: StreamingQuery) -> list[dict]:
    """Per micro-batch: its number, rows, rows a second and seconds."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p.get("processedRowsPerSecond"), "seconds": p["durationMs"].get("triggerExecution", 0) / 1000} for p in query.recentProgress]


def unknown_content(stream_batch: DataFrame, ledger_path: str, hash_column: str) -> DataFrame:
    """Rows of a micro-batch whose content hash isn't in the ledger yet, each content once."""
    spark = stream_batch.sparkSession
    batch = stream_batch.dropDuplicates([hash_column])
    try:
        done = spark.read.parquet(ledger_path).select(hash_column).distinct()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return batch
    return batch.join(done, hash_column, "left_anti")


def take_in(batch: DataFrame, ledger_path: str, hash_column: str) -> None:
    """For foreachBatch: append what the ledger doesn't know. A batch that is run again after
    a failure finds its own rows there and adds nothing."""
    columns = batch.columns
    unknown_content(batch, ledger_path, hash_column).select(*columns).write.mode("append").parquet(ledger_path)
