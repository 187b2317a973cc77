"""File streams: landed JSON or Parquet events, severity scoring, append and insert-once sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hazardlens.functions.severity import with_severity
from hazardlens.schema import STREAM
from hazardlens.sinks.snapshots import TARGET_BYTES, SnapshotTable
from hazardlens.sinks.tables import event_store, insert_only

FILES_PER_TRIGGER = 5
TRIGGER = "15 seconds"


def read_events(spark: SparkSession, path: str, schema: T.StructType = STREAM, fmt: str = "json",
                multi_line: bool = True, files_per_trigger: int = FILES_PER_TRIGGER, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).options(**options)
    if fmt == "json":
        reader = reader.option("multiLine", multi_line)
    return reader.format(fmt).load(path)


def enrich_stream(events: DataFrame) -> DataFrame:
    typed = events.withColumns({
        "event_type": F.lit("streaming"), "classify_conf": F.lit(0.0).cast("float"),
    })
    return with_severity(typed).withColumn("cluster_id", F.lit(None).cast("int"))


def spread(batch: DataFrame, *keys: str) -> DataFrame:
    """A micro-batch dealt out to all cores. One of few files has few tasks, as a file's row group is not split.

    Rows are dealt by ``keys``, which needs no sort and no memory in the task that reads them."""
    return batch.repartition(batch.sparkSession.sparkContext.defaultParallelism, *keys)


def enriched(write: Callable[[DataFrame, int], None], *keys: str) -> Callable[[DataFrame, int], None]:
    """Score each micro-batch on all cores, whatever its number of files, and hand it to ``write``."""
    return lambda batch, batch_id: write(enrich_stream(spread(batch, *keys)), batch_id)


def _trigger(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append sink; the file log in the target makes it exactly-once across restarts."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, once).start(path)


def to_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               once: bool = False, mode: str = "append") -> StreamingQuery:
    """Hand each non-empty micro-batch to ``write``. A batch may be delivered again after a failure, so
    ``write`` must be idempotent (see :func:`batch_store` and :func:`insert_once`)."""
    def non_empty(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write(batch, batch_id)

    writer = stream.writeStream.foreachBatch(non_empty).outputMode(mode).option(
        "checkpointLocation", checkpoint)
    return _trigger(writer, once).start()


def batch_store(path: str) -> Callable[[DataFrame, int], None]:
    """One folder per batch, overwritten when the batch is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def append_once(path: str, stream: str, partition_by: tuple[str, ...] = (), target_bytes: int = TARGET_BYTES,
                ) -> Callable[[DataFrame, int], None]:
    """Append to a snapshot table that remembers the stream's last batch and merges small files as they come.

    A replayed batch adds nothing, also after its files were merged into others. ``stream`` names the checkpoint: a stream that
    begins anew with a fresh checkpoint needs a new name. A batch is written to files by its size, not by its number of tasks."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, path, partition_by)
        table.append(batch if partition_by else batch.hint("rebalance"), (stream, batch_id))
        table.compact(target_bytes)

    return write


def insert_once(store_path: str, key: str = "event_id", compact: bool = True) -> Callable[[DataFrame, int], None]:
    """Insert-only merge into an event store: a replayed batch finds its rows already there. Only files that may hold a key of
    the batch are opened."""
    def write(batch: DataFrame, batch_id: int) -> None:
        insert_only(batch.sparkSession, batch, store_path, key)
        if compact:
            event_store(batch.sparkSession, store_path, key).compact()

    return write


def partial_window_counts(path: str, width: str = "15 minutes", keys: tuple[str, ...] = ("event_type",),
                          ) -> Callable[[DataFrame, int], None]:
    """Store what each micro-batch adds to the tumbling windows, in a folder of its own that a replay overwrites.

    No state and no watermark: late rows count whenever they come, and open windows are there to be read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.groupBy(F.window("ts", width), *keys).agg(F.count(F.lit(1)).alias("n"))
        counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
                       "n").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def window_totals(spark: SparkSession, path: str, keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """All windows as of now, from the parts that :func:`partial_window_counts` stored."""
    return spark.read.parquet(path).groupBy("window_start", "window_end", *keys).agg(F.sum("n").alias("n"))


def drop_repeats(stream: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """First record per key while the key is within the watermark delay; state older than that is freed.

    Rows older than the delay are dropped. Where nothing may be lost, merge with :func:`insert_once` instead."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, width: str = "15 minutes", delay: str = "15 minutes",
                    keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Events per tumbling window; a window is emitted once the watermark has passed its end, rows later than
    ``delay`` are dropped. Where nothing may be lost, use :func:`partial_window_counts`."""
    counted = stream.withWatermark("ts", delay).groupBy(F.window("ts", width), *keys).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          *keys, "n")


def run_to_end(*queries: StreamingQuery, timeout: int = 600) -> None:
    """Wait until every available-now query is done; the first failure is raised."""
    for query in queries:
        if not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"stream {query.id} did not finish in {timeout} s")


def wait_for_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until some running query ends."""
    return spark.streams.awaitAnyTermination(timeout)
