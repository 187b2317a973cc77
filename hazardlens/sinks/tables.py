"""Parquet and text writers.

Folders are written by Spark's committer straight to shared storage. Output files are balanced with the
``rebalance`` hint, which lets AQE split the files of a hot key instead of sending it to one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazardlens.operators.normalize import first_per_key
from hazardlens.schema import DOCUMENT_COLUMNS, LEAD_MATCHES, LEAD_SUMMARY, REGION_DATE
from hazardlens.sinks.snapshots import SnapshotTable

MAX_ROWS_PER_FILE = 5_000_000
#: Deltas hardly repeat, but those of pairs in the order of time lie close together: kept as differences, not in a dictionary.
PAIR_FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#delta_seconds": "false"}


class RowCountMismatch(RuntimeError):
    pass


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder beside ``path`` that becomes ``path`` when the block ends without an error."""
    jvm = spark._jvm
    target, staged, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{end}")
                           for end in ("", f".new-{uuid.uuid4().hex[:8]}", f".old-{uuid.uuid4().hex[:8]}"))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield staged.toString()
    except BaseException:
        files.delete(staged, True)
        raise
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"{path} cannot be replaced")
    if not files.rename(staged, target):
        files.rename(old, target)
        raise OSError(f"{path} cannot be replaced")
    files.delete(old, True)


def write_parquet(df: DataFrame, path: str, files: int | None = None, partition_by: list[str] | None = None,
                  mode: str = "overwrite", **options: str) -> None:
    """Overwrite (or append) a Parquet table, optionally with a fixed number of files or partition columns.

    ``files`` uses a full repartition, so asking for few files does not slow the stages before it. An overwrite is
    written beside the table and takes its place when it is complete; a failed write leaves the old table.
    """
    if mode == "overwrite":
        with replacing(df.sparkSession, path) as staged:
            return write_parquet(df, staged, files, partition_by, mode="errorifexists", **options)
    if files:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_ROWS_PER_FILE).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_source(df: DataFrame, path: str, files_per_source: dict[str, int] | None = None,
                    default_files: int = 8) -> None:
    """One folder per source. By default files are balanced by size, whatever a source holds; with ``files_per_source``
    each source gets exactly its number of files (others ``default_files``), rows dealt by chance, as long as it has rows enough
    and no file grows beyond ``MAX_ROWS_PER_FILE``. Sources are folders, so their names pass through the driver."""
    if not files_per_source:
        return write_parquet(df, path, partition_by=["source"])
    first, writers = {}, 0
    for source in sorted((r.source for r in df.select("source").distinct().collect()), key=lambda s: (s is not None, s)):
        first[source] = writers, files_per_source.get(source, default_files)
        writers += first[source][1]
    plan = df.sparkSession.createDataFrame([(k, *v) for k, v in first.items()], "place string, first int, files int")
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("files"))
    placed = df.join(F.broadcast(plan), df["source"].eqNullSafe(plan["place"])).withColumn(
        "__file", (F.col("first") + turn).cast("int")).repartitionById(max(1, writers), "__file").select(*df.columns)
    with replacing(df.sparkSession, path) as staged:
        placed.write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).partitionBy("source").parquet(staged)


def write_verified(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write, then compare the rows that passed through the write with the rows the files hold."""
    seen = Observation("written")
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by=partition_by)
    expected, stored = seen.get["rows"], df.sparkSession.read.parquet(path).count()
    if stored != expected:
        raise RowCountMismatch(f"{path}: {stored} rows stored, {expected} written")
    return stored


def write_lines(df: DataFrame, path: str, files: int | None = None, sep: str = "\t") -> None:
    """All columns joined to one text line per row; ``files`` asks for a number of output files."""
    lines = df.select(F.concat_ws(sep, *[F.col(c) for c in df.columns]).alias("line"))
    (lines.repartition(files) if files else lines).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str) -> None:
    write_parquet(df.select(*DOCUMENT_COLUMNS), path)


def write_keywords(df: DataFrame, path: str) -> bool:
    """Store the keyword table unless it is empty; says whether it was stored."""
    if df.isEmpty():
        return False
    write_parquet(df, path)
    return True


def region_date_rows(df: DataFrame) -> DataFrame:
    """Serving rows keyed by (country, month) / (time descending, event id); one row per full key."""
    rows = df.where(F.col("ts").isNotNull()).select(
        F.coalesce("country", F.lit("UNK")).alias("country"), F.date_format("ts", "yyyy-MM").alias("date_bucket"),
        F.col("ts").alias("event_time"), "event_id", "source", "event_type",
        F.col("severity").cast("float").alias("severity"), F.col("cluster_id").cast("int").alias("cluster_id"),
        "title", "lat", "lon")
    key = ["country", "date_bucket", "event_time", "event_id"]
    order = [F.col(c).asc_nulls_last() for c in ("source", "title", "event_type", "severity", "cluster_id",
                                                 "lat", "lon")]
    return first_per_key(rows, key, order)


def region_date_table(spark: SparkSession, path: str) -> SnapshotTable:
    """Folders by (country, date_bucket); inside a file rows are newest first."""
    return SnapshotTable(spark, path, ("country", "date_bucket"), (F.col("event_time").desc(), "event_id"))


def write_region_date(df: DataFrame, path: str) -> None:
    """The serving table anew. Readers see the old version until the new one is complete."""
    region_date_table(df.sparkSession, path).overwrite(region_date_rows(df).select(*REGION_DATE.names))


def upsert_region_date(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Merge rows into the serving table: equal keys are replaced, all other stored rows stay.

    Only the (country, month) folders that the new rows touch are read and written, and all of them change at once. A repeated
    load changes nothing; a writer that finds its folders changed by another one merges again."""
    rows = region_date_rows(df).select(*REGION_DATE.names)
    region_date_table(spark, path).upsert(rows, ["country", "date_bucket", "event_time", "event_id"])


def read_region_date(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return region_date_table(spark, path).read(version)


def write_lead_time(matches: DataFrame, summary: DataFrame, matches_path: str, summary_path: str) -> None:
    """Both tables with fixed schemas, also when there are no pairs."""
    write_parquet(matches.select(*[F.col(f.name).cast(f.dataType) for f in LEAD_MATCHES.fields]), matches_path, **PAIR_FILES)
    write_lead_summary(summary, summary_path)


def write_lead_summary(summary: DataFrame, path: str) -> None:
    write_parquet(summary.select(*[F.col(f.name).cast(f.dataType) for f in LEAD_SUMMARY.fields]), path, files=1)


def known_keys(incoming: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Stored keys that occur in ``incoming``.

    Only the key column of the store is read. The keys of the usual small batch are broadcast (AQE decides
    by size), so a large store is filtered where it is read and never shuffled.
    """
    return store.select(key).join(incoming.select(key).distinct(), key, "left_semi")


def new_rows(incoming: DataFrame, store: DataFrame, key: str = "event_id") -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(known_keys(incoming, store, key), key, "left_anti").select(*incoming.columns)


def poll_statistics(incoming: DataFrame, store: DataFrame, key: str = "event_id",
                    readable: Column | None = None) -> DataFrame:
    """What a merge would report: rows fetched, distinct keys it would insert, and rows that cannot be used.

    A row is an error without a key, or where ``readable`` (such as: a text and a time that could be read) is not true.
    """
    usable = F.col(key).isNotNull() & (F.coalesce(readable, F.lit(False)) if readable is not None else F.lit(True))
    rows = incoming.select(key, usable.alias("__usable"))
    known = known_keys(rows.where("__usable"), store, key).distinct().withColumn("__known", F.lit(True))
    fresh = F.when(F.col("__known").isNull() & F.col("__usable"), F.col(key))
    return rows.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("fetched"), F.count_distinct(fresh).alias("inserted"),
        F.count(F.when(~F.col("__usable"), 1)).alias("errors"))


def event_store(spark: SparkSession, path: str, key: str = "event_id") -> SnapshotTable:
    """A store that grows by inserts and knows which of its files can hold a key."""
    return SnapshotTable(spark, path, index_key=key)


def insert_only(spark: SparkSession, incoming: DataFrame, store_path: str, key: str = "event_id",
                batch: tuple[str, int] | None = None) -> dict[str, int]:
    """Insert rows with new keys into an :func:`event_store` and leave stored rows untouched; rows without a key are not
    stored. Returns fetched and inserted counts. Safe with several writers; a ``batch`` (stream, number) counts once."""
    store, fetched = event_store(spark, store_path, key), Observation()
    if batch and store.snapshot().batches.get(batch[0], -1) >= batch[1]:
        return {"fetched": incoming.count(), "inserted": 0}
    insert = store.inserting(incoming.observe(fetched, F.count(F.lit(1)).alias("n")), batch=batch)
    insert.commit()
    return {"fetched": fetched.get["n"], "inserted": insert.change.rows}
