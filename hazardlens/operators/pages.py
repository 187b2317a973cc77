"""Paging by position: a sorted layout whose files know where their rows lie in the whole order.

Rows are sorted by ranges once, when they are stored; the n-th file holds the n-th range, and a small table beside the files
tells how many rows lie before each. A page then opens the files that it lies in, however deep it is, and sorts their rows
only. The list of files is what passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.sinks.tables import MAX_ROWS_PER_FILE, replacing


def newest_first() -> list[Column]:
    return [F.col("ts").desc(), F.col("event_id").asc()]


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    files_opened: int
    files: int


def write_pages(df: DataFrame, path: str, files: int | None = None, rows_per_file: int = MAX_ROWS_PER_FILE) -> None:
    """Store ``df`` sorted by :func:`newest_first` (null times last), in about ``files`` ranges and files of at most
    ``rows_per_file`` rows, with their positions. An older table at ``path`` is replaced when both are complete."""
    order = newest_first()
    ranged = (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    with replacing(df.sparkSession, path) as staged:
        ranged.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{staged}/rows")
        stored = df.sparkSession.read.parquet(f"{staged}/rows")
        # Names of files begin with the number of their range and end with their number inside it, so they sort like their rows.
        counts = stored.groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"[^/]+$", 0).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        counts.coalesce(1).write.parquet(f"{staged}/positions")


def page_at(spark: SparkSession, path: str, page_no: int, page_size: int) -> Page:
    """Page ``page_no`` (from 0) of a table that :func:`write_pages` stored. Beyond the end it is empty."""
    start, before, chosen = page_no * page_size, 0, []
    positions = sorted(spark.read.parquet(f"{path}/positions").collect(), key=lambda r: r.file)
    skipped = 0
    for held in positions:
        if before < start + page_size and before + held.rows > start:
            chosen.append(held.file)
        elif before + held.rows <= start:
            skipped = before + held.rows
        before += held.rows
    if not chosen:
        return Page(spark.read.parquet(f"{path}/rows").limit(0), 0, len(positions))
    rows = spark.read.parquet(*[f"{path}/rows/{file}" for file in chosen])
    return Page(rows.orderBy(*newest_first()).offset(start - skipped).limit(page_size), len(chosen), len(positions))
