"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlens.session import checkpointed

__all__ = ["WORD", "checkpointed", "fresh", "let", "ordered_index", "partitions_of", "releasing", "slices", "table", "with_row_id"]

#: Fixed value: a word is a run of anything but space and the ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fresh(columns: list[str], base: str) -> str:
    """A column name that none of ``columns`` has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_row_id(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number that tells its rows apart, repeated rows too, and that column's name.

    The number follows from a row's place in its split, so ``docs`` has to be a stored table (or
    checkpointed): then every evaluation, also one after a lost executor, gives a row the same number."""
    name = fresh(docs.columns, "_row_id")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; one row at least, however long."""
    start = held = 0
    i = -1
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start <= i:
        yield start, i + 1


def releasing(work: Callable[..., Iterator[pa.RecordBatch]], **options) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``. When a task ends its worker gives unused memory back, as an executor keeps its workers
    while it goes on with other work."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches, **options)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
            if trim is not None:
                trim(0)

    return run


def ordered_index(df: DataFrame, *order: Column | str, name: str = "index") -> DataFrame:
    """``df`` (checkpointed) with the place of each row in the global order, from 0 without gaps.

    Rows are sorted by ranges, numbered inside their partition and shifted by the sizes of the partitions
    before it; only one row per partition is summed in order."""
    place, part = fresh(df.columns, "_place"), fresh(df.columns, "_part")
    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        place, F.monotonically_increasing_id()))
    counts = placed.groupBy(F.shiftright(place, 33).alias(part)).count()
    before = F.sum("count").over(Window.orderBy(part)) - F.col("count")
    offsets = counts.select(part, before.alias("_before"))
    return placed.withColumn(part, F.shiftright(place, 33)).join(F.broadcast(offsets), part).withColumn(
        name, F.col("_before") + F.col(place).bitwiseAND((1 << 33) - 1)).drop(place, part, "_before")
