"""Raw rows to the canonical event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlens.schema import CANONICAL


def empty_canonical(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CANONICAL)


def to_canonical(df: DataFrame, feed: str | None, /, raw: Column | None = None, **columns: Column) -> DataFrame:
    """Project to the canonical columns. Columns not given become typed nulls.

    ``raw`` is the original record (a struct); by default the whole input row is kept as provenance.
    """
    record = raw if raw is not None else F.struct(*df.columns)
    given = {**columns, "raw_json": F.to_json(record)}
    if feed is not None:
        given["source"] = F.lit(feed)
    return df.select(*[
        given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in CANONICAL.fields
    ])


def usable_rows(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("event_id").isNotNull()
        & (F.col("title").isNotNull() | F.col("text").isNotNull())
        & F.col("ts").isNotNull()
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``. Spark limits each group before the shuffle
    (WindowGroupLimit), so a hot key costs one row per map task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def drop_duplicate_events(df: DataFrame) -> DataFrame:
    """Earliest record per event id; coordinates, then wording, break ties so the result is repeatable."""
    order = [F.col(c).asc_nulls_last() for c in ("ts", "lat", "lon", "title", "text")]
    return first_per_key(df, ["event_id"], order)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
