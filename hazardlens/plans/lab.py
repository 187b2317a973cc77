"""One query under three conditions: cold, cached and cached with a join hint."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.operators.explore import type_country_term_counts
from hazardlens.session import scratch_path


def _hinted(events: DataFrame, terms: DataFrame) -> DataFrame:
    """The same counts as a join: events are counted per group first, so the keyless match works on the
    number of groups and not on the events. A cluster keeps a bounded number of ranked terms (10 by
    default, see ``themes.top_terms``), so the hinted side is small by construction."""
    small = F.broadcast(terms.where(F.col("cluster_id") == 0).select(F.lit(1).alias("one")))
    groups = events.groupBy("event_type", "country").agg(F.count(F.lit(1)).alias("events"), F.lit(1).alias("one"))
    return groups.join(small, "one").groupBy("event_type", "country").agg(F.sum("events").alias("n"))


def compare_conditions(events: DataFrame, terms: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Results of all conditions (column ``condition``) and the seconds each took."""
    spark = events.sparkSession
    needed = events.select("event_type", "country")
    seconds: dict[str, float] = {}
    paths = {}

    def run(condition: str, df: DataFrame) -> None:
        paths[condition] = scratch_path(spark, f"lab-{condition}")
        start = time.perf_counter()
        df.write.parquet(paths[condition])
        seconds[condition] = time.perf_counter() - start

    run("cold", type_country_term_counts(needed, terms))
    cached = needed.persist(StorageLevel.MEMORY_AND_DISK)
    cached_terms = terms.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cached.count()
        cached_terms.count()
        run("cached", type_country_term_counts(cached, cached_terms))
        run("hinted", _hinted(cached, cached_terms))
    finally:
        cached.unpersist()
        cached_terms.unpersist()
    results = None
    for condition, path in paths.items():
        part = spark.read.parquet(path).withColumn("condition", F.lit(condition))
        results = part if results is None else results.unionByName(part)
    return results.select("condition", "event_type", "country", "n"), seconds


def speedups(seconds: dict[str, float]) -> dict[str, float]:
    return {name: round(seconds["cold"] / s, 2) for name, s in seconds.items()}
