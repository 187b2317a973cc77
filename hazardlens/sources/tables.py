"""Stored tables: recursive Parquet trees, keyword text, SQL registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.schema import KEYWORDS

RESULT_TABLES = [
    "events_enriched", "events_clustered", "lead_time_matches", "lead_time_summary", "cluster_terms",
]


def read_tree(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files below ``path`` whatever the folder names; no partition columns are derived."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A ``key=value`` layout; the keys become columns and filters on them prune folders."""
    return spark.read.parquet(path)


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Header-less tab-separated (year, country, term, count); rows without a year are dropped."""
    return spark.read.schema(KEYWORDS).option("sep", "\t").csv(path).where(F.col("year").isNotNull())


def register_tables(spark: SparkSession, locations: dict[str, str], prefix: str = "") -> list[str]:
    """Expose stored Parquet folders as external SQL tables. Existing definitions are kept."""
    names = []
    for name, path in locations.items():
        full = f"{prefix}{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{path}'")
        if any(c.isPartition for c in spark.catalog.listColumns(full)):
            spark.catalog.recoverPartitions(full)
        names.append(full)
    return names
