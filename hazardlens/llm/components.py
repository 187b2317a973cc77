"""Connected components with DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``id, comp`` for all ids in ``edges`` (a, b): ``comp`` is the smallest id that can be reached.

    Each round takes the smallest label around and then the label of that label, so distances halve; stars end in
    two rounds. Minima are aggregated before they are shuffled, so a hub costs its edges only."""
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select(
        "id", F.least("id", "low").alias("comp")))
    while True:
        around = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("comp").alias("low"))
        near = labels.join(around, labels["id"] == around["a"]).select(
            "id", F.col("comp").alias("old"), F.least("comp", "low").alias("next"))
        far = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        moved = checkpointed(near.join(far, "next").select(
            "id", "old", F.least("next", "far").alias("comp")))
        labels = moved.select("id", "comp")
        if moved.where("comp < old").isEmpty():
            return labels
