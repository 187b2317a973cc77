"""Keyword frequency over (year, country)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import joined_text, lexicon_words, one_line
from hazardlens.schema import KEYWORD_LEXICON


def keyword_lines(df: DataFrame) -> DataFrame:
    """One (year, country, text) row per event with a known year; the text has no tabs or line breaks."""
    return df.select(
        F.year("ts").cast("string").alias("year"),
        F.coalesce("country", F.lit("UNK")).alias("country"),
        one_line(joined_text(F.col("title"), F.col("text"))).alias("text"),
    ).where(F.col("year").isNotNull())


def distinct_words(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    return df.withColumn(out, F.array_distinct(lexicon_words(F.col(text))))


def keyword_frequency(lines: DataFrame, lexicon: list[str] | None = None,
                      keys: tuple[str, ...] = ("year", "country")) -> DataFrame:
    """Documents per key and lexicon term. A term counts once per document.

    The lexicon test and the per-document de-duplication are one hashed array intersection, so only hits
    are exploded; partial counts are combined before the shuffle.
    """
    terms = F.array(*[F.lit(t) for t in (lexicon or KEYWORD_LEXICON)])
    kept = lines
    for key in keys:
        kept = kept.where(F.col(key) != "")
    found = F.array_intersect(lexicon_words(F.col("text")), terms)
    # An inner explode would add a size test that evaluates the same expression a second time.
    hits = kept.select(*keys, F.explode_outer(found).alias("term")).where(F.col("term").isNotNull())
    return hits.groupBy(*keys, "term").agg(F.count(F.lit(1)).cast("int").alias("count"))


def keyword_frequency_by_table(lines: DataFrame, lexicon: DataFrame,
                               keys: tuple[str, ...] = ("year", "country")) -> DataFrame:
    """Same result with the lexicon as a table (column ``term``) of any size."""
    words = distinct_words(lines).select(*keys, F.explode_outer("words").alias("term"))
    hits = words.join(lexicon.select("term").distinct(), "term", "left_semi")
    return hits.groupBy(*keys, "term").agg(F.count(F.lit(1)).cast("int").alias("count"))


def top_words(docs: DataFrame, n: int, text: str = "text", min_length: int = 4) -> DataFrame:
    """A corpus lexicon: the ``n`` words found in most documents."""
    words = distinct_words(docs, text).select(F.explode_outer("words").alias("term"))
    counted = words.where(F.length("term") >= min_length).groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))
    return counted.orderBy(F.col("n_docs").desc(), "term").limit(n)
