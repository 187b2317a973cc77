"""Typing, severity and location of canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.severity import with_severity
from hazardlens.functions.text import joined_text
from hazardlens.functions.typing import cue_scores, rule_event_type
from hazardlens.operators.places import Gazetteer, resolve_places
from hazardlens.schema import ENRICHED, FREE_TEXT_SOURCES


def scored_text(text_mode: str = "first") -> Column:
    """``first``: text, or the title when there is no text. ``concat``: both, so a title is never hidden."""
    if text_mode == "first":
        return F.coalesce(F.col("text"), F.col("title"))
    if text_mode == "concat":
        return joined_text(F.col("title"), F.col("text"))
    raise ValueError(f"unknown text_mode {text_mode!r}")


def split_by_typing(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose type needs their text, rows typed by rule). A null source is in neither."""
    free = F.col("source").isin(FREE_TEXT_SOURCES)
    return df.where(free), df.where(~free)


def type_events(df: DataFrame, scorer: str = "skip", text_mode: str = "first",
                cues: dict[str, list[str]] | None = None, full_words: bool = False) -> DataFrame:
    """Add ``event_type`` and ``classify_conf`` in one pass, without splitting and re-uniting the rows.

    Rule-typed feeds get confidence 1. Free-text feeds get ``other``/0 with ``scorer='skip'`` or the
    label-cue result with ``scorer='cues'``.
    """
    typed = df.where(F.col("source").isNotNull())
    free = F.col("source").isin(FREE_TEXT_SOURCES)
    if scorer == "skip":
        free_type, free_conf = F.lit("other"), F.lit(0.0)
    elif scorer == "cues":
        typed = typed.withColumn("__cue", F.when(free, cue_scores(scored_text(text_mode), cues)))
        free_type, free_conf = F.col("__cue.event_type"), F.col("__cue.classify_conf")
    else:
        raise ValueError(f"unknown scorer {scorer!r}")
    return typed.select(
        *df.columns,
        F.when(free, free_type).otherwise(
            rule_event_type(F.col("source"), F.col("title"), full_words)).alias("event_type"),
        F.when(free, free_conf).otherwise(F.lit(1.0)).cast("float").alias("classify_conf"),
    )


def incomplete_location() -> Column:
    return F.col("country").isNull() | F.col("lat").isNull() | F.col("lon").isNull()


def fuse_locations(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Reported location first, inferred second, column by column."""
    raw = {f"raw_{c}": F.col(c) for c in ("lat", "lon", "country")} if keep_raw else {}
    fused = {c: F.coalesce(F.col(c), F.col(f"geo_{c}")) for c in ("lat", "lon", "country")}
    return df.withColumns({**raw, **fused})


def enrich(df: DataFrame, gazetteer: Gazetteer, scorer: str = "skip", text_mode: str = "first",
           keep_raw: bool = False, retype: bool = True) -> DataFrame:
    """Canonical rows plus type, confidence, severity and place.

    With ``retype=False`` the input already carries ``event_type`` and ``classify_conf``.
    """
    typed = type_events(df, scorer, text_mode) if retype else df
    typed = typed.withColumn("__scored", scored_text(text_mode))
    scored = with_severity(typed, text="__scored")
    placed = resolve_places(scored, gazetteer, F.col("__scored"), incomplete_location())
    fused = fuse_locations(placed.drop("__scored"), keep_raw)
    extra = [c for c in fused.columns if c not in ENRICHED.names]
    return fused.select(*ENRICHED.names, *extra)


def normalise_country(df: DataFrame, codes: DataFrame, column: str = "country") -> DataFrame:
    """Optional: map mixed country spellings to one code through a ``(spelling, code)`` table."""
    lookup = codes.select(F.col("spelling").alias(column), F.col("code").alias("__code"))
    return (df.join(lookup, column, "left")
            .withColumn(column, F.coalesce("__code", column)).select(*df.columns))


