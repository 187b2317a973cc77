"""Event-type rules and the label-cue scorer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword ladder (order matters) and alert-code prefixes of the rule typing.
LADDER = [
    ("wildfire", ["fire"]),  # also covers the longer word
    ("storm", ["storm", "cyclone", "hurricane", "typhoon"]),
    ("flood", ["flood"]),
    ("volcano", ["volcano"]),
    ("drought", ["drought"]),
]
ALERT_CODES = {
    "eq": "earthquake", "tc": "storm", "fl": "flood", "vo": "volcano", "dr": "drought", "wf": "wildfire",
}
FULL_WORDS = {
    "earthquake": "earthquake", "tropical cyclone": "storm", "flood": "flood", "volcan": "volcano",
    "drought": "drought", "wildfire": "wildfire", "forest fire": "wildfire",
}
# Cue words per short label; a label's score is its share of all cue hits.
LABEL_CUES = {
    "earthquake": ["earthquake", "quake", "aftershock", "epicenter", "magnitude"],
    "flood": ["flood", "floods", "flooding", "deluge", "inundation"],
    "storm": ["hurricane", "cyclone", "typhoon", "storm", "tornado"],
    "wildfire": ["wildfire", "wildfires", "bushfire", "blaze", "fire"],
    "volcano": ["volcano", "volcanic", "eruption", "lava"],
    "landslide": ["landslide", "landslides", "mudslide", "avalanche"],
    "drought": ["drought", "famine"],
    "tsunami": ["tsunami"],
    "aid": ["aid", "relief", "rescue", "shelter", "volunteers", "displaced"],
    "infra_damage": ["damage", "destroyed", "collapsed", "outages", "infrastructure"],
}


def rule_event_type(source: Column, title: Column, full_words: bool = False) -> Column:
    """Type from the feed itself: ``''`` for feeds whose type needs the text scorer."""
    feed = F.lower(F.coalesce(source, F.lit("")))
    head = F.lower(F.coalesce(title, F.lit("")))
    ladder = F
    for label, words in LADDER:
        ladder = ladder.when(reduce(lambda a, b: a | b, [head.contains(w) for w in words]), label)
    coded = F
    for code, label in ALERT_CODES.items():
        coded = coded.when(head.startswith(code), label)
    if full_words:
        for word, label in FULL_WORDS.items():
            coded = coded.when(head.contains(word), label)
    return (F.when(feed == "usgs", "earthquake")
            .when(feed == "eonet", ladder.otherwise("other"))
            .when(feed == "gdacs", coded.otherwise("other"))
            .otherwise(""))


def cue_scores(text: Column, cues: dict[str, list[str]] | None = None) -> Column:
    """``struct(event_type, classify_conf)`` from cue-word counts over the whole text.

    Confidence is the winning label's share of all cue hits. No hit gives ``other`` with 0. Ties go to
    the label listed first.
    """
    cues = cues or LABEL_CUES
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-z]+)"), F.lit(1))
    def hit_count(cue_words: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(cue_words)))

    hits = F.array(*[
        F.struct(hit_count(ws).alias("n"), F.lit(-i).alias("pref"), F.lit(label).alias("label"))
        for i, (label, ws) in enumerate(cues.items())
    ])
    total = F.aggregate(hits, F.lit(0), lambda acc, h: acc + h["n"])
    best = F.array_max(hits)
    return F.struct(
        F.when(total > 0, best["label"]).otherwise("other").alias("event_type"),
        F.when(total > 0, best["n"] / total).otherwise(0.0).cast("float").alias("classify_conf"),
    )
