"""A text classifier learned by counting: complement naive Bayes as DataFrame aggregates.

A word's weight for a label is the log-odds of the word among texts with that label against all other texts, from counts
over all labelled rows. A text's score for a label is the sum of its words' weights and of the label's own log-odds. There
is no sampling, iteration or hashing: any engine that can count gets the same model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.session import checkpointed

#: What counts as a word, in lower-cased text.
WORD = "[a-z]{2,}"
ALPHA = 1.0
MAX_LABELS = 500
#: A model of at most so many weights (8 bytes each) is sent to all tasks. Of a larger one the most frequent words are, and only
#: the other words of the texts are shuffled.
BROADCAST_WEIGHTS = 4_000_000
#: Scores are compared at this number of places, so that the order of adding cannot decide.
PLACES = 6


@dataclass(frozen=True)
class WordModel:
    """``labels`` in order, each with its own log-odds; ``weights`` has ``word, weights`` (one weight per label), ``every``
    (how often the word was counted). Unless the model is small, words counted ``sent_from`` times or more are sent to all tasks."""
    labels: list[str]
    prior: list[float]
    weights: DataFrame
    small: bool
    sent_from: int = 1 << 62

    @property
    def common(self) -> int:
        """The most frequent label, the first of equals: what a text without a known word gets."""
        return max(range(len(self.labels)), key=lambda k: (round(self.prior[k], PLACES), -k))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def fit_words(labelled: DataFrame, text: str = "text", label: str = "label", alpha: float = ALPHA) -> WordModel:
    """Count all rows with a label; null texts have no words. Labels go by their text, in order."""
    rows = labelled.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), words_of(F.col(text)).alias("words"))
    shares = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("words"), F.lit(0))).alias("held")).limit(
        MAX_LABELS + 1).collect()
    if not 0 < len(shares) <= MAX_LABELS:
        raise ValueError(f"{len(shares)} labels: between 1 and {MAX_LABELS} are needed")
    shares.sort(key=lambda r: r.label)
    labels, total = [r.label for r in shares], sum(r.n for r in shares)
    # Words are counted by label where they are read; one row per word comes out.
    counted = checkpointed(rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        *[F.count(F.when(F.col("label") == name, 1)).alias(f"n{k}") for k, name in enumerate(labels)]))
    size = counted.count()
    every = sum((F.col(f"n{k}") for k in range(len(labels))), F.lit(0))
    held = [float(r.held) for r in shares]

    def weight(k: int) -> Column:
        inside = (F.col(f"n{k}") + alpha) / (held[k] + alpha * size)
        outside = (every - F.col(f"n{k}") + alpha) / (sum(held) - held[k] + alpha * size)
        return F.log(inside) - F.log(outside)

    weights = checkpointed(counted.select("word", F.array(*[weight(k) for k in range(len(labels))]).alias("weights"), every.alias("every")))
    prior = [_log_odds(r.n, total) for r in shares]
    small = size * len(labels) <= BROADCAST_WEIGHTS
    return WordModel(labels, prior, weights, small, _sent_from(weights, BROADCAST_WEIGHTS // len(labels)))


def _sent_from(weights: DataFrame, limit: int) -> int:
    """The least count with at most ``limit`` words of that count or more."""
    held = 0
    for r in sorted(weights.groupBy("every").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.every):
        held += r.n
        if held > limit:
            return r.every + 1
    return 0


def _log_odds(n: int, total: int) -> float:
    import math

    return math.log((n + 1.0) / (total - n + 1.0))


def classify_words(df: DataFrame, model: WordModel, key: str, text: str = "text") -> DataFrame:
    """``key, event_type, margin, known_words`` for each distinct ``key`` of ``df`` (null keys are one).

    ``margin`` is the distance to the second-best label per known word. Equal scores go to the first label. Texts do not
    travel."""
    words = df.select(F.col(key).alias("key"), F.explode_outer(words_of(F.col(text))).alias("word"))
    n = len(model.labels)
    sums = [f"s{k}" for k in range(n)]

    def summed(counted: DataFrame, times: Column) -> DataFrame:
        return counted.groupBy("key").agg(
            F.sum(F.when(F.col("weights").isNotNull(), times).otherwise(0)).alias("known_words"),
            *[F.coalesce(F.sum(times * F.col("weights")[k]), F.lit(0.0)).alias(s) for k, s in enumerate(sums)])

    # Words meet the frequent words where they are read: what is shuffled is one row per key and task.
    sent = F.broadcast(model.weights if model.small else model.weights.where(F.col("every") >= model.sent_from))
    met = summed(words.join(sent, "word", "left"), F.lit(1))
    if not model.small:
        other = words.where(F.col("word").isNotNull()).join(sent, "word", "left_anti").groupBy("key", "word").agg(F.count("word").alias("times"))
        rare = model.weights.where(F.col("every") < model.sent_from)
        met = met.unionByName(summed(other.join(rare, "word"), F.col("times"))).groupBy("key").agg(*[F.sum(c).alias(c) for c in ["known_words", *sums]])
    scores = F.array(*[F.struct(F.round(F.col(f"s{k}") + F.lit(model.prior[k]), PLACES).alias("score"), F.lit(-k).alias("k"))
                       for k in range(n)])
    order = F.reverse(F.array_sort(scores))
    best = F.when(F.col("known_words") == 0, F.lit(model.common)).otherwise(-order[0]["k"])
    apart = F.when((F.col("known_words") > 0) & F.lit(n > 1), (order[0]["score"] - F.get(order, F.lit(1))["score"]) / F.col("known_words"))
    return met.select(F.col("key").alias(key), F.element_at(F.array(*map(F.lit, model.labels)), (best + 1).cast("int")).alias("event_type"),
                      F.coalesce(apart, F.lit(0.0)).alias("margin"), "known_words")
