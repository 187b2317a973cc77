"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from its words' features (the word, its beginnings
and ends); the document's is the noisy-or of its sentences. Only document labels are known: the weights are trained
on the noisy-or itself, so the sentences that explain the labels get the blame, and the same weights then point them
out. Features are counted and the bounded sample is reduced to chosen features in Spark; only the small training
matrix reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.llm.common import checkpointed, fresh

SAMPLE_DOCS = 10_000    #: expected number of labelled documents that are learned from
FEATURES = 3_000        #: features kept, by how surely they go with label 1
MIN_DOCS, MIN_SURETY = 4, 3.0
STARTS, ENDS = range(2, 8), range(3, 6)
STEPS, RATE, DECAY = 400, 0.05, 1e-4
CACHE_WORDS = 400_000

_TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]")
_STOPS = frozenset(".!?\n")


def features(word: str) -> list[str]:
    """A lower-case word, its beginnings (``ab*``) and its ends (``*yz``)."""
    return [word, *(word[:k] + "*" for k in STARTS if k < len(word)), *("*" + word[-k:] for k in ENDS if k < len(word))]


@dataclass
class Model:
    numbers: dict[str, int]
    weights: np.ndarray
    bias: float
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {"numbers": self.numbers, "weights": self.weights, "bias": self.bias, "known": {}}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            found = self.known[word] = tuple(self.numbers[f] for f in features(word.lower()) if f in self.numbers)
        return found

    def sentences(self, text: str | None) -> Iterator[tuple[int, int, set[int]]]:
        """Sentences with a known feature: start, end (code points of ``text``, end exclusive) and features."""
        start, found, end = 0, set(), 0
        for m in _TOKENS.finditer(text) if text and self.numbers else ():
            word, end = m[0], m.end()
            if word in _STOPS:
                if found:
                    yield start, end, found
                start, found = end, set()
            elif own := self.of(word):
                found.update(own)
        if found:
            yield start, end, found

    def bags(self, text: str | None) -> list[set[int]]:
        """The features of each sentence that has any, without positions."""
        out: list[set[int]] = []
        current: set[int] | None = None
        for word in _TOKENS.findall(text) if text and self.numbers else ():
            if word in _STOPS:
                current = None
            elif own := self.of(word):
                if current is None:
                    out.append(current := set())
                current.update(own)
        return out

    def chance(self, found: set[int]) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[list(found)].sum()))))

    def score(self, text: str | None) -> float:
        """Noisy-or of the sentences; a text without known features scores 0."""
        clean = 1.0
        for found in self.bags(text):
            clean *= 1 - self.chance(found)
        return 1 - clean


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = {w.lower() for w in _TOKENS.findall(text) if w not in _STOPS}
            for f in {f for w in words for f in features(w)}:
                counts.setdefault(f, [0, 0])[toxic] += 1
            if len(counts) > 300_000:
                yield _feature_rows(counts)
                counts = {}
        yield _feature_rows(counts)


def _feature_rows(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "feature": pa.array(counts, pa.string()), "clean": pa.array([c for c, _ in counts.values()], pa.int64()),
        "toxic": pa.array([t for _, t in counts.values()], pa.int64())})


def _bag_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [model.bags(t) for t in batch.column("text").to_pylist()]
        sizes = pa.array([[len(b) for b in bag] for bag in bags], pa.list_(pa.int32()))
        found = pa.array([[f for b in bag for f in sorted(b)] for bag in bags], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("draw"), sizes, found],
                                         names=["toxic", "draw", "sizes", "found"])


def fit(sentences: np.ndarray, sizes: np.ndarray, feature_of: np.ndarray, toxic: np.ndarray,
        start: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the labels under the noisy-or (Adam, fixed steps).

    ``sentences``: how many each document has; ``sizes``: how many features each sentence has; then the features."""
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    doc_of = np.repeat(np.arange(len(sentences)), sentences)
    bias, n = -4.0, len(start)
    weights = start.copy()
    if not len(doc_of):
        return weights, bias
    label = toxic[doc_of]
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        logit = bias + np.bincount(sentence_of, weights[feature_of], minlength=len(doc_of))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(sentences)))
        blame = clean[doc_of] / np.maximum(1 - clean[doc_of], 1e-9)
        slope = np.where(label == 1, -p * blame, p) / len(sentences)
        gradient = np.append(np.bincount(feature_of, slope[sentence_of], minlength=n) + DECAY * weights, slope.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        move = RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
              sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """About ``sample_docs`` labelled rows ``text, toxic, draw``, chosen by a hash of id and text; equal rows are one, so it
    holds no more than that, whatever repeats. What is drawn is small enough to be broadcast; texts are not shuffled before
    they are drawn."""
    given = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "said", F.xxhash64("text"))
    marked = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).distinct()
    known = checkpointed(given.select("id", "said").distinct().join(marked, "id").withColumn(
        "draw", F.pmod(F.xxhash64("id", "said"), F.lit(1 << 30))))
    limit = int(min(1.0, sample_docs / max(known.count(), 1)) * (1 << 30))
    drawn = known.where(F.col("draw") < limit)
    return given.join(F.broadcast(drawn), ["id", "said"]).groupBy("id", "said", "toxic", "draw").agg(F.first("text").alias("text")).select(
        "text", "toxic", "draw")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_docs: int = SAMPLE_DOCS, n_features: int = FEATURES) -> Model:
    """A model from the documents that ``labels`` (same id column) marks 0 or 1, or a sample of them (:func:`sample_of`);
    others and null texts teach nothing. An id that is marked both ways teaches both. With one label only, no feature tells
    anything and all scores are 0."""
    sample = checkpointed(sample_of(docs, labels, id_col, text_col, label_col, sample_docs))
    n, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == n:
        return Model({}, np.zeros(0), 0.0)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (positive + 1 - a)) - F.log(b / (n - positive + 1 - b))
    chosen = sample.mapInArrow(_count_features, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_DOCS).withColumn(
        "odds", odds).withColumn("surety", F.col("odds") / F.sqrt(1 / a + 1 / b)).where(
        F.col("surety") >= MIN_SURETY).orderBy(F.desc("surety"), "feature").limit(n_features).select("feature", "odds")
    rows = chosen.toArrow()
    names = rows.column("feature").to_pylist()
    model = Model({f: i for i, f in enumerate(names)}, np.zeros(len(names)), 0.0)
    held = sample.mapInArrow(partial(_bag_rows, model=model),
                             "toxic int, draw long, sizes array<int>, found array<int>").toArrow()
    held = held.sort_by("draw").combine_chunks()     # the same sums in every run
    sizes, found = (held.column(c).combine_chunks() for c in ("sizes", "found"))
    if isinstance(sizes, pa.ChunkedArray):          # no rows at all
        return model
    model.weights, model.bias = fit(pc.list_value_length(sizes).to_numpy(), pc.list_flatten(sizes).to_numpy(),
                                    pc.list_flatten(found).to_numpy().astype(np.int64),
                                    held.column("toxic").to_numpy(), rows.column("odds").to_numpy() * 0.5)
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Model, text_col: str, names: list[str], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(text_col).to_pylist()
        columns = [pa.array([model.score(t) for t in texts], pa.float64())]
        if len(names) > 1:
            spans = [[(start, end) for start, end, found in model.sentences(t) if model.chance(found) >= least] if score >= least else []
                     for t, score in zip(texts, columns[0].to_pylist())]
            columns.append(pa.array([[{"start": a, "end": b} for a, b in found] for found in spans],
                                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score", spans: str | None = None,
          least: float = 0.5) -> DataFrame:
    """``docs`` with the probability that a reader would label the document toxic, from its whole text.

    With ``spans`` a column of that name tells the sentences that reach ``least`` in documents that reach it: start and end in
    code points of the text as given, end exclusive. Null and empty texts score 0; a new column gets a free name if its name
    is taken."""
    names = [fresh(docs.columns, name)]
    added = [T.StructField(names[0], T.DoubleType())]
    if spans:
        names.append(fresh([*docs.columns, *names], spans))
        place = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
        added.append(T.StructField(names[1], T.ArrayType(place)))
    return docs.mapInArrow(partial(_scored, model=model, text_col=text_col, names=names, least=least), T.StructType([*docs.schema.fields, *added]))


def _located(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            for start, end, found in model.sentences(text):
                if (p := model.chance(found)) >= least:
                    for values, value in zip(out, (doc_id, start, end, p)):
                        values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                          pa.array(out[2], pa.int32()), pa.array(out[3], pa.float64())],
                                         names=["doc_id", "start", "end", "score"])


def offending_sentences(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                        least: float = 0.5) -> DataFrame:
    """``doc_id, start, end, score`` of the sentences that reach ``least``, in all documents (code points of the text
    as given, end exclusive)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        partial(_located, model=model, least=least), "doc_id long, start int, end int, score double")
