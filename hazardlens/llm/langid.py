"""Language identification with language-bitmask n-gram filters.

Each language's frequent byte n-grams go into a Bloom filter. The filters are bit-sliced: slot i holds one bit per
language, so the hashes of an n-gram and one AND per hash give the set of all languages that know it (false
positives aside). Over a text these sets are counted per language and corrected for the filter's false positive
rate; the language with the highest corrected count wins.

Learning counts n-grams in Spark over a bounded sample of labelled documents; ``sample_docs`` is the expected
number per language. The filters are a few MB, however large the corpus, and travel with the task.

Whether a text is in a known language at all is told by its score. The least score of each language follows from
labelled documents that were not learned from (:func:`least_scores`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.llm.common import fresh, slices

GRAM = 4            #: bytes in an n-gram
TOP_GRAMS = 20_000  #: n-grams kept per language
SAMPLE_DOCS = 4_000  #: expected number of labelled documents per language that are learned from
SLOTS_LOG2 = 20     #: log2 of the slots of the filters
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)   # odd multipliers, any will do
FEW_GRAMS = 20      #: a text of fewer n-grams is too short to be told foreign
MIN_SCORE = 0.2     #: least score where too few labelled documents are held out to derive one
HELD_OUT = 4        #: one labelled text in so many is held out to derive the least scores
MIN_HELD_OUT = 20   #: different held-out texts that a language needs for a least score of its own
LOW_SHARE, MARGIN = 0.01, 0.25  #: a least score is this quantile of the held-out scores minus the margin
UNKNOWN = "und"
SLICE_BYTES = 1 << 20

#: Bytes that count as text: ASCII letters and everything beyond ASCII. Others are blanks.
_CLASS = np.array([0 if b == 0 else b if chr(b).isalpha() or b >= 128 else 32 for b in range(256)], np.uint8)


@dataclass
class Model:
    languages: list[str]        #: most frequent first
    masks: np.ndarray           #: (words, slots): the languages of each slot, up to 64 to a word
    false_rates: np.ndarray     #: false positive rate per language


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all texts end to end, and where each text's n-grams begin (one more than texts)."""
    coded = [b" %b  \0" % t.lower().encode() for t in texts]     # so the shortest word fills an n-gram
    data = _CLASS[np.frombuffer(b"".join(coded), np.uint8)].astype(np.uint32)
    begins = np.concatenate([[0], np.cumsum(list(map(len, coded)), dtype=np.int64)])
    if not texts:
        return np.empty(0, np.uint32), begins
    gram, whole = data[GRAM - 1:].copy(), data[GRAM - 1:] != 0
    some = data[GRAM - 1:] > 32
    for back in range(1, GRAM):
        part = data[GRAM - 1 - back:len(data) - back]
        gram |= part << np.uint32(8 * back)
        whole &= part != 0
        some |= part > 32
    good = whole & some
    before = np.concatenate([[0], np.cumsum(good)])
    return gram[good], before[np.minimum(begins, len(good))]


def _slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    wide = grams.astype(np.uint64)
    for multiplier in HASHES:
        yield (wide * np.uint64(multiplier)) >> np.uint64(64 - SLOTS_LOG2)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        texts = np.array(batch.column("text").to_pylist(), object)
        for language in sorted(set(languages)):
            own = texts[languages == language]
            for start, stop in slices(map(len, own), SLICE_BYTES):
                grams, counts = np.unique(_grams(list(own[start:stop]))[0], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([language] * len(grams), pa.string()),
                                                  "gram": grams.astype(np.int64), "n": counts.astype(np.int64)})


def _drawn(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
           sample_docs: int | None) -> tuple[DataFrame, list[str]]:
    """The sample (lang, text) of the labelled rows, all of them without ``sample_docs``, and their languages, most frequent
    first."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).alias("draw"))
    sizes = dict(known.groupBy("lang").count().collect())
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))
    if not languages or sample_docs is None:
        return known.select("lang", "text"), languages
    limit = F.create_map(*[F.lit(x) for name in languages
                           for x in (name, int(min(1.0, sample_docs / sizes[name]) * (1 << 30)))])
    return known.where(F.col("draw") < limit[F.col("lang")]).select("lang", "text"), languages


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int | None = SAMPLE_DOCS, top_grams: int = TOP_GRAMS) -> Model:
    """Filters of all languages in ``labelled``; rows without text or language teach nothing.

    The sample is chosen by a hash of the id, so it is the same in every run. With None all rows teach."""
    sample, languages = _drawn(labelled, id_col, text_col, lang_col, sample_docs)
    if not languages:
        return Model([], np.zeros((1, 1 << SLOTS_LOG2), np.uint64), np.zeros(0))
    counts = sample.mapInArrow(
        _count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.where("n > 1").withColumn("place", place).where(F.col("place") <= top_grams)
    numbers = {name: i for i, name in enumerate(languages)}
    words = -(-len(languages) // 64)
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    masks = np.zeros((words, 1 << SLOTS_LOG2), kind)
    found = top.select("lang", "gram").toArrow()
    order = np.array([numbers[x] for x in found.column("lang").to_pylist()], np.int64)
    for slots in _slots(found.column("gram").to_numpy().astype(np.uint32)):
        for word in range(words):
            own = order // 64 == word
            np.bitwise_or.at(masks[word], slots[own], kind(1) << (order[own] % 64).astype(kind))
    filled = [np.count_nonzero((masks[i // 64] >> kind(i % 64)) & kind(1)) / masks.shape[1]
              for i in range(len(languages))]
    return Model(languages, masks, np.array(filled) ** len(HASHES))


def classify(texts: list[str | None], model: Model) -> tuple[list[str], list[float], list[int]]:
    """Language, score and number of n-grams of each text. The score is the corrected share of the text's n-grams that the language
    knows. Null texts and texts without a letter are ``und`` with score 0; a text with letters but without known
    n-grams gets the most frequent language."""
    named = [UNKNOWN] * len(texts)
    scores, sizes = [0.0] * len(texts), [0] * len(texts)
    wanted = [i for i, t in enumerate(texts) if t is not None and any(c.isalpha() for c in t)]
    if not model.languages:
        return named, scores, sizes
    for start, stop in slices((len(texts[i]) for i in wanted), SLICE_BYTES):
        rows = wanted[start:stop]
        grams, begins = _grams([texts[i] for i in rows])
        positions = list(_slots(grams))
        total = np.diff(begins)
        hits = np.zeros((len(rows), len(model.languages)))
        for word, masks in enumerate(model.masks):
            found = masks[positions[0]]
            for slots in positions[1:]:
                found &= masks[slots]
            for bit in range(min(64, len(model.languages) - 64 * word)):
                summed = np.concatenate([[0], np.cumsum((found >> masks.dtype.type(bit)) & masks.dtype.type(1),
                                                        dtype=np.int64)])
                hits[:, 64 * word + bit] = summed[begins[1:]] - summed[begins[:-1]]
        real = (hits - total[:, None] * model.false_rates) / (1 - model.false_rates)
        best = real.argmax(axis=1)
        share = np.clip(real[np.arange(len(rows)), best] / np.maximum(total, 1), 0, 1)
        for i, language, score, n in zip(rows, best, share, total):
            named[i], scores[i], sizes[i] = model.languages[language], float(score), int(n)
    return named, scores, sizes


def _classified(batches: Iterator[pa.RecordBatch], model: Model, text_col: str, names: tuple[str, str],
                keep_from: dict[str, float] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages, scores, sizes = classify(batch.column(text_col).to_pylist(), model)
        if keep_from is None:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, *names])
        else:
            yield batch.filter(pa.array([x != UNKNOWN and (s >= keep_from.get(x, MIN_SCORE) or n < FEW_GRAMS)
                                         for x, s, n in zip(languages, scores, sizes)], pa.bool_()))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred",
            score_name: str = "score") -> DataFrame:
    """``docs`` with two more columns, language and score (see :func:`classify`); only the text is looked at."""
    names = (fresh(docs.columns, lang_name), fresh(docs.columns, score_name))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(partial(_classified, model=model, text_col=text_col, names=names, keep_from=None), schema)


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages, scores, sizes = classify(batch.column("text").to_pylist(), model)
        told = pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
            names=["key", "lang", "score"])
        yield told.filter(pa.array([x != UNKNOWN and n >= FEW_GRAMS for x, n in zip(languages, sizes)], pa.bool_()))


def least_scores(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 sample_docs: int | None = None, top_grams: int = TOP_GRAMS) -> dict[str, float]:
    """The least score that a text in each language of ``labelled`` gets, for :func:`keep_known`. All labelled texts
    count unless ``sample_docs`` is given.

    One text in ``HELD_OUT``, chosen by a hash of the text so that copies stay together, is scored by a model of the
    others; a language's least score is the ``LOW_SHARE`` quantile over the different texts told to be in it, minus
    ``MARGIN``. A language with fewer than ``MIN_HELD_OUT`` of them is left out."""
    key = F.xxhash64(F.col(text_col).cast("string"))
    held_out = F.pmod(key, F.lit(HELD_OUT)) == 0
    model = learn(labelled.where(~held_out), id_col, text_col, lang_col, sample_docs, top_grams)
    sample, _ = _drawn(labelled.where(held_out), id_col, text_col, lang_col, sample_docs)
    scores = sample.select("text", F.xxhash64("text").alias("key")).mapInArrow(
        partial(_scores, model=model), "key long, lang string, score double").distinct()
    low = scores.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", LOW_SHARE).alias("low"))
    return {r.lang: max(MIN_SCORE, r.low - MARGIN) for r in low.collect() if r.n >= MIN_HELD_OUT}


def keep_known(docs: DataFrame, model: Model, text_col: str = "text",
               min_score: float | dict[str, float] = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text is in one of the model's languages: not ``und``, and at least ``min_score``
    of its n-grams known unless there are too few to tell.

    ``min_score`` may differ by language (see :func:`least_scores`); languages that it leaves out have ``MIN_SCORE``. Null and
    empty texts and those without a letter go. A text that fits two languages equally counts as the more frequent one of
    them (then the first by name). Ids are not looked at: repeated rows and null ids are judged like others, and all columns
    stay as they are. An empty table gives no rows."""
    least = min_score if isinstance(min_score, dict) else dict.fromkeys(model.languages, min_score)
    run = partial(_classified, model=model, text_col=text_col, names=("", ""), keep_from=least)
    return docs.mapInArrow(run, docs.schema)


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % by, F.lit(-1))
