from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hazardlens.llm import langid
from hazardlens.llm.common import table
from hazardlens.llm.queries import op2_language_filters
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(table(spark, "/root/testdata/sf0.01", "documents"))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = op2_language_filters(spark, folder).join(table(spark, folder, "documents"), "doc_id").collect()
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def grams(text):
    data = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in f" {text.lower()}  ".encode())
    return [int.from_bytes(data[i:i + 4], "big") for i in range(len(data) - 3) if data[i:i + 4].strip()]


def test_grams_and_counts_match_a_plain_count(model):
    texts = ["The cat, the dog", "", "É é", "x", "a1b2c3", "Ünd ö " * 50]
    found, begins = langid._grams(texts)
    assert [found[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == [grams(t) for t in texts]
    named, scores, sizes = langid.classify(texts, model)
    for text, name, score, n in zip(texts, named, scores, sizes):
        if not any(c.isalpha() for c in text):
            assert (name, score) == ("und", 0.0)
            continue
        real = []
        for language in range(len(model.languages)):
            hits = 0
            for gram in grams(text):
                places = [(gram * m % (1 << 64)) >> (64 - langid.SLOTS_LOG2) for m in langid.HASHES]
                hits += all(int(model.masks[0, p]) >> language & 1 for p in places)
            real.append((hits - n * model.false_rates[language]) / (1 - model.false_rates[language]))
        assert n == len(grams(text)) and name == model.languages[int(np.argmax(real))]
        assert score == pytest.approx(min(1, max(0, max(real) / n)))


def test_more_languages_than_one_word_holds(stored):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}qx " * 30, f"l{i}") for i in range(70)]
    learned = langid.learn(stored(rows, "doc_id long, text string, lang string"))
    assert learned.masks.shape[0] == 2
    named, _, _ = langid.classify([t for _, t, _ in rows], learned)
    assert named == [n for _, _, n in rows]


def test_odd_rows(stored, model):
    docs = stored(ODD_ROWS, ODD_SCHEMA)
    got = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    assert got[1, None].lang_pred == got[2, ""].lang_pred == "und"
    assert got[None, "The the"].lang_pred == "en"
    clash = docs.withColumnsRenamed({"lang": "lang_pred", "source": "Score"})
    assert langid.predict(clash, model).columns[-2:] == ["lang_pred_", "score_"]
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {3, 5, None}


def test_nothing_learned(documents):
    empty = langid.learn(documents.where(F.lit(False)))
    assert {r.lang_pred for r in langid.predict(documents, empty).collect()} == {"und"}


#: Plain sentences in languages that are not in ``documents.lang`` but related to those that are.
FOREIGN = [
    "Il governo ha annunciato ieri che le nuove misure contro la siccità entreranno in vigore nella prossima settimana.",
    "O governo anunciou ontem que as novas medidas contra a seca vão entrar em vigor na próxima semana em todo o país.",
    "De regering heeft gisteren aangekondigd dat de nieuwe maatregelen tegen de droogte volgende week van kracht worden.",
    "Regeringen meddelade i går att de nya åtgärderna mot torkan börjar gälla nästa vecka i alla delar av landet.",
    "El govern va anunciar ahir que les noves mesures contra la sequera entraran en vigor la setmana que ve.",
    "Rząd ogłosił wczoraj, że nowe środki przeciwko suszy wejdą w życie w przyszłym tygodniu we wszystkich regionach.",
]


def test_foreign_texts_go_and_clean_ones_stay(spark, folder):
    given = table(spark, "/root/testdata/sf0.1", "documents")
    held_out = langid.remainder(F.col("doc_id"), 5) == 0        # neither learned from nor used for the least scores
    learned = given.where(~held_out)
    least = langid.least_scores(learned)
    assert set(least) == {r.lang for r in given.select("lang").distinct().collect()}
    assert all(0.5 < s < 0.9 for s in least.values())
    model = langid.learn(learned)
    clean = given.where(held_out & F.col("text").rlike("[A-Za-z]"))
    assert langid.keep_known(clean, model, min_score=least).count() == clean.count()
    rows = [(-1 - i, text, None, "x", len(text)) for i, text in enumerate(FOREIGN)]
    spark.createDataFrame(rows, given.schema).unionByName(given).write.parquet(f"{folder}/foreign")
    kept = corpus_pipeline.known_language(spark, spark.read.parquet(f"{folder}/foreign"), folder)
    assert kept.where("doc_id < 0").count() == 0
    assert kept.count() == langid.keep_known(given, langid.learn(given)).count()


def test_few_held_out_texts_leave_the_fixed_score(spark, documents):
    assert langid.least_scores(documents.limit(30)) == {}
    assert langid.least_scores(documents.where(F.lit(False))) == {}


def test_least_scores_and_pipeline_learn_from_all_rows(spark, monkeypatch):
    import corpus_pipeline

    given = spark.createDataFrame([(k, f"some words of number {k} and more", "en") for k in range(200)], "doc_id long, text string, lang string")
    assert langid._drawn(given, "doc_id", "text", "lang", None)[0].count() == 200 > langid._drawn(given, "doc_id", "text", "lang", 50)[0].count()
    asked, drawn = [], langid._drawn
    monkeypatch.setattr(langid, "_drawn", lambda *args: asked.append(args[-1]) or drawn(*args))
    assert corpus_pipeline.known_language(spark, given, "").count() == 200
    assert asked == [None, None, None]
