from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from hazardlens.llm import toxicity
from hazardlens.llm.common import table
from hazardlens.llm.queries import op8_toxicity
from tests.llm.conftest import ODD_ROWS, ODD_SCHEMA


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    rows = op8_toxicity(spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for y, s in held if y], [s for y, s in held if not y]
    wins = np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic])
    assert wins >= 0.93
    assert np.mean([s >= 0.5 for s in toxic]) >= 0.8 and np.mean([s >= 0.5 for s in clean]) <= 0.02


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents of several sentences; toxic ones have one sentence with a bad word."""
    chance, rows, labels = random.Random(3), [], []
    plain = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    for i in range(600):
        sentences = [" ".join(chance.choice(plain) for _ in range(8)) for _ in range(chance.randrange(3, 30))]
        bad = i % 4 == 0
        if bad:
            at = chance.randrange(len(sentences))
            sentences[at] += chance.choice([" vilest", " nastily", " nastiest"])
        rows.append((i, "Fine. " + ". ".join(sentences) + "!"))
        labels.append((i, int(bad)))
    path = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/d")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/l")
    return spark.read.parquet(f"{path}/d"), spark.read.parquet(f"{path}/l")


def test_offending_sentences(planted):
    docs, labels = planted
    model = toxicity.learn(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = toxicity.offending_sentences(docs, model).collect()
    assert {r.doc_id for r in found} == {i for i in texts if i % 4 == 0}
    for r in found:
        assert "vilest" in texts[r.doc_id][r.start:r.end] or "nasti" in texts[r.doc_id][r.start:r.end]
        assert texts[r.doc_id][r.start:r.end].count(".") + texts[r.doc_id][r.start:r.end].count("!") == 1


def test_score_is_the_noisy_or_of_the_sentences(planted):
    docs, labels = planted
    model = toxicity.learn(docs, labels)
    text = "A vilest thing. Nothing here\nNastily nastiest? Wordaa vilest"
    chances = [model.chance(found) for _, _, found in model.sentences(text)]
    assert len(chances) == 3
    assert model.score(text) == pytest.approx(1 - np.prod([1 - c for c in chances]))
    assert [s for _, _, s in model.sentences(text)] == model.bags(text)


def test_odd_rows(stored, planted):
    model = toxicity.learn(*planted)
    docs = stored(ODD_ROWS, ODD_SCHEMA).withColumnRenamed("source", "SCORE")
    scored = toxicity.score(docs, model)
    assert scored.columns[-1] == "score_" and {r.score_ for r in scored.collect()} == {0.0}
    assert toxicity.score(docs.where("doc_id < 0"), model).count() == 0


def test_labels_that_tell_nothing(planted, spark):
    docs, labels = planted
    for useless in (labels.where("toxic = 1"), labels.where("toxic > 5"), spark.createDataFrame([(1, None), (None, 1)], labels.schema)):
        model = toxicity.learn(docs, useless)
        assert model.score("vilest") == 0.0


def test_spans_are_those_of_the_given_text(planted):
    docs, labels = planted
    model = toxicity.learn(docs, labels)
    text = "İİ İstanbul WORDAA. Then a VILEST thing! Wordab"
    scored = toxicity.score(docs.limit(1).selectExpr("1L AS doc_id", f"'{text}' AS text"), model, spans="score").first()
    assert [text[s.start:s.end] for s in scored.score_] == [" Then a VILEST thing!"] and scored.score >= 0.5
    found = toxicity.offending_sentences(docs.limit(1).selectExpr("1L AS doc_id", f"'{text}' AS text"), model).collect()
    assert [(r.start, r.end) for r in found] == [(s.start, s.end) for s in scored.score_]


def test_repeated_ids_do_not_enlarge_the_sample(spark, stored):
    rows = [(1, "vilest text")] * 500 + [(2, f"plain text {i % 3}") for i in range(500)] + [(None, "null id")]
    docs, labels = stored(rows, "doc_id long, text string"), spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1)], "doc_id long, toxic int")
    held = toxicity.sample_of(docs, labels)
    assert sorted((r.text, r.toxic) for r in held.collect()) == [("plain text 0", 0), ("plain text 1", 0), ("plain text 2", 0), ("vilest text", 1)]


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    """One small step of the fit against a plain likelihood, by differences."""
    monkeypatch.setattr(toxicity, "STEPS", 1)
    sentences, sizes = np.array([2, 1, 1]), np.array([1, 2, 1, 1])
    feature_of, toxic, start = np.array([0, 1, 2, 1, 0]), np.array([1, 0, 1]), np.array([0.3, -0.2, 0.1])

    def loss(weights, bias):
        bags = [[[0], [1, 2]], [[1]], [[0]]]
        total = 0.0
        for bag, y in zip(bags, toxic):
            clean = np.prod([1 - 1 / (1 + np.exp(-(bias + sum(weights[f] for f in s)))) for s in bag])
            total -= np.log(1 - clean) if y else np.log(clean)
        return total / 3 + toxicity.DECAY / 2 * (weights ** 2).sum()

    weights, bias = toxicity.fit(sentences, sizes, feature_of, toxic, start)
    for k in range(4):      # the first step of Adam goes against the sign of each derivative
        step = np.eye(4)[k] * 1e-6
        slope = loss(start + step[:3], -4 + step[3]) - loss(start - step[:3], -4 - step[3])
        assert np.sign(np.append(start - weights, -4 - bias)[k]) == np.sign(slope)
