"""Names of several words and the counting classifier, against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardlens.operators import bayes, names

WORD = re.compile(r"[^\W][\w'\-]*")


def plain_names(texts, gazetteer):
    known = {" ".join(w.lower() for w in WORD.findall(n)): p for n, p in reversed(gazetteer) if n and WORD.findall(n)}
    longest = max((len(n.split()) for n in known), default=0)
    out = []
    for key, text in texts:
        said, at = WORD.findall(text or ""), 0
        while at < len(said):
            for n in range(min(longest, len(said) - at), 0, -1):
                name = " ".join(w.lower() for w in said[at:at + n])
                if said[at][0] != said[at][0].lower() and name in known:
                    out.append((key, at, n, name, known[name]))
                    at += n - 1
                    break
            at += 1
    return sorted(out)


GAZETTEER = [("New York", 1), ("New York City", 2), ("York", 3), ("Rio de Janeiro", 4), ("San José del Cabo", 5), ("City Hall", 6), ("new york", 7),
             ("", 8), (None, 9), ("!!", 10), ("San", 11), ("Stratford-upon-Avon", 12), ("A B C D", 13), ("B C", 14)]
TEXTS = ["New York City Hall in York", "new york. New york!", "From Rio de Janeiro to San José del Cabo, San José", "A B C D A B C A B", "", None,
         "Stratford-upon-Avon", "New New York York City", "x " * 5000 + "San"]


@pytest.mark.parametrize("limit", [100, 0])
def test_names(spark, limit):
    chance = random.Random(1)
    vocabulary = ["New", "York", "City", "Hall", "San", "de", "A", "B", "C", "D"]
    texts = list(enumerate([*TEXTS, *(" ".join(chance.choices(vocabulary, k=12)) for _ in range(60))]))
    gazetteer = spark.createDataFrame(GAZETTEER, "name string, place int")
    trie = names.build_trie(gazetteer, "name", F.struct("place"), [F.col("place")], limit)
    assert trie.small == (limit > 0) and trie.longest == 4
    found = names.find_names(spark.createDataFrame(texts, "doc int, text string"), trie, "doc")
    assert sorted((r.doc, r.pos, r.words, r.name, r.place.place) for r in found.collect()) == plain_names(texts, GAZETTEER)


def test_country_before_town(spark):
    countries = spark.createDataFrame([("costa rica", "CR"), ("san marino", "SM")], "key string, code string")
    cities = spark.createDataFrame([("san", 1.0, 2.0, "X"), ("costa", 3.0, 4.0, "Y"), ("san marino", 5.0, 6.0, "Z")],
                                   "key string, latitude double, longitude double, countrycode string")
    texts = spark.createDataFrame([(1, "San and Costa Rica"), (2, "Costa, San"), (3, "San Marino"), (4, "none")], "id int, text string")
    got = {r.id: tuple(r)[1:] for r in names.resolve_long_names(texts, countries, cities, "id").collect()}
    assert got == {1: (None, None, "CR"), 2: (3.0, 4.0, "Y"), 3: (None, None, "SM")}


def test_empty_gazetteer(spark):
    none = spark.createDataFrame([], "name string, place int")
    trie = names.build_trie(none, "name", F.struct("place"), [F.col("place")])
    assert names.find_names(spark.createDataFrame([(1, "New York")], "id int, text string"), trie, "id").count() == 0


def plain_bayes(rows, asked):
    words = {label: Counter() for label, _ in rows if label is not None}
    count = Counter(label for label, _ in rows if label is not None)
    for label, text in rows:
        if label is not None:
            words[label].update(re.findall("[a-z]{2,}", (text or "").lower()))
    every = sum(words.values(), Counter())
    held, total, size = {k: sum(c.values()) for k, c in words.items()}, sum(every.values()), len(every)
    out = {}
    for key, text in asked:
        said = [w for w in re.findall("[a-z]{2,}", (text or "").lower()) if w in every]
        scores = []
        for label in sorted(words):
            prior = math.log((count[label] + 1) / (sum(count.values()) - count[label] + 1))
            inside = sum(math.log((words[label][w] + 1) / (held[label] + size))
                         - math.log((every[w] - words[label][w] + 1) / (total - held[label] + size)) for w in said)
            scores.append((-round(inside + prior, 6), label))
        out[key] = (min(scores)[1], len(said))
    return out


def test_labels_by_counting(spark):
    chance = random.Random(2)
    vocabulary = {"flood": ["water", "river", "rain", "dam"], "fire": ["smoke", "heat", "burn", "dam"], "quake": ["shake", "magnitude", "dam"]}
    def text(label):
        return " ".join(chance.choices(vocabulary[label] + ["the", "near", "Area"], k=chance.randint(0, 9)))
    rows = [(label, text(label)) for label in chance.choices(list(vocabulary), k=200)] + [(None, "water"), ("fire", None)]
    asked = [(k, text(label)) for k, label in enumerate(chance.choices(list(vocabulary), k=100))] + [(500, None), (501, ""), (502, "unseen WORDS")]
    for limit in (10**6, 0):
        model = bayes.fit_words(spark.createDataFrame(rows, "label string, text string"))
        model = bayes.WordModel(model.labels, model.prior, model.weights, limit > 0)
        got = bayes.classify_words(spark.createDataFrame(asked, "id int, text string"), model, "id").collect()
        assert {r.id: (r.event_type, r.known_words) for r in got} == plain_bayes(rows, asked)
        assert all(r.margin >= 0 for r in got) and sum(r.margin > 0 for r in got) > 80


def test_one_label_and_none(spark):
    model = bayes.fit_words(spark.createDataFrame([("a", "x yy"), ("a", None)], "label string, text string"))
    got = bayes.classify_words(spark.createDataFrame([(1, "yy"), (1, "zz"), (None, "yy")], "id int, text string"), model, "id").collect()
    assert sorted((str(r.id), r.event_type, r.margin) for r in got) == [("1", "a", 0.0), ("None", "a", 0.0)]
    with pytest.raises(ValueError, match="labels"):
        bayes.fit_words(spark.createDataFrame([(None, "x")], "label string, text string"))


def test_frequent_words_are_not_shuffled(spark, monkeypatch):
    chance = random.Random(5)
    rows = [(k % 37 if k % 19 else None, " ".join(chance.choice(["calm", "storm", "flood", "x" + "abcdefgh"[chance.randint(0, 7)] * 3,
             "odd" + "abcdefgh"[k % 8] + "ab"[k % 2] + "z" * (k // 8)]) for _ in range(30)), "ab"[k % 2]) for k in range(120)]
    texts = spark.createDataFrame(rows, "id int, text string, label string")
    whole = bayes.classify_words(texts, bayes.fit_words(texts), "id")
    monkeypatch.setattr(bayes, "BROADCAST_WEIGHTS", 12)
    model = bayes.fit_words(texts)
    assert not model.small and 0 < model.weights.where(F.col("every") >= model.sent_from).count() <= 6
    told = lambda found: sorted((str(r.id), r.event_type, round(r.margin, 4), r.known_words) for r in found.collect())
    assert told(bayes.classify_words(texts, model, "id")) == told(whole)
    plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("limit", [100, 0])
def test_words_do_not_carry_their_text(spark, limit):
    trie = names.build_trie(spark.createDataFrame(GAZETTEER, "name string, place int"), "name", F.struct("place"), [F.col("place")], limit)
    found = names.find_names(spark.createDataFrame(list(enumerate(TEXTS)), "doc int, text string"), trie, "doc")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and not re.search(r"Generate \w+\(said#", plan) and "collect_list" not in plan


def test_names_of_one_text_go_on_over_batches():
    rows = [(1, 0, 2), (1, 1, 3), (1, 2, 1), (2, 0, 1), (2, 0, 1), (3, 5, 2), (3, 6, 1), (3, 7, 1)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("key", "pos", "words"), r)) for r in rows])
    for size in (1, 2, 3, 8):
        cut = [batch.slice(k, size) for k in range(0, len(rows), size)]
        got = [tuple(r.values()) for part in names._kept(iter(cut)) for r in part.to_pylist()]
        assert got == [(1, 0, 2), (1, 2, 1), (2, 0, 1), (3, 5, 2), (3, 7, 1)]
