"""Theme model, native tokens and rankings."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from hazardlens.operators import classify as C
from hazardlens.operators import keywords as KW
from hazardlens.operators import themes as T


@pytest.fixture(scope="module")
def planted(spark):
    topics = [("flood river water dam levee rising", 0), ("quake tremor fault seismic magnitude rupture", 1),
              ("fire smoke burning forest acres containment", 2)]
    rows = [(k, f"{t} {t.split()[k % 6]} The {k}!", None, g) for g, (t, _) in enumerate(topics) for k in range(40)]
    return spark.createDataFrame(rows, "id int, title string, text string, topic int")


def test_documents_clean_and_filter(spark):
    df = spark.createDataFrame([("Abc-9 É", "x"), ("A" * 15, "b" * 15), (None, None), ("é" * 21, None)],
                               "title string, text string")
    docs = {r.doc for r in T.theme_documents(df).collect()}
    assert docs == {"a" * 15 + " " + "b" * 15, " " * 21 + " "}


def test_native_tokens_equal_model_stages(inputs):
    docs = inputs.documents
    native = T.theme_tokens(docs).select("doc_id", "tokens")
    words = Tokenizer(inputCol="doc", outputCol="words").transform(docs)
    stages = StopWordsRemover(inputCol="words", outputCol="tokens").transform(words).select("doc_id", "tokens")
    # The model's splitter drops trailing empty strings; they never count as tokens.
    clean = F.filter("tokens", lambda t: t != "")
    joined = native.select("doc_id", clean.alias("a")).join(stages.select("doc_id", clean.alias("b")), "doc_id")
    assert joined.where(F.col("a") != F.col("b")).count() == 0 and joined.count() == docs.count()


def test_themes_separate_planted_topics(planted):
    docs = T.theme_documents(planted)
    model = T.fit_themes(docs, k=3, buckets=1 << 10)
    clustered = T.assign_themes(docs, model)
    assert set(clustered.columns) == {"id", "title", "text", "topic", "cluster_id"}
    groups = clustered.groupBy("topic").agg(F.count_distinct("cluster_id").alias("n")).collect()
    assert [g.n for g in groups] == [1, 1, 1] and clustered.select("cluster_id").distinct().count() == 3
    with pytest.raises(T.TooFewDocuments):
        T.fit_themes(docs.limit(2), k=3)


def test_sample_size(planted):
    assert T.sampled(planted, "title", 1.0).count() == 120
    numbered = planted.sparkSession.range(1000)
    half = T.sampled(numbered, "id", 0.5)
    assert 420 < half.count() < 580 and half.orderBy("id").collect() == T.sampled(numbered.repartition(3), "id", 0.5).orderBy("id").collect()


def test_ranking_breaks_ties_by_token_and_limits_early(spark):
    counts = spark.createDataFrame([(0, w, n) for w, n in [("b", 2), ("a", 2), ("c", 5), ("d", 1)]] + [(1, "z", 1)],
                                   "cluster_id int, token string, n bigint")
    top = T.top_terms(counts, 3)
    assert [(r.token, r["rank"]) for r in top.where("cluster_id = 0").orderBy("rank").collect()] == [("c", 1), ("a", 2), ("b", 3)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    lists = {r.cluster_id: r.top_terms for r in T.term_lists(counts, 3).collect()}
    assert lists == {0: "c, a, b", 1: "z"}


def test_dominant_type_tie(spark):
    rows = [(0, "b", 0.1), (0, "a", 0.3), (1, None, None)]
    df = spark.createDataFrame(rows, "cluster_id int, event_type string, severity float")
    assert {r.cluster_id: r.dominant_event_type for r in T.dominant_types(df).collect()} == {0: "a", 1: "unknown"}
    sizes = {r.cluster_id: round(r.avg_severity, 3) for r in T.cluster_sizes(df).collect()}
    assert sizes == {0: 0.2, 1: 0.0}


def test_keyword_frequency_counts_documents_once(spark):
    rows = [("2024", "PH", "Flood flood FLOOD aid"), ("2024", "PH", "flood-hit aid-worker"), ("2024", "", "flood"),
            ("2023", "UNK", "floods quake")]
    lines = spark.createDataFrame(rows, "year string, country string, text string")
    got = {(r.year, r.country, r.term): r["count"] for r in KW.keyword_frequency(lines).collect()}
    assert got == {("2024", "PH", "flood"): 1, ("2024", "PH", "aid"): 1, ("2023", "UNK", "quake"): 1}
    lexicon = spark.createDataFrame([("flood",), ("aid",), ("quake",)], "term string")
    by_table = {(r.year, r.country, r.term): r["count"] for r in
                KW.keyword_frequency_by_table(lines.where("country <> ''"), lexicon).collect()}
    assert by_table == got


def test_trained_and_hooked_scorers(spark, planted):
    model = C.fit_text_classifier(planted.select("id", F.col("title").alias("text"), F.col("topic").cast("double").alias("label")))
    scored = C.classify_with_model(planted.select("id", "topic", F.col("title").alias("text")), model)
    assert scored.where(F.col("predicted") == F.col("topic")).count() == 120

    def load():
        return lambda texts: (["x" if "quake" in t else "y" for t in texts], [float(len(t)) for t in texts])

    C.register_scorer(spark, load)
    assert spark.sql("SELECT classify_event('quake').event_type AS t").first().t == "x"
    hooked = C.classify_with_scorer(spark.createDataFrame([("quake",), (None,), ("a" * 2000,)], "text string"), load)
    assert sorted((r.event_type, r.classify_conf) for r in hooked.collect()) == [("x", 5.0), ("y", 0.0), ("y", 2000.0)]
    cut = C.classify_with_scorer(spark.createDataFrame([("a" * 2000,)], "text string"), load, max_chars=1500)
    assert cut.first().classify_conf == 1500.0


def test_fit_takes_texts_apart_once(spark, folder):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = spark.createDataFrame([(k, f"words {'abc'[k % 3] * 4} of a text") for k in range(30)], "doc_id int, doc string")
    watched = docs.withColumn("doc", F.udf(seen, useArrow=False)("doc"))
    assert T.fit_themes(watched, k=3, buckets=1 << 10).stages[-1].summary.k == 3
    assert read.value == 30
