"""Queries for themes and trained scorers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.operators import bayes as B
from hazardlens.operators import classify as C
from hazardlens.operators import enrich as E
from hazardlens.operators import themes as T
from hazardlens.plans.inputs import EVENT_TYPES, STOP_WORDS, Inputs
from hazardlens.plans.registry import query, rounded

_SIZES = ("SELECT cluster_id, count(*) AS events, round(avg(severity), 6) AS avg_severity FROM clustered "
          "GROUP BY cluster_id")
_DOMINANT = ("SELECT cluster_id, event_type AS dominant_event_type, n AS dominant_type_events FROM (SELECT *, row_number() "
             "OVER (PARTITION BY cluster_id ORDER BY n DESC, event_type) AS k FROM (SELECT cluster_id, event_type, "
             "count(*) AS n FROM clustered GROUP BY ALL)) WHERE k = 1")
_TERMS8 = ("SELECT cluster_id, string_agg(token, ', ' ORDER BY rank) AS top_terms FROM cluster_terms WHERE rank <= 8 "
           "GROUP BY cluster_id")


@query("a24_cluster_summary", _SIZES)
def _(i: Inputs) -> DataFrame:
    return rounded(T.cluster_sizes(i.clustered), "avg_severity")


@query("a25_cluster_type_matrix", "SELECT cluster_id, " + ", ".join(
    f"count(*) FILTER (event_type = '{t}') AS \"{t}\"" for t in EVENT_TYPES) + " FROM clustered GROUP BY cluster_id")
def _(i: Inputs) -> DataFrame:
    return T.cluster_type_matrix(i.clustered, EVENT_TYPES)


@query("a26_cluster_token_counts", "SELECT cluster_id, token, n FROM token_counts")
def _(i: Inputs) -> DataFrame:
    return i.token_counts


@query("a27_top_term_lists", _TERMS8)
def _(i: Inputs) -> DataFrame:
    return T.term_lists(i.token_counts, 8)


@query("a27_top_term_lists_10", _TERMS8.replace("rank <= 8", "rank <= 10"))
def _(i: Inputs) -> DataFrame:
    return T.term_lists(i.token_counts, 10)


@query("w01_ranked_terms", "SELECT cluster_id, token, n, rank FROM cluster_terms")
def _(i: Inputs) -> DataFrame:
    return i.cluster_terms


@query("w05_dominant_type", _DOMINANT)
def _(i: Inputs) -> DataFrame:
    return T.dominant_types(i.clustered)


@query("w06_top_8_terms", "SELECT cluster_id, token, n, rank FROM cluster_terms WHERE rank <= 8")
def _(i: Inputs) -> DataFrame:
    return T.top_terms(i.token_counts, 8)


@query("j03_cluster_overview", f", s AS ({_SIZES}), d AS ({_DOMINANT}), t AS ({_TERMS8}) SELECT s.*, "
                               "d.dominant_event_type, d.dominant_type_events, t.top_terms FROM s LEFT JOIN d USING "
                               "(cluster_id) LEFT JOIN t USING (cluster_id)")
def _(i: Inputs) -> DataFrame:
    return rounded(T.cluster_overview(i.clustered, i.token_counts), "avg_severity")


@query("j06_clusters_with_terms", ", t AS (SELECT cluster_id, string_agg(token, ', ' ORDER BY rank) AS top_terms FROM "
                                  "cluster_terms WHERE rank <= 5 GROUP BY cluster_id) SELECT cluster_id, count(event_id) "
                                  "AS event_count, top_terms FROM clustered JOIN t USING (cluster_id) GROUP BY cluster_id, "
                                  "top_terms")
def _(i: Inputs) -> DataFrame:
    return T.clusters_with_terms(i.clustered, i.token_counts)


@query("p24_cluster_samples", "SELECT event_id, source, event_type, severity, title FROM clustered WHERE cluster_id = 3 "
                              "ORDER BY event_id LIMIT 50")
def _(i: Inputs) -> DataFrame:
    return T.cluster_samples(i.clustered, 3)


@query("x05_token_idf", ", m AS (SELECT count(*) AS m FROM docs), f AS (SELECT token, count(DISTINCT doc_id) AS df FROM "
                        "doc_tokens GROUP BY token) SELECT token, df, round(ln((m + 1) / CAST(df + 1 AS DOUBLE)), 6) AS "
                        "idf FROM f, m")
def _(i: Inputs) -> DataFrame:
    return rounded(T.smoothed_idf(i.document_tokens, "doc_id"), "idf")


@query("x05_theme_terms")
def _(i: Inputs) -> DataFrame:
    model = T.fit_themes(i.documents)
    clustered = T.assign_themes(i.documents, model, keep_tokens=True)
    return T.top_terms(T.token_counts(clustered))


@query("x06_theme_assignment")
def _(i: Inputs) -> DataFrame:
    docs = i.documents.select("doc_id", "lang", "doc")
    return T.assign_themes(docs, T.fit_themes(docs))


@query("l07_bernoulli_sample", "SELECT doc_id, lang FROM docs WHERE ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT "
                               "< 2147483648")
def _(i: Inputs) -> DataFrame:
    return T.sampled(i.documents.select("doc_id", "lang"), "doc_id", 0.5)


@query("x05_fit_to_terms_facts", "SELECT count(*) AS documents, 1 AS clusters_in_range, (SELECT CAST(sum(n) AS BIGINT) FROM "
                                 "token_counts) AS counted_tokens, 1 AS ranks_in_range FROM docs")
def _(i: Inputs) -> DataFrame:
    # Fit, assign and rank terms on the same rows; what has to hold whatever clusters come out.
    model = T.fit_themes(i.documents, stop_words=STOP_WORDS)
    clustered = T.assign_themes(i.documents, model, keep_tokens=True).select("doc_id", "cluster_id", "tokens")
    counts = T.token_counts(clustered)
    facts = clustered.agg(
        F.count_distinct("doc_id").alias("documents"),
        F.bool_and(F.col("cluster_id").between(0, T.K - 1)).cast("int").alias("clusters_in_range"))
    ranked = T.top_terms(counts).agg(F.bool_and(F.col("rank").between(1, 10)).cast("int").alias("ranks_in_range"))
    counted = counts.agg(F.sum("n").alias("counted_tokens"))
    one = F.lit(1).alias("one")     # three tables of one row
    return facts.select("*", one).join(counted.select("*", one), "one").join(ranked.select("*", one), "one").drop("one")


@query("x06_assignment_facts", "SELECT doc_id, lang, 1 AS times, true AS same_again FROM docs")
def _(i: Inputs) -> DataFrame:
    # Every document once, and in the same cluster when it is scored again from other partitions.
    docs = i.documents.select("doc_id", "lang", "doc")
    model = T.fit_themes(docs)
    again = T.assign_themes(docs.repartition(3, "doc_id"), model).select("doc_id", F.col("cluster_id").alias("second"))
    both = T.assign_themes(docs, model).join(again, "doc_id")
    return both.groupBy("doc_id", "lang").agg(
        F.count(F.lit(1)).cast("int").alias("times"),
        F.bool_and(F.col("cluster_id") == F.col("second")).alias("same_again"))


@query("x06_nearest_centre_facts", "SELECT doc_id, true AS nearest FROM docs")
def _(i: Inputs) -> DataFrame:
    # For every document: no centre is nearer than the assigned one.
    docs = i.documents.select("doc_id", "lang", "doc")
    return T.centre_distances(docs, T.fit_themes(docs), "doc_id").select(
        "doc_id", (F.col("own") <= F.array_min("distances") + 1e-6).alias("nearest"))


@query("x05_centre_facts", f"SELECT range AS cluster_id, true AS has_members, true AS centre_is_mean FROM range({T.K})")
def _(i: Inputs) -> DataFrame:
    # For every cluster: it has members, and its centre is about their mean.
    docs = i.documents.select("doc_id", "lang", "doc")
    return T.centre_drift(docs, T.fit_themes(docs, max_iter=100)).select(
        F.col("cluster_id").cast("long").alias("cluster_id"), (F.col("members") > 0).alias("has_members"),
        (F.col("drift") <= 0.05 * F.col("spread") + 1e-6).alias("centre_is_mean"))


@query("x03_trained_classifier_facts", "SELECT count(*) AS documents, true AS labels_ok, true AS confidence_ok, true AS "
                                       "learned FROM documents")
def _(i: Inputs) -> DataFrame:
    labels = i.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = i.spread("documents").select("doc_id", "text")
    scored = C.classify_with_model(docs, C.fit_text_classifier(docs.join(labels, "doc_id"))).join(labels, "doc_id", "left")
    right = F.avg(F.when(F.col("label").isNotNull(), (F.col("predicted") == F.col("label")).cast("int")))
    share = F.greatest(F.avg("label"), 1 - F.avg("label"))
    return scored.agg(
        F.count(F.lit(1)).alias("documents"), F.bool_and(F.col("predicted").isin(0.0, 1.0)).alias("labels_ok"),
        F.bool_and(F.col("classify_conf").between(0.5, 1.0)).alias("confidence_ok"), (right >= share).alias("learned"))


@query("x04_classify_event_sql", "SELECT doc_id, CASE WHEN length(text) > 500 THEN 'long' ELSE 'short' END AS event_type, "
                                 "CAST(length(text) / 2048.0 AS FLOAT) AS classify_conf FROM documents")
def _(i: Inputs) -> DataFrame:
    def load():
        def score(texts: list[str]) -> tuple[list[str], list[float]]:
            return ["long" if len(t) > 500 else "short" for t in texts], [len(t) / 2048 for t in texts]
        return score

    C.register_scorer(i.spark, load)
    i.spread("documents").createOrReplaceTempView("hazardlens_documents")
    return i.spark.sql("SELECT doc_id, scored.event_type, scored.classify_conf FROM "
                       "(SELECT doc_id, classify_event(text) AS scored FROM hazardlens_documents)")


@query("x03_trained_classifier")
def _(i: Inputs) -> DataFrame:
    labels = i.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = i.spread("documents").select("doc_id", "text")
    model = C.fit_text_classifier(docs.join(labels, "doc_id"))
    return C.classify_with_model(docs, model).select("doc_id", "predicted", "classify_conf")


def _bayes_sql(given: str, to_classify: str) -> str:
    """Complement naive Bayes in SQL: ``given`` selects (label, t) of labelled rows, ``to_classify`` (key, t) of all."""
    return f"""
    , given AS ({given}), gw AS (SELECT label, unnest(regexp_extract_all(lower(t), '[a-z]{{2,}}')) AS word FROM given),
    label_counts AS (SELECT label, row_number() OVER (ORDER BY label) AS k, count(*) AS n, sum(len(regexp_extract_all(lower(t), '[a-z]{{2,}}'))) AS held
               FROM given GROUP BY label),
    prior AS (SELECT label, k, held, ln((n + 1.0) / (sum(n) OVER () - n + 1.0)) AS prior, sum(held) OVER () AS total,
                     (SELECT count(DISTINCT word) FROM gw) AS size FROM label_counts),
    cells AS (SELECT word, label, count(*) AS n FROM gw GROUP BY ALL), sums AS (SELECT word, sum(n) AS every FROM cells GROUP BY word),
    weights AS (SELECT word, p.label, ln((coalesce(c.n, 0) + 1.0) / (held + size)) - ln((every - coalesce(c.n, 0) + 1.0) / (total - held + size))
                AS weight FROM sums CROSS JOIN prior p LEFT JOIN cells c USING (word, label)),
    asked AS ({to_classify}), aw AS (SELECT key, word, count(*) AS times FROM (SELECT key, unnest(regexp_extract_all(lower(t), '[a-z]{{2,}}'))
              AS word FROM asked) GROUP BY ALL),
    summed AS (SELECT key, label, sum(times * weight) AS s, sum(times)::BIGINT AS known_words FROM aw JOIN weights USING (word) GROUP BY ALL),
    scored_labels AS (SELECT a.key, p.label, k, coalesce(known_words, 0) AS known_words, round(coalesce(s, 0) + prior, 6) AS score, round(prior, 6) AS own
               FROM (SELECT DISTINCT key FROM asked) a CROSS JOIN prior p LEFT JOIN summed u ON u.key = a.key AND u.label = p.label),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN known_words = 0 THEN own ELSE score END DESC, k) AS place,
                      score - lead(score) OVER (PARTITION BY key ORDER BY score DESC, k) AS apart FROM scored_labels),
    labelled AS (SELECT key, label AS event_type, known_words,
                        CASE WHEN known_words = 0 THEN 0.0 ELSE coalesce(apart, 0) / known_words END AS margin FROM ranked WHERE place = 1)"""


_DOC_LABELS = "SELECT quality::VARCHAR || toxic::VARCHAR AS label, text AS t FROM documents JOIN labels USING (doc_id)"


def _document_labels(i: Inputs) -> DataFrame:
    label = F.concat(F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("label")
    return i.spread("documents").join(i.table("labels").select("doc_id", label), "doc_id").select("doc_id", "text", "label")


@query("x03_bayes_documents", _bayes_sql(_DOC_LABELS, "SELECT doc_id AS key, text AS t FROM documents")
       + " SELECT key AS doc_id, event_type, known_words, round(margin, 4) AS margin FROM labelled")
def _(i: Inputs) -> DataFrame:
    # Four labels (quality and toxicity) learned from all labelled documents, told for every document.
    model = B.fit_words(_document_labels(i))
    return rounded(B.classify_words(i.spread("documents"), model, "doc_id"), "margin", places=4)


@query("x03_bayes_events", _bayes_sql(
    "SELECT event_type AS label, coalesce(title, text) AS t FROM typed WHERE source NOT IN ('reliefweb', 'gdelt', 'social')",
    "SELECT event_id AS key, coalesce(title, text) AS t FROM typed WHERE source IN ('reliefweb', 'gdelt', 'social')")
    + " SELECT key AS event_id, event_type, known_words, round(margin, 4) AS margin FROM labelled")
def _(i: Inputs) -> DataFrame:
    # Feeds that come typed teach the types of the free-text feeds.
    free, typed = E.split_by_typing(i.typed.withColumn("said", F.coalesce("title", "text")))
    model = B.fit_words(typed, "said", "event_type")
    return rounded(B.classify_words(free, model, "event_id", "said"), "margin", places=4)


_FOLD = "('0x' || substr(md5('fold:' || doc_id), 1, 8))::BIGINT % 4 = 0"


@query("x03_bayes_held_out", _bayes_sql(_DOC_LABELS.replace("quality::VARCHAR || toxic::VARCHAR", "quality::VARCHAR") + f" WHERE NOT {_FOLD}",
                                        f"SELECT doc_id AS key, text AS t FROM documents JOIN labels USING (doc_id) WHERE {_FOLD}")
       + " SELECT count(*) AS documents, count(*) FILTER (event_type = quality::VARCHAR) AS correct, greatest(count(*) FILTER (quality = 1), "
         "count(*) FILTER (quality = 0)) AS majority FROM labelled JOIN labels ON doc_id = key")
def _(i: Inputs) -> DataFrame:
    # Correct labels in a quarter of the documents that was not learned from, beside always saying the more frequent label.
    rows = _document_labels(i).withColumn("label", F.substring("label", 1, 1))
    held = F.conv(F.substring(F.md5(F.concat(F.lit("fold:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long") % 4 == 0
    told = B.classify_words(rows.where(held), B.fit_words(rows.where(~held)), "doc_id").join(rows.select("doc_id", "label"), "doc_id")
    of = lambda label: F.count(F.when(F.col("label") == label, 1))
    return told.agg(F.count(F.lit(1)).alias("documents"), F.count(F.when(F.col("event_type") == F.col("label"), 1)).alias("correct"),
                    F.greatest(of("0"), of("1")).alias("majority"))


@query("x03_batch_scorer_hook", "SELECT doc_id, CASE WHEN length(text) > 500 THEN 'long' ELSE 'short' "
                                "END AS event_type, CAST(length(text) / 2048.0 AS FLOAT) AS "
                                "classify_conf FROM documents")
def _(i: Inputs) -> DataFrame:
    def load():
        # Defined inside so that workers need no import of this package.
        def score(texts: list[str]) -> tuple[list[str], list[float]]:
            return ["long" if len(t) > 500 else "short" for t in texts], [len(t) / 2048 for t in texts]
        return score

    docs = i.spread("documents").select("doc_id", "text")
    return C.classify_with_scorer(docs, load).drop("text")
