"""Text themes: TF-IDF + K-means, term ranking and cluster reports."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlens.functions.text import clean_document, joined_text
from hazardlens.session import checkpointed

K = 12
HASH_BUCKETS = 1 << 14
MIN_DOC_CHARS = 20


class TooFewDocuments(ValueError):
    pass


def theme_documents(df: DataFrame, *columns: str) -> DataFrame:
    """Add ``doc``, the cleaned text of ``columns``; rows with at most 20 characters are left out.

    Cleaning replaces characters one for one, so the length is tested on the raw text: the test reaches
    the scan without running the replacement twice.
    """
    parts = [F.col(c) for c in (columns or ("title", "text"))]
    return df.where(F.length(joined_text(*parts)) > MIN_DOC_CHARS).withColumn("doc", clean_document(*parts))


def sampled(docs: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample: each row is kept with probability ``fraction``, decided by a digest of its key. The same
    rows come out of every run, retry and cluster."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return docs.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(fraction * (1 << 32)))


def fit_themes(docs: DataFrame, k: int = K, buckets: int = HASH_BUCKETS, max_iter: int = 20, seed: int = 42,
               stop_words: list[str] | None = None) -> PipelineModel:
    """Tokens -> stop words -> hashed term counts -> IDF -> K-means, fitted on all of ``docs``.

    The term counts are stored once, so weights and clustering rounds read them and the texts are taken apart once. A caller
    who wants a cheaper fit hands in a sample (:func:`sampled`).
    """
    remover = StopWordsRemover(inputCol="words", outputCol="tokens")
    if stop_words is not None:
        remover.setStopWords(stop_words)
    terms = Pipeline(stages=[
        Tokenizer(inputCol="doc", outputCol="words"), remover, HashingTF(inputCol="tokens", outputCol="tf", numFeatures=buckets),
    ]).fit(docs)
    counted = checkpointed(terms.transform(docs).select("tf"))
    n = counted.count()
    if n < k:
        raise TooFewDocuments(f"{n} documents for {k} clusters")
    weights = IDF(inputCol="tf", outputCol="features").fit(counted)
    features = weights.transform(counted).select("features")
    clusters = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster_id").fit(features)
    return PipelineModel([*terms.stages, weights, clusters])


def assign_themes(docs: DataFrame, model: PipelineModel, keep_tokens: bool = False) -> DataFrame:
    """Every document with its ``cluster_id``; the working columns are dropped."""
    dropped = ["doc", "words", "tf", "features"] + ([] if keep_tokens else ["tokens"])
    return model.transform(docs).drop(*dropped)


def _centres(model: PipelineModel) -> DataFrame:
    """``cluster_id, place, value``: the coordinates of all centres that are not zero."""
    spark = SparkSession.active()
    rows = [(k, int(j), float(c[j])) for k, c in enumerate(model.stages[-1].clusterCenters()) for j in c.nonzero()[0]]
    return spark.createDataFrame(rows, "cluster_id int, place int, value double")


def _coordinates(scored: DataFrame, *keys: str) -> DataFrame:
    """``keys, place, value`` of each row's features. Vectors open up in Python only; a row is a list of a text's words."""
    @F.udf("array<struct<place:int,value:double>>", useArrow=False)
    def opened(vector):
        places = vector.indices if hasattr(vector, "indices") else range(len(vector))
        return [(int(k), float(x)) for k, x in zip(places, vector.values if hasattr(vector, "indices") else vector) if x]

    return scored.select(*keys, F.explode(opened("features")).alias("x")).select(*keys, "x.*")


def centre_distances(docs: DataFrame, model: PipelineModel, key: str) -> DataFrame:
    """``key, cluster_id, own, distances``: squared distances of each document to its own and to all centres.

    Squares are added per shared coordinate: |x|^2 - 2 x.c + |c|^2, so the dense centres meet only the words that a document
    has."""
    scored = checkpointed(model.transform(docs).select(key, "cluster_id", "features"))
    centres = _centres(model)
    norms = {r.cluster_id: r.n for r in centres.groupBy("cluster_id").agg(F.sum(F.col("value") ** 2).alias("n")).collect()}
    k = len(model.stages[-1].clusterCenters())
    by_place = centres.groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("cluster_id", "value"))).alias("at"))
    dots = _coordinates(scored, key).join(by_place, "place", "left").groupBy(key).agg(
        F.sum(F.col("value") ** 2).alias("length"), *[F.coalesce(F.sum(F.col("value") * F.col("at")[c]), F.lit(0.0)).alias(f"d{c}") for c in range(k)])
    distances = F.array(*[F.coalesce("length", F.lit(0.0)) - 2 * F.coalesce(f"d{c}", F.lit(0.0)) + norms.get(c, 0.0) for c in range(k)])
    return scored.select(key, "cluster_id").join(dots, key, "left").select(
        key, "cluster_id", F.element_at(distances, F.col("cluster_id") + 1).alias("own"), distances.alias("distances"))


def centre_drift(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """``cluster_id, members, drift, spread``: how far each centre is from the mean of its members, beside their root mean
    square distance from that mean. One row per centre, also without members."""
    scored = checkpointed(model.transform(docs).select("cluster_id", "features"))
    members = scored.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("members"))
    sums = _coordinates(scored, "cluster_id").groupBy("cluster_id", "place").agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q"))
    both = sums.join(members, "cluster_id").join(_centres(model), ["cluster_id", "place"], "full")
    mean = F.coalesce(F.col("s") / F.col("members"), F.lit(0.0))
    found = both.groupBy("cluster_id").agg(
        F.sqrt(F.sum((mean - F.coalesce("value", F.lit(0.0))) ** 2)).alias("drift"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(F.coalesce(F.col("q") / F.col("members"), F.lit(0.0)) - mean ** 2))).alias("spread"))
    every = SparkSession.active().range(len(model.stages[-1].clusterCenters())).select(F.col("id").cast("int").alias("cluster_id"))
    return every.join(members, "cluster_id", "left").join(found, "cluster_id", "left").select(
        "cluster_id", F.coalesce("members", F.lit(0)).alias("members"), F.coalesce("drift", F.lit(0.0)).alias("drift"),
        F.coalesce("spread", F.lit(0.0)).alias("spread"))


def theme_tokens(docs: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """``tokens`` as native expressions, equal to the Tokenizer and StopWordsRemover stages."""
    stop = stop_words if stop_words is not None else StopWordsRemover.loadDefaultStopWords("english")
    tokens = F.split("doc", r"\s")  # doc is lower case already
    if stop:
        tokens = F.filter(tokens, lambda t: ~t.isin(stop))
    return docs.withColumn("tokens", tokens)


def smoothed_idf(docs_with_tokens: DataFrame, doc_key: str) -> DataFrame:
    """Token-level ln((m + 1) / (df + 1)), the weight IDF gives a hash bucket holding one token."""
    m = docs_with_tokens.agg(F.count(F.lit(1))).scalar()
    words = docs_with_tokens.select(doc_key, F.explode_outer(F.array_distinct("tokens")).alias("token"))
    df = words.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return df.withColumn("idf", F.log((m + 1) / (F.col("df") + 1)))


def token_counts(clustered: DataFrame, min_length: int = 3, stop_words: list[str] | None = None) -> DataFrame:
    """Occurrences per cluster and token of at least ``min_length`` characters.

    Counts the ``tokens`` column; without one, ``doc`` is split here and ``stop_words`` are left out.
    """
    tokens = F.col("tokens") if "tokens" in clustered.columns else F.split("doc", r"\s")
    exploded = clustered.select("cluster_id", F.explode_outer(tokens).alias("token"))
    kept = exploded.where(F.length("token") >= min_length)
    if stop_words:
        kept = kept.where(~F.col("token").isin(stop_words))
    return kept.groupBy("cluster_id", "token").agg(F.count(F.lit(1)).alias("n"))


def _by_count() -> list[Column]:
    return [F.col("n").desc(), F.col("token")]


def top_terms(counts: DataFrame, n: int = 10) -> DataFrame:
    """Ranked terms per cluster. Map tasks keep only ``n`` candidates each (WindowGroupLimit), so a
    cluster's whole vocabulary never meets in one task."""
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(*_by_count()))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def term_lists(counts: DataFrame, n: int = 8, out: str = "top_terms") -> DataFrame:
    """The ``n`` best terms of each cluster as one comma-separated string in rank order."""
    terms = F.array_sort(F.collect_list(F.struct("rank", "token")))
    joined = F.array_join(F.transform(terms, lambda t: t["token"]), ", ")
    return top_terms(counts, n).groupBy("cluster_id").agg(joined.alias(out))


def cluster_sizes(events: DataFrame) -> DataFrame:
    return events.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("events"), F.avg(F.coalesce("severity", F.lit(0.0))).alias("avg_severity"))


def _typed(events: DataFrame) -> DataFrame:
    return events.withColumn("event_type", F.coalesce("event_type", F.lit("unknown")))


def dominant_types(events: DataFrame) -> DataFrame:
    """Most frequent type per cluster; the alphabetically first wins a tie."""
    counts = _typed(events).groupBy("cluster_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.col("n").desc(), "event_type"))
    return counts.withColumn("rank", rank).where("rank = 1").select(
        "cluster_id", F.col("event_type").alias("dominant_event_type"), F.col("n").alias("dominant_type_events"))


def cluster_type_matrix(events: DataFrame, types: list[str]) -> DataFrame:
    return _typed(events).groupBy("cluster_id").pivot("event_type", types).count().na.fill(0)


def cluster_overview(events: DataFrame, counts: DataFrame) -> DataFrame:
    """Size, mean severity, dominant type and top terms per cluster. All inputs are one row per cluster."""
    return (cluster_sizes(events).join(dominant_types(events), "cluster_id", "left")
            .join(term_lists(counts), "cluster_id", "left"))


def clusters_with_terms(events: DataFrame, terms: DataFrame, n: int = 5) -> DataFrame:
    """Events per cluster next to its ``n`` best terms; clusters without terms are left out."""
    counted = events.groupBy("cluster_id").agg(F.count("event_id").alias("event_count"))
    return counted.join(term_lists(terms, n), "cluster_id")


def cluster_samples(events: DataFrame, cluster_id: int, n: int = 50) -> DataFrame:
    return (events.where(F.col("cluster_id") == cluster_id)
            .select("event_id", "source", "event_type", "severity", "title").orderBy("event_id").limit(n))
