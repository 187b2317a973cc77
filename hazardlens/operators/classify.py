"""Event typing from text: trained scorer and hook for any batch scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.session import scratch_path

BatchScorer = Callable[[list[str]], tuple[list[str], list[float]]]


def fit_text_classifier(labelled: DataFrame, text: str = "text", label: str = "label",
                        buckets: int = 1 << 14, max_iter: int = 20, path: str | None = None) -> PipelineModel:
    """Logistic regression on hashed term counts, stored below ``path``. ``label`` is numeric.

    The stored model is what is returned: a freshly fitted one carries its training summary, which holds
    on to the session and cannot be sent to executors once the session has observed a metric.
    """
    model = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"\W+"),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=buckets),
        LogisticRegression(featuresCol="__tf", labelCol=label, maxIter=max_iter, predictionCol="predicted",
                           probabilityCol="__prob", rawPredictionCol="__raw"),
    ]).fit(labelled.na.drop(subset=[text, label]))
    path = path or scratch_path(labelled.sparkSession, "text-classifier")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def classify_with_model(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``predicted`` and its probability ``classify_conf``."""
    scored = model.transform(df)
    return scored.withColumn("classify_conf", F.array_max(vector_to_array("__prob")).cast("float")).drop(
        "__words", "__tf", "__prob", "__raw")


def _scorer_function(load_scorer: Callable[[], BatchScorer], max_chars: int | None):
    """Texts (whole, or their first ``max_chars`` characters) to (event_type, classify_conf), batch by batch."""
    @F.pandas_udf("event_type string, classify_conf float")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load_scorer()
        for batch in batches:
            texts = batch.fillna("").str.slice(0, max_chars).tolist()
            labels, confidences = scorer(texts) if texts else ([], [])
            yield pd.DataFrame({"event_type": labels, "classify_conf": pd.Series(confidences, dtype="float32")})

    return classify


def register_scorer(spark: SparkSession, load_scorer: Callable[[], BatchScorer], name: str = "classify_event",
                    max_chars: int | None = None) -> None:
    """Make a batch scorer callable from SQL text as ``name(text) -> struct<event_type, classify_conf>``."""
    spark.udf.register(name, _scorer_function(load_scorer, max_chars))


def classify_with_scorer(df: DataFrame, load_scorer: Callable[[], BatchScorer], text: str = "text",
                         max_chars: int | None = None) -> DataFrame:
    """Run any batch scorer over Arrow batches and add ``event_type`` and ``classify_conf``.

    ``load_scorer`` is called once per task, so a model is loaded once and reused for all its batches. Only the text
    goes to Python: whole, unless the scorer has an input limit (``max_chars``).
    """
    scored = df.withColumn("__scored", _scorer_function(load_scorer, max_chars)(F.col(text)))
    return scored.select(*df.columns, "__scored.event_type", "__scored.classify_conf")
