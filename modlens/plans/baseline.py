"""Trainable baseline: tf-idf features and one logistic regression per label, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modlens.functions import text as tx
from modlens.functions.scores import PRED


def _with_terms(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_words", tx.tokens(F.col(text))).withColumn(
        "_terms", tx.unigrams_and_bigrams(F.col("_words"))
    )


@dataclass
class BaselineModel:
    """Fitted features and one classifier per label."""

    features: PipelineModel
    classifiers: dict[str, LogisticRegressionModel]
    text: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``pred_<label>`` probabilities."""
        kept = list(df.columns)
        out = self.features.transform(_with_terms(df, self.text))
        for label, model in self.classifiers.items():
            scored = model.transform(out)
            out = scored.withColumn(PRED[label], vector_to_array("_prob")[1]).drop("_raw", "_prob", "_class")
        return out.select(*kept, *[PRED[x] for x in self.classifiers])


def held_out(key: str, sixteenths: int = 4) -> Column:
    """Whether a row is kept from training: its key's SHA-256 begins with one of the first ``sixteenths`` hex digits."""
    return F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 1).isin(*"0123456789abcdef"[:sixteenths])


def fit_baseline(
    train: DataFrame,
    labels: Sequence[str],
    text: str = "text_clean",
    n_features: int = 1 << 16,
    min_df: int = 3,
    max_iter: int = 20,
    reg: float = 0.01,
) -> BaselineModel:
    """Fit on rows with 0/1 label columns.

    Terms are hashed, so no vocabulary is gathered on the driver; what an iteration
    sends there is one vector of ``n_features`` doubles, summed in a tree.
    """
    # cut into terms once, for the document frequencies and for the features
    rows = _with_terms(train.select(F.col(text), *labels), text).select("_terms", *labels).persist(StorageLevel.MEMORY_AND_DISK)
    features = Pipeline(
        stages=[
            HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=n_features),
            IDF(inputCol="_tf", outputCol="_features", minDocFreq=min_df),
        ]
    ).fit(rows)
    # iterations reread the features: keep them, spilling to disk, and release them at the end
    ready = features.transform(rows).select("_features", *[F.col(x).cast("double").alias(x) for x in labels])
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classifiers = {
            x: LogisticRegression(
                featuresCol="_features", labelCol=x, family="binomial", maxIter=max_iter, regParam=reg,
                rawPredictionCol="_raw", probabilityCol="_prob", predictionCol="_class",
            ).fit(ready)
            for x in labels
        }
    finally:
        ready.unpersist()
        rows.unpersist()
    return BaselineModel(features, classifiers, text)
