"""Defect classifier with Spark ML: features, training, scoring, evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import constants as K
from millrace.functions.columns import number
from millrace.operators.evaluate import classification_report
from millrace.operators.shards import SHARD
from millrace.plans import boosting
from millrace.plans.boosting import Booster
from millrace.sources.layers import DAY

# Columns that are never features: texts, the target, and keys of the layout.
NOT_FEATURES = (
    *K.TEXT_COLUMNS,
    "timestamp",
    K.LABEL,
    "line_id",
    "event_id",
    "t_us",
    "idx",
    DAY,
    SHARD,
    "is_test",
)


def feature_names(df: DataFrame, exclude: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def feature_matrix(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Feature columns as doubles without gaps; other columns unchanged."""
    features = features or feature_names(df)
    chosen = set(features)
    return df.selectExpr(
        *[
            f"coalesce({number(c)}, 0D) AS `{c}`" if c in chosen else f"`{c}`"
            for c in df.columns
        ]
    )


def classifier(kind: str = "forest", seed: int = K.SPLIT_SEED):
    """``forest`` has class probabilities; ``boosted`` is one-against-rest.

    Spark ML has no boosted trees for more than two classes; ``train`` has them as
    ``softmax``, from :mod:`millrace.plans.boosting`. Depth, rate and tree count are
    the same for all.
    """
    if kind == "forest":
        return RandomForestClassifier(
            labelCol=K.LABEL, numTrees=K.TREES, maxDepth=K.TREE_DEPTH, seed=seed
        )
    if kind == "boosted":
        one = GBTClassifier(
            labelCol=K.LABEL,
            maxIter=K.TREES,
            maxDepth=K.TREE_DEPTH,
            stepSize=K.LEARNING_RATE,
            seed=seed,
        )
        return OneVsRest(classifier=one, labelCol=K.LABEL)
    raise ValueError(f"unknown classifier: {kind}")


def train(
    df: DataFrame, kind: str = "forest", features: list[str] | None = None, estimator=None
) -> PipelineModel | Booster:
    """Fit on the rows given. The assembler stage keeps the feature names.

    ``softmax`` gives a :class:`Booster`, the other kinds an ML pipeline."""
    features = features or feature_names(df)
    if kind == "softmax":
        return boosting.fit(df, K.LABEL, features, estimator or boosting.Settings())
    assembler = VectorAssembler(
        inputCols=features, outputCol="features", handleInvalid="error"
    )
    pipeline = Pipeline(stages=[assembler, estimator or classifier(kind)])
    return pipeline.fit(feature_matrix(df, features))


def model_features(model: PipelineModel | Booster) -> list[str]:
    if isinstance(model, Booster):
        return model.features
    return model.stages[0].getInputCols()


def score(model: PipelineModel | Booster, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``probabilities``, one for each class.

    One-against-rest models have a score for each class; their probabilities are the
    binary models' ones, made to add up to 1. The class is the likeliest.
    """
    if isinstance(model, Booster):
        return model.score(df)
    scored = model.transform(feature_matrix(df, model_features(model)))
    scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
    if "probability" in scored.columns:
        scored = scored.withColumn("probabilities", vector_to_array("probability"))
    else:
        # The boosted trees' probability of a score s is 1 / (1 + exp(-2 s)).
        raw = F.transform(vector_to_array("rawPrediction"), lambda s: 1 / (1 + F.exp(-2 * s)))
        total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
        scored = scored.withColumn("probabilities", raw)
        scored = scored.withColumn("probabilities", F.transform("probabilities", lambda p: p / total))
    return scored.drop("features", "rawPrediction", "probability")


def save(model: PipelineModel | Booster, path: str) -> None:
    """A pipeline is read again by ``load``, a booster by ``Booster.load``."""
    if isinstance(model, Booster):
        return model.save(SparkSession.active(), path)
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def report(model: PipelineModel | Booster, df: DataFrame) -> DataFrame:
    return classification_report(score(model, df), K.LABEL, "prediction")
