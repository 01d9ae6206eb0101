"""Training, storing and scoring with small models."""

import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.sql import functions as F

from millrace import constants as K
from millrace.operators import evaluate
from millrace.plans import training


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).select(
        F.col("id").alias("event_id"),
        F.lit("x").alias(K.DESCRIPTION),
        (F.col("id") % 3).cast("int").alias(K.LABEL),
        F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") % 3) * 10.0).alias("a"),
        F.rand(1).cast("string").alias("b"),
    )


def test_feature_choice(rows):
    assert training.feature_names(rows) == ["a", "b"]
    matrix = training.feature_matrix(rows)
    assert dict(matrix.dtypes)["b"] == "double"
    assert matrix.where("a IS NULL").count() == 0


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_fit_store_score(spark, rows, tmp_path, kind):
    small = {
        "forest": RandomForestClassifier(labelCol=K.LABEL, numTrees=3, seed=1),
        "boosted": OneVsRest(
            classifier=GBTClassifier(labelCol=K.LABEL, maxIter=2, maxDepth=2), labelCol=K.LABEL
        ),
    }[kind]
    model = training.train(rows, estimator=small)
    training.save(model, str(tmp_path / "m"))
    loaded = training.load(str(tmp_path / "m"))
    assert training.model_features(loaded) == ["a", "b"]
    scored = training.score(loaded, rows)
    for row in scored.collect():
        assert len(row.probabilities) == 3 and abs(sum(row.probabilities) - 1) < 1e-9
        assert row.probabilities[row.prediction] == max(row.probabilities)
    report = {r.class_name: r.f1 for r in training.report(loaded, rows).collect()}
    assert report["accuracy"] > 0.95


def test_defaults():
    assert training.classifier("forest").getNumTrees() == K.TREES
    assert training.classifier("boosted").getClassifier().getStepSize() == K.LEARNING_RATE
    with pytest.raises(ValueError):
        training.classifier("other")


def test_split_keeps_rows_without_a_key(spark):
    rows = [(k if k % 10 else None, k % 3) for k in range(1000)]
    df = spark.createDataFrame(rows, "event_id long, defect_label int")
    got = evaluate.stratified_split(df).collect()
    assert len(got) == 1000
    for label in range(3):
        own = [r.is_test for r in got if r.defect_label == label]
        assert sum(own) == round(0.2 * len(own))


def test_split_ranks_keys_and_reads_wide_rows_once(spark, tmp_path):
    rows = [(k, k % 3, float(k)) for k in range(900)]
    spark.createDataFrame(rows, "event_id long, defect_label int, x double").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    split = evaluate.stratified_split(df)
    got = {r.event_id: r.is_test for r in split.collect()}
    order = lambda k: ((k % evaluate.PRIME * evaluate.FACTOR + K.SPLIT_SEED) % evaluate.PRIME, k)
    for label in range(3):
        first = sorted(range(label, 900, 3), key=order)[:60]
        assert sorted(k for k in range(label, 900, 3) if got[k]) == sorted(first)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet [event_id") == 1 and "Window" not in plan
    # Repeated keys: the cut falls among rows of one key, which are then told apart.
    again = df.unionByName(df).unionByName(df).where("event_id < 30")
    got = evaluate.stratified_split(again, test_share=0.5).collect()
    for label in range(3):
        own = [r.is_test for r in got if r.defect_label == label]
        assert len(own) == 30 and sum(own) == 15
