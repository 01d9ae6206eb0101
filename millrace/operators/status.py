"""Per-row status tables: lookups, scores in long form, rules, scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace import constants as K
from millrace.functions.scores import drive_health, robot_health


def defect_lookup(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Add title, severity and message of the row's class (four fixed rows)."""
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(n, *texts) for n, texts in K.DEFECT_MESSAGES.items()],
        f"{label} int, defect_title string, severity string, message string",
    )
    return df.join(F.broadcast(table), label, "left")


def label_confidence(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Long form: the displayed probability of each class for each row.

    These are constants chosen by the label. For a model's own probabilities
    use :func:`millrace.plans.training.score`.
    """
    spark = df.sparkSession
    table = spark.createDataFrame(
        [
            (n, K.CLASS_NAMES[c], float(p))
            for n, shares in K.CLASS_CONFIDENCE.items()
            for c, p in enumerate(shares)
        ],
        f"{label} int, class_name string, probability double",
    )
    return df.join(F.broadcast(table), label, "inner")


def scenario_overlay(df: DataFrame) -> DataFrame:
    """Each row once per named scenario, with the scenario's columns replaced.

    Apply to current rows, before scores and status texts; aggregates over
    earlier rows are not affected by a scenario.
    """
    names = F.explode(F.array(*[F.lit(s) for s in K.SCENARIOS]))
    named = df.withColumn("scenario", names)
    changed = {}
    for column in df.columns:
        value = F.col(column)
        for scenario, overrides in K.SCENARIOS.items():
            if column in overrides:
                hit = F.col("scenario") == scenario
                value = F.when(hit, F.lit(overrides[column])).otherwise(value)
                changed[column] = value.cast(df.schema[column].dataType)
    return named.withColumns(changed) if changed else named


def robot_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{r}_health": robot_health(r) for r in K.ROBOTS})


def drive_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({f"VFD{d}_health": drive_health(d) for d in K.DRIVES})


def metrics_long(df: DataFrame, keys: list[str]) -> DataFrame:
    """(metric, subject, value) rows from the KPI and score columns present."""
    subjects = [(m, "line", m) for m in ("availability", "performance", "quality")]
    subjects += [("robot_health", r, f"{r}_health") for r in K.ROBOTS]
    subjects += [("vfd_health", f"VFD{d}", f"VFD{d}_health") for d in K.DRIVES]
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.lit(subject).alias("subject"),
            F.col(column).alias("value"),
        )
        for metric, subject, column in subjects
        if column in df.columns
    ]
    return df.select(*keys, F.inline(F.array(*rows)))


def rule_alerts(metrics: DataFrame) -> DataFrame:
    """Advice for every metric below its limit (five fixed rules)."""
    rules = metrics.sparkSession.createDataFrame(
        list(K.ALERT_RULES), "metric string, limit double, advice string"
    )
    return metrics.join(F.broadcast(rules), "metric").where(
        F.col("value") < F.col("limit")
    )
