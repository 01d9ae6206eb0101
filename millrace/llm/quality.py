"""Quality of documents by co-training on two views of them.

One classifier sees a text's words and their shapes, the other what is known about the
document: source, language, length and layout. Each labels the unlabelled documents it
is surest about for the other, over some rounds. Their calibrated scores are combined.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import stored

#: Labelled rows, and as many unlabelled ones, that the fit uses at most, about. The
#: rows with the least hash of the key are taken, whatever the size of the tables.
FIT_ROWS = 16_000
#: Rounds of exchanging labels; share of the unlabelled rows labelled in each.
ROUNDS, SHARE = 2, 0.1
#: Hash slots of the text view and of the document view.
TEXT_SLOTS, META_SLOTS = 1 << 15, 1 << 10


def _views(docs: DataFrame, key: str) -> DataFrame:
    """``id`` and the columns that both views' features are made of."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col(key).alias("id"), text.alias("t"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    base = base.withColumn("chars", F.length("t").cast("double"))
    # A word counts once as its lower-case letters and once as its shape (Xxxx9!!).
    plain = F.lower(F.translate("t", _SIGNS, " " * len(_SIGNS)))
    shape = F.translate("t", _UPPER + _LOWER + _DIGITS, "X" * 26 + "x" * 26 + "9" * 10)
    base = base.withColumn("words", F.split(plain, _SPACE)).withColumn("shapes", F.split(shape, _SPACE))
    size = F.greatest(F.size("shapes"), F.lit(1)).cast("double")
    lines = F.size(F.split("t", "\n", -1)).cast("double")
    return base.select(
        "id",
        F.concat("words", "shapes").alias("words"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.log1p("chars").alias("length"),
        F.log1p(size).alias("count"),
        (F.col("chars") / size / 10).alias("word_length"),
        F.log1p(lines).alias("lines"),
        F.log1p(F.col("chars") / lines).alias("line_length"),
    )


_SPACE = "[\\x20\\x09-\\x0D]+"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_NUMBERS = ["length", "count", "word_length", "lines", "line_length"]


def _features() -> PipelineModel:
    """Vectors of both views; nothing is learned from the data."""
    text = HashingTF(inputCol="words", outputCol="text_view", numFeatures=TEXT_SLOTS, binary=True)
    named = FeatureHasher(inputCols=["source", "lang"], outputCol="named", numFeatures=META_SLOTS)
    meta = VectorAssembler(inputCols=[*_NUMBERS, "named"], outputCol="meta_view", handleInvalid="keep")
    return PipelineModel([text, named, meta])


def _regression(view: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=f"{view}_view", labelCol="label", weightCol="weight", probabilityCol=f"{view}_p", rawPredictionCol=f"{view}_raw",
        predictionCol=f"{view}_label", maxIter=60, regParam=0.003,
        # Most words tell nothing: a penalty that leaves their weights at zero.
        elasticNetParam=1.0 if view == "text" else 0.0,
    )


def _log_odds(view: str) -> Column:
    return vector_to_array(f"{view}_raw")[1]


class Model:
    """Two fitted views and how their scores are combined."""

    def __init__(self, views: dict, combined, prior: float):
        self.views, self.combined, self.prior = views, combined, prior

    def score(self, features: DataFrame) -> DataFrame:
        """``id, text_score, meta_score, quality`` of rows with both views' features."""
        if not self.views:
            return features.select("id", *[F.lit(self.prior).alias(c) for c in ("text_score", "meta_score", "quality")])
        for view in self.views.values():
            features = view.transform(features)
        text, meta = _log_odds("text"), _log_odds("meta")
        a, b, bias = self.combined
        return features.select(
            "id",
            _sigmoid(text).alias("text_score"),
            _sigmoid(meta).alias("meta_score"),
            _sigmoid(a * text + b * meta + bias).alias("quality"),
        )


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def fit(docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", rows: int = FIT_ROWS) -> Model:
    """Co-train on labelled and unlabelled documents, about ``rows`` of each at most.

    ``good`` is a condition over ``labels``; rows where it is null, and null keys, are
    left out; of repeated labels of a key the worst counts. A fifth of the labelled rows
    is held back to calibrate and combine the views. Without labelled documents of both
    kinds the model scores every document with the share of good labels.
    """
    known = labels.select(F.col(key).alias("id"), good.cast("double").alias("label")).where("id is not null and label is not null")
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    place = F.pmod(F.xxhash64(F.lit(31), "id"), F.lit(1 << 20))
    counts = known.agg(F.count("*"), F.sum("label")).first()
    if not counts[0] or counts[1] in (0, counts[0]):
        return Model({}, None, float(counts[1] / counts[0]) if counts[0] else 0.5)
    total = docs.count()
    limit = lambda n: min(1.0, rows / max(n, 1)) * (1 << 20)
    ids = docs.select(F.col(key).alias("id")).where("id is not null").distinct().join(known, "id", "left")
    ids = ids.withColumn("place", place)
    chosen = ids.where(
        (F.col("label").isNotNull() & (F.col("place") < limit(counts[0])))
        | (F.col("label").isNull() & (F.col("place") < limit(total - counts[0])))
    )
    sample = docs.join(F.broadcast(chosen), docs[key] == chosen["id"]).drop("id", "label", "place")
    data = _features().transform(_views(sample, key)).select("id", "text_view", "meta_view").join(F.broadcast(chosen), "id")
    data = stored(data)
    held = F.pmod(F.xxhash64(F.lit(32), "id"), F.lit(5)) == 0
    train, check = data.where(F.col("label").isNotNull() & ~held), data.where(F.col("label").isNotNull() & held)
    pool = data.where(F.col("label").isNull())
    if train.agg(F.count_distinct("label")).first()[0] < 2:
        return Model({}, None, float(counts[1] / counts[0]))
    taken = {view: train.select("id", f"{view}_view", "label", F.lit(1.0).alias("weight")) for view in ("text", "meta")}
    fitted = {view: _regression(view).fit(own) for view, own in taken.items()}
    for step in range(1, ROUNDS + 1):
        scored = fitted["meta"].transform(fitted["text"].transform(pool))
        scored = stored(scored.select("id", "text_view", "meta_view", _log_odds("text").alias("text"), _log_odds("meta").alias("meta")))
        part = SHARE * step
        new = {}
        for view, other in (("text", "meta"), ("meta", "text")):
            # The other view's surest documents of each kind teach this one.
            low, high = scored.approxQuantile(view, [part / 4, 1 - part], 0.005) or (0.0, 0.0)
            sure = scored.where((F.col(view) >= max(high, 2.0)) | (F.col(view) <= min(low, -2.0)))
            pseudo = sure.select("id", f"{other}_view", (F.col(view) > 0).cast("double").alias("label"), F.lit(0.5).alias("weight"))
            new[other] = taken[other].unionByName(pseudo)
        fitted = {view: _regression(view).fit(own) for view, own in new.items()}
    scored = fitted["meta"].transform(fitted["text"].transform(check))
    pairs = scored.select("label", _log_odds("text").alias("text"), _log_odds("meta").alias("meta"), F.lit(1.0).alias("weight"))
    both = VectorAssembler(inputCols=["text", "meta"], outputCol="both_view").transform(stored(pairs))
    if both.agg(F.count_distinct("label")).first()[0] < 2:
        return Model(fitted, (1.0, 0.0, 0.0), 0.5)
    combined = LogisticRegression(featuresCol="both_view", labelCol="label", regParam=0.001).fit(both)
    a, b = combined.coefficients.toArray().tolist()
    return Model(fitted, (a, b, combined.intercept), 0.5)


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key, text_score, meta_score, quality`` for every row, from whole texts.

    Needs the columns ``text``, ``source`` and ``lang``; nulls in them count as empty.
    Rows that repeat a key or have none each get a score.
    """
    return model.score(_features().transform(_views(docs, key))).withColumnRenamed("id", key)
