"""A corpus from raw documents to tokens: stages that run one after another.

Each stage takes what its predecessor kept; all but the last return the columns of
``documents``. Between stages ``run`` writes the rows to the shared folder and reads
them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontaminate, jaccard, language, lines
from millrace.llm.queries import vocabulary_path
from millrace.llm.tables import arrow_rows, stored
from millrace.session import scratch

#: Least share of a text's letters that its language must have.
LEAST_SHARE = 0.5
#: Whole texts that Python gets at a time.
BATCH_ROWS = 1_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters or without a prevailing language go. Learned from the
    documents that are not held out."""
    with arrow_rows(spark, BATCH_ROWS):
        model = language.fit(docs.where(~language.held_out("doc_id")))
        found = language.identify(docs, model)
        kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
        return stored(kept.select(docs.columns))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, but for the first; ``n_chars`` follows the text."""
    left = lines.drop_recurring(docs)
    return left.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the document with the smallest id stays."""
    groups = jaccard.group(docs.select("doc_id", "text"))
    gone = groups.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = decontaminate.contained(docs.select("doc_id", "text"), items).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number of tokens and token ids of what is left, and the hash of the
    text decoded from the ids."""
    with arrow_rows(spark, BATCH_ROWS):
        return stored(bpe.encode(docs.select("doc_id", "text"), bpe.vocabulary(vocabulary_path()), decoded=True))


STAGES = [
    ("language", known_language),
    ("lines", without_recurring_lines),
    ("near_copies", one_of_each_group),
    ("decontamination", without_test_items),
    ("tokens", tokens),
]

#: SQL cannot say the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every one but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
