"""Registered queries of the corpus operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontaminate, jaccard, language, lines, negatives, pii, quality, sharding, sql, substring, tokenfiles, vectors, whitening
from millrace.session import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """Where the word-level public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards with the same mixture of sources."""
    return sharding.digests(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has are cut."""
    return substring.digests(substring.deduplicate(_table(spark, sf_dir, "documents")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents are dropped, but for the first."""
    return lines.digests(_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of cosine 0.9 and more."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and secrets of every document."""
    return pii.digests(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items, with what they share."""
    return decontaminate.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learned from labels; toxic ones count as bad."""
    docs = _table(spark, sf_dir, "documents")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), good)
    return quality.score(docs, model).withColumn("kept", F.col("quality") >= 0.5)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Tokens of every document and their decoded text, as hashes."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), bpe.vocabulary(path or vocabulary_path()))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose shingle sets have a similarity of 0.75 and more."""
    return jaccard.group(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors along the first 16 components, each of variance one."""
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document's place and checksum, read back from the files of token ids."""
    out = scratch(spark, "token-ids")
    tokenfiles.write(_table(spark, sf_dir, "documents"), bpe.vocabulary(path or vocabulary_path()), out)
    return tokenfiles.positions(spark, out)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and its positives, the best rows of other labels below them."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_line_dedup": op3_line_dedup,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_language_id": op5_language_id,
        "op6_pii": op6_pii,
        "op7_decontamination": op7_decontamination,
        "op8_quality": op8_quality,
        "op9_bpe_round_trip": op9_bpe_round_trip,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_whitening": op11_whitening,
        "op12_token_files": op12_token_files,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sharding": sql.SHARDING,
        "op2_substring_dedup": sql.SUBSTRING,
        "op3_line_dedup": sql.LINES,
        "op4_embedding_dedup": sql.VECTORS,
        "op7_decontamination": sql.DECONTAMINATE,
        "op10_jaccard_join": sql.JACCARD,
        "op13_hard_negatives": sql.NEGATIVES,
    }
