"""Every operator on nulls, empty and long texts, repeated rows, clashing names, no rows."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, language, lines, pii, quality, sharding, substring, vectors

from .conftest import rows

SPEC = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
IDS = collections.Counter(r[0] for r in rows())


def ids(df):
    return collections.Counter(r[0] for r in df.select("doc_id").collect())


def labels(spark, docs):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (4, None, 0), (6, 0, 1), (8, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")


def good():
    return (F.col("quality") == 1) & (F.col("toxic") == 0)

PER_ROW = {
    "sharding": lambda spark, d: sharding.interleave(d, 4),
    "substring": lambda spark, d: substring.deduplicate(d),
    "lines": lambda spark, d: lines.drop_recurring(d),
    "language": lambda spark, d: language.identify(d, language.fit(d)),
    "pii": lambda spark, d: pii.find(d),
    "quality": lambda spark, d: quality.score(d, quality.fit(d, labels(spark, d), good())),
    "encode": lambda spark, d: bpe.encode(d, SPEC),
    "round_trip": lambda spark, d: bpe.round_trip(d, SPEC),
    "decode": lambda spark, d: bpe.decode(bpe.encode(d, SPEC), SPEC),
    "jaccard": lambda spark, d: jaccard.group(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(spark, edge, name):
    assert ids(PER_ROW[name](spark, edge)) == IDS


@pytest.mark.parametrize("name", PER_ROW)
def test_no_rows(spark, edge, empty, name):
    out = PER_ROW[name](spark, empty)
    assert out.count() == 0
    assert out.columns == PER_ROW[name](spark, edge).columns


def test_decontaminate_edges(spark, edge, empty):
    items = edge.select(F.col("doc_id").alias("item_id"), "text", "id", "n", "h")
    found = {(r[0], r[1]) for r in decontaminate.contained(edge, items).collect()}
    assert {(1, 1), (1, 2), (2, 1), (8, 9), (9, 8), (6, 7)} <= found
    assert not {x for pair in found for x in pair} & {None, 3, 4, 5}
    assert decontaminate.contained(empty, items).count() == 0
    assert decontaminate.contained(edge, items.limit(0)).count() == 0


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id long, embedding array<float>, g string, links int")
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (9, 0, 9, True), (10, 0, 10, True), (None, 0, None, False)} <= got
    assert vectors.near_duplicates(df).count() == len(data)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_results_of_odd_rows(spark, edge):
    cut = {r.doc_id: r for r in substring.deduplicate(edge).collect()}
    assert (cut[4].n_words, cut[4].n_removed, cut[4].kept) == (0, 0, "")
    assert cut[6].n_removed < cut[6].n_words and cut[7].n_removed == cut[7].n_words == 120_000
    found = {r.doc_id: r for r in language.identify(edge, language.fit(edge)).collect()}
    assert (found[3].lang_pred, found[4].lang_pred, found[5].lang_pred) == ("und",) * 3
    groups = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.group(edge).collect()}
    assert {(1, 15, 1), (2, 15, 1), (3, 0, 3), (4, 0, 4), (None, 15, None), (9, 1, 8)} <= groups
    left = {r.doc_id: r for r in lines.drop_recurring(edge).collect()}
    assert left[4].text is None and (left[4].n_lines, left[3].n_lines) == (0, 1)
    assert [r.n for r in edge.limit(1).collect()] == ["n"] and left[1].n == "n"
    coded = {r.doc_id: r for r in bpe.encode(edge, SPEC).collect()}
    assert coded[4].ids == coded[3].ids == coded[5].ids == []
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(edge).collect()}
    assert spans[10] == [("email", 28, 43), ("ip", 44, 52)] and spans[4] == []
