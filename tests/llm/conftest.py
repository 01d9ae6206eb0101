import datetime

import pytest
from pyspark.sql import Row

LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(60_000))


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = [
        (1, "the cat sat on the mat and the dog sat on the log by the door\nit was late", "en", "a"),
        (2, "the cat sat on the mat and the dog sat on the log by the door\nit was late", "en", "a"),
        (2, "the cat sat on the mat and the dog sat on the log by the door\nit was late", "en", "a"),
        (3, "", "en", "b"),
        (4, None, "fr", "b"),
        (5, "  \t\n ", None, None),
        (6, LONG, "en", "a"),
        (7, LONG, "en", None),
        (None, "the cat sat on the mat and the dog sat on the log by the door\nit was late", "en", "a"),
        (None, None, None, None),
        (8, "one two", "en", "a"),
        (9, "One TWO", "en", "a"),
        (10, "Été à la plage, 東京 и Москва a@b.example.org 10.0.0.1", "fr", "c"),
        (2**53 + 1, "x" * 300_000, "en", "c"),
    ]
    return base


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with columns whose names the operators also use inside."""
    clash = dict(id="i", h="h", n="n", key="k", shard="s", slot=1, score="s", lang_pred="l", words="w", t="t", row="r", at="a", n_lines=1, component=datetime.date(2024, 1, 1))
    names = ["doc_id", "text", "lang", "source", "n_chars", *clash]
    data = [Row(*r, len(r[1]) if r[1] else None, *clash.values()) for r in rows()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} {'date' if c == 'component' else 'int' if isinstance(v, int) else 'string'}" for c, v in clash.items()
    )
    assert names
    return spark.createDataFrame(data, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
