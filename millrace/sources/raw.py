"""Loading raw sensor files: CSV, JSON lines, Parquet and workbooks."""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import constants as K
from millrace.functions.columns import coerce_numeric
from millrace.operators.shards import small
from millrace.session import checkpointed
from millrace.sources.workbook import read_workbooks

# First bytes of a workbook, which is a zip archive, and of a Parquet file.
WORKBOOK_MAGIC, PARQUET_MAGIC = b"PK\x03\x04", b"PAR1"
# A header line is looked for in this many first bytes of a file.
HEAD_BYTES = 1 << 16


# Blanks, tabs and line breaks become ``_``; what would need quoting goes.
_HEADER = str.maketrans(dict.fromkeys(" \t\n\r", "_") | dict.fromkeys("()`."))


def clean_name(name: str) -> str:
    """Header text to column name, safe to use in SQL text."""
    return name.strip().translate(_HEADER)


def clean_headers(df: DataFrame) -> DataFrame:
    cleaned = [clean_name(c) for c in df.columns]
    twice = [n for n, k in Counter(c.lower() for c in cleaned).items() if k > 1]
    if twice:
        raise ValueError(f"headers that become the same name: {twice}")
    return df.toDF(*cleaned)


def look_into(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, kind, header`` of every file, from its first bytes, and its ``file``, the
    name by which rows read from it can be told.

    ``kind`` is ``workbook``, ``parquet``, ``json``, ``csv`` or ``unknown``, whatever
    the file is called; compressed text is looked into as well. ``header`` is the first
    line of a CSV. Tasks open the files; contents stay where they are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.select("path", F.col("_metadata.file_path").alias("file"))
    return named.mapInArrow(_heads, "path string, file string, kind string, header string")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, file in zip(batch.column("path").to_pylist(), batch.column("file").to_pylist()):
            files, inner = fs.FileSystem.from_uri(file)  # which has blanks and the like escaped
            with files.open_input_stream(inner, compression="detect") as stream:
                head = stream.read(HEAD_BYTES)
            found.append((path, *_kind(head)))
        path, kind, header = (pa.array([f[k] for f in found], pa.string()) for k in range(3))
        yield pa.RecordBatch.from_arrays([path, batch.column("file"), kind, header], ["path", "file", "kind", "header"])


def _kind(head: bytes) -> tuple[str, str | None]:
    if head.startswith(WORKBOOK_MAGIC):
        return "workbook", None
    if head.startswith(PARQUET_MAGIC):
        return "parquet", None
    if b"\0" in head:
        return "unknown", None
    text = head.decode("utf-8", "replace").removeprefix("\ufeff").lstrip()
    if text.startswith("{"):
        return "json", None
    return "csv", text.split("\n", 1)[0].rstrip("\r")


def load_raw(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    format: str | None = None,
) -> DataFrame:
    """One raw source as cleaned columns: text columns as text, others double.

    ``format`` is ``csv``, ``json``, ``parquet`` or ``workbook`` if all files are
    alike. Without it each file is read as what its content is, CSV files by their own
    headers, and the rows are put together by column name; a file that lacks a column
    has NULLs there, an empty file has no rows, unknown content raises. ``columns``
    are the expected cleaned names; workbooks and JSON need them, and with them the
    result has just these. Unreadable numbers and NaN become NULL.
    """
    if format:
        return coerce_numeric(_expected(_read(spark, path, columns, format), columns))
    looked = checkpointed(look_into(spark, path).where("header IS NULL OR header != ''"))
    kinds = looked.groupBy("kind", "header").agg(F.min("path").alias("path")).collect()
    groups = sorted(((k.kind, k.header) for k in kinds), key=str)
    if not groups:
        raise ValueError(f"no content in {path}")
    if strange := [k.path for k in kinds if k.kind == "unknown"]:
        raise ValueError(f"neither CSV, JSON, Parquet nor a workbook: {strange}")
    if len(groups) == 1:  # the files need not be listed
        return coerce_numeric(_expected(_read(spark, path, columns, groups[0][0]), columns))
    headers = [header for kind, header in groups if kind == "csv"]
    parts = [_lines(spark, path, looked, headers, columns)] if headers else []
    for kind in sorted({kind for kind, _ in groups if kind != "csv"}):
        paths = [r.path for r in looked.where(F.col("kind") == kind).select("path").collect()]
        parts.append(_expected(_read(spark, paths, columns, kind), columns))
    first, *others = [coerce_numeric(p) for p in parts]
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _lines(spark: SparkSession, path, looked: DataFrame, headers: list[str], columns: list[str] | None) -> DataFrame:
    """Rows of CSV files with different headers, in one pass over their lines.

    Each line is taken apart by place and its values named by the header of its file; the
    files and their headers stay a table that is joined. Lines that repeat their file's
    header are no rows.
    """
    names = []
    for header in headers:
        cleaned = [clean_name(c) for c in next(csv.reader([header]))]
        twice = [n for n, k in Counter(c.lower() for c in cleaned).items() if k > 1]
        if twice:
            raise ValueError(f"headers that become the same name: {twice}")
        names.append(cleaned)
    known = spark.createDataFrame(list(zip(headers, names)), "header string, names array<string>")
    files = looked.where("kind = 'csv'").select("file", "header").join(F.broadcast(known), "header")
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = text.select(F.ltrim("value", F.lit("\ufeff")).alias("value"), F.col("_metadata.file_path").alias("file"))
    lines = lines.join(small(files), "file").where("value != header AND trim(value) != ''")
    width = max(map(len, names))
    places = ", ".join(f"_{k} string" for k in range(width))
    values = F.from_csv("value", F.lit(places))
    row = F.map_from_entries(
        F.filter(F.arrays_zip("names", F.array(*[F.col(f"_row._{k}") for k in range(width)])), lambda e: e["names"].isNotNull())
    )
    rows = lines.withColumn("_row", values).withColumn("_named", row)
    wanted = columns or list(dict.fromkeys(n for own in names for n in own))
    return rows.select(*[F.try_element_at("_named", F.lit(c)).alias(c) for c in wanted])


def _read(spark: SparkSession, path, columns: list[str] | None, format: str) -> DataFrame:
    if format in ("json", "workbook") and not columns:
        raise ValueError(f"{format} needs the expected columns")
    if format == "workbook":
        return read_workbooks(spark, path, columns, clean_name)
    paths = [path] if isinstance(path, str) else path
    read = spark.read.option("recursiveFileLookup", "true")
    if format == "parquet":
        return clean_headers(read.parquet(*paths))
    if format == "json":
        keyed = F.transform_keys(F.from_json("value", "map<string,string>"), lambda k, v: _clean(k))
        rows = read.text(paths).where("trim(value) != ''").select(keyed.alias("row"))
        return rows.select(*[F.try_element_at("row", F.lit(c)).alias(c) for c in columns])
    if format == "csv":
        # All columns as text; another header than the first file's is an error.
        return clean_headers(read.option("header", True).option("enforceSchema", False).csv(paths))
    raise ValueError(f"unknown format: {format}")


def _clean(name: Column) -> Column:
    """:func:`clean_name` for a column of names."""
    return F.translate(F.trim(name), " \t\n\r()`.", "____")


def _expected(df: DataFrame, columns: list[str] | None) -> DataFrame:
    if not columns:
        return df
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def mask(df: DataFrame, columns: tuple[str, ...] = K.MASKED_COLUMNS) -> DataFrame:
    """Hide the signals of the uninstrumented station; absent ones are fine."""
    return df.drop(*columns)
