"""Workbook (.xlsx) tables, one file per task.

Spark has no reader for this format. ``binaryFile`` lists and ships the files,
Spark spreads them over tasks, and a small XML reader yields the first sheet in
batches. A sheet has at most 1,048,576 rows by its format, so one file always
fits a task; the number of files is what grows.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 10_000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_EPOCH = dt.datetime(1899, 12, 30)
_BUILTIN_DATES = {*range(14, 23), *range(45, 48)}


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    clean: Callable[[str], str] = str.strip,
) -> DataFrame:
    """First sheet of every workbook as text columns, header in the first row.

    ``columns`` are the expected cleaned names; one missing from a file is
    NULL there, others in the file are ignored.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield from _sheet_batches(content, columns, clean)

    # One file per task: contents are large and batches hold few of them.
    schema = ", ".join(f"`{c}` string" for c in columns)
    return files.mapInPandas(parse, schema)


def _sheet_batches(content: bytes, columns, clean) -> Iterator[pd.DataFrame]:
    rows = iter_sheet(content)
    header = {clean(str(v)): i for i, v in next(rows, {}).items() if v is not None}
    places = [header.get(c) for c in columns]
    batch: list[list[str | None]] = []
    for row in rows:
        batch.append([None if p is None else row.get(p) for p in places])
        if len(batch) == BATCH_ROWS:
            yield pd.DataFrame(batch, columns=columns, dtype=object)
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=columns, dtype=object)


def iter_sheet(content: bytes) -> Iterator[dict[int, str | None]]:
    """Rows of the first sheet as {column number: text}."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = _shared_texts(book) if "xl/sharedStrings.xml" in names else []
        dates = _date_styles(book) if "xl/styles.xml" in names else set()
        sheets = [n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
        first = min(sheets, key=lambda n: int(re.search(r"(\d+)\.xml", n).group(1)))
        with book.open(first) as stream:
            for _, element in ElementTree.iterparse(stream):
                if element.tag == f"{_MAIN}row":
                    yield {
                        _column(cell, i): _text(cell, shared, dates)
                        for i, cell in enumerate(element.iter(f"{_MAIN}c"))
                    }
                    element.clear()


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in root]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or time."""
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = set()
    for number_format in root.iter(f"{_MAIN}numFmt"):
        # Quoted texts and bracketed colours are not part of the pattern.
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", number_format.get("formatCode", ""))
        if re.search(r"[ymdhs]", code.lower()):
            custom.add(int(number_format.get("numFmtId")))
    formats = root.find(f"{_MAIN}cellXfs")
    return {
        i
        for i, style in enumerate(formats if formats is not None else [])
        if int(style.get("numFmtId", 0)) in custom | _BUILTIN_DATES
    }


def _column(cell, position: int) -> int:
    letters = re.match(r"[A-Z]+", cell.get("r", ""))
    if not letters:
        return position
    number = 0
    for letter in letters.group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "n" and int(cell.get("s", 0)) in dates:
        # Dates are days since the epoch; milliseconds are what a double holds.
        moment = _EPOCH + dt.timedelta(milliseconds=round(float(value) * 86_400_000))
        return moment.isoformat(sep=" ", timespec="milliseconds")
    return value
