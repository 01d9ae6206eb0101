"""Writes workbooks from a DataFrame, so that the workbook loader can be run.

Each task writes the rows of its partition as files of bounded size, straight
into a shared folder.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame

ROWS_PER_BOOK = 2_000


def book_bytes(pdf: pd.DataFrame) -> bytes:
    """One sheet: texts inline, numbers as numbers, gaps as absent cells."""

    def cell(value) -> str:
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        return "<c/>" if pd.isna(value) else f"<c><v>{value!r}</v></c>"

    rows = [list(pdf.columns), *pdf.astype(object).values.tolist()]
    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        f"<sheetData>{body}</sheetData></worksheet>"
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/worksheets/sheet1.xml", sheet)
    return buffer.getvalue()


def write_workbooks(df: DataFrame, path: str, ending: str = ".xlsx") -> None:
    # Spark writes "file:/x" where URIs elsewhere are "file:///x".
    uri = re.sub("^file:/+", "file:///", path)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Names follow the task, so a task run again replaces its own files.
        files, folder = FileSystem.from_uri(uri)
        files.create_dir(folder, recursive=True)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, len(batch), ROWS_PER_BOOK):
                part = batch.iloc[start : start + ROWS_PER_BOOK]
                name = f"{folder}/book-{task:05d}-{number:05d}{ending}"
                number += 1
                with files.open_output_stream(name) as file:
                    file.write(book_bytes(part))
                yield pd.DataFrame({"name": [name]})

    df.mapInPandas(store, "name string").write.format("noop").mode("append").save()
