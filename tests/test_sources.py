"""Raw files, workbooks, layers and the whole pipeline."""

import datetime as dt
import io
import os
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog.queries import SMALL_SHARD
from catalog.telemetry import raw_source
from catalog.workbooks import book_bytes, write_workbooks
from millrace import constants as K
from millrace.functions.columns import coerce_numeric, parse_time
from millrace.operators.unify import unify
from millrace.plans import pipeline
from millrace.sources import layers, raw, workbook


def test_header_rules(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` A (x) ` int, `B C` int, D int")
    assert raw.clean_headers(df).columns == ["A_x", "B_C", "D"]
    with pytest.raises(ValueError):
        raw.clean_headers(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_coercion(spark):
    df = spark.createDataFrame(
        [("1.5",), ("x",), ("NaN",), (None,), (" 2 ",)], "v string"
    )
    assert [r.v for r in coerce_numeric(df).collect()] == [1.5, None, None, None, 2.0]
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert coerce_numeric(nan).first().v is None


def test_time_texts(spark):
    texts = [
        "2024-08-13T14:00:00.123Z",
        "2024-08-13T14:00:00Z",
        "2024-08-13T14:00:00.123456Z",
        "2024-08-13 14:00:00",
        "garbage",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    base = 1_723_557_600_000_000
    want = [base + 123_000, base, base + 123_456, base, None, None]
    got = df.orderBy("i").select(F.unix_micros(parse_time(F.col("t")))).collect()
    assert [r[0] for r in got] == want
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        moved = df.orderBy("i").select(F.unix_micros(parse_time(F.col("t")))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0] for r in moved][:3] == want[:3]


SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2" s="1"><v>45517.583334756943</v></c><c r="C2"><v>1.25</v></c></row>
<row r="3"><c r="A3" t="str"><v>later</v></c><c r="C3" t="e"><v>#N/A</v></c></row>
</sheetData></worksheet>"""
STYLES = """<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm:ss"/></numFmts>
<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>"""
SHARED = """<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<si><t>_time</t></si><si><r><t>Load </t></r><r><t>(N)</t></r></si></sst>"""


def test_workbook_cells():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", SHEET)
        book.writestr("xl/styles.xml", STYLES)
        book.writestr("xl/sharedStrings.xml", SHARED)
    header, first, second = workbook.iter_sheet(buffer.getvalue())
    assert header == {0: "_time", 2: "Load (N)"}
    moment = dt.datetime(1899, 12, 30) + dt.timedelta(days=45517.583334756943)
    assert first[0].startswith(moment.isoformat(sep=" ")[:19]) and first[2] == "1.25"
    assert second == {0: "later", 2: None}


def test_csv_folder_with_a_workbook_inside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("_time,Load (N)\nt1,1.5\nt2,bad\n")
    book = book_bytes(pd.DataFrame({"_time": ["t3"], "Load (N)": [2.5]}))
    (tmp_path / "b.csv").write_bytes(book)
    names = [K.TIME_TEXT, "Load_N"]
    got = raw.load_raw(spark, str(tmp_path), names).orderBy(K.TIME_TEXT).collect()
    assert [tuple(r) for r in got] == [("t1", 1.5), ("t2", None), ("t3", 2.5)]
    with pytest.raises(ValueError):
        raw.load_raw(spark, str(tmp_path))


def test_other_formats(spark, tmp_path):
    df = spark.createDataFrame([("t1", "1.5"), ("t2", "x")], "_time string, v string")
    df.write.json(f"{tmp_path}/rows.json")
    df.write.parquet(f"{tmp_path}/rows.parquet")
    for name in ("rows.json", "rows.parquet"):
        got = raw.load_raw(spark, f"{tmp_path}/{name}", [K.TIME_TEXT, "v"]).orderBy("_time")
        assert [tuple(r) for r in got.collect()] == [("t1", 1.5), ("t2", None)]


def test_mask_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "I_Stopper2_Status int, x int")
    assert raw.mask(raw.mask(df)).columns == ["x"]


def test_join_rules(spark):
    a = spark.createDataFrame([(1, 5, 1), (1, None, 2)], "line_id int, t_us bigint, a int")
    b = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, None, 3)], "line_id int, t_us bigint, b int")
    assert sorted(r.b for r in unify([a, b]).collect()) == [1, 2]
    with pytest.raises(ValueError):
        unify([a, b.withColumnRenamed("b", "A")])


def test_join_exchanges_each_source_once(spark, sf_dir):
    sources = [
        layers.with_time(raw_source(spark, sf_dir, n)).select("line_id", "t_us", *K.SOURCE_COLUMNS[n])
        for n in K.SOURCES
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = unify(sources)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == len(K.SOURCES)


def test_as_of_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    source = layers.with_time(raw_source(spark, sf_dir, "conveyor"))
    layers.write_layer(source, str(tmp_path / "t"), ("line_id", "t_us"))
    from millrace.operators.ordered import up_to_time

    rows = up_to_time(layers.read_layer(spark, str(tmp_path / "t")), 8_526_000_000_000)
    plan = rows.select("line_id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(t_us,8526000000000)" in plan


@pytest.mark.parametrize("limit", [None, SMALL_SHARD // 4])
def test_run_over_raw_files(spark, sf_dir, tmp_path, limit):
    """Seven raw files of one line, without a line column, to gold."""
    paths = {}
    for name in K.SOURCES:
        source = raw_source(spark, sf_dir, name).where("line_id = 3").drop("line_id", "event_id")
        paths[name] = str(tmp_path / name)
        if name == "conveyor":  # a workbook under a .csv name
            write_workbooks(source, paths[name], ending=".csv")
        elif name in ("r01", "r02"):
            write_workbooks(source, paths[name] + ".xlsx")
            paths[name] += ".xlsx"
        else:
            source.write.option("header", True).csv(paths[name])
    gold = pipeline.run(spark, paths, str(tmp_path / "out"), rows_per_shard=limit)
    shown = pipeline.gold_columns(gold)
    assert K.stopper(2) not in shown.columns
    for r in K.ROBOTS:
        assert {f"{K.load(r)}_MA10", K.velocity(r, "S"), K.acceleration(r, "U")} <= set(shown.columns)
    kept = raw_source(spark, sf_dir, "conveyor").where("line_id = 3 AND event_id % 41 NOT BETWEEN 1 AND 7")
    assert shown.count() == kept.count()
    assert shown.where(F.col(K.TRANSIT).isNull()).count() == 0
    assert os.path.isdir(tmp_path / "out" / "silver" / "integrated")


def test_times_without_a_date_are_not_read(spark):
    texts = ["12:30", "T12:30", "2024", "12345", "2024-08-13", "2024-08-13T14:00", "now"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(parse_time(F.col("t"))).collect()] == [None] * len(texts)


def test_files_are_read_by_content(spark, tmp_path):
    import gzip

    names = ["_time", "A_x", "B"]
    (tmp_path / "one.csv").write_text("_time,A (x),B\nt1,1,2\n")
    (tmp_path / "two.csv").write_text("B,_time,A (x)\n20,t2,10\n")
    (tmp_path / "three.csv.gz").write_bytes(gzip.compress(b"_time,A (x),B\nt3,3,4\n"))
    (tmp_path / "four.txt").write_text('{"_time": "t4", "A (x)": 5, "other": 1}\n')
    (tmp_path / "five.csv").write_text("")
    spark.createDataFrame([("t6", 7.0, 8.0)], "_time string, A_x double, B double").write.parquet(str(tmp_path / "six"))
    got = {tuple(r) for r in raw.load_raw(spark, str(tmp_path), names).collect()}
    assert got == {("t1", 1.0, 2.0), ("t2", 10.0, 20.0), ("t3", 3.0, 4.0), ("t4", 5.0, None), ("t6", 7.0, 8.0)}
    (tmp_path / "bad.csv").write_bytes(b"\x00\x01\x02")
    with pytest.raises(ValueError):
        raw.load_raw(spark, str(tmp_path), names)


def test_compressed_text_beside_a_workbook(spark, tmp_path):
    import gzip

    (tmp_path / "book.csv").write_bytes(book_bytes(pd.DataFrame({"_time": ["t1", "t2"], "A": [1.0, 2.0]})))
    (tmp_path / "part.csv.gz").write_bytes(gzip.compress(b"_time,A\nt3,3\n"))
    (tmp_path / "part.txt").write_text("_time,A\nt4,4\n")
    rows = raw.load_raw(spark, str(tmp_path), ["_time", "A"]).collect()
    assert {r["_time"]: r.A for r in rows} == {"t1": 1.0, "t2": 2.0, "t3": 3.0, "t4": 4.0}


def test_headers_that_need_quoting(spark):
    assert raw.clean_name(" A.b`c\td ") == "Abc_d"


def test_many_files_with_few_headers(spark, tmp_path):
    """What the driver gets grows with the distinct headers, not with the files."""
    for k in range(120):
        folder = tmp_path / f"d {k % 5}"
        folder.mkdir(exist_ok=True)
        if k % 3 == 0:
            (folder / f"{k}.csv").write_text(f"_time,Load (N)\nt{k},{k}\n")
        elif k % 3 == 1:
            (folder / f"{k}.csv").write_bytes(f'﻿Load (N),"_time",Other\r\n{k},"t,{k}",1\r\n\r\n'.encode())
        else:
            (folder / f"{k}.csv").write_text("")
    looked = raw.look_into(spark, str(tmp_path)).where("header != ''")
    assert looked.select("kind", "header").distinct().count() == 2 and looked.count() == 80
    got = raw.load_raw(spark, str(tmp_path), [K.TIME_TEXT, "Load_N", "Missing"])
    assert got.columns == [K.TIME_TEXT, "Load_N", "Missing"]
    want = sorted([(f"t{k}" if k % 3 == 0 else f"t,{k}", float(k), None) for k in range(120) if k % 3 < 2])
    assert sorted(map(tuple, got.collect())) == want
    whole = raw.load_raw(spark, str(tmp_path))
    assert set(whole.columns) == {K.TIME_TEXT, "Load_N", "Other"} and whole.count() == 80
    one = raw.load_raw(spark, str(tmp_path / "d 0"), [K.TIME_TEXT, "Load_N"])
    assert one.count() == 16 and len(one.inputFiles()) >= 16


def test_files_of_one_kind_are_not_listed(spark, tmp_path, monkeypatch):
    for k in range(30):
        (tmp_path / f"{k}.csv").write_text(f"_time,Load (N)\nt{k},{k}\n")
    asked = []
    read = raw._read
    monkeypatch.setattr(raw, "_read", lambda spark, path, *rest: asked.append(path) or read(spark, path, *rest))
    assert raw.load_raw(spark, str(tmp_path), [K.TIME_TEXT, "Load_N"]).count() == 30
    assert asked == [str(tmp_path)]
