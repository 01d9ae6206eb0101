"""Runs registered queries next to their SQL and compares whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql: str, tolerance: float = 0.0) -> str | None:
    """None if equal, else what differs; rows in any order, columns by name."""
    names = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    result = con.execute(f"SELECT * FROM ({sql}) AS q")
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} vs {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = [tuple(r[i] for i in order) for r in result.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(sorted(got, key=_key), sorted(want, key=_key)):
        for n, a, b in zip(names, g, w):
            same = a == b or (
                isinstance(a, float)
                and isinstance(b, float)
                and math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
            )
            if not same or type(a) is not type(b):
                return f"{n}: {a!r} vs {b!r} in {g} / {w}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in oracle:
                verdict = compare(df, con, oracle[name]) or "ok"
            else:
                verdict = f"ok, {df.count()} rows (no SQL)"
        except Exception as error:  # report and go on to the next query
            verdict = f"ERROR {str(error)[:1500]}"
        bad += not verdict.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s  {verdict[:1600]}", flush=True)
    print("failed:", bad)
