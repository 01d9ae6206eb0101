"""Times whole-line windows against shards on a repeated copy of the events.

Usage: python tests/scale_trial.py <tables folder> <copies> <rows per shard> [jobs]
A third of all rows belong to line 0. Not a test; run by hand.
"""

from __future__ import annotations

import sys
import tempfile
import time

sys.path.insert(0, "/root/repo")

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from catalog.telemetry import tel  # noqa: E402
from millrace import constants as K  # noqa: E402
from millrace.operators import kpi, ordered as O  # noqa: E402
from millrace.operators.shards import shard  # noqa: E402
from millrace.session import configured  # noqa: E402


def main() -> None:
    sf_dir, copies, size = sys.argv[1], int(sys.argv[2]), int(sys.argv[3])
    spark = (
        configured(SparkSession.builder)
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "20g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = tempfile.mkdtemp(prefix="run-") + "/tel"
    span = 13_000_000_000  # a little more than one copy's time, in microseconds
    wide = tel(spark, sf_dir).select(
        "line_id", "event_id", "t_us", K.STOPPER1, K.STOPPER3, K.ESTOP, K.DOOR1, K.DOOR2,
        K.CYCLE_COUNT, K.DESCRIPTION, *[K.load(r) for r in K.ROBOTS],
        *[K.angle("R01", j) for j in K.JOINTS],
    )
    copy = wide.repartition(8).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    copy.select(
        F.when(F.col("_copy") % 4 == 0, 0).otherwise(F.col("line_id")).cast("long").alias("line_id"),
        (F.col("event_id") + F.col("_copy") * 1_000_000).alias("event_id"),
        (F.col("t_us") + F.col("_copy") * span).alias("t_us"),
        *[c for c in wide.columns if c not in ("line_id", "event_id", "t_us")],
    ).write.parquet(path)
    table = spark.read.parquet(path)
    total = table.count()
    hot = table.where("line_id = 0").count()
    print(f"rows {total}, on line 0 {hot}", flush=True)
    jobs = {
        "transit": lambda s: O.add_transit(s).df.select("line_id", "event_id", K.TRANSIT),
        "motion": lambda s: O.add_motion(s, ["R01"]).df,
        "rolling60": lambda s: O.add_rolling_mean(s, 60, {K.load(r): f"{r}_m" for r in K.ROBOTS}).df,
        "kpi": lambda s: kpi.line_kpis(s).select("line_id", "oee"),
        "running": lambda s: kpi.running_oee(s),
    }
    for name in sys.argv[4:] or jobs:
        job = jobs[name]
        seconds = []
        for rows in (10 * total, size):
            start = time.perf_counter()
            job(shard(table, rows_per_shard=rows)).write.format("noop").mode("append").save()
            seconds.append(time.perf_counter() - start)
        print(f"{name:10s} whole lines {seconds[0]:7.2f}s  shards {seconds[1]:7.2f}s", flush=True)


if __name__ == "__main__":
    main()
