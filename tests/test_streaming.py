"""Streams give the batch result; late rows are kept aside; restarts repeat nothing."""

from pyspark.sql import functions as F

from catalog.telemetry import tel
from millrace import constants as K
from millrace.operators import ordered as O
from millrace.operators.shards import shard
from millrace.streaming import transit as live, windows

SCHEMA = f"line_id bigint, event_id bigint, t_us bigint, {K.STOPPER1} double, {K.STOPPER3} double"


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_restart_and_late_rows(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    S = 1_000_000
    put(spark, path, [(1, 0, 0, 1.0, 0.0), (1, 1, 2 * S, 0.0, 0.0)])
    live.run_transit(source(spark, path), out)
    # A later run goes on from the stored state.
    put(spark, path, [(1, 2, 5 * S, 0.0, 1.0), (2, 9, 7 * S, 0.0, 0.0)])
    put(spark, path, [(1, 3, 1 * S, 1.0, 1.0), (1, 4, 6 * S, 0.0, 0.0), (1, 5, 8 * S, 0.0, 1.0)])
    rows = live.run_transit(source(spark, path), out)
    got = {r.event_id: (r.dt, r[K.TRANSIT]) for r in rows.collect()}
    assert got == {
        0: (0.1, 12.5),
        1: (2.0, 12.5),
        2: (3.0, 3.0),
        9: (0.1, 12.5),
        4: (1.0, 3.0),
        5: (2.0, 6.0),
    }
    late = spark.read.parquet(f"{out}/late")
    assert [r.event_id for r in late.collect()] == [3]
    # Running again with nothing new changes nothing.
    assert live.run_transit(source(spark, path), out).count() == 6


def test_batch_repeated_after_a_failure(spark, tmp_path):
    """The sink writes the same again when a batch is delivered twice."""
    sink = live.TransitStream(str(tmp_path / "out"))
    first = spark.createDataFrame([(1, 0, 0, 1.0, 0.0)], SCHEMA)
    second = spark.createDataFrame([(1, 1, 10**6, 0.0, 1.0)], SCHEMA)
    sink(first, 0)
    for _ in range(2):
        sink(second, 1)
        rows = spark.read.parquet(f"{tmp_path}/out/rows").collect()
        assert sorted((r.event_id, r[K.TRANSIT]) for r in rows) == [(0, 12.5), (1, 0.0)]


def test_sharded_stream_equals_batch(spark, sf_dir, tmp_path):
    df = tel(spark, sf_dir).select("line_id", "event_id", "t_us", K.STOPPER1, K.STOPPER3)
    path = str(tmp_path / "in")
    cut = df.approxQuantile("t_us", [0.5], 0.0)[0]
    for part in (df.where(F.col("t_us") < cut), df.where(F.col("t_us") >= cut)):
        part.coalesce(1).write.mode("append").parquet(path)
    rows = live.run_transit(source(spark, path), str(tmp_path / "out"), rows_per_shard=100)
    got = {r.event_id: r[K.TRANSIT] for r in rows.collect()}
    batch = O.add_transit(shard(df)).df
    assert got == {r.event_id: r[K.TRANSIT] for r in batch.collect()}


def test_repeated_rows_count_once(spark, tmp_path):
    columns = [K.ESTOP, K.DOOR1, K.DOOR2, *[K.temperature(d) for d in K.DRIVES]]
    df = spark.range(200).select(
        F.lit(1).alias("line_id"),
        (F.col("id") % 100).alias("event_id"),
        F.timestamp_seconds(3_600 + (F.col("id") % 100) * 30).alias("timestamp"),
        F.lit(30.0).alias("dt"),
        *[F.lit(1.0).alias(c) for c in columns],
    )
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    result = windows.windowed_kpis(stream, unique=["event_id"])
    rows = windows.run_append(result, str(tmp_path / "out"))
    got = sorted((r.window_start.minute, r.n_rows, r.elapsed_s) for r in rows.collect())
    # 50 minutes of rows; the last window is still open.
    assert got == [(m, 20, 600.0) for m in (0, 10, 20, 30)]


def test_open_windows_are_replaced(spark, tmp_path):
    """Every window comes out, with the rows of all batches, and a restart goes on."""
    columns = [K.ESTOP, K.DOOR1, K.DOOR2, *[K.temperature(d) for d in K.DRIVES]]
    df = spark.range(100).select(
        F.lit(1).alias("line_id"),
        F.col("id").alias("event_id"),
        F.timestamp_seconds(3_600 + F.col("id") * 30).alias("timestamp"),
        F.lit(30.0).alias("dt"),
        *[F.lit(1.0).alias(c) for c in columns],
    )

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        result = windows.windowed_kpis(stream, unique=["event_id"])
        rows = windows.run_update(result, str(tmp_path / "out"), ("line_id", "window_start"))
        return sorted((r.window_start.minute, r.n_rows, r.elapsed_s) for r in rows.collect())

    df.where("event_id < 50").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [(0, 20, 600.0), (10, 20, 600.0), (20, 10, 300.0)]
    df.where("event_id >= 45").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run() == [(m, 20, 600.0) for m in (0, 10, 20, 30, 40)]


def test_sources_of_different_pace(spark, tmp_path):
    """Repeated instants multiply, missing ones don't come out, a late source completes."""
    at = F.timestamp_seconds(F.col("id") * 10)
    sources = []
    for n in range(3):
        path = str(tmp_path / f"s{n}")
        base = spark.range(40).where(F.col("id") % 7 != n)
        if n == 1:
            base = base.unionByName(base.where("id < 3"))
        df = base.select((F.col("id") % 2).alias("line_id"), at.alias("timestamp"), F.col("id").alias(f"v{n}"))
        for low in range(0, 40, 10 if n else 40):
            df.where(F.col(f"v{n}").between(low, low + (9 if n else 39))).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
        sources.append((df, stream))
    keys = ("line_id", "timestamp")
    gathered = windows.run_update(windows.align_streams([s for _, s in sources], keys), str(tmp_path / "out"), keys)
    got = sorted(tuple(r) for r in windows.aligned(gathered, keys).collect())
    batch = sources[0][0]
    for df, _ in sources[1:]:
        batch = batch.join(df, list(keys))
    assert got == sorted(tuple(r) for r in batch.collect()) and len(got) > 15


def test_state_of_aligned_instants_is_dropped(spark, tmp_path):
    schema = "line_id long, timestamp timestamp, a long"
    path = str(tmp_path / "a")
    for k in range(3):
        rows = spark.range(50).selectExpr("0 AS line_id", f"timestamp_seconds({k} * 100000 + id) AS timestamp", "id AS a")
        rows.coalesce(1).write.mode("append").parquet(path)
    one = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    both = windows.align_streams([one, one.withColumnRenamed("a", "b")])
    query = (
        both.writeStream.foreachBatch(lambda batch, number: batch.count())
        .outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    assert all(len(s) == 1 for s in states)
    assert states[-1][0]["numRowsTotal"] <= 50 < 150


def test_thin_slices_stay_apart(spark):
    from catalog import queries as Q

    rows = [(0, 0)] + [(k, 900 + k % 90) for k in range(1, 400)]
    df = spark.createDataFrame(rows, "event_id long, t_us long")
    seen = []
    session = Q._stream_session(spark)
    stream = Q._stream_source(session, df)

    def note(batch, number):
        seen.append([r.t_us for r in batch.collect()])

    run = stream.writeStream.foreachBatch(note).trigger(availableNow=True).start()
    run.awaitTermination()
    assert sum(map(len, seen)) == 400
    assert any(times == [0] for times in seen)


def test_state_is_held_on_disk(spark, tmp_path):
    """The stream queries' sessions keep state in RocksDB, with bounded memory, not as
    objects in the heap; instants that come in two batches still meet."""
    from catalog import queries as Q

    session = Q._stream_session(spark)
    streams = []
    for n, name in enumerate("ab"):
        path = str(tmp_path / name)
        for k in (n, 1 - n):
            rows = session.range(20).where(F.col("id") % 2 == k)
            rows.selectExpr("1 AS line_id", "timestamp_seconds(3600 + id) AS timestamp", f"id AS {name}").coalesce(1).write.mode("append").parquet(path)
        schema = f"line_id int, timestamp timestamp, {name} long"
        streams.append(session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
    gathered, found = windows.align_streams(streams), []
    keys = ("line_id", "timestamp")
    sink = windows.Upserts(str(tmp_path / "out"), gathered.schema, keys)
    query = (
        gathered.writeStream.foreachBatch(sink).outputMode("update")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    for p in query.recentProgress:
        found += [name for state in p["stateOperators"] for name in state["customMetrics"]]
    assert any(name.startswith("rocksdb") for name in found)
    assert session.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"
    rows = windows.aligned(sink.latest(session), keys).collect()
    assert sorted((r.a, r.b) for r in rows) == [(k, k) for k in range(20)]
