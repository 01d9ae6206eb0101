"""Raw files to bronze, silver and gold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import constants as K
from millrace.operators.ordered import add_features, rebuild_hidden
from millrace.operators.shards import SHARD, Series, shard
from millrace.operators.unify import HOT_ROWS, unify
from millrace.session import use_utc
from millrace.sources.layers import (
    DAY,
    load_gold,
    read_bronze,
    read_layer,
    write_bronze,
    write_layer,
)
from millrace.sources.raw import load_raw, mask

LINE = "line_id"


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def bronze(spark: SparkSession, raw: dict[str, DataFrame], root: str) -> None:
    """Store each raw source, the conveyor without its hidden signals.

    The seven writes are independent jobs and are submitted together.
    """

    def store(name: str) -> None:
        df = mask(raw[name]) if name == "conveyor" else raw[name]
        write_bronze(df, layer_path(root, "bronze", name))

    with ThreadPoolExecutor(len(K.SOURCES)) as pool:
        list(pool.map(store, K.SOURCES))


def unified(
    spark: SparkSession, root: str, line: str | None = None, keep: tuple[str, ...] = (LINE,)
) -> DataFrame:
    """Bronze sources joined on (line, instant).

    Files of a plant with one line carry no line column; name it in ``line``. An instant
    that very many rows share is spread over tasks.
    """
    sources = []
    for name in K.SOURCES:
        df = read_bronze(spark, layer_path(root, "bronze", name), keep)
        if line is not None:
            df = df.withColumn(LINE, F.lit(line))
        if name != "conveyor":
            df = df.drop(K.TIME_TEXT, "timestamp", DAY)
        sources.append(df)
    return unify(sources, hot_rows=HOT_ROWS)


def silver(
    spark: SparkSession,
    root: str,
    line: str | None = None,
    ties: tuple[str, ...] = (),
    keep: tuple[str, ...] = (LINE,),
    whole_seconds: bool = False,
    rows_per_shard: int | None = None,
) -> DataFrame:
    """Join the sources and rebuild the hidden signals.

    The join is stored before the ordered part, so that counting and cutting
    it into shards does not run it again; as it is read back whole, it is
    written as it falls, without another exchange. The silver table keeps its
    ``shard`` column: gold uses the same cuts.
    """
    joined = layer_path(root, "silver", "joined")
    series = Series(LINE, "t_us", ties)
    unified(spark, root, line, keep).write.mode("overwrite").parquet(joined)
    sharded = shard(read_layer(spark, joined), series, rows_per_shard)
    rebuilt = rebuild_hidden(sharded, whole_seconds=whole_seconds).df
    path = layer_path(root, "silver", "integrated")
    # Rows lie by line and shard, a short stretch of time: they are written as they lie.
    write_layer(rebuilt, path, (LINE, *series.order), arrange=False)
    return read_layer(spark, path)


def gold(
    spark: SparkSession,
    root: str,
    ties: tuple[str, ...] = (),
    include_extra: bool = False,
) -> DataFrame:
    """Motion, rolling, bottleneck and label features over silver."""
    series = Series(LINE, "t_us", ties)
    source = read_layer(spark, layer_path(root, "silver", "integrated"))
    features = add_features(shard(source, series), include_extra).df
    path = layer_path(root, "gold", "features")
    write_layer(features, path, (LINE, *series.order), arrange=False)
    return load_gold(spark, path)


def run(
    spark: SparkSession,
    paths: dict[str, str],
    root: str,
    line: str = "line-1",
    rows_per_shard: int | None = None,
) -> DataFrame:
    """The whole pipeline over the seven raw files of one line."""
    use_utc(spark)
    raw = {
        name: load_raw(spark, paths[name], [K.TIME_TEXT, *K.SOURCE_COLUMNS[name]])
        for name in K.SOURCES
    }
    bronze(spark, raw, root)
    silver(spark, root, line=line, rows_per_shard=rows_per_shard)
    return gold(spark, root)


def gold_columns(df: DataFrame) -> DataFrame:
    """Gold without the layout columns."""
    return df.drop(DAY, SHARD)
