"""Layers refreshed part by part, a day or any other stretch of time, instead of whole.

A part needs of its past the state that every line had at the end of the part before
(last statuses, release and transit) and each line's last rows, as far as the longest
rolling mean reaches. Both are stored with a part, so a new part reads nothing older. Its
tables are written to fresh folders first; then one small file of the manifest says where
they lie. A run that ends midway leaves folders that no manifest names, and the layers as
they were; running it again writes new ones.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace import constants as K
from millrace.functions.columns import interpolated_drive2
from millrace.operators.ordered import add_features
from millrace.operators.shards import SHARD, Series, shard, small
from millrace.operators.unify import HOT_ROWS, unify
from millrace.streaming import transit as live

SILVER, GOLD, STATE, TAIL = "silver", "gold", "state", "tail"
_MANIFEST = "version bigint, layer string, part string, path string"


class PartedLayers:
    """Silver and gold of all parts below ``root``. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, series: Series, include_extra: bool = False):
        self.spark, self.root, self.series = spark, root.rstrip("/"), series
        self.include_extra = include_extra

    def entries(self) -> dict[tuple[str, str], str]:
        """Where each (layer, part) lies, by the newest manifest entry that names it."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        return {(r.layer, r.part): r.path for r in sorted(rows, key=lambda r: r.version)}

    def parts(self) -> list[str]:
        return sorted({part for _, part in self.entries()})

    def read(self, layer: str, first: str | None = None, last: str | None = None) -> DataFrame:
        """A layer's rows, of the parts from ``first`` to ``last`` only if these are given."""
        paths = [
            path
            for (own, part), path in sorted(self.entries().items())
            if own == layer and (first is None or part >= first) and (last is None or part <= last)
        ]
        return self.spark.read.parquet(*paths)

    def publish(self, part: str, paths: dict[str, str]) -> None:
        """Names the tables of a part, in one file, which is what commits them."""
        version = 1 + max((r[0] for r in self._versions()), default=0)
        rows = [(version, layer, part, path) for layer, path in paths.items()]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def _versions(self) -> list:
        if not self.entries():
            return []
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest").select("version").distinct().collect()

    def refresh(self, part: str, sources: list[DataFrame], rows_per_shard: int | None = None) -> None:
        """Adds a part, or makes the last one anew. Parts sort as text.

        ``sources`` are the part's bronze rows, ready to join. Every row has to be later
        than its line's rows in the parts before; a part older than the last one would
        change what follows it, and is refused.
        """
        known = self.parts()
        if known and part < known[-1]:
            raise ValueError(f"part {part} is older than {known[-1]}; refresh the later parts after it")
        before = [p for p in known if p < part]
        run = f"{self.root}/parts/{part}/{uuid.uuid4().hex}"
        line, order = self.series.line, self.series.order

        def store(df: DataFrame, layer: str) -> DataFrame:
            df.write.parquet(f"{run}/{layer}")
            return self.spark.read.schema(df.schema).parquet(f"{run}/{layer}")

        joined = store(unify(sources, hot_rows=HOT_ROWS), "joined")
        joined = joined.withColumn(K.temperature(2), interpolated_drive2())
        if before:
            state, tail = self.read(STATE, before[-1], before[-1]), self.read(TAIL, before[-1], before[-1])
            self._refuse_early(joined, state)
        else:
            state = self.spark.createDataFrame([], ", ".join(live._state_schema(self.series, joined)))
            tail = None
        stepped = store(live.transit_step(joined, state, self.series, rows_per_shard), "stepped")
        store(live.next_state(stepped, self.series), STATE)
        own = stepped.where(~F.col(live._SEED)).select(*joined.columns, K.TRANSIT)
        silver = store(own.sortWithinPartitions(line, *order), SILVER)
        rows = silver.withColumn("_old", F.lit(False))
        if tail is not None:
            rows = rows.unionByName(tail.withColumn("_old", F.lit(True)))
        featured = add_features(shard(rows, self.series, rows_per_shard), self.include_extra).df
        store(featured.where(~F.col("_old")).drop("_old", SHARD).sortWithinPartitions(line, *order), GOLD)
        back = Window.partitionBy(line).orderBy(*[F.desc(c) for c in order])
        last = rows.drop("_old").withColumn("_back", F.row_number().over(back))
        store(last.where(F.col("_back") <= K.MEAN_LONG + 1).drop("_back"), TAIL)
        self.publish(part, {layer: f"{run}/{layer}" for layer in (SILVER, GOLD, STATE, TAIL)})

    def _refuse_early(self, joined: DataFrame, state: DataFrame) -> None:
        line, order = self.series.line, self.series.order
        first = joined.groupBy(line).agg(F.min(F.struct(*order)).alias("_first"))
        marks = state.select(F.col(line).alias("_line"), F.struct(*order).alias("_mark"))
        early = first.join(small(marks), F.col(line).eqNullSafe(F.col("_line"))).where("_first <= _mark")
        if not early.isEmpty():
            raise ValueError("rows that are not later than those of the parts before")
