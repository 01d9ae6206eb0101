"""Joining the raw sources into one wide row per line and instant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.shards import small
from millrace.session import checkpointed

KEYS = ("line_id", "t_us")
# An instant with more rows than this in one source is worth spreading.
HOT_ROWS = 200_000
# How often such an instant is expected in the sample of the keys, and how often it must be.
SAMPLE_HITS, LEAST_HITS = 64, 24
# Pieces a source's rows of one instant are cut into at most; the instant has as many
# cells as the product of its sources' pieces.
MOST_PIECES, MOST_CELLS = 256, 4096
_CELL = "_cell"


def unify(sources: list[DataFrame], keys: tuple[str, ...] = KEYS, hot_rows: int | None = None) -> DataFrame:
    """Inner join on the shared keys; every source is exchanged once.

    Rows without a readable time match nothing. Repeated keys multiply, as in
    any inner join. The key is (line, instant), which spreads even one dominant
    line over all tasks.

    With ``hot_rows`` an instant that many rows of a source share is spread as well. A
    sample of the keys shows about how many rows each such instant has in each source.
    They are cut into pieces of at most about ``hot_rows``; a cell of the instant takes
    one piece of every source, and rows are copied to the cells of their piece. All cells
    together hold every combination once, so the result is the same, and what the
    sample misses or misjudges costs time only.
    """
    seen: set[str] = set()
    for df in sources:
        names = {c.lower() for c in df.columns} - {k.lower() for k in keys}
        if seen & names:
            raise ValueError(f"columns in more than one source: {sorted(seen & names)}")
        seen |= names
    on = list(keys)
    hot = hot_instants(sources, keys, hot_rows) if hot_rows else None
    if hot is not None:
        sources = [_in_cells(df, n, hot, keys) for n, df in enumerate(sources)]
        on.append(_CELL)
    joined = reduce(lambda left, right: left.join(right, on, "inner"), sources)
    return joined.drop(_CELL)


def hot_instants(sources: list[DataFrame], keys: tuple[str, ...], hot_rows: int) -> DataFrame | None:
    """``keys, pieces`` (one number for each source) of the instants worth spreading.

    None if there is none. One job over the key columns of all sources, of which a
    sample is counted; the table has at most a row for each ``hot_rows`` rows or so.
    """
    share = min(1.0, SAMPLE_HITS / hot_rows)
    least = LEAST_HITS if share < 1.0 else hot_rows + 1
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    sampled = reduce(
        DataFrame.unionByName,
        [df.select(*keys, F.lit(n).alias("_source")).where(known) for n, df in enumerate(sources)],
    )
    if share < 1.0:
        sampled = sampled.sample(share, seed=29)
    counts = sampled.groupBy(*keys, "_source").agg(F.count(F.lit(1)).alias("_n"))
    pieces = F.least(F.ceil(F.col("_n") / F.lit(share * hot_rows)), F.lit(MOST_PIECES))
    by_source = F.map_from_entries(F.collect_list(F.struct("_source", pieces.cast("int"))))
    hot = counts.where(F.col("_n") >= least).groupBy(*keys).agg(by_source.alias("_by"))
    # Too many cells are fewer pieces of each source that has more than one.
    hot = hot.selectExpr(
        *keys,
        f"transform(sequence(0, {len(sources) - 1}), n -> coalesce(_by[n], 1)) AS _all",
        f"pow({MOST_CELLS} / aggregate(map_values(_by), 1D, (a, p) -> a * p), 1D / size(_by)) AS _share",
    ).selectExpr(
        *keys,
        "transform(_all, p -> cast(greatest(1, floor(p * least(1D, _share))) AS int)) AS _pieces",
    )
    hot = checkpointed(hot)
    return None if hot.isEmpty() else hot


def _in_cells(df: DataFrame, number: int, hot: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The source's rows, in every cell of their instant that takes their piece.

    The number of cell c in this source's pieces is (c div stride) mod pieces, as of a
    digit; rows are dealt to the pieces in turn.
    """
    placed = df.withColumn("_row", F.monotonically_increasing_id()).join(small(hot), list(keys), "left")
    cells = f"""
        CASE WHEN _pieces IS NULL THEN array(0) ELSE filter(
            sequence(0, aggregate(_pieces, 1, (a, p) -> a * p) - 1),
            c -> (c DIV aggregate(slice(_pieces, 1, {number}), 1, (a, p) -> a * p)) % _pieces[{number}]
                = pmod(_row, _pieces[{number}])
        ) END"""
    return placed.withColumn(_CELL, F.explode(F.expr(cells))).drop("_row", "_pieces")
