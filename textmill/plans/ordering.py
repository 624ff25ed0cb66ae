"""Ranks and running totals without a single-task window.

A plain ``sum() over (order by ...)`` puts each window partition into one task, and
one partition key may hold a large share of all rows. Here the order column is cut
into range blocks: totals per block are summed over the few blocks, and rows are only
ordered inside their own block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows that one task puts in order.
BLOCK_ROWS = 200_000
# Cut points are literals of the plan, so there are at most this many; beyond BLOCK_ROWS times
# this many rows the blocks grow, and their sorts spill.
MOST_BLOCKS = 1 << 14
PROBES_PER_BLOCK = 16


def range_bounds(df: DataFrame, order: str, block_rows: int | None = None) -> list:
    """Cut points that split ``order`` into about equal parts, one for each ``block_rows`` rows (``BLOCK_ROWS``).

    Probes the order column only: about ``PROBES_PER_BLOCK`` values per block, those whose
    hash falls below a limit. The choice affects balance, never results.
    """
    column = df.select(F.col(order).alias("v")).where(F.col("v").isNotNull())
    rows = column.count()
    blocks = min(-(-rows // (block_rows or BLOCK_ROWS)), MOST_BLOCKS)
    if blocks < 2:
        return []
    share = blocks * PROBES_PER_BLOCK / rows
    probes = column.where(F.pmod(F.xxhash64("v"), F.lit(1 << 32)) < int(min(1.0, share) * (1 << 32))).distinct()
    values = sorted(r["v"] for r in probes.collect())
    step = max(1, -(-len(values) // blocks))
    return values[step::step]


def block_of(order: Column, bounds: list) -> Column:
    """Number of the range block an order value falls into, found in two short searches."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    cuts = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    group = F.size(F.filter(heads, lambda cut: cut <= order)) - 1
    return F.get(
        F.transform(
            F.array(group),
            lambda g: F.when(g < 0, 0).otherwise(g * width + F.size(F.filter(F.get(cuts, g), lambda c: c <= order))),
        ),
        F.lit(0),
    )


def running_sum(
    df: DataFrame,
    value: str,
    order: str,
    out: str,
    partition: list[str] | None = None,
    bounds: list | None = None,
    block: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: sum of ``value`` up to and including the row, in ``order``, per ``partition``.

    ``order`` must be unique within a partition. ``block`` names a column that already
    holds ``block_of(order, bounds)``. ``counted``: cheaper rows with the same totals of
    ``value`` per partition and ``block``.
    """
    keys = list(partition or [])
    bounds = range_bounds(df, order) if bounds is None else bounds
    # A number before the keys spares comparing texts when rows are sorted.
    place = [F.xxhash64(*keys).alias("_place")] if keys else []
    spot = ["_place", *keys] if keys else []

    def numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
        number = F.col(block) if block else block_of(F.col(order), bounds)
        return rows.select(*columns, *place, number.alias("_blk"))

    within = W.partitionBy(*spot, "_blk").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    rows = numbered(df, df.columns).withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
    if not bounds:
        return rows.select(*df.columns, out)

    totals = numbered(df if counted is None else counted, [*keys, value]).groupBy(*spot, "_blk")
    before = W.partitionBy(*spot).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.agg(F.sum(value).alias("_sum")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(spot)],
        F.col("_blk").alias("_b"),
        F.sum("_sum").over(before).alias("_before"),
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per block: at most MOST_BLOCKS
    match = F.col("_blk") == F.col("_b")
    for i, k in enumerate(spot):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(offsets, match, "left")
    return joined.select(*df.columns, (F.col(out) + F.coalesce("_before", F.lit(0))).alias(out))


def wide_rank(df: DataFrame, order: str, out: str) -> DataFrame:
    """As ``global_rank``, for rows with long values: a block holds ``order`` alone, and whole rows are not brought in order.

    Reads ``df`` more than once: pass a written table or a cheap scan. ``order`` must not be NULL.
    """
    places = global_rank(df.select(F.col(order).alias("_at")), "_at", out)
    return df.join(places, F.col(order) == F.col("_at")).drop("_at")


def global_rank(df: DataFrame, order: str, out: str, bounds: list | None = None) -> DataFrame:
    """Add ``out``: 1-based position of the row in ``order`` over the whole table."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sum(ones, "_one", order, out, bounds=bounds).drop("_one")
