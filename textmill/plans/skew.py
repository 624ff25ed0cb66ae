"""Joins on keys of which one may hold a large share of the rows.

A key is split over as many tasks as its rows call for. Which keys are hot, and over how many
tasks each goes, follows from counted rows: a key is left whole while it has fewer than
``HOT_ROWS`` rows, or less than one ``HOT_SHARE``-th of all rows, which is below the mean load
of a task in any job of up to ``HOT_SHARE`` tasks. So the table of hot keys has at most
``HOT_SHARE`` rows of two numbers, whatever the size of the data, and may be broadcast; the
copies made of the other side are at most twice as many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.plans.lineage import materialize

# Rows of one key that a task takes.
HOT_ROWS = 200_000
# Most hot keys there can be: 4 MB of (hash, salts) pairs.
HOT_SHARE = 1 << 18


def _hot(counts: DataFrame, threshold_of: DataFrame) -> DataFrame:
    """``(_h, _salts)`` of the hot keys of ``counts(_h, _rows)``; totals come from ``threshold_of(_rows)``."""
    total = threshold_of.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    threshold = F.greatest(F.lit(float(HOT_ROWS)), total / F.lit(float(HOT_SHARE)))
    hot = counts.where(F.col("_rows") >= threshold)
    return hot.groupBy("_h").agg(F.ceil(F.max(F.col("_rows") / threshold)).cast("int").alias("_salts"))


def _salted(rows: DataFrame, keys: list[str], hot: DataFrame, spread_by: Column) -> DataFrame:
    tagged = rows.withColumn("_h", F.xxhash64(*keys)).join(F.broadcast(hot), "_h", "left")
    salt = F.when(F.col("_salts") > 1, F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")).otherwise(0)
    return tagged.withColumn("_salt", salt).drop("_salts")


def _copied(other: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    tagged = other.withColumn("_h", F.xxhash64(*keys)).join(F.broadcast(hot), "_h", "left")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    return tagged.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    weight: str,
    spread_by: str,
    how: str = "inner",
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (unique on ``key``; ``weight`` = its rows in ``rows``, about).

    Rows of a hot key are split by ``spread_by``. Both sides are sorted by a hash before the
    key, which spares comparing texts.
    """
    values = [c for c in lookup.columns if c not in (key, weight)]
    hot = _hot(
        lookup.select(F.xxhash64(key).alias("_h"), F.col(weight).alias("_rows")), lookup.select(F.col(weight).alias("_rows"))
    )
    joined = _salted(rows, [key], hot, F.col(spread_by)).join(
        _copied(lookup.select(key, *values), [key], hot), ["_h", "_salt", key], how
    )
    return joined.select(*rows.columns, *values)


def hot_values(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """Written ``(_h, _salts)`` of the key values with very many rows; None when there are none.

    Reads ``rows`` more than once: pass a written table or a cheap scan.
    """
    if rows.limit(HOT_ROWS).count() < HOT_ROWS:  # too few rows for any key to be hot
        return None
    counts = rows.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.count("*").alias("_rows"))
    hot = materialize(_hot(counts, counts.select("_rows")), "hot")
    return None if hot.isEmpty() else hot


def salted_join(
    rows: DataFrame,
    other: DataFrame,
    keys: list[str],
    hot: DataFrame | None,
    spread_by: Column,
    how: str = "inner",
) -> DataFrame:
    """Join on ``keys``; values found by ``hot_values`` are split over their number of tasks.

    Only the matching rows of ``other`` are copied per salt. A hash collision costs a few
    extra copies and changes nothing.
    """
    if hot is None:
        return rows.join(other, keys, how)
    joined = _salted(rows, keys, hot, spread_by).join(_copied(other, keys, hot), [*keys, "_h", "_salt"], how)
    return joined.drop("_h", "_salt")
