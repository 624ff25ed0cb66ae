"""Exact top-k search by vector-approximation files (``op3_exact_topk``).

Vectors are integer grids (``floor(256 * x)``); equal vectors are one entry with its k+1 smallest ids, so a vector that
fills a third of the table is as cheap as any. Two tables are written: the approximation file (for blocks of entries, each
vector's components in ``2**BITS`` cells of its own width s, one byte each) and the exact file (one row an entry).
For a query q the product with the cells c bounds the score: ``s*q.c + (s-1)*sum(min(q,0)) <= q.v <= s*q.c + (s-1)*sum(max(q,0))``.

Phase 1 scans the approximation alone. Blocks of entries are dealt into groups, blocks of queries are sent to every group; a task
keeps for each query the k+1 highest lower bounds met so far and passes on the entries whose upper bound reaches the last of them. The same limit
over all tasks leaves the candidates. Phase 2 reads exact vectors in the order of their upper bounds: the first ``FIRST`` of
each query, then, if the k+1-th best exact score is not above all bounds that are left, those whose bound reaches it. No other exact vector is read.

A query's own row is taken out at the end; rows are identified by id. Queries with equal vectors are searched once, and their rows are
dealt over tasks by counted rows.

Rows with a null id, a null vector, or null or non-finite components take no part. Rows equal in id and vector count
once. Vectors of another length than the query's are no candidates. Components beyond 64 bits and scores beyond them are held at
the limits. An empty table gives no rows; a query with fewer than k candidates returns them all. Ties go to the smaller id. Only named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm import kit
from textmill.plans import hot_values, salted_join

K = 5
EVERY = 50
BITS = 8
SCALE = 256.0
ENTRY_BLOCK = 4096  # entries of a block
QUERY_BLOCK = 1024
GROUP_ROWS = 16_384  # entries that share one copy of the query blocks
FIRST = 32  # exact vectors of a query that are read at once


def approximate(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell width of each vector and its cells."""
    most = np.maximum(np.abs(values.astype(np.float64)).max(1, initial=0), 1)
    width = np.maximum(np.ceil((most + 1) / (1 << (bits - 1))), 1)
    return width, np.floor(values / width[:, None]).astype(np.int8)


CELLS = "dim int, entries binary, rows binary, width binary, cells binary"
ASKING = "dim int, reps binary, grid binary"


def packed(kind: str, size: int, bits: int = BITS):
    """Rows (id, rows, grid) to blocks: of entries with their cells, or of queries with their exact values."""

    def block(own: list) -> pd.DataFrame:
        ids, rows, grids = zip(*own)
        values = np.array(grids, np.int64).reshape(len(own), -1)
        held = {"dim": [values.shape[1]], "entries": [np.array(ids, np.int64).tobytes()]}
        if kind == "query":
            return pd.DataFrame(held | {"grid": [values.tobytes()]}).rename(columns={"entries": "reps"})
        width, cells = approximate(values, bits)
        return pd.DataFrame(held | {"rows": [np.array(rows, np.int32).tobytes()], "width": [width.tobytes()], "cells": [cells.tobytes()]})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        for batch in batches:
            for row in zip(batch["id"], batch["rows"], batch["grid"]):
                own = waiting.setdefault(len(row[2]), [])
                own.append(row)
                if len(own) == size:
                    yield block(own)
                    own.clear()
        for own in waiting.values():
            if own:
                yield block(own)

    return rows


def bounds(queries: np.ndarray, width: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (queries x entries) of the products."""
    asked = queries.astype(np.float64)
    dots = asked @ cells.T.astype(np.float64) * width
    # rounding of sums beyond 53 bits
    most = max(1, queries.shape[1]) * np.abs(asked).max(initial=1.0) * (width * 128.0)
    slack = np.where(most < 2**52, 0.0, most * 1e-12)
    plus, minus = (f(asked, 0).sum(1)[:, None] for f in (np.maximum, np.minimum))
    return dots + (width - 1) * minus - slack, dots + (width - 1) * plus + slack


def nth_best(scores: np.ndarray, rows: np.ndarray, n: int) -> float:
    """The score that the n-th best row reaches at least, from scores of entries that stand for several rows each."""
    order = np.argsort(-scores, kind="stable")
    place = np.searchsorted(np.cumsum(rows[order]), n)
    return float(scores[order[place]]) if place < len(order) else -math.inf


BOUNDED = "rep long, entry long, rows int, lower double, upper double"


def scan(n: int):
    """Blocks of entries joined with blocks of queries to ``BOUNDED`` rows that may be among the n best rows of a query."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sure: dict[bytes, np.ndarray] = {}  # of each query block: the score each query's n-th best row reaches, so far
        for batch in batches:
            for b in batch.itertuples():
                reps, entries = np.frombuffer(b.reps, np.int64), np.frombuffer(b.entries, np.int64)
                held, width = np.frombuffer(b.rows, np.int32), np.frombuffer(b.width, np.float64)
                queries = np.frombuffer(b.grid, np.int64).reshape(len(reps), b.dim)
                lower, upper = bounds(queries, width, np.frombuffer(b.cells, np.int8).reshape(len(entries), b.dim))
                key = b.reps[:8] + len(b.reps).to_bytes(8, "little")
                best = sure.setdefault(key, np.full(len(reps), -math.inf))
                most = min(n, len(entries))
                kept = np.argpartition(-lower, most - 1, axis=1)[:, :most]
                for q in range(len(reps)):
                    best[q] = max(best[q], nth_best(lower[q, kept[q]], held[kept[q]], n))
                place, entry = np.nonzero(upper >= best[:, None])
                yield pd.DataFrame({"rep": reps[place], "entry": entries[entry], "rows": held[entry], "lower": lower[place, entry], "upper": upper[place, entry]})

    return rows


def exact_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, entry, q, v) to (rep, entry, score); products beyond 62 bits by whole numbers of any size, held at 64 bits."""
    low, high = -(1 << 63), (1 << 63) - 1
    for batch in batches:
        if not batch.num_rows:
            continue
        q, v = (batch.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
        sizes = batch.column(2).value_lengths().to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes)])
        size = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * max(1, int(sizes.max()))
        if size < 2**62:
            total = np.concatenate([[0], np.cumsum(q * v)]) if size * batch.num_rows < 2**62 else None
            if total is None:
                scores = np.array([int(q[a:b] @ v[a:b]) for a, b in zip(starts[:-1], starts[1:])], np.int64)
            else:
                scores = total[starts[1:]] - total[starts[:-1]]
        else:
            scores = np.array([min(max(sum(int(x) * int(y) for x, y in zip(q[a:b], v[a:b])), low), high) for a, b in zip(starts[:-1], starts[1:])], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=["rep", "entry", "score"])


def grids(vectors: DataFrame) -> DataFrame:
    """vec_id and grid (array of longs) of the rows that take part, once each."""
    x = F.col("embedding")
    whole = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    grid = F.transform(x, lambda v: F.floor(F.lit(SCALE) * v.cast("double")))
    return vectors.where(F.col("vec_id").isNotNull() & whole).select(F.col("vec_id").cast("long").alias("vec_id"), grid.alias("grid"))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, bits: int = BITS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for every row of ``queries`` (both vec_id, embedding)."""
    spark = vectors.sparkSession
    folder = kit.scratch(spark)
    n = k + 1  # rows a search keeps: one may be the query's own
    alike = F.md5(F.concat_ws(",", F.col("grid").cast("array<string>"))).alias("code")  # equal vectors have one code

    # the two files
    nth = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    few = grids(vectors).distinct().withColumn("code", alike).withColumn("nth", nth).where(F.col("nth") <= n)
    exact = few.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("grid").alias("grid"))
    exact = kit.written(exact.select(F.col("ids")[0].alias("entry"), "ids", "grid"), folder, "exact")
    rows = exact.select(F.col("entry").alias("id"), F.size("ids").alias("rows"), "grid")
    cells = kit.written(rows.mapInPandas(packed("entry", ENTRY_BLOCK, bits), CELLS), folder, "cells")

    asked = kit.written(grids(queries).distinct().withColumn("code", alike), folder, "asked")
    reps = kit.written(asked.groupBy("code").agg(F.min("vec_id").alias("rep"), F.first("grid").alias("grid")), folder, "reps")
    blocks = reps.select(F.col("rep").alias("id"), F.lit(1).alias("rows"), "grid").mapInPandas(packed("query", QUERY_BLOCK), ASKING)

    # phase 1: the approximation alone
    groups = max(1, math.ceil(exact.count() / GROUP_ROWS))
    dealt = cells.withColumn("group", F.pmod(F.xxhash64("entries"), F.lit(groups)).cast("int"))
    sent = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    met = kit.written(dealt.join(sent.hint("shuffle_hash"), ["group", "dim"]).mapInPandas(scan(n), BOUNDED), folder, "met")
    by_lower = Window.partitionBy("rep").orderBy(F.desc("lower"), "entry")
    so_far = F.sum("rows").over(by_lower.rowsBetween(Window.unboundedPreceding, 0))
    top = met.withColumn("nth", F.row_number().over(by_lower)).where(F.col("nth") <= n).withColumn("so_far", so_far)
    sure = top.where(F.col("so_far") >= n).groupBy("rep").agg(F.max("lower").alias("sure"))
    left = met.join(sure, "rep", "left").where(F.col("sure").isNull() | (F.col("upper") >= F.col("sure"))).select("rep", "entry", "upper")
    by_upper = Window.partitionBy("rep").orderBy(F.desc("upper"), "entry")
    left = kit.written(left.withColumn("place", F.row_number().over(by_upper)), folder, "left")

    # phase 2: exact vectors, best bounds first
    def scored(pairs: DataFrame) -> DataFrame:
        both = pairs.select("rep", "entry").join(reps.select("rep", F.col("grid").alias("q")), "rep").join(exact.select("entry", F.col("grid").alias("v")), "entry")
        return both.select("rep", "entry", "q", "v").mapInArrow(exact_scores, "rep long, entry long, score long").join(exact.select("entry", "ids"), "entry")

    first = kit.written(scored(left.where(F.col("place") <= FIRST)), folder, "first")
    order = [F.col("score").desc(), F.col("vec_id")]

    def best_rows(found: DataFrame) -> DataFrame:
        each = found.select("rep", "score", F.explode("ids").alias("vec_id"))
        return each.withColumn("nth", F.row_number().over(Window.partitionBy("rep").orderBy(*order))).where(F.col("nth") <= n)

    reached = best_rows(first).where(F.col("nth") == n).select("rep", F.col("score").alias("reached"))
    more = left.where(F.col("place") > FIRST).join(reached, "rep", "left").where(F.col("reached").isNull() | (F.col("upper") >= F.col("reached")))
    second = kit.written(scored(more), folder, "second")
    best = kit.written(best_rows(first.unionByName(second)).drop("nth"), folder, "best")

    rep_of = reps.select("code", "rep")
    owned = kit.written(salted_join(asked.select("code", F.col("vec_id").alias("query_id")), rep_of, ["code"], hot_values(asked, ["code"]), F.col("query_id")), folder, "owned")
    kit.keep_only(spark, folder, ("best", "owned"))
    own = Window.partitionBy("query_id").orderBy(*order)
    return (
        salted_join(owned, best, ["rep"], hot_values(owned, ["rep"]), F.col("query_id")).where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kit.tables(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors.where(F.col("vec_id") % EVERY == 0), vectors)


ORACLE = f"""
with usable as (select vec_id, [cast(floor({SCALE} * cast(x as double)) as bigint) for x in embedding] as grid from embeddings
  where vec_id is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
parts as (select vec_id, unnest(range(1, len(grid) + 1)) as i, unnest(grid) as x from usable),
scores as (select q.vec_id as query_id, v.vec_id, cast(sum(q.x * v.x) as bigint) as score
  from parts q join parts v on q.i = v.i and q.vec_id <> v.vec_id where q.vec_id % {EVERY} = 0 group by all),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= {K}
"""

QUERIES = {"op3_exact_topk": op3_exact_topk}
ORACLE_SQL = {"op3_exact_topk": ORACLE}
