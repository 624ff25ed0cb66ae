"""Input spreading and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows and bytes of a lookup that every executor may hold; beyond either the join is shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
# An input below this size per core has fewer splits than cores.
SPLIT_BYTES = 128 << 20
# Estimated bytes of input, which is compressed, for each bucket of a table that is dealt by keys.
BUCKET_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input with few splits; leave wide inputs alone, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if planned_bytes(df) < cores * SPLIT_BYTES else df


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate, which costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame) -> int:
    """Buckets of tables that are dealt like ``df``: the shuffle partitions, fewer for a small input."""
    spark = df.sparkSession
    wanted = max(spark.sparkContext.defaultParallelism, -(-planned_bytes(df) // BUCKET_BYTES))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast only when its rows and the bytes of their values are counted and within the limits.

    The count stops at the limit of rows. Pass a written table (``materialize``) or a cheap scan.
    """
    size = F.octet_length(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]))) if df.columns else F.lit(0)
    found = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    fits = found["rows"] <= max_rows and found["bytes"] <= max_bytes
    return (F.broadcast(df), True) if fits else (df, False)
