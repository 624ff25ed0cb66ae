"""Cutting lineage with tables written to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if context.master.split("[")[0] != "local":  # nor local-cluster, which has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
    return context._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Survives executor loss like a reliable checkpoint, but stays columnar: later
    steps read only the columns they use, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/textmill/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Dealt:
    """A written table that grows by parts, dealt by ``keys`` into ``buckets`` files each.

    A join or grouping by ``keys`` reads it where it lies, so only the other side moves. Bucketed, so it has a name in the session's catalog.
    """

    def __init__(self, spark: SparkSession, label: str, keys: list[str], buckets: int) -> None:
        self.spark, self.keys, self.buckets = spark, keys, buckets
        self.name = f"textmill_{label}_{uuid.uuid4().hex}"
        self.path = f"{scratch_dir(spark)}/textmill/{self.name}"
        self.parts = 0

    def add(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` as the next part and return a scan of them. Rows that are dealt by ``keys`` already are not moved."""
        dealt = self.deal(rows).withColumn("_part", F.lit(self.parts))
        writer = dealt.write.mode("append").partitionBy("_part").bucketBy(self.buckets, *self.keys)
        writer.option("path", self.path).option("compression", "zstd").saveAsTable(self.name)
        self.parts += 1
        return self.part(self.parts - 1)

    def deal(self, rows: DataFrame) -> DataFrame:
        """``rows`` moved to where those of the table lie."""
        return rows.repartition(self.buckets, *self.keys)

    def part(self, number: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("_part") == number).drop("_part")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("_part")
