"""Streams over lines, generations and response chunks.

Sinks that update tables run in ``foreachBatch`` and may see a batch twice after a
failure; each is written so that the second run adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import schemas
from textmill.functions.text import strip, token_count
from textmill.operators import dedupe, language, store
from textmill.operators.ledger import Ledger
from textmill.plans import materialize
from textmill.sources.tables import read_if_there

# First level of assembling a response; a group holds at most this many pieces.
PIECES = 4096


def read_line_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``(line)`` of files arriving in a folder."""
    reader = spark.readStream
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.text(path).select(strip(F.col("value")).alias("line"))


def first_seen(lines: DataFrame, line: str = "line", event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Each line once. State grows with the distinct lines, unless ``event_time`` bounds it to ``delay``."""
    if event_time is None:
        return lines.dropDuplicates([line])
    return lines.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([line])


def assemble_chunks(chunks: DataFrame) -> DataFrame:
    """``(response_id, text, tok)``: pieces joined in ``seq`` order, NULL pieces left out.

    Joined in runs first, so a response in very many pieces is sorted in parallel.
    """
    piece = F.struct("seq", "delta")
    joined = lambda name: F.array_join(F.transform(F.sort_array(name), lambda p: p["delta"]), "")
    runs = (
        chunks.where(F.col("delta").isNotNull())
        .groupBy("response_id", F.floor(F.col("seq") / PIECES).alias("run"))
        .agg(F.collect_list(piece).alias("_pieces"))
        .select("response_id", "run", joined("_pieces").alias("delta"))
    )
    texts = runs.groupBy("response_id").agg(F.collect_list(F.struct("run", "delta")).alias("_runs"))
    return texts.select("response_id", joined("_runs").alias("text")).withColumn("tok", token_count(F.col("text")))


def assemble_stream(chunks: DataFrame) -> DataFrame:
    """Streaming form, one aggregation; run it in update or complete mode."""
    grouped = chunks.where(F.col("delta").isNotNull()).groupBy("response_id").agg(
        F.collect_list(F.struct("seq", "delta")).alias("_pieces")
    )
    text = F.array_join(F.transform(F.sort_array("_pieces"), lambda p: p["delta"]), "")
    return grouped.select("response_id", text.alias("text")).withColumn("tok", token_count(F.col("text")))


def running_totals(rows: DataFrame) -> DataFrame:
    """Tokens and generations per word so far; run it in update or complete mode."""
    return store.tokens_by_root(rows)


def insert_sink(path: str, keys: tuple[str, ...] = ("data",)) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: add the rows of a batch that the store does not hold yet."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = materialize(
            store._shaped(batch).withColumn("_order", F.monotonically_increasing_id()), "batch"
        )
        there = read_if_there(spark, path, schemas.TEXTS)
        fresh = store.insert_or_ignore(there, rows, list(keys), "_order", long_keys=True)
        store.numbered(fresh.drop("_order"), there).write.mode("append").parquet(path)

    return write


def ledger_sink(ledger: Ledger, stream: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: commit the new rows of each batch as run ``<stream>-<number>``.

    A batch that comes again is known by its run. Stored texts are not read, only the touched part of the index.
    """

    def write(batch: DataFrame, number: int) -> None:
        ledger.commit(f"{stream}-{number}", texts=batch.withColumn("_order", F.monotonically_increasing_id()))

    return write


def keyed_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for update mode: the changed rows of each batch, under its number; see ``latest_of``."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def latest_of(rows: DataFrame, key: str) -> DataFrame:
    """The newest row of each key among those of a ``keyed_sink``."""
    values = F.struct(*[c for c in rows.columns if c not in (key, "batch")])
    return rows.groupBy(key).agg(F.max_by(values, "batch").alias("_row")).select(key, "_row.*")


def bloom_sink(
    path: str, bits: str, line: str = "line", order: str | None = None, **filter_args
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: append the lines a Bloom filter lets through.

    ``bits`` holds ``(batch, idx)`` and stays within the filter's size. Lines and bits
    are written under their batch number, and a batch ignores bits of its own number, so
    running it again gives the same lines in the same place. ``order`` ranks the lines of a
    batch; without it they go as they arrive.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = materialize(
            batch.select(line, (F.col(order) if order else F.monotonically_increasing_id()).alias("_order")), "bloom-batch"
        )
        old = read_if_there(spark, bits, "idx long, batch long").where(F.col("batch") != number)
        probes = rows.select("_order", F.explode(dedupe.bloom_indexes(F.col(line), **filter_args)).alias("idx"))
        earliest = probes.groupBy("idx").agg(F.min("_order").alias("_first"))
        fresh = materialize(earliest.join(old.select("idx"), "idx", "left_anti"), "bloom-bits")
        kept = rows.join(fresh.select("_first").distinct(), F.col("_order") == F.col("_first"), "left_semi")
        kept.select(line).write.mode("overwrite").parquet(f"{path}/batch={number}")
        fresh.select("idx").write.mode("overwrite").parquet(f"{bits}/batch={number}")

    return write


def language_sink(
    path: str, model: language.LanguageModel, line: str = "line"
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: write each line to the folder of its language, per batch."""

    def write(batch: DataFrame, number: int) -> None:
        if model.judge:
            labelled = batch.select(line, model.judge(F.lower(F.col(line))).alias("lang"))
        else:
            rows = materialize(batch.select(line).withColumn("_order", F.monotonically_increasing_id()), "lang-batch")
            labelled = rows.join(language.detect(rows, model, line, "_order"), "_order")
        labelled.select("lang", F.col(line).alias("value")).write.mode("overwrite").partitionBy("lang").text(
            f"{path}/batch={number}"
        )

    return write
