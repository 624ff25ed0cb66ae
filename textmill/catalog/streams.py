"""Streams over the driver tables, run until all present files are read; results are written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.catalog import repeats
from textmill.catalog.common import LINES, sql_strip, sql_words, table
from textmill.catalog.loading import ORACLE as LOADING
from textmill.catalog.loading import pieces_of
from textmill.functions import text as tx
from textmill.functions.codec import compress, decompress
from textmill.operators import language, store
from textmill.operators.ledger import Ledger
from textmill.plans import scratch_dir
from textmill.streaming import queries as sq
from textmill.streaming import stateful

BATCHES = 6
DAY = 24 * 3600 * 1000


def _stream(spark, folder, name):
    # The pattern serves both a single file and a folder of part files.
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def _lines(spark, folder):
    docs = _stream(spark, folder, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.select((F.shiftleft("doc_id", 32) + F.col("pos")).alias("seq"), tx.strip(F.col("line")).alias("line"))


def _arriving(spark, folder, name):
    """The table as a stream of ``BATCHES`` micro-batches; a table of fewer files is written anew in that many."""
    rows = table(spark, folder, name)
    files = len(rows.inputFiles())
    if files >= BATCHES:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // BATCHES))
        return stream.parquet(f"{folder}/{name}.parque[t]")
    place = f"{scratch_dir(spark)}/textmill/arriving-{uuid.uuid4().hex}"
    rows.repartition(BATCHES).write.parquet(place)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(place)


def _run(rows: DataFrame, sink, mode: str = "append") -> str:
    """Run to the end; returns the folder the sink, given that folder, wrote to."""
    place = f"{scratch_dir(rows.sparkSession)}/textmill/stream-{uuid.uuid4().hex}"
    writer = rows.writeStream.outputMode(mode).trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{place}/progress").foreachBatch(sink(place)).start()
    query.awaitTermination()
    return place


def _append(place):
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{place}/out/batch={number}")


def _replace(place):
    """For complete mode: the newest batch holds the whole result."""
    return lambda batch, _: batch.write.mode("overwrite").parquet(f"{place}/out")


def _first_seen(spark, folder):
    place = _run(sq.first_seen(_lines(spark, folder).select("line")), _append)
    return spark.read.parquet(f"{place}/out").select("line")


def _bloom(spark, folder):
    place = _run(
        _lines(spark, folder),
        lambda p: sq.bloom_sink(f"{p}/out", f"{p}/bits", order="seq", **repeats.DEDUPE_FILTER),
    )
    return spark.read.parquet(f"{place}/out").select("line")


def _languages(spark, folder):
    model = language.train(table(spark, folder, "documents"))
    first = sq.first_seen(_lines(spark, folder).select("line"))
    place = _run(first, lambda p: sq.language_sink(f"{p}/out", model))
    routed = spark.read.text(f"{place}/out")
    return routed.groupBy("lang").agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))


def _insert(spark, folder):
    rows = _lines(spark, folder).select(F.lit("archive").alias("word"), compress(F.col("line"), 9).alias("data"), tx.token_count(F.col("line")).alias("tok"))
    place = _run(rows, lambda p: sq.insert_sink(f"{p}/out"))
    found = store.read_store(spark, f"{place}/out")
    return found.select(decompress(F.col("data"), F.col("compression_algo")).alias("line"), F.col("tok").cast("long").alias("tok"))


def _assemble(spark, folder):
    pieces = pieces_of(_stream(spark, folder, "conversations"))
    place = _run(sq.assemble_stream(pieces), _replace, "complete")
    return spark.read.parquet(f"{place}/out").select("response_id", "text", F.col("tok").cast("long").alias("tok"))


def _totals(spark, folder):
    docs = _arriving(spark, folder, "documents").select(
        F.col("source").alias("word"), tx.token_count(F.col("text")).alias("tok")
    )
    place = _run(sq.running_totals(docs), lambda p: sq.keyed_sink(f"{p}/out"), "update")
    return sq.latest_of(spark.read.parquet(f"{place}/out"), "word")


def _forgetting(spark, folder):
    """First-seen lines over several batches, each forgotten after a day."""
    docs = _arriving(spark, folder, "documents")
    rows = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).select(tx.strip(F.col("line")).alias("line"))
    with stateful.with_disk_state(spark):
        place = _run(stateful.first_seen_for(rows, DAY), _append)
    return spark.read.parquet(f"{place}/out").select("line")


def _responses(spark, folder):
    """Responses told once, at their last piece; the pieces of a response come in several batches."""
    talk = table(spark, folder, "conversations")
    pieces = pieces_of(talk).withColumn("last", F.lit(False))
    # NULL pieces take numbers of their own, so numbers are closed up before the last one is marked
    line = F.transform(
        F.sort_array(F.collect_list(F.struct("seq", "delta"))), lambda p, i: F.struct(i.cast("long").alias("seq"), p["delta"].alias("delta"))
    )
    told = pieces.groupBy("response_id").agg(line.alias("line")).select("response_id", F.size("line").alias("n"), F.explode("line").alias("p"))
    told = told.select("response_id", "p.seq", "p.delta", (F.col("p.seq") == F.col("n") - 1).alias("last"))
    place = f"{scratch_dir(spark)}/textmill/pieces-{uuid.uuid4().hex}"
    told.repartition(BATCHES, F.xxhash64("response_id", "seq")).write.parquet(place)
    arriving = spark.readStream.schema(told.schema).option("maxFilesPerTrigger", 1).parquet(place)
    with stateful.with_disk_state(spark):
        place = _run(stateful.assemble_responses(arriving, DAY), _append)
    return spark.read.parquet(f"{place}/out").select("response_id", "text", F.col("tok").cast("long").alias("tok"), "complete")


def _insert_indexed(spark, folder):
    """Lines of several batches into a ledger; equal lines of later batches are ignored."""
    docs = _arriving(spark, folder, "documents").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    lines = docs.select(tx.strip(F.col("line")).alias("line")).select(
        F.lit("archive").alias("word"), compress(F.col("line"), 9).alias("data"), tx.token_count(F.col("line")).alias("tok")
    )
    place = _run(lines, lambda p: sq.ledger_sink(Ledger(spark, f"{p}/out"), "lines"))
    found = Ledger(spark, f"{place}/out").table("texts")
    return found.select(decompress(F.col("data"), F.col("compression_algo")).alias("line"), F.col("tok").cast("long").alias("tok"))


QUERIES = {
    "stream_first_seen": _first_seen,
    "stream_bloom_dedupe": _bloom,
    "stream_language_routing": _languages,
    "stream_insert_or_ignore": _insert,
    "stream_assemble_chunks": _assemble,
    "stream_running_totals": _totals,
    "stream_first_seen_expiring": _forgetting,
    "stream_responses": _responses,
    "stream_insert_indexed": _insert_indexed,
}

_STRIPPED = f"(select seq, {sql_strip('line')} as line from {LINES})"

ORACLE = {
    "stream_first_seen": f"select distinct line from {_STRIPPED}",
    "stream_bloom_dedupe": f"""
        with bits as {repeats.bits_sql(_STRIPPED, 'line', repeats.DEDUPE_FILTER, 'seq,')},
        firsts as (select seq, min(seq) over (partition by idx) as first from bits),
        passed as (select seq from firsts group by seq having max(first) >= seq)
        select line from {_STRIPPED} join passed using (seq)""",
    "stream_language_routing": LOADING["lines_by_language"].replace(
        """,
               min(seq) as first_seq, max(seq) as last_seq""",
        "",
    ),
    "stream_insert_or_ignore": f"select distinct line, len({sql_words('line')}) as tok from {_STRIPPED}",
    "stream_assemble_chunks": LOADING["assemble_chunks"],
    "stream_first_seen_expiring": f"select distinct line from {_STRIPPED}",
    "stream_responses": LOADING["assemble_chunks"].replace("as tok from", "as tok, true as complete from") + " where text <> ''",
    "stream_insert_indexed": f"select distinct line, len({sql_words('line')}) as tok from {_STRIPPED}",
    "stream_running_totals": f"""
        select source as word, cast(sum(len({sql_words('text')})) as bigint) as total_tokens, count(*) as generations
        from documents group by source""",
}
