import os
import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textmill.functions.codec import compress
from textmill.operators import dedupe, language, store
from textmill.operators.ledger import Ledger
from textmill.streaming import queries as sq
from textmill.streaming import stateful

BATCHES = [["a", " b ", "a"], ["b", "c", "the dog barks"], ["c", "d", "die Katze"]]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i, lines in enumerate(BATCHES):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(lines) + "\n")
        os.utime(tmp_path / "in" / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))  # arrival order
    return tmp_path


def run(df, folder, sink=None, mode="append", name="out"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", str(folder / f"cp-{name}")).trigger(availableNow=True)
    writer = writer.foreachBatch(sink) if sink else writer.format("memory").queryName(name)
    query = writer.start()
    query.awaitTermination()


def stream(spark, folder):
    return sq.read_line_stream(spark, str(folder / "in"), maxFilesPerTrigger="1")


def batch(spark):
    lines = [x.strip() for b in BATCHES for x in b]
    return spark.createDataFrame(list(enumerate(lines)), "seq long, line string")


def test_first_seen(spark, folder):
    run(sq.first_seen(stream(spark, folder)), folder, name="seen")
    got = sorted(r.line for r in spark.table("seen").collect())
    assert got == sorted(r.line for r in dedupe.distinct_texts(batch(spark), "line", "seq").collect())


def test_first_seen_with_event_time(spark, folder):
    timed = stream(spark, folder).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    run(sq.first_seen(timed, event_time="ts"), folder, name="timed")
    assert spark.table("timed").count() == 6


@pytest.mark.parametrize("power2", [4, 20])
def test_bloom_sink_matches_batch_and_replays(spark, folder, power2):
    sink = sq.bloom_sink(str(folder / "lines"), str(folder / "bits"), power2=power2, k=2)
    run(stream(spark, folder), folder, sink, name=f"bloom{power2}")
    wanted = sorted(r.line for r in dedupe.dedupe_bloom(batch(spark), "line", "seq", power2=power2, k=2).collect())
    read = lambda: sorted(r.line for r in spark.read.parquet(str(folder / "lines")).collect())
    assert read() == wanted
    again = spark.read.text(str(folder / "in" / "2.txt")).select(F.trim("value").alias("line"))
    sink(again, 2)
    assert read() == wanted


def test_language_sink(spark, folder):
    known = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de")], "text string, lang string")
    model = language.train(known)
    run(sq.first_seen(stream(spark, folder)), folder, sq.language_sink(str(folder / "langs"), model), name="langs")
    back = {(r.value, r.lang) for r in spark.read.text(str(folder / "langs")).collect()}
    assert back == {(r.line, r.lang) for r in language.route_languages(batch(spark), model).collect()}


def test_insert_sink_adds_each_row_once(spark, folder):
    rows = stream(spark, folder).select(F.lit("w").alias("word"), compress(F.col("line")).alias("data"), F.lit(1).alias("tok"))
    sink = sq.insert_sink(str(folder / "store"))
    run(rows, folder, sink, name="insert")
    sink(batch(spark).select(F.lit("w").alias("word"), compress(F.col("line")).alias("data"), F.lit(1).alias("tok")), 9)
    back = store.store_texts(store.read_store(spark, str(folder / "store")))
    assert sorted(r.text for r in back.collect()) == sorted({x.strip() for b in BATCHES for x in b})


def test_assembled_responses_and_totals(spark, folder, monkeypatch):
    pieces = [(1, 2, "c"), (1, 0, "a"), (1, 1, None), (2, 0, "x "), (2, 5000, "y"), (1, 3, "b")]
    chunks = spark.createDataFrame(pieces, "response_id long, seq long, delta string")
    wanted = [(1, "acb", 1), (2, "x y", 2)]
    assert sorted(map(tuple, sq.assemble_chunks(chunks).collect())) == wanted
    chunks.repartition(3).write.parquet(str(folder / "pieces"))
    arriving = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "pieces"))
    run(sq.assemble_stream(arriving), folder, mode="complete", name="assembled")
    assert sorted(map(tuple, spark.table("assembled").collect())) == wanted
    totals = arriving.select(F.col("response_id").cast("string").alias("word"), F.lit(2).alias("tok"))
    run(sq.running_totals(totals), folder, mode="complete", name="totals")
    assert sorted(map(tuple, spark.table("totals").collect())) == [("1", 8, 4), ("2", 4, 2)]


def arriving(spark, folder, name, schema, batches, start=0):
    """A stream of one micro-batch for each list of rows; further batches may be added to the folder later."""
    for i, rows in enumerate(batches, start):
        (folder / name).mkdir(exist_ok=True)
        place = folder / name / f"{i}.parquet"
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), place)
        os.utime(place, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / name))


def told(spark, folder, df, name):
    """Run to the end of what is there; the rows written so far and the state's size after each batch."""
    out = str(folder / f"out-{name}")
    with stateful.with_disk_state(spark):
        query = df.writeStream.outputMode("append").option("checkpointLocation", str(folder / f"cp-{name}")).trigger(availableNow=True)
        query = query.format("parquet").option("path", out).start()
        query.awaitTermination()
    assert spark.conf.get(stateful.PROVIDER) != stateful.DISK_STORE
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]]
    return spark.read.schema(df.schema).parquet(out).collect(), sizes


def test_first_seen_over_batches(spark, folder):
    batches = [[(f"l{(i * 3 + j) % 10}",) for j in range(4)] for i in range(6)]
    rows, sizes = told(spark, folder, stateful.first_seen_for(arriving(spark, folder, "seen-in", "line string", batches), 3_600_000), "seen-for")
    assert sorted(r.line for r in rows) == [f"l{i}" for i in range(10)] and len(sizes) == 6 and sizes[-1] == 10


def test_first_seen_forgets(spark, folder):
    batches = [[("again",), *[(f"{i}-{j}",) for j in range(20)]] for i in range(6)]
    rows, sizes = told(spark, folder, stateful.first_seen_for(arriving(spark, folder, "forget-in", "line string", batches), 1), "forget")
    assert sum(r.line == "again" for r in rows) == 6 and len(rows) == 126
    assert len(sizes) == 6 and max(sizes) <= 42  # what came in the last batch or two, not all 121


PIECE = "response_id long, seq long, delta string, last boolean"


def test_responses_are_told_once_and_evicted(spark, folder):
    batches = [
        [(1, 0, "a", False), (2, 1, "y", True), (3, 0, "never ", False)],
        [(1, 2, "c", True), (2, 0, "x ", False), (1, 0, "a", False)],
        [(1, 1, None, False), (4, 0, "one", True)],
        [(2, 0, "late", False), (1, 2, "late", True)],
        [(3, 2, "ends", False)],
        [(5, 0, "z", None)],
    ]
    df = stateful.assemble_responses(arriving(spark, folder, "pieces-in", PIECE, batches), 3_600_000)
    rows, sizes = told(spark, folder, df, "responses")
    assert sorted((r.response_id, r.text, r.tok, r.complete) for r in rows) == [(1, "ac", 1, True), (2, "x y", 2, True), (4, "one", 1, True)]
    assert len(sizes) == 6


def test_responses_end_at_their_time_limit(spark, folder):
    batches = [[(1, 0, "a ", False), (1, 2, "c", False)], [(2, 0, "b", True)]]
    df = lambda more, start: stateful.assemble_responses(arriving(spark, folder, "limit-in", PIECE, more, start), 500)
    told(spark, folder, df(batches, 0), "limit")
    time.sleep(1.5)
    rows, sizes = told(spark, folder, df([[(9, 0, "x", True)]], 2), "limit")
    assert sorted((r.response_id, r.text, r.complete) for r in rows) == [(1, "a c", False), (2, "b", True), (9, "x", True)]
    time.sleep(1.5)
    rows, sizes = told(spark, folder, df([[(10, 0, "y", True)]], 3), "limit")
    assert len(rows) == 4 and sizes[-1] <= 4  # nothing of the first three is held


def test_ledger_sink_knows_its_batches(spark, folder):
    rows = stream(spark, folder).select(F.lit("w").alias("word"), compress(F.col("line")).alias("data"), F.lit(1).alias("tok"))
    book = Ledger(spark, str(folder / "book"))
    sink = sq.ledger_sink(book, "lines")
    run(rows, folder, sink, name="ledger")
    texts = lambda: sorted(r.text for r in store.store_texts(book.table("texts")).collect())
    wanted = sorted({x.strip() for b in BATCHES for x in b})
    assert texts() == wanted and book.commits().count() == 3
    again = batch(spark).select(F.lit("w").alias("word"), compress(F.concat("line", F.lit("?"))).alias("data"), F.lit(1).alias("tok"))
    sink(again, 2)  # a batch that was committed before
    assert texts() == wanted


def test_keyed_sink_keeps_the_newest_row(spark, folder):
    rows = stream(spark, folder).select(F.col("line").alias("word"), F.lit(2).alias("tok"))
    run(sq.running_totals(rows), folder, sq.keyed_sink(str(folder / "totals")), mode="update", name="keyed")
    found = sq.latest_of(spark.read.parquet(str(folder / "totals")), "word")
    assert {r.word: (r.total_tokens, r.generations) for r in found.collect()} == {"a": (4, 2), "b": (4, 2), "c": (4, 2), "d": (2, 1), "the dog barks": (2, 1), "die Katze": (2, 1)}


def test_responses_are_handled_by_part(spark, folder, monkeypatch):
    """Few groups, however many responses; any order, repeats, NULL ids, ends that come late."""
    monkeypatch.setattr(stateful, "GROUPS", 4)
    rng = random.Random(5)
    wanted, rows = {}, []
    for i in [None, *range(60)]:
        n = rng.randint(1, 9)
        deltas = [rng.choice(["a ", "b", None, "語\n"]) for _ in range(n)]
        wanted[i] = "".join(d or "" for d in deltas)
        rows += [(i, s, d, s == n - 1) for s, d in enumerate(deltas)] + ([(i, 0, deltas[0], n == 1)] if i and i % 5 == 0 else [])
    rng.shuffle(rows)
    df = stateful.assemble_responses(arriving(spark, folder, "parts-in", PIECE, [rows[k::4] for k in range(4)]), 3_600_000)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "TransformWithStateInPySpark [part" in plan or "[part#" in plan.split("TransformWithState")[1].split("\n")[0]
    found, sizes = told(spark, folder, df, "parts")
    assert sorted(((r.response_id, r.text, r.complete) for r in found), key=repr) == sorted(((i, t, True) for i, t in wanted.items()), key=repr)
    assert sizes[0] < len(rows) // 4  # no entry for each piece
