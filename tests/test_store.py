import random
import sqlite3
import zlib

import pytest
from pyspark.sql import functions as F

from textmill.functions import codec
from textmill.operators import store
from textmill.plans import skew
from textmill.sources import sqlite_source


@pytest.mark.parametrize(("algo", "level"), [("zlib", 6), ("gz", 9), ("lz4", 1), ("zstd", 3), ("zlib", 0)])
def test_codecs(spark, algo, level):
    df = spark.createDataFrame([("test content for compression",), ("",), ("é\x00",), (None,)], "t string")
    packed = df.select("t", codec.compress(F.col("t"), level, algo).alias("d"))
    assert packed.select("t", codec.decompress(F.col("d"), algo, level).alias("u")).where("not (t <=> u)").count() == 0


def test_codec_errors_and_default(spark):
    with pytest.raises(ValueError):
        codec.compress(F.col("t"), 6, "rar")
    row = spark.createDataFrame([(bytearray(zlib.compress(b"x")), None)], "d binary, a string")
    assert row.select(codec.decompress(F.col("d"), F.col("a"))).first()[0] == "x"


def test_merge_golden(spark):
    base = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"y"))], "id long, data binary")
    other = spark.createDataFrame([(2, bytearray(b"z")), (3, bytearray(b"x")), (4, bytearray(b"w"))], "id long, data binary")
    merged = {r.id: bytes(r.data) for r in store.merge_stores(base, other).collect()}
    assert merged == {1: b"x", 2: b"y", 4: b"w"}
    merged = {r.id: bytes(r.data) for r in store.merge_stores(base, other, keys=("data",)).collect()}
    assert merged == {1: b"x", 2: b"y", 3: b"z", 4: b"w"}


@pytest.mark.parametrize("seed", range(4))
def test_insert_or_ignore_against_sqlite(spark, monkeypatch, seed):
    """Two unique keys at once, NULLs never clash, earlier rows win."""
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, *range(8)])
    there = [(1000, 1, 20), (1001, 21, 2)]
    rows = [(i, pick(), pick()) for i in range(40)]
    db = sqlite3.connect(":memory:")
    db.execute("create table t (seq, a unique, b unique)")
    db.executemany("insert or ignore into t values (?, ?, ?)", there + rows)
    wanted = sorted(r[0] for r in db.execute("select seq from t where seq < 1000"))
    frame = lambda data: spark.createDataFrame(data, "seq long, a int, b int")
    found = store.insert_or_ignore(frame(there), frame(rows), ["a", "b"], "seq")
    assert sorted(r.seq for r in found.collect()) == wanted


def test_insert_single_key_with_nulls(spark):
    frame = lambda data: spark.createDataFrame(data, "seq long, a string")
    found = store.insert_or_ignore(frame([(0, "x")]), frame([(1, "x"), (2, "y"), (3, "y"), (4, None), (5, None)]), ["a"], "seq")
    assert sorted(r.seq for r in found.collect()) == [2, 4, 5]


def test_composite_key(spark):
    frame = lambda data: spark.createDataFrame(data, "seq long, seed int, word string, data binary")
    there = frame([(0, 1, "w", bytearray(b"x"))])
    rows = [(1, 1, "w", bytearray(b"x")), (2, 1, "v", bytearray(b"x")), (3, 1, "v", bytearray(b"x")), (4, None, "w", bytearray(b"x")), (5, None, "w", bytearray(b"x"))]
    found = store.insert_or_ignore(there, frame(rows), [("seed", "word", "data")], "seq", long_keys=True)
    assert sorted(r.seq for r in found.collect()) == [2, 4, 5]


def test_append_and_read(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("root", "hello there", 2)], "word string, text string, tok int")
    store.append_generations(rows.select("word", codec.compress(F.col("text")).alias("data"), "tok"), path)
    back = store.read_store(spark, path)
    assert back.where("created_at is not null and seed is null").count() == 1
    assert store.store_texts(back).collect() == [("root", "hello there")]
    plan = back.select("word")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<word:string>" in plan
    store.write_text(rows, str(tmp_path / "txt"))
    store.write_text(rows, str(tmp_path / "txt"))
    assert spark.read.text(str(tmp_path / "txt")).count() == 2


def test_migrate_skips_archive_and_null_words(spark):
    pack = lambda t: bytearray(zlib.compress(t.encode()))
    rows = [(1, "a", pack("one two")), (2, "archive", pack("old")), (3, None, pack("none")), (4, "b", pack("one two")), (5, "b", None), (6, "c", pack("kept"))]
    source = spark.createDataFrame(rows, "id long, word string, data binary").withColumn("compression_algo", F.lit(None).cast("string"))
    target = spark.createDataFrame([(pack("kept"),)], "data binary")
    for bloom in (None, {"power2": 20, "k": 4}):
        assert [(r.id, r.word, r.tok) for r in store.migrate_archive(source, target, bloom=bloom).collect()] == [(1, "archive", 2)]


def test_rates_and_empty_total(spark):
    rows = spark.createDataFrame([("a", 10, 2.0), ("a", 5, 0.0)], "word string, tok int, td double")
    assert sorted(r.rate for r in store.generation_rate(rows).collect()) == [0.0, 5.0]
    assert store.run_rate(rows).first().run_rate == 7.5
    assert store.total_tokens(rows.limit(0)).first()[0] == 0


def test_latest_three(spark):
    df = spark.createDataFrame([("f", i) for i in range(5)] + [("g", 1)], "name string, mtime int")
    rows = store.latest_n(df, ["name"], "mtime", 3).collect()
    assert sorted((r.name, r.mtime) for r in rows if r.expired) == [("f", 0), ("f", 1)] and len(rows) == 6


def test_sqlite_source(spark, tmp_path):
    for name, base in (("a", 0), ("b", 100)):
        db = sqlite3.connect(tmp_path / f"{name}.db")
        db.execute("create table texts (id integer primary key, seed int, model text, word text, data blob not null unique, tok int, compression_algo text, created_at timestamp default current_timestamp)")
        db.executemany("insert into texts (id, word, data, tok) values (?, ?, ?, ?)", [(base + i, "w", zlib.compress(f"{name}{i}".encode()), i) for i in range(1, 26)])
        db.execute("create table prompts (id integer primary key, prompt text not null unique)")
        db.execute("insert into prompts (prompt) values (?)", (f" {name} ",))
        db.commit()
        db.close()
    sqlite_source.register(spark)
    texts = spark.read.format("texts_sqlite").option("rows", 10).load(str(tmp_path))
    assert texts.rdd.getNumPartitions() == 6
    assert texts.where("created_at is not null").count() == 50
    assert {r.text for r in store.store_texts(texts).collect()} == {f"{n}{i}" for n in "ab" for i in range(1, 26)}
    prompts = spark.read.format("texts_sqlite").option("table", "prompts").load(str(tmp_path / "a.db"))
    assert prompts.collect() == [(1, " a ")]
    with pytest.raises(Exception, match="unknown table"):
        spark.read.format("texts_sqlite").option("table", "x").load(str(tmp_path)).collect()


def test_compression_ratio_counts_characters(spark):
    text = "é" * 50 + "abc"
    rows = spark.createDataFrame([(text,)], "text string").select("text", codec.compress(F.col("text"), 6).alias("data"))
    assert store.compression_ratio(rows).first().ratio == len(text) / len(zlib.compress(text.encode(), 6))


def test_rows_without_ids_are_numbered_and_survive(spark, tmp_path):
    path = str(tmp_path / "written")
    rows = spark.createDataFrame([(f"text {i}".encode(),) for i in range(5)], "data binary").withColumn("word", F.lit("w")).withColumn("compression_algo", F.lit("none"))
    store.append_generations(rows, path)
    store.append_generations(rows, path)
    written = store.read_store(spark, path)
    assert sorted(r.id for r in written.collect()) == list(range(1, 11))
    first = written.where("id <= 5").cache()
    blank = first.withColumn("id", F.when(F.col("id") > 5, F.col("id")))
    for keys in (("id", "data"), ("data",)):
        assert store.merge_stores(first.limit(0), blank, keys).count() == 5
        assert store.merge_stores(first, blank, keys).count() == 5
    with pytest.raises(Exception, match="NULL in id"):
        store.insert_or_ignore(first.limit(0), blank, ["data"], "id").collect()


def test_prompt_log_of_many_pieces(spark):
    pieces = spark.range(5001).select(F.struct(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"), F.col("id").alias("pos")).alias("at"), F.concat(F.lit("p"), "id").alias("prompt"))
    again = pieces.withColumn("at", F.struct(F.lit(1).alias("conv_id"), F.lit(2).alias("turn"), F.col("at.pos").alias("pos")))
    log = spark.createDataFrame([], "prompt string")
    assert store.log_prompts(log, pieces.unionAll(again), "at").count() == 5001


def test_merged_rows_are_ranked_by_their_ids_alone(spark):
    """Whole rows, with their data, were put in order by blocks of 200,000 (F24); an id that comes twice still gives two numbers."""
    from textmill.operators import store

    base = spark.createDataFrame([(7, b"a"), (2, b"b")], "id long, data binary")
    other = spark.createDataFrame([(9, b"c"), (1, b"a"), (4, b"d"), (5, b"f")], "id long, data binary")
    merged = store.merge_stores(base, other, keys=("data",))
    windows = [x for x in merged._jdf.queryExecution().optimizedPlan().toString().split("\n") if " Window [" in x or "- Window [" in x]
    assert not any("data" in x for x in windows) and "Window" not in merged._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert {(r.id, bytes(r.data)) for r in merged.collect()} == {(7, b"a"), (2, b"b"), (8, b"d"), (9, b"f"), (10, b"c")}

    twice = other.unionAll(spark.createDataFrame([(4, b"e")], other.schema))
    found = {r.id: bytes(r.data) for r in store.merge_stores(base, twice, keys=("data",)).collect()}
    assert {i: found[i] for i in (7, 2, 10, 11)} == {7: b"a", 2: b"b", 10: b"f", 11: b"c"}
    assert {found[8], found[9]} == {b"d", b"e"} and len(found) == 6
