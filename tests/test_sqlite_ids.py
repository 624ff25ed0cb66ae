"""Stores without ids, the log with responses, and id comparisons that reach SQLite."""

import contextlib
import sqlite3

import pytest

from textmill.sources import sqlite_source

PUSH = "spark.sql.python.filterPushdown.enabled"


@pytest.fixture
def package_store(tmp_path):
    path = tmp_path / "package.db"
    with contextlib.closing(sqlite3.connect(path)) as db:
        db.execute("create table texts (seed, model, word, data, tok, compression_algo, primary key (seed, model, word, data))")
        db.executemany("insert into texts values (?, ?, ?, ?, ?, ?)", [(None, "m", f"w{i}", f"text {i}".encode(), i, "zlib") for i in range(25)])
        db.execute("create table prompts (id integer primary key, prompt text, response text, compression_level integer, timestamp text)")
        db.executemany("insert into prompts values (?, ?, ?, ?, ?)", [(i * 10, f"p{i}", None if i % 2 else f"r{i}", 6, "2024-05-01 10:00:00") for i in range(8)])
        db.commit()
    return str(path)


def read(spark, path, **options):
    sqlite_source.register(spark)
    reader = spark.read.format("texts_sqlite").option("path", path)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def test_store_without_ids(spark, package_store):
    df = read(spark, package_store, rows="10")
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(1, 26)) and df.rdd.getNumPartitions() == 3
    assert bytes(rows[4].data) == b"text 4" and rows[4].seed is None and rows[4].created_at is None


def test_log_with_responses(spark, package_store):
    rows = sorted(read(spark, package_store, table="prompt_responses").collect(), key=lambda r: r.id)
    assert [(r.id, r.prompt, r.response) for r in rows[:2]] == [(0, "p0", "r0"), (10, "p1", None)] and rows[0].timestamp.year == 2024
    assert [r.prompt for r in sorted(read(spark, package_store, table="prompts").collect(), key=lambda r: r.id)] == [f"p{i}" for i in range(8)]
    with pytest.raises(Exception, match="unknown table"):
        read(spark, package_store, table="other").collect()


def test_id_comparisons_reach_the_file(spark, package_store):
    before = spark.conf.get(PUSH)
    spark.conf.set(PUSH, "true")
    try:
        df = read(spark, package_store, rows="5", push="true").where("id > 7 and id <= 12 and word <> 'w8'")
        assert df.rdd.getNumPartitions() == 1  # row numbers 8 to 12 alone
        assert sorted(r.id for r in df.collect()) == [8, 10, 11, 12]
        log = read(spark, package_store, table="prompt_responses", push="true").where("id = 30")
        assert [r.prompt for r in log.collect()] == ["p3"]
    finally:
        spark.conf.set(PUSH, before)
