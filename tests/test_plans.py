import random

import pytest
from pyspark.sql import functions as F

from textmill.plans import global_rank, lineage, lookup_join, ordering, range_bounds, running_sum, salted_join, skew
from textmill.plans.layout import bounded_broadcast


@pytest.mark.parametrize("kind", ["long", "string"])
def test_running_sum_and_rank(spark, monkeypatch, kind):
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 10)
    rng = random.Random(3)
    keys = rng.sample(range(10_000), 500)
    rows = [(f"{k:05d}" if kind == "string" else k, rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(0, 9)) for k in keys]
    df = spark.createDataFrame(rows, f"seq {kind}, word string, tok int")
    bounds = range_bounds(df, "seq")
    assert len(bounds) > 30
    totals, wanted = {}, {}
    for seq, word, tok in sorted(rows, key=lambda r: r[0]):
        totals[word] = totals.get(word, 0) + tok
        wanted[seq] = totals[word]
    assert {r.seq: r.s for r in running_sum(df, "tok", "seq", "s", ["word"]).collect()} == wanted
    ranks = {r.seq: r.n for r in global_rank(df, "seq", "n").collect()}
    assert ranks == {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: r[0]))}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_with_hot_keys(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "HOT_ROWS", 30)
    rows = spark.createDataFrame([(i, "the" if i % 2 else f"w{i % 9}") for i in range(300)], "doc long, term string")
    lookup = spark.createDataFrame([("the", 150, 1.0), ("w0", 40, None), ("w2", 9, 2.0), ("w4", 8, 3.0)], "term string, n int, v double")
    key = lambda r: (r.doc, r.term, r.v or 0.0)
    wanted = rows.join(lookup.drop("n"), "term", how).select("doc", "term", "v").collect()
    found = lookup_join(rows, lookup, "term", "n", "doc", how)
    assert found.columns == ["doc", "term", "v"]
    assert sorted(map(key, found.collect())) == sorted(map(key, wanted))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(200)], "id long, k string")
    other = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    hot = skew.hot_values(rows, ["k"])
    assert [r["_salts"] for r in hot.collect()] == [3]
    wanted = sorted(map(str, rows.join(other, "k", how).collect()))
    assert sorted(map(str, salted_join(rows, other, ["k"], hot, F.col("id"), how).collect())) == wanted


def test_every_key_beyond_the_threshold_is_split(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 4)
    rows = spark.range(1500 * 10).select("id", (F.col("id") % 1500).alias("k"))
    hot = skew.hot_values(rows, ["k"])
    assert hot.groupBy("_salts").count().collect() == [(3, 1500)]
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    parts = skew._salted(rows, ["k"], hot, F.col("id")).groupBy("k", "_salt").count()
    assert parts.select("k").distinct().count() == 1500 and parts.count() > 3000
    assert lookup_join(rows, lookup, "k", "n", "id").where("top % 1500 = k").count() == 15_000


def test_hot_table_is_bounded_by_the_share(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    rows = spark.range(100).select(F.when(F.col("id") < 30, 0).otherwise(F.col("id")).alias("k"))
    assert [r["_salts"] for r in skew.hot_values(rows, ["k"]).collect()] == [3]


def test_bounded_broadcast(spark):
    df = spark.range(10)
    assert bounded_broadcast(df, 10)[1] is True
    assert bounded_broadcast(df, 9)[1] is False


@pytest.mark.parametrize("url", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_needs_a_shared_folder(url):
    class NoDir:
        def isDefined(self):
            return False

    class Context:
        master = url

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": lambda self: NoDir()})()

    session = type("Session", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda *_: None)})})
    with pytest.raises(RuntimeError):
        lineage.scratch_dir(session)
