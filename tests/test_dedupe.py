import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textmill.functions.bloom import bloom_indexes
from textmill.operators import dedupe


def positions(item, power2=27, k=8):
    h = int.from_bytes(hashlib.sha256(item.encode()).digest(), "big")
    return [(h >> ((k - 1 - i) * (256 // k))) & ((1 << power2) - 1) for i in range(k)]


def test_golden_indexes(spark):
    df = spark.createDataFrame([("test_item",)], "t string")
    got = lambda **a: df.select(bloom_indexes(F.col("t"), **a)).first()[0]
    assert got(power2=27, k=8) == [15068672, 85178625, 62090555, 75482522, 39329133, 21092869, 69760149, 71995941]
    assert got(power2=26, k=6) == [58730308, 29078381, 33494635, 30858004, 22874653, 4887077]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 7, 12])
@pytest.mark.parametrize("power2", [3, 10, 40, 52])
def test_sliced_against_big_integers(spark, power2, k):
    items = [f"x{i}" for i in range(5)]
    rows = spark.createDataFrame([(i,) for i in items], "t string").select("t", bloom_indexes(F.col("t"), power2, k)).collect()
    assert all(r[1] == positions(r[0], power2, k) for r in rows)


def test_other_families(spark):
    df = spark.createDataFrame([("é1",)], "t string")
    salted = [int(hashlib.sha256(f"{i}é1".encode()).hexdigest(), 16) for i in range(6)]
    first = hashlib.sha256("é1".encode()).digest()
    chained = [int.from_bytes(hashlib.sha256(first + str(i).encode()).digest(), "big") & ((1 << 27) - 1) for i in range(6)]
    get = lambda **a: df.select(bloom_indexes(F.col("t"), k=6, **a)).first()[0]
    assert get(family="salted", size=1_000_000_000) == [s % 1_000_000_000 for s in salted]
    assert get(family="salted", size=1024) == [s % 1024 for s in salted]
    assert get(family="chained") == chained
    with pytest.raises(ValueError):
        bloom_indexes(F.col("t"), family="other")


@pytest.mark.parametrize("seed", range(6))
def test_bloom_dedupe_against_one_by_one(spark, seed):
    rng = random.Random(seed)
    power2, k = rng.choice([4, 6, 8]), rng.choice([1, 2, 3])
    items = [f"i{rng.randint(0, 60)}" for _ in range(120)]
    history = [f"i{rng.randint(0, 99)}" for _ in range(rng.choice([0, 4]))]
    bits, kept = set(), []
    for item in history:
        bits.update(positions(item, power2, k))
    for n, item in enumerate(items):
        if not bits.issuperset(positions(item, power2, k)):
            bits.update(positions(item, power2, k))
            kept.append(n)
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string")
    past = spark.createDataFrame([(h,) for h in history], "text string")
    found = dedupe.dedupe_bloom(df, history=past if history else None, power2=power2, k=k)
    assert sorted(r.doc_id for r in found.collect()) == kept

    bloom = dedupe.bloom_build(df, power2=power2, k=k)
    full = {i for item in items for i in positions(item, power2, k)}
    assert {r.idx for r in dedupe.bloom_bits(bloom).collect()} == full
    probes = spark.createDataFrame([(n, f"i{n}") for n in range(100)], "doc_id long, text string")
    wanted = {n: full.issuperset(positions(f"i{n}", power2, k)) for n in range(100)}
    assert {r.doc_id: r.seen for r in dedupe.bloom_contains(probes, bloom, power2=power2, k=k).collect()} == wanted
    twice = dedupe.bloom_union(bloom, dedupe.bloom_build(probes, power2=power2, k=k))
    assert dedupe.bloom_contains(probes, twice, power2=power2, k=k).where("not seen").count() == 0


def test_large_filter_is_joined(spark):
    items = spark.createDataFrame([(n, f"item{n}") for n in range(1, 6)], "doc_id long, text string")
    bloom = dedupe.bloom_build(items, power2=30, k=3)
    probes = items.union(spark.createDataFrame([(9, "something_else")], "doc_id long, text string"))
    rows = dedupe.bloom_contains(probes, bloom, power2=30, k=3).collect()
    assert {r.doc_id for r in rows if r.seen} == {1, 2, 3, 4, 5} and len(rows) == 6


def test_first_wins_and_novel(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (4, None), (5, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in dedupe.dedupe_exact(df).collect()) == [1, 2, 4]
    cand = spark.createDataFrame([("p", 2), ("p", 1), ("q", 3)], "prompt string, ordinal long")
    seen = spark.createDataFrame([("q",)], "prompt string")
    assert dedupe.novel(cand, seen).collect() == [("p", 1)]
