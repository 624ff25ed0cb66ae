"""First-wins removal of repeats, exact or through a Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.bloom import bloom_indexes, index_list
from textmill.functions.text import strip
from textmill.plans import materialize

# Bit tables up to this many bits (16 MiB of bitmaps) are sent to every executor.
BROADCAST_POWER2 = 27


def digest(text: Column) -> Column:
    """32-byte SHA-256: what to group long texts by."""
    return F.unhex(F.sha2(text, 256))


def first_wins(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """Rows that hold the lowest ``order`` of their key; ``order`` must be unique.

    Copies collapse to one (key, order) pair per task before any shuffle, so a key with
    very many copies costs nothing extra; whole rows move once, by ``order``.
    """
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    winners = df.select(F.col(order).alias("_first"), *named).groupBy(*[f"_k{i}" for i in range(len(keys))])
    winners = winners.agg(F.min("_first").alias("_first")).select("_first")
    return df.join(winners, F.col(order) == F.col("_first"), "left_semi")


def dedupe_exact(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    return first_wins(df, [digest(F.col(text))], order)


def dedupe_md5(files: DataFrame, content: str = "content", order: str = "path") -> DataFrame:
    """One file per MD5 of its bytes, the first in ``order``."""
    return first_wins(files, [F.unhex(F.md5(F.col(content)))], order)


def distinct_texts(df: DataFrame, text: str, order: str) -> DataFrame:
    """``(order, text)`` of the first appearance of each text; for short texts such as lines."""
    return df.groupBy(text).agg(F.min(order).alias(order)).select(order, text)


def novel(candidates: DataFrame, visited: DataFrame, key: str = "prompt", order: str = "ordinal") -> DataFrame:
    """Candidates not in ``visited``, each once, with the lowest ``order``."""
    return candidates.groupBy(key).agg(F.min(order).alias(order)).join(visited.select(key).distinct(), key, "left_anti")


def dedupe_bloom(
    df: DataFrame,
    item: str = "text",
    order: str = "doc_id",
    history: DataFrame | None = None,
    **filter_args,
) -> DataFrame:
    """Rows that a Bloom filter fed in ``order`` would let through, false positives included.

    A skipped row sets no new bit, so the bits set before a row are those of all earlier
    rows. Hence a row passes exactly when it is the earliest on at least one of its
    positions: take the lowest ``order`` per position and keep the rows named there.
    ``history``: an ``item`` column of texts already in the filter.
    """
    rows = df.select(F.lit(1).alias("new"), F.col(order).alias("at"), F.col(item).alias("_item"))
    if history is not None:
        kind = df.schema[order].dataType
        rows = rows.unionByName(
            history.select(F.lit(0).alias("new"), F.lit(None).cast(kind).alias("at"), F.col(item).alias("_item"))
        )
    bits = rows.select("new", "at", F.explode(bloom_indexes(F.col("_item"), **filter_args)).alias("idx"))
    earliest = bits.groupBy("idx").agg(F.min("new").alias("new"), F.min("at").alias("_first"))
    passed = earliest.where("new = 1").select("_first").distinct()
    return df.join(passed, F.col(order) == F.col("_first"), "left_semi")


def bloom_build(items: DataFrame, item: str = "text", **filter_args) -> DataFrame:
    """``(bucket, bitmap)`` rows of 32,768 bits each."""
    bits = items.select(F.explode(bloom_indexes(F.col(item), **filter_args)).alias("idx"))
    return bits.groupBy(F.bitmap_bucket_number("idx").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("idx")).alias("bitmap")
    )


def bloom_union(*filters: DataFrame) -> DataFrame:
    """One filter holding the bits of several with the same parameters."""
    merged = filters[0]
    for other in filters[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bloom_bits(bloom: DataFrame) -> DataFrame:
    """``idx`` of every set bit. Bucket 0 holds position 0 alone; bucket b starts after ``(b-1) * 32768``."""
    bytes_ = bloom.select(
        "bucket", F.posexplode(F.regexp_extract_all(F.hex("bitmap"), F.lit(".."), F.lit(0))).alias("byte_no", "digits")
    ).where("digits <> '00'")
    bits = bytes_.select(
        "bucket",
        (F.col("byte_no") * 8).alias("base"),
        F.conv("digits", 16, 10).cast("int").alias("value"),
        F.explode(F.array(*[F.lit(b) for b in range(8)])).alias("bit"),
    ).where("(value & shiftleft(1, bit)) <> 0")
    within = (F.col("base") + F.col("bit")).cast("long")
    return bits.select(
        F.when(F.col("bucket") == 0, within).otherwise((F.col("bucket") - 1) * 32768 + within + 1).alias("idx")
    )


def _bit(bitmap: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0, F.lit(False))


def bloom_contains(
    items: DataFrame, bloom: DataFrame, item: str = "text", order: str = "doc_id", **filter_args
) -> DataFrame:
    """Add ``seen``: all bits of the item are set.

    A filter of up to ``2**27`` bits is at most 16 MiB and is broadcast once; rows then
    stay where they are. A larger one is joined by bucket.
    """
    power2 = filter_args.get("power2", 27)
    size = filter_args.get("size")
    k = filter_args.get("k", 8)
    if (size or 1 << power2) <= 1 << BROADCAST_POWER2:
        found = items
        names = [f"_i{n}" for n in range(k)]
        for name, idx in zip(names, index_list(F.col(item), **filter_args)):
            found = found.withColumn(name, idx)
        seen = F.lit(True)
        for n, name in enumerate(names):
            side = F.broadcast(bloom.select(F.col("bucket").alias(f"_b{n}"), F.col("bitmap").alias(f"_m{n}")))
            found = found.join(side, F.bitmap_bucket_number(name) == F.col(f"_b{n}"), "left")
            found = found.withColumn(name, _bit(f"_m{n}", F.bitmap_bit_position(F.col(name)))).drop(f"_m{n}", f"_b{n}")
            seen = seen & F.col(name)
        return found.withColumn("seen", seen).drop(*names)

    probes = items.select(F.col(order).alias("_at"), F.explode(bloom_indexes(F.col(item), **filter_args)).alias("idx"))
    hits = probes.join(bloom, F.bitmap_bucket_number("idx") == F.col("bucket"), "left")
    flags = hits.groupBy("_at").agg(F.bool_and(_bit("bitmap", F.bitmap_bit_position("idx"))).alias("seen"))
    return items.join(flags, F.col(order) == F.col("_at")).drop("_at")


def bloom_admit(
    rows: DataFrame, bloom: DataFrame | None, item: str = "prompt", order: str = "ordinal", bits: str | None = None, **filter_args
) -> tuple[DataFrame, DataFrame]:
    """Rows that a filter already holding ``bloom`` lets through in ``order``, and the filter with their bits.

    ``bits``: the column that holds the ``bloom_indexes`` of the item, where they are known already. ``rows`` is read twice: pass a written table.
    """
    found = F.col(bits) if bits else bloom_indexes(F.col(item), **filter_args)
    probes = rows.select(F.col(order).alias("_at"), F.explode(found).alias("idx"))
    first = probes.groupBy("idx").agg(F.min("_at").alias("_first"))
    if bloom is not None:
        hits = first.join(bloom, F.bitmap_bucket_number("idx") == F.col("bucket"), "left")
        first = hits.where(~_bit("bitmap", F.bitmap_bit_position("idx"))).select("idx", "_first")
    first = materialize(first, "bits")
    passed = rows.join(first.select("_first").distinct(), F.col(order) == F.col("_first"), "left_semi")
    added = first.groupBy(F.bitmap_bucket_number("idx").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("idx")).alias("bitmap")
    )
    return passed, added if bloom is None else bloom_union(bloom, added)


def resume_set(store_texts: DataFrame, prompts: DataFrame | None = None) -> DataFrame:
    """``item``: texts already stored, and logged prompts (stripped) when given."""
    items = store_texts.select(F.col("text").alias("item"))
    if prompts is not None:
        items = items.union(prompts.select(strip(F.col("prompt")).alias("item")))
    return items.distinct()

