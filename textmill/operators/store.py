"""The store of generations: appends that ignore repeats, merges, migration, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill import schemas
from textmill.functions.codec import compress, decompress
from textmill.functions.text import strip, token_count
from textmill.operators.dedupe import dedupe_bloom, digest, distinct_texts
from textmill.operators.ledger import Ledger
from textmill.plans import bounded_broadcast, global_rank, hot_values, materialize, range_bounds, running_sum, salted_join, spread, wide_rank
from textmill.sources.tables import read_if_there

ARCHIVE = "archive"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored rows; select the columns you need and the scan reads only those."""
    return spark.read.schema(schemas.TEXTS).parquet(path)


def store_texts(store: DataFrame) -> DataFrame:
    """``(word, text)`` of the stored rows."""
    return store.select("word", decompress(F.col("data"), F.col("compression_algo")).alias("text"))


def read_prompt_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROMPTS).parquet(path).select(strip(F.col("prompt")).alias("prompt"))


def _shaped(rows: DataFrame) -> DataFrame:
    """All store columns; missing ones are NULL, a missing ``created_at`` is now."""
    columns = []
    for field in schemas.TEXTS:
        if field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = F.current_timestamp() if field.name == "created_at" else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def numbered(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """``rows`` (all store columns) with an ``id`` for those that lack one, counted on from the highest id of both tables."""
    rows = materialize(rows.withColumn("_order", F.monotonically_increasing_id()), "numbered")
    blank = rows.where(F.col("id").isNull())
    if blank.isEmpty():
        return rows.drop("_order")
    highest = existing.select("id").unionByName(rows.select("id")).agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    counted = wide_rank(blank, "_order", "_rank").withColumn("id", (F.col("_rank") + highest).cast("long")).drop("_rank")
    return rows.where(F.col("id").isNotNull()).unionByName(counted).drop("_order")


def append_generations(rows: DataFrame, path: str) -> None:
    """Append rows; those without ``id`` are numbered on from the highest one stored."""
    there = read_if_there(rows.sparkSession, path, schemas.TEXTS)
    numbered(_shaped(rows), there).write.mode("append").parquet(path)


def write_text(rows: DataFrame, path: str, text: str = "text", rows_per_file: int = 0) -> None:
    """``rows_per_file``: a file that is full is followed by another; 0 means one file a task."""
    rows.select(text).write.mode("append").option("maxRecordsPerFile", rows_per_file).text(path)


def insert_or_ignore(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str | tuple[str, ...]],
    order: str,
    long_keys: bool = False,
) -> DataFrame:
    """Incoming rows that may be added: no unique key of theirs is taken.

    Each entry of ``keys``, a column or a tuple of columns, is a unique key of its own; a key
    holding a NULL never clashes. Among the incoming rows the lower ``order`` (unique, a NULL is an error) wins. ``long_keys`` compares digests, which
    keeps blobs and texts out of the key shuffles. Whole rows move once.
    """

    def part_of(name: str) -> Column:
        return digest(F.col(name)) if long_keys and _is_long(incoming, name) else F.col(name)

    def key_of(key: str | tuple[str, ...]) -> Column:
        if isinstance(key, str):
            return part_of(key)
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        return F.when(complete, F.struct(*[part_of(c).alias(c) for c in key]))

    names = [f"_k{i}" for i in range(len(keys))]
    place = F.coalesce(F.col(order), F.raise_error(F.lit(f"insert_or_ignore: NULL in {order}")))
    rows = incoming.select(place.alias("_at"), *[key_of(k).alias(n) for k, n in zip(keys, names)])
    taken = [existing.select(key_of(k).alias(n)).where(F.col(n).isNotNull()) for k, n in zip(keys, names)]
    accepted = _accept_one_key(rows, taken[0]) if len(keys) == 1 else _accept_many_keys(rows, taken)
    return incoming.join(accepted, F.col(order) == F.col("_at"), "left_semi")


def _is_long(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("binary", "string")


def _accept_one_key(rows: DataFrame, taken: DataFrame) -> DataFrame:
    # Copies collapse before the join with the store, so a frequent key meets it once.
    first = rows.where("_k0 is not null").groupBy("_k0").agg(F.min("_at").alias("_at"))
    return first.join(taken.distinct(), "_k0", "left_anti").select("_at").union(rows.where("_k0 is null").select("_at"))


def _accept_many_keys(rows: DataFrame, taken: list[DataFrame]) -> DataFrame:
    """Rows that inserting one by one, in ``_at`` order, would accept.

    A rejected row frees the keys it would have taken, so this goes in rounds: accept the
    rows that are first on all their keys, drop the rows these rule out, look again.
    """
    names = [c for c in rows.columns if c != "_at"]
    waiting = materialize(rows, "insert")

    def minus(left: DataFrame, used: DataFrame, name: str) -> DataFrame:
        keys = used.select(name).where(F.col(name).isNotNull()).distinct()
        return salted_join(left, keys, [name], hot[name], F.col("_at"), "left_anti")

    hot = {name: hot_values(waiting, [name]) for name in names}
    open_rows = waiting
    for name, used in zip(names, taken):
        open_rows = minus(open_rows, used, name)
    waiting, accepted = materialize(open_rows.select("_at", *names), "insert"), None
    while accepted is None or not waiting.isEmpty():
        lead = waiting
        for name in names:
            first = waiting.where(F.col(name).isNotNull()).groupBy(name).agg(F.min("_at").alias("_first"))
            lead = salted_join(lead, first, [name], hot[name], F.col("_at"), "left")
            lead = lead.where(F.col("_first").isNull() | (F.col("_first") == F.col("_at"))).drop("_first")
        lead = materialize(lead.select("_at", *names), "insert-accepted")
        accepted = lead if accepted is None else accepted.unionByName(lead)
        rest = waiting.join(lead.select("_at"), "_at", "left_anti")
        for name in names:
            rest = minus(rest, lead, name)
        waiting = materialize(rest.select("_at", *names), "insert-waiting")
    return accepted.select("_at")


def log_prompts(log: DataFrame, prompts: DataFrame, order: str) -> DataFrame:
    """Stripped prompts not in the log yet, once each."""
    incoming = prompts.withColumn("prompt", strip(F.col("prompt")))
    return insert_or_ignore(log, incoming, ["prompt"], order)


def merge_stores(base: DataFrame, other: DataFrame, keys: tuple[str, ...] = ("id", "data")) -> DataFrame:
    """All of ``base``, and the rows of ``other`` none of whose keys are in ``base``.

    ``other`` must obey its own unique keys. Without ``id`` among the keys the added rows
    are numbered on from the highest id of ``base``. Rows of ``other`` without id are numbered on from the highest id of both.
    """
    if not other.where(F.col("id").isNull()).isEmpty():
        other = numbered(other, base)
    survivors = other.select(F.col("id").alias("_id"), *_merge_keys(other, keys))
    for key, column in zip(keys, _merge_keys(base, keys)):
        survivors = survivors.join(base.select(column), f"_m_{key}", "left_anti")
    if "id" in keys:
        added = other.join(survivors.select("_id"), F.col("id") == F.col("_id"), "left_semi")
    else:
        # Only the ids are ranked, so that no task holds the rows of a whole block.
        top = base.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
        kept = other.select("id").join(survivors.select("_id"), F.col("id") == F.col("_id"), "left_semi")
        counts = materialize(kept.groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("_n")), "merged")
        added = other.join(running_sum(counts, "_n", "_id", "_last"), F.col("id") == F.col("_id"))
        if not counts.where("_n > 1").isEmpty():
            added = added.withColumn("_last", F.col("_last") - F.row_number().over(W.partitionBy("id").orderBy("id")) + 1)
        added = added.withColumn("id", F.col("_last") + top)
    return base.unionByName(added.select(*base.columns))


def _merge_keys(df: DataFrame, keys: tuple[str, ...]) -> list[Column]:
    return [
        (digest(F.col(k)) if _is_long(df, k) else F.col(k)).alias(f"_m_{k}") for k in keys
    ]


def filter_not_archive(store: DataFrame) -> DataFrame:
    """Rows of another word than ``archive``; a NULL word is dropped too."""
    return store.where(F.col("word") != ARCHIVE)


def filter_nonempty(store: DataFrame) -> DataFrame:
    return store.where(F.col("data").isNotNull() & (F.length("data") > 0))


def filter_min_tokens(rows: DataFrame, minimum: int = 20) -> DataFrame:
    return rows.where(F.col("tok") > minimum)


def archive_candidates(source: DataFrame, tokens: str = "whitespace", bloom: dict | None = None) -> DataFrame:
    """``(id, word, data, tok, compression_algo)``: texts of ``source``, once each, as ``archive``, bytes unchanged.

    ``bloom``: filter arguments to let a Bloom filter decide what has been seen.
    """
    rows = filter_nonempty(filter_not_archive(source))
    if not rows.where(F.col("id").isNull()).isEmpty():
        rows = numbered(rows, source)
    texts = spread(rows.select("id", "data", "compression_algo")).select(
        "id", decompress(F.col("data"), F.col("compression_algo")).alias("text")
    )
    counted = texts.withColumn("tok", token_count(F.col("text"), tokens))
    if bloom is not None:
        counted = materialize(counted, "migrate")
        first = dedupe_bloom(counted, "text", "id", **bloom).select(F.col("id").alias("_first"), "tok")
    else:
        # Equal texts have equal counts, so blobs are unpacked once and texts are not shuffled.
        first = counted.groupBy(digest(F.col("text")).alias("_d")).agg(
            F.min("id").alias("_first"), F.min("tok").alias("tok")
        ).drop("_d")
    return rows.drop("tok").join(first, F.col("id") == F.col("_first")).select(
        "id", F.lit(ARCHIVE).alias("word"), "data", "tok", "compression_algo"
    )


def migrate_archive(
    source: DataFrame, target: DataFrame, tokens: str = "whitespace", bloom: dict | None = None
) -> DataFrame:
    """Rows of ``archive_candidates`` to add to ``target``."""
    return insert_or_ignore(target, archive_candidates(source, tokens, bloom), ["data"], "id", long_keys=True)


def load_archive(source: DataFrame, ledger: Ledger, run: str, tokens: str = "whitespace", bloom: dict | None = None) -> bool:
    """Commit the rows of ``archive_candidates`` to a ledger, which numbers them anew."""
    rows = archive_candidates(source, tokens, bloom).withColumnRenamed("id", "_order")
    return ledger.commit(run, texts=rows)


def archive_rows(texts: DataFrame, text: str, order: str, tokens: str = "whitespace", level: int = 9) -> DataFrame:
    """``(order, word, data, tok)`` of each distinct text, ready for a store."""
    return distinct_texts(texts, text, order).select(
        order,
        F.lit(ARCHIVE).alias("word"),
        compress(F.col(text), level).alias("data"),
        token_count(F.col(text), tokens).alias("tok"),
    )


def total_tokens(rows: DataFrame) -> DataFrame:
    return rows.agg(F.coalesce(F.sum("tok"), F.lit(0)).alias("total_tokens"))


def tokens_by_root(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.sum("tok").alias("total_tokens"), F.count("*").alias("generations"))


def generation_rate(rows: DataFrame) -> DataFrame:
    """Add ``rate``: tokens per second, 0 without elapsed time."""
    return rows.withColumn("rate", F.when(F.col("td") > 0, F.col("tok") / F.col("td")).otherwise(0.0))


def run_rate(rows: DataFrame) -> DataFrame:
    total = F.sum("td")
    return rows.groupBy("word").agg(F.when(total > 0, F.sum("tok") / total).otherwise(0.0).alias("run_rate"))


def compression_ratio(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add ``ratio``: characters per compressed byte."""
    return rows.withColumn("ratio", F.length(text) / F.length("data"))


def running_tokens(rows: DataFrame, order: str, partition: list[str] | None = None) -> DataFrame:
    return running_sum(rows, "tok", order, "running_tokens", partition)


def progress_points(rows: DataFrame, order: str, every: int = 10) -> DataFrame:
    """Rows 0, ``every``, 2 * ``every``, ... with the total reached."""
    bounds = range_bounds(rows, order)
    placed = global_rank(rows, order, "n", bounds=bounds).withColumn("n", F.col("n") - 1)
    return running_sum(placed, "tok", order, "running_tokens", bounds=bounds).where(F.col("n") % every == 0)


def latest_n(versions: DataFrame, keys: list[str], order: str, n: int = 3, tie: str | None = None) -> DataFrame:
    """Add ``expired``: true for all but the ``n`` newest versions of each key.

    The kept versions are found with a rank limit that Spark applies before the shuffle,
    so a name with very many versions sends ``n`` rows per task and is never sorted whole.
    """
    by = [order, *([tie] if tie else [])]
    newest = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in by])
    kept = versions.select(*keys, *by).withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n)
    # The oldest kept version of a key is its cut.
    cut = kept.groupBy(*keys).agg(F.min(F.struct(*by)).alias("_cut"))
    small, fits = bounded_broadcast(cut)
    if fits:
        joined = versions.join(small, keys)
    else:
        joined = salted_join(versions, cut, keys, hot_values(versions, keys), F.xxhash64(*by))
    return joined.withColumn("expired", F.struct(*by) < F.col("_cut")).drop("_cut")
