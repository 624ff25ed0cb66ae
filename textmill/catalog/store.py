"""Store queries: scans, filters, inserts, merges, migration, totals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textmill.catalog.common import GENERATIONS, LINES, generations, lines, r6, sql_strip, sql_words, table
from textmill.functions import text as tx
from textmill.functions.codec import compress, decompress
from textmill.operators import store
from textmill.operators.ledger import Ledger
from textmill.plans import materialize, scratch_dir, spread


def _store(spark, folder):
    """Documents as a store: the source is the word, some sources are archived or unnamed."""
    docs = table(spark, folder, "documents")
    word = F.when(F.col("source") == "src1", "archive").when(F.col("source") != "src2", F.col("source"))
    return docs.select(
        F.col("doc_id").alias("id"),
        word.alias("word"),
        "text",
        F.when(F.col("lang") == "en", F.lit("zstd")).when(F.col("lang") == "de", F.lit("zlib")).alias("compression_algo"),
        tx.token_count(F.col("text")).alias("tok"),
    )


STORE = f"""(select doc_id as id, text, lang, len({sql_words('text')}) as tok,
    case when source = 'src1' then 'archive' when source <> 'src2' then source end as word from documents)"""


def _packed(rows):
    """Each row goes through its own codec alone."""
    zstd = F.col("compression_algo").eqNullSafe("zstd")
    packed = rows.where(zstd).withColumn("data", compress(F.col("text"), 3, "zstd"))
    return packed.unionByName(rows.where(~zstd).withColumn("data", compress(F.col("text"))))


def _scan(spark, folder):
    """Rows appended to a store, some without a blob or with an empty one, and read back."""
    path = f"{scratch_dir(spark)}/textmill/store-{uuid.uuid4().hex}"
    blob = F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 11 == 0, F.lit(b"")).otherwise(F.col("data")))
    store.append_generations(_packed(_store(spark, folder)).withColumn("data", blob).drop("text"), path)
    kept = store.filter_nonempty(store.filter_not_archive(store.read_store(spark, path)))
    return store.store_texts(kept)


def _appended(spark, folder):
    """Two appends: documents with their ids, then turns without, which are numbered on."""
    path = f"{scratch_dir(spark)}/textmill/store-{uuid.uuid4().hex}"
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("word"), F.encode("text", "UTF-8").alias("data"))
    store.append_generations(docs, path)
    turns = table(spark, folder, "conversations").select(F.col("role").alias("word"), F.encode("text", "UTF-8").alias("data"), F.lit(3).alias("seed"))
    store.append_generations(turns, path)
    found = store.read_store(spark, path)
    return found.groupBy("word", "seed").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.sum(F.length("data")).alias("n_bytes"), F.count("created_at").alias("n_dated"),
        F.count_distinct(F.when(F.col("seed") == 3, F.col("id") > F.lit(docs.agg(F.max("id")).first()[0]))).alias("n_sides"),
    )


def _labelled(spark, folder):
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id").distinct()
    return table(spark, folder, "documents").join(good, "doc_id", "left_semi")


LABELLED = "(select * from documents where doc_id in (select doc_id from labels where quality = 1))"


def _insert(spark, folder):
    existing = _labelled(spark, folder).select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return store.insert_or_ignore(existing, lines(spark, folder), ["line"], "seq")


def _merge(keys):
    def run(spark, folder):
        docs = table(spark, folder, "documents").select("doc_id", "text")
        first = docs.groupBy("text").agg(F.min("doc_id").alias("id"))
        base = _labelled(spark, folder).groupBy("text").agg(F.min("doc_id").alias("id"))
        other = first.withColumn("id", F.col("id") + 1)
        packed = [t.select("id", F.encode("text", "UTF-8").alias("data")) for t in (base, other)]
        return store.merge_stores(*packed, keys=keys).select("id", F.md5("data").alias("digest"))

    return run


MERGE_SQL = f"""
    base as (select min(doc_id) as id, text from {LABELLED} group by text),
    other as (select min(doc_id) + 1 as id, text from documents group by text),"""


def _prompt_log(spark, folder):
    talk = table(spark, folder, "conversations")
    log = talk.where("role = 'system'").select(tx.strip(F.col("text")).alias("prompt"))
    pieces = talk.select("conv_id", "turn", F.posexplode(F.split("text", r"\.", -1)).alias("pos", "prompt"))
    found = store.log_prompts(log, pieces.select(F.struct("conv_id", "turn", "pos").alias("at"), "prompt"), "at")
    return found.select("at.conv_id", "at.turn", "at.pos", "prompt")


def _migrate(spark, folder):
    source = materialize(_packed(spread(_store(spark, folder))), "source")
    done = _labelled(spark, folder).select(
        "text", F.when(F.col("lang") == "en", F.lit("zstd")).otherwise(F.lit("zlib")).alias("compression_algo")
    )
    return store.migrate_archive(source.drop("text"), _packed(done)).select(
        "id", "word", F.col("tok").cast("long").alias("tok")
    )


def _migrate_indexed(spark, folder):
    """The same migration into a ledger, which numbers the rows anew; sources are told by their texts."""
    source = materialize(_packed(spread(_store(spark, folder))), "source")
    done = _labelled(spark, folder).select(
        F.col("doc_id").alias("_order"), "text", F.lit("done").alias("word"), F.when(F.col("lang") == "en", F.lit("zstd")).otherwise(F.lit("zlib")).alias("compression_algo")
    )
    ledger = Ledger(spark, f"{scratch_dir(spark)}/textmill/ledger-{uuid.uuid4().hex}")
    ledger.commit("done", texts=_packed(done))
    store.load_archive(source.drop("text"), ledger, "archive")
    store.load_archive(source.drop("text"), ledger, "archive")  # adds nothing
    found = ledger.table("texts").where(F.col("word") == store.ARCHIVE)
    return found.select("id", "word", F.md5(decompress(F.col("data"), F.col("compression_algo"))).alias("digest"), F.col("tok").cast("long").alias("tok"))


def _rates(spark, folder):
    return _store(spark, folder).withColumn("td", (F.col("id") % 4) / 8.0)


def _latest(spark, folder):
    versions = table(spark, folder, "events").select("event_id", "event_type", "ts")
    return store.latest_n(versions, ["event_type"], "ts", 3, tie="event_id").select("event_id", "event_type", "expired")


QUERIES = {
    "store_scan": _scan,
    "append_generations": _appended,
    "prompt_log_scan": lambda s, d: generations(s, d).select(
        "gen", tx.strip(F.concat(F.lit(" \t"), "prompt", F.lit("\n"))).alias("prompt")
    ),
    "filter_not_archive": lambda s, d: store.filter_not_archive(_store(s, d)).select("id", "word"),
    "min_tokens": lambda s, d: store.filter_min_tokens(_store(s, d)).select("id", F.col("tok").cast("long").alias("tok")),
    "insert_or_ignore": _insert,
    "prompt_log": _prompt_log,
    "merge_stores": _merge(("id", "data")),
    "merge_stores_renumbered": _merge(("data",)),
    "migrate_archive": _migrate,
    "migrate_archive_indexed": _migrate_indexed,
    "total_tokens": lambda s, d: store.total_tokens(_store(s, d)),
    "tokens_by_root": lambda s, d: store.tokens_by_root(_store(s, d)),
    "generation_rate": lambda s, d: store.generation_rate(_rates(s, d)).select("id", r6("rate").alias("rate")),
    "run_rate": lambda s, d: store.run_rate(_rates(s, d)).withColumn("run_rate", r6("run_rate")),
    "compression_ratio": lambda s, d: store.compression_ratio(_store(s, d).withColumn("data", compress(F.col("text"), 0))).select("id", "ratio"),
    "running_tokens": lambda s, d: store.running_tokens(_store(s, d), "id", ["word"]).select("id", "word", "running_tokens"),
    "progress_points": lambda s, d: store.progress_points(_store(s, d), "id").select("id", "n", "running_tokens"),
    "latest_versions": _latest,
}

ORACLE = {
    "compression_ratio": f"select id, length(text) / cast(strlen(text) as double) as ratio from {STORE}",
    "store_scan": f"select word, text from {STORE} where word <> 'archive' and id % 7 <> 0 and id % 11 <> 0",
    "append_generations": """
        select word, seed, count(*) as n, count(*) as n_ids, sum(strlen(text))::bigint as n_bytes, count(*) as n_dated, n_sides from (
            select source as word, null::int as seed, text, 0 as n_sides from documents union all select role, 3, text, 1 from conversations) group by all""",
    "prompt_log_scan": f"select gen, {sql_strip('prompt')} as prompt from {GENERATIONS}",
    "filter_not_archive": f"select id, word from {STORE} where word <> 'archive'",
    "min_tokens": f"select id, tok from {STORE} where tok > 20",
    "insert_or_ignore": f"""
        select min(seq) as seq, line from {LINES}
        where line not in (select unnest(string_split(text, chr(10))) from {LABELLED}) group by line""",
    "prompt_log": f"""
        with log as (select {sql_strip('text')} as prompt from conversations where role = 'system'),
        pieces as (select conv_id, turn, unnest(string_split(text, '.')) as piece,
                          generate_subscripts(string_split(text, '.'), 1) - 1 as pos from conversations),
        incoming as (select conv_id, turn, cast(pos as int) as pos, {sql_strip('piece')} as prompt from pieces),
        ranked as (select *, row_number() over (partition by prompt order by conv_id, turn, pos) as nr from incoming)
        select conv_id, turn, pos, prompt from ranked where nr = 1 and prompt not in (select prompt from log)""",
    "merge_stores": f"""
        with {MERGE_SQL} added as (select * from other
            where id not in (select id from base) and text not in (select text from base))
        select id, md5(text) as digest from (select * from base union all select * from added)""",
    "merge_stores_renumbered": f"""
        with {MERGE_SQL} added as (select * from other where text not in (select text from base)),
        numbered as (select row_number() over (order by id) + (select max(id) from base) as id, text from added)
        select id, md5(text) as digest from (select * from base union all select * from numbered)""",
    "migrate_archive": f"""
        select min(id) as id, 'archive' as word, min(tok) as tok from {STORE}
        where word <> 'archive' and text <> '' and text not in (select text from {LABELLED}) group by text""",
    "migrate_archive_indexed": f"""
        with firsts as (select min(id) as id, min(tok) as tok, text from {STORE}
            where word <> 'archive' and text <> '' and text not in (select text from {LABELLED}) group by text)
        select row_number() over (order by id) + (select count(distinct text) from {LABELLED}) as id, 'archive' as word, md5(text) as digest, tok from firsts""",
    "total_tokens": f"select cast(coalesce(sum(tok), 0) as bigint) as total_tokens from {STORE}",
    "tokens_by_root": f"""
        select word, cast(sum(tok) as bigint) as total_tokens, count(*) as generations from {STORE} group by word""",
    "generation_rate": f"""
        select id, round(case when id % 4 > 0 then tok / ((id % 4) / 8.0) else 0.0 end, 6) as rate from {STORE}""",
    "run_rate": f"""
        select word, round(case when sum(id % 4) > 0 then sum(tok) / (sum(id % 4) / 8.0) else 0.0 end, 6) as run_rate
        from {STORE} group by word""",
    "running_tokens": f"""
        select id, word, cast(sum(tok) over (partition by word order by id) as bigint) as running_tokens from {STORE}""",
    "progress_points": f"""
        select id, n, running_tokens from (
            select id, row_number() over (order by id) - 1 as n,
                   cast(sum(tok) over (order by id) as bigint) as running_tokens from {STORE})
        where n % 10 = 0""",
    "latest_versions": """
        select event_id, event_type,
               row_number() over (partition by event_type order by ts desc, event_id desc) > 3 as expired from events""",
}
