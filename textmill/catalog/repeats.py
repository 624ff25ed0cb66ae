"""Removing and remembering repeats: exact, by content hash, through Bloom filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.columns import sql_sliced
from textmill.catalog.common import GENERATIONS, LINES, generations, lines, sql_lines, sql_strip, table
from textmill.functions import text as tx
from textmill.functions.codec import compress
from textmill.operators import dedupe
from textmill.operators.store import store_texts

# Small filters, so that false positives take part in the comparison.
DEDUPE_FILTER = {"power2": 14, "k": 4}
BITS_FILTER = {"power2": 20, "k": 6}
PROBE_FILTER = {"power2": 12, "k": 3}


def _talk_lines(spark, folder):
    talk = table(spark, folder, "conversations")
    return talk.select(F.explode(F.split("text", "\n", -1)).alias("line"))


TALK_LINES = f"(select line from {sql_lines('conversations', keys='conv_id')})"


def _novel(spark, folder):
    candidates = lines(spark, folder).select(F.col("line").alias("prompt"), F.col("seq").alias("ordinal"))
    visited = table(spark, folder, "benchmark").select(F.explode(F.split("text", "\n", -1)).alias("prompt"))
    return dedupe.novel(candidates, visited)


def _bloom_history(spark, folder):
    return dedupe.dedupe_bloom(
        lines(spark, folder), "line", "seq", history=_talk_lines(spark, folder), **DEDUPE_FILTER
    )


def _contains(spark, folder):
    bloom = dedupe.bloom_build(_talk_lines(spark, folder), "line", **PROBE_FILTER)
    return dedupe.bloom_contains(lines(spark, folder), bloom, "line", "seq", **PROBE_FILTER).select("seq", "seen")


def _resume(spark, folder):
    gens = generations(spark, folder)
    store = gens.select(
        F.col("prompt").alias("word"), compress(F.col("text")).alias("data"), F.lit(None).cast("string").alias("compression_algo")
    )
    log = gens.select(F.concat(F.lit(" \t"), "prompt", F.lit("\n")).alias("prompt"))
    return dedupe.resume_set(store_texts(store), log)


QUERIES = {
    "dedupe_exact": lambda s, d: dedupe.dedupe_exact(table(s, d, "documents").select("doc_id", "text", "lang")),
    "dedupe_lines": lambda s, d: dedupe.distinct_texts(lines(s, d).select("seq", tx.strip(F.col("line")).alias("line")), "line", "seq"),
    "dedupe_md5": lambda s, d: dedupe.dedupe_md5(
        table(s, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content")), order="doc_id"
    ).select("doc_id", F.md5("content").alias("md5")),
    "dedupe_bloom": lambda s, d: dedupe.dedupe_bloom(lines(s, d), "line", "seq", **DEDUPE_FILTER),
    "dedupe_bloom_resumed": _bloom_history,
    "bloom_bits": lambda s, d: dedupe.bloom_bits(
        dedupe.bloom_build(table(s, d, "documents"), "text", **BITS_FILTER)
    ),
    "bloom_contains": _contains,
    "novel_prompts": _novel,
    "resume_set": _resume,
}


def bits_sql(source: str, item: str, args: dict, keep: str = "") -> str:
    found = ", ".join(sql_sliced(item, args["power2"], args["k"]))
    return f"(select {keep} unnest([{found}]) as idx from {source})"


ORACLE = {
    "dedupe_exact": """
        select doc_id, text, lang from (select *, row_number() over (partition by text order by doc_id) as n
        from documents) where n = 1""",
    "dedupe_lines": f"select min(seq) as seq, line from (select seq, {sql_strip('line')} as line from {LINES}) group by line",
    "dedupe_md5": "select min(doc_id) as doc_id, md5(text) as md5 from documents group by md5(text)",
    # A row is seen when every one of its positions was set by an earlier row.
    "dedupe_bloom": f"""
        with bits as {bits_sql(LINES, 'line', DEDUPE_FILTER, 'seq,')},
        firsts as (select seq, min(seq) over (partition by idx) as first from bits),
        passed as (select seq from firsts group by seq having max(first) >= seq)
        select seq, line from {LINES} join passed using (seq)""",
    "dedupe_bloom_resumed": f"""
        with allrows as (select seq, line from {LINES} union all select -1 as seq, line from {TALK_LINES}),
        bits as {bits_sql('allrows', 'line', DEDUPE_FILTER, 'seq,')},
        firsts as (select seq, min(seq) over (partition by idx) as first from bits),
        passed as (select seq from firsts where seq >= 0 group by seq having max(first) >= seq)
        select seq, line from {LINES} join passed using (seq)""",
    "bloom_bits": f"select distinct idx from {bits_sql('documents', 'text', BITS_FILTER)}",
    "bloom_contains": f"""
        with bits as (select distinct idx from {bits_sql(TALK_LINES, 'line', PROBE_FILTER)}),
        probes as {bits_sql(LINES, 'line', PROBE_FILTER, 'seq,')}
        select seq, bool_and(bits.idx is not null) as seen from probes left join bits using (idx) group by seq""",
    "novel_prompts": f"""
        select line as prompt, min(seq) as ordinal from {LINES}
        where line not in (select line from {sql_lines('benchmark', keys='item_id')}) group by line""",
    "resume_set": f"""
        select text as item from {GENERATIONS} union select {sql_strip('prompt')} from {GENERATIONS}""",
}
