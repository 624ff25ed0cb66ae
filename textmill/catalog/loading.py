"""Loading lines and files, routing by language, counting a corpus, joining response chunks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textmill.catalog.columns import FILES_SQL, LITERALS, _as_files
from textmill.catalog.common import LINES, lines, sql_strip, sql_words, table
from textmill.functions.codec import compress, decompress
from textmill.operators import ingest, language
from textmill.operators.ledger import Ledger
from textmill.plans import scratch_dir
from textmill.streaming.queries import assemble_chunks

PIECE = 20


def _docs(spark, folder):
    return table(spark, folder, "documents")


def _stored(rows, text, level=9):
    return rows.select(compress(F.col(text), level).alias("data"))


def _ingest_lines(spark, folder):
    """Lines of ``documents`` into a store that already holds the lines of ``benchmark``."""
    known = table(spark, folder, "benchmark").select(F.explode(F.split("text", "\n", -1)).alias("line")).distinct()
    added = ingest.ingest_lines(lines(spark, folder), _stored(known, "line"))
    return added.select("seq", "word", decompress(F.col("data")).alias("line"), F.col("tok").cast("long").alias("tok"))


def _ingest_files(spark, folder):
    files = _docs(spark, folder).select("doc_id", "text")
    known = table(spark, folder, "conversations").select("text").distinct()
    added = ingest.ingest_files(files, _stored(known, "text"), LITERALS, order="doc_id", keep_newline=False)
    return added.select("doc_id", "word", F.md5(decompress(F.col("data"))).alias("digest"), F.col("tok").cast("long").alias("tok"))


def _lines_indexed(spark, folder):
    """The lines of ``benchmark``, then those of ``documents``, into one ledger, which numbers them in their order."""
    ledger = Ledger(spark, f"{scratch_dir(spark)}/textmill/ledger-{uuid.uuid4().hex}")
    known = table(spark, folder, "benchmark").select("item_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    ingest.load_lines(known.select((F.shiftleft("item_id", 32) + F.col("pos")).alias("seq"), "line"), ledger, "benchmark")
    ingest.load_lines(lines(spark, folder), ledger, "documents")
    return ledger.table("texts").select("id", decompress(F.col("data")).alias("line"), F.col("tok").cast("long").alias("tok"))


def _detect(spark, folder):
    docs = _docs(spark, folder)
    return language.detect(docs, language.train(docs))


def _route(spark, folder):
    routed = language.route_languages(lines(spark, folder), language.train(_docs(spark, folder)))
    return routed.groupBy("lang").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


def pieces_of(talk):
    """Conversation texts as streamed responses: pieces of 20 characters, every fifth followed by a NULL piece."""
    pieces = talk.select(
        (F.shiftleft("conv_id", 20) + F.col("turn")).alias("response_id"),
        F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("seq", "delta"),
    )
    with_gaps = F.when(F.col("seq") % 5 == 4, F.array("delta", F.lit(None).cast("string"))).otherwise(F.array("delta"))
    return pieces.select("response_id", "seq", F.posexplode(with_gaps).alias("part", "delta")).select(
        "response_id", (F.col("seq") * 2 + F.col("part")).alias("seq"), "delta"
    )


QUERIES = {
    "ingest_lines": _ingest_lines,
    "ingest_lines_indexed": _lines_indexed,
    "ingest_files": _ingest_files,
    "content_addressed": lambda s, d: ingest.content_addressed(_as_files(s, d).drop("path"), order="doc_id").select(
        "doc_id", "name"
    ),
    "corpus_token_report": lambda s, d: ingest.count_tokens(_docs(s, d), "doc_id").select(
        "doc_id", F.col("tok").cast("long").alias("tok"), "running_tokens"
    ),
    "detect_language": _detect,
    "lines_by_language": _route,
    "assemble_chunks": lambda s, d: assemble_chunks(pieces_of(table(s, d, "conversations"))).select(
        "response_id", "text", F.col("tok").cast("long").alias("tok")
    ),
}


def _language_sql(source: str, key: str, text: str) -> str:
    """CTEs: trigram model of ``documents``, and ``best(key, lang)`` for the rows of ``source``."""

    def grams(relation: str, keys: str, column: str) -> str:
        chars = f"regexp_extract_all(lower({column}), '(?s).')"
        return f"""(select {keys}, gram from (
            select {keys}, c || lead(c, 1) over o || lead(c, 2) over o as gram
            from (select {keys}, unnest({chars}) as c, generate_subscripts({chars}, 1) as p from {relation})
            window o as (partition by {keys} order by p)) where gram is not null)"""

    return f"""
        counts as (select lang, gram, count(*) as c from {grams('documents', 'doc_id, lang', 'text')} group by all),
        sizes as (select lang, sum(c) + (select count(distinct gram) from counts) as size from counts group by lang),
        rowgrams as materialized {grams(source, key, text)},
        totals as (select {key}, count(*) as n from rowgrams group by {key}),
        parts as (select {key}, lang, sum(ln(c + 1.0)) as s from rowgrams join counts using (gram) group by all),
        scores as (select {key}, lang, coalesce(s, 0) - n * ln(size) as score
                   from totals cross join sizes left join parts using ({key}, lang)),
        best as (select {key}, lang from (
            select *, row_number() over (partition by {key} order by score desc, lang) as r from scores) where r = 1)"""


ORACLE = {
    "ingest_lines": f"""
        with stripped as (select seq, {sql_strip('line')} as line from {LINES}),
        known as (select unnest(string_split(text, chr(10))) as line from benchmark)
        select min(seq) as seq, 'archive' as word, line, len({sql_words('line')}) as tok
        from stripped where line not in (select line from known) group by line""",
    "ingest_lines_indexed": f"""
        with known as (select item_id * 4294967296 + generate_subscripts(string_split(text, chr(10)), 1) - 1 as seq,
                              unnest(string_split(text, chr(10))) as line from benchmark),
        both_runs as (select 0 as run, seq, {sql_strip('line')} as line from known
                      union all select 1, seq, {sql_strip('line')} from {LINES}),
        firsts as (select min({{'run': run, 'seq': seq}}) as place, line from both_runs group by line)
        select row_number() over (order by place) as id, line, len({sql_words('line')}) as tok from firsts""",
    "ingest_files": f"""
        with firsts as (select text, min(doc_id) as doc_id from documents group by text),
        kept as (select doc_id, len({sql_words('text')}) as tok,
                        replace(replace(replace(text, 'ing ', ''), 'the', ''), 'en', '') as cleaned from firsts),
        good as (select * from kept where tok > 20 and cleaned not in (select text from conversations))
        select doc_id, 'archive' as word, md5(cleaned) as digest, tok
        from (select *, row_number() over (partition by cleaned order by doc_id) as n from good) where n = 1""",
    "content_addressed": f"""
        with {FILES_SQL}
        select min(doc_id) as doc_id, md5(content) || '.txt' as name from utf where v_nul group by content""",
    "corpus_token_report": f"""
        select doc_id, tok, cast(sum(tok) over (order by doc_id) as bigint) as running_tokens
        from (select doc_id, len({sql_words('text')}) as tok from documents)""",
    "detect_language": f"""
        with {_language_sql('documents', 'doc_id', 'text')}
        select doc_id, coalesce(best.lang, 'undetected') as lang from documents left join best using (doc_id)""",
    "lines_by_language": f"""
        with firsts as materialized (
            select min(seq) as seq, line from (select seq, {sql_strip('line')} as line from {LINES}) group by line),
        {_language_sql('firsts', 'seq', 'line')}
        select coalesce(lang, 'undetected') as lang, count(*) as n_lines, cast(sum(len(line)) as bigint) as n_chars,
               min(seq) as first_seq, max(seq) as last_seq
        from firsts left join best using (seq) group by all""",
    "assemble_chunks": f"""
        select conv_id * 1048576 + turn as response_id, text, len({sql_words('text')}) as tok from conversations""",
}
