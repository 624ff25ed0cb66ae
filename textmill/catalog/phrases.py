"""Terms, document frequencies, TF-IDF scores and ranked phrases over ``documents``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from textmill.catalog.common import r6, sql_fused, sql_grams, sql_tokens, sql_words, table
from textmill.functions import text as tx
from textmill.operators import tfidf


def _docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def _phrase_summary(spark, folder):
    """Strings kept by an aggregate make Spark sort its input, so all phrases but the edges of a text are counted under NULL first."""
    found = tfidf.phrase_candidates(_docs(spark, folder))
    counted = found.groupBy("doc_id", F.when(F.col("edge"), F.col("ngram")).alias("ngram")).agg(
        F.count("*").alias("n"), F.sum(F.length("ngram")).alias("chars")
    )
    return counted.groupBy("doc_id").agg(
        F.sum("n").alias("n_phrases"),
        F.sum("chars").alias("n_chars"),
        F.min("ngram").alias("first_phrase"),
        F.max("ngram").alias("last_phrase"),
    )


def _idf_report(spark, folder):
    """Strings kept by an aggregate make Spark sort its input, so each batch of terms is reduced to its frequencies first."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by("df").aggregate([("term", "count"), ("idf", "max"), ("term", "min")])
            yield from found.select(["df", "term_count", "idf_max", "term_min"]).rename_columns(["df", "n", "idf", "term"]).to_batches()

    found = tfidf.idf(_docs(spark, folder)).mapInArrow(reduced, "df long, n long, idf double, term string")
    return found.groupBy("df").agg(F.sum("n").alias("n_terms"), r6(F.max("idf")).alias("idf"), F.min("term").alias("first_term"))


def _ranked(spark, folder, sanitized=False, **args):
    docs = _docs(spark, folder)
    if sanitized:
        docs = docs.withColumn("text", tx.sanitize("text"))
    return tfidf.rank_phrases(docs, docs, **args).withColumn("score", r6("score")).withColumn(
        "rank", F.col("rank").cast("long")
    )


def top_phrases(spark, folder):
    """Sanitized texts, phrases of one to six words scoring 0.01 or more, the ten best of each."""
    return _ranked(spark, folder, sanitized=True, min_score=0.01, min_ngrams=1, max_ngrams=6, top=10)


QUERIES = {
    "word_tokens": lambda s, d: _docs(s, d)
    .select("doc_id", F.explode(tx.word_tokens(F.col("text"))).alias("token"))
    .groupBy("token")
    .agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")),
    "term_frequency": lambda s, d: tfidf.term_frequency(_docs(s, d)),
    "document_frequency": lambda s, d: tfidf.document_frequency(_docs(s, d)),
    "idf": _idf_report,
    "phrase_candidates": _phrase_summary,
    "tfidf_scores": lambda s, d: tfidf.tfidf_scores(_docs(s, d), _docs(s, d)).withColumn("score", r6("score")),
    "top_terms": lambda s, d: tfidf.top_terms(_docs(s, d), _docs(s, d), 10)
    .withColumn("score", r6("score"))
    .withColumn("rank", F.col("rank").cast("long")),
    "rank_phrases": lambda s, d: _ranked(s, d),
    "top_phrases": top_phrases,
    "tfidf_expanding": lambda s, d: tfidf.tfidf_expanding(_docs(s, d)).withColumn("score", r6("score")),
}


def _scored_sql(text: str = "text") -> str:
    """CTEs: fit terms ``df``, score terms ``sc(doc_id, term, score)`` against the whole table."""
    return f"""
    docs as (select doc_id, {text} as text from documents),
    ft as (select doc_id, {sql_tokens('text')} as w from docs),
    df as (select gram as term, count(distinct doc_id) as df from {sql_grams('ft', 1, 3)} group by gram),
    st as (select doc_id, {sql_tokens(sql_fused('text'))} as w from docs),
    tf as (select doc_id, gram as term, count(*) as tf from {sql_grams('st', 1, 3)} group by all),
    w as (select doc_id, term, tf * (ln((1.0 + (select count(*) from docs)) / (1.0 + df)) + 1) as w
          from tf join df using (term)),
    sc as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as score from w)"""


def _ranked_sql(text: str, low: int, high: int, minimum: float, top: int | None = None) -> str:
    return f"""
    with {_scored_sql(text)},
    cw as (select doc_id, {sql_words(sql_fused('text'))} as w from docs),
    cand as (select distinct doc_id, gram as ngram from {sql_grams('cw', low, high)}),
    joined as (select c.doc_id, ngram, coalesce(case when score > {minimum} then score end, 0.0) as score,
                      count(*) over (partition by c.doc_id) as n
               from cand c left join sc on sc.doc_id = c.doc_id and sc.term = c.ngram),
    ranked as (select doc_id, ngram, score,
                      row_number() over (partition by doc_id order by score desc, ngram) as rank
               from joined where score >= {minimum} or n < {low})
    select doc_id, ngram, round(score, 6) as score, rank from ranked
    {f'where rank <= {top}' if top else ''}"""


ORACLE = {
    "word_tokens": f"""
        select token, count(*) as n, min(doc_id) as first_doc
        from (select doc_id, unnest({sql_tokens('text')}) as token from documents) group by token""",
    "term_frequency": f"""
        with ft as (select doc_id, {sql_tokens('text')} as w from documents)
        select doc_id, gram as term, count(*) as tf from {sql_grams('ft', 1, 3)} group by all""",
    "document_frequency": f"""
        with ft as (select doc_id, {sql_tokens('text')} as w from documents)
        select gram as term, count(distinct doc_id) as df from {sql_grams('ft', 1, 3)} group by gram""",
    "idf": f"""
        with {_scored_sql()}
        select df, count(*) as n_terms,
               round(ln((1.0 + (select count(*) from docs)) / (1.0 + df)) + 1, 6) as idf, min(term) as first_term
        from df group by df""",
    "phrase_candidates": f"""
        with cw as (select doc_id, {sql_words(sql_fused('text'))} as w from documents)
        select doc_id, count(*) as n_phrases, cast(sum(len(ngram)) as bigint) as n_chars,
               min(ngram) as first_phrase, max(ngram) as last_phrase
        from (select distinct doc_id, gram as ngram from {sql_grams('cw', 2, 10)}) group by doc_id""",
    "tfidf_scores": f"""
        with {_scored_sql()} select doc_id, term, round(score, 6) as score from sc where score > 0.2""",
    "top_terms": f"""
        with {_scored_sql()},
        rk as (select *, row_number() over (partition by doc_id order by score desc, term) as rank from sc)
        select doc_id, term, round(score, 6) as score, rank from rk where rank <= 10""",
    "rank_phrases": _ranked_sql("text", 2, 10, 0.2),
    "top_phrases": _ranked_sql(r"regexp_replace(text, '\n+', chr(10), 'g')", 1, 6, 0.01, 10),
    "tfidf_expanding": f"""
        with ft as (select doc_id, {sql_tokens('text')} as w from documents),
        ev as (select distinct doc_id, gram as term from {sql_grams('ft', 1, 3)}),
        st as (select doc_id, {sql_tokens(sql_fused('text'))} as w from documents),
        tf as (select doc_id, gram as term, count(*) as tf from {sql_grams('st', 1, 3)} group by all),
        allrows as (select coalesce(ev.doc_id, tf.doc_id) as doc_id, coalesce(ev.term, tf.term) as term,
                           case when ev.doc_id is null then 0 else 1 end as fit, coalesce(tf.tf, 0) as tf
                    from ev full join tf on ev.doc_id = tf.doc_id and ev.term = tf.term),
        seen as (select *, sum(fit) over (partition by term order by doc_id) as df from allrows),
        n as (select doc_id, row_number() over (order by doc_id) as n from documents),
        w as (select s.doc_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1) as w
              from seen s join n on n.doc_id = s.doc_id where tf > 0 and df > 0),
        sc as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as score from w)
        select doc_id, term, round(score, 6) as score from sc where score > 0.2""",
}
