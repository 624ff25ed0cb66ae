"""Quality scores of the assistant turns of ``conversations``, and embedding similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.common import GENERATIONS, generations, r6, sql_fused, sql_grams, sql_tokens, sql_words, table
from textmill.operators import quality

WINDOW = 50


def _chunks(spark, folder):
    return quality.chunk_tokens(generations(spark, folder), WINDOW)


def _round(df, *names, places=6):
    for name in names:
        df = df.withColumn(name, F.round(name, places) + F.lit(0.0))
    return df


def _perplexity(spark, folder):
    gens = generations(spark, folder)
    scored = quality.chunk_perplexity(_chunks(spark, folder), quality.bigram_model(gens))
    return _round(scored.withColumn("window", F.col("window").cast("long")), "perplexity", places=4)


def _similarity(spark, folder):
    gens = generations(spark, folder)
    found = quality.prompt_chunk_similarity(gens, _chunks(spark, folder), gens.select("text"))
    return _round(found.withColumn("window", F.col("window").cast("long")), "similarity")


def _windows(spark, folder):
    scored = quality.evaluate_windows(generations(spark, folder), WINDOW)
    scored = _round(scored.withColumn("window", F.col("window").cast("long")), "perplexity", places=4)
    return _round(scored, "similarity")


MEASURES = [f"{a}_{b}" for b in ("perplexity", "similarity") for a in ("avg", "std", "min", "max")]


def _evaluate(spark, folder):
    summary = quality.evaluate_generations(generations(spark, folder), WINDOW)
    return _round(summary, "penalized_perplexity", *MEASURES, places=4)


def _summary(spark, folder):
    """The summary over stored scores: event values stand for both measures, per user."""
    scores = table(spark, folder, "events").select(
        "user_id", F.col("value").alias("perplexity"), (F.col("value") / 7).alias("similarity")
    )
    return _round(quality.quality_summary(scores, "user_id"), "penalized_perplexity", *MEASURES, places=4)


def _cosine(spark, folder):
    """Each vector against the next one by id: an equi-join, not all pairs."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    cosine = quality.cosine_similarity(F.col("embedding"), F.col("other"))
    return vectors.join(following, "vec_id").select("vec_id", r6(cosine).alias("cosine"))


QUERIES = {
    "chunk_tokens": lambda s, d: _chunks(s, d).withColumn("window", F.col("window").cast("long")),
    "chunk_documents": lambda s, d: quality.chunk_tokens(table(s, d, "documents"), 100, "doc_id")
    .withColumn("window", F.col("window").cast("long")),
    "chunk_perplexity": _perplexity,
    "prompt_chunk_similarity": _similarity,
    "evaluate_windows": _windows,
    "evaluate_generations": _evaluate,
    "quality_summary": _summary,
    "embedding_cosine": _cosine,
}


def _chunk_sql(source: str, key: str, window: int) -> str:
    return f"""(select {key}, p // {window} as "window", string_agg(w, ' ' order by p) as chunk
        from (select {key}, unnest(w) as w, generate_subscripts(w, 1) - 1 as p
              from (select {key}, {sql_words('text')} as w from {source})) group by all)"""


PERPLEXITY_SQL = f"""
    gens as materialized (select * from {GENERATIONS}),
    chunks as materialized (select * from {_chunk_sql('gens', 'gen', WINDOW)}),
    toks as (select gen, unnest(w) as w, generate_subscripts(w, 1) as p from (select gen, {sql_words('text')} as w from gens)),
    pairs as (select w as a, lead(w) over (partition by gen order by p) as b from toks),
    n_pair as (select a, b, count(*) as n from pairs where b is not null group by all),
    n_first as (select a, count(*) as n from pairs where b is not null group by a),
    vocabulary as (select count(distinct w) as v from toks),
    ctoks as (select gen, "window", unnest(w) as w, generate_subscripts(w, 1) as p
              from (select gen, "window", string_split(chunk, ' ') as w from chunks)),
    cpairs as (select gen, "window", w as a, lead(w) over (partition by gen, "window" order by p) as b from ctoks),
    ppl as (select gen, "window", exp(avg(ln(n_first.n + (select v from vocabulary)) - ln(n_pair.n + 1.0))) as perplexity
            from cpairs join n_pair using (a, b) join n_first using (a) group by all),
    perplexities as (select gen, "window", perplexity from chunks left join ppl using (gen, "window"))"""

SIMILARITY_SQL = f"""
    ft as (select gen, {sql_tokens('text')} as w from gens),
    df as (select gram as term, count(distinct gen) as df from {sql_grams('ft', 1, 3, 'gen')} group by gram),
    items as (select gen::varchar || ':' || "window"::varchar as item, gen, "window", chunk as text from chunks
              union all select gen::varchar || ':-1', gen, -1, prompt from gens),
    st as (select item, {sql_tokens(sql_fused('text'))} as w from items),
    tf as (select item, gram as term, count(*) as tf from {sql_grams('st', 1, 3, 'item')} group by all),
    wt as (select item, term, tf * (ln((1.0 + (select count(*) from gens)) / (1.0 + df)) + 1) as w from tf join df using (term)),
    sc as materialized (select item, gen, "window", term, w / sqrt(sum(w * w) over (partition by item)) as score
           from wt join items using (item)),
    dots as (select c.gen, c."window", sum(c.score * p.score) as s
             from sc c join sc p on p.gen = c.gen and p.term = c.term where c."window" >= 0 and p."window" = -1 group by all),
    similarities as (select gen, "window", coalesce(s, 0.0) as similarity from chunks left join dots using (gen, "window"))"""

SUMMARY_SQL = ", ".join(
    ["round(avg(perplexity) + 2.0 * stddev_pop(perplexity), 4) as penalized_perplexity"]
    + [
        f"round({fn}({name}), 4) as {label}_{name}"
        for name in ("perplexity", "similarity")
        for label, fn in (("avg", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max"))
    ]
)

ORACLE = {
    "chunk_tokens": f"select * from {_chunk_sql(GENERATIONS, 'gen', WINDOW)}",
    "chunk_documents": f"select * from {_chunk_sql('documents', 'doc_id', 100)}",
    "chunk_perplexity": f'with {PERPLEXITY_SQL} select gen, "window", round(perplexity, 4) as perplexity from perplexities',
    "prompt_chunk_similarity": f"""
        with {PERPLEXITY_SQL}, {SIMILARITY_SQL}
        select gen, "window", round(similarity, 6) as similarity from similarities""",
    "evaluate_windows": f"""
        with {PERPLEXITY_SQL}, {SIMILARITY_SQL}
        select gen, "window", chunk[1:100] || '...' as preview, round(perplexity, 4) as perplexity,
               round(similarity, 6) as similarity
        from chunks join perplexities using (gen, "window") join similarities using (gen, "window")""",
    "evaluate_generations": f"""
        with {PERPLEXITY_SQL}, {SIMILARITY_SQL}
        select gen, {SUMMARY_SQL} from perplexities join similarities using (gen, "window") group by gen""",
    "quality_summary": f"""
        select user_id, {SUMMARY_SQL}
        from (select user_id, value as perplexity, value / 7 as similarity from events) group by user_id""",
    "embedding_cosine": """
        select a.vec_id, round(list_dot_product(a.embedding::double[], b.embedding::double[])
            / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])
                   * list_dot_product(b.embedding::double[], b.embedding::double[])), 6) as cosine
        from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
}
