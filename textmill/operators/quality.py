"""Window scores of generations: bigram perplexity, similarity to the prompt, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.operators import tfidf
from textmill.plans import lookup_join, materialize, spread


def chunk_tokens(gens: DataFrame, window: int = 100, gen: str = "gen", text: str = "text") -> DataFrame:
    """``(gen, window, chunk)``: runs of ``window`` words, the last one shorter.

    One linear scan of the text, no shuffle.
    """
    word, space = r"[^\s\x1c-\x1f]", r"[\s\x1c-\x1f]"
    runs = F.regexp_extract_all(F.col(text), F.lit(f"(?U)(?:{word}++{space}*+){{1,{window}}}+"), F.lit(0))
    return gens.select(gen, F.posexplode(runs).alias("window", "_run")).select(
        gen, "window", F.regexp_replace(tx.strip(F.col("_run")), f"(?U){space}+", " ").alias("chunk")
    )


def _bigram_keys(text: Column) -> Column:
    """Per pair of neighbours: the first word, and the pair. Words hold no space."""
    return tx.let(
        tx.whitespace_words(text),
        lambda words: F.concat(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), tx.ngrams(words, 2, 2)
        ),
    )


def bigram_model(texts: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """``(key, n)`` counts of first words and pairs, and the number of distinct words."""
    rows = spread(texts.select(text))
    keys = rows.select(F.explode(_bigram_keys(F.col(text))).alias("key"))
    counts = materialize(keys.groupBy("key").agg(F.count("*").alias("n")), "bigrams")
    words = rows.select(F.explode(tx.whitespace_words(F.col(text))).alias("w")).distinct().count()
    return counts, words


def chunk_perplexity(
    chunks: DataFrame, model: tuple[DataFrame, int], gen: str = "gen", chunk: str = "chunk"
) -> DataFrame:
    """``(gen, window, perplexity)``: exp of the mean negative log-likelihood, add-one smoothed.

    ``-log p = log(n(first) + V) - log(n(pair) + 1)``, so one join by key serves both counts.
    A chunk of fewer than two words has no perplexity.
    """
    counts, vocabulary = model
    is_pair = F.contains("key", F.lit(" "))
    cost = F.when(is_pair, -F.log1p("n")).otherwise(F.log(F.col("n") + vocabulary))
    lookup = counts.select("key", "n", cost.alias("cost"))
    item = F.concat_ws(":", F.col(gen).cast("string"), F.col("window").cast("string"))
    rows = spread(chunks.select(gen, "window", chunk, item.alias("_item"))).select(
        gen, "window", "_item", F.explode(_bigram_keys(F.col(chunk))).alias("key")
    )
    found = lookup_join(rows, lookup, "key", "n", "_item", how="left")
    unseen = F.when(is_pair, 0.0).otherwise(F.log(F.lit(float(max(vocabulary, 1)))))
    scored = found.groupBy(gen, "window").agg(
        F.exp(F.sum(F.coalesce("cost", unseen)) / F.sum(F.when(is_pair, 1).otherwise(0))).alias("perplexity")
    )
    return chunks.select(gen, "window").join(scored, [gen, "window"], "left")


def prompt_chunk_similarity(
    pairs: DataFrame, chunks: DataFrame, corpus: DataFrame, gen: str = "gen", prompt: str = "prompt"
) -> DataFrame:
    """``(gen, window, similarity)``: cosine of the TF-IDF vectors of prompt and chunk."""
    items = pairs.select(gen, F.lit(-1).alias("window"), F.col(prompt).alias("text")).unionByName(
        chunks.select(gen, "window", F.col("chunk").alias("text"))
    )
    item = F.concat_ws(":", F.col(gen).cast("string"), F.col("window").cast("string"))
    scored = tfidf.tfidf_scores(items.withColumn("_item", item), corpus, 0.0, doc="_item").select(
        F.substring_index("_item", ":", -1).cast("int").alias("window"),
        F.expr("substring(_item, 1, length(_item) - length(substring_index(_item, ':', -1)) - 1)").alias("_gen"),
        "term",
        "score",
    )
    scored = materialize(scored, "vectors")
    left = scored.where("window = -1").select("_gen", "term", F.col("score").alias("_p"))
    right = scored.where("window >= 0")
    dots = right.join(left, ["_gen", "term"]).groupBy("_gen", "window").agg(F.sum(F.col("score") * F.col("_p")).alias("s"))
    return (
        chunks.select(gen, "window", F.col(gen).cast("string").alias("_gen"))
        .join(dots, ["_gen", "window"], "left")
        .select(gen, "window", F.coalesce("s", F.lit(0.0)).alias("similarity"))
    )


def penalized(perplexity: str = "perplexity", factor: float = 2.0) -> Column:
    return F.avg(perplexity) + factor * F.stddev_pop(perplexity)


def quality_summary(scores: DataFrame, gen: str = "gen", factor: float = 2.0) -> DataFrame:
    measures = [
        fn(name).alias(f"{label}_{name}")
        for name in ("perplexity", "similarity")
        for label, fn in (("avg", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
    ]
    return scores.groupBy(gen).agg(penalized("perplexity", factor).alias("penalized_perplexity"), *measures)


def evaluate_windows(
    gens: DataFrame, window: int = 100, gen: str = "gen", prompt: str = "prompt", text: str = "text"
) -> DataFrame:
    """``(gen, window, preview, perplexity, similarity)`` of every chunk of every generation.

    The bigram model and the document frequencies come from the generations themselves.
    """
    gens = materialize(gens.select(gen, prompt, text), "generations")
    chunks = materialize(chunk_tokens(gens, window, gen, text), "chunks")
    perplexity = chunk_perplexity(chunks, bigram_model(gens, text), gen)
    similarity = prompt_chunk_similarity(gens, chunks, gens.select(F.col(text).alias("text")), gen, prompt)
    return (
        chunks.select(gen, "window", tx.preview(F.col("chunk")).alias("preview"))
        .join(perplexity, [gen, "window"])
        .join(similarity, [gen, "window"])
    )


def evaluate_generations(
    gens: DataFrame, window: int = 100, factor: float = 2.0, gen: str = "gen", prompt: str = "prompt", text: str = "text"
) -> DataFrame:
    return quality_summary(evaluate_windows(gens, window, gen, prompt, text), gen, factor)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two float arrays; NULL when one has no length."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v
    )
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))
