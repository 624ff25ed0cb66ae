import math
import statistics
from collections import Counter

from pyspark.sql import functions as F

from textmill.operators import quality
from tests.test_tfidf import brute_scores


GENS = [(1, "red fox", "the red fox runs and the red fox sleeps"), (2, "blue", "one"), (3, "dog", "the dog runs\nthe dog sleeps at home")]


def frame(spark):
    return spark.createDataFrame(GENS, "gen long, prompt string, text string")


def test_chunks(spark):
    df = spark.createDataFrame([(1, "  a b\nc\td  e "), (2, ""), (3, "x y")], "gen long, text string")
    rows = quality.chunk_tokens(df, 2).collect()
    assert sorted((r.gen, r.window, r.chunk) for r in rows) == [(1, 0, "a b"), (1, 1, "c d"), (1, 2, "e"), (3, 0, "x y")]


def test_evaluation_against_brute_force(spark):
    first, pairs, words = Counter(), Counter(), set()
    for _, _, text in GENS:
        w = text.split()
        words.update(w)
        first.update(w[:-1])
        pairs.update(zip(w, w[1:]))
    v = len(words)
    wanted = {}
    corpus = [t for _, _, t in GENS]
    for gen, prompt, text in GENS:
        w = text.split()
        for n in range(0, len(w), 4):
            chunk = w[n : n + 4]
            costs = [math.log(first[a] + v) - math.log(pairs[a, b] + 1) for a, b in zip(chunk, chunk[1:])]
            p, c = brute_scores(prompt, corpus) if prompt != "blue" else {}, brute_scores(" ".join(chunk), corpus)
            similar = sum(p[t] * c[t] for t in p.keys() & c.keys())
            wanted[gen, n // 4] = (math.exp(sum(costs) / len(costs)) if costs else None, similar)
    rows = quality.evaluate_windows(frame(spark), 4).collect()
    assert {(r.gen, r.window) for r in rows} == set(wanted)
    for r in rows:
        ppl, similar = wanted[r.gen, r.window]
        assert (r.perplexity is None) == (ppl is None)
        assert ppl is None or math.isclose(r.perplexity, ppl, rel_tol=1e-9)
        assert math.isclose(r.similarity, similar, abs_tol=1e-9)
    summary = {r.gen: r for r in quality.evaluate_generations(frame(spark), 4, 2.0).collect()}
    values = [p for (g, _), (p, _) in wanted.items() if g == 1 and p is not None]
    assert math.isclose(summary[1].penalized_perplexity, statistics.mean(values) + 2 * statistics.pstdev(values))
    assert summary[2].avg_perplexity is None


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0], [1.0])], "a array<float>, b array<float>")
    rows = df.select(quality.cosine_similarity(F.col("a"), F.col("b")).alias("c")).collect()
    assert math.isclose(rows[0].c, 0.96) and rows[1].c is None
