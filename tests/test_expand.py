import random
from collections import deque
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textmill.functions import udf
from textmill.functions.codec import decompress
from textmill.operators import expand
from textmill.plans import scratch_dir, skew
from tests.test_tfidf import brute_rank


def frame(spark, answers):
    return spark.createDataFrame([(p, r, len(r.split())) for p, r in answers.items()], "prompt string, response string, tok int")


def walk(root, answers, prefixes, max_depth, visited=()):
    """Breadth-first expansion of one root, one prompt after the other."""
    seen, queue, found = set(visited), deque([(root, 0)]), []
    while queue:
        prompt, depth = queue.popleft()
        if prompt not in answers:
            continue
        text = __import__("re").sub("\n+", "\n", answers[prompt])
        found.append((root, prompt, depth, text))
        for line in text.split("\n"):
            for prefix in prefixes:
                child = f"{prefix} {line}" if prefix else line
                if child not in seen:
                    seen.add(child)
                    if depth + 1 < max_depth:
                        queue.append((child, depth + 1))
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_expansion_matches_walk(spark, monkeypatch, seed):
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + [""]
    prefixes = rng.choice([("",), ("", "on"), ("on",)])
    stock = words + [f"on {w}" for w in words[:6]]
    answers = {w: "\n".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for w in stock if rng.random() < 0.9}
    roots = ["w0", "w1", "w2", "w3"]
    visited = ["w5"]
    seeds = spark.createDataFrame([(r,) for r in roots], "word string")
    past = spark.createDataFrame([(v,) for v in visited], "prompt string")
    found = expand.expand_frontier(seeds, expand.table_responder(frame(spark, answers)), prefixes, 4, visited=past)
    wanted = sorted(row for root in roots for row in walk(root, answers, prefixes, 4, visited))
    assert sorted((r.word, r.prompt, r.depth, r.text) for r in found.collect()) == wanted


def test_root_may_come_back_once(spark):
    seeds = spark.createDataFrame([("a",)], "word string")
    found = expand.expand_frontier(seeds, expand.table_responder(frame(spark, {"a": "b", "b": "a"})), max_depth=9)
    assert sorted((r.prompt, r.depth) for r in found.collect()) == [("a", 0), ("a", 2), ("b", 1)]


def test_shared_visited_and_callable(spark):
    seeds = spark.createDataFrame([("a",), ("b",)], "word string")
    answer = udf.respond_with(lambda prompts: (["c" for _ in prompts], [1 for _ in prompts]))
    found = expand.expand_frontier(seeds, answer, max_depth=2, shared_visited=True)
    assert sorted((r.word, r.prompt) for r in found.collect()) == [("a", "a"), ("a", "c"), ("b", "b")]


def test_think_tags_and_prompt_removal(spark):
    seeds = spark.createDataFrame([("q<think>x\n</think>",)], "word string")
    found = expand.expand_frontier(
        seeds, expand.table_responder(frame(spark, {"q": "q is\n\nq"})), max_depth=1, strip_think=True, remove_prompt=True
    ).collect()
    assert [(r.prompt, r.text) for r in found] == [("q", " is\n")]


def test_phrase_children(spark):
    answers = {"a": "red fox runs\nred fox", "b": "blue fox sleeps", "red fox": "x y"}
    seeds = spark.createDataFrame([("a",), ("b",)], "word string")
    args = {"min_score": 0.2, "min_ngrams": 2, "max_ngrams": 3}
    found = expand.expand_frontier(
        seeds, expand.table_responder(frame(spark, answers)), max_depth=2, phrases=args
    ).collect()
    phrases = [g for g, _ in brute_rank(answers["a"], [answers["a"], answers["b"]], 0.2, 2, 3)]
    assert "red fox" in phrases
    assert ("a", "red fox", 1) in {(r.word, r.prompt, r.depth) for r in found}
    level1 = {r.prompt for r in found if r.depth == 1}
    assert level1 == {p for p in phrases if p in answers}


def test_candidates_keep_empty_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb")], "doc_id long, text string")
    rows = expand.prompt_candidates(df, ("", "p")).orderBy("ordinal").collect()
    assert [r.prompt for r in rows] == ["a", "p a", "", "p ", "b", "p b"]


def test_shuffle_is_repeatable(spark):
    df = spark.createDataFrame([(i, f"p{i % 3}") for i in range(50)], "ordinal long, prompt string")
    order = lambda seed: [r.ordinal for r in expand.shuffle_prompts(df, seed).orderBy("position").collect()]
    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == list(range(50))


def test_store_keeps_each_text_once(spark):
    seeds = spark.createDataFrame([("a",), ("b",)], "word string")
    gens = expand.expand_frontier(seeds, expand.table_responder(frame(spark, {"a": "t", "b": "t", "t": "u"})), max_depth=2)
    rows = expand.grow_store(gens, algo="zstd").select("word", decompress(F.col("data"), F.col("compression_algo")).alias("t"))
    assert sorted(rows.collect()) == [("a", "t"), ("a", "u")]


def test_a_prompt_is_asked_once_for_all_levels(spark):
    asked = []

    def answer(prompts):
        asked.extend(r.prompt for r in prompts.collect())
        return frame(spark, {"a": "x", "x": "y", "b": "y", "y": "z"}).join(prompts, "prompt")

    seeds = spark.createDataFrame([("a",), ("b",)], "word string")
    found = expand.expand_frontier(seeds, answer, max_depth=4)
    assert sorted((r.word, r.prompt, r.depth) for r in found.collect()) == [("a", "a", 0), ("a", "x", 1), ("a", "y", 2), ("b", "b", 0), ("b", "y", 1)]
    assert sorted(p for p in asked if p in "abxy") == ["a", "b", "x", "y"]


def test_answers_stay_where_they_lie(spark):
    responder = expand.table_responder(frame(spark, {f"p{i}": f"p{i + 1}\np{i + 2}" for i in range(50)}))
    told = responder(spark.createDataFrame([("p3",), ("p7",), ("none",)], "prompt string"))
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.prompt, r.response) for r in told.collect()) == [("p3", "p4\np5"), ("p7", "p8\np9")]
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert len(moved) == 1 and "Bucketed: true" in plan and "Sort " not in plan


def test_stripped_prompts_meet_over_levels(spark):
    answers = {"a": "q<think>1</think>\nr", "r": "<think>2</think>q\ns", "q": "end", "s": "t"}
    seeds = spark.createDataFrame([("a",)], "word string")
    found = expand.expand_frontier(seeds, expand.table_responder(frame(spark, answers)), max_depth=4, strip_think=True).collect()
    assert sorted((r.prompt, r.depth, r.text) for r in found) == [
        ("a", 0, answers["a"]), ("q", 1, "end"), ("q", 2, "end"), ("r", 1, answers["r"]), ("s", 2, "t")
    ]


def test_phrases_are_ranked_once_for_all_roots(spark):
    """Roots that share prompts: a text counts for each of them, but moves once."""
    answers = {f"r{i}": f"red fox {'runs' if i % 2 else 'sleeps'}" for i in range(6)}
    answers |= {"red fox": "blue dog barks\nred fox", "fox runs": "blue dog", "blue dog": "green owl"}
    folder = Path(scratch_dir(spark).removeprefix("file:")) / "textmill"
    before = set(folder.glob("level-*"))
    seeds = spark.createDataFrame([(f"r{i}",) for i in range(6)], "word string")
    args = {"min_score": 0.2, "min_ngrams": 1, "max_ngrams": 2}
    found = expand.expand_frontier(seeds, expand.table_responder(frame(spark, answers)), max_depth=3, phrases=args).collect()
    wanted, level, past = set(), [(f"r{i}", f"r{i}") for i in range(6)], []
    seen = set()
    for depth in range(3):
        level = [(w, p) for w, p in level if p in answers]
        wanted |= {(w, p, depth) for w, p in level}
        past += [answers[p] for _, p in level]
        level = {(w, g) for w, p in level for g, _ in brute_rank(answers[p], past, 0.2, 1, 2)} - seen
        seen |= level
    assert {(r.word, r.prompt, r.depth) for r in found} == wanted and len(found) == len(wanted) > 12
    levels = [spark.read.parquet(str(p)) for p in set(folder.glob("level-*")) - before]
    assert levels and not any("word" in x.columns for x in levels) and sum(x.count() for x in levels) < len(found)
