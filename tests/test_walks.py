"""Ordered walks against a walker with a stack, and a Bloom walk against a filter fed one by one."""

import random
import re
from pathlib import Path

import pytest

from textmill.functions.bloom import bloom_indexes
from textmill.operators import expand, walks
from textmill.plans import scratch_dir, skew


def frame(spark, answers):
    return expand.table_responder(spark.createDataFrame([(p, r, len(r.split())) for p, r in answers.items()], "prompt string, response string, tok int"))


def children(text, prefixes):
    return [f"{p} {line}" if p else line for line in re.sub("\n+", "\n", text).split("\n") for p in prefixes]


def stack_walk(root, answers, prefixes, max_depth, visited):
    """(word, prompt, depth) in the order of handling."""
    stack, seen, found = [(root, 0)], set(visited), []
    while stack:
        prompt, depth = stack.pop()
        if prompt not in answers:
            continue
        found.append((root, prompt, depth))
        fresh = []
        for child in children(answers[prompt], prefixes):
            if child not in seen:
                seen.add(child)
                fresh.append((child, depth + 1))
        stack += [c for c in reversed(fresh) if c[1] < max_depth]
    return found


@pytest.mark.parametrize("seed", range(4))
def test_depth_first_is_the_order_of_a_stack(spark, monkeypatch, seed):
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)] + [""]
    prefixes = rng.choice([("",), ("", "on")])
    stock = words + [f"on {w}" for w in words[:8]]
    answers = {w: "\n".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for w in stock if rng.random() < 0.95}
    roots, visited, depth = ["w0", "w1", "w2"], ["w5"], rng.choice([2, 4, 6])
    seeds = spark.createDataFrame([(r,) for r in roots], "word string")
    past = spark.createDataFrame([(v,) for v in visited], "prompt string")
    found = walks.expand_depth_first(seeds, frame(spark, answers), prefixes, depth, visited=past).collect()
    got = sorted(found, key=lambda r: (r.word, r.path))
    assert [(r.word, r.prompt, r.depth) for r in got] == [x for root in roots for x in stack_walk(root, answers, prefixes, depth, visited)]


def test_depth_first_differs_from_breadth_first(spark):
    answers = {"r": "x\ny", "x": "z", "z": "y2", "y": "z\nk", "y2": "k", "k": "end"}
    seeds = spark.createDataFrame([("r",)], "word string")
    deep = {(r.prompt, r.depth) for r in walks.expand_depth_first(seeds, frame(spark, answers), max_depth=4).collect()}
    wide = {(r.prompt, r.depth) for r in expand.expand_frontier(seeds, frame(spark, answers), max_depth=4).collect()}
    assert ("k", 2) in wide and not any(p == "k" for p, _ in deep)  # met at the last depth first, so never asked
    think = walks.expand_depth_first(spark.createDataFrame([("r<think>x</think>",)], "word string"), frame(spark, answers), max_depth=1, strip_think=True)
    assert [r.text for r in think.collect()] == ["x\ny"]


@pytest.mark.parametrize("power2", [5, 20])
def test_bloom_walk_feeds_one_filter_in_order(spark, power2):
    rng = random.Random(power2)
    words = [f"w{i}" for i in range(40)]
    answers = {w: "\n".join(rng.choice(words) for _ in range(3)) for w in words}
    roots = ["w0", "w1", "w2"]
    items = spark.createDataFrame([(w,) for w in words], "item string")
    bits = {r[0]: set(r[1]) for r in items.select("item", bloom_indexes("item", power2=power2, k=2)).collect()}
    held = set(bits["w7"])
    level, wanted = [(r, r) for r in roots], []
    for depth in range(4):
        wanted += [(word, prompt, depth) for word, prompt in level]
        following = []
        for word, prompt in level:
            for child in dict.fromkeys(answers[prompt].split("\n")):
                if not bits[child] <= held:
                    held |= bits[child]
                    following.append((word, child))
        level = following
    seeds = spark.createDataFrame([(r,) for r in roots], "word string")
    history = spark.createDataFrame([("w7",)], "item string")
    found = walks.expand_bloom(seeds, frame(spark, answers), max_depth=4, history=history, power2=power2, k=2).collect()
    assert sorted((r.word, r.prompt, r.depth) for r in found) == sorted(wanted)
    alone = walks.expand_bloom(seeds, frame(spark, answers), max_depth=1, power2=power2, k=2).collect()
    assert sorted(r.prompt for r in alone) == roots


@pytest.mark.parametrize("walk, label", [(walks.expand_depth_first, "walk"), (walks.expand_bloom, "fresh")])
def test_walks_go_by_keys(spark, walk, label):
    folder = Path(scratch_dir(spark).removeprefix("file:")) / "textmill"
    before = set(folder.glob("*"))
    seeds = spark.createDataFrame([("a",)], "word string")
    found = walk(seeds, frame(spark, {"a": "b\nc", "b": "c", "c": "a"}), max_depth=3).collect()
    assert {r.prompt for r in found} == {"a", "b", "c"}
    written = [spark.read.parquet(str(p)).columns for p in set(folder.glob("*")) - before if label in p.name]
    assert written and not any({"word", "prompt"} & set(columns) for columns in written)
