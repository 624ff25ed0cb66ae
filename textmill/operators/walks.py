"""Walks in a stated order: depth first, and breadth first through one Bloom filter.

A prompt's place is its path, the numbers of the children that lead to it, eight hex digits each; paths compare as strings, and a
path stands before those that go on from it. That is the order in which a walker with a stack would handle the prompts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.bloom import bloom_indexes
from textmill.operators import dedupe
from textmill.operators.expand import Asked, Responder, numbered_roots
from textmill.plans import Dealt, hot_values, materialize, salted_join

STEP = 8  # hex digits of a child's number


def _step(number: Column, digits: int = STEP) -> Column:
    return F.lpad(F.hex(number), digits, "0")


def expand_depth_first(
    seeds: DataFrame,
    responder: Responder,
    prefixes: Sequence[str] = ("",),
    max_depth: int = 10,
    visited: DataFrame | None = None,
    strip_think: bool = False,
    remove_prompt: bool = False,
) -> DataFrame:
    """``(word, prompt, depth, path, text, tok)`` of every generation of a walk that goes down each first child before the next.

    Each root of ``seeds(word)`` walks alone. A prompt belongs to the first handled one that has it as a child, at whatever depth, and is asked
    when that depth is below ``max_depth``; so a prompt first met at the last depth is never asked. ``visited(prompt)`` are never asked; a root may come
    back once as a child.

    Who is handled first depends on who belongs where, so places are settled in rounds over all roots at once: each prompt goes to its
    earliest parent by the places of the round before, until none moves. What a walker handles first is right after the first round, and with the
    first ``n`` right the next is right too, so the rounds end at the walker's order and nowhere else. A prompt is asked once for all roots and rounds.
    """
    roots = numbered_roots(seeds)
    asked = Asked(seeds, responder, prefixes, visited, strip_think, remove_prompt)
    start = roots.select("w", "p", F.lit("").alias("path"), F.lit(0).alias("depth"))
    nodes: DataFrame | None = None
    stock = roots.select("p", F.col("word").alias("prompt"))
    while True:
        walked = start if nodes is None else start.unionByName(nodes)
        asked.ask(walked, stock if nodes is None else None)
        turns = asked.turns(walked)
        met = salted_join(turns, asked.edges.rows(), ["p"], hot_values(turns, ["p"]), F.col("w"))
        place = F.struct("path", _step(F.col("ordinal")).alias("step"), (F.col("depth") + 1).alias("depth"))
        # Dealt by root and prompt once for each round, so that two rounds are compared where they lie.
        settled = Dealt(seeds.sparkSession, "walk", ["w", "p"], asked.buckets)
        met = settled.deal(met.select("w", F.col("child").alias("p"), place.alias("at")))
        owned = met.groupBy("w", "p").agg(F.min("at").alias("at")).where(F.col("at.depth") < max_depth)
        following = settled.add(owned.select("w", "p", F.concat("at.path", "at.step").alias("path"), F.col("at.depth").alias("depth")))
        if nodes is None:
            same = following.isEmpty()
        else:
            moved = following.join(nodes.select("w", "p", F.col("path").alias("_old")), ["w", "p"], "full_outer")
            same = moved.where(~F.col("path").eqNullSafe(F.col("_old"))).isEmpty()
        nodes = following
        if same:
            break
    found = asked.spell(asked.turns(start.unionByName(nodes)), roots.select("w", "word"))
    return found.select("word", "prompt", "depth", "path", "text", "tok")


def expand_bloom(
    seeds: DataFrame,
    responder: Responder,
    prefixes: Sequence[str] = ("",),
    max_depth: int = 10,
    history: DataFrame | None = None,
    strip_think: bool = False,
    remove_prompt: bool = False,
    power2: int = 27,
    k: int = 8,
) -> DataFrame:
    """``(word, prompt, depth, path, text, tok)`` of a breadth-first walk whose only memory is one Bloom filter for all roots.

    The filter is fed in the order of level, root, path, and keeps out what it holds, by mistake too. ``history(item)`` fills it
    first. Roots are not fed. Its bits are merged level by level as bitmaps, so memory is that of the filter, whatever was seen.
    """
    roots = numbered_roots(seeds)
    marks = {"bits": lambda prompt: bloom_indexes(prompt, power2=power2, k=k)}
    asked = Asked(seeds, responder, prefixes, None, strip_think, remove_prompt, marks)
    frontier = materialize(roots.select("w", "p", _step(F.col("w"), 2 * STEP).alias("path")), "frontier")
    stock = roots.select("p", F.col("word").alias("prompt"))
    bloom = None
    if history is not None:
        bloom = materialize(dedupe.bloom_build(history, "item", power2=power2, k=k), "bloom")
    found: DataFrame | None = None
    for depth in range(max_depth):
        asked.ask(frontier, stock if depth == 0 else None)
        turns = asked.turns(frontier)
        level = turns.withColumn("depth", F.lit(depth))
        found = level if found is None else found.unionByName(level)
        if depth + 1 == max_depth:
            break
        met = salted_join(turns, asked.edges.rows(), ["p"], hot_values(turns, ["p"]), F.col("w"))
        rows = met.select("w", F.col("child").alias("p"), F.concat("path", _step(F.col("ordinal"))).alias("path"), "bits")
        passed, bloom = dedupe.bloom_admit(materialize(rows, "fresh"), bloom, order="path", bits="bits")
        frontier = materialize(passed.drop("bits"), "frontier")
        bloom = materialize(bloom, "bloom")
        if frontier.isEmpty():
            break
    return asked.spell(found, roots.select("w", "word")).select("word", "prompt", "depth", "path", "text", "tok")
