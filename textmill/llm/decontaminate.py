"""Benchmark decontamination by pigeonhole edit matching (``op5_decontamination``).

Texts and test items are normalised (lower case, white space collapsed). An item of n characters tolerates
``floor(RATE * n)`` edits and is split into one piece more than that; whatever lies within the budget holds at
least one piece unchanged. One pass of an Aho-Corasick automaton over the text finds all exact piece
hits. Pieces are the leaves of a halving tree whose nodes carry their share of the budget, rounded down: an
occurrence within the budget has a piece hit all of whose ancestors keep theirs, so a hit is verified from
its parent up by Myers' bit-parallel distance and mostly falls at once. At the root the stretch of text around
the hits that are left (those that lie close together share it) decides. Every occurrence within the budget is found.

Items are taken in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_CHARS`` characters; only one block is held by the
driver and sent to the tasks at a time, its matches are written before the next, and each block is one pass over the documents, so neither grows
with the benchmark. Documents are never shuffled. An item under ``LEAST_CHARS`` characters after normalising has budget 0 and must not begin or
end inside a word (scripts without spaces have no such places); an item without any text takes no part. Null and empty texts match
nothing; very long texts are searched whole; of equally good places the first counts; repeated rows, of documents or items, give repeated
results; an empty table gives none; only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

RATE = 0.1
LEAST_CHARS = 40  # shorter items must stand whole
BLOCK_ITEMS = 10_000
BLOCK_CHARS = 8_000_000
SCHEMA = "doc_id long, item_id long, distance int, start int, stop int"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def original_places(text: str) -> np.ndarray:
    """For each character of ``normalised(text)``, its place in ``text`` (code points)."""
    places, gap = [], False
    for i, c in enumerate(text):
        if c.isspace():
            gap = bool(places)
            continue
        if gap:
            places.append(i - 1)
            gap = False
        places.extend([i] * len(c.lower()))
    return np.array([*places, len(text)], np.int64)


def cut(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their places."""
    bounds = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:])]


def masks(item: str) -> dict[str, int]:
    found: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        found[c] |= 1 << i
    return found


def best_end(peq: dict[str, int], size: int, text: str, limit: int) -> tuple[int, int] | None:
    """Least edit distance of the item to a substring of ``text`` and the first end of one, if within ``limit`` (Myers)."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance = full, 0, size
    best, at = limit + 1, -1
    get = peq.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp = minus | ~(d0 | plus)
        hm = plus & d0
        if hp & high:
            distance += 1
        elif hm & high:
            distance -= 1
        hp <<= 1
        minus = hp & d0 & full
        plus = ((hm << 1) | ~(d0 | hp)) & full
        if distance < best:
            best, at = distance, i + 1
    return (best, at) if at >= 0 else None


def in_word(c: str) -> bool:
    """Whether a character may be inside a word of a script that sets words apart."""
    return c.isalnum() and ord(c) < 0x2E80 and not 0x0E00 <= ord(c) < 0x1100


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether a stretch neither begins nor ends inside a word."""
    cuts = [p for p in (start, end) if 0 < p < len(text)]
    return not any(in_word(text[p - 1]) and in_word(text[p]) for p in cuts)


class Items:
    """One block of items: automaton of pieces, and the masks for verification."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least: int = LEAST_CHARS) -> None:
        import ahocorasick

        self.least = least
        self.texts = [(i, normalised(t)) for i, t in items]
        self.budgets = [int(rate * len(t)) if len(t) >= least else 0 for _, t in self.texts]
        self.masks: dict[tuple[int, int, int], dict[str, int]] = {}
        wanted: dict[str, list[tuple[int, int, list]]] = defaultdict(list)
        for n, (_, text) in enumerate(self.texts):
            pieces = cut(text, self.budgets[n])
            above: list[list[tuple[int, int, int]]] = [[] for _ in pieces]  # of each piece, from its parent up, root left out
            self.halve(n, pieces, 0, len(pieces), above, self.budgets[n])
            for (place, piece), chain in zip(pieces, above):
                wanted[piece].append((n, place, chain))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in wanted.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if wanted:
            self.automaton.make_automaton()
        self.empty = not wanted

    def halve(self, n: int, pieces: list, first: int, last: int, above: list, budget: int) -> None:
        """Record (start, end, budget) of the node over pieces ``first`` to ``last`` with each of them, children first."""
        if last - first < 2:
            return
        middle = (first + last) // 2
        for a, b in ((first, middle), (middle, last)):
            self.halve(n, pieces, a, b, above, budget * (b - a) // (last - first))
        if last - first < len(pieces):
            start, end = pieces[first][0], pieces[last - 1][0] + len(pieces[last - 1][1])
            for k in range(first, last):
                above[k].append((start, end, budget))

    def mask(self, n: int, start: int, end: int) -> dict[str, int]:
        """Masks of a stretch of an item; of the reversed item for ``end`` 0."""
        key = n, start, end
        if key not in self.masks:
            text = self.texts[n][1]
            self.masks[key] = dict(masks(text[start:end] if end else text[::-1]))
        return self.masks[key]

    def stands(self, n: int, at: int, chain: list, text: str) -> bool:
        """Whether the item, if it began at ``at``, keeps the budgets of all nodes of ``chain``."""
        for start, end, budget in chain:
            a = max(0, at + start - budget)
            part = text[a : max(a, at + end + budget)]
            if best_end(self.mask(n, start, end), end - start, part, budget) is None:
                return False
        return True

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best place of each item in a normalised text; the first of equals."""
        if self.empty:
            return
        found: dict[int, list[int]] = defaultdict(list)
        exact: dict[int, int] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for n, place, chain in owners:
                at = end + 1 - size - place  # where the item would start
                if n in exact:
                    continue
                if len(self.texts[n][1]) < self.least:
                    if stands_alone(text, at, end + 1):
                        exact[n] = at
                elif at >= 0 and text.startswith(self.texts[n][1], at):
                    exact[n] = text.find(self.texts[n][1])
                elif self.stands(n, at, chain, text):
                    found[n].append(at)
        for n, first in exact.items():
            yield n, 0, first, first + len(self.texts[n][1])
        for n, starts in found.items():
            if n in exact:
                continue
            budget, size, best = self.budgets[n], len(self.texts[n][1]), None
            starts.sort()
            low = high = starts[0]
            stretches = []
            for s in starts[1:]:
                if s > high + 2 * budget:
                    stretches.append((low, high))
                    low = s
                high = s
            stretches.append((low, high))
            for low, high in stretches:
                a = max(0, low - budget)
                part = text[a : max(a, high + size + budget)]
                hit = best_end(self.mask(n, 0, size), size, part, (best[0] - 1) if best else budget)
                if hit:
                    best = hit[0], a + hit[1]
            if best:
                distance, end = best
                back = text[max(0, end - size - budget) : end][::-1]
                yield n, distance, end - best_length(self.mask(n, 0, 0), size, back, distance), end


def best_length(peq: dict[str, int], size: int, text: str, distance: int) -> int:
    """Length of the shortest prefix of ``text`` (reversed, anchored) at the given distance from the reversed item."""
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, now = full, 0, size
    if now == distance:
        return 0
    for i, c in enumerate(text):
        eq = peq.get(c, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp = minus | ~(d0 | plus)
        hm = plus & d0
        if hp & high:
            now += 1
        elif hm & high:
            now -= 1
        hp = (hp << 1) | 1  # the prefix is anchored
        minus = hp & d0 & full
        plus = ((hm << 1) | ~(d0 | hp)) & full
        if now == distance:
            return i + 1
    return len(text)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items with any text, in blocks of bounded size; equal normalised texts stay separate items."""
    usable = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    block: list[tuple[int, str]] = []
    spent = 0
    for row in usable.toLocalIterator():
        if not normalised(row["text"]):
            continue
        if block and (len(block) >= BLOCK_ITEMS or spent + len(row["text"]) > BLOCK_CHARS):
            yield block
            block, spent = [], 0
        block.append((row["item_id"], row["text"]))
        spent += len(row["text"])
    if block:
        yield block


def matches_of(docs: DataFrame, sent, rate: float, least: int) -> DataFrame:
    """The matches of one block of items, ``sent`` to all tasks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, rate, least)
        for batch in batches:
            for part in kit.slices(batch):
                out: list[tuple] = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    places = None
                    for n, distance, start, end in items.matches(normalised(text)):
                        places = original_places(text) if places is None else places
                        out.append((doc, items.texts[n][0], distance, int(places[start]), int(places[max(start, end - 1)]) + (end > start)))
                columns = list(zip(*out)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "distance", "start", "stop"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(rows, SCHEMA)


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, start, stop: the best occurrence of every item in every text that holds it within its budget."""
    spark, folder, found = docs.sparkSession, None, []
    for number, block in enumerate(blocks(benchmark)):
        folder = folder or kit.scratch(spark)
        sent = spark.sparkContext.broadcast(block)
        found.append(kit.written(matches_of(docs, sent, rate, LEAST_CHARS), folder, str(number)))
        sent.destroy()  # before the next one is made
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], SCHEMA)


def without_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without the rows whose text holds an item within its budget, tested inside each row (no join).

    With several blocks what each one keeps is written for the next, and only that is read.
    """
    spark, folder, before, least = docs.sparkSession, None, None, LEAST_CHARS
    for number, block in enumerate(blocks(benchmark)):
        if before is not None:
            folder = folder or kit.scratch(spark)
            docs = kit.written(docs, folder, str(number))
            before.destroy()
            kit.keep_only(spark, folder, (str(number),))
        before = sent = spark.sparkContext.broadcast(block)

        def rows(batches, sent=sent):
            items = Items(sent.value, rate, least)
            for batch in batches:
                for part in kit.slices(batch):
                    texts = part.column(part.schema.get_field_index("text")).to_pylist()
                    clean = [not t or next(items.matches(normalised(t)), None) is None for t in texts]
                    yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(kit.tables(spark, sf_dir, "documents"), kit.tables(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontamination": op5_decontamination}
ORACLE_SQL: dict[str, str] = {}
