"""Prompt frontier: prompt -> response -> lines or phrases x prefixes -> new prompts, level by level.

Walks breadth first, so a prompt's depth is the smallest one. All roots run in one job.
Each level is written once to the shared scratch folder, as keys of its prompts; nothing of it
reaches the driver but whether it is empty. Texts move when they are answered and at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions.codec import compress
from textmill.operators import dedupe, tfidf
from textmill.operators.ledger import Ledger, log_rows
from textmill.operators.store import store_texts
from textmill.plans import Dealt, buckets_for, global_rank, hot_values, materialize, salted_join

Responder = Callable[[DataFrame], DataFrame]
KEY = "key"


def text_key(text: Column) -> Column:
    """16 bytes of the SHA-256 of a text, which stand for it in joins."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def prefixed(line: Column, prefix: Column) -> Column:
    return F.when(prefix == "", line).otherwise(F.concat(prefix, F.lit(" "), line))


def prompt_candidates(
    texts: DataFrame, prefixes: Sequence[str] = ("",), text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``(*keep, ordinal, prompt)``: every line with every prefix, in line order.

    Empty lines stay and give the empty prompt.
    """
    lines = texts.select(*keep, F.posexplode(F.split(text, "\n", -1)).alias("_line_no", "_line"))
    stock = F.array(*[F.lit(p) for p in prefixes])
    pairs = lines.select(*keep, "_line_no", "_line", F.posexplode(stock).alias("_prefix_no", "_prefix"))
    return pairs.select(
        *keep,
        (F.col("_line_no").cast("long") * len(prefixes) + F.col("_prefix_no")).alias("ordinal"),
        prefixed(F.col("_line"), F.col("_prefix")).alias("prompt"),
    )


def shuffle_prompts(prompts: DataFrame, seed: int, prompt: str = "prompt", order: str = "ordinal") -> DataFrame:
    """Add ``position``: a repeatable random order."""
    key = F.md5(F.concat_ws("\x00", F.lit(str(seed)), F.col(order).cast("string"), F.col(prompt)))
    return global_rank(prompts.withColumn("_key", key), "_key", "position").drop("_key")


def _timing(answers: DataFrame) -> list[str]:
    return [c for c in answers.columns if c == "td"]


class TableResponder:
    """Answers from a table ``(prompt, response, tok)``, and ``td`` where it is there, unique on ``prompt``.

    The table is dealt once by the keys of its prompts; whatever is asked later moves keys alone.
    """

    def __init__(self, responses: DataFrame) -> None:
        columns = ["prompt", "response", "tok", *_timing(responses)]
        key = F.col(KEY) if KEY in responses.columns else text_key(F.col("prompt"))
        self.buckets = buckets_for(responses)
        self.stock = Dealt(responses.sparkSession, "answers", [KEY], self.buckets).add(responses.select(key.alias(KEY), *columns))

    def __call__(self, prompts: DataFrame) -> DataFrame:
        return self.by_key(prompts.select(text_key(F.col("prompt")).alias(KEY))).drop(KEY)

    def by_key(self, keys: DataFrame) -> DataFrame:
        """The same, with its key, for the distinct prompts of ``keys``."""
        # The keys are held by their hashes and the table passes by them, so it is not sorted.
        return keys.select(KEY).hint("shuffle_hash").join(self.stock, KEY)


def table_responder(responses: DataFrame) -> Responder:
    """Answer prompts from ``(prompt, response, tok)``, and ``td`` where it is there, unique on ``prompt``; NULL is never answered."""
    return TableResponder(responses)


class Asked:
    """What was asked, each prompt once for all roots, and what came of it.

    Prompts go by their ``text_key`` ``p``. ``told``: ``(p, prompt, text, tok)`` of what was asked; ``edges``: ``(p, child, ordinal)``, the distinct
    children of each by first appearance, without those of ``visited``. All are dealt by ``p``. ``marks`` are further columns of a child, by name.
    """

    def __init__(
        self,
        seeds: DataFrame,
        responder: Responder,
        prefixes: Sequence[str],
        visited: DataFrame | None = None,
        strip_think: bool = False,
        remove_prompt: bool = False,
        marks: dict[str, Callable[[Column], Column]] | None = None,
    ) -> None:
        self.responder, self.prefixes, self.strip_think, self.remove_prompt, self.marks = responder, prefixes, strip_think, remove_prompt, marks or {}
        spark, self.buckets = seeds.sparkSession, responder.buckets if isinstance(responder, TableResponder) else buckets_for(seeds)
        self.told, self.edges, self.spelt = (Dealt(spark, label, ["p"], self.buckets) for label in ("told", "edges", "spelt"))
        self.known = materialize(visited.select(text_key(F.col("prompt")).alias("child")).distinct(), "visited") if visited is not None else None

    def ask(self, wanted: DataFrame, stock: DataFrame | None = None) -> None:
        """Ask what is new among ``wanted(p)``. ``stock(p, prompt)`` spells it, by default the children of what was told."""
        new = self.told.deal(wanted.select("p").where("p is not null")).distinct()
        if self.told.parts:
            new = new.join((self.spelt if self.strip_think else self.told).rows().select("p"), "p", "left_anti")
        if self.strip_think or not isinstance(self.responder, TableResponder):
            stock = self._children() if stock is None else stock
            prompts = self.told.deal(stock.select("p", "prompt")).groupBy("p").agg(F.first("prompt").alias("prompt")).join(new, "p", "left_semi")
        if self.strip_think:  # may make prompts equal
            short = prompts.select("p", tx.strip_think(F.col("prompt")).alias("prompt")).withColumn("asked", text_key(F.col("prompt")))
            prompts = self.spelt.add(short).groupBy(F.col("asked").alias("p")).agg(F.first("prompt").alias("prompt"))
            if self.told.parts:
                prompts = prompts.join(self.told.rows().select("p"), "p", "left_anti")
        if isinstance(self.responder, TableResponder):
            answers = self.responder.by_key((prompts if self.strip_think else new).select(F.col("p").alias(KEY))).withColumnRenamed(KEY, "p")
        else:
            answers = self.responder(prompts.select("prompt")).withColumn("p", text_key(F.col("prompt")))
        text = tx.sanitize(F.col("response"))
        if self.remove_prompt:
            text = tx.remove_prompt(text, F.col("prompt"))
        # What has no answer may be asked again.
        told = self.told.add(answers.select("p", "prompt", text.alias("text"), "tok", *_timing(answers)))
        marks = [F.first(f"_{name}").alias(name) for name in self.marks]
        lines = prompt_candidates(told, self.prefixes, keep=("p",))
        lines = lines.select("p", text_key(F.col("prompt")).alias("child"), "ordinal", *[f(F.col("prompt")).alias(f"_{name}") for name, f in self.marks.items()])
        edges = lines.groupBy("p", "child").agg(F.min("ordinal").alias("ordinal"), *marks)
        self.edges.add(edges if self.known is None else edges.join(self.known, "child", "left_anti"))

    def _children(self) -> DataFrame:
        lines = prompt_candidates(self.told.rows(), self.prefixes, keep=("p",))
        return lines.select(text_key(F.col("prompt")).alias("p"), "prompt")

    def turns(self, nodes: DataFrame) -> DataFrame:
        """``nodes`` with the keys of what was asked for them."""
        if not self.strip_think:
            return nodes
        spelt = self.spelt.rows().select("p", "asked")
        found = salted_join(nodes, spelt, ["p"], hot_values(nodes, ["p"]), F.col("w"))
        return found.withColumn("p", F.col("asked")).drop("asked")

    def spell(self, nodes: DataFrame, roots: DataFrame) -> DataFrame:
        """``nodes(w, p, ...)`` with the words of ``roots(w, word)`` and what was told for them. ``nodes`` is read more than once: pass a written table."""
        named = salted_join(nodes, roots, ["w"], hot_values(nodes, ["w"]), F.col("p"))
        return salted_join(named, self.told.rows(), ["p"], hot_values(nodes, ["p"]), F.col("w")).drop("w", "p")


def numbered_roots(seeds: DataFrame) -> DataFrame:
    """``(word, w, p)`` of the distinct words, written: numbers rise with the words."""
    words = materialize(seeds.select("word").where("word is not null").distinct(), "words")
    return materialize(global_rank(words, "word", "w").select("word", "w", text_key(F.col("word")).alias("p")), "roots")


def expand_frontier(
    seeds: DataFrame,
    responder: Responder,
    prefixes: Sequence[str] = ("",),
    max_depth: int = 10,
    visited: DataFrame | None = None,
    strip_think: bool = False,
    remove_prompt: bool = False,
    phrases: dict | None = None,
    shared_visited: bool = False,
) -> DataFrame:
    """``(word, prompt, depth, text, tok)`` of every generation reached from ``seeds(word)``.

    ``responder`` maps distinct ``(prompt)`` rows to ``(prompt, response, tok)``; a further column ``td``, the seconds
    an answer took, comes back with its generations. A prompt is asked once for all roots and levels.
    ``visited(prompt)``: never ask these again. ``phrases``: arguments of ``rank_phrases``;
    children are then the ranked phrases, scored over all generations up to the level,
    instead of the lines. A root is not marked as visited, so it can come back once as a
    child. With ``shared_visited`` a prompt belongs to the lowest word reaching it first.

    The walk goes by numbers of roots and keys of prompts; texts are joined to it at the end, once.
    """
    return _generations(*_walk(seeds, responder, prefixes, max_depth, visited, strip_think, remove_prompt, phrases, shared_visited))


def _generations(found: DataFrame, asked: Asked, roots: DataFrame) -> DataFrame:
    return asked.spell(found, roots.select("w", "word")).select("word", "prompt", "depth", "text", "tok", *_timing(asked.told.rows()))


def _walk(
    seeds: DataFrame,
    responder: Responder,
    prefixes: Sequence[str] = ("",),
    max_depth: int = 10,
    visited: DataFrame | None = None,
    strip_think: bool = False,
    remove_prompt: bool = False,
    phrases: dict | None = None,
    shared_visited: bool = False,
) -> tuple[DataFrame, Asked, DataFrame]:
    """``(w, p, depth)`` of every generation, what was asked, and the roots; see ``expand_frontier``."""
    spark = seeds.sparkSession
    scope = ["p"] if shared_visited else ["w", "p"]
    roots = numbered_roots(seeds)
    asked = Asked(seeds, responder, prefixes, visited if phrases is None else None, strip_think, remove_prompt)
    known = materialize(visited.select(text_key(F.col("prompt")).alias("p")).distinct(), "visited") if visited is not None and phrases is not None else None
    nodes = Dealt(spark, "nodes", scope, asked.buckets)  # all levels but the roots
    found: DataFrame | None = None
    frequency: DataFrame | None = None  # in phrase mode: grows by each level's texts
    texts = 0
    frontier, stock = roots.select("w", "p"), roots.select("p", F.col("word").alias("prompt"))
    for depth in range(max_depth):
        asked.ask(frontier, stock)
        stock = None
        turns = asked.turns(frontier).distinct() if strip_think else frontier
        level = turns.select("w", "p", F.lit(depth).alias("depth"))
        found = level if found is None else found.unionByName(level)
        if depth + 1 == max_depth:
            break
        if phrases is None:
            fresh = salted_join(turns, asked.edges.rows().select("p", "child"), ["p"], hot_values(turns, ["p"]), F.col("w"))
            fresh = fresh.select("w", F.col("child").alias("p"))
        else:
            # Texts and their phrases go by prompt: a generation is a root's key of it, and counts as often as roots have it.
            times = asked.told.deal(turns.select("p")).groupBy("p").agg(F.count("*").alias("times"))
            level = materialize(times.join(asked.told.rows().select("p", "text"), "p"), "level")
            frequency = materialize(tfidf.merged_frequency(frequency, level.select("p", "text", "times"), times="times"), "frequency")
            texts += level.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
            model = frequency.withColumn("idf", tfidf.idf_of(F.col("df"), texts))
            children = _phrase_children(level, model, prefixes, phrases)
            stock = materialize(children.withColumn("child", text_key(F.col("prompt"))), "children")
            fresh = salted_join(turns, stock.select("p", "child").distinct(), ["p"], hot_values(turns, ["p"]), F.col("w"))
            fresh, stock = fresh.select("w", F.col("child").alias("p")), stock.select(F.col("child").alias("p"), "prompt")
            if known is not None:
                fresh = _unseen(fresh, known, ["p"])
        fresh = nodes.deal(fresh)
        fresh = fresh.groupBy("p").agg(F.min("w").alias("w")).select("w", "p") if shared_visited else fresh.distinct()
        if nodes.parts:
            fresh = fresh.join(nodes.rows(), scope, "left_anti")
        frontier = nodes.add(fresh)
        if frontier.isEmpty():
            break
    if found is None:
        found = roots.select("w", "p", F.lit(0).alias("depth")).limit(0)
        asked.ask(found)
    return found, asked, roots


def _unseen(fresh: DataFrame, visited: DataFrame, keys: list[str]) -> DataFrame:
    """A prompt may be shared by very many roots: test each distinct prompt once, then salt."""
    seen = fresh.select(*keys).distinct().join(visited, keys, "left_semi")
    return salted_join(fresh, seen, keys, hot_values(fresh, keys), F.col("w"), "left_anti")


def _phrase_children(level: DataFrame, model: DataFrame, prefixes: Sequence[str], args: dict) -> DataFrame:
    """``(p, prompt)``: what each text of ``level(p, text)`` leads to, whatever its root."""
    ranked = tfidf.rank_phrases(level, None, doc="p", model=model, **args).select("p", "ngram")
    stock = F.array(*[F.lit(p) for p in prefixes])
    return ranked.select("p", "ngram", F.explode(stock).alias("_prefix")).select("p", prefixed(F.col("ngram"), F.col("_prefix")).alias("prompt"))


def grow_store(
    generations: DataFrame,
    level: int = 6,
    algo: str = "zlib",
    model: str | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Store rows of generations: each text once, under the word that reached it first.

    First is by depth, then word, then prompt.
    """
    place = F.struct("depth", "word", "prompt")
    first = (
        generations.groupBy(F.sha2("text", 256).alias("_d"))
        .agg(F.min(place).alias("_place"))
        .select("_place.*")
    )
    rows = generations.join(first, ["depth", "word", "prompt"])
    return rows.select(
        F.lit(seed).cast("int").alias("seed"),
        F.lit(model).cast("string").alias("model"),
        "word",
        compress(F.col("text"), level, algo).alias("data"),
        "tok",
        F.lit(algo).alias("compression_algo"),
        "prompt",
        "depth",
        "text",
    )


def run_totals(generations: DataFrame, run: str) -> DataFrame:
    """Generations, tokens and seconds of each root; seconds are NULL where the responder took no time."""
    td = F.sum("td") if "td" in generations.columns else F.lit(None)
    return generations.groupBy("word").agg(F.count("*").alias("generations"), F.sum("tok").alias("total_tokens"), td.cast("double").alias("td")).withColumn("run", F.lit(run))


def distill(
    seeds: DataFrame,
    responder: Responder,
    ledger: Ledger,
    run: str,
    level: int = 6,
    algo: str = "zlib",
    model: str | None = None,
    seed: int | None = None,
    log: bool = True,
    resume: bool = False,
    **walk,
) -> bool:
    """Walk from ``seeds(word)`` and commit the texts, the root prompts and the totals of the run together.

    A text that is stored already is ignored; the totals count it all the same. ``log``: record the stripped roots. ``resume``: never ask
    what is stored or logged. ``walk``: arguments of ``expand_frontier``. False, and nothing happens, when the ledger holds the run.
    """
    if ledger.holds(run):
        return False
    if resume:
        walk["visited"] = materialize(
            dedupe.resume_set(store_texts(ledger.table("texts")), ledger.table("prompts")).withColumnRenamed("item", "prompt"), "visited"
        )
    found, asked, roots = _walk(seeds, responder, **walk)
    # A prompt has one text, so no generation but its first, by depth and word, can be the first of that text.
    first = asked.told.deal(found).groupBy("p").agg(F.min(F.struct("depth", "w")).alias("at"))
    first = materialize(first.select("at.w", "p", "at.depth"), "firsts")
    place = F.concat_ws("\x00", F.lpad(F.col("depth").cast("string"), 10, "0"), "word", "prompt")
    texts = grow_store(_generations(first, asked, roots), level, algo, model, seed).withColumn("_order", place)
    return ledger.commit(run, texts=texts, prompts=log_rows(seeds) if log else None, totals=run_totals(_generations(found, asked, roots), run))
