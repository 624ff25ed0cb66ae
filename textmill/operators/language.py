"""Language of a text by character trigrams: counted in Arrow batches, applied there too while the model is small, else as joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.text import char_ngrams, strip
from textmill.operators.dedupe import distinct_texts
from textmill.operators.tfidf import term_runs
from textmill.plans import bounded_broadcast, hot_values, lookup_join, materialize, salted_join, spread

UNDETECTED = "undetected"
GRAM = 3
# A model whose rows are estimated below this size is sent to every executor.
BROADCAST_BYTES = 64 << 20
# Most languages of a model that is applied in Arrow batches.
LANGUAGES = 256
# Bytes of texts, and pairs of trigram and language, that are in hand at once; such pairs that a task of counting holds.
TEXT_BYTES, PAIRS, HELD = 4 << 20, 1 << 20, 1 << 20


def _trigrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(n, codes, rows)`` of the next ``n`` texts: 21 bits for each character of a trigram, and the text it is in, from 0."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
        some = texts.slice(start, stop - start).drop_null().to_pylist()
        chars = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.zeros(stop - start, np.int64)
        sizes[texts.slice(start, stop - start).is_valid().to_numpy(zero_copy_only=False)] = [len(t) for t in some]
        rows = np.repeat(np.arange(stop - start), sizes)
        inside = np.flatnonzero(rows[2:] == rows[:-2]) if len(rows) > 2 else np.zeros(0, np.int64)
        yield stop - start, chars[inside] | chars[inside + 1] << 21 | chars[inside + 2] << 42, rows[inside]
        start = stop


def _spelt(codes: np.ndarray) -> list[str]:
    chars = np.stack([codes >> 21 * k & (1 << 21) - 1 for k in range(GRAM)], axis=1).astype("<u4")
    text = chars.tobytes().decode("utf-32-le")
    return [text[i : i + GRAM] for i in range(0, len(text), GRAM)]


@dataclass(frozen=True)
class LanguageModel:
    """``grams(gram, total, counts)`` with an array of ``(lang, n)`` per trigram, and ``sizes(lang, size)``.

    ``smallest`` is the language of the least size, the first by name of equals. ``bytes`` estimates the size of ``grams`` in memory.
    """

    grams: DataFrame
    sizes: DataFrame
    smallest: tuple[str, int]
    vocabulary: int
    bytes: int

    @property
    def judge(self) -> Callable[[Column], Column] | None:
        """The language of a lower-case text, by a copy of the model on every executor; None when it is too large for that."""
        return self._judge if self.bytes <= BROADCAST_BYTES else None

    @cached_property
    def _judge(self) -> Callable[[Column], Column] | None:
        sizes = self.sizes.orderBy("lang").limit(LANGUAGES + 1).collect()
        if len(sizes) > LANGUAGES:
            return None
        number = {r["lang"]: i for i, r in enumerate(sizes)}
        penalties = np.log(np.array([r["size"] for r in sizes], float) + float(self.vocabulary))
        pairs = self.grams.select("gram", F.explode("counts").alias("c")).select("gram", "c.lang", "c.n").toArrow()
        codes = [c for _, c, _ in _trigrams(pairs["gram"].combine_chunks())]
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        langs = np.array([number[x] for x in pairs["lang"].to_pylist()], np.int64)
        logs = np.log1p(pairs["n"].to_numpy().astype(float))
        place = np.lexsort((langs, codes))
        grams, starts, counts = np.unique(codes[place], return_index=True, return_counts=True)
        sent = self.grams.sparkSession.sparkContext.broadcast((grams, starts, counts, langs[place], logs[place], penalties, list(number)))

        @F.arrow_udf(T.StringType())
        def run(texts: pa.Array) -> pa.Array:
            return _judged(texts, *sent.value)

        return run


def _judged(
    texts: pa.Array, grams: np.ndarray, starts: np.ndarray, counts: np.ndarray, langs: np.ndarray, logs: np.ndarray, penalties: np.ndarray, names: list[str]
) -> pa.Array:
    """The cheapest language of each text. ``starts`` and ``counts`` say which of ``langs`` and ``logs`` are those of a trigram."""
    found: list[str] = []
    step = max(1, PAIRS // len(names))
    for n, codes, rows in _trigrams(texts):
        sums = np.zeros(n * len(names))
        for at in range(0, len(codes), step):
            here, row = codes[at : at + step], rows[at : at + step]
            spot = np.minimum(np.searchsorted(grams, here), max(len(grams) - 1, 0))
            known = grams[spot] == here if len(grams) else np.zeros(len(here), bool)
            spot, row = spot[known], row[known]
            times = counts[spot]
            entry = np.repeat(starts[spot] - np.cumsum(times) + times, times) + np.arange(times.sum())
            if len(row):
                low = row[0] * len(names)
                some = np.bincount(np.repeat(row, times) * len(names) + langs[entry] - low, weights=logs[entry])
                sums[low : low + len(some)] += some
        size = np.bincount(rows, minlength=n)
        best = np.argmin(size[:, None] * penalties - sums.reshape(n, len(names)), axis=1)
        found += [names[b] if k else UNDETECTED for b, k in zip(best.tolist(), size.tolist())]
    return pa.array(found, pa.string())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, n)`` from ``(lang, text)``, combined for as many batches as ``HELD`` allows."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def told() -> pa.RecordBatch:
        langs = [lang for lang, (codes, _) in held.items() for _ in range(len(codes))]
        codes = np.concatenate([c for c, _ in held.values()])
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(_spelt(codes), pa.string()), pa.array(np.concatenate([n for _, n in held.values()]))], ["lang", "gram", "n"]
        )

    for batch in batches:
        names = batch["lang"].dictionary_encode()
        numbers, at = names.indices.to_numpy().astype(np.int64), 0
        for n, codes, rows in _trigrams(batch["text"]):
            of = numbers[at : at + n][rows]
            at += n
            place = np.argsort(of, kind="stable")
            codes, of = codes[place], of[place]
            for number in np.unique(of):
                low, high = np.searchsorted(of, [number, number + 1])
                lang = names.dictionary[int(number)].as_py()
                new, times = np.unique(codes[low:high], return_counts=True)
                if lang in held:
                    old, before = held[lang]
                    new, where = np.unique(np.concatenate([old, new]), return_inverse=True)
                    times = np.bincount(where, weights=np.concatenate([before, times])).astype(np.int64)
                held[lang] = new, times.astype(np.int64)
            if sum(len(c) for c, _ in held.values()) > HELD:
                yield told()
                held.clear()
    if held:
        yield told()


def _grams(text: Column) -> Column:
    return char_ngrams(F.lower(text), GRAM)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count trigrams per language, of any number of languages; counts are combined per task before their shuffle."""
    known = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("_text"))
    rows = spread(known).select("lang", F.lower("_text").alias("text")).mapInArrow(_counted, "lang string, gram string, n long")
    counts = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    pairs = F.collect_list(F.struct("lang", "n"))  # one entry per language, not per text
    grams = materialize(counts.groupBy("gram").agg(F.sum("n").alias("total"), pairs.alias("counts")), "grams")
    # A labelled language without trigrams has size 0.
    sums = grams.select(F.explode("counts").alias("c")).select("c.lang", "c.n")
    sums = sums.unionByName(known.select("lang", F.lit(0).cast("long").alias("n")).distinct())
    sizes = materialize(sums.groupBy("lang").agg(F.sum("n").alias("size")), "sizes")
    least = sizes.agg(F.min(F.struct("size", "lang")).alias("least")).first()["least"]
    if least is None:
        raise ValueError(f"{lang!r} holds no language")
    in_memory = F.aggregate("counts", F.lit(64).cast("long"), lambda size, c: size + 40 + F.octet_length(c["lang"]))
    found = grams.agg(F.count("*").alias("rows"), F.coalesce(F.sum(in_memory), F.lit(0)).alias("bytes")).first()
    return LanguageModel(grams, sizes, (least["lang"], least["size"]), found["rows"], found["bytes"])


def detect(texts: DataFrame, model: LanguageModel, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``(order, lang)`` by naive Bayes with add-one smoothing; no trigram means ``undetected``.

    A language costs ``n * log(size + vocabulary) - sum(log(count + 1))``, and the cheapest is taken, the first by name of equals. The sums
    come from a join by trigram, for the languages that share one with the text. Of all others, whose sums are 0, the smallest language
    is the cheapest; where it shares a trigram itself it is cheaper still. So it alone stands in for them.
    A small model goes to every executor instead, which adds up the costs text by text, without rows for trigrams.
    """
    if model.judge:
        return spread(texts.select(order, text)).select(order, model.judge(F.lower(F.col(text))).alias("lang"))
    logs = model.grams.select(
        "gram", "total", F.transform("counts", lambda c: F.struct(c["lang"].alias("lang"), F.log1p(c["n"]).alias("w"))).alias("logs")
    )
    n = F.greatest(F.length(F.lower(F.col(text))) - (GRAM - 1), F.lit(0)).cast("long").alias("_n")
    split = spread(texts.select(order, text)).select(order, text, n)  # counted before the text is exploded
    if model.bytes <= BROADCAST_BYTES:
        # Nothing is shuffled before the sums, so counting inside the text would only add sorts.
        rows = split.select(order, "_n", F.explode(_grams(F.col(text))).alias("gram"), F.lit(1).alias("_times"))
        known = rows.join(F.broadcast(logs.drop("total")), "gram")
    else:
        counted = split.select(order, "_n", F.explode(term_runs(_grams(F.col(text)))).alias("r"))
        rows = counted.select(order, "_n", F.col("r.term").alias("gram"), F.col("r.tf").alias("_times"))
        known = lookup_join(rows, logs, "gram", "total", order)
    parts = known.select(order, "_n", "_times", F.explode("logs").alias("l"))
    sums = parts.groupBy(order, "l.lang").agg(F.sum(F.col("_times") * F.col("l.w")).alias("_s"), F.max("_n").alias("_n"))

    def penalty(size: Column) -> Column:
        return F.log(size + F.lit(float(model.vocabulary)))

    sizes, fits = bounded_broadcast(model.sizes.select("lang", penalty(F.col("size")).alias("_penalty")))
    priced = sums.join(sizes, "lang") if fits else salted_join(sums, sizes, ["lang"], hot_values(sums, ["lang"]), F.col(order))
    cost = F.struct((F.col("_n") * F.col("_penalty") - F.col("_s")).alias("cost"), "lang")
    best = priced.groupBy(F.col(order).alias("_at")).agg(F.min(cost).alias("_best"))
    name, size = model.smallest
    other = F.struct((F.col("_n") * penalty(F.lit(size))).alias("cost"), F.lit(name).alias("lang"))
    judged = texts.select(order, n).join(best, F.col(order) == F.col("_at"), "left")
    return judged.select(order, F.when(F.col("_n") > 0, F.least(F.col("_best"), other)["lang"]).otherwise(F.lit(UNDETECTED)).alias("lang"))


def route_languages(
    lines: DataFrame, model: LanguageModel, line: str = "line", order: str = "seq"
) -> DataFrame:
    """``(order, line, lang)`` of each distinct stripped line."""
    first = distinct_texts(lines.select(order, strip(F.col(line)).alias(line)), line, order)
    if model.judge:
        return first.withColumn("lang", model.judge(F.lower(F.col(line))))
    first = materialize(first, "lines")
    return first.join(detect(first, model, line, order), order)
