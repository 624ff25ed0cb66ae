"""TF-IDF phrase scoring over a fixed or a growing corpus.

Terms are 1- to 3-word phrases of clean words. Weights are ``tf * idf`` with
``idf = ln((1 + n) / (1 + df)) + 1``, L2-normalised per text over the terms the corpus
knows. Fitting splits lines normally; scoring first deletes newlines, which joins the
words on both sides.

Texts are dealt into slices of about ``SLICE_TEXT`` bytes by a hash of their id (by ranges of it for a growing corpus). Each slice
sends the hashes of its distinct terms with the number of its texts that hold each, dealt into buckets of hashes; a bucket adds them up
and sends back one number for each, in the order they came. So a term moves once per slice as 6 to 8 bytes, never as text, however
often it occurs, and no row of a text and a term is moved at all. A slice then norms and filters its texts and spells what is left.
A task goes through a slice in steps of ``STEP_WORDS`` words; of the whole slice it holds the texts and two numbers for each distinct term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import grams
from textmill.functions import text as tx
from textmill.functions.grams import Words
from textmill.plans import block_of, range_bounds, spread

MAX_WORDS = 3
# Bytes of text whose terms one group of a task holds.
SLICE_TEXT = 16 << 20
# Smaller slices are made where there would be fewer than two for each core.
LEAST_TEXT = 4 << 20
BUCKET_TEXT = 8 << 20
# Bytes of text that one task goes through, slice by slice.
TASK_TEXT = 32 << 20
# Words whose terms are held with their places at once.
STEP_WORDS = 1 << 18
# Words of a corpus that is counted without being scored, held at once.
BATCH_WORDS = 1 << 19


def fit_terms(text: Column) -> Column:
    return tx.ngrams(tx.word_tokens(text), 1, MAX_WORDS)


def phrase_array(text: Column, low: int, high: int) -> Column:
    """Distinct white-space n-grams of the scoring text."""
    return F.array_distinct(tx.ngrams(tx.whitespace_words(tx.normalize_for_scoring(text)), low, high))


def idf_of(df: Column, n: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


def term_runs(terms: Column, marked: Column | None = None) -> Column:
    """Array of ``(term, tf, mark)``: each distinct term of a row with its count.

    Sorts the row's terms and counts runs. ``marked`` holds distinct terms to flag; those
    that do not occur get a count of 0. A marked term is sorted in as the term plus a NUL,
    its direct successor, so it follows its own run.
    """
    nul = F.lit("\x00")
    stock = terms if marked is None else F.concat(terms, F.transform(marked, lambda m: F.concat(m, nul)))

    def starts(run: Column) -> Column:
        first = F.transform(run, lambda t, i: F.when((i == 0) | (t != F.get(run, i - 1)), i))
        return F.filter(first, lambda i: i.isNotNull())

    def count(run: Column) -> Column:
        def rows(at: Column) -> Column:
            def row(i: Column, j: Column) -> Column:
                term, following = F.get(run, i), F.get(at, j + 1)
                length = (F.coalesce(following, F.size(run)) - i).cast("long")
                if marked is None:
                    return F.struct(term.alias("term"), length.alias("tf"), F.lit(False).alias("mark"))
                flagged = F.coalesce(F.get(run, following) == F.concat(term, nul), F.lit(False))
                plain = F.struct(term.alias("term"), length.alias("tf"), flagged.alias("mark"))
                absent = F.struct(
                    F.substring(term, F.lit(1), F.length(term) - 1).alias("term"),
                    F.lit(0).cast("long").alias("tf"),
                    F.lit(True).alias("mark"),
                )
                before = F.when(j > 0, F.get(run, F.get(at, j - 1)))
                follows = F.coalesce(F.concat(before, nul) == term, F.lit(False))
                return F.when(~F.endswith(term, nul), plain).when(~follows, absent)

            return F.transform(at, row)

        return tx.let(starts(run), rows)

    found = tx.let(F.sort_array(stock), count)
    return found if marked is None else F.filter(found, lambda r: r.isNotNull())


def term_frequency(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, term, tf)`` of the texts as fitted."""
    rows = spread(docs.select(doc, text)).select(doc, F.explode(term_runs(fit_terms(F.col(text)))).alias("r"))
    return rows.select(doc, "r.term", "r.tf")


def _extent(frames: list[DataFrame], text: str) -> tuple[int, int]:
    """Rows and bytes of the texts of all frames."""
    found = [f.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first() for f in frames]
    return sum(r[0] for r in found), sum(r[1] for r in found)


def _parts(size: int, each: int) -> int:
    return max(1, -(-size // each))


def _slices(rows: DataFrame, size: int) -> int:
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(_parts(size, SLICE_TEXT), min(2 * cores, _parts(size, LEAST_TEXT)))


def _dealt(rows: DataFrame, slice_of: Column, size: int) -> DataFrame:
    """``rows`` with their ``_slice``, slice by slice. Shuffled once for both passes over the texts.

    In order here, so that texts are sorted and not the words taken from them.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, _parts(size, TASK_TEXT))
    return rows.select("*", slice_of.alias("_slice")).repartition(tasks, "_slice").sortWithinPartitions("_slice")


def _fit_words(text: str) -> Column:
    return F.coalesce(tx.word_tokens(F.col(text)), F.array()).alias("_fit")


def _score_words(text: str) -> Column:
    return F.coalesce(tx.lowered_tokens(tx.normalize_for_scoring(F.col(text))), F.array()).alias("_score")


class Step:
    """Some texts and the terms in them. A column ``_times`` says how many equal texts a row stands for."""

    def __init__(self, table: pa.Table) -> None:
        self.rows = table.num_rows
        self.times = table.column("_times").to_numpy() if "_times" in table.column_names else None
        self.words = {name: Words(table.column(name)) for name in ("_fit", "_score") if name in table.column_names}

    def distinct(self) -> np.ndarray:
        """Hashes of all terms, rising."""
        return _rising(np.concatenate([words.grams(1, MAX_WORDS)[0] for words in self.words.values()]))

    def pairs(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row, count, first word and size of each distinct term of each text, by hash and row."""
        words = self.words[name]
        hashes, at, sizes = words.grams(1, MAX_WORDS)
        order = np.argsort(hashes, kind="stable")  # rows rise among equal ones
        rising, row = hashes[order], words.rows[at[order]]
        heads = np.flatnonzero(_changes(rising) | _changes(row))
        first = order[heads]
        return rising[heads], row[heads], np.diff(np.append(heads, len(order))), at[first], sizes[first]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all terms, rising, and the number of texts that hold each as fitted."""
        found = []
        if "_fit" in self.words:
            hashes, row = self.pairs("_fit")[:2]
            heads = np.flatnonzero(_changes(hashes))
            counts = np.diff(np.append(heads, len(hashes))) if self.times is None else np.add.reduceat(self.times[row], heads) if len(heads) else heads
            found.append((hashes[heads], counts))
        if "_score" in self.words:
            hashes = _rising(self.words["_score"].grams(1, MAX_WORDS)[0])
            found.append((hashes, np.zeros(len(hashes), np.int64)))
        return found[0] if len(found) == 1 else _added(*found)


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it."""
    return np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])


def _rising(values: np.ndarray, kind: str | None = None) -> np.ndarray:
    """The different values in order. Sorted, as ``np.unique`` hashes them first, which takes longer."""
    values = np.sort(values, kind=kind)
    return values[_changes(values)]


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(hashes, kind="stable")  # merges the two runs
    rising = hashes[order]
    heads = np.flatnonzero(_changes(rising))
    return rising[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts


def _merged(found: Iterator, add: Callable) -> object:
    """All of ``found`` added up, like sizes with like ones; an item is led by its size."""
    parts: list = []
    for item in found:
        parts.append(item)
        while len(parts) > 1 and parts[-2][0] <= 2 * parts[-1][0]:
            parts[-2:] = [add(*parts[-2:])]
    while len(parts) > 1:
        parts[-2:] = [add(*parts[-2:])]
    return parts[0][1]


def _steps(table: pa.Table, groups: np.ndarray | None = None) -> Iterator[tuple[int, pa.Table]]:
    """First row and rows of each step, of about ``STEP_WORDS`` words; equal neighbours in ``groups`` stay together."""
    names = [name for name in ("_fit", "_score") if name in table.column_names]
    ends = np.cumsum(sum(pc.fill_null(pc.list_value_length(table.column(name)), 0).to_numpy().astype(np.int64) for name in names))
    cuts = np.arange(1, table.num_rows + 1) if groups is None else np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, table.num_rows)
    start = 0
    while start < table.num_rows:
        limit = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + STEP_WORDS, "right"))
        left = cuts[np.searchsorted(cuts, start, "right") :]
        stop = int(left[max(0, int(np.searchsorted(left, limit, "right")) - 1)])
        yield start, table.slice(start, stop - start)
        start = stop


def _counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a slice's terms, rising, and the number of its texts that hold each as fitted."""

    def add(a: tuple, b: tuple) -> tuple:
        found = _added(a[1], b[1])
        return len(found[0]), found

    found = (Step(part).counts() for _, part in _steps(table))
    return _merged(((len(c[0]), c) for c in found), add)


def _hashes(table: pa.Table) -> np.ndarray:
    """Hashes of a slice's terms, rising."""

    def add(a: tuple, b: tuple) -> tuple:
        found = _rising(np.concatenate([a[1], b[1]]), "stable")  # merges the two runs
        return len(found), found

    found = (Step(part).distinct() for _, part in _steps(table))
    return _merged(((len(h), h) for h in found), add)


ASKED = "_slice int, _bucket int, _hashes binary, _values binary"
TOLD = "_slice int, _bucket int, _found binary"


def _by_bucket(number: int, hashes: np.ndarray, values: np.ndarray, buckets: int) -> pa.Table:
    """One row for each bucket, ranges of rising hashes; ``number`` is that of the slice, -1 where nothing is asked."""
    cuts = [(b << 64) // buckets for b in range(1, buckets)]
    ends = [0, *np.searchsorted(hashes, np.array(cuts, np.uint64)), len(hashes)]
    spans = [(b, slice(i, j)) for b, (i, j) in enumerate(zip(ends, ends[1:])) if j > i]
    columns = {
        "_slice": pa.array([number] * len(spans), pa.int32()),
        "_bucket": pa.array([b for b, _ in spans], pa.int32()),
        "_hashes": pa.array([grams.pack_sorted(hashes[at]) for _, at in spans], pa.binary()),
        "_values": pa.array([grams.pack(values[at]) for _, at in spans], pa.binary()),
    }
    return pa.table(columns)


def _asked(sliced: DataFrame, buckets: int) -> DataFrame:
    """What each slice sends: its terms and the number of its texts that hold each."""

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        return _by_bucket(key[0].as_py(), *_counts(table), buckets)

    return sliced.groupBy("_slice").applyInArrow(ask, ASKED)


def _counted(corpus: DataFrame, buckets: int, text: str) -> DataFrame:
    """The terms of a corpus that is not scored itself, counted a few texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_WORDS, "right")))
                own = Step(pa.table({"_fit": batch.column(0).slice(start, stop - start)}))
                yield from _by_bucket(-1, *own.counts(), buckets).to_batches()
                start = stop

    return spread(corpus.select(text)).select(_fit_words(text)).mapInArrow(count, ASKED)


def _given(model: DataFrame, buckets: int) -> DataFrame:
    """The terms of a model ``(term, idf)``; the values are the weights."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0))
            whole, at, sizes = words.grams(1, MAX_WORDS)
            own = sizes == words.lengths[words.rows[at]]
            order = np.argsort(whole[own])
            weights = batch.column(1).to_numpy(zero_copy_only=False)[words.rows[at][own]]
            yield from _by_bucket(-1, whole[own][order], weights[order], buckets).to_batches()

    return model.select(F.split("term", " ", -1).alias("_term"), F.col("idf").cast("double")).mapInArrow(give, ASKED)


def _told(asked: DataFrame, how: str) -> DataFrame:
    """One number for each term that a slice has sent.

    ``total``: the texts that hold it; ``first``: the same, but 0 for all slices but the lowest that holds it;
    ``before``: the texts of lower slices that hold it; ``given``: its weight in the model, 0 where there is none.
    """
    kind = np.float64 if how == "given" else np.int64

    def tell(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_slice")
        slices = table.column("_slice").to_numpy()
        parts = [grams.unpack_sorted(x, np.uint64) for x in table.column("_hashes").to_pylist()]
        values = np.concatenate([grams.unpack(x, kind if s < 0 else np.int64) for s, x in zip(slices, table.column("_values").to_pylist())])
        ends = np.cumsum([len(p) for p in parts])
        hashes = np.concatenate(parts)
        del parts
        order = np.argsort(hashes, kind="stable")
        rising = hashes[order]
        heads = np.flatnonzero(np.concatenate([[True], rising[1:] != rising[:-1]]))
        sizes = np.diff(np.append(heads, len(rising)))
        sums = np.add.reduceat(values[order], heads)
        if how == "before":
            running = np.cumsum(values[order]) - values[order]
            answer = running - np.repeat(running[heads], sizes)
        elif how == "first":
            counted = np.where(values[order] > 0, np.arange(len(order)), len(order))
            answer = np.where(np.arange(len(order)) == np.repeat(np.minimum.reduceat(counted, heads), sizes), np.repeat(sums, sizes), 0)
        else:
            answer = np.repeat(sums, sizes)
        found = np.empty(len(order), kind)
        found[order] = answer
        spans = [(k, i, j) for k, (i, j) in enumerate(zip([0, *ends[:-1]], ends)) if slices[k] >= 0]
        columns = {
            "_slice": pa.array([int(slices[k]) for k, _, _ in spans], pa.int32()),
            "_bucket": pa.array([key[0].as_py()] * len(spans), pa.int32()),
            "_found": pa.array([grams.pack(found[i:j]) for _, i, j in spans], pa.binary()),
        }
        return pa.table(columns)

    return asked.groupBy("_bucket").applyInArrow(tell, TOLD)


def _unpacked(told: pa.Table, kind: type) -> np.ndarray:
    """The answers to a slice, in the order of its terms."""
    parts = [grams.unpack(x, kind) for x in told.sort_by("_bucket").column("_found").to_pylist()]
    return np.concatenate([np.zeros(0, kind), *parts])


def document_frequency(corpus: DataFrame, text: str = "text", times: str | None = None) -> DataFrame:
    """``(term, df)``: number of texts holding each term. Each is spelt by the lowest slice that holds it.

    ``times``: a column of whole numbers from 1, the texts that a row stands for.
    """
    _, size = _extent([corpus], text)
    # Dealt by all plain columns, so that copies of a text under several ids do not meet.
    plain = [f.name for f in corpus.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(_slices(corpus, size))).cast("int")
    more = [F.col(times).cast("long").alias("_times")] if times else []
    sliced = _dealt(corpus.select(text, deal.alias("_deal"), *more), F.col("_deal"), size).select("_slice", _fit_words(text), *["_times"] * len(more))
    told = _told(_asked(sliced, _parts(size, BUCKET_TEXT)), "first")

    def spell(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes, df = _hashes(left), _unpacked(right, np.int64)
        found = [pa.table({"term": pa.array([], pa.string()), "df": pa.array([], pa.int64())})]
        for _, part in _steps(left):
            step = Step(part)
            term, _, _, at, sizes = step.pairs("_fit")
            heads = np.flatnonzero(_changes(term))
            place = np.searchsorted(hashes, term[heads])
            heads, place = heads[df[place] > 0], place[df[place] > 0]
            terms = step.words["_fit"].spelt(at[heads], sizes[heads])
            found.append(pa.table({"term": terms, "df": pa.array(df[place])}))
            df[place] = 0  # spelt once
        return pa.concat_tables(found)

    return sliced.groupBy("_slice").cogroup(told.groupBy("_slice")).applyInArrow(spell, "term string, df long")


def idf(corpus: DataFrame, text: str = "text") -> DataFrame:
    """``(term, df, idf)`` of a corpus."""
    n = corpus.agg(F.count("*")).scalar()
    return document_frequency(corpus, text).select("term", "df", idf_of(F.col("df"), n).alias("idf"))


def _groups(ids: pa.ChunkedArray) -> np.ndarray:
    """A number for each row; rows with the same id have the same."""
    return pc.dictionary_encode(ids.combine_chunks(), null_encoding="encode").indices.to_numpy()


def _normed(pairs: tuple, weights: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, row, score, first word and size of each term of weight; ``groups`` numbers the rows by their ids."""
    term, row, _, at, sizes = pairs
    known = weights > 0
    group = groups[row[known]]
    norms = np.sqrt(np.bincount(group, weights[known] ** 2))
    return term[known], row[known], weights[known] / norms[group], at[known], sizes[known]


def _scored(
    docs: DataFrame,
    corpus: DataFrame | None,
    model: DataFrame | None,
    doc: str,
    text: str,
    corpus_text: str,
    more: list[Column],
    pick: Callable[[pa.Table, Step, tuple], tuple[np.ndarray, pa.Array, np.ndarray]],
    term: str = "term",
) -> DataFrame:
    """``(doc, term, score)`` of what ``pick`` takes from the scored terms of a slice, as rows, terms and scores."""
    rows = docs.select(doc, text)
    same = corpus is not None and docs.select(text).sameSemantics(corpus.select(corpus_text))
    n, size = _extent([rows], text)
    total = size
    if corpus is not None and not same:
        n, more_size = _extent([corpus], corpus_text)
        total += more_size
    buckets = _parts(total, BUCKET_TEXT)
    dealt = _dealt(rows, F.pmod(F.xxhash64(doc), F.lit(_slices(rows, size))).cast("int"), size)
    asked = _asked(dealt.select("_slice", doc, _score_words(text), *([_fit_words(text)] if same else [])), buckets)
    if model is not None:
        asked = asked.unionByName(_given(model, buckets))
    elif not same:
        asked = asked.unionByName(_counted(corpus, buckets, corpus_text))
    told = _told(asked, "total" if model is None else "given")

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        groups = _groups(left.column(doc))
        order = np.argsort(groups, kind="stable")
        left, groups = left.take(pa.array(order)), groups[order]
        hashes = _hashes(left)
        found = _unpacked(right, np.float64 if model_given else np.int64)
        weight = found if model_given else np.where(found > 0, np.log((1.0 + n) / (1.0 + found)) + 1, 0.0)
        told = [_result(left.slice(0, 0), doc, term, np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0))]
        for start, part in _steps(left, groups):
            step = Step(part)
            pairs = step.pairs("_score")
            weights = pairs[2] * weight[np.searchsorted(hashes, pairs[0])]
            own = groups[start : start + step.rows] - groups[start]
            told.append(_result(part, doc, term, *pick(part, step, _normed(pairs, weights, own))))
        return pa.concat_tables(told)

    model_given = model is not None
    kind = docs.schema[doc].dataType.simpleString()
    # The terms as fitted are needed again, as the answers stand in the order of all terms of the slice.
    held = dealt.select("_slice", doc, _score_words(text), *([_fit_words(text)] if same else []), *more)
    return held.groupBy("_slice").cogroup(told.groupBy("_slice")).applyInArrow(tell, f"`{doc}` {kind}, {term} string, score double")


def _result(part: pa.Table, doc: str, term: str, rows: np.ndarray, names: pa.Array, scores: np.ndarray) -> pa.Table:
    return pa.table({doc: part.column(doc).take(pa.array(rows)), term: names, "score": pa.array(scores)})


def _best(row: np.ndarray, score: np.ndarray, top: int | None) -> np.ndarray:
    """Which scores are not below the ``top`` best ones of their row; equal ones all stay."""
    order = np.lexsort((-score, row))
    if top is None:
        return order
    if top < 1:
        return order[:0]
    row, score = row[order], score[order]
    last = np.minimum(np.searchsorted(row, row) + top, np.searchsorted(row, row, "right")) - 1
    return order[score >= score[last]]


def _terms_above(min_score: float, top: int | None = None) -> Callable:
    """Terms with more than ``min_score``; with ``top`` none that is below the ``top`` best of its text."""

    def pick(table: pa.Table, own: Step, scored: tuple) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        _, row, score, at, sizes = scored
        kept = np.flatnonzero(score > min_score)
        kept = kept[_best(row[kept], score[kept], top)]
        return row[kept], own.words["_score"].spelt(at[kept], sizes[kept]), score[kept]

    return pick


def tfidf_scores(
    docs: DataFrame,
    corpus: DataFrame,
    min_score: float = 0.2,
    doc: str = "doc_id",
    text: str = "text",
    corpus_text: str = "text",
) -> DataFrame:
    """``(doc, term, score)`` with ``score > min_score``."""
    return _scored(docs, corpus, None, doc, text, corpus_text, [], _terms_above(min_score))


def phrase_candidates(
    docs: DataFrame, min_ngrams: int = 2, max_ngrams: int = 10, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc, ngram, edge)``: every distinct white-space phrase of ``min_ngrams``..``max_ngrams`` words.

    ``edge`` marks the first and the last phrase of a text in order: a smallest or largest phrase is one of them, so
    extremes need not be kept for each row.
    """
    rows = spread(docs.select(doc, text)).select(doc, phrase_array(F.col(text), min_ngrams, max_ngrams).alias("_all"))
    ends = rows.select(doc, "_all", F.array_min("_all").alias("_first"), F.array_max("_all").alias("_last"))
    # Of a plain explode Spark infers a filter on the array, which it would build once more below the exchange for that.
    found = ends.select(doc, "_first", "_last", F.explode_outer("_all").alias("ngram")).where(F.col("ngram").isNotNull())
    return found.select(doc, "ngram", ((F.col("ngram") == F.col("_first")) | (F.col("ngram") == F.col("_last"))).alias("edge"))


def merged_frequency(frequency: DataFrame | None, added: DataFrame, text: str = "text", times: str | None = None) -> DataFrame:
    """``(term, df)`` of a corpus that has grown by the texts of ``added``, each ``times`` over; the old texts are not read."""
    delta = document_frequency(added, text, times)
    return delta if frequency is None else frequency.unionByName(delta).groupBy("term").agg(F.sum("df").alias("df"))


def rank_phrases(
    docs: DataFrame,
    corpus: DataFrame | None,
    min_score: float = 0.2,
    min_ngrams: int = 2,
    max_ngrams: int = 10,
    doc: str = "doc_id",
    text: str = "text",
    corpus_text: str = "text",
    model: DataFrame | None = None,
    top: int | None = None,
) -> DataFrame:
    """``(doc, ngram, score, rank)`` of the phrases with ``score >= min_score``, only ranks to ``top``.

    ``model``: the ``(term, df, idf)`` of a corpus, in place of the corpus.

    A text with fewer than ``min_ngrams`` phrases keeps all of them. Scores at or below
    ``min_score`` count as 0. Only phrases of up to three words can have a score, so with a
    positive ``min_score`` longer ones are listed just for texts that keep everything.
    """
    if min_ngrams < 1:
        raise ValueError("min_ngrams must be at least 1")
    # Sizes differ, so a text of 2 * min_ngrams words or more has at least min_ngrams phrases once the size range allows it;
    # only other texts need their phrases counted. Phrases without a score are wanted only where everything is kept.
    enough = 2 * min_ngrams if max_ngrams >= 2 * min_ngrams else None

    def pick(table: pa.Table, own: Step, scored: tuple) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        words = Words(table.column("_words"))
        whole = np.ones(own.rows, bool) if enough is None or min_score <= 0 else words.lengths < enough
        hashes, at, sizes = words.grams(min_ngrams, max_ngrams, whole, MAX_WORDS)
        kinds, back = np.unique(hashes, return_inverse=True)
        held, first = np.unique(words.rows[at] * max(1, len(kinds)) + back, return_index=True)
        row, kind = held // max(1, len(kinds)), held % max(1, len(kinds))
        few = whole & (np.bincount(row, minlength=own.rows) < min_ngrams)
        if enough is not None:
            few &= words.lengths < enough
        term, of, score, _, _ = scored
        # The terms that are phrases too, by their numbers among the phrases.
        above = score > min_score
        term, of, score = term[above], of[above], score[above]
        place = np.minimum(np.searchsorted(kinds, term), max(0, len(kinds) - 1))
        spelt = kinds[place] == term if len(kinds) else np.zeros(len(term), bool)
        key = of[spelt] * max(1, len(kinds)) + place[spelt]
        spot = np.minimum(np.searchsorted(held, key), max(0, len(held) - 1))
        there = held[spot] == key if len(held) else np.zeros(len(key), bool)
        scores = np.zeros(len(held))
        scores[spot[there]] = score[spelt][there]
        kept = np.flatnonzero((scores >= min_score) | few[row])
        kept = kept[_best(row[kept], scores[kept], top)]
        return row[kept], words.spelt(at[first[kept]], sizes[first[kept]]), scores[kept]

    split = tx.whitespace_words(tx.normalize_for_scoring(F.col(text)))
    more = [F.coalesce(split, F.array()).alias("_words")]
    kept = _scored(docs, corpus if model is None else None, model, doc, text, corpus_text, more, pick, "ngram")
    best = W.partitionBy(doc).orderBy(F.desc("score"), "ngram")
    ranked = kept.withColumn("rank", F.row_number().over(best))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def top_terms(
    docs: DataFrame, corpus: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text", corpus_text: str = "text"
) -> DataFrame:
    """The ``n`` best terms of each text."""
    best = W.partitionBy(doc).orderBy(F.desc("score"), "term")
    scored = _scored(docs, corpus, None, doc, text, corpus_text, [], _terms_above(0.0, n))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def tfidf_expanding(
    docs: DataFrame, min_score: float = 0.2, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Score each text against the corpus up to and including itself, in the order of ``doc``.

    Replaces a refit per text: the document frequency seen by a text is a running count per term. Slices are ranges of
    ``doc``; a bucket counts the texts of lower slices, the slice goes on from there.
    """
    rows, size = _extent([docs], text)
    bounds = range_bounds(docs, doc, max(1, rows // _slices(docs, size)))
    place = block_of(F.col(doc), bounds).cast("int")
    sizes = docs.groupBy(place.alias("b")).agg(F.count("*").alias("n")).collect()  # at most MOST_BLOCKS rows
    before, passed = {}, 0
    for r in sorted(sizes):
        before[r["b"]], passed = passed, passed + r["n"]
    sliced = _dealt(docs.select(doc, text), place, size).select("_slice", doc, _score_words(text), _fit_words(text))
    told = _told(_asked(sliced, _parts(size, BUCKET_TEXT)), "before")
    pick = _terms_above(min_score)

    def tell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.take(pc.sort_indices(left.column(doc).combine_chunks(), null_placement="at_start"))
        groups = _groups(left.column(doc))
        hashes, df = _hashes(left), _unpacked(right, np.int64)  # the texts of lower slices, then of lower steps too
        told = [_result(left.slice(0, 0), doc, "term", np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0))]
        for start, part in _steps(left, groups):
            step = Step(part)
            pairs, fitted = step.pairs("_score"), step.pairs("_fit")
            of, known = np.searchsorted(hashes, pairs[0]), np.searchsorted(hashes, fitted[0])
            inside, asked = known * step.rows + fitted[1], of * step.rows
            here = np.searchsorted(inside, asked + pairs[1], "right") - np.searchsorted(inside, asked)
            held = df[of] + here
            n = before[key[0].as_py()] + start + pairs[1] + 1
            weights = np.where(held > 0, pairs[2] * (np.log((1.0 + n) / (1.0 + held)) + 1), 0.0)
            own = groups[start : start + step.rows] - groups[start : start + step.rows].min()
            told.append(_result(part, doc, "term", *pick(part, step, _normed(pairs, weights, own))))
            heads = np.flatnonzero(_changes(known))
            df[known[heads]] += np.diff(np.append(heads, len(known)))
        return pa.concat_tables(told)

    kind = docs.schema[doc].dataType.simpleString()
    return sliced.groupBy("_slice").cogroup(told.groupBy("_slice")).applyInArrow(tell, f"`{doc}` {kind}, term string, score double")
