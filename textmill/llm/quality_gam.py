"""Quality by a generalised additive model with pairwise interactions (``op10_quality``).

Shape statistics of the whole text are cut into quantile bins. Cyclic boosting visits one feature after
the other, fits a tree of at most four leaves to the gradient of the logistic loss over that feature's
bins and adds a small step of it to the feature's look-up table. Then the pairs whose best two-way split
explains most of what is left get a table each, boosted the same way by four-quadrant trees. A score is
the sum of the entries a row's bins select, all rows of a slice at once.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (by a hash of the id, so the cut depends on no row
order), as feature rows of fixed width in one task; its tables are a few hundred kilobytes. Features and
scores cover every row and the whole text.

Null and empty texts have the features of a text without words and are scored like any other. A training
fold with one label alone gives that label's rate as constant score. Of a repeated label row the larger
label counts; repeated rows give repeated rows; only named columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "stops", "bars", "distinct_words",
    "distinct_trigrams", "repeated_lines", "line_words", "odd_word_ends", "top_word", "doubled_words", "long_words", "short_sentences",
)
TRAIN_ROWS = 40_000
BINS = 48
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 8
GRID = 12  # bins of each side of a pair's table
RATE = 0.15
CUT = 0.5


def byte_class(characters: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[[ord(c) for c in characters]] = True
    return found


SYMBOLS = byte_class("#$%&*+/<=>@[\\]^_`{|}~!")
STOPS = byte_class(".,;:?")
UPPER, DIGIT, BAR = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), byte_class("0123456789"), byte_class("|")
LINE = byte_class("\n")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    rows = len(offsets) - 1
    starts, ends, owner = kit.word_spans(data, offsets)
    words = np.bincount(owner, minlength=rows).astype(float)
    size = np.maximum(np.diff(offsets), 1)
    some = np.maximum(words, 1)

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def counted(where: np.ndarray) -> np.ndarray:
        return np.bincount(owner[where], minlength=rows).astype(float)

    def distinct(hashes: np.ndarray, of: np.ndarray):
        keys, counts = np.unique(kit.mix(hashes ^ kit.mix(of.astype(np.uint64) + np.uint64(1))), return_counts=True)
        return keys, counts

    hashes = kit.word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    tagged = kit.mix(hashes ^ kit.mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first, back, counts = np.unique(tagged, return_index=True, return_inverse=True, return_counts=True)
    kinds = np.bincount(owner[first], minlength=rows).astype(float)
    top = np.zeros(rows)
    np.maximum.at(top, owner[first], counts)
    if len(starts) > 2:
        inside = owner[2:] == owner[:-2]
        grams = kit.mix(tagged[:-2] + kit.mix(tagged[1:-1]) * np.uint64(3) + kit.mix(tagged[2:] + np.uint64(9)))[inside]
        gram_owner = owner[:-2][inside]
        _, gram_first = np.unique(grams, return_index=True)
        gram_kinds = np.bincount(gram_owner[gram_first], minlength=rows) / np.maximum(np.bincount(gram_owner, minlength=rows), 1)
        doubled = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=rows)
    else:
        gram_kinds, doubled = np.zeros(rows), np.zeros(rows)
    # lines: runs of bytes between line ends, within a row
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:] |= LINE[data]
    marks = np.flatnonzero(edge)
    line_start, line_end = marks[:-1], marks[1:]
    solid = line_end - line_start > 1
    line_start, line_end = line_start[solid], line_end[solid]
    line_owner = np.searchsorted(offsets, line_start, "right") - 1
    body = line_end - (LINE[data[line_end - 1]] if len(line_end) else 0)
    if len(line_start):
        line_hash = kit.span_hashes(kit.LOWER_VALUES[data], line_start, body)
        line_tag = kit.mix(line_hash ^ kit.mix(line_owner.astype(np.uint64) + np.uint64(1)))
        _, line_first = np.unique(line_tag, return_index=True)
        again = np.ones(len(line_start), bool)
        again[line_first] = False
        repeated = np.bincount(line_owner[again], weights=(body - line_start)[again], minlength=rows)
    else:
        repeated = np.zeros(rows)
    lines = np.maximum(np.bincount(line_owner, minlength=rows), 1)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    length = (ends - starts).astype(float)
    return np.stack(
        [
            np.log1p(words),
            np.bincount(owner, weights=length, minlength=rows) / some,
            per_row(SYMBOLS[data]) / size,
            per_row(UPPER[data]) / size,
            per_row(DIGIT[data]) / size,
            per_row(STOPS[data]) / some,
            per_row(BAR[data]) / some,
            kinds / np.sqrt(some),
            gram_kinds,
            repeated / size,
            np.log1p(words / lines),
            counted(SYMBOLS[last]) / some,
            top / some,
            doubled / some,
            counted(length > 20) / some,
            counted(last == ord(".")) / some,
        ],
        1,
    )


def tree(grad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A step function of at most four leaves over ordered bins: two rounds of the split with the best gain."""
    value = np.zeros(len(grad))
    pieces = [(0, len(grad))]
    for _ in range(2):
        grown = []
        for a, b in pieces:
            g, w = np.cumsum(grad[a:b]), np.cumsum(weight[a:b])
            if b - a < 2:
                grown.append((a, b))
                continue
            gain = g[:-1] ** 2 / (w[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + 1)
            cut = a + 1 + int(gain.argmax())
            grown += [(a, cut), (cut, b)]
        pieces = grown
    for a, b in pieces:
        value[a:b] = grad[a:b].sum() / (weight[a:b].sum() + 1)
    return value


def quadrants(grad: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Best pair of cuts of a grid: its gain over one leaf, and the four-leaf table."""
    g, w = grad.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    corner = lambda t: (t[:-1, :-1], t[:-1, -1:] - t[:-1, :-1], t[-1:, :-1] - t[:-1, :-1], t[-1, -1] - t[:-1, -1:] - t[-1:, :-1] + t[:-1, :-1])
    gains = sum(x**2 / (y + 1) for x, y in zip(corner(g), corner(w)))
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    table = np.zeros(grad.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            table[rows, cols] = grad[rows, cols].sum() / (weight[rows, cols].sum() + 1)
    return float(gains[i, j] - g[-1, -1] ** 2 / (w[-1, -1] + 1)), table


class AdditiveModel:
    """Bin edges, one table for each feature and for each chosen pair, and an intercept."""

    def __init__(self, edges: list[np.ndarray], coarse: list[np.ndarray]) -> None:
        self.edges, self.coarse = edges, coarse
        self.single = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.base = 0.0

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        fine, coarse = self.bins(x, self.edges), self.bins(x, self.coarse)
        total = np.full(len(x), self.base)
        for table, b in zip(self.single, fine):
            total += table[b]
        for (i, j), table in self.pairs.items():
            total += table[coarse[i], coarse[j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    def cuts(n: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(x[:, i], np.linspace(0, 1, n + 1)[1:-1])) for i in range(x.shape[1])]

    model = AdditiveModel(cuts(BINS), cuts(GRID))
    fine, coarse = model.bins(x, model.edges), model.bins(x, model.coarse)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model.base = float(np.log(rate / (1 - rate)))
    margin = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, np.maximum(p * (1 - p), 1e-4)

    for _ in range(ROUNDS):
        for i, b in enumerate(fine):
            n = len(model.single[i])
            grad, weight = (np.bincount(b, weights=v, minlength=n) for v in slope())
            step = RATE * tree(grad, weight)
            model.single[i] += step
            margin += step[b]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        key = coarse[i] * shape[1] + coarse[j]
        return tuple(np.bincount(key, weights=v, minlength=shape[0] * shape[1]).reshape(shape) for v in slope())

    wide = [i for i in range(x.shape[1]) if len(model.coarse[i])]
    ranked = sorted(combinations(wide, 2), key=lambda p: -quadrants(*grid(*p))[0])[:PAIRS]
    for pair in ranked:
        model.pairs[pair] = np.zeros(tuple(len(model.coarse[i]) + 1 for i in pair))
    for _ in range(PAIR_ROUNDS):
        for i, j in ranked:
            step = RATE * quadrants(*grid(i, j))[1]
            model.pairs[i, j] += step
            margin += step[coarse[i], coarse[j]]
    return model


def feature_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``features`` (array of doubles) for each row of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch):
                found = features(*kit.raw(part.column(part.schema.get_field_index("text"))))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(k)) for k in keep), flat], names=[*keep, "features"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(rows, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", features array<double>")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> dict:
    """Train on rows of ``docs`` with a label where ``allowed`` (an expression on doc_id) holds."""
    known = labels.where(F.col("quality").isin(0, 1) & allowed).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    sample = known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(TRAIN_ROWS)  # narrow rows, few enough to broadcast
    rows = feature_rows(docs.join(F.broadcast(sample), "doc_id").select("text", "label", "place"), ["label", "place"])
    rows = rows.orderBy("place", "label", F.xxhash64("features")).limit(TRAIN_ROWS)  # an id may stand many times

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            yield pd.DataFrame({"model": [pickle.dumps({"model": None, "rate": 1.0})]})
            return
        sample = pd.concat(parts).sort_values(["place", "label"], kind="stable")
        x, y = np.stack(sample["features"].to_list()), sample["label"].to_numpy(float)
        model = train(x, y) if y.min() != y.max() else None
        yield pd.DataFrame({"model": [pickle.dumps({"model": model, "rate": float(y.mean())})]})

    # one task: at most TRAIN_ROWS rows of fixed width
    return pickle.loads(rows.repartition(1).mapInPandas(task, "model binary").first()["model"])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and ``score`` (probability of label 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch):
                own = sent.value["model"]
                found = own.scores(features(*kit.raw(part.column(1)))) if own else np.full(part.num_rows, sent.value["rate"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, score double")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kit.tables(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, kit.tables(spark, sf_dir, "labels"), kit.fold(F.col("doc_id"), 3) != 1)
    return score(docs, model).select(
        "doc_id",
        (kit.fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


QUERIES = {"op10_quality": op10_quality}
ORACLE_SQL: dict[str, str] = {}
