"""Toxicity by a convolutional text classifier trained here in numpy (``op8_toxicity``).

A word is the sum of three hashed embeddings: the whole word and its first four and five bytes (A-Z
lower-cased, edge punctuation off). Filters of several widths slide over the words of the whole text, each
filter keeps its maximum, and a logistic layer turns the maxima into a probability. Training is plain numpy
with Adam, on labelled rows of the training folds: at most ``TRAIN_ROWS`` of them, chosen by a hash of
the id, so the cut depends on no row order. It runs on word numbers alone, each network in a task of its own; the trained
weights (a few megabytes, fixed by the parameters) are sent to all tasks.

Scores are calibrated on every labelled row of the training folds, at every size: rows outside the sample are scored by the
network in all tasks, sampled ones by networks fitted on the other parts of the sample (``PARTS``). Counts by language,
label and score (``BINS`` steps) give the common cut and one threshold for each language (the smallest total error, shrunk
to the common one by ``PRIOR`` rows), used by ``flag``. A score itself depends on the text alone.

Null and empty texts are scored like a text without words. A training fold without both labels gives the
constant score of its base rate. Repeated rows give repeated rows; of a repeated label row the larger
label counts. An empty table gives an empty result. Very long texts are scored whole. Only named columns are read; ``accepted`` adds its own under free names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

BUCKETS = 1 << 16  # rows of the hashed embedding table
NUMBER = np.uint16  # holds a row of the table
DIM = 8
FILTERS = 8  # for each width
WIDTHS = (1, 2, 3)
TRAIN_ROWS = 12_000  # labelled rows a model is fitted on, at most
TRAIN_WORDS = 6_000_000  # words of those rows, at most; longer samples end before this row
ROW_WORDS = TRAIN_WORDS // 100  # a longer row is left out of the fit, alone
STEP_WORDS = 1 << 17  # words handled at once outside the batches
PARTS = 3  # of the sample, each scored by a network fitted on the others
BINS, STEP = 1024, 1 / 32  # log-odds of a score in steps from -16 to 16
BATCH, EPOCHS, MORE = 64, 8, 100  # a network takes EPOCHS / BATCH steps a row and MORE steps
CUT = 0.3
PRIOR = 50
EDGE = np.zeros(256, bool)
EDGE[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"]] = True


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three bucket numbers of each word (n x 3) and the words before each row's end."""
    starts, ends, _ = kit.word_spans(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    for _ in range(3):  # edge punctuation, as far as three characters
        starts = starts + (EDGE[data[starts]] & (ends - starts > 1)) if len(starts) else starts
        ends = ends - (EDGE[data[ends - 1]] & (ends - starts > 1)) if len(ends) else ends
    symbols = kit.LOWER_VALUES[data]
    found = [kit.span_hashes(symbols, starts, stop) + np.uint64(i) for i, stop in enumerate((ends, np.minimum(ends, starts + 4), np.minimum(ends, starts + 5)))]
    return np.stack([(kit.mix(h) % np.uint64(BUCKETS)).astype(NUMBER) for h in found], 1), bounds


class Network:
    """The classifier: embeddings, one filter bank for each width, a logistic layer."""

    def __init__(self, rng: np.random.Generator) -> None:
        self.table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.banks = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.float32(0)
        self.shift = np.float32(0)

    def vectors(self, numbers: np.ndarray) -> np.ndarray:
        return self.table[numbers[:, 0]] + self.table[numbers[:, 1]] + self.table[numbers[:, 2]]

    def pooled(self, vectors: np.ndarray, bounds: np.ndarray, where: bool = False):
        """Largest answer of each filter in each text (and the first place of it); texts too short for a width get 0."""
        rows = len(bounds) - 1
        best = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
        at = np.full((rows, len(WIDTHS) * FILTERS), -1, np.int64) if where else None
        sizes = np.diff(bounds)
        for i, (w, bank) in enumerate(zip(WIDTHS, self.banks)):
            own = np.flatnonzero(sizes >= w)
            if not len(own):
                continue
            n = len(vectors) - w + 1
            answer = vectors[:n] @ bank[0]
            for k in range(1, w):
                answer += vectors[k : k + n] @ bank[k]
            for k in range(1, w):  # windows that leave their text
                edges = bounds[1:-1] - k
                answer[edges[(edges >= 0) & (edges < n)]] = -np.inf
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            heads = bounds[own]
            top = np.maximum.reduceat(answer, heads, axis=0)
            best[own, cols] = np.maximum(top, 0)
            if where:
                peaks = answer[heads[0] :] == np.repeat(top, np.diff(np.append(heads, n)), axis=0)
                spots, filters = np.nonzero(peaks)
                spots += heads[0]
                place, first = np.unique((np.searchsorted(heads, spots, "right") - 1) * FILTERS + filters, return_index=True)
                at[own, cols] = np.where(top > 0, spots[first].reshape(len(own), FILTERS), -1)
        return best, at

    def odds(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        found = [np.zeros(0)]
        for first, last in runs_of(bounds):
            best = self.pooled(self.vectors(numbers[bounds[first] : bounds[last]]), bounds[first : last + 1] - bounds[first])[0]
            found.append(best.astype(np.float64) @ self.out + self.bias + self.shift)
        return np.concatenate(found)

    def scores(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(numbers, bounds), -40, 40)))


def runs_of(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts (first, last + 1) of at most ``STEP_WORDS`` words, one text at least."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + STEP_WORDS, "right")) - 1)
        yield first, last
        first = last


def start_from_counts(net: Network, numbers: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> None:
    """Begin with one direction of the embedding that holds each bucket's smoothed log-odds over texts."""
    held = np.zeros((2, BUCKETS))
    for first, last in runs_of(bounds):  # texts are counted apart, so a few of them at a time do
        rows = np.repeat(np.arange(first, last), np.diff(bounds[first : last + 1]))
        words = numbers[bounds[first] : bounds[last]]
        for column in range(3):
            pairs = np.unique(rows * BUCKETS + words[:, column])
            for label in (0, 1):
                held[label] += np.bincount(pairs[labels[pairs // BUCKETS] == label] % BUCKETS, minlength=BUCKETS)
    share = held.sum(0)
    rate = labels.mean()
    lift = np.log((held[1] + 2 * rate) / (share + 2) / rate) - np.log((held[0] + 2 * (1 - rate)) / (share + 2) / (1 - rate))
    net.table[:, 0] = np.clip(lift * share / (share + 3), -3, 3) * 0.5
    for bank in net.banks:
        bank[0, 0, :] = np.abs(bank[0, 0, :]) + 0.3
    net.out[:] = np.abs(net.out) + 0.1
    net.bias = np.float32(-2)


def train(numbers: np.ndarray, bounds: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """Fit by Adam on small batches; embeddings are updated for the words that reached a maximum."""
    rng = np.random.default_rng(seed)
    net = Network(rng)
    start_from_counts(net, numbers, bounds, labels)
    state: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def adam(name: str, value: np.ndarray, grad: np.ndarray, rate: float, step: int) -> np.ndarray:
        m, v = state.get(name, (np.zeros_like(grad), np.zeros_like(grad)))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        state[name] = m, v
        return (value - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)

    squares = np.full(BUCKETS, 1e-8, np.float32)
    weight = np.where(labels == 1, min(8.0, (labels == 0).sum() / max(1, labels.sum())), 1.0)
    order = np.zeros(0, np.int64)
    for step in range(1, EPOCHS * len(labels) // BATCH + MORE + 1):
        while len(order) < min(BATCH, len(labels)):
            order = np.concatenate([order, rng.permutation(len(labels))])
        rows, order = order[:BATCH], order[BATCH:]
        words = np.concatenate([numbers[bounds[r] : bounds[r + 1]] for r in rows])
        cuts = np.concatenate([[0], np.cumsum(bounds[rows + 1] - bounds[rows])])
        vectors = net.vectors(words)
        best, at = net.pooled(vectors, cuts, where=True)
        keep = (rng.random(best.shape) > 0.2) / 0.8  # dropout
        z = (best * keep) @ net.out + net.bias
        slope = ((1 / (1 + np.exp(-z))) - labels[rows]) * weight[rows] / weight[rows].sum()
        to_best = (slope[:, None] * net.out[None, :] * keep).astype(np.float32)
        places, slopes = [np.zeros(0, np.int64)], [np.zeros((0, DIM), np.float32)]  # words that reached a maximum
        for i, (w, bank) in enumerate(zip(WIDTHS, net.banks)):
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            row, filt = np.nonzero(at[:, cols] >= 0)
            spot, g = at[:, cols][row, filt], to_best[:, cols][row, filt]
            by_filter = np.zeros((FILTERS, len(spot)), np.float32)
            by_filter[filt, np.arange(len(spot))] = g
            grad_bank = np.stack([(by_filter @ vectors[spot + k]).T for k in range(w)])
            for k in range(w):
                places.append(spot + k)
                slopes.append(g[:, None] * bank[k][:, filt].T)
            net.banks[i] = adam(f"bank{i}", bank, grad_bank + 1e-4 * bank, 0.01, step)
        net.out = adam("out", net.out, slope @ (best * keep) + 1e-4 * net.out, 0.02, step)
        net.bias = np.float32(net.bias - 0.05 * slope.sum())
        buckets = words[np.concatenate(places)].astype(np.int64).ravel()  # three for each place
        if len(buckets):
            line = np.argsort(buckets, kind="stable")
            used, starts = np.unique(buckets[line], return_index=True)
            grad_table = np.add.reduceat(np.repeat(np.concatenate(slopes), 3, axis=0)[line], starts, axis=0)
            squares[used] += (grad_table**2).mean(1)
            net.table[used] -= 0.05 * grad_table / np.sqrt(squares[used])[:, None]
    return net


def bins(odds: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(odds / STEP) + BINS // 2, 0, BINS - 1).astype(np.int32)


def best_cut(counts: np.ndarray) -> float:
    """The log-odds cut with the fewest errors, from counts by label and bin (2 x BINS); between equals the middle one."""
    below = np.concatenate([[0], np.cumsum(counts[1])])
    above = counts[0].sum() - np.concatenate([[0], np.cumsum(counts[0])])
    places = np.flatnonzero(below + above == (below + above).min())
    return (places[len(places) // 2] - BINS // 2) * STEP


FITTED = "which int, net binary, rate double, lang array<string>, label array<int>, bin array<int>"


def fit_network(which: int, sample: pd.DataFrame) -> pd.DataFrame:
    """One network from rows (word numbers as bytes, label, lang, place); 'place' orders them.

    Number PARTS is fitted on all rows, the others leave out the rows of their part and give back their language, label and score bin.
    """
    sample = sample.sort_values(["place", "label"], kind="stable").reset_index(drop=True)
    labels = sample["label"].to_numpy(np.int64)
    parts = [np.frombuffer(x, NUMBER).reshape(-1, 3) for x in sample["numbers"]]

    def packed(rows):
        own = [parts[i] for i in rows]
        return np.concatenate([np.zeros((0, 3), NUMBER), *own]), np.concatenate([[0], np.cumsum([len(x) for x in own])])

    part = np.unique(sample["place"], return_inverse=True)[1] % PARTS  # rows of one id stay together
    rest, own = np.flatnonzero(part != which), np.flatnonzero(part == which)
    found = {"which": which, "net": None, "rate": float(labels.mean()), "lang": [], "label": [], "bin": []}
    if len(rest) and labels[rest].min() != labels[rest].max() and (which == PARTS or len(own)):
        net = train(*packed(rest), labels[rest])
        if which == PARTS:
            found["net"] = pickle.dumps(net)
        else:
            found |= {"lang": sample["lang"].to_numpy()[own].tolist(), "label": labels[own].tolist(), "bin": bins(net.odds(*packed(own))).tolist()}
    return pd.DataFrame([found])


def calibrate(model: dict, counts: pd.DataFrame) -> dict:
    """The model with its common shift and the thresholds by language, from counts (lang, label, bin, count) of all labelled rows."""
    held: dict[str | None, np.ndarray] = {}
    every = np.zeros((2, BINS))
    for lang, label, place, n in zip(counts["lang"], counts["label"], counts["bin"], counts["count"]):
        every[label, place] += n
        held.setdefault(lang, np.zeros((2, BINS)))[label, place] += n
    both = lambda c: c.sum(1).min() > 0
    chance = lambda z: 1 / (1 + np.exp(-z))
    middle = min(max(chance(best_cut(every)), 0.02), 0.98) if both(every) else CUT
    shift = np.log(CUT / (1 - CUT)) - np.log(middle / (1 - middle))  # the best common cut becomes CUT
    model["net"].shift = np.float32(shift)
    for lang, own in held.items():
        if lang is not None:
            cut = chance(best_cut(own) + shift) if both(own) else CUT
            model["cuts"][lang] = float((own.sum() * cut + PRIOR * CUT) / (own.sum() + PRIOR))
    return model


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in kit.slices(batch):
            numbers, bounds = word_numbers(*kit.raw(part.column(0)))
            packed = [numbers[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), *part.columns[1:]], names=["numbers", "label", "lang", "place"])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column) -> dict:
    """Train on rows of ``docs`` with a label where ``allowed`` (an expression on doc_id) holds."""
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isin(0, 1) & allowed).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    place = F.xxhash64("doc_id")
    sample = known.withColumn("place", place).orderBy("place", "doc_id").limit(TRAIN_ROWS)  # narrow rows, few enough to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = texts.join(F.broadcast(sample), "doc_id").select("text", "label", "lang", "place", "doc_id").mapInArrow(sized, "doc_id long, label int, place long, size long")
    sizes = sizes.groupBy("doc_id", "label", "place").agg(F.sum("size").alias("size"), F.max("size").alias("longest")).toPandas()
    sizes = sizes[sizes["longest"] <= ROW_WORDS].sort_values(["place", "doc_id"])
    sizes = sizes[sizes["size"].cumsum() <= TRAIN_WORDS]
    used = spark.createDataFrame([tuple(map(int, x)) for x in sizes[["doc_id", "label", "place"]].to_numpy()], "doc_id long, label int, place long")
    rows = texts.join(F.broadcast(used), "doc_id").select("text", "label", "lang", "place")
    numbers = rows.mapInArrow(numbered, "numbers binary, label int, lang string, place long")

    # a task for each network; the sample is bounded by TRAIN_ROWS and TRAIN_WORDS before it gets there
    dealt = numbers.select("*", F.explode(F.array(*[F.lit(k) for k in range(PARTS + 1)])).alias("which")).repartitionByRange(PARTS + 1, "which")

    def task(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        return fit_network(int(key[0]), sample)

    fitted = dealt.groupBy("which").applyInPandas(task, FITTED).collect()  # PARTS + 1 rows
    whole = [r for r in fitted if r["net"] is not None]
    model = {"net": pickle.loads(whole[0]["net"]) if whole else None, "rate": fitted[0]["rate"] if fitted else 0.0, "cuts": {}, "cut": CUT}
    if not model["net"]:
        return model
    counts = [x for r in fitted for x in zip(r["lang"], r["label"], r["bin"])]
    own = pd.DataFrame(counts, columns=["lang", "label", "bin"]).assign(count=1)
    # the texts stay in their tasks; only ids and bins meet the labels
    placed = binned(texts.where(allowed), model).join(known.join(F.broadcast(used), "doc_id", "left_anti"), "doc_id")
    rest = placed.groupBy("lang", "label", "bin").count().toPandas()  # at most 2 * BINS rows a language
    return calibrate(model, pd.concat([own, rest]) if len(own) and len(rest) else rest if len(rest) else own)


def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in kit.slices(batch):
            data, offsets = kit.raw(part.column(0))
            sizes = np.diff(np.searchsorted(kit.word_spans(data, offsets)[0], offsets))
            yield pa.RecordBatch.from_arrays([part.column(4), part.column(1), part.column(3), pa.array(sizes)], names=["doc_id", "label", "place", "size"])


def binned(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang and score bin of every row with doc_id, text and lang."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        net = sent.value["net"]
        for batch in batches:
            for part in kit.slices(batch):
                found = bins(net.odds(*word_numbers(*kit.raw(part.column(1)))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(found)], names=["doc_id", "lang", "bin"])

    return docs.mapInArrow(rows, "doc_id long, lang string, bin int")


def score(docs: DataFrame, model: dict, names: tuple[str, str] = ("toxic_score", "toxic_flag")) -> DataFrame:
    """``docs`` (any columns but ``names``) with the score and the flag by the threshold of the row's language, under these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        net = sent.value["net"]
        for batch in batches:
            for part in kit.slices(batch):
                numbers, bounds = word_numbers(*kit.raw(part.column(part.schema.get_field_index("text"))))
                found = net.scores(numbers, bounds) if net else np.full(part.num_rows, sent.value["rate"])
                langs = part.column(part.schema.get_field_index("lang")).to_pylist()
                cuts = np.array([sent.value["cuts"].get(x, sent.value["cut"]) for x in langs])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found), pa.array(found >= cuts)], names=[*part.schema.names, *names])

    schema = docs.schema.jsonValue()
    added = [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in zip(names, ("double", "boolean"))]
    return docs.mapInArrow(rows, type(docs.schema).fromJson({**schema, "fields": [*schema["fields"], *added]}))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` (any columns at all) that are not flagged."""
    names = kit.free_names(docs, "toxic_score", "toxic_flag")
    return score(docs, model, names).where(~F.col(names[1])).select(*docs.columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kit.tables(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, kit.tables(spark, sf_dir, "labels"), kit.fold(F.col("doc_id"), 4) != 2)
    return score(docs, model).select(
        "doc_id",
        (kit.fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= CUT).cast("int").alias("predicted"),
        "toxic_flag",
    )


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE_SQL: dict[str, str] = {}
