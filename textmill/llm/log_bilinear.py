"""Scores of texts by a log-bilinear neural language model (``op12_lm_scores``).

Tokens are the words of a text, A-Z lower-cased, and one end. Every word belongs to a class: the ``HEADS`` commonest words of the training
texts and the end are classes of their own, all others fall into ``ENDINGS`` classes by a hash of their last bytes. With
``context`` the classes of the two tokens before (the end stands before the first token)

    P(word | context) = P(class | context) * P(word | class)

``P(class | context)`` is the log-bilinear model: the context words' embeddings, each through the matrix of its position, add up to a predicted
vector; its products with the output vectors, plus a bias, are the logits. ``P(word | class)`` is ``(c + 0.1) / (sum of c + 0.1 over the
words of the class + 0.1)``, the last 0.1 for all words never seen, so the probabilities of all known words and of "unknown" in each class add up to 1.

What is gathered: the count of every word of every training text (a table, as large as the vocabulary), and the counts of class triples over
all training texts, exact and at most ``CLASSES ** 3`` of them at any size. Training is noise-contrastive estimation in numpy on all of these
triples by their counts, without drawing any: ``TRAINERS`` tasks take a share of the contexts by hash and whole passes of ``STEPS`` batches or more over them,
their weights are averaged, ``ROUNDS`` times. So a task holds at most ``CLASSES ** 3 / TRAINERS`` triples or so, whatever the corpus.

Scoring normalises exactly: batched matrix products give the logits of all classes for every context met, once per task. Counts
of words with at least one in ``FREQUENT`` of all tokens (so at most ``FREQUENT`` words) are sent to all tasks; the others are joined by
word hash, from pairs (text, word) counted in their task, so no text is shuffled and no common word is a join key.
Words are compared by 64-bit hashes (a clash is expected once in about 6 * 10^9 different words).

Null and empty texts hold the end alone. Rows with a null id are scored, not learnt from, and have a null ``held_out``. Repeated rows are
learnt from and scored once each. Very long texts are scored whole. Without training texts every count is 0 and all classes are equally
likely. An empty table gives an empty result. Ties among the commonest words go to the smaller hash. Only named columns are read, so further columns cannot clash.
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

HEADS, ENDINGS = 127, 128
END_CLASS, CLASSES = HEADS, HEADS + 1 + ENDINGS
TAIL = 3  # last bytes that name the class of a rarer word
DIM = 24
TRAINERS, ROUNDS, STEPS, CONTEXTS, NOISE = 4, 2, 500, 512, 64
RATE = 0.02
FREQUENT = 1 << 19
ADD = 0.1
SLICE = 2 << 20
END = int(kit.span_hashes(kit.LOWER_VALUES[np.array([32])], np.zeros(1, np.int64), np.ones(1, np.int64)).view(np.int64)[0])  # no word holds a space


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key (word hash, or END), ending class and row of every token, ends included."""
    starts, ends, rows = kit.word_spans(data, offsets)
    symbols = kit.LOWER_VALUES[data]
    n, texts = len(starts), len(offsets) - 1
    place = np.arange(n) + rows
    last = np.searchsorted(rows, np.arange(texts), "right") + np.arange(texts)
    keys, kinds, owner = np.empty(n + texts, np.int64), np.full(n + texts, END_CLASS, np.int64), np.empty(n + texts, np.int64)
    if n:
        keys[place] = kit.span_hashes(symbols, starts, ends).view(np.int64)
        kinds[place] = HEADS + 1 + (kit.span_hashes(symbols, np.maximum(starts, ends - TAIL), ends) % np.uint64(ENDINGS)).astype(np.int64)
    keys[last], owner[place], owner[last] = END, rows, np.arange(texts)
    return keys, kinds, owner


def triples(kinds: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Context (two classes) and class of every token as one number."""
    before = np.full((2, len(kinds)), END_CLASS, np.int64)
    for k in (1, 2):
        same = owner[k:] == owner[:-k]
        before[k - 1, k:][same] = kinds[:-k][same]
    return (before[1] * CLASSES + before[0]) * CLASSES + kinds


def found_at(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def word_counts(docs: DataFrame) -> DataFrame:
    """``(key, kind, n)`` of every distinct token of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch, limit=SLICE):
                keys, kinds, _ = tokens(*kit.raw(part.column(0)))
                own, first, times = np.unique(keys, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(kinds[first].astype(np.int32)), pa.array(times.astype(np.int64))], names=["key", "kind", "n"])

    return docs.select("text").mapInArrow(rows, "key long, kind int, n long").groupBy("key").agg(F.min("kind").alias("kind"), F.sum("n").alias("n"))


def triple_counts(docs: DataFrame, heads: np.ndarray) -> DataFrame:
    """``(cell, n)`` of every class triple of ``docs``; each task sends a cell once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES**3, np.int32)
        for batch in batches:
            for part in kit.slices(batch, limit=SLICE):
                keys, kinds, owner = tokens(*kit.raw(part.column(0)))
                at, there = found_at(heads, keys)
                cells, times = np.unique(triples(np.where(there, at, kinds), owner), return_counts=True)
                held[cells] += times.astype(np.int32)
        cells = np.flatnonzero(held)
        for a in range(0, len(cells), 1 << 18):
            own = cells[a : a + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(held[own].astype(np.int64))], names=["cell", "n"])

    return docs.select("text").mapInArrow(rows, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


class Model:
    """Embeddings of context classes, a matrix for each position, output vectors and biases."""

    NAMES = ("embed", "near", "far", "out", "bias")

    def __init__(self, unigram: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
        self.near, self.far = (np.eye(DIM, dtype=np.float32) * s for s in (1.0, 0.5))
        self.out = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
        self.bias = np.log(unigram).astype(np.float32)

    def logits(self, contexts: np.ndarray) -> np.ndarray:
        """Log-probabilities (contexts x classes), normalised; a context is ``far * CLASSES + near``."""
        embed = self.embed.astype(np.float64)
        predicted = (embed @ self.near)[contexts % CLASSES] + (embed @ self.far)[contexts // CLASSES]
        found = predicted @ self.out.T.astype(np.float64) + self.bias
        top = found.max(1, keepdims=True)
        return found - (top + np.log(np.exp(found - top).sum(1, keepdims=True)))


def unigram_of(cells: np.ndarray, n: np.ndarray) -> np.ndarray:
    share = np.bincount(cells % CLASSES, n, CLASSES) + ADD
    return share / share.sum()


def train(model: Model, cells: np.ndarray, n: np.ndarray, unigram: np.ndarray, seed: int, steps: int = STEPS) -> Model:
    """Noise-contrastive estimation with the exact sums over all triples and all noise classes, in whole passes of ``steps`` batches or more.

    A batch holds the ``CONTEXTS`` commonest contexts and a part of the others, which the parts of one pass share out; a context comes
    with all counts of all its triples, the part weighs as much as all parts do.
    """
    rng = np.random.default_rng(seed)
    contexts, of = np.unique(cells // CLASSES, return_inverse=True)
    mass = np.bincount(of, n)
    falling = np.argsort(-mass, kind="stable")
    common, others = falling[:CONTEXTS], rng.permutation(falling[CONTEXTS:])
    batches = [common, *(others[i : i + CONTEXTS] for i in range(0, len(others), CONTEXTS))]
    place, batch_of = np.empty(len(contexts), np.int64), np.empty(len(contexts), np.int64)
    for k, own in enumerate(batches):
        place[own], batch_of[own] = np.arange(len(own)), k
    order = np.argsort(batch_of[of], kind="stable")
    ends = np.searchsorted(batch_of[of][order], np.arange(len(batches) + 1))
    expected = np.log(NOISE * unigram).astype(np.float32)  # log-odds at which a class is as likely noise as not
    state = {name: (np.zeros_like(getattr(model, name)), np.zeros_like(getattr(model, name))) for name in Model.NAMES}

    def slopes(k: int, scale: float) -> dict[str, np.ndarray]:
        """Slopes of the loss of a batch's contexts."""
        own, held = batches[k], order[ends[k] : ends[k + 1]]
        times = np.zeros((len(own), CLASSES), np.float32)
        times[place[of[held]], cells[held] % CLASSES] = n[held] * scale
        near, far = contexts[own] % CLASSES, contexts[own] // CLASSES
        e_near, e_far = model.embed[near], model.embed[far]
        predicted = e_near @ model.near + e_far @ model.far
        odds = 1 / (1 + np.exp(-np.clip(predicted @ model.out.T + model.bias - expected, -60, 60)))
        push = times * (odds - 1) + times.sum(1, keepdims=True) * (NOISE * unigram).astype(np.float32) * odds
        back = push @ model.out
        embed = np.zeros_like(model.embed)
        np.add.at(embed, near, back @ model.near.T)
        np.add.at(embed, far, back @ model.far.T)
        return {"embed": embed, "near": e_near.T @ back, "far": e_far.T @ back, "out": push.T @ predicted, "bias": push.sum(0)}

    parts = max(1, len(batches) - 1)
    steps = -(-steps // parts) * parts
    for step in range(1, steps + 1):
        grads = slopes(0, 1 / mass.sum())
        if len(batches) > 1:
            more = slopes(1 + step % parts, parts / mass.sum())
            grads = {name: grad + more[name] for name, grad in grads.items()}
        rate = RATE * (1 - 0.9 * step / steps)
        for name, grad in grads.items():
            m, v = state[name]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            setattr(model, name, (getattr(model, name) - change).astype(np.float32))
    return model


def trainer(sent, unigram: np.ndarray, turn: int):
    """The task of one share: train a copy of the model ``sent`` (pickled, broadcast)."""

    def task(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cell")
        n = frame["n"].to_numpy(np.float64)
        made = train(pickle.loads(sent.value), frame["cell"].to_numpy(np.int64), n, unigram, seed=turn * TRAINERS + int(key[0]))
        return pd.DataFrame({"part": [int(key[0])], "n": [n.sum()], "model": [pickle.dumps(made)]})

    return task


def fit_network(cells: DataFrame) -> Model:
    """The model trained on all of the table ``(cell, n)``: shares of it in ``TRAINERS`` tasks, averaged after each round."""
    own = cells.groupBy((F.col("cell") % CLASSES).alias("kind")).agg(F.sum("n").alias("n")).toPandas()  # at most CLASSES rows
    unigram = unigram_of(own["kind"].to_numpy(np.int64), own["n"].to_numpy(np.float64))
    model = Model(unigram)
    if not len(own):
        model.out[:], model.bias[:] = 0, 0
        return model
    dealt = cells.withColumn("part", F.pmod(F.xxhash64(F.floor(F.col("cell") / CLASSES)), F.lit(TRAINERS)))
    for turn in range(ROUNDS):
        task = trainer(cells.sparkSession.sparkContext.broadcast(pickle.dumps(model)), unigram, turn)
        made = sorted(dealt.groupBy("part").applyInPandas(task, "part int, n double, model binary").collect())  # TRAINERS models
        total = sum(r["n"] for r in made)
        parts = [(r["n"] / total, pickle.loads(r["model"])) for r in made]
        for name in Model.NAMES:
            setattr(model, name, sum(w * getattr(p, name) for w, p in parts).astype(np.float32))
    return model


def learn(docs: DataFrame, folder: str) -> tuple[dict, DataFrame]:
    """What scoring needs of the training texts ``docs(text)``: a bounded model, and the table of the rarer words' counts."""
    counts = kit.written(word_counts(docs), folder, "counts")
    total, words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = counts.where(F.col("n") * FREQUENT >= total)  # at most FREQUENT rows
    known = common.where(F.col("key") != END).toPandas().sort_values(["n", "key"], ascending=[False, True])
    ends = counts.where(F.col("key") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heads = np.sort(known["key"].to_numpy(np.int64)[:HEADS])
    tails = counts.where(~F.col("key").isin([int(k) for k in heads]) & (F.col("kind") > END_CLASS))
    sums = tails.groupBy("kind").agg((F.sum("n") + F.lit(ADD) * F.count("*")).alias("mass")).toPandas()  # at most ENDINGS rows
    mass = np.full(CLASSES, ADD)
    mass[sums["kind"].to_numpy(np.int64)] += sums["mass"].to_numpy(np.float64)
    end = pd.DataFrame({"key": [END], "kind": [END_CLASS], "n": [ends]})  # sent to all tasks, however rare
    known = pd.concat([known, end]).sort_values("key")
    network = fit_network(kit.written(triple_counts(docs, heads), folder, "triples"))
    model = {"network": network, "heads": heads, "keys": known["key"].to_numpy(np.int64), "n": known["n"].to_numpy(np.int64), "mass": np.log10(mass), "total": int(total), "words": int(words)}
    return model, counts.where(F.col("n") * FREQUENT < total).select("key", "n")


SCORED = "row long, doc_id long, tokens long, known long, logs double, head_logs double, class_logs double, mass_logs double, rare array<long>, times array<int>"


def score_slice(model: dict, table: np.ndarray, ready: np.ndarray, part: pa.RecordBatch) -> pa.RecordBatch:
    keys, kinds, owner = tokens(*kit.raw(part.column(part.schema.get_field_index("text"))))
    texts = part.num_rows
    own, back = np.unique(keys, return_inverse=True)
    at, head = found_at(model["heads"], own)
    place, common = found_at(model["keys"], own)
    logs = np.where(common, np.log10(model["n"][place] + ADD), 0.0)
    known = common & (model["n"][place] > 0)
    single = head | (own == END)  # classes of one token
    kinds = np.where(head[back], at[back], kinds)
    cells = triples(kinds, owner)
    contexts = cells // CLASSES
    fresh = np.unique(contexts[~ready[contexts]])
    for a in range(0, len(fresh), 4096):
        table[fresh[a : a + 4096]] = model["network"].logits(fresh[a : a + 4096])
    ready[fresh] = True

    def by_text(values: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(owner, values, texts))

    rare = ~common[back]
    held, times = np.unique(owner[rare] * len(own) + back[rare], return_counts=True)
    bounds = pa.array(np.searchsorted(held // len(own), np.arange(texts + 1)).astype(np.int32))
    whole = lambda x: pa.array(np.bincount(owner, x, texts).astype(np.int64))
    columns = [
        part.column(part.schema.get_field_index("row")),
        part.column(part.schema.get_field_index("doc_id")),
        whole(np.ones(len(keys))),
        whole(known[back]),
        by_text(logs[back]),
        by_text(np.where(single, logs, 0.0)[back]),
        by_text(table[contexts, kinds].astype(np.float64) / np.log(10)),
        by_text(np.where(single[back], 0.0, model["mass"][kinds])),
        pa.ListArray.from_arrays(bounds, pa.array(own[held % len(own)])),
        pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "tokens", "known", "logs", "head_logs", "class_logs", "mass_logs", "rare", "times"])


def score(docs: DataFrame, model: dict, rarer: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs(doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ready = np.zeros((CLASSES**2, CLASSES), np.float32), np.zeros(CLASSES**2, bool)  # filled for the contexts met
        for batch in batches:
            for part in kit.slices(batch, limit=SLICE):
                yield score_slice(sent.value, table, ready, part)

    asked = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = kit.written(asked.mapInArrow(rows, SCORED), folder, "scored")  # row numbers are fixed from here on
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    met = pairs.join(rarer, "key", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(ADD))).alias("more_logs"))
    joined = scored.drop("rare", "times").join(sums, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    base = float(np.log10(model["total"] + ADD * (model["words"] + 1)))
    return joined.select(
        "doc_id",
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model["total"]).cast("long").alias("train_tokens"),
        (logs - F.col("tokens") * F.lit(base)).alias("base_score"),
        (F.col("class_logs") + logs - F.col("head_logs") - F.col("mass_logs")).alias("score"),
    )


def score_corpus(docs: DataFrame, training: Column) -> DataFrame:
    """Learn from the rows where ``training`` holds, score all."""
    folder = kit.scratch(docs.sparkSession)
    model, rarer = learn(docs.where(training).select(F.col("text").cast("string").alias("text")), folder)
    return score(docs, model, rarer, folder)


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kit.tables(spark, sf_dir, "documents").select("doc_id", "text")
    fold = kit.fold(F.col("doc_id"), 10)
    found = score_corpus(docs, fold != 0)
    return found.select("doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op12_lm_scores": op12_lm_scores}
ORACLE_SQL: dict[str, str] = {}
