"""Language-model scores: counts against a plain count, probabilities that add up to 1, held-out gain, odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import kit
from textmill.llm import log_bilinear as lb

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "One one ONE"), (4, "One one ONE"), (None, "one never"), (5, "word " * 3000 + "x" * 5000), (6, "Ärger über\x0bÖl one"), (7, "  one one")]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


def base(rows, trained):
    counts = Counter()
    for (i, text), used in zip(rows, trained):
        if used:
            counts.update([*words(text), None])
    total, kinds = sum(counts.values()), len(counts)
    found = []
    for i, text in rows:
        own = [*words(text), None]
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        found.append((i, len(own), sum(counts[w] > 0 for w in own), total, round(score, 6)))
    return sorted(found, key=repr)


def shown(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("frequent", [lb.FREQUENT, 40])
def test_base_scores_of_odd_rows(spark, monkeypatch, frequent):
    monkeypatch.setattr(lb, "FREQUENT", frequent)  # with 40 most words are joined
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in ODD], "doc_id long, text string, key string, n int").repartition(3)
    found = lb.score_corpus(docs, F.coalesce(F.col("doc_id") % 2 != 1, F.lit(False)))
    assert shown(found) == base(ODD, [i is not None and i % 2 != 1 for i, _ in ODD])
    rows = {(r.doc_id, r.n_tokens): r.score for r in found.collect()}
    assert all(s < 0 and math.isfinite(s) for s in rows.values())


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    found = lb.score_corpus(docs, F.lit(False))
    assert shown(found) == base(ODD, [False] * len(ODD))
    assert all(r.score == pytest.approx(-r.n_tokens * math.log10(lb.CLASSES), rel=1e-5) for r in found.collect())
    assert lb.score_corpus(docs.limit(0), F.lit(True)).count() == 0


def test_class_probabilities_add_up_and_noise_estimation_learns_them():
    rng = np.random.default_rng(1)
    follow = {0: 5, 5: 9, 9: 0}
    chain = [0]
    for _ in range(60_000):
        chain.append(follow[chain[-1]] if chain[-1] in follow and rng.random() < 0.9 else int(rng.integers(0, 12)))
    cells, n = np.unique(lb.triples(np.array(chain), np.zeros(len(chain), np.int64)), return_counts=True)
    unigram = lb.unigram_of(cells, n)
    model = lb.train(lb.Model(unigram), cells, n.astype(float), unigram, seed=1, steps=600)
    logs = model.logits(np.arange(0, lb.CLASSES**2, 97))
    assert np.allclose(np.exp(logs).sum(1), 1)
    after = np.exp(model.logits(np.array([7 * lb.CLASSES + 5])))[0]
    assert 0.8 < after[9] < 0.99  # truly about 0.91


def test_words_of_a_class_and_unknown_add_up_to_one(spark):
    docs = spark.createDataFrame([(i, f"alpha beta w{i % 60} rare{i} alpha") for i in range(300)], "doc_id long, text string")
    folder = kit.scratch(spark)
    model, rarer = lb.learn(docs.select("text"), folder)
    counts = {r.key: (r.kind, r.n) for r in spark.read.parquet(f"{folder}/counts").collect()}
    heads = set(model["heads"].tolist())
    mass = Counter()
    for key, (kind, n) in counts.items():
        if key not in heads and kind > lb.END_CLASS:
            mass[kind] += (n + lb.ADD) / 10 ** model["mass"][kind]
    assert len(heads) == lb.HEADS and model["total"] == sum(n for _, n in counts.values()) == 300 * 6
    for kind, share in mass.items():
        assert share + lb.ADD / 10 ** model["mass"][kind] == pytest.approx(1)


def test_held_out_texts_gain_over_the_base(spark):
    rows = lb.op12_lm_scores(spark, DATA).collect()
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score - r.base_score for r in held) / tokens > 0.1  # in log10 a token
    assert sum(r.score > r.base_score for r in held) > 0.85 * len(held)


def test_no_triple_is_left_out_of_training():
    """Batches were drawn by counts, so the rarest triples met no step (F11): here each of 3,000 contexts has one of its own."""
    cells = np.arange(3_000) * lb.CLASSES + 3
    n = np.ones(len(cells))
    n[:1_000] = 1e9
    unigram = lb.unigram_of(cells, n)
    one, other = n.copy(), n.copy()
    other[2_999] = 1_000.0
    made = [lb.train(lb.Model(unigram), cells, x, unigram, seed=1, steps=1) for x in (one, other)]
    assert any(not np.array_equal(getattr(made[0], name), getattr(made[1], name)) for name in lb.Model.NAMES)
