"""Divergence of sources against plain sums, with blocks and tiles of all sizes, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from textmill.llm import source_audit as sa

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    rows = [[x or "" for x in r] for r in rows]
    lower = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [lower(t) for t in TERM.findall(text)]
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    found = set()
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted({r[2] for r in rows if r[1] == lang})
        of_lang = Counter()
        for s in sources:
            of_lang.update(counts[lang, s])

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(of_lang)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                found |= {(lang, s, part, item, -value, n) for n, (value, _, item) in enumerate(sorted(items)[:most], 1)}
    return found


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "text string, lang string, source string, term string, n int").repartition(3)


def rows_of(seed, n, sources):
    rng = random.Random(seed)
    stock = [f"t{chr(97 + i)}{'é' * (i % 3)}" for i in range(26)] + ["The", "THE", "Ünï", "x1y"]
    return [(" ".join(rng.choice(stock[: 8 + (i % 3) * 11]) for _ in range(rng.randrange(0, 30))), rng.choice(["en", "de"]), f"s{rng.randrange(sources)}") for i in range(n)]


@pytest.mark.parametrize(("block", "tile", "sources"), [(2048, 32, 5), (4, 3, 11), (1, 1, 4)])
def test_all_pairs_and_terms(spark, monkeypatch, block, tile, sources):
    monkeypatch.setattr(sa, "BLOCK", block)
    monkeypatch.setattr(sa, "TILE", tile)
    rows = rows_of(block, 250, sources)
    rows += [(None, None, None), ("Wort wort", None, None), ("", "en", "empty"), ("lonely", "fr", "one"), ("x", "it", "a"), ("x", "it", "b"), ("ta " * 20_000, "en", "s0")]
    rows += [("same text", "de", "s1")] * 12
    got = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in sa.audit(table(spark, rows), least=9, top=6).collect()}
    assert got == brute(rows, 9, 6)


def test_empty_table(spark):
    assert sa.audit(table(spark, [("x", "en", "a")]).limit(0)).count() == 0


def test_shares_are_exact():
    rng = random.Random(2)
    counts = [0, 1, 7, 10**9, 8 * 10**15] + [rng.randrange(10**15) for _ in range(50)]
    totals = [c + 5 + rng.randrange(1, 10**15) for c in counts]
    got = sa.shares(np.array(counts), np.array(totals))
    assert got.tolist() == [1 + 1_000_000_000 * (c + 5) // t for c, t in zip(counts, totals)]


def test_equal_subtrees_are_one_node():
    counts = np.zeros((40, 1024), np.int64)
    counts[3, 17] = counts[9, 17] = 5
    leaves, levels, roots = sa.consed(counts)
    assert len(leaves) == 2 and sum(len(a) for a, _ in levels) <= 2 * 10 and len(set(roots.tolist())) == 2 and roots[3] == roots[9]
    totals = np.full(40, 5 * 1024)
    totals[3] += 5
    left, right = np.array([0, 3, 3]), np.array([1, 9, 0])
    plain = [sum(abs(int(sa.shares(counts[a, t : t + 1], totals[a : a + 1])[0]) - int(sa.shares(counts[b, t : t + 1], totals[b : b + 1])[0])) for t in range(1000)) for a, b in zip(left, right)]
    assert sa.divergences(counts, 1000, totals, left, right).tolist() == plain
