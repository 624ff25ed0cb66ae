"""Conversation repair against a search over edit strings, on many small conversations and on long ones in small chunks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from textmill.llm import dialogue_repair as dr

SOLID = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    """(conv, turn, role, text) after damage, by the definition."""
    found = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(":".join(shown).encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        found += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return found


def brute(rows):
    """The result of one conversation from its damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        solid = SOLID.findall(text)
        kinds.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(t, last, inserted):
        options = [(0, "", ())] if t == len(rows) and last in ("", "a") else []
        need = "a" if last == "u" else "u"
        if inserted < 2:
            cost, audit, lines = best(t, need, inserted + 1)
            options.append((cost + 5, "I" + audit, ((None, need), *lines)))
        if t < len(rows):
            cost, audit, lines = best(t + 1, last, 0)
            options.append((cost + 2, "D" + audit, lines))
            if kinds[t] in ("", "truncated"):
                extra = 5 * (kinds[t] == "truncated")
                cost, audit, lines = best(t + 1, need, 0)
                options.append((cost + 1 + extra, "R" + audit, ((t, need), *lines)))
                if initials[t] and initials[t] in follow[last]:
                    cost, audit, lines = best(t + 1, initials[t], 0)
                    options.append((cost + extra, "K" + audit, ((t, None), *lines)))
        return min(options, default=(10**9, "", ()))[:3]

    cost, audit, lines = best(0, "", 0)
    names = {"u": "user", "a": "assistant"}
    shown = [f"{names[new] if new else rows[t][2]}:{'' if t is None else rows[t][3]}" for t, new in lines]
    turns = [r[1] for r in rows if r[1] is not None]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(shown).encode()).hexdigest(),
    )


def expected(rows):
    left = damaged(rows)
    return {conv: brute([r for r in left if r[0] == conv]) for conv in {r[0] for r in rows}}


def got(spark, rows, size=dr.CHUNK):
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, chunk int").repartition(3)
    found, _ = dr.repair(table, dr.damage(table).drop("copy"), size)
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[f] for f in fields) for r in found.collect()}


def talk(rng, conv, turns):
    roles = ["user", "assistant"]
    rows = []
    for turn in range(turns):
        role = "system" if turn == 0 and rng.random() < 0.4 else rng.choice(["system", "tool", "", None, "unknown"]) if rng.random() < 0.15 else roles[(turn + rng.randrange(20) // 18) % 2]
        text = None if rng.random() < 0.05 else rng.choice(["Yes.", "No!", "What", "", " \n", f"say {turn}.", f"word {rng.randrange(9)}", "Ärger?  "])
        rows.append((conv, None if rng.random() < 0.05 else turn + (rng.random() < 0.1), role, text))
    return rows


def test_small_conversations(spark):
    rng = random.Random(5)
    rows = [r for conv in [*range(250), None] for r in talk(rng, conv, rng.randrange(1, 13))]
    rows += [(900, 0, "user", "same."), (900, 0, "user", "same."), (901, None, None, None), (902, 2, "user", "x" * 50_000)]
    assert got(spark, rows) == expected(rows)


@pytest.mark.parametrize("kind", ["mixed", "blank", "repeated", "system"])
def test_long_conversations_in_small_chunks(spark, kind):
    rng = random.Random(kind)
    rows = talk(rng, 1, 150) if kind == "mixed" else [(1, t, rng.choice(["user", "assistant"]), "" if kind == "blank" else "again.") for t in range(150)]
    if kind == "system":
        rows = [(1, t, "system" if t < 120 else "user", f"line {t}.") for t in range(150)]
    rows += talk(rng, 2, 40) + talk(rng, 3, 2)
    assert got(spark, rows, 3) == expected(rows)


def test_vectors_converge_and_compose():
    rng = np.random.default_rng(3)
    kinds = [rng.integers(0, 12, n) for n in (1, 2, 5, 40)]
    whole = dr.transfer([np.concatenate(kinds)])
    vector = np.array([dr.FINAL])
    for k in reversed(kinds):
        vector = dr.through(dr.transfer([k]), vector)
    assert (vector == dr.through(whole, np.array([dr.FINAL]))).all()
    alike, form = dr.converged(whole)
    assert alike[0] and (form == dr.level(vector)).all()
    assert not dr.converged(dr.transfer([np.full(30, dr.FORCED)]))[0][0]


def test_no_rows_left_and_empty_table(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = got(spark, [(dropped, 0, "user", "Gone."), (5, 1, "assistant", "Hello.")])
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dr.repair(empty, dr.damage(empty).drop("copy"))[0].count() == 0
