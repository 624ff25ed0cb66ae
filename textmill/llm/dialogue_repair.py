"""Repair of damaged conversations by the cheapest edits (``op11_dialogue_repair``), with a chunked Viterbi search.

A conversation is in order when its role initials read ``(s?(ua)+)?``. Walking through its turns, a row is kept (``K``, 0), given the role
that the place asks for (``R``, 1) or deleted (``D``, 2; the only choice for blank and repeated rows), and an empty turn of the role
asked for may be inserted anywhere (``I``, 5). A truncated row that stays adds 5. Of all cheapest edits the one whose letters come first in
ASCII order is taken. Four states say what has been read: nothing, the system turn, a user turn, an assistant turn.

Order and chunks: narrow rows (no text) are sorted over all tasks by conversation, turn (nulls first), role, digest of the text and row number, so
a conversation of any length is spread over tasks. Each batch of sorted rows falls into chunks: rows of one conversation, at most ``CHUNK``.

Search: every chunk is walked backwards from four speculative cost vectors, one for each state its successor may start in. Real vectors never
spread by more than ``SPREAD`` (any state reaches an assistant turn with two insertions), so a chunk whose four results differ by constants alone, each
other state being charged ``SPREAD``, has converged: what follows it no longer matters. Fix-up passes run over the chunks that have not converged: each takes its
successor's vector if that is known and else joins the successor's results to its own, so that ``n`` chunks need at most ``log2(n)`` passes. Only conversations of
several chunks take part, in rows of a fixed size. Constants are dropped; the true vector behind a chunk then drives the forward trace inside it: the
first letter among D, I, K, R that keeps the cost. Start states of the chunks are found by the same kind of passes over their maps of four states.

Nulls in ``role`` and ``text`` and in the damage key read as one space. Rows without conv_id form one conversation (null). Equal turns go by role, then by the md5
of role and text; equal rows are interchangeable. A conversation without rows after damage has zeros, an empty audit and the hash of the empty string. Very long texts
are handled whole: they are read to find faults and, if kept, to be hashed. An empty table gives an empty result. Only named columns are read, so further columns cannot clash.

SHA-256 of a repaired conversation is sequential by definition: its kept texts pass through one task, as a stream, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm import kit

CHUNK = 4096  # rows of a chunk, at most
CELLS = 1 << 20  # rows walked in step, times the longest chunk among them
SPREAD = 16
FAR = np.int64(1) << 40  # no way
WHITE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # states: what has been read last
ASKED = np.array([USER, USER, ASSISTANT, USER])  # state after an insertion or a new role
FINAL = np.array([0, 10, 5, 0], np.int64)  # cheapest end of a conversation by state, insertions alone
CLASSES = "sua"  # role initials that may stay; class 3 is any other
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])  # state, class -> state
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
COST = {"R": 1, "D": 2, "I": 5, "truncated": 5}
FORCED = 2  # kind of a row: class * 3 + (0 plain, 1 truncated, 2 to be deleted)


def step_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By kind and state: cost and next state of K and of R (FAR where there is none)."""
    shape = (12, 4)
    keep, keep_to, role, role_to = np.full(shape, FAR), np.zeros(shape, np.int64), np.full(shape, FAR), np.tile(ASKED, (12, 1))
    for kind in range(12):
        if kind % 3 == FORCED:
            continue
        extra = COST["truncated"] * (kind % 3)
        role[kind] = COST["R"] + extra
        for state in range(4):
            if KEPT[state, kind // 3] >= 0:
                keep[kind, state], keep_to[kind, state] = extra, KEPT[state, kind // 3]
    return keep, keep_to, role, role_to


KEEP, KEEP_TO, ROLE, ROLE_TO = step_tables()


def back(kinds: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost vectors before the rows ``kinds`` (m) from those behind them (m x ... x 4, states last)."""
    shape = (len(kinds),) + (1,) * (after.ndim - 2) + (4,)
    pick = lambda table: np.broadcast_to(table[kinds].reshape(shape), after.shape)
    found = np.minimum(after + COST["D"], np.take_along_axis(after, pick(KEEP_TO), -1) + pick(KEEP))
    found = np.minimum(found, np.take_along_axis(after, pick(ROLE_TO), -1) + pick(ROLE))
    for _ in range(2):
        found = np.minimum(found, found[..., ASKED] + COST["I"])
    return found


def groups(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of chunks of similar size, at most CELLS padded rows at once."""
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * max(1, sizes[order[stop]]) <= CELLS:
            stop += 1
        yield order[start:stop]
        start = stop


def padded(kinds: list[np.ndarray]) -> np.ndarray:
    """Rows of kinds, filled up at the front with -1."""
    found = np.full((len(kinds), max(len(k) for k in kinds)), -1, np.int64)
    for i, k in enumerate(kinds):
        found[i, found.shape[1] - len(k) :] = k
    return found


def transfer(kinds: list[np.ndarray]) -> np.ndarray:
    """For each chunk the four vectors before it (m x state behind x state before), each from one state behind it alone."""
    found = np.zeros((len(kinds), 4, 4), np.int64)
    for own in groups(np.array([len(k) for k in kinds])):
        table = padded([kinds[i] for i in own])
        vectors = np.where(np.eye(4, dtype=bool), np.int64(0), FAR)[None].repeat(len(own), 0)
        for t in range(table.shape[1] - 1, -1, -1):
            here = np.flatnonzero(table[:, t] >= 0)
            vectors[here] = np.minimum(back(table[here, t], vectors[here]), FAR)
        found[own] = vectors
    return found


def through(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Vectors before chunks (m x 4) from those behind them."""
    return np.minimum((matrix + vector[:, :, None]).min(1), FAR)


def level(vectors: np.ndarray) -> np.ndarray:
    return vectors - vectors.min(-1, keepdims=True)


def converged(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the speculative vectors of a chunk differ by constants alone, and their common form."""
    ends = np.where(np.eye(4, dtype=bool), 0, SPREAD)
    found = level(np.stack([through(matrix, np.broadcast_to(e, (len(matrix), 4))) for e in ends], 1))
    return (found == found[:, :1]).all((1, 2)), found[:, 0]


def trace(kinds: list[np.ndarray], after: np.ndarray, start: np.ndarray, last: np.ndarray) -> list[tuple[str, int, int]]:
    """``(letters, cost, end state)`` of each chunk, from its start state and the cost vector behind it.

    A chunk that is the last of its conversation ends with the insertions it needs.
    """
    found: list = [None] * len(kinds)
    for own in groups(np.array([len(k) for k in kinds])):
        table = padded([kinds[i] for i in own])
        width = table.shape[1]
        costs = np.zeros((width + 1, len(own), 4), np.int64)
        costs[width] = after[own]
        for t in range(width - 1, -1, -1):
            costs[t] = costs[t + 1]
            here = np.flatnonzero(table[:, t] >= 0)
            costs[t, here] = back(table[here, t], costs[t + 1, here])
        state, spent = start[own].copy(), np.zeros(len(own), np.int64)
        letters = np.zeros((len(own), 3 * width), np.uint8)  # two insertions at most before a row
        for t in range(width):
            open_rows = np.flatnonzero(table[:, t] >= 0)
            for turn in range(3):
                s, kind, now = state[open_rows], table[open_rows, t], costs[t, open_rows]
                line = np.arange(len(open_rows))
                best, next_costs = now[line, s], costs[t + 1, open_rows]
                options = (
                    ("D", np.full(len(s), COST["D"]), s, next_costs),
                    ("I", np.full(len(s), COST["I"]), ASKED[s], now),
                    ("K", KEEP[kind, s], KEEP_TO[kind, s], next_costs),
                    ("R", ROLE[kind, s], ROLE_TO[kind, s], next_costs),
                )
                free = np.ones(len(s), bool)
                for letter, cost, to, rest in options:
                    chosen = np.flatnonzero(free & (cost + rest[line, to] == best))
                    free[chosen] = False
                    rows = open_rows[chosen]
                    letters[rows, 3 * t + turn] = ord(letter)
                    state[rows], spent[rows] = to[chosen], spent[rows] + cost[chosen]
                    if letter == "I":
                        again = rows
                open_rows = again
                if not len(open_rows):
                    break
        for i, place in enumerate(own):
            text = letters[i][letters[i] > 0].tobytes().decode()
            while last[place] and state[i] in (SYSTEM, USER):
                text, spent[i], state[i] = text + "I", spent[i] + COST["I"], ASKED[state[i]]
            found[place] = text, int(spent[i]), int(state[i])
    return found


# rows and chunks ----------------------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: ``conv_id, turn, role, text, copy``."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), (F.crc32(key) % 20).alias("hit"))
    kind = F.col("hit")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def described(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with a row number, the digest of role and text, and blank and truncated marks."""
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    return rows.select(
        "conv_id", "turn", "role", "text",
        F.monotonically_increasing_id().alias("row"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"),
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


PACKED = "conv_id long, chunk long, kinds binary, rows array<long>, first int, last int, blank long, duplicate long, truncated long, illegal long, matrix array<long>"


def pack(part: pa.RecordBatch, number: int, size: int) -> pa.RecordBatch:
    """One row for each chunk of a batch of sorted rows ``(conv_id, row, initial, fault)``; ``number`` orders batches."""
    ids = part.column(0)
    empty, value = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    n = part.num_rows
    new = np.ones(n, bool)
    new[1:] = (value[1:] != value[:-1]) | (empty[1:] != empty[:-1])
    run = np.flatnonzero(new)
    inside = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    cut = np.append(np.flatnonzero(inside % size == 0), n)
    classes = part.column(2).to_numpy().astype(np.int64)
    fault = part.column(3).to_numpy().astype(np.int64)
    kinds = classes * 3 + np.where(fault == TRUNCATED, 1, np.where(fault == NONE, 0, FORCED))
    wrong = np.zeros(n, np.int64)
    wrong[1:] = ~LEGAL[classes[:-1], classes[1:]]
    wrong[cut[:-1]] = 0  # between chunks: counted when they are stitched
    sums = lambda x: pa.array(np.add.reduceat(x.astype(np.int64), cut[:-1]))
    own = [kinds[a:b] for a, b in zip(cut[:-1], cut[1:])]
    matrix = transfer(own).reshape(-1)
    chunk = (np.int64(number) << np.int64(20)) + np.arange(len(own))
    columns = [
        ids.take(pa.array(cut[:-1])), pa.array(chunk), pa.array([k.astype(np.uint8).tobytes() for k in own], pa.binary()),
        pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), part.column(1)),
        pa.array(classes[cut[:-1]].astype(np.int32)), pa.array(classes[cut[1:] - 1].astype(np.int32)),
        sums(fault == BLANK), sums(fault == DUPLICATE), sums(fault == TRUNCATED), sums(wrong),
        pa.ListArray.from_arrays(pa.array(np.arange(0, len(matrix) + 1, 16, np.int32)), pa.array(matrix)),
    ]
    names = [x.split()[0] for x in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names=names)


def chunks_of(rows: DataFrame, size: int) -> DataFrame:
    """One row for each chunk; ``chunk`` rises along every conversation."""
    firsts = rows.where("not blank").groupBy("conv_id", "digest").agg(F.min(F.struct("turn", "row")).alias("at")).select("at.row", F.lit(True).alias("first"))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(NONE)
    order = ["conv_id", "turn", "role", "digest", "row"]
    narrow = rows.select(*order, "blank", "truncated").join(firsts, "row", "left")
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "row", initial.cast("int").alias("initial"), fault.cast("int").alias("fault"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            if batch.num_rows:
                yield pack(batch, number, size)
                number += 1

    return sorted_rows.mapInArrow(packed, PACKED)


# stitching: only conversations of several chunks ---------------------------------------------------------------------


def lists(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a table; null counts as zeros."""
    found = np.zeros((len(column), width), np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    if there.any():
        found[there] = column.drop_null().flatten().to_numpy().reshape(-1, width)
    return found


def column_of(part: pa.RecordBatch, name: str) -> pa.Array:
    return part.column(part.schema.get_field_index(name))


def as_lists(values: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(values.reshape(len(values), -1))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, max(1, flat.shape[1]), np.int32)[: len(values) + 1]), pa.array(flat.ravel()))


VECTORS = "chunk long, next long, matrix array<long>, known boolean, vector array<long>"


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over ``VECTORS`` rows with their successor's ``to_next, to_matrix, to_known, to_vector`` (null behind the last chunk)."""
    for part in batches:
        if not part.num_rows:
            continue
        matrix, vector = lists(column_of(part, "matrix"), 16).reshape(-1, 4, 4), lists(column_of(part, "vector"), 4)
        known = column_of(part, "known").to_numpy(zero_copy_only=False).astype(bool)
        following, follower = column_of(part, "next"), column_of(part, "to_next")
        ended = following.is_null().to_numpy(zero_copy_only=False)
        ready = column_of(part, "to_known").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        behind = np.where(ended[:, None], FINAL, lists(column_of(part, "to_vector"), 4))
        solved = ~known & (ended | ready)
        vector[solved] = level(through(matrix, behind))[solved]
        joined = ~known & ~solved & column_of(part, "to_matrix").is_valid().to_numpy(zero_copy_only=False)
        after = lists(column_of(part, "to_matrix"), 16).reshape(-1, 4, 4)
        if joined.any():
            matrix[joined] = np.stack([through(matrix[joined], after[joined][:, k]) for k in range(4)], 1)
        onward = np.where(joined, follower.fill_null(-1).to_numpy(), following.fill_null(-1).to_numpy())
        alike, form = converged(matrix)
        done = alike & ~known & ~solved
        vector[done] = form[done]
        known = known | solved | done
        yield pa.RecordBatch.from_arrays(
            [column_of(part, "chunk"), pa.array(onward, mask=onward < 0), as_lists(matrix), pa.array(known), as_lists(vector)], names=["chunk", "next", "matrix", "known", "vector"]
        )


STATES = "chunk long, prev long, map array<long>, known boolean, state long"


def settle_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same forwards: ``map`` leads from the start state of ``prev`` to that of ``chunk``."""
    for part in batches:
        if not part.num_rows:
            continue
        maps, before = lists(column_of(part, "map"), 4), lists(column_of(part, "to_map"), 4)
        known = column_of(part, "known").to_numpy(zero_copy_only=False).astype(bool)
        state = column_of(part, "state").fill_null(0).to_numpy().astype(np.int64)
        previous, earlier = column_of(part, "prev"), column_of(part, "to_prev")
        ready = column_of(part, "to_known").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        known_before = column_of(part, "to_state").fill_null(0).to_numpy().astype(np.int64)
        line = np.arange(len(state))
        solved = ~known & ready
        state[solved] = maps[line, known_before][solved]
        joined = ~known & ~solved & column_of(part, "to_map").is_valid().to_numpy(zero_copy_only=False)
        maps[joined] = np.take_along_axis(maps, before, 1)[joined]
        onward = np.where(joined, earlier.fill_null(-1).to_numpy(), previous.fill_null(-1).to_numpy())
        done = ~known & ~solved & (maps == maps[:, :1]).all(1)
        state[done] = maps[done, 0]
        yield pa.RecordBatch.from_arrays(
            [column_of(part, "chunk"), pa.array(onward, mask=onward < 0), as_lists(maps), pa.array(known | solved | done), pa.array(state)], names=["chunk", "prev", "map", "known", "state"]
        )


def passes(table: DataFrame, link: str, names: list[str], settle_pass, schema: str, folder: str, label: str) -> DataFrame:
    """Join every open chunk with the one it points to, until none is open; the reach doubles each time."""
    number = 0
    while True:
        target = table.select(F.col("chunk").alias(f"_{link}"), *[F.col(n).alias(f"to_{n}") for n in names])
        joined = table.join(target, F.col(link) == F.col(f"_{link}"), "left").drop(f"_{link}")
        table = kit.written(joined.mapInArrow(settle_pass, schema), folder, f"{label}{number}")
        number += 1
        if table.where("not known").isEmpty():
            return table


def stitched(chunks: DataFrame, folder: str) -> DataFrame | None:
    """``(chunk, after, start, last, between)`` for the chunks of conversations that have several; None without any."""
    shared = chunks.groupBy("conv_id").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("low < high").select(F.col("conv_id").alias("_id"))
    line = Window.partitionBy("conv_id").orderBy("chunk")  # one narrow row for up to CHUNK rows
    several = chunks.join(shared, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id", "rows").select(
        "chunk", "kinds", "matrix", F.lead("chunk").over(line).alias("next"), F.lag("chunk").over(line).alias("prev"), "last", F.lead("first").over(line).alias("next_first")
    )
    several = kit.written(several, folder, "several")
    if several.isEmpty():
        return None
    unknown = F.lit(False).alias("known")
    vectors = several.select("chunk", "next", "matrix", unknown, F.lit(None).cast("array<long>").alias("vector"))
    vectors = passes(vectors, "next", ["next", "matrix", "known", "vector"], settle, VECTORS, folder, "vectors")
    after = several.drop("matrix").join(vectors.select(F.col("chunk").alias("_c"), F.col("vector").alias("after")), F.col("next") == F.col("_c"), "left").drop("_c")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            kinds = [np.frombuffer(x, np.uint8).astype(np.int64) for x in column_of(part, "kinds").to_pylist()]
            if not kinds:
                continue
            ended = column_of(part, "next").is_null().to_numpy(zero_copy_only=False)
            behind = np.where(ended[:, None], FINAL, lists(column_of(part, "after"), 4))
            ends = [[x[2] for x in trace(kinds, behind, np.full(len(kinds), s), np.zeros(len(kinds), bool))] for s in range(4)]
            wrong = ~LEGAL[column_of(part, "last").to_numpy(), column_of(part, "next_first").fill_null(0).to_numpy()] & ~ended
            yield pa.RecordBatch.from_arrays(
                [column_of(part, "chunk"), column_of(part, "next"), column_of(part, "prev"), as_lists(behind), pa.array(ended), as_lists(np.array(ends, np.int64).T), pa.array(wrong.astype(np.int64))],
                names=["chunk", "next", "prev", "after", "ended", "ends", "between"],
            )

    maps = kit.written(after.mapInArrow(mapped, "chunk long, next long, prev long, after array<long>, ended boolean, ends array<long>, between long"), folder, "maps")
    origin = maps.select(F.col("next").alias("chunk"), F.col("ends").alias("map")).where("chunk is not null")
    states = maps.select("chunk", "prev").join(origin, "chunk", "left").select(
        "chunk", "prev", "map", F.col("prev").isNull().alias("known"), F.lit(START).cast("long").alias("state")
    )
    states = passes(states, "prev", ["prev", "map", "known", "state"], settle_states, STATES, folder, "states")
    return maps.join(states.select("chunk", F.col("state").alias("start")), "chunk").select("chunk", "after", "start", "ended", "between")


# results ------------------------------------------------------------------------------------------------------------

TRACED = "conv_id long, chunk long, audit string, cost long, line_rows array<long>, line_roles array<int>"


def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each chunk, and its repaired lines: row (null if inserted) and new role (null if kept)."""
    for part in batches:
        if not part.num_rows:
            continue
        kinds = [np.frombuffer(x, np.uint8).astype(np.int64) for x in column_of(part, "kinds").to_pylist()]
        alone = column_of(part, "after").is_null().to_numpy(zero_copy_only=False)
        after = np.where(alone[:, None], FINAL, lists(column_of(part, "after"), 4))
        last = column_of(part, "ended").fill_null(True).to_numpy(zero_copy_only=False).astype(bool)
        start = column_of(part, "start").fill_null(START).to_numpy().astype(np.int64)
        found = trace(kinds, after, start, last)
        rows, roles = [], []
        for (letters, _, _), own, state, kind in zip(found, column_of(part, "rows").to_pylist(), start.tolist(), kinds):
            t, out_rows, out_roles = 0, [], []
            for letter in letters:
                to = state if letter == "D" else int(KEEP_TO[kind[t], state]) if letter == "K" else int(ASKED[state])
                if letter != "D":
                    out_rows.append(None if letter == "I" else own[t])
                    out_roles.append(None if letter == "K" else to)
                t, state = t + (letter != "I"), to
            rows.append(out_rows)
            roles.append(out_roles)
        yield pa.RecordBatch.from_arrays(
            [
                column_of(part, "conv_id"), column_of(part, "chunk"), pa.array([x[0] for x in found]), pa.array([x[1] for x in found], pa.int64()),
                pa.array(rows, pa.list_(pa.int64())), pa.array(roles, pa.list_(pa.int32())),
            ],
            names=["conv_id", "chunk", "audit", "cost", "line_rows", "line_roles"],
        )


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, from rows (conv_id, line) that stand together and in order."""
    current, state = None, None

    def result(ids: list, sums: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.string())], names=["conv_id", "sha"])

    for batch in batches:
        ids, sums = [], []
        for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if state is None or conv != current:
                if state is not None:
                    ids.append(current)
                    sums.append(state.hexdigest())
                current, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode())
        yield result(ids, sums)
    if state is not None:
        yield result([current], [state.hexdigest()])


def repair(conversations: DataFrame, rows: DataFrame, size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Faults and edits of each conversation, and the repaired lines ``(conv_id, chunk, place, role, text)``.

    ``conversations(conv_id)`` names all that shall have a result, ``rows(conv_id, turn, role, text)`` are the turns to repair. ``size``: rows of a chunk, at most.
    """
    folder = kit.scratch(rows.sparkSession)
    rows = kit.written(described(rows), folder, "rows")  # row numbers are fixed from here on
    chunks = kit.written(chunks_of(rows, size), folder, "chunks")
    known = stitched(chunks, folder)
    if known is None:
        ready = chunks.select("*", F.lit(None).cast("array<long>").alias("after"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("boolean").alias("ended"), F.lit(0).cast("long").alias("between"))
    else:
        ready = kit.written(chunks.join(known, "chunk", "left"), folder, "ready")
    done = kit.written(ready.mapInArrow(traced, TRACED), folder, "traced")

    lines = done.select("conv_id", "chunk", F.posexplode(F.arrays_zip("line_rows", "line_roles")).alias("place", "x"))
    lines = lines.select("conv_id", "chunk", "place", F.col("x.line_rows").alias("row"), F.when(F.col("x.line_roles") == USER, "user").when(F.col("x.line_roles") == ASSISTANT, "assistant").alias("new"))
    stay = lines.where("row is not null").join(rows.select("row", "role", "text"), "row").select("conv_id", "chunk", "place", F.coalesce("new", "role").alias("role"), "text")
    repaired = stay.unionByName(lines.where("row is null").select("conv_id", "chunk", "place", F.col("new").alias("role"), F.lit("").alias("text")))
    sums = repaired.select("conv_id", "chunk", "place", F.concat("role", F.lit(":"), "text").alias("line")).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
    sums = sums.select("conv_id", "line").mapInArrow(hashed, "conv_id long, sha string")

    span = rows.groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("kinds"))
    parts = {
        "gaps": span.select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("kinds"), F.lit(0)).alias("gaps")),
        "counts": ready.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce("between", F.lit(0))).alias("illegal")),
        "edits": done.select("conv_id", "cost", F.struct("chunk", "audit").alias("audit")),
        "sums": sums,
    }
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in parts.values():
        every = every.unionByName(part, allowMissingColumns=True)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)
    letters = F.array_join(F.transform(F.sort_array(F.collect_list("audit")), lambda x: x["audit"]), "")
    found = every.groupBy("conv_id").agg(
        *[total(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        letters.alias("audit"),
        F.coalesce(F.max("sha"), F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )
    return found, repaired


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = kit.tables(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(talk, damage(talk).drop("copy"))[0]


QUERIES = {"op11_dialogue_repair": op11_dialogue_repair}
ORACLE_SQL: dict[str, str] = {}
