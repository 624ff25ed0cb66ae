"""Streams whose state ends: first-seen lines that are forgotten after a time, responses that are evicted once told.

Both keep their state in a disk store (``with_disk_state``), so it may be larger than an executor's memory, and drop
every entry after a stated time, so it follows the rate of the stream and not its age.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, ValueState

from textmill.functions.text import token_count

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Groups of lines, or of responses, by hash: a group's call handles all its rows of a batch.
GROUPS = 256


class with_disk_state:  # noqa: N801 - used as a context
    """Start queries with the disk state store; the session's own settings come back afterwards.

    ``drain``: for queries that shall end once their input is read. Timers then fire in batches that bring rows; otherwise a
    query with timers runs empty batches for them, and never ends by itself.
    """

    def __init__(self, spark: SparkSession, drain: bool = True) -> None:
        self.spark = spark
        self.settings = {PROVIDER: DISK_STORE} | ({EMPTY_BATCHES: "false"} if drain else {})

    def __enter__(self) -> None:
        self.before = {name: self.spark.conf.get(name, None) for name in self.settings}
        for name, value in self.settings.items():
            self.spark.conf.set(name, value)

    def __exit__(self, *_: object) -> None:
        for name, value in self.before.items():
            if value is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, value)


class FirstSeenLines(StatefulProcessor):
    """Passes a digest on when it is not held; each is held for ``keep_ms`` after it was passed on."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "digest binary", "there boolean", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame.drop_duplicates("digest")
            new = [not self.seen.containsKey((d,)) for d in frame["digest"]]
            for d in frame["digest"][new]:
                self.seen.updateValue((d,), (True,))
            yield frame.loc[new, ["line"]]

    def close(self) -> None:
        pass


def first_seen_for(lines: DataFrame, keep_ms: int, line: str = "line") -> DataFrame:
    """``(line)``: each line once, and again when it comes back ``keep_ms`` or more after it was last passed on.

    State holds a digest for each line of the last ``keep_ms``. Lines are grouped by hash; a line's copies in one batch collapse there.
    """
    keyed = lines.select(
        F.pmod(F.xxhash64(line), F.lit(GROUPS)).cast("int").alias("part"), F.unhex(F.md5(F.col(line))).alias("digest"), F.col(line).alias("line")
    )
    found = keyed.groupBy("part").transformWithStateInPandas(FirstSeenLines(keep_ms), "line string", "Append", "ProcessingTime")
    return found.select(F.col("line").alias(line))


OPEN = pa.schema({"response_id": pa.int64(), "seq": pa.int64(), "delta": pa.string(), "size": pa.int64(), "since": pa.int64()})
TOLD = pa.schema({"response_id": pa.int64(), "at": pa.int64()})


def _get(state: ValueState, schema: pa.Schema) -> pd.DataFrame:
    found = state.get() if state.exists() else None
    return (pa.ipc.open_stream(bytes(found[0])).read_all() if found else schema.empty_table()).to_pandas()


def _put(state: ValueState, rows: pd.DataFrame, schema: pa.Schema) -> None:
    if rows.empty:
        state.clear()
        return
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(pa.Table.from_pandas(rows, schema, preserve_index=False))
    state.update((sink.getvalue().to_pybytes(),))


class Responses(StatefulProcessor):
    """Collects the pieces of the responses of one part until their last one is there or ``limit_ms`` have passed.

    The pieces of all open responses are one value, an Arrow table, and so are the ids of those that were told in the last ``limit_ms``.
    A batch reads and writes each once, not piece by piece or response by response.
    """

    def __init__(self, limit_ms: int) -> None:
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "pieces binary")  # ended by timers
        self.told = handle.getValueState("told", "ids binary", self.limit_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        held, told, now = _get(self.open, OPEN), _get(self.told, TOLD), timerValues.getCurrentProcessingTimeInMs()
        told = told[told["at"] + self.limit_ms > now]
        new = pd.concat(list(rows), ignore_index=True).astype({"response_id": "int64", "seq": "int64"})
        new = new[~new["response_id"].isin(told["response_id"])]  # late pieces of responses that were told
        if new.empty:
            return
        size = np.where(new["last"].astype(bool), new["seq"] + 1, -1)
        new = new.assign(size=size, since=now)[OPEN.names]
        pieces = pd.concat([held, new], ignore_index=True) if len(held) else new.reset_index(drop=True)
        number, ids = pd.factorize(pieces["response_id"])
        sizes, since = np.full(len(ids), -1), np.zeros(len(ids), np.int64)
        ends = pieces["size"].to_numpy() >= 0
        sizes[number[ends]] = pieces["size"].to_numpy()[ends]  # of several ends the last to come
        since[number[::-1]] = pieces["since"].to_numpy()[::-1]  # of the first piece
        first = ~pieces.duplicated(["response_id", "seq"]).to_numpy()
        pieces, number = pieces.assign(size=sizes[number], since=since[number])[first], number[first]
        whole = (np.bincount(number, minlength=len(ids)) == sizes)[number]
        if whole.any():
            yield self.tell(pieces[whole], True, told, now).assign(part=key[0])
        pieces = pieces[~whole]
        _put(self.open, pieces, OPEN)
        wanted, there = {int(t) + self.limit_ms for t in pieces["since"].unique()}, set(self.handle.listTimers())
        for at in wanted - there:
            self.handle.registerTimer(at)
        for at in there - wanted:
            self.handle.deleteTimer(at)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        held, now = _get(self.open, OPEN), timerValues.getCurrentProcessingTimeInMs()
        over = held["since"] + self.limit_ms <= expiredTimerInfo.getExpiryTimeInMs()
        if over.any():
            told = _get(self.told, TOLD)
            yield self.tell(held[over], False, told[told["at"] + self.limit_ms > now], now).assign(part=key[0])
            _put(self.open, held[~over], OPEN)

    def tell(self, pieces: pd.DataFrame, complete: bool, told: pd.DataFrame, now: int) -> pd.DataFrame:
        texts: dict[int, list[str]] = {}
        ordered = pieces.sort_values(["response_id", "seq"])
        for i, delta in zip(ordered["response_id"].tolist(), ordered["delta"].tolist()):
            texts.setdefault(i, []).append("" if delta is None or delta != delta else delta)
        _put(self.told, pd.DataFrame({"response_id": [*told["response_id"], *texts], "at": [*told["at"], *[now] * len(texts)]}), TOLD)
        return pd.DataFrame({"response_id": list(texts), "text": ["".join(t) for t in texts.values()], "complete": complete})

    def close(self) -> None:
        pass


def assemble_responses(pieces: DataFrame, limit_ms: int) -> DataFrame:
    """``(response_id, text, tok, complete)``, each response once, in append mode.

    ``pieces`` has ``response_id, seq, delta, last``: ``seq`` counts from 0, ``last`` marks the end, a NULL delta adds nothing. A response is
    told when all pieces up to its last one are there, in any order, or ``limit_ms`` after its first piece came, with ``complete``
    false; its pieces are dropped then. Repeated pieces count once. Pieces that come within ``limit_ms`` after it was told are ignored.
    Responses are handled together by hash; those without an id are one response, in a part of its own.
    """
    part = F.when(F.col("response_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("response_id"), F.lit(GROUPS)).cast("int"))
    rows = pieces.select(
        part.alias("part"), F.coalesce("response_id", F.lit(0)).cast("long").alias("response_id"), F.col("seq").cast("long").alias("seq"), "delta",
        F.coalesce("last", F.lit(False)).alias("last"),
    )
    found = rows.groupBy("part").transformWithStateInPandas(
        Responses(limit_ms), "part int, response_id long, text string, complete boolean", "Append", "ProcessingTime"
    )
    named = found.select(F.when(F.col("part") >= 0, F.col("response_id")).alias("response_id"), "text", "complete")
    return named.withColumn("tok", token_count(F.col("text")))
