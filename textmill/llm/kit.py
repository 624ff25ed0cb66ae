"""Shared helpers of the subpackage: text batches as flat arrays, word hashes, scratch tables, label folds.

Texts reach the numpy kernels as one byte (or code point) array and a row of offsets, in slices of a
few megabytes, so a task's memory follows the slice and the longest single text, never the partition.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text bytes handled at once
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
POWERS: list[np.ndarray] = []


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; set to one below the warehouse only where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/textmill-llm/{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` below ``folder`` and read it back: what follows no longer depends on what made it."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder of this module (any file system Spark can reach)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep_only(spark: SparkSession, folder: str, names: tuple[str, ...]) -> None:
    """Delete all tables of a scratch folder but those named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def free_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with as many underscores behind it as it takes to clash with no column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return tuple(found)


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(id_column.cast("string")) % parts


def fold_of(value: int, parts: int) -> int:
    return zlib.crc32(str(value).encode()) % parts


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows holding at most ``limit`` text bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(np.diff(raw(batch.column(batch.schema.get_field_index(column)))[1]))
    start = 0
    while start < batch.num_rows:
        spent = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, spent + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return text[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finalising step of a splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the first ``n`` powers of the multiplier and of its inverse."""
    size = 1 << max(16, int(n).bit_length())
    if not POWERS or len(POWERS[0]) < size:
        POWERS[:] = [
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, m, np.uint64), dtype=np.uint64)])
            for m in (MULTIPLIER, INVERSE)
        ]
    return POWERS[0], POWERS[1]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``symbols`` (uint64), alike wherever the span stands."""
    up, down = powers(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[: len(symbols)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[LOWER]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are no ASCII white space, within its row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word, A-Z lower-cased."""
    return span_hashes(LOWER_VALUES[data], starts, ends)
