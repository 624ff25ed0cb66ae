"""Word n-grams as 64-bit hashes, in numpy, for whole slices of texts.

A word's hash depends on its bytes alone, an n-gram's on its words and their order, so equal n-grams are equal wherever they
stand. Two different ones that clash would be taken for equal: about one pair is expected among 6 * 10^9 different n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finalising step of a splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


def hash_words(words: pa.Array) -> np.ndarray:
    """Hash of each string."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.cast(pa.large_string())
    _, ends, data = words.buffers()
    offsets = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    lengths, starts = np.diff(offsets), offsets[:-1] - offsets[0]
    sums, solid = np.zeros(len(words), np.uint64), lengths > 0
    if solid.any():
        powers = np.cumprod(np.full(int(lengths.max()), MULTIPLIER), dtype=np.uint64)
        place = np.arange(offsets[-1] - offsets[0]) - np.repeat(starts, lengths)
        values = BYTE_VALUES[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] * powers[place]
        sums[solid] = np.add.reduceat(values, starts[solid])
    return mix(sums + lengths.astype(np.uint64))


class Words:
    """The words of a column of word arrays: ``words``, their hashes and their rows."""

    def __init__(self, column: pa.ChunkedArray | pa.Array) -> None:
        chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
        parts = [c.flatten().cast(pa.large_string()) for c in chunks]
        self.words = pa.concat_arrays(parts) if parts else pa.array([], pa.large_string())
        self.lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
        self.rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.hashes = hash_words(self.words)

    def grams(self, low: int, high: int, only: np.ndarray | None = None, beyond: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and number of words of every n-gram of ``low``..``high`` words; of more than ``beyond`` words in rows of ``only`` alone."""
        found, run = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))], self.hashes
        for n in range(1, high + 1):
            starts = len(self.hashes) - n + 1
            if starts < 1 or (only is not None and n > beyond and not only.any()):
                break
            if n > 1:
                run = mix(run[:starts] * MULTIPLIER + self.hashes[n - 1 :])
            if n < low:
                continue
            whole = self.rows[:starts] == self.rows[n - 1 :]
            if only is not None and n > beyond:
                whole &= only[self.rows[:starts]]
            at = np.flatnonzero(whole)
            found.append((run[at], at, np.full(len(at), n)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def spelt(self, at: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The n-grams that begin at the words ``at``, as text."""
        order, parts = [], []
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            columns = [self.words.take(pa.array(at[own] + k)) for k in range(n)]
            parts.append(columns[0] if n == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string())))
            order.append(own)
        if not parts:
            return pa.array([], pa.string())
        back = np.argsort(np.concatenate(order))
        return pa.concat_arrays(parts).take(pa.array(back)).cast(pa.string())


def pack(values: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones, and so on: bytes alike stand together for the codec. Led by their size."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising numbers by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def unpack_sorted(data: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)
