"""Bit positions of a Bloom filter, from SHA-256, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAMILIES = ("sliced", "chained", "salted")


def _hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def _low_bits(digest: Column, power2: int) -> Column:
    """The last ``power2`` (at most 56) bits of a 64-digit hex digest."""
    width = -(-power2 // 4)
    return _hex_to_long(F.substring(digest, 65 - width, width)).bitwiseAND((1 << power2) - 1)


def _sliced(digest: Column, power2: int, k: int) -> list[Column]:
    """Bits cut from one digest: position i drops ``(k-1-i) * (256 // k)`` low bits."""
    found = []
    for i in range(k):
        drop = (k - 1 - i) * (256 // k)
        skip, rest = divmod(drop, 4)
        width = min(-(-(power2 + rest) // 4), 64 - skip)
        value = _hex_to_long(F.substring(digest, 64 - skip - width + 1, width))
        found.append(F.shiftright(value, rest).bitwiseAND((1 << power2) - 1))
    return found


def _remainder(digest: Column, size: int) -> Column:
    """A 256-bit digest modulo ``size``, folded 32 bits at a time."""
    rest = F.lit(0).cast("long")
    for start in range(1, 65, 8):
        rest = (rest * F.lit(1 << 32) + _hex_to_long(F.substring(digest, start, 8))) % F.lit(size)
    return rest


def bloom_indexes(
    item: Column, power2: int = 27, k: int = 8, family: str = "sliced", size: int | None = None
) -> Column:
    """Array of ``k`` bit positions.

    ``sliced``: slices of one digest. ``chained``: digest of (digest bytes + counter), low bits.
    ``salted``: digest of (counter + item) modulo ``size`` (default ``2**power2``).
    """
    return F.array(*index_list(item, power2, k, family, size))


def index_list(
    item: Column, power2: int = 27, k: int = 8, family: str = "sliced", size: int | None = None
) -> list[Column]:
    if not 1 <= k <= 256:
        raise ValueError("k must be between 1 and 256")
    if family != "salted" or size is None:
        if not 1 <= power2 <= 56:
            raise ValueError("power2 must be between 1 and 56")
    if family == "sliced":
        return _sliced(F.sha2(item, 256), power2, k)
    if family == "chained":
        first = F.unhex(F.sha2(item, 256))
        return [
            _low_bits(F.sha2(F.concat(first, F.encode(F.lit(str(i)), "UTF-8")), 256), power2) for i in range(k)
        ]
    if family == "salted":
        digests = [F.sha2(F.concat(F.lit(str(i)), item), 256) for i in range(k)]
        if size is None or size & (size - 1) == 0:
            return [_low_bits(d, power2 if size is None else size.bit_length() - 1) for d in digests]
        if not 1 <= size < 1 << 31:
            raise ValueError("size must be below 2**31, or a power of two")
        return [_remainder(d, size) for d in digests]
    raise ValueError(f"unknown family {family!r}: use one of {FAMILIES}")
