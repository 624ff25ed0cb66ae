"""Compression of text columns in Arrow batches."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODECS = ("zlib", "zstd", "gz", "lz4")


def _lz4_decode(data: bytes) -> bytes:
    with pa.CompressedInputStream(pa.BufferReader(data), "lz4") as stream:
        return stream.read()


def _lz4_encode(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as stream:
        stream.write(data)
    return sink.getvalue().to_pybytes()


def _encoder(algo: str, level: int) -> Callable[[bytes], bytes]:
    if algo == "zlib":
        return lambda b: zlib.compress(b, level)
    if algo == "gz":
        return lambda b: gzip.compress(b, level, mtime=0)
    if algo == "zstd":
        return zstandard.ZstdCompressor(level=level).compress
    return _lz4_encode


def _decoder(algo: str) -> Callable[[bytes], bytes]:
    if algo == "zlib":
        return zlib.decompress
    if algo == "gz":
        return gzip.decompress
    if algo == "zstd":
        # A reader also takes frames that do not state their content size.
        return lambda b: zstandard.ZstdDecompressor().stream_reader(b).read()
    if algo == "lz4":
        return _lz4_decode
    raise ValueError(f"unknown compression {algo!r}: use one of {CODECS}")


def compress(text: Column, level: int = 6, algo: str = "zlib") -> Column:
    """UTF-8 bytes of the text, compressed. Level 0 leaves them as they are."""
    if algo not in CODECS:
        raise ValueError(f"unknown compression {algo!r}: use one of {CODECS}")
    if level == 0:
        return F.encode(text, "UTF-8")

    @F.pandas_udf(T.BinaryType())
    def run(batch: pd.Series) -> pd.Series:
        encode = _encoder(algo, level)
        return batch.map(lambda s: encode(s.encode("utf-8")), na_action="ignore")

    return run(text)


@F.pandas_udf(T.BinaryType())
def _decompress(data: pd.Series, algo: pd.Series) -> pd.Series:
    decoders: dict[str, Callable[[bytes], bytes]] = {}
    out = []
    for blob, name in zip(data, algo):
        if blob is None:
            out.append(None)
            continue
        if name not in decoders:
            decoders[name] = _decoder(name)
        out.append(decoders[name](bytes(blob)))
    return pd.Series(out, dtype=object)


def decompress(data: Column, algo: Column | str = "zlib", level: int | None = None) -> Column:
    """Text of compressed bytes. A NULL codec means zlib; ``level=0`` says they are plain."""
    if level == 0:
        return F.decode(data, "UTF-8")
    name = F.lit(algo) if isinstance(algo, str) else algo
    return F.decode(_decompress(data, F.coalesce(name, F.lit("zlib"))), "UTF-8")


@F.pandas_udf(T.StringType())
def decode_lossy(content: pd.Series) -> pd.Series:
    """UTF-8 text of bytes: bad bytes dropped, line ends turned into newlines."""
    return content.map(
        lambda b: bytes(b).decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n"),
        na_action="ignore",
    )


def register(spark) -> None:
    """SQL names: ``tm_compress(text)``, ``tm_decompress(data, algo)``."""

    @F.pandas_udf(T.BinaryType())
    def tm_compress(batch: pd.Series) -> pd.Series:
        return batch.map(lambda s: zlib.compress(s.encode("utf-8"), 6), na_action="ignore")

    @F.pandas_udf(T.StringType())
    def tm_decompress(data: pd.Series, algo: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if blob is None else _decoder(name or "zlib")(bytes(blob)).decode("utf-8")
                for blob, name in zip(data, algo)
            ],
            dtype=object,
        )

    spark.udf.register("tm_compress", tm_compress)
    spark.udf.register("tm_decompress", tm_decompress)
