"""Loading lines and files into a store, and keeping files by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions.codec import compress
from textmill.functions.filetype import is_text_nul
from textmill.operators.dedupe import dedupe_bloom, dedupe_exact, dedupe_md5
from textmill.operators.ledger import Ledger
from textmill.operators.store import ARCHIVE, archive_rows, filter_min_tokens, insert_or_ignore, running_tokens
from textmill.plans import materialize, spread
from textmill.sources.tables import read_if_there


def line_rows(lines: DataFrame, line: str = "line", order: str = "seq", tokens: str = "whitespace") -> DataFrame:
    """``(order, word, data, tok)`` of the stripped, distinct lines."""
    return archive_rows(spread(lines.select(order, tx.strip(F.col(line)).alias(line))), line, order, tokens)


def ingest_lines(
    lines: DataFrame, store: DataFrame, line: str = "line", order: str = "seq", tokens: str = "whitespace"
) -> DataFrame:
    """Rows to add for stripped, distinct lines: ``(order, word, data, tok)``."""
    ready = materialize(line_rows(lines, line, order, tokens), "lines")  # compress once
    return insert_or_ignore(store, ready, ["data"], order, long_keys=True)


def load_lines(lines: DataFrame, ledger: Ledger, run: str, line: str = "line", order: str = "seq", tokens: str = "whitespace") -> bool:
    """Commit the new lines to a ledger; only the touched part of its index is read."""
    return ledger.commit(run, texts=line_rows(lines, line, order, tokens), order=order)


def file_rows(
    files: DataFrame,
    literals: Sequence[str] = (),
    minimum: int = 20,
    order: str = "path",
    tokens: str = "whitespace",
    bloom: dict | None = None,
    keep_newline: bool = True,
) -> DataFrame:
    """``(order, word, data, tok)`` of whole files. Repeats and tokens are judged before cleaning."""
    raw = dedupe_bloom(files, "text", order, **bloom) if bloom is not None else dedupe_exact(files, "text", order)
    counted = filter_min_tokens(spread(raw).withColumn("tok", tx.token_count(F.col("text"), tokens)), minimum)
    cleaned = tx.remove_literals(F.col("text"), literals, keep_newline)
    return counted.select(order, F.lit(ARCHIVE).alias("word"), compress(cleaned, 9).alias("data"), "tok")


def ingest_files(files: DataFrame, store: DataFrame, literals: Sequence[str] = (), minimum: int = 20, order: str = "path", **options) -> DataFrame:
    """Rows to add for whole files; ``options`` as for ``file_rows``."""
    ready = file_rows(files, literals, minimum, order, **options)
    return insert_or_ignore(store, materialize(ready, "files"), ["data"], order, long_keys=True)


def load_files(files: DataFrame, ledger: Ledger, run: str, literals: Sequence[str] = (), minimum: int = 20, order: str = "path", **options) -> bool:
    """Commit the new files to a ledger; ``options`` as for ``file_rows``."""
    return ledger.commit(run, texts=file_rows(files, literals, minimum, order, **options), order=order)


def count_tokens(files: DataFrame, order: str = "path", tokens: str = "whitespace") -> DataFrame:
    """``(order, tok, running_tokens)`` of each file; the last running total is the corpus total."""
    counted = spread(files.select(order, "text")).select(order, tx.token_count(F.col("text"), tokens).alias("tok"))
    return running_tokens(materialize(counted, "tokens"), order)


def content_addressed(files: DataFrame, existing: DataFrame | None = None, order: str = "path") -> DataFrame:
    """``(order, name, content)``: each text file once under ``<md5>.txt``, names taken are skipped."""
    texts = files.where(is_text_nul(F.col("content")))
    named = dedupe_md5(texts, "content", order).withColumn("name", F.concat(F.md5("content"), F.lit(".txt")))
    if existing is not None:
        named = named.join(existing.select("name"), "name", "left_anti")
    return named.select(order, "name", "content")


def write_content_addressed(files: DataFrame, path: str, order: str = "path") -> None:
    """Add new text files to the table of ``(name, content)`` at ``path``."""
    existing = read_if_there(files.sparkSession, path, "name string, content binary")
    added = content_addressed(files, existing, order).select("name", "content")
    added.write.mode("append").parquet(path)
