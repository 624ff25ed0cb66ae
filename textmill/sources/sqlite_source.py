"""Spark data source for existing SQLite stores: ``spark.read.format("texts_sqlite")``.

Options: ``path`` (a file, or a folder of ``*.db`` files, reachable by every executor),
``table`` (``texts``, ``prompts`` or ``prompt_responses``), ``rows`` (row numbers per partition).

Partitions are ranges of SQLite's row numbers, which every such store has; a store without ``id`` gives them as its ids. With the
option ``push`` (Spark then wants ``spark.sql.python.filterPushdown.enabled``) comparisons of ``id`` with a number reach SQLite, and partitions outside them are not made.
"""

from __future__ import annotations

import contextlib
import datetime
import glob
import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructType, TimestampType

from textmill import schemas

TABLES = {"texts": schemas.TEXTS, "prompts": schemas.PROMPTS, "prompt_responses": schemas.PROMPT_RESPONSES}
STORED = {"prompt_responses": "prompts"}  # the log with responses is kept under the same name
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class RowRange(InputPartition):
    def __init__(self, path: str, low: int, high: int) -> None:
        super().__init__((path, low, high))
        self.path, self.low, self.high = path, low, high


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{os.path.abspath(path)}?mode=ro", uri=True)


def _value(value, kind):
    if value is None:
        return None
    if isinstance(kind, BinaryType):
        return value.encode("utf-8") if isinstance(value, str) else bytes(value)
    if isinstance(kind, TimestampType):
        stamp = datetime.datetime.fromisoformat(str(value))
        return stamp if stamp.tzinfo else stamp.replace(tzinfo=datetime.timezone.utc)
    if isinstance(kind, (LongType, IntegerType)):
        return int(value)
    if isinstance(kind, StringType):
        return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)
    return value


class StoreReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.options = schema, options
        self.table = STORED.get(options["table"], options["table"])
        self.tests: list[tuple[str, int]] = []  # comparisons of the id

    def _files(self) -> list[str]:
        path = self.options["path"]
        return sorted(glob.glob(os.path.join(path, "*.db"))) if os.path.isdir(path) else [path]

    def _columns(self, db: sqlite3.Connection) -> dict[str, str]:
        """SQL of each column; a store without ids gives its row numbers."""
        there = {row[1] for row in db.execute(f"pragma table_info({self.table})")}
        return {f.name: f.name if f.name in there else "rowid" if f.name == "id" else f"null as {f.name}" for f in StoreSource.SCHEMAS[self.options["table"]]}

    def _where(self, columns: dict[str, str]) -> str:
        return " and ".join(["true", *[f"{columns['id']} {sign} {value}" for sign, value in self.tests]])

    def partitions(self) -> list[RowRange]:
        step = int(self.options.get("rows", 100_000))
        found = []
        for path in self._files():
            with contextlib.closing(_connect(path)) as db:
                where = self._where(self._columns(db))
                low, high = db.execute(f"select min(rowid), max(rowid) from {self.table} where {where}").fetchone()
            if low is not None:
                found += [RowRange(path, start, min(start + step - 1, high)) for start in range(low, high + 1, step)]
        return found

    def read(self, partition: RowRange) -> Iterator[tuple]:
        with contextlib.closing(_connect(partition.path)) as db:
            columns = self._columns(db)
            names = ", ".join(columns[f.name] for f in self.schema.fields)
            sql = f"select {names} from {self.table} where rowid between ? and ? and {self._where(columns)}"
            for row in db.execute(sql, (partition.low, partition.high)):
                yield tuple(_value(v, f.dataType) for v, f in zip(row, self.schema.fields))


class PushingReader(StoreReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for test in filters:
            sign = COMPARED.get(type(test))
            if sign and test.attribute == ("id",) and isinstance(test.value, int):
                self.tests.append((sign, test.value))
            else:
                yield test


class StoreSource(DataSource):
    SCHEMAS = TABLES

    @classmethod
    def name(cls) -> str:
        return "texts_sqlite"

    def schema(self) -> StructType:
        return TABLES[self._table()]

    def _table(self) -> str:
        table = self.options.get("table", "texts")
        if table not in TABLES:
            raise ValueError(f"unknown table {table!r}: use one of {sorted(TABLES)}")
        return table

    def reader(self, schema: StructType) -> StoreReader:
        kind = PushingReader if str(self.options.get("push", "")).lower() == "true" else StoreReader
        return kind(schema, {**dict(self.options), "table": self._table()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StoreSource)
