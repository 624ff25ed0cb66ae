"""Registered queries over the driver tables, each with its SQL equivalent where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("phrases", "columns", "repeats", "store", "frontier", "loading", "files", "scoring", "streams", "walks")


def _load(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"textmill.catalog.{name}"), attribute)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        found.update(part)
    return found


def queries() -> dict[str, Query]:
    return _load("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _load("ORACLE")
