"""Registry of the query catalogue: name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | None
    ids: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, ids)
        return fn
    return deco
