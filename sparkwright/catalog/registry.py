"""Name -> (query builder, oracle SQL) registry used by ``__spark_entry__``.

A query builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables.  The oracle is the same computation as plain SQL over the
pre-registered views; ``None`` marks a query that has no SQL form (the
driver then checks row counts only).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    covers: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None, covers: str = ""):
    """Register ``fn`` under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(covers.split()))
        return fn

    return deco
