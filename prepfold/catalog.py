"""Registry of the checked queries.

Each entry runs library operators over the driver tables (the stand-ins of
FIXTURES.md section 3) and may carry the equivalent DuckDB SQL. Float outputs
that two engines can compute with different last bits (sums, logs,
correlations) are rounded half-up with plain IEEE operations on both sides
(``half_up`` / ``hu``). Dates and arrays are rendered as text on both
sides (ISO ``YYYY-MM-DD`` and JSON, which both engines print identically), so
the comparison does not depend on how a client library maps those types;
everything else is compared as is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .sources.parquet import load_table

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    headline: bool


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, headline)
        return fn
    return deco


def hu(expr: str, digits: int) -> str:
    """SQL twin of ``functions.scalar.half_up``."""
    return f"(floor(({expr}) * {float(10 ** digits)!r} + 0.5) / {float(10 ** digits)!r})"


class Tables:
    """Lazy access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load_table(self.spark, self.base_dir, name)
