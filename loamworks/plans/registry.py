"""The table of registered queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamworks.sources.fixtures import Tables, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MADE: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables; ``sql`` is its DuckDB twin over the same fixtures."""

    def keep(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        assert name not in QUERIES, name
        MADE[name] = make, sql
        QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = with_fixtures(sql)
        return make

    return keep


class Thin(Tables):
    """The same tables, but the grid lacks cells here and there."""

    @property
    def cells(self) -> DataFrame:
        return self.thin


def on_thin_grid(*names: str) -> None:
    """Register queries on ``cells`` once more over the grid with absent cells, as ``<name>_thin``."""
    for name in names:
        make, sql = MADE[name]
        query(f"{name}_thin", re.sub(r"\bcells\b", "thin", sql) if sql else None)(lambda t, make=make: make(Thin(t.spark, t.sf_dir)))
