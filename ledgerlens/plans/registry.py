"""Query registry: each named query pairs a Spark builder with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``. ``sql`` is optional: queries
whose result cannot be written as SQL (model fits, random draws) register
without one and are checked by property tests instead.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.stats import fround

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

PLAN_MODULES = (
    "ledgerlens.plans.rollups",
    "ledgerlens.plans.profiling",
    "ledgerlens.plans.features",
    "ledgerlens.plans.cleaning",
    "ledgerlens.plans.splits",
    "ledgerlens.plans.evaluation",
    "ledgerlens.plans.monitoring",
    "ledgerlens.plans.scalars",
    "ledgerlens.plans.balancing",
    "ledgerlens.plans.modeling",
    "ledgerlens.plans.scoring",
    "ledgerlens.plans.linear",
    "ledgerlens.plans.persistence",
    "ledgerlens.plans.streams",
)


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def round_doubles(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round every double column (comparison-friendly output)."""
    return df.select(*[
        fround(F.col(f.name), scale).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])
