"""Registration of queries: a name, a plan and, where SQL can say the same, the check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewright.catalog.shapes import Tables, with_shapes
from tidewright.session import tune


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a plan; ``sql`` may name the shapes of `shapes.py` as if they were tables."""

    def register(plan: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(name, plan, None if sql is None else with_shapes(sql))
        return plan

    return register


def runner(item: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return item.plan(Tables(tune(spark), sf_dir))

    run.__name__ = item.name
    return run
