"""Every query of the core by name, with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlens.plans import near, relational, scalars, walks

MODULES = (near, scalars, relational, walks)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalars.q_category_stats(spark, sf_dir)
