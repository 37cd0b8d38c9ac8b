"""Caps, budgets, first-of-key and upserts as window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group; the order should end in a unique key.

    Spark prunes to k rows per group before the shuffle (WindowGroupLimit), so a hot group
    moves k rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def within_budget(df: DataFrame, group: Sequence[str], order: Sequence[Column], key: Sequence[str], eligible: Column, budget: int, name: str = "granted") -> DataFrame:
    """Marks the first `budget` eligible rows of each group; others don't use it up.

    `key` identifies a row and ends `order`. The marks are a pruned top-k of the eligible
    rows joined back by the key, so no task sorts a whole hot group. A null condition isn't
    eligible; rows of a null group share one budget.
    """
    marked = df.withColumn("_ok", F.coalesce(eligible, F.lit(False)))
    granted = top_per_group(marked.filter("_ok"), group, order, budget).select(*key, F.lit(True).alias("_granted")).distinct()
    return marked.join(granted, list(key), "left").select(*df.columns, F.coalesce("_granted", F.lit(False)).alias(name))


def first_of_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The row of the smallest `order` of each key, by a combining aggregate (no window).

    `order` should be unique; null keys are a key of their own.
    """
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.col(order)).alias("_r")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*df.columns)


def latest_of_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Upsert: the last written row of each key replaces the earlier ones."""
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.col(order)).alias("_r")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*df.columns)
