"""Model slots, cached results and fused fields.

A model is a function from a pandas batch to rows; it is made once per Python worker. The
cache is a table keyed by engine and content, joined before any model runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.scoring import keyword_category
from adlens.functions.text import is_personal
from adlens.operators.ranking import first_of_key

RESULT = ("text", "advertiser", "category", "construction", "is_realty", "developer", "complex_name", "offer_type", "advertiser_type")
RESULT_SCHEMA = ", ".join(f"{c} string" for c in RESULT) + ", failed boolean"
Recogniser = Callable[[pd.DataFrame], pd.DataFrame]


def detected(images: DataFrame, make: Callable[[], Callable[[pd.Series], list]], id_cols: list[str]) -> DataFrame:
    """One row per box: `make()` gives a detector of a row (pos_score, neg_score, label, box)."""
    ids = ", ".join(f"`{c}` {images.schema[c].dataType.simpleString()}" for c in id_cols)
    schema = f"{ids}, idx int, fx0 double, fy0 double, fx1 double, fy1 double, score double, label string, pos_score double, neg_score double"
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for df in batches:
            ids = df[id_cols].itertuples(index=False, name=None)
            rows = [[*own, i, *box] for own, row in zip(ids, df.itertuples(index=False)) for i, box in enumerate(model(row))]
            yield pd.DataFrame(rows, columns=names)

    return images.mapInPandas(run, schema)


def retrying(call: Callable, tries: int = 4, delay: float = 1.0, fatal: Callable[[Exception], bool] = lambda e: False) -> Callable:
    """The call, tried again after 1, 2, 4... delays; a fatal error ends its use for good."""
    dead: list[Exception] = []

    def run(*args):
        if dead:
            raise dead[0]
        for i in range(tries):
            try:
                return call(*args)
            except Exception as e:
                if fatal(e):
                    dead.append(e)
                    raise
                if i == tries - 1:
                    raise
                time.sleep(delay * 2**i)
        raise AssertionError("tries must be positive")

    return run


def observed(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """The table, counting rows and conditions as they pass by: no extra job, no accumulator."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]]
    return df.observe(seen, *counts), seen


def fixed_regions(images: DataFrame, regions: list[tuple[float, float, float, float]], label: str = "banner") -> DataFrame:
    """The same boxes for every row, score 1."""
    boxes = F.array(*[F.struct(F.lit(i).alias("idx"), *[F.lit(float(v)).alias(k) for k, v in zip(("fx0", "fy0", "fx1", "fy1"), r)]) for i, r in enumerate(regions)])
    if not regions:
        boxes = F.array().cast("array<struct<idx: int, fx0: double, fy0: double, fx1: double, fy1: double>>")
    return images.select("*", F.explode(boxes).alias("_b")).select(*images.columns, "_b.*", F.lit(1.0).alias("score"), F.lit(label).alias("label"))


def recognised(rows: DataFrame, make: Callable[[], Recogniser], keys: list[str]) -> DataFrame:
    """keys and result columns; a row whose recogniser raises is marked failed, the job goes on."""
    ids = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for df in batches:
            try:
                out = model(df).reindex(columns=RESULT).assign(failed=False)
            except Exception:  # one bad row must not cost the batch
                parts = []
                for i in range(len(df)):
                    try:
                        parts.append(model(df.iloc[i : i + 1]).reindex(columns=RESULT).assign(failed=False))
                    except Exception:
                        parts.append(pd.DataFrame([[None] * len(RESULT) + [True]], columns=[*RESULT, "failed"]))
                out = pd.concat(parts)
            # Plain objects: joined string parts may be chunked, which Arrow batches can't be.
            out = out.astype(object).reset_index(drop=True).assign(failed=lambda d: d["failed"].astype(bool))
            yield pd.concat([df[keys].reset_index(drop=True), out], axis=1)

    return rows.mapInPandas(run, f"{ids}, {RESULT_SCHEMA}")


def cached(rows: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """Rows with the cached result of their key (one of equal keys), and whether there was one."""
    one = first_of_key(cache.filter(F.col(key).isNotNull()).select(key, "created", *RESULT), [key], "created")
    return rows.join(one.withColumn("hit", F.lit(True)), key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def recognise(rows: DataFrame, cache: DataFrame, primary: Callable[[], Recogniser], fallback: Callable[[], Recogniser] | None = None) -> DataFrame:
    """Cache, else the primary engine, else the fallback: (key, engine, result, failed, hit).

    Rows: key, primary and fallback cache keys in `key` and `fallback_key` where there is a
    fallback. Results that failed are not to be cached.
    """
    looked = cached(rows, cache)
    hits = looked.filter("hit").select(*rows.columns, *RESULT, F.lit(False).alias("failed"), "hit")
    misses = looked.filter("not hit").select(*rows.columns)
    if fallback is not None and "fallback_key" in rows.columns:
        again = misses.withColumnRenamed("key", "_key").withColumnRenamed("fallback_key", "key")
        second = cached(again, cache).withColumnRenamed("key", "fallback_key").withColumnRenamed("_key", "key")
        hits = hits.unionByName(second.filter("hit").select(*rows.columns, *RESULT, F.lit(False).alias("failed"), "hit"))
        misses = second.filter("not hit").select(*rows.columns)
    first = recognised(misses, primary, rows.columns).withColumn("hit", F.lit(False))
    if fallback is None:
        return hits.unionByName(first)
    redo = recognised(first.filter("failed").select(*rows.columns), fallback, rows.columns).withColumn("hit", F.lit(False))
    return hits.unionByName(first.filter("not failed")).unionByName(redo)


def cache_insert(cache: DataFrame, results: DataFrame) -> DataFrame:
    """Cache with the results upserted: the latest created of each key."""
    from adlens.operators.ranking import latest_of_key

    both = cache.select(*cache.columns).unionByName(results.select(*cache.columns))
    return latest_of_key(both.filter("key is not null"), ["key"], "created")


def fused(category: Column, text: Column, matched: Column, canonical: Column, developer: Column, complex_read: Column, complex_known: Column, advertiser_type: Column) -> dict[str, Column]:
    """Fields from several origins: the engine's category else keywords; a known developer else the one read."""
    filled = lambda c: F.nullif(c, F.lit(""))
    return {
        "category": F.coalesce(filled(category), keyword_category(text)),
        "developer": F.coalesce(F.when(matched, canonical), filled(developer)),
        "complex_name": F.coalesce(filled(complex_read), complex_known),
        "personal_ad": is_personal(advertiser_type),
    }
