"""Queries of problem 7: held-out passages inside the training corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.tiling import SEED, SeedFilter, leaks, numbers, seeds, shared_runs
from adlens.session import shared_dir, spread, table

#: Texts searched at once by a worker.
TEXTS = 1_000


def passages(items: DataFrame) -> DataFrame:
    """(item_id, words) of the passages of five words or more, words as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [numbers(t) if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64()))], names=["item_id", "words"])

    return items.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null").mapInArrow(run, "item_id long, words array<long>").filter(F.size("words") >= SEED)


def item_seeds(distinct: DataFrame) -> DataFrame:
    """(key, seed) of every window of the distinct passages (key, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.unique(seeds(np.array(words, dtype=np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key)), pa.array(own)], names=["key", "seed"])

    return distinct.select("key", "words").mapInArrow(run, "key long, seed long")


def seed_filter(keys: DataFrame) -> SeedFilter:
    """The filter of all seeds, filled by one task; at most 32 MB reach the driver."""
    n = keys.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = SeedFilter(n)
        for batch in batches:
            made.add(batch.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([made.bits.tobytes()], pa.binary())], names=["bits"])

    rows = keys.select("seed").coalesce(1).mapInArrow(run, "bits binary").collect()
    return SeedFilter(n, bytes(rows[0].bits) if rows else None)


def leaked(documents: DataFrame, items: DataFrame, share: float = 0.5) -> DataFrame:
    """(doc_id, item_id): at least `share` of the item's words stand in runs of five or more.

    One pass over the documents, whatever the number of items, keeps the runs of words that
    may be shared; documents and items then meet by seed. Of an item that needs k seeds the
    k - 1 most frequent ones can't be the only ones shared and are not joined, so a phrase
    that many have is met only where rarer words agree; a seed that is frequent still is
    split by adaptive skew joins. Passages under five words, null and empty texts leak
    nothing; whole texts of any length are searched; repeated documents each have their
    rows, repeated items are searched once and told once for each id; either table may be
    empty. A word is known by a 64-bit hash.
    """
    spark = documents.sparkSession
    shared_dir(spark)
    every = passages(items).checkpoint()
    distinct = every.groupBy("words").agg(F.min("item_id").alias("key")).checkpoint()
    keys = item_seeds(distinct).checkpoint()
    known = spark.sparkContext.broadcast(seed_filter(keys.select("seed").distinct()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                part = batch.slice(a, TEXTS)
                found = list(shared_runs(part.column(1).to_pylist(), known.value))
                ids = part.column(0).to_pylist()
                many = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[d] for d, _, _ in found], pa.int64()), pa.array([r for _, r, _ in found], many), pa.array([s for _, _, s in found], many)], names=["doc_id", "runs", "seeds"]
                )

    texts = spread(documents.select(F.col("doc_id").cast("long"), "text").filter("text is not null"))
    hits = texts.mapInArrow(search, "doc_id long, runs array<long>, seeds array<long>")
    hits = hits.withColumn("doc", F.monotonically_increasing_id()).checkpoint()
    met = hits.select("doc", F.explode("seeds").alias("seed"))
    # Rare seeds first; the last ones that an item can do without are left out. A tile of n
    # words has n - 4 windows, which is a fifth of them at least; windows may repeat a seed.
    times = met.groupBy("seed").agg(F.count("*").alias("times"))
    of_item = Window.partitionBy("key")
    ranked = keys.withColumn("all", F.count("*").over(of_item)).join(times, "seed")
    ranked = ranked.withColumn("rank", F.row_number().over(of_item.orderBy("times", "seed"))).withColumn("have", F.count("*").over(of_item))
    repeats = F.size("words") - (SEED - 1) - F.col("all")
    need = F.greatest(F.lit(1), F.ceil(F.size("words") * F.lit(share) / SEED) - repeats)
    index = ranked.join(distinct, "key").filter(F.col("rank") <= F.col("have") - need + 1).select("key", "seed")
    pairs = met.join(index, "seed").select("doc", "key").distinct()
    both = pairs.join(distinct.select("key", "words"), "key").join(hits.select("doc", "doc_id", "runs"), "doc")

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [leaks(w, r, share) for w, r in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["doc", "doc_id", "key"]).filter(pa.array(keep, pa.bool_()))

    found = both.select("doc", "doc_id", "words", "runs", "key").mapInArrow(tiled, "doc long, doc_id long, key long")
    names = every.join(distinct, "words").select("key", "item_id").distinct()
    return found.join(names, "key").select("doc", "doc_id", "item_id").distinct().select("doc_id", "item_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


QUERIES = {"p7_found": p7_found}

SQL: dict[str, str] = {}
