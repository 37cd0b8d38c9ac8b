"""Queries of problem 5: text that looks alike but is stored in other characters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import charforms as cf
from adlens.session import shared_dir, spread, table

FIELDS = ("text", "advertiser")
#: Least share of all words that a canonical word has, so there are at most 1 / SHARE of them at any size of the corpus.
SHARE = 1e-5
#: Fully ambiguous words that may be broadcast; more than these are looked up by a join.
MAX_AMBIGUOUS = 200_000


def values(banners: DataFrame) -> DataFrame:
    """(seq, field_name, value) of the non-null texts and advertisers."""
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS])
    return banners.select("seq", F.explode(each).alias("v")).select("seq", "v.field_name", "v.value").filter("value is not null")


def word_counts(cells: DataFrame) -> DataFrame:
    """(word, n) over all values: whole words of one alphabet, hosts and addresses left out."""
    cyrillic = rf"(?<![\p{{L}}\p{{M}}])[{cf.CYRILLIC}]+(?![\p{{L}}\p{{M}}])"
    latin = r"(?<![\p{L}\p{M}\p{N}@._/:-])[A-Za-z]+(?![\p{L}\p{M}\p{N}@_/:-]|\.\p{L})"
    words = F.regexp_extract_all("value", F.lit(f"{cyrillic}|{latin}"), F.lit(0))
    return cells.select(F.explode(F.transform(words, F.lower)).alias("word")).groupBy("word").count().withColumnRenamed("count", "n")


LATIN = "abcehijkmopstxy"
CYRILLIC = "".join({"b": "в", "h": "н", "k": "к", "m": "м", "t": "т"}.get(c) or cf.TO["cyrillic"][c] for c in LATIN)


def spellings(cells: DataFrame) -> tuple[list[tuple[str, int]], DataFrame | None]:
    """Canonical words, and a table (shape, word, n) of the fully ambiguous ones if they are too many.

    Of two whole-word twins the more frequent is kept, so an ordinary Latin word stays;
    these are all kept, however rare. Rarer words of other letters need no entry: the table
    of letters gives them their alphabet.
    """
    shared_dir(cells.sparkSession)
    counts = word_counts(cells).checkpoint()
    both = f"^[{cf.AMBIGUOUS_CYRILLIC.lower()}]+$|^[{cf.AMBIGUOUS_LATIN.lower()}]+$"
    twins = (
        counts.filter(F.col("word").rlike(both))
        .groupBy(F.translate("word", LATIN, CYRILLIC).alias("shape"))
        .agg(F.max(F.struct("n", "word")).alias("best"))
        .select("shape", "best.word", "best.n")
    )
    # Merged by a task, not by the driver, which would get every partition's share.
    least = (counts.agg(F.sum("n")).first()[0] or 0) * SHARE
    words = counts.filter(F.col("n") >= least).filter(~F.col("word").rlike(both)).repartition(1).sortWithinPartitions("word").collect()
    known = twins.limit(MAX_AMBIGUOUS + 1).collect()
    if len(known) > MAX_AMBIGUOUS:
        return [(r.word, r.n) for r in words], twins
    return [(r.word, r.n) for r in (*words, *known)], None


WHOLE_LATIN, WHOLE_CYRILLIC = (rf"(?<![\p{{L}}])[{letters}]+(?![\p{{L}}])" for letters in (cf.AMBIGUOUS_LATIN, cf.AMBIGUOUS_CYRILLIC))


def hinted(cells: DataFrame, twins: DataFrame) -> DataFrame:
    """Adds `hints`, the twins of a value's ambiguous words, by a join on their shape."""
    found = F.regexp_extract_all("value", F.lit(rf"{WHOLE_LATIN}|{WHOLE_CYRILLIC}"), F.lit(0))
    shapes = F.array_distinct(F.transform(found, lambda w: F.translate(F.lower(w), LATIN, CYRILLIC)))
    of = cells.select("value").distinct().select("value", F.explode(shapes).alias("shape")).join(twins, "shape")
    hints = of.groupBy("value").agg(F.collect_set(F.struct("word", "n")).alias("hints"))
    return cells.join(hints, "value", "left").select(*cells.columns, "hints")


def consistent(banners: DataFrame) -> DataFrame:
    """(seq, field_name, value, form, by) of every value that needs a closer look.

    `by` tells what found a disguise: the trie of spellings, one edit in it, the table of
    letters, or that of signs; it is empty where there is none.

    Values of Cyrillic letters and plain signs alone are skipped by the JVM unless one of
    their words may be a Latin one in look-alikes: they are in consistent form already.
    Nulls have no row, empty values and those of any length are handled whole, repeated rows keep their own seq, an empty table gives no rows.
    """
    cells = values(spread(banners.select("seq", *FIELDS)))
    words, twins = spellings(cells)
    shared = banners.sparkSession.sparkContext.broadcast(words)
    made: list[cf.Normaliser] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(cf.Normaliser(shared.value))
        for batch in batches:
            if batch.num_columns > 3:
                if len(made[0].learnt) > MAX_AMBIGUOUS:  # bounds a worker's memory
                    made[0] = cf.Normaliser(shared.value)
                for hints in batch.column(3).to_pylist():
                    made[0].learn((h["word"], h["n"]) for h in hints or ())
            done = [made[0].value(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())],
                names=["seq", "field_name", "value", "form", "by"],
            )

    looked = cells.filter(F.col("value").rlike(cf.LOOK) | F.col("value").rlike(WHOLE_CYRILLIC))
    if twins is not None:
        looked = hinted(looked, twins)
    return looked.mapInArrow(run, "seq long, field_name string, value string, form string, by string")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistent(table(spark, sf_dir, "banners")).filter("by <> ''").select("seq", "field_name")


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every disguised value."""
    return consistent(table(spark, sf_dir, "banners")).filter("by <> ''").select("seq", "field_name", "form")


QUERIES = {"p5_found": p5_found, "p5_forms": p5_forms}

SQL: dict[str, str] = {}
