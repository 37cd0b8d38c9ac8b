"""Queries of problem 3: advertiser, brand and complex names mapped to the directory."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.mapping import directory, normal
from adlens.session import shared_dir, spread, table

FIELDS = ("advertiser", "brand", "complex_name")
#: The directory is an index in every worker; a longer list is refused.
MAX_ENTRIES = 100_000
#: Share of all cells from which a value's answer is broadcast; at most 1 / HOT values have it.
HOT = 1e-4


def cells_of(banners: DataFrame, brands: DataFrame, strict: bool = True) -> DataFrame:
    """(seq, field_name, value) of non-blank values; with `strict` those not spelled exactly like an entry."""
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS])
    cells = banners.select("seq", F.explode(each).alias("v")).select("seq", "v.field_name", "v.value").filter(F.col("value").rlike(r"(?U)[^\s]"))
    if not strict:
        return cells
    name = brands.select(F.explode(F.array(F.lit("advertiser"), F.lit("brand"))).alias("field_name"), F.col("canonical").alias("value"))
    exact = name.unionByName(brands.select(F.lit("complex_name").alias("field_name"), F.explode("complexes").alias("value"))).filter("value is not null")
    return cells.join(F.broadcast(exact.distinct()), ["field_name", "value"], "left_anti")  # bounded with the directory


def answers(cells: DataFrame, brands: DataFrame) -> DataFrame:
    """(field_name, value, n, form, canon, by): each distinct value once, with its number of cells."""
    shared_dir(cells.sparkSession)
    entries = [r.asDict() for r in brands.select("canonical", "aliases", "complexes", "site").filter("canonical is not null").limit(MAX_ENTRIES + 1).collect()]
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"the directory has more than {MAX_ENTRIES} entries")
    shared = cells.sparkSession.sparkContext.broadcast(entries)
    made: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            names, complexes = directory(shared.value)
            made.update(advertiser=names, brand=names, complex_name=complexes)
        for batch in batches:
            forms = [normal(v) for v in batch.column(1).to_pylist()]
            found = [made[f].match_normal(x) for f, x in zip(batch.column(0).to_pylist(), forms)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forms, pa.string()), pa.array([m.target for m in found], pa.string()), pa.array([m.by for m in found], pa.string())],
                names=["field_name", "value", "n", "form", "canon", "by"],
            )

    distinct = cells.groupBy("field_name", "value").agg(F.count("*").alias("n")).checkpoint()
    return spread(distinct).mapInArrow(run, "field_name string, value string, n long, form string, canon string, by string")


def mapped(banners: DataFrame, brands: DataFrame, strict: bool = True) -> DataFrame:
    """(seq, field_name, value, canon) of every non-blank value that isn't an entry's spelling.

    canon is the entry meant, empty when none is. A complex named in advertiser or brand
    stands for its developer. Values are counted, and each is looked up once; answers come
    back to the rows by a join, those of frequent values by a broadcast one, so a value
    that fills a third of the rows is no hot key. Nulls and blanks have no row; repeated
    rows keep their own seq; null aliases, complexes and sites of the directory are
    skipped; with an empty directory everything is unmatched. With `strict` off, exact
    spellings are rows too.
    """
    cells = cells_of(banners, brands, strict)
    known = answers(cells, brands).checkpoint()
    least = (known.agg(F.sum("n")).first()[0] or 0) * HOT
    key = ["field_name", "value"]
    hot = known.filter(F.col("n") >= least).select(*key, "canon")
    told = cells.join(F.broadcast(hot), key, "left")
    rest = told.filter("canon is null").drop("canon").join(known.filter(F.col("n") < least).select(*key, "canon"), key)
    return told.filter("canon is not null").unionByName(rest).select("seq", "field_name", "value", "canon")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(table(spark, sf_dir, "banners"), table(spark, sf_dir, "brands")).drop("value")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the values that mean no entry, by their normalised form."""
    banners, brands = table(spark, sf_dir, "banners"), table(spark, sf_dir, "brands")
    none = answers(cells_of(banners, brands), brands).filter("canon = ''")
    return none.groupBy("field_name", "form").agg(F.sum("n").alias("n"))


QUERIES = {"p3_found": p3_found, "p3_unmatched": p3_unmatched}

SQL: dict[str, str] = {}
