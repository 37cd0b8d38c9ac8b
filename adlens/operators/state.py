"""Sets that only grow: frontier, visited and cells as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions import geo
from adlens.operators.ranking import first_of_key


def insert_new(known: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the batch whose key is new, the first of each; known keys keep their place."""
    fresh = first_of_key(batch.filter(F.col(key).isNotNull()), [key], order)
    return fresh.join(known.select(key).distinct(), key, "left_anti").select(*batch.columns)


def not_in(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti").select(*df.columns)


def first_per_cell(points: DataFrame, metres: float, order: str = "seq") -> DataFrame:
    """The first point of every grid cell."""
    cells = points.filter(geo.valid_position(F.col("lon"), F.col("lat")))
    cells = cells.withColumn("cell_row", geo.cell_row(F.col("lat"), metres)).withColumn("cell_col", geo.cell_col(F.col("lon"), F.col("lat"), metres))
    return first_of_key(cells, ["cell_row", "cell_col"], order)


def points_in_cells(points: DataFrame, cells: DataFrame, metres: float) -> DataFrame:
    """Points that lie in one of the cells (cell_row, cell_col)."""
    keyed = points.withColumn("cell_row", geo.cell_row(F.col("lat"), metres)).withColumn("cell_col", geo.cell_col(F.col("lon"), F.col("lat"), metres))
    return keyed.join(cells.select("cell_row", "cell_col").distinct(), ["cell_row", "cell_col"], "left_semi").select(*points.columns)


def far_from(points: DataFrame, recorded: DataFrame, metres: float) -> DataFrame:
    """Points with no recorded point of their 3x3 cells nearer than `metres`."""
    keyed = points.withColumn("_r", geo.cell_row(F.col("lat"), metres)).withColumn("_c", geo.cell_col(F.col("lon"), F.col("lat"), metres))
    off = F.sequence(F.lit(-1), F.lit(1))
    around = F.flatten(F.transform(off, lambda i: F.transform(off, lambda j: F.struct(i.alias("i"), j.alias("j")))))
    guard = recorded.select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), geo.cell_row(F.col("lat"), metres).alias("_gr"), geo.cell_col(F.col("lon"), F.col("lat"), metres).alias("_gc"), F.explode(around).alias("o"))
    guard = guard.select("_lon", "_lat", (F.col("_gr") + F.col("o.i")).alias("_r2"), (F.col("_gc") + F.col("o.j")).alias("_c2"))
    close = geo.distance_m(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat")) < metres
    return keyed.join(guard, (F.col("_r") == F.col("_r2")) & (F.col("_c") == F.col("_c2")) & close, "left_anti").select(*points.columns)


def evolved(parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Tables of older and newer columns as one of the given schema; missing columns are null."""
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    have = set(joined.columns)
    return joined.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
