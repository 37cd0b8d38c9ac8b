"""Query p4: boards close to each other, seen from different panoramas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.operators.neighbors import board_pairs
from adlens.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_pairs(table(spark, sf_dir, "banners"))


QUERIES = {"p4_found": p4_found}

SQL = {
    "p4_found": """
WITH p AS (
  SELECT seq, coalesce(panoid, '') AS panoid,
    lon + CASE WHEN bearing_deg IS NULL THEN 0
      ELSE 25 * sin(radians(bearing_deg)) / (111320 * greatest(0.1, cos(radians(lat)))) END AS x,
    lat + CASE WHEN bearing_deg IS NULL THEN 0 ELSE 25 * cos(radians(bearing_deg)) / 111320 END AS y
  FROM banners
  WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AND NOT (lon = 0 AND lat = 0)),
c AS (SELECT *, CAST(floor(y * 111320 / 30) AS BIGINT) AS r FROM p),
d AS (SELECT seq, panoid, x, y, r + k AS r FROM c, (VALUES (-1), (0), (1)) t(k))
SELECT c.seq AS seq_a, d.seq AS seq_b
FROM c JOIN d ON c.r = d.r AND c.seq < d.seq AND c.panoid <> d.panoid
WHERE sqrt(power((d.x - c.x) * 111320 * cos(radians((c.y + d.y) / 2)), 2) + power((d.y - c.y) * 111320, 2)) <= 25
"""
}
