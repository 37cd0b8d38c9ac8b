"""Queries of problem 1: the best representative of each duplicate group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.survivors import by_rule, fuse
from adlens.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors under the stated rule, the prior that leaves the votes nothing to decide."""
    return by_rule(table(spark, sf_dir, "banners")).select("banner_id", "field_name", "seq")


def p1_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors under a flat prior: the value that the sources' discounted votes favour."""
    return fuse(table(spark, sf_dir, "banners")).withColumn("posterior", F.round("posterior", 6))


QUERIES = {"p1_found": p1_found, "p1_fused": p1_fused}

SQL = {
    "p1_found": r"""
WITH u AS (
  SELECT banner_id, seq,
    CASE WHEN score >= 0 AND score <= 1 THEN score END AS sc,
    CASE WHEN timestamp >= 1420070400 AND timestamp < 1767225600 THEN timestamp END AS ts,
    CASE WHEN regexp_matches(crop_image_path, '\.(jpg|jpeg|png)\s*$', 'i') THEN 1 END AS pth,
    len(list_distinct(list_filter(list_transform(phones, lambda x: CASE
      WHEN regexp_matches(regexp_replace(x, '[^0-9]', '', 'g'), '^(7|8)[0-9]{10}$')
        AND NOT (starts_with(ltrim(x), '+') AND starts_with(regexp_replace(x, '[^0-9]', '', 'g'), '8'))
        THEN right(regexp_replace(x, '[^0-9]', '', 'g'), 10)
      WHEN regexp_matches(regexp_replace(x, '[^0-9]', '', 'g'), '^[0-9]{10}$') AND NOT starts_with(ltrim(x), '+')
        THEN regexp_replace(x, '[^0-9]', '', 'g') END), lambda x: x IS NOT NULL))) AS np
  FROM banners WHERE banner_id IS NOT NULL
    AND banner_id IN (SELECT banner_id FROM banners GROUP BY banner_id HAVING count(*) >= 2)),
f AS (
  SELECT banner_id, seq, ts, sc, 'score' AS field_name, sc AS k FROM u WHERE sc IS NOT NULL
  UNION ALL SELECT banner_id, seq, ts, sc, 'timestamp', ts FROM u WHERE ts IS NOT NULL
  UNION ALL SELECT banner_id, seq, ts, sc, 'crop_image_path', coalesce(ts, -1) FROM u WHERE pth = 1
  UNION ALL SELECT banner_id, seq, ts, sc, 'phones', np FROM u WHERE np > 0)
SELECT banner_id, field_name, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY banner_id, field_name
    ORDER BY k DESC, ts DESC NULLS LAST, sc DESC NULLS LAST, seq) AS rn FROM f) WHERE rn = 1
"""
}
