"""Advertiser directory files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "brand_id long, canonical string, role string, aliases array<string>, complexes array<string>, site string, phone string, category string"


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """`brands:` mapping of a YAML file as a table; a missing file is an empty directory."""
    import yaml

    file = Path(path)
    data = (yaml.safe_load(file.read_text(encoding="utf-8")) or {}) if file.exists() else {}
    rows = []
    for i, (name, info) in enumerate((data.get("brands") or {}).items(), 1):
        info = info or {}
        texts = lambda k: [str(x) for x in info.get(k) or ()]  # noqa: B023, E731
        rows.append((i, str(name), info.get("role"), texts("aliases"), texts("complexes"), info.get("site"), info.get("phone"), info.get("category")))
    return spark.createDataFrame(rows, SCHEMA)
