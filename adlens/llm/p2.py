"""Queries of problem 2: personal information inside free text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.pii import redact, spans, tagger
from adlens.session import spread, table

#: Texts tagged at once by a worker.
BATCH = 2_000


def tagged(texts: DataFrame) -> DataFrame:
    """(seq, redacted, found: array of (kind, value)) of rows (seq, text).

    The model comes with the package and is broadcast (some thousand weights). Null texts have no row, empty ones nothing found; texts of any
    length are tagged whole; repeated rows are tagged again; an empty table gives no rows.
    """
    model = texts.sparkSession.sparkContext.broadcast(tagger())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seq", pa.int64()), ("redacted", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])))])
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH):
                batch = whole.slice(a, BATCH)
                rows = batch.column(1).to_pylist()
                found = spans(model.value, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([redact(t, s) for t, s in zip(rows, found)], pa.string()),
                        pa.array([[{"kind": k, "value": v} for _, _, k, v in s] for s in found], schema.field("found").type),
                    ],
                    schema=schema,
                )

    cells = texts.select(F.col("seq").cast("long"), F.col("text")).filter("text is not null")
    return spread(cells).mapInArrow(run, "seq long, redacted string, found array<struct<kind: string, value: string>>")


def private_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "banners").filter("personal_ad")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = tagged(private_ads(spark, sf_dir)).select("seq", F.explode(F.array_distinct("found")).alias("f"))
    return each.select("seq", F.col("f.kind").alias("pii_kind"), F.col("f.value").alias("pii_value"))


def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Private advertisements with typed placeholders for personal values."""
    return tagged(private_ads(spark, sf_dir)).select("seq", F.col("redacted").alias("text"))


QUERIES = {"p2_found": p2_found, "p2_redacted": p2_redacted}

SQL: dict[str, str] = {}
