"""Queries of problem 6: the corpus as ids of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.bpe import Decoder, Transducer, read_ranks
from adlens.session import spread, table

TOKENIZERS = os.environ.get("ADLENS_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: how this vocabulary's texts are cut into words before encoding.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Ids that a batch of results may hold before it is sent off.
MAX_IDS = 1_000_000

_MADE: dict[str, tuple[Transducer, Decoder]] = {}


def _machines(key: str, ranks: Callable[[], dict[bytes, int]]) -> tuple[Transducer, Decoder]:
    """One transducer for each Python worker; its states serve all tasks of the worker."""
    if key not in _MADE:
        _MADE[key] = (Transducer(ranks()), Decoder(ranks()))
    return _MADE[key]


def encode_text(transducer: Transducer, cut: Callable[[str], list[str]], text: str | None) -> list[int]:
    ids: list[int] = []
    if text:
        words = transducer.words
        for w in cut(text):
            b = w.encode("utf-8", "replace")
            ids += words.get(b) or transducer.encode(b)
    return ids


def encoded(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids) of every document; null and empty texts give an empty list.

    Special tokens' names in a text are ordinary text. Texts of any length are encoded
    whole; repeated rows give repeated results; an empty table gives no rows. The
    vocabulary (fixed, about 1 MB) is read on the driver and broadcast.
    """
    path = vocabulary or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    shared = documents.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(WORDS).findall
        transducer, _ = _machines(path, lambda: shared.value)
        for batch in batches:
            flat: list[int] = []
            ends, start = [0], 0
            for row in range(batch.num_rows):
                flat += encode_text(transducer, cut, batch.column(1)[row].as_py())
                ends.append(len(flat))
                # Long texts leave in smaller batches, within a worker's memory.
                if len(flat) >= MAX_IDS or row + 1 == batch.num_rows:
                    ids = pa.ListArray.from_arrays(pa.array(np.asarray(ends, dtype=np.int32)), pa.array(np.asarray(flat, dtype=np.int32)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, row + 1 - start), ids], names=["doc_id", "ids"])
                    flat, ends, start = [], [0], row + 1

    return spread(documents.select("doc_id", "text")).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are no UTF-8 come out as U+FFFD."""
    path = vocabulary or f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    shared = ids.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _machines(path, lambda: shared.value)
        for batch in batches:
            texts = ["".join(decoder.stream(x or ())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip: every document's ids back to its text (null comes back empty)."""
    return decoded(encoded(table(spark, sf_dir, "documents"))).select("doc_id", F.col("text").alias("text"))


QUERIES = {"p6_ids": p6_ids, "p6_decoded": p6_decoded}

SQL = {"p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
