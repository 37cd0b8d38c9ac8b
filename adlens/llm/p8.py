"""Queries of problem 8: the subjects of documents and the mix of the corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.subjects import BOS, FREE, NOTE, SUBJECTS, Boundaries, Labelled, Numbered, Statements, SubjectModel, Texts, bits_of, kept_out, pieces, statements_of, triples_of
from adlens.session import shared_dir, spread, table

#: Words of distinct statements up to which the models are estimated in one process; more are estimated by passes over a table.
LOCAL_WORDS = 3_000_000


def _broadcast(df: DataFrame, value: object):
    return df.sparkSession.sparkContext.broadcast(value)


def _labelled(batch: pa.RecordBatch) -> Iterator[Labelled]:
    for a in range(0, batch.num_rows, 1000):
        part = batch.slice(a, 1000)
        for stems, gaps, bits in zip(*(part.column(i).to_pylist() for i in range(3))):
            yield stems.split(), gaps.split(), bits


def _collected(df: DataFrame) -> Iterator[tuple]:
    """Rows of a table that is collected, batch by batch."""
    for batch in df.toArrow().to_batches(max_chunksize=10_000):
        yield from zip(*(c.to_pylist() for c in batch.columns))


class TextTable(Texts):
    """Cut texts as a table (stems, gaps, bits, kept), and the sums that a fit takes over it."""

    def __init__(self, rows: DataFrame, local_words: int):
        self.rows, self.local_words = rows, local_words

    def count(self) -> int:
        return self.rows.filter(F.col("bits") != NOTE).count()

    def part(self, kept: bool) -> TextTable:
        return TextTable(self.rows.filter(F.col("kept") == kept), self.local_words)

    def triples(self) -> Counter:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = triples_of(_labelled(batch))
                a, b, kind = zip(*n) if n else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(kind, pa.string()), pa.array(n.values(), pa.int64())], names=["a", "b", "kind", "n"])

        each = self.rows.mapInArrow(run, "a string, b string, kind string, n long").groupBy("a", "b", "kind").agg(F.sum("n").alias("n"))
        return Counter({(a, b, kind): n for a, b, kind, n in _collected(each)})

    def statements(self, boundaries: Boundaries, model: SubjectModel | None = None) -> Statements | StatementTable:
        shared = _broadcast(self.rows, (boundaries, model))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = statements_of(_labelled(batch), *shared.value)
                text, bits = zip(*n) if n else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(bits, pa.int32()), pa.array(n.values(), pa.int64())], names=["text", "bits", "n"])

        rows = self.rows.mapInArrow(run, "text string, bits int, n long").groupBy("text", "bits").agg(F.sum("n").alias("n")).checkpoint()
        shared.unpersist()
        words = rows.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
        return Statements(_collected(rows)) if words <= self.local_words else StatementTable(rows)

    def judged(self, model: SubjectModel) -> np.ndarray:
        shared = _broadcast(self.rows, model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = shared.value.judged(_labelled(batch)).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(range(len(n)), pa.int32()), pa.array(n, pa.int64())], names=["i", "n"])

        out = model.judged([]).ravel()
        for i, n in _collected(self.rows.mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n"))):
            out[i] = n
        return out.reshape(model.judged([]).shape)


class StatementTable(Statements):
    """Distinct statements as a table (text, bits, n)."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def vocabulary(self) -> tuple[list[str], list[tuple[str, str]]]:
        s = F.split("text", " ")
        words = self.rows.select(F.explode(s).alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n")).filter("n >= 2").select("w")
        after = F.transform(s, lambda w, i: F.struct(F.when(i == 0, F.lit(BOS)).otherwise(F.get(s, i - 1)).alias("a"), w.alias("b")))
        pairs = self.rows.select(F.explode(after).alias("p"), "n").groupBy("p.a", "p.b").agg(F.sum("n").alias("n")).filter("n >= 2").select("a", "b")
        return sorted(w for (w,) in _collected(words)), sorted(_collected(pairs))

    def numbered(self, model: SubjectModel) -> NumberTable:
        one = self.rows.filter((F.col("bits") > 0) & (F.col("bits") < FREE) & (F.bit_count("bits") == 1))
        under = one.groupBy("text").agg(F.count("*").alias("k"), F.sum("n").alias("times")).filter("k >= 6 or k >= 3 and k >= 0.25 * times").select("text", F.lit(True).alias("spread"))
        rows = self.rows.join(under, "text", "left").select("text", "bits", "n", F.coalesce("spread", F.lit(False)).alias("spread"))
        shared = _broadcast(self.rows, model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                block = shared.value.block(list(zip(*(c.to_pylist() for c in batch.columns))))
                yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in block], names=[f"x{i}" for i in range(6)])

        numbers = rows.mapInArrow(run, ", ".join(f"x{i} binary" for i in range(6))).checkpoint()
        shared.unpersist()
        return NumberTable(numbers)


class NumberTable(Numbered):
    """Blocks of numbers as a table, a block a row."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def sums(self, model: SubjectModel, start: bool = False) -> np.ndarray:
        shared = _broadcast(self.rows, model)
        classes = len(SUBJECTS) + 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = ([np.frombuffer(x, np.int64) for x in row] for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
            told = shared.value.sums(blocks, start)
            at = np.flatnonzero(told.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(told[at, c]) for c in range(classes))], names=["i", *(f"c{c}" for c in range(classes))])

        each = self.rows.mapInArrow(run, "i long, " + ", ".join(f"c{c} double" for c in range(classes)))
        out = model.sums([])
        for batch in each.groupBy("i").agg(*(F.sum(f"c{c}") for c in range(classes))).toArrow().to_batches():
            out[batch.column(0).to_numpy()] = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
        shared.unpersist()
        return out


def fitted(documents: DataFrame, labels: DataFrame, items: DataFrame, local_words: int = LOCAL_WORDS) -> SubjectModel:
    """Models from all labelled documents and all items, of any length; the same at any order of rows.

    Texts are cut and counted on the executors; the driver holds the models, the counts of
    their gaps and pairs, and at most `local_words` words of distinct statements. Beyond these every
    round of the estimate is a pass over a table, with equal sums.
    """
    spark = documents.sparkSession
    shared_dir(spark)
    of = labels.filter("doc_id is not null and subject is not null").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    texts = documents.select("doc_id", "text").join(of, "doc_id").select("text", "subjects").unionByName(items.select("text", F.lit(None).cast("array<string>").alias("subjects")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                text, of_text = (c.to_pylist() for c in whole.slice(a, 1000).columns)
                cut = [pieces(t) for t in text]
                bits = [NOTE if s is None else bits_of(s) for s in of_text]
                kept = [b != NOTE and kept_out(t) for t, b in zip(text, bits)]
                columns = [pa.array([" ".join(s) for s, _ in cut]), pa.array([" ".join(g) for _, g in cut]), pa.array(bits, pa.int32()), pa.array(kept, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["stems", "gaps", "bits", "kept"])

    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = texts.filter(F.col("text").rlike(r"\S")).repartition(cores).mapInArrow(run, "stems string, gaps string, bits int, kept boolean").checkpoint()
    return SubjectModel().learn(TextTable(rows, local_words))


def subjects(documents: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, subjects: array) of every document with words in its text.

    Null, empty and blank texts have no row; whole texts of any length are read; repeated
    documents each have their row; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                found = shared.value.classify(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "subjects"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").rlike(r"\S"))
    return spread(texts).mapInArrow(run, "doc_id long, subjects array<string>")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fitted(documents, table(spark, sf_dir, "doc_labels"), table(spark, sf_dir, "eval_items"))
    return subjects(documents, model)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select("doc_id", F.explode("subjects").alias("subject"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composition of the corpus: documents of each subject, one of k subjects counting 1/k."""
    each = _found(spark, sf_dir).filter("size(subjects) > 0")
    rows = each.select((F.lit(1.0) / F.size("subjects")).alias("part"), F.explode("subjects").alias("subject"))
    return rows.groupBy("subject").agg(F.count("*").alias("n_docs"), F.round(F.sum("part"), 6).alias("weight"))


QUERIES = {"p8_found": p8_found, "p8_mix": p8_mix}

SQL: dict[str, str] = {}
