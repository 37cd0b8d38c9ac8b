"""Resumable walk with spacing, and first-fit duplicates over a stream.

State is a few tables that only grow: frontier, visited, recorded, failed, processed. Each
step's rows are written before its commit, and a run continues after the last commit, so an
interrupted step is done again from the same input. A walk is sequential by nature and its
frontier mostly small: graphs that fit one task are walked by one task, larger ones level
by level with joins; both give the same rows.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions import geo
from adlens.operators.graph import Box, nearest, numbered, usable
from adlens.operators.greedy import first_fit_boards, spaced
from adlens.operators.ranking import first_of_key
from adlens.session import shared_dir

SCHEMAS = {
    "frontier": "oid string, seq long, level int",
    "visited": "panoid string, level int",
    "recorded": "seq long, lon double, lat double",
    "failed": "seq long",
    "processed": "panoid string, seq long, level int",
    "commits": "step int, done_seq long, next_seq long, processed long, reason string",
}
#: Panoramas that one task may hold; larger graphs are crawled level by level.
LOCAL_NODES = 200_000


@dataclass
class CrawlRules:
    bbox: Box | None = None
    spacing_m: float = 75.0
    max_failures: int = 30
    max_processed: int | None = None


class Crawl:
    """Crawl state in a folder. A step writes its rows, then its commit; uncommitted rows don't count."""

    def __init__(self, spark: SparkSession, path: str, rules: CrawlRules, local_nodes: int = LOCAL_NODES):
        self.spark, self.path, self.rules, self.local_nodes = spark, path.rstrip("/"), rules, local_nodes

    def table(self, name: str, steps: int | None = None) -> DataFrame:
        """Committed rows of a table."""
        schema = T.StructType.fromDDL(SCHEMAS[name])
        try:
            df = self.spark.read.schema(T.StructType.fromDDL(SCHEMAS[name] + ", part int")).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        except AnalysisException as e:  # not written yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)
        if steps is None and name != "commits":
            last = self.last()
            steps = -1 if last is None else last.step
        return (df if steps is None else df.filter(F.col("part") <= steps)).select(*schema.names)

    def drop(self) -> None:
        """Removes the state; its tables can't be read afterwards."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def counts(self) -> DataFrame:
        """(state, n) of pending, visited, processed, recorded and failed."""
        last = self.last()
        done = -1 if last is None else last.done_seq
        of = lambda name, n: self.table(name).agg(n.alias("n")).select(F.lit(name).alias("state"), "n")
        rows = of("frontier", F.count_if(F.col("seq") > done)).withColumn("state", F.lit("pending"))
        for name in ("visited", "processed", "recorded", "failed"):
            rows = rows.unionByName(of(name, F.count(F.lit(1))))
        return rows

    def last(self) -> T.Row | None:
        return self.table("commits").orderBy(F.desc("step")).first()

    def _write(self, df: DataFrame, name: str, step: int) -> None:
        df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(SCHEMAS[name]).fields]).write.mode("overwrite").parquet(f"{self.path}/{name}/part={step}")

    def _commit(self, step: int, done_seq: int, next_seq: int, processed: int, reason: str) -> T.Row:
        row = self.spark.createDataFrame([(step, done_seq, next_seq, processed, reason)], SCHEMAS["commits"]).coalesce(1)
        self._write(row, "commits", step)
        return row.first()

    def run(self, panoramas: DataFrame, lon: float, lat: float) -> DataFrame:
        """Processed panoramas (panoid, seq, level), the start with seq -1.

        The start is processed without a spacing check. An oid without usable metadata
        fails and is never asked again; `max_failures` in a row end the run, as does
        `max_processed` of this run (the start not counted). Panoramas out of the box stay
        visited and unexpanded. Running again continues where the last run stopped.
        """
        shared_dir(self.spark)
        return self._run(usable(panoramas).checkpoint(), lon, lat)

    def _run(self, meta: DataFrame, lon: float, lat: float) -> DataFrame:
        last = self.last() or self._start(meta, lon, lat)
        first_seq, before = last.done_seq + 1, last.processed
        small = meta.count() <= self.local_nodes
        while True:
            last = self._local(meta, last) if small else self._level(meta, last, first_seq, before)
            if last.reason:
                return self.table("processed")

    def _start(self, meta: DataFrame, lon: float, lat: float) -> T.Row:
        first = nearest(meta, lon, lat).filter(geo.in_bbox(F.col("lon"), F.col("lat"), self.rules.bbox)).checkpoint()
        zero, before = F.lit(0).alias("level"), F.lit(-1).alias("seq")
        self._write(first.select("panoid", zero), "visited", 0)
        self._write(first.select("panoid", before, zero), "processed", 0)
        self._write(first.select(before, "lon", "lat"), "recorded", 0)
        links = first.select(F.posexplode("neighbor_oids").alias("pos", "oid")).filter("oid is not null")
        new = numbered(first_of_key(links, ["oid"], "pos"), ["oid"], "pos", "seq", rows_known=0).checkpoint()
        self._write(new.withColumn("level", F.lit(1)), "frontier", 0)
        return self._commit(0, -1, new.count(), 0, "")

    def run_all(self, panoramas: DataFrame, lon: float, lat: float) -> DataFrame:
        """Processed panoramas (panoid, seq, level) once every usable panorama of the box was visited.

        When the frontier is empty, the panoramas left that no link from an earlier one of
        them leads to are asked next, at level 0: every other one left is reached from these.
        Failures in a row don't end it, `max_processed` does.
        """
        shared_dir(self.spark)
        meta = usable(panoramas).checkpoint()
        while True:
            rows = self._run(meta, lon, lat)
            last = self.last()
            if last.reason == "limit" or last.reason == "frontier empty" and not self._seed(meta, last, lon, lat):
                return rows

    def _seed(self, meta: DataFrame, last: T.Row, lon: float, lat: float) -> int:
        """Puts starts for what is left into the frontier, the nearest to (lon, lat) first; their number."""
        left = meta.filter(geo.in_bbox(F.col("lon"), F.col("lat"), self.rules.bbox)).join(self.table("visited"), "panoid", "left_anti").checkpoint()
        links = left.select(F.col("panoid").alias("from"), F.explode("neighbor_oids").alias("oid"))
        later = links.join(left.select("oid", "panoid"), "oid").filter(F.col("from") < F.col("panoid")).select("panoid").distinct()
        metres = F.coalesce(geo.distance_m(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat)), F.lit(float("inf")))
        new = left.join(later, "panoid", "left_anti").select("panoid", "oid", F.struct(metres, "panoid", "oid").alias("order"))
        new = first_of_key(new, ["panoid"], "order").checkpoint()
        n = new.count()
        if n:
            self._write(numbered(new, ["oid"], "order", "seq", last.next_seq, rows_known=n).withColumn("level", F.lit(0)), "frontier", last.step + 1)
            self._commit(last.step + 1, last.done_seq, last.next_seq + n, last.processed, "")
        return n

    # -- one task ---------------------------------------------------------------------

    def _local(self, meta: DataFrame, last: T.Row) -> T.Row:
        """The whole rest of the crawl in one task over the graph's rows (few, by their count)."""
        rules, step = self.rules, last.step + 1
        state = {
            "pending": [(r.seq, r.oid, r.level) for r in self.table("frontier", last.step).filter(F.col("seq") > last.done_seq).orderBy("seq").collect()],
            "known": {r.oid for r in self.table("frontier", last.step).collect()},
            "visited": {r.panoid for r in self.table("visited", last.step).collect()},
            "recorded": [(r.lon, r.lat) for r in self.table("recorded", last.step).orderBy("seq").collect()],
            "next_seq": last.next_seq,
        }

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            nodes = {r.oid: (r.panoid, r.lon, r.lat, [] if r.neighbor_oids is None else list(r.neighbor_oids)) for df in batches for r in df.itertuples()}
            yield pd.DataFrame(_pop_all(nodes, state, rules), columns=["kind", "key", "seq", "level", "lon", "lat"])

        log = meta.coalesce(1).mapInPandas(task, "kind string, key string, seq long, level int, lon double, lat double").checkpoint()
        of = lambda kind: log.filter(F.col("kind") == kind)
        self._write(of("frontier").withColumnRenamed("key", "oid"), "frontier", step)
        self._write(of("visited").withColumnRenamed("key", "panoid"), "visited", step)
        self._write(of("processed").withColumnRenamed("key", "panoid"), "processed", step)
        self._write(of("recorded"), "recorded", step)
        self._write(of("failed"), "failed", step)
        end = of("end").first()
        n = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
        return self._commit(step, end.seq, last.next_seq + n.get("frontier", 0), last.processed + n.get("processed", 0), end.key)

    # -- level by level ---------------------------------------------------------------

    def _level(self, meta: DataFrame, last: T.Row, first_seq: int, before: int) -> T.Row:
        """All pending oids at once; equal to popping them one by one in order."""
        rules, step, done = self.rules, last.step + 1, last.step
        front = self.table("frontier", done).filter(F.col("seq") > last.done_seq).checkpoint()
        if front.isEmpty():
            return self._commit(step, last.done_seq, last.next_seq, last.processed, "frontier empty")
        asked = front.join(meta, "oid", "left").checkpoint()
        reason, end = "", last.next_seq - 1
        failed = asked.filter("panoid is null").select("seq")
        recent = self.table("failed", done).filter((F.col("seq") >= first_seq) & (F.col("seq") > last.done_seq - rules.max_failures))
        stop = self._failure_stop(failed.unionByName(recent))
        if stop is not None:
            asked, reason, end = asked.filter(F.col("seq") <= stop), "failures", stop
        ok = first_of_key(asked.filter("panoid is not null"), ["panoid"], "seq").join(self.table("visited", done).select("panoid"), "panoid", "left_anti")
        ok = ok.withColumn("inside", geo.in_bbox(F.col("lon"), F.col("lat"), rules.bbox)).checkpoint()
        guards = self.table("recorded", done).select((F.col("seq") - (1 << 40)).alias("seq"), "lon", "lat")
        kept = spaced(ok.filter("inside").select("seq", "lon", "lat"), rules.spacing_m, guards).join(ok, "seq").checkpoint()
        n = kept.count()
        if rules.max_processed is not None and last.processed - before + n >= rules.max_processed:
            n = rules.max_processed - (last.processed - before)
            end, reason = kept.orderBy("seq").limit(n).agg(F.max("seq")).first()[0], "limit"
        kept, ok, failed = (d.filter(F.col("seq") <= end) for d in (kept, ok, failed))
        links = ok.filter("inside").select(F.col("seq").alias("from"), "level", F.posexplode("neighbor_oids").alias("pos", "oid")).filter("oid is not null")
        links = links.select("oid", (F.col("level") + 1).alias("level"), F.struct("from", "pos").alias("order")).join(self.table("frontier", done).select("oid"), "oid", "left_anti")
        new = first_of_key(links, ["oid"], "order").checkpoint()
        n_new = new.count()
        self._write(ok, "visited", step)
        self._write(kept, "processed", step)
        self._write(kept.filter("recorded"), "recorded", step)
        self._write(failed, "failed", step)
        self._write(numbered(new, ["oid", "level"], "order", "seq", last.next_seq, rows_known=n_new), "frontier", step)
        return self._commit(step, end, last.next_seq + n_new, last.processed + n, reason)

    def _failure_stop(self, failed: DataFrame) -> int | None:
        """Number of the failure that completes the first run of `max_failures`."""
        k = self.rules.max_failures
        runs = failed.select(F.explode(F.sequence(F.col("seq") - (k - 1), F.col("seq"))).alias("first")).groupBy("first").count().filter(F.col("count") == k)
        first = runs.agg(F.min("first")).first()[0]
        return None if first is None else first + k - 1


def _pop_all(nodes: dict, state: dict, rules: CrawlRules) -> list[tuple]:
    """Log of the crawl from its pending oids to its end, one oid after the other."""
    scale = geo.METRES_PER_DEGREE
    log: list[tuple] = []
    queue, known, visited, seq_next = deque(state["pending"]), set(state["known"]), set(state["visited"]), state["next_seq"]

    def cell(lon: float, lat: float) -> tuple[int, int]:
        row = round(lat / (rules.spacing_m / scale))
        return row, round(lon / (rules.spacing_m / (scale * max(0.1, math.cos(math.radians(lat))))))

    guard: dict[tuple[int, int], tuple[float, float]] = {}
    for lon, lat in state["recorded"]:
        guard.setdefault(cell(lon, lat), (lon, lat))
    in_row = done = 0
    at, reason = seq_next - 1 if not queue else queue[0][0] - 1, "frontier empty"
    while queue:
        at, oid, level = queue.popleft()
        node = nodes.get(oid)
        if node is None:
            log.append(("failed", oid, at, level, None, None))
            in_row += 1
            if in_row >= rules.max_failures:
                reason = "failures"
                break
            continue
        in_row = 0
        panoid, lon, lat, links = node
        if panoid in visited:
            continue
        visited.add(panoid)
        log.append(("visited", panoid, at, level, None, None))
        if rules.bbox and not (rules.bbox[0] <= lon <= rules.bbox[2] and rules.bbox[1] <= lat <= rules.bbox[3]):
            continue
        for link in links:
            if link is not None and link not in known:
                known.add(link)
                queue.append((seq_next, link, level + 1))
                log.append(("frontier", link, seq_next, level + 1, None, None))
                seq_next += 1
        if not (abs(lon) <= 180 and abs(lat) <= 90) or (lon == 0 and lat == 0):
            continue
        row, col = cell(lon, lat)
        around = (guard.get((row + i, col + j)) for i in (-1, 0, 1) for j in (-1, 0, 1))
        if any(g and math.hypot((g[0] - lon) * scale * math.cos(math.radians((g[1] + lat) / 2)), (g[1] - lat) * scale) < rules.spacing_m for g in around):
            continue
        if (row, col) not in guard:
            guard[row, col] = (lon, lat)
            log.append(("recorded", panoid, at, level, lon, lat))
        log.append(("processed", panoid, at, level, None, None))
        done += 1
        if rules.max_processed is not None and done >= rules.max_processed:
            reason = "limit"
            break
    log.append(("end", reason, at, None, None, None))
    return log


#: Side of the store's partitions in degrees; wider than any search box.
STORE_CELL = 1.0


def _store_cell(lon: Column, lat: Column) -> Column:
    """Number of the store's cell, -1 without a position."""
    cell = F.floor((lat + 90) / STORE_CELL) * 1000 + F.floor((lon + 180) / STORE_CELL)
    return F.when(geo.valid_position(lon, lat), cell).otherwise(-1).cast("int")


def stream_first_fit(source: DataFrame, store: str, checkpoint: str, **radii: float):
    """Writes a stream's readings that are no duplicates of earlier ones to the store.

    `source` is a streaming table of readings. Every micro-batch is checked against the
    batches before it and within itself by seq, so batches in order of arrival give the
    same store as one run. A batch writes its own folder and reads those of smaller number
    only: doing it again changes nothing, whichever it is. A store belongs to one
    checkpoint. Only cells (`cell`, one degree wide) around the batch are read.
    """
    store = store.rstrip("/")

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        cell = _store_cell(F.col("lon"), F.col("lat"))
        near = [[cell + i * 1000 + j for j in (-1, 0, 1)] for i in (-1, 0, 1)]
        # At most the cells of the globe; 180 degrees east and west meet.
        around = F.explode(F.array(*[c for row in near for c in row], cell - 359, cell + 359)).alias("cell")
        cells = [r.cell for r in rows.filter(cell >= 0).select(around).distinct().collect()]
        try:
            schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType()), T.StructField("cell", T.IntegerType())])
            stored = spark.read.schema(schema).parquet(store).filter(F.col("batch") < number).filter(F.col("cell").isin(cells)).select(*rows.columns)
            stored.limit(0).count()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = None
        kept = first_fit_boards(rows, stored, **radii)
        kept.withColumn("cell", cell).write.mode("overwrite").partitionBy("cell").parquet(f"{store}/batch={number}")

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def stored_readings(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The readings that `stream_first_fit` has stored."""
    return spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(store)
