"""Boxes cut out of tiles, straightened, gated and encoded.

A crop is a group of the few tiles that its box touches; the size gate bounds its pixels
before any tile is read. Pixels stay on the executors; tiles are joined from a table, or
looked up by the task that cuts the boxes of their panorama.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import boxes, scoring
from adlens.operators.images import STATS, pixels, rectified, with_visual_stats

EDGES = ("px0", "py0", "px1", "py1")
CROP = "panoid string, idx int, width int, height int, data binary"

#: Looks up a tile (panoid, x, y): its width, height and BGR bytes, or None if it is missing.
Fetch = Callable[[str, int, int], tuple[int, int, bytes] | None]
KEPT = 64  # tiles that a task remembers
BATCH_BYTES = 16 << 20  # pixels in a worker's hands at once


def placed(boxes_: DataFrame, level: Column, pad: float = 0.0) -> DataFrame:
    """Adds the padded box (b_fx0...), its pixels (px0...) and its tiles (tx0...) at a zoom level (struct of width and height)."""
    wide = boxes.padded({k: F.col(k) for k in boxes.BOX}, pad)
    out = boxes_.select("*", *[wide[k].alias(f"b_{k}") for k in boxes.BOX], level["width"].alias("pano_w"), level["height"].alias("pano_h"))
    size = {"x": F.col("pano_w"), "y": F.col("pano_h")}
    out = out.select("*", *[(F.col(f"b_f{e[1:]}") * size[e[1]]).cast("int").alias(e) for e in EDGES])
    return out.select("*", *[F.floor(F.col(e) / F.col("tile_size")).cast("int").alias(f"t{e[1:]}") for e in EDGES])


def cropped(boxes_: DataFrame, tiles: DataFrame | Fetch, zoom: int, pad: float = 0.0, straighten: bool = True) -> DataFrame:
    """(panoid, idx, width, height, data) of each box (panoid, idx, box, zooms, tile_size), `data` as rows of BGR bytes.

    Missing tiles stay black, boxes without an area or without the zoom have no row; of
    equal tiles one counts. With `straighten` a crop is turned into perspective where most
    of the picture lies within it.

    `tiles` is a table, or a function by which the executors look up a tile of the zoom.
    Then no pixels but the crops' leave a task, and a tile that no box touches is never read.
    """
    level = boxes.zoom_level(F.col("zooms"), zoom)
    want = placed(boxes_.select("panoid", "idx", *boxes.BOX, "zooms", "tile_size"), level, pad).drop("zooms").filter("px1 > px0 and py1 > py0")
    return _looked_up(want, tiles, straighten) if callable(tiles) else _joined(want, tiles.filter(F.col("zoom") == zoom), straighten)


def _joined(want: DataFrame, tiles: DataFrame, straighten: bool) -> DataFrame:
    each = want.withColumn("x", F.explode(F.sequence("tx0", "tx1"))).withColumn("y", F.explode(F.sequence("ty0", "ty1")))
    # Spark knows nothing of the size of pictures and would send them all to the driver for a broadcast.
    one = tiles.groupBy("panoid", "x", "y").agg(F.min(F.struct("width", "height", "data")).alias("t")).hint("merge")
    keys = want.columns
    # A box touches few tiles, so its list is bounded by the size gate.
    listed = each.join(one, ["panoid", "x", "y"], "left").groupBy(*keys).agg(F.collect_list(F.when(F.col("t.data").isNotNull(), F.struct("x", "y", "t.width", "t.height", "t.data"))).alias("tiles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _written(batch, (_cut(r, (tuple(t.values()) for t in r["tiles"]), straighten) for r in _rows(batch)))

    return listed.mapInArrow(run, CROP)


def _looked_up(want: DataFrame, fetch: Fetch, straighten: bool) -> DataFrame:
    """A panorama's boxes come to one task in the order of their tiles, so each tile is read about once."""
    need = ["panoid", "idx", *boxes.BOX, "tile_size", *EDGES, *([f"b_{k}" for k in boxes.BOX] + ["pano_w", "pano_h"] if straighten else [])]
    rows = want.filter("tile_size is not null").select(*need).repartition("panoid").dropDuplicates(need)
    rows = rows.sortWithinPartitions("panoid", F.floor(F.col("py0") / F.col("tile_size")), "px0").select(*[k for k in need if straighten or k not in boxes.BOX])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = lru_cache(KEPT)(fetch)

        def touched(r: dict) -> Iterator[tuple]:
            size = r["tile_size"]
            for y in range(r["py0"] // size, (r["py1"] - 1) // size + 1):
                for x in range(r["px0"] // size, (r["px1"] - 1) // size + 1):
                    if r["panoid"] is not None and (tile := look(r["panoid"], x, y)):
                        yield x, y, *tile

        for batch in batches:
            yield from _written(batch, (_cut(r, touched(r), straighten) for r in _rows(batch)))

    return rows.mapInArrow(run, CROP)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, no more of them at once than fill BATCH_BYTES."""
    step = max(1, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes))
    for i in range(0, batch.num_rows, step):
        yield from batch.slice(i, step).to_pylist()


def _written(batch: pa.RecordBatch, crops: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The crops of a batch's rows, written out whenever they fill BATCH_BYTES."""
    made, size, done = [], 0, 0
    for m in crops:
        made.append(m)
        size += m.nbytes
        if size >= BATCH_BYTES or done + len(made) == batch.num_rows:
            arrays = [pa.array([m.shape[1] for m in made], pa.int32()), pa.array([m.shape[0] for m in made], pa.int32()), pa.array([m.tobytes() for m in made], pa.binary())]
            of = batch.slice(done, len(made))
            yield pa.RecordBatch.from_arrays([of.column("panoid"), of.column("idx"), *arrays], names=["panoid", "idx", "width", "height", "data"])
            made, size, done = [], 0, done + len(made)


def _cut(r: dict, tiles: Iterable[tuple[int, int, int, int, bytes]], straighten: bool) -> np.ndarray:
    """The crop of a box (a row of `placed`) from its tiles (x, y, width, height, data)."""
    x0, y0, x1, y1 = (r[e] for e in EDGES)
    out = np.zeros((y1 - y0, x1 - x0, 3), np.uint8)
    for x, y, width, height, data in tiles:
        tile = np.frombuffer(data, np.uint8).reshape(height, width, 3)
        left, top = x * r["tile_size"] - x0, y * r["tile_size"] - y0  # of the tile within the crop
        a, b = max(0, left), max(0, top)
        part = tile[b - top : y1 - y0 - top, a - left : x1 - x0 - left]
        out[b : b + part.shape[0], a : a + part.shape[1]] = part
    if straighten:
        out = rectified(out, tuple(r[f"b_{k}"] for k in boxes.BOX), tuple(r[k] for k in boxes.BOX), r["pano_w"], r["pano_h"])
    return np.ascontiguousarray(out)


def png(rgb: np.ndarray) -> bytes:
    """An image file of the pixels, lossless."""
    h, w = rgb.shape[:2]

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = np.zeros((h, 1 + 3 * w), np.uint8)
    lines[:, 1:] = rgb.reshape(h, 3 * w)
    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def encoded(crops: DataFrame) -> DataFrame:
    """(panoid, idx, name, data, body): crops as files, and as base64 for a recogniser's request."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame({"panoid": df["panoid"], "idx": df["idx"], "data": [png(pixels(d, h, w)) for d, h, w in zip(df["data"], df["height"], df["width"])]})

    files = crops.select("panoid", "idx", "width", "height", "data").mapInPandas(run, "panoid string, idx int, data binary")
    name = F.concat("panoid", F.lit("_"), F.col("idx").cast("string"), F.lit(".png"))
    return files.select("panoid", "idx", name.alias("name"), "data", F.regexp_replace(F.base64("data"), r"\s", "").alias("body"))


def verified(crops: DataFrame, text: Column | None = None, zero_shot: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """Crops with their visual statistics and `is_ad`, `ad_score`.

    A zero-shot probability decides where there is one; the visual gate is the fallback for
    rows without it. Broken pixels are no advertisement.
    """
    worded = F.length(F.trim(F.coalesce(text, F.lit("")))) >= 4 if text is not None else F.lit(False)
    seen = with_visual_stats(crops)
    c = F.col
    gate = scoring.visual_gate(c("edge_density"), c("colorfulness"), c("saturation"), c("bright_ratio"), c("dark_ratio"), c("gray_std"), worded)
    p = zero_shot if zero_shot is not None else F.lit(None).cast("double")
    return seen.withColumn("_g", gate).select(
        *seen.columns, F.coalesce(p >= threshold, c("_g.is_ad"), F.lit(False)).alias("is_ad"), F.coalesce(F.bround(p, 3), c("_g.score")).alias("ad_score")
    )
