"""Boxes in normalised panorama coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zoom_level(zooms: Column, level: int) -> Column:
    """struct<level,width,height> of a level; null if the panorama hasn't got it."""
    return F.get(F.filter(zooms, lambda z: z["level"] == level), F.lit(0))


def max_zoom(zooms: Column) -> Column:
    """The finest level is the smallest number."""
    return F.array_min(F.transform(zooms, lambda z: z["level"]))


def clamped(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def padded(box: dict[str, Column], pad: float, of_box: bool = True) -> dict[str, Column]:
    """Box grown by a fraction of itself (or of the panorama), kept within [0, 1]."""
    dx = (box["fx1"] - box["fx0"]) * pad if of_box else F.lit(pad)
    dy = (box["fy1"] - box["fy0"]) * pad if of_box else F.lit(pad)
    return {
        "fx0": F.greatest(F.lit(0.0), box["fx0"] - dx), "fy0": F.greatest(F.lit(0.0), box["fy0"] - dy),
        "fx1": F.least(F.lit(1.0), box["fx1"] + dx), "fy1": F.least(F.lit(1.0), box["fy1"] + dy),
    }


def pixel_size(box: dict[str, Column], width: Column, height: Column, pad: float = 0.0) -> tuple[Column, Column]:
    """Pixels of a crop, truncated, known before any tile is read."""
    b = padded(box, pad, of_box=False)
    return ((b["fx1"] - b["fx0"]) * width).cast("int"), ((b["fy1"] - b["fy0"]) * height).cast("int")


def size_gate(w: Column, h: Column, min_side: int = 30, min_area: int = 1200, max_area: int | None = 800_000) -> Column:
    ok = (F.least(w, h) >= min_side) & (w * h >= min_area)
    return ok & (w * h <= max_area) if max_area else ok


def tile_range(box: dict[str, Column], width: Column, height: Column, tile: Column) -> Column:
    """struct<tx0,ty0,tx1,ty1> of the tiles that a crop touches, ends included."""
    px = lambda c, n: F.floor((c * n).cast("int") / tile).cast("int")
    return F.struct(px(box["fx0"], width).alias("tx0"), px(box["fy0"], height).alias("ty0"), px(box["fx1"], width).alias("tx1"), px(box["fy1"], height).alias("ty1"))


def margin_rule(pos: Column, neg: Column, strong: float = 0.25, weak: float = 0.10, margin: float = 0.10) -> Column:
    """A strong positive passes; a weak one unless a distractor beats it by more than the margin.

    A missing distractor score (null or NaN) doesn't beat anything; a missing positive fails.
    """
    beaten = F.coalesce(F.nanvl(neg, F.lit(float("-inf"))), F.lit(float("-inf"))) > pos + margin
    passes = (pos >= strong) | ((pos >= weak) & ~beaten)
    return F.coalesce(passes & ~F.isnan(pos), F.lit(False))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two box structs; 0 if disjoint."""
    w = F.greatest(F.lit(0.0), F.least(a["fx1"], b["fx1"]) - F.greatest(a["fx0"], b["fx0"]))
    h = F.greatest(F.lit(0.0), F.least(a["fy1"], b["fy1"]) - F.greatest(a["fy0"], b["fy0"]))
    inter = w * h
    area = lambda x: (x["fx1"] - x["fx0"]) * (x["fy1"] - x["fy0"])
    return F.when(inter == 0, F.lit(0.0)).otherwise(F.try_divide(inter, area(a) + area(b) - inter))


BOX = ("fx0", "fy0", "fx1", "fy1")


def suppressed(sorted_boxes: Column, element: str, threshold: float) -> Column:
    """Greedy fold over boxes in order of preference: kept are those that overlap none kept."""
    none = F.array().cast(f"array<{element}>")
    return F.aggregate(
        sorted_boxes,
        none,
        lambda kept, d: F.when(F.exists(kept, lambda k: F.coalesce(iou(d, k), F.lit(0.0)) >= threshold), kept).otherwise(F.concat(kept, F.array(d))),
    )
