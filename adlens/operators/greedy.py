"""Order-exact greedy selection: first-fit duplicates and crawl spacing.

Both decide rows in order of arrival, each by what was decided before it. Here they run in
rounds over an edge table: a row is decided as soon as its earlier neighbours are, so the
result equals the sequential loop's at any partitioning. Rounds are cut by checkpoint(),
which survives lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import geo
from adlens.operators.neighbors import pairs_within
from adlens.operators.ranking import top_per_group
from adlens.session import shared_dir


#: Conflicts that one task decides in order; more are first thinned by joined rounds.
TAIL = 300_000


def first_fit(nodes: DataFrame, edges: DataFrame, group: str | None = None, cap: int | None = None, tail: int = TAIL, max_rounds: int = 1000) -> DataFrame:
    """(seq) of the kept: rows without an earlier kept neighbour, at most `cap` of a group.

    `nodes` has a unique `seq` (and `group`); `edges` (earlier, later) join rows that exclude
    each other. A row over the cap isn't kept, so it excludes nothing. A round rejects all
    rows next to one that is certainly kept, and drops every edge of a rejected row, so it
    reads undecided conflicts only; at most `tail` of them are left to one task, which
    decides them in order. Every round decides at least the earliest open conflict. Null
    ids are dropped, rows of a null group aren't capped, an empty table keeps nothing.
    """
    shared_dir(nodes.sparkSession)
    of = F.col(group) if group and cap is not None else F.lit(None).cast("string")
    ids = nodes.select(F.col("seq").cast("long").alias("seq"), of.cast("string").alias("of")).filter("seq is not null")
    ids = ids.groupBy("seq").agg(F.min("of").alias("of"))
    if cap is not None:
        ids = ids.checkpoint()  # read in every round
    edges = edges.select("earlier", "later").distinct()
    known = ids.select("seq")
    edges = edges.join(known.withColumnRenamed("seq", "earlier"), "earlier", "left_semi").join(known.withColumnRenamed("seq", "later"), "later", "left_semi").checkpoint()
    rejected: list[DataFrame] = []
    for _ in range(max_rounds):
        if edges.limit(tail + 1).count() <= tail:
            break
        certain = edges.select("earlier").distinct().join(edges.select(F.col("later").alias("earlier")), "earlier", "left_anti")
        over = None
        if cap is not None:
            alive = _without(ids.filter("of is not null"), rejected, "seq")
            allowed = top_per_group(alive, ["of"], [F.asc("seq")], cap).checkpoint()
            waits = allowed.join(edges.select(F.col("later").alias("seq")).distinct(), "seq", "left_semi").select("of").distinct()
            full = allowed.groupBy("of").agg(F.count("*").alias("n"), F.max("seq").alias("last")).filter(F.col("n") >= cap).join(waits, "of", "left_anti")
            over = alive.join(full, "of").filter(F.col("seq") > F.col("last")).select("seq").checkpoint()
            free = ids.filter("of is null").select("seq").unionByName(allowed.select("seq"))
            certain = certain.join(free.withColumnRenamed("seq", "earlier"), "earlier", "left_semi")
        blocked = edges.join(certain, "earlier", "left_semi").select(F.col("later").alias("seq")).distinct().checkpoint()
        out = [blocked] if over is None else [blocked, over]
        rejected += out
        edges = _without(_without(edges, out, "later"), out, "earlier").checkpoint()
    else:
        raise RuntimeError("conflict chains are longer than max_rounds")
    alive = _without(ids, rejected, "seq")
    lost = _decided_in_order(alive, edges, cap)
    alive = alive.join(lost, "seq", "left_anti")
    if cap is None:
        return alive.select("seq")
    # Rows in conflict are decided with the cap; this drops the free ones beyond it.
    capped = top_per_group(alive.filter("of is not null"), ["of"], [F.asc("seq")], cap)
    return alive.filter("of is null").select("seq").unionByName(capped.select("seq"))


def _without(rows: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    for p in parts:
        rows = rows.join(p.select(F.col("seq").alias(key)), key, "left_anti")
    return rows


def _decided_in_order(alive: DataFrame, edges: DataFrame, cap: int | None) -> DataFrame:
    """(seq) that the edges left, and the cap, reject: one task goes through them by seq.

    With a cap the task also gets the groups of rows in conflict, and the first `cap` rows
    without a conflict of these groups: later ones find their group full already.
    """
    conflicts = edges.select(F.col("later").alias("seq"), F.col("earlier").alias("by"), F.lit(None).cast("string").alias("of"))
    if cap is not None:
        ends = edges.select(F.explode(F.array("earlier", "later")).alias("seq")).distinct()
        grouped = alive.filter("of is not null")
        mixed = grouped.join(ends, "seq", "left_semi").checkpoint()
        free = grouped.join(mixed.select("of").distinct(), "of", "left_semi").join(ends, "seq", "left_anti")
        sent = mixed.unionByName(top_per_group(free, ["of"], [F.asc("seq")], cap))
        conflicts = conflicts.unionByName(sent.select("seq", F.col("seq").alias("by"), "of"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts).sort_values("seq", kind="stable")
        lost: set[int] = set()
        taken: dict[str, int] = {}
        now, of, blocked = None, None, False

        def decide() -> None:
            full = of is not None and taken.get(of, 0) >= cap
            if blocked or full:
                lost.add(now)
            elif of is not None:
                taken[of] = taken.get(of, 0) + 1

        for seq, by, group in zip(rows["seq"].tolist(), rows["by"].tolist(), rows["of"].tolist()):
            if seq != now:
                if now is not None:
                    decide()
                now, of, blocked = seq, None, False
            of = group if isinstance(group, str) else of
            blocked |= by != seq and by not in lost
        decide()
        yield pd.DataFrame({"seq": np.fromiter(lost, np.int64, len(lost))})

    return conflicts.coalesce(1).mapInPandas(run, "seq long").checkpoint()


def _in_search_box(a_lon: Column, a_lat: Column, lon: Column, lat: Column, reach: float) -> Column:
    """Camera a lies in the box around the later camera."""
    dlat = reach / geo.METRES_PER_DEGREE
    dlon = reach / (geo.METRES_PER_DEGREE * F.greatest(F.lit(0.1), F.cos(F.radians(lat))))
    return a_lat.between(lat - dlat, lat + dlat) & a_lon.between(lon - dlon, lon + dlon)


def duplicate_edges(rows: DataFrame, radius_m: float = 25.0, phone_radius_m: float = 300.0, assumed_m: float = 25.0) -> DataFrame:
    """(earlier, later) of readings that may be one board.

    Boards within `radius_m`, or within `phone_radius_m` when they share a phone; a shared
    phone farther off isn't a duplicate even within `radius_m`. The earlier camera must lie
    in the later one's search box. Columns: seq, lon, lat, bearing_deg, phones. Rows without
    a position have no edges; null and empty phone lists share nothing.
    """
    phones = F.filter(F.transform(F.coalesce("phones", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    placed = rows.filter(geo.valid_position(F.col("lon"), F.col("lat"))).select(
        F.col("seq").cast("long").alias("seq"), "lon", "lat", F.array_distinct(phones).alias("phones"),
        geo.sign_lon(F.col("lon"), F.col("lat"), F.col("bearing_deg"), assumed_m).alias("x"),
        geo.sign_lat(F.col("lat"), F.col("bearing_deg"), assumed_m).alias("y"),
    )
    near = pairs_within(placed, "seq", F.col("x"), F.col("y"), F.col("seq"), radius_m).toDF("earlier", "later")
    # A phone key is cut by a coarse grid, so a nationwide number is no hot key. Columns of a
    # row are as wide as the radius on the row's most polar edge.
    step = phone_radius_m * 1.001 / geo.METRES_PER_DEGREE
    wide = lambda r: F.lit(step) / F.greatest(F.cos(F.radians(F.least((F.abs(r) + 2) * step, F.lit(89.9)))), F.lit(1e-3))
    near_by = F.sequence(F.lit(-1), F.lit(1))
    cells = placed.withColumn("phone", F.explode("phones")).select("seq", "phone", "x", "y")
    later = cells.select(F.col("seq").alias("later"), "phone", F.col("x").alias("lx"), F.col("y").alias("ly"), F.floor(F.col("y") / step).alias("row"))
    later = later.withColumn("col", F.floor(F.col("lx") / wide(F.col("row"))))
    earlier = cells.select(F.col("seq").alias("earlier"), "phone", F.col("x").alias("ex"), F.col("y").alias("ey"), F.explode(F.transform(near_by, lambda i: F.floor(F.col("y") / step) + i)).alias("row"))
    earlier = earlier.withColumn("col", F.explode(F.transform(near_by, lambda i: F.floor(F.col("ex") / wide(F.col("row"))) + i)))
    d = geo.distance_m(F.col("ex"), F.col("ey"), F.col("lx"), F.col("ly"))
    called = earlier.join(later, ["phone", "row", "col"]).filter((F.col("earlier") < F.col("later")) & (d <= phone_radius_m)).select("earlier", "later")
    pairs = near.unionByName(called).distinct()
    a, b = placed.alias("a"), placed.alias("b")
    full = pairs.join(a, F.col("earlier") == F.col("a.seq")).join(b, F.col("later") == F.col("b.seq"))
    metres = geo.distance_m(F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y"))
    limit = F.when(F.arrays_overlap("a.phones", "b.phones"), phone_radius_m).otherwise(radius_m)
    reach = max(radius_m, phone_radius_m) + assumed_m
    boxed = _in_search_box(F.col("a.lon"), F.col("a.lat"), F.col("b.lon"), F.col("b.lat"), reach)
    return full.filter((metres <= limit) & boxed).select("earlier", "later")


def first_fit_boards(rows: DataFrame, stored: DataFrame | None = None, group: str | None = None, cap: int | None = None, **radii: float) -> DataFrame:
    """Readings kept in order of seq, duplicates of earlier kept ones left out, at most `cap` of a `group`.

    With `stored` (readings kept before, of smaller seq) the batch is also checked against
    it: equal to one long run when batches come in order. The cap counts the batch's own
    rows; a row over it is not kept and so rejects nothing. Rows without a position are
    duplicates of none.
    """
    shared_dir(rows.sparkSession)
    if cap is None or group is None:
        group = cap = None
    spots = first_of_spot(rows, group).checkpoint()  # read by every part of the edge join
    places = spots.drop(group) if group else spots
    free = _unplaced(rows, group)
    if stored is None:
        new, edges = spots, duplicate_edges(places, **radii)
    else:
        both = stored.select(*SPOT).unionByName(spots.select(*SPOT))
        found = duplicate_edges(both, **radii).checkpoint()
        known = found.join(stored.select(F.col("seq").alias("earlier")), "earlier", "left_semi").select(F.col("later").alias("seq")).distinct()
        new = spots.join(known, "seq", "left_anti").join(stored.select("seq"), "seq", "left_anti")
        edges = found
    if cap is None:
        kept = first_fit(new, edges).unionByName(free)
    else:
        kept = first_fit(new.select("seq", group).unionByName(free), edges, group, cap)
    return rows.join(kept, "seq", "left_semi")


SPOT = ("seq", "lon", "lat", "bearing_deg", "phones")


def _unplaced(rows: DataFrame, group: str | None = None) -> DataFrame:
    lost = rows.filter(~F.coalesce(geo.valid_position(F.col("lon"), F.col("lat")), F.lit(False)))
    return lost.select(F.col("seq").cast("long").alias("seq"), *([group] if group else []))


def first_of_spot(rows: DataFrame, group: str | None = None) -> DataFrame:
    """The first of readings equal in position, bearing and phones (and group), by a combining aggregate.

    Whatever rejects the first rejects its equals, and if nothing does, the first itself
    does; so groups of copies need no edges, however large they are.
    """
    phones = F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce("phones", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")))
    placed = rows.filter(geo.valid_position(F.col("lon"), F.col("lat")))
    key = [*SPOT[1:], *([group] if group else [])]
    return placed.select("seq", *SPOT[1:4], phones.alias("phones"), *key[4:]).groupBy(*key).agg(F.min("seq").cast("long").alias("seq")).select("seq", *key)


def spaced(points: DataFrame, metres: float, guards: DataFrame | None = None, max_rounds: int = 1000) -> DataFrame:
    """(seq, recorded) of points kept: no earlier recorded point of the 3x3 cells is nearer than `metres`.

    A kept point is recorded unless its cell already has a recorded one, so a second point
    of a cell is kept without guarding its surroundings. Columns: seq, lon, lat; points
    without a position are left out. `guards` (same columns, smaller seq) were recorded
    before; they guard, but aren't given again.
    """
    shared_dir(points.sparkSession)
    every = points.select(F.col("seq").cast("long").alias("seq"), "lon", "lat", F.lit(False).alias("fixed"))
    if guards is not None:
        every = every.unionByName(guards.select(F.col("seq").cast("long").alias("seq"), "lon", "lat", F.lit(True).alias("fixed")))
    p = every.filter(geo.valid_position(F.col("lon"), F.col("lat")))
    p = p.withColumn("row", geo.cell_row(F.col("lat"), metres)).withColumn("col", geo.cell_col(F.col("lon"), F.col("lat"), metres)).checkpoint()
    off = F.sequence(F.lit(-1), F.lit(1))
    around = F.explode(F.flatten(F.transform(off, lambda i: F.transform(off, lambda j: F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col"))))))
    seen = p.select(F.col("seq").alias("later"), F.col("lon").alias("l_lon"), F.col("lat").alias("l_lat"), F.col("row").alias("l_row"), F.col("col").alias("l_col"), around.alias("c"))
    met = seen.join(p.select(F.col("seq").alias("earlier"), "lon", "lat", F.col("row").alias("e_row"), F.col("col").alias("e_col")), (F.col("c.row") == F.col("e_row")) & (F.col("c.col") == F.col("e_col")))
    near = geo.distance_m(F.col("lon"), F.col("lat"), F.col("l_lon"), F.col("l_lat")) < metres
    same = (F.col("e_row") == F.col("l_row")) & (F.col("e_col") == F.col("l_col"))
    edges = met.filter(F.col("earlier") < F.col("later")).select("earlier", "later", near.alias("near"), same.alias("same")).filter("near or same").checkpoint()
    # state: kept and recorded are null while unknown.
    bound = edges.select(F.col("later").alias("seq")).distinct().withColumn("bound", F.lit(True))
    known = F.when(F.col("fixed") | F.col("bound").isNull(), True)
    state = p.select("seq", "fixed").join(bound, "seq", "left").select("seq", "fixed", known.alias("kept"), known.alias("recorded")).checkpoint()
    for _ in range(max_rounds):
        if state.filter("recorded is null").isEmpty():
            break
        of = edges.join(state.select(F.col("seq").alias("earlier"), F.col("recorded").alias("r")), "earlier")
        told = of.groupBy("later").agg(
            F.max(F.when(F.col("near") & F.col("r"), True)).alias("blocked"),
            F.max(F.when(F.col("near") & F.col("r").isNull(), True)).alias("open_near"),
            F.max(F.when(F.col("same") & F.col("r"), True)).alias("taken"),
            F.max(F.when(F.col("same") & F.col("r").isNull(), True)).alias("open_same"),
        )
        s = state.join(told.withColumnRenamed("later", "seq"), "seq", "left")
        kept = F.coalesce("kept", F.when(F.col("blocked"), False).when(F.col("open_near").isNull(), True))
        s = s.withColumn("kept", kept)
        recorded = F.coalesce("recorded", F.when(~F.col("kept") | F.col("taken"), False).when(F.col("kept") & F.col("open_same").isNull(), True))
        state = s.select("seq", "fixed", "kept", recorded.alias("recorded")).checkpoint()
    else:
        raise RuntimeError("spacing chains are longer than max_rounds")
    return state.filter("kept and not fixed").select("seq", "recorded")
