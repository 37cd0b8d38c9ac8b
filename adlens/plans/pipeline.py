"""Stage composition: boxes and readings to the table of advertisements.

Every stage is a DataFrame function, cheap native predicates first, so Catalyst pushes the
gates below the joins and no reading is looked up for a box that fails them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens import schemas
from adlens.functions import boxes, contacts, geo, text
from adlens.operators import crops, ranking, recognition
from adlens.operators.dictionary import Directory
from adlens.operators.graph import numbered
from adlens.operators.greedy import first_fit_boards
from adlens.session import shared_dir
from adlens.sources import metadata
from adlens.sources.config import Settings

VIEWER = "https://maps.example.net/"


#: What a box needs of its panorama.
OF_PANORAMA = ("panoid", "lon", "lat", "timestamp", "tile_size", "zooms", "azimuth_origin", "address")


def candidates(detections: DataFrame, panoramas: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Boxes worth reading: above the margin, not overlapping a better one, of usable size, best first per panorama."""
    s = settings or Settings()
    d = detections.filter(boxes.margin_rule(F.col("pos_score"), F.col("neg_score"), s.get("detector.pos_strong"), s.get("detector.pos_weak"), s.get("detector.neg_margin")))
    d = d.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    order = F.struct((-F.coalesce("score", F.lit(-1.0))).alias("o"), F.col("idx"), F.col("fx0").alias("t"))
    element = "struct<idx: int, score: double, label: string, fx0: double, fy0: double, fx1: double, fy1: double>"
    listed = d.groupBy("panoid").agg(F.sort_array(F.collect_list(F.struct(order.alias("order"), "idx", "score", "label", *boxes.BOX))).alias("b"))
    plain = F.transform("b", lambda x: F.struct(*[x[k].alias(k) for k in ("idx", "score", "label", *boxes.BOX)]))
    kept = listed.select("panoid", F.explode(boxes.suppressed(plain, element, s.get("detector.iou"))).alias("k")).select("panoid", "k.*")
    one = metadata.earliest(panoramas.filter("status = 'success'").select(*OF_PANORAMA), "panoid")
    sized = kept.join(one, "panoid").withColumn("z", boxes.zoom_level(F.col("zooms"), s.get("panorama.crop_zoom")))
    sized = sized.withColumn("z", F.coalesce("z", boxes.zoom_level(F.col("zooms"), s.get("panorama.overview_zoom"))))
    w, h = boxes.pixel_size({k: F.col(k) for k in boxes.BOX}, F.col("z.width"), F.col("z.height"))
    ok = sized.withColumn("crop_w", w).withColumn("crop_h", h).filter(boxes.size_gate(F.col("crop_w"), F.col("crop_h"), s.get("crop.min_side"), s.get("crop.min_area"), s.get("crop.max_area")))
    return ranking.top_per_group(ok, ["panoid"], [F.desc_nulls_last("score"), F.asc("idx"), F.asc("fx0")], s.get("detector.max_candidates"))


#: Routes of a box to its reading.
CLOUD, FALLBACK, LOW, SPENT = "cloud", "fallback", "skipped-lowres", "skipped-budget"


def routed(boxes_: DataFrame, settings: Settings | None = None, fallback: bool = False, cloud: bool = True) -> DataFrame:
    """Adds `route`: how a box (panoid, idx, crop_w, crop_h, is_ad if verified) comes to be read.

    Boxes that are no advertisement are left out. A paid engine reads crops whose smaller
    side is at least ocr.cloud_min_side, the first ocr.max_cloud_calls_per_panorama of a
    panorama in order of score; the others go to the fallback engine where there is one,
    else they are skipped and stay without text. A free engine reads all.
    """
    s = settings or Settings()
    ads = boxes_.filter(F.coalesce("is_ad", F.lit(False))) if "is_ad" in boxes_.columns else boxes_
    if not cloud:
        return ads.withColumn("route", F.lit(FALLBACK))
    sharp = F.least("crop_w", "crop_h") >= s.get("ocr.cloud_min_side")
    order = [F.desc_nulls_last("score"), F.asc("idx"), F.asc("fx0")]
    marked = ranking.within_budget(ads, ["panoid"], order, ["panoid", "idx", "fx0"], sharp, s.get("ocr.max_cloud_calls_per_panorama"))
    other = F.lit(FALLBACK) if fallback else F.when(sharp, SPENT).otherwise(LOW)
    return marked.withColumn("route", F.when(F.col("granted"), CLOUD).otherwise(other)).drop("granted")


def verified_boxes(boxes_: DataFrame, tiles: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Candidate boxes with `is_ad` from the pixels of their crops; boxes without a tile are none."""
    s = settings or Settings()
    cut = crops.cropped(boxes_, tiles, s.get("panorama.crop_zoom"), s.get("crop.pad"))
    seen = crops.verified(cut.select("panoid", "idx", "width", "height", "data")).select("panoid", "idx", "is_ad", "ad_score")
    return boxes_.join(seen, ["panoid", "idx"], "left").withColumn("is_ad", F.coalesce("is_ad", F.lit(False)))


def assembled(boxes_: DataFrame, readings: DataFrame, directory: Directory | None = None, settings: Settings | None = None) -> DataFrame:
    """Banner rows of candidate boxes and their readings (panoid, idx, result columns, engine).

    Boxes without a reading have empty text; routed boxes (`routed`) that are skipped have
    no reading and their route for an engine. `seq` is free for the caller: it must follow
    the order of arrival.
    """
    if "route" in boxes_.columns:
        skipped = F.col("route").isin(LOW, SPENT)
        read = boxes_.filter(~skipped).drop("route").join(readings, ["panoid", "idx"], "left")
        unread = boxes_.filter(skipped).withColumn("engine", F.col("route")).drop("route")
        return _rows(read.unionByName(unread, allowMissingColumns=True), directory, settings)
    return _rows(boxes_.join(readings, ["panoid", "idx"], "left"), directory, settings)


#: What a stored reading brings to its row, and what it says of its own place and board.
READING = ("text", "advertiser", "category", "construction", "is_realty", "developer", "complex_name", "offer_type", "advertiser_type", "ocr_engine")
PLACE = ("lon", "lat", "timestamp", "address", "score", "banner_id", "bearing_deg", "crop_image_path")


def paired(boxes_: DataFrame, banners: DataFrame) -> DataFrame:
    """Candidate boxes with all stored readings, and a `seq` in order of arrival.

    The boards of a panorama (banner_id) in order of their first reading meet its boxes in
    order of idx; every reading of a board is a row of its box. Readings without a box and
    boxes without a reading are rows too. A reading arrives by its own seq, an unread box
    just after its panorama's first reading, those of unread panoramas last.
    """
    # Places and numbers are found on narrow rows; texts and boxes join them once.
    c, of = F.col, Window.partitionBy("panoid")
    shared_dir(banners.sparkSession)
    known = boxes_.withColumn("box", F.monotonically_increasing_id()).checkpoint()
    b = known.select("panoid", "box", "idx", "fx0", F.row_number().over(of.orderBy("idx", "fx0", "box")).alias("place"))
    r = banners.select("panoid", c("seq").alias("arrival"), "banner_id").withColumn("first", F.min("arrival").over(Window.partitionBy("panoid", "banner_id")))
    r = r.select("panoid", "arrival", F.dense_rank().over(of.orderBy("first", "banner_id")).alias("place"))
    j = b.join(r, ["panoid", "place"], "full")
    came = F.coalesce("arrival", F.min("arrival").over(of), F.lit((1 << 63) - 1))
    j = j.withColumn("order", F.struct(came.alias("came"), c("arrival").isNull().alias("unread"), "panoid", "idx", "fx0", "box"))
    j = numbered(j, ["panoid", "box", "arrival"], "order", "seq")
    stored = banners.select(c("seq").alias("arrival"), *READING[:-1], c("ocr_engine").alias("engine"), *[c(k).alias(f"own_{k}") for k in PLACE])
    j = j.join(stored, "arrival", "left").join(known.drop("panoid", "tile_size", "zooms", "z"), "box", "left")
    for k in PLACE[:5]:
        j = j.withColumn(k, F.when(c("idx").isNull(), c(f"own_{k}")).otherwise(c(k)))
    return j.drop("box", "arrival")


def assembled_readings(boxes_: DataFrame, banners: DataFrame, directory: Directory | None = None, settings: Settings | None = None) -> DataFrame:
    """Banner rows of candidate boxes and all stored readings, as `paired`.

    A reading without a box keeps the board's id, bearing and picture that were stored with it.
    """
    return _rows(paired(boxes_, banners), directory, settings)


def _rows(j: DataFrame, directory: Directory | None, settings: Settings | None) -> DataFrame:
    s = settings or Settings()
    c = F.col
    none = F.lit(None).cast("string")
    own = lambda name, made: F.when(c("idx").isNull(), c(f"own_{name}")).otherwise(made) if f"own_{name}" in j.columns else made
    j = j.withColumn("bearing_deg", own("bearing_deg", geo.azimuth((c("fx0") + c("fx1")) / 2, c("azimuth_origin"))))
    j = j.withColumn("contact", contacts.demoted(contacts.contacts(c("text")), F.least("crop_w", "crop_h"), s.get("contacts.min_side")))
    found = directory.lookup(c("advertiser"), c("complex_name")) if directory else F.lit(None).cast("struct<canonical: string, matched: boolean, role: string, complex_name: string, site: string, phone: string, category: string>")
    j = j.withColumn("b", found)
    matched = F.coalesce(c("b.matched"), F.lit(False))
    f = recognition.fused(c("category"), c("text"), matched, c("b.canonical"), c("developer"), c("complex_name"), c("b.complex_name"), c("advertiser_type"))
    row = {
        "seq": c("seq"), "banner_id": own("banner_id", text.reading_id(c("panoid"), c("fx0"), c("fy0"))), "panoid": c("panoid"), "lon": c("lon"), "lat": c("lat"), "timestamp": c("timestamp"),
        "bearing_deg": c("bearing_deg"), "category": f["category"], "phones": c("contact.phones"), "phones_unreliable": c("contact.phones_unreliable"),
        "sites": c("contact.sites"), "telegram": c("contact.telegram"), "text": F.coalesce("text", F.lit("")), "advertiser": c("advertiser"), "brand": c("b.canonical"),
        "brand_matched": matched, "construction": c("construction"), "is_realty": c("is_realty"), "developer": f["developer"], "complex_name": f["complex_name"],
        "offer_type": c("offer_type"), "advertiser_type": c("advertiser_type"), "personal_ad": f["personal_ad"], "ocr_engine": c("engine"), "dir_site": c("b.site"),
        "dir_phone": c("b.phone"), "address": c("address"), "score": c("score"), "full_image_path": none,
        "crop_image_path": own("crop_image_path", F.concat(F.lit("crops/"), c("panoid"), F.lit("_"), c("idx").cast("string"), F.lit(".jpg"))),
        "source_url": text.deep_link(c("lon"), c("lat"), c("bearing_deg"), VIEWER),
        "dedup_key": text.coarse_key(c("lon"), c("lat"), c("bearing_deg"), f["category"]),
    }
    return j.select(*[row[x.name].cast(x.dataType).alias(x.name) for x in schemas.BANNERS.fields])


def accepted(banners: DataFrame, stored: DataFrame | None = None, settings: Settings | None = None) -> DataFrame:
    """Rows in order of seq that are no duplicates of earlier accepted ones, at most so many of a panorama.

    A row beyond its panorama's cap isn't accepted, so it makes no later row a duplicate.
    """
    s = settings or Settings()
    radii = {"radius_m": s.get("dedup.radius_m"), "phone_radius_m": s.get("dedup.phone_radius_m"), "assumed_m": s.get("dedup.assumed_distance_m")}
    return first_fit_boards(banners, stored, group="panoid", cap=s.get("detector.max_per_panorama"), **radii)
