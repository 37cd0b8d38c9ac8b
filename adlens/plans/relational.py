"""Queries of joins, aggregates, windows, state and lookups, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import boxes, geo, text
from adlens.operators import evaluation, ranking, recognition, state
from adlens.operators.dictionary import Directory
from adlens.plans.export import by_category, category_counts, is_realty, presentation, realty
from adlens.plans.scalars import category_sql
from adlens.session import spread, table
from adlens.sources import metadata, seeds

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- aggregates --------------------------------------------------------------------------


@query("SELECT category, count(*) AS n FROM banners GROUP BY category")
def q_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return category_counts(table(spark, sf, "banners"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE brand_matched) AS matched, count(*) FILTER (WHERE personal_ad) AS personal, count(*) FILTER (WHERE len(phones) > 0) AS with_phone FROM banners")
def q_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "banners").agg(F.count("*").alias("total"), F.count_if("brand_matched").alias("matched"), F.count_if("personal_ad").alias("personal"), F.count_if(F.size("phones") > 0).alias("with_phone"))


_ONE = "WITH p AS (SELECT panoid, any_value(list_filter(zooms, lambda z: z.level = 2)[1]) AS z FROM panoramas GROUP BY panoid)"
_W = "CAST(trunc((least(1.0, fx1) - greatest(0.0, fx0)) * z.width) AS INT)"
_H = "CAST(trunc((least(1.0, fy1) - greatest(0.0, fy0)) * z.height) AS INT)"
_MARGIN = "(pos_score >= 0.25 OR (pos_score >= 0.10 AND (neg_score IS NULL OR lower(CAST(neg_score AS VARCHAR)) LIKE '%nan%' OR neg_score <= pos_score + 0.10)))"


@query(
    f"""{_ONE} SELECT label, count(*) AS raw, count(*) FILTER (WHERE m) AS above_margin, count(*) FILTER (WHERE m AND g) AS above_size FROM (
  SELECT label, {_MARGIN} AS m, coalesce(least({_W}, {_H}) >= 30 AND {_W} * {_H} >= 1200 AND {_W} * {_H} <= 800000, false) AS g FROM detections LEFT JOIN p USING (panoid)) GROUP BY label"""
)
def q_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes left after each gate, in one pass."""
    p = metadata.earliest(table(spark, sf, "panoramas"), "panoid").select("panoid", boxes.zoom_level(F.col("zooms"), 2).alias("z"))
    d = table(spark, sf, "detections").join(p, "panoid", "left")
    w, h = boxes.pixel_size({k: F.col(k) for k in boxes.BOX}, F.col("z.width"), F.col("z.height"))
    gates = d.select("label", boxes.margin_rule(F.col("pos_score"), F.col("neg_score")).alias("m"), F.coalesce(boxes.size_gate(w, h), F.lit(False)).alias("g"))
    return gates.groupBy("label").agg(F.count("*").alias("raw"), F.count_if("m").alias("above_margin"), F.count_if(F.col("m") & F.col("g")).alias("above_size"))


@query("SELECT engine, count(*) AS n, count(DISTINCT key) AS keys, count(*) - count(DISTINCT key) AS repeats FROM ocr_cache GROUP BY engine")
def q_cache_counts(spark: SparkSession, sf: str) -> DataFrame:
    k = table(spark, sf, "ocr_cache").groupBy("engine", "key").agg(F.count("*").alias("n"))
    return k.groupBy("engine").agg(F.sum("n").alias("n"), F.count("key").alias("keys"), (F.sum("n") - F.count("key")).alias("repeats"))


@query(
    r"""WITH c AS (SELECT engine, sha256(text) AS k, arg_min(struct_pack(text := text, advertiser := advertiser, category := category, usage := usage, created := created), (created, key)) AS r FROM ocr_cache WHERE text IS NOT NULL GROUP BY engine, k),
b AS (SELECT ocr_engine AS engine, sha256(text) AS k, arg_min(struct_pack(text := text, advertiser := advertiser, category := category), seq) AS t FROM banners WHERE text IS NOT NULL GROUP BY engine, k),
j AS (SELECT engine, r.text AS g0, t.text AS t0, r.created % 10 AS seconds, coalesce(TRY_CAST(CASE WHEN json_valid(r.usage) THEN json_extract_string(r.usage, '$.input_tokens') END AS BIGINT), 0) AS ti,
  coalesce(TRY_CAST(CASE WHEN json_valid(r.usage) THEN json_extract_string(r.usage, '$.output_tokens') END AS BIGINT), 0) AS tok, coalesce(t.advertiser, '') AS ea, coalesce(r.advertiser, '') AS ga, coalesce(t.category, '') AS ec, coalesce(r.category, '') AS gc FROM c JOIN b USING (engine, k)),
n AS (SELECT *, trim(regexp_replace(replace(lower(t0), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')) AS truth, trim(regexp_replace(replace(lower(g0), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')) AS got FROM j),
w AS (SELECT *, list_filter(string_split(truth, ' '), lambda x: length(x) >= 3) AS ws FROM n)
SELECT engine, count(*) AS n, round(avg(CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda x: contains(got, x))) / len(ws) END), 6) AS recall,
  round(100.0 * avg(CAST(CASE WHEN ea = '' THEN ga = '' ELSE ga <> '' AND contains(trim(regexp_replace(replace(lower(ga), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')), trim(regexp_replace(replace(lower(ea), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g'))) END AS INT)), 6) AS advertiser_ok,
  round(100.0 * avg(CAST(CASE WHEN ec = '' THEN gc = '' ELSE gc <> '' AND contains(trim(regexp_replace(replace(lower(gc), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')), trim(regexp_replace(replace(lower(ec), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g'))) END AS INT)), 6) AS category_ok,
  round(avg(seconds), 6) AS seconds, round((sum(ti) * 3.0 + sum(tok) * 15.0) / 1e6 / count(*) * 100000, 6) AS cost_per_100k FROM w GROUP BY engine"""
)
def q_engine_report(spark: SparkSession, sf: str) -> DataFrame:
    """Cached answers beside the stored readings of the same content, by engine."""
    fields, key = ("text", "advertiser", "category"), F.sha2("text", 256).alias("k")
    c = table(spark, sf, "ocr_cache").filter("text is not null").groupBy("engine", key).agg(F.min_by(F.struct(*fields, "usage", "created"), F.struct("created", "key")).alias("r"))
    b = table(spark, sf, "banners").filter("text is not null").groupBy(F.col("ocr_engine").alias("engine"), key).agg(F.min_by(F.struct(*fields), F.col("seq")).alias("t"))
    used = text.usage_counts(F.col("r.usage"))
    pairs = c.join(b, ["engine", "k"]).select(
        "engine", *[F.col(f"r.{f}").alias(f) for f in fields], *[F.col(f"t.{f}").alias(f"true_{f}") for f in fields], F.lit(False).alias("failed"),
        (F.col("r.created") % 10).alias("seconds"), used["input_tokens"].alias("input_tokens"), used["output_tokens"].alias("output_tokens"),
    )
    return evaluation.engine_report(pairs, 3.0, 15.0)


# --- windows -----------------------------------------------------------------------------


@query(
    """SELECT panoid, idx, score FROM (SELECT *, row_number() OVER (PARTITION BY panoid ORDER BY CASE WHEN isnan(score) THEN -1 ELSE coalesce(score, -1) END DESC, idx, fx0, fy0) AS r FROM detections) WHERE r <= 3"""
)
def q_top_candidates(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "detections").withColumn("s", F.coalesce(F.nanvl("score", F.lit(-1.0)), F.lit(-1.0)))
    return ranking.top_per_group(d, ["panoid"], [F.desc("s"), F.asc("idx"), F.asc("fx0"), F.asc("fy0")], 3).select("panoid", "idx", "score")


@query(
    """SELECT o_orderkey, e AND r <= 2 AS granted FROM (SELECT o_orderkey, o_orderstatus = 'O' AS e,
  row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)"""
)
def q_budget(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return ranking.within_budget(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], ["o_orderkey"], F.col("o_orderstatus") == "O", 2).select("o_orderkey", "granted")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1")
def q_ordered_distinct(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return ranking.first_of_key(e, ["user_id", "event_type"], "event_id")


@query("SELECT banner_id, seq, panoid, text FROM (SELECT *, row_number() OVER (PARTITION BY banner_id ORDER BY seq DESC) AS r FROM banners) WHERE r = 1")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "banners").select("banner_id", "seq", "panoid", "text")
    return ranking.latest_of_key(b, ["banner_id"], "seq")


# --- greedy suppression within a group -----------------------------------------------------


@query(
    """WITH s AS (SELECT panoid, list({'idx': idx, 'fx0': fx0, 'fy0': fy0, 'fx1': fx1, 'fy1': fy1} ORDER BY CASE WHEN isnan(score) THEN -1 ELSE coalesce(score, -1) END DESC, idx, fx0) AS b FROM detections GROUP BY panoid),
f AS (SELECT panoid, list_reduce(b, lambda kept, d: CASE WHEN len(list_filter(kept, lambda k:
    greatest(0, least(d.fx1, k.fx1) - greatest(d.fx0, k.fx0)) * greatest(0, least(d.fy1, k.fy1) - greatest(d.fy0, k.fy0)) > 0 AND
    greatest(0, least(d.fx1, k.fx1) - greatest(d.fx0, k.fx0)) * greatest(0, least(d.fy1, k.fy1) - greatest(d.fy0, k.fy0)) >= 0.4 *
    ((d.fx1 - d.fx0) * (d.fy1 - d.fy0) + (k.fx1 - k.fx0) * (k.fy1 - k.fy0) - greatest(0, least(d.fx1, k.fx1) - greatest(d.fx0, k.fx0)) * greatest(0, least(d.fy1, k.fy1) - greatest(d.fy0, k.fy0))))) > 0
  THEN kept ELSE list_append(kept, d) END, []) AS kept FROM (SELECT panoid, list_transform(b, lambda x: x) AS b FROM s))
SELECT panoid, k.idx AS idx FROM (SELECT panoid, unnest(kept) AS k FROM f)"""
)
def q_suppression(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes kept in order of score: those that overlap no kept one by 0.4 or more."""
    d = table(spark, sf, "detections").withColumn("s", F.coalesce(F.nanvl("score", F.lit(-1.0)), F.lit(-1.0)))
    order = F.struct((-F.col("s")).alias("o"), F.col("idx"), F.col("fx0").alias("t"))
    rows = d.groupBy("panoid").agg(F.sort_array(F.collect_list(F.struct(order.alias("order"), "idx", *boxes.BOX))).alias("b"))
    plain = F.transform("b", lambda x: F.struct(x["idx"].alias("idx"), *[x[k].alias(k) for k in boxes.BOX]))
    kept = boxes.suppressed(plain, "struct<idx: int, fx0: double, fy0: double, fx1: double, fy1: double>", 0.4)
    return rows.select("panoid", F.explode(kept).alias("k")).select("panoid", "k.idx")


# --- lookups and cache -------------------------------------------------------------------


_NORM = "trim(regexp_replace(replace(lower(coalesce({0}, '')), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g'))"
_LOOKUP = f"""WITH a AS (SELECT k, arg_max(canonical, (brand_id, i)) AS canonical FROM (
  SELECT brand_id, canonical, {_NORM.format("s")} AS k, i FROM (SELECT brand_id, canonical, unnest(list_prepend(canonical, coalesce(aliases, []))) AS s,
  generate_subscripts(list_prepend(canonical, coalesce(aliases, [])), 1) AS i FROM brands)) WHERE k <> '' GROUP BY k),
x AS (SELECT k, arg_max(canonical, (brand_id, i)) AS canonical, arg_max(s, (brand_id, i)) AS complex FROM (SELECT brand_id, canonical, s, {_NORM.format("s")} AS k, i FROM
  (SELECT brand_id, canonical, unnest(complexes) AS s, generate_subscripts(complexes, 1) AS i FROM brands)) WHERE k <> '' GROUP BY k),
v AS (SELECT DISTINCT advertiser, complex_name FROM banners),
n AS (SELECT advertiser, complex_name, {_NORM.format("advertiser")} AS ka, {_NORM.format("complex_name")} AS kc FROM v),
h AS (SELECT n.*,
  (SELECT min({{'p': CASE WHEN x.k = kc THEN 0 ELSE 1 END, 'l': -length(x.k), 'canonical': x.canonical, 'complex': x.complex}}) FROM x WHERE kc <> '' AND (x.k = kc OR (length(x.k) >= 5 AND contains(kc, x.k)))) AS xc,
  (SELECT min({{'p': CASE WHEN x.k = ka THEN 0 ELSE 1 END, 'l': -length(x.k), 'canonical': x.canonical, 'complex': x.complex}}) FROM x WHERE ka <> '' AND (x.k = ka OR (length(x.k) >= 5 AND contains(ka, x.k)))) AS xa,
  (SELECT min({{'p': CASE WHEN a.k = ka THEN 0 ELSE 1 END, 'l': -length(a.k), 'canonical': a.canonical}}) FROM a WHERE ka <> '' AND (a.k = ka OR (length(a.k) >= 3 AND contains(' ' || ka || ' ', ' ' || a.k || ' ')))) AS al FROM n)
SELECT b.seq, coalesce(xc.canonical, xa.canonical, al.canonical, CASE WHEN ka <> '' THEN regexp_replace(b.advertiser, '^[\\s\\p{{Z}}\\x{{85}}]+|[\\s\\p{{Z}}\\x{{85}}]+$', '', 'g') END) AS canonical,
  coalesce(xc.canonical, xa.canonical, al.canonical) IS NOT NULL AS matched, CASE WHEN xc IS NOT NULL THEN xc.complex ELSE xa.complex END AS complex_name
FROM banners b JOIN h ON b.advertiser IS NOT DISTINCT FROM h.advertiser AND b.complex_name IS NOT DISTINCT FROM h.complex_name"""


@query(_LOOKUP)
def q_brand_lookup(spark: SparkSession, sf: str) -> DataFrame:
    d = Directory.from_table(table(spark, sf, "brands"))
    b = spread(table(spark, sf, "banners").select("seq", "advertiser", "complex_name")).select("seq", d.lookup(F.col("advertiser"), F.col("complex_name")).alias("b"))
    return b.select("seq", "b.canonical", "b.matched", "b.complex_name")


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "banners").select("seq", F.concat("ocr_engine", F.lit(":"), F.sha2("text", 256)).alias("key"))


_CACHE = """WITH c AS (SELECT engine || ':' || sha256(text) AS k, arg_min(advertiser, (created, key)) AS advertiser, min(created) AS created FROM ocr_cache WHERE text IS NOT NULL GROUP BY k)
"""


@query(_CACHE + "SELECT b.seq, c.k IS NOT NULL AS hit FROM banners b LEFT JOIN c ON c.k = b.ocr_engine || ':' || sha256(b.text)")
def q_cache_join(spark: SparkSession, sf: str) -> DataFrame:
    """Readings found in the cache by the content of their text."""
    c = table(spark, sf, "ocr_cache").withColumn("key", F.concat("engine", F.lit(":"), F.sha2("text", 256)))
    return recognition.cached(_keyed(spark, sf), c).select("seq", "hit")


@query(_CACHE + "SELECT b.ocr_engine AS engine, count(c.k) AS hits, count(*) - count(c.k) AS misses FROM banners b LEFT JOIN c ON c.k = b.ocr_engine || ':' || sha256(b.text) GROUP BY engine")
def q_cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    """How often the cache answers, by engine."""
    c = table(spark, sf, "ocr_cache").withColumn("key", F.concat("engine", F.lit(":"), F.sha2("text", 256)))
    asked = table(spark, sf, "banners").select(F.col("ocr_engine").alias("by"), F.concat("ocr_engine", F.lit(":"), F.sha2("text", 256)).alias("key"))
    return recognition.cached(asked, c).groupBy(F.col("by").alias("engine")).agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))


@query("SELECT key, arg_max(engine, created) AS engine, max(created) AS created FROM (SELECT key, engine, created FROM ocr_cache UNION ALL SELECT key, 'again', created + 1 FROM ocr_cache WHERE engine = 'vlm-a') GROUP BY key")
def q_cache_insert(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "ocr_cache").select("key", "engine", "created")
    new = c.filter("engine = 'vlm-a'").select("key", F.lit("again").alias("engine"), (F.col("created") + 1).alias("created"))
    return recognition.cache_insert(c, new)


@query(
    "WITH k AS (" + category_sql("text") + ") "
    + """SELECT seq, coalesce(nullif(b.category, ''), k.category) AS category, coalesce(CASE WHEN brand_matched THEN brand END, nullif(developer, '')) AS developer,
  coalesce(nullif(complex_name, ''), 'нет') AS complex_name, starts_with(lower(coalesce(advertiser_type, '')), 'частн') AS personal_ad FROM banners b JOIN k USING (seq)"""
)
def q_fused_fields(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    f = recognition.fused(c("category"), c("text"), c("brand_matched"), c("brand"), c("developer"), c("complex_name"), F.lit("нет"), c("advertiser_type"))
    b = table(spark, sf, "banners")
    return spread(b).select("seq", f["category"].alias("category"), f["developer"].alias("developer"), f["complex_name"].alias("complex_name"), f["personal_ad"].alias("personal_ad"))


# --- state, semi and anti joins ------------------------------------------------------------


@query("SELECT DISTINCT panoid FROM banners WHERE panoid IS NOT NULL AND panoid NOT IN (SELECT panoid FROM panoramas WHERE panoid IS NOT NULL)")
def q_unseen(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "banners").select("panoid").filter("panoid is not null").distinct()
    return state.not_in(b, table(spark, sf, "panoramas"), "panoid")


@query("SELECT o AS oid, min(s) AS seq FROM (SELECT unnest(neighbor_oids) AS o, timestamp AS s FROM panoramas) WHERE o IS NOT NULL AND o NOT IN (SELECT oid FROM panoramas WHERE status = 'success' AND oid IS NOT NULL) GROUP BY o")
def q_enqueue(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "panoramas")
    batch = p.select(F.explode("neighbor_oids").alias("oid"), F.col("timestamp").alias("seq"))
    return state.insert_new(p.filter("status = 'success'"), batch, "oid", "seq")


_VALID = "lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AND NOT (lon = 0 AND lat = 0)"
_CELL = "CAST(round_even(lat / (75.0 / 111320), 0) AS BIGINT) AS cell_row, CAST(round_even(lon / (75.0 / (111320 * greatest(0.1, cos(radians(lat))))), 0) AS BIGINT) AS cell_col"


@query(f"SELECT cell_row, cell_col, min(seq) AS seq FROM (SELECT seq, {_CELL} FROM banners WHERE {_VALID}) GROUP BY cell_row, cell_col")
def q_first_per_cell(spark: SparkSession, sf: str) -> DataFrame:
    return state.first_per_cell(table(spark, sf, "banners").select("seq", "lon", "lat"), 75.0).select("cell_row", "cell_col", "seq")


@query(
    f"""SELECT seq FROM (SELECT seq, {_CELL} FROM banners WHERE {_VALID}) b WHERE EXISTS (SELECT 1 FROM
  (SELECT {_CELL} FROM panoramas WHERE {_VALID} AND status = 'success') p WHERE p.cell_row = b.cell_row AND p.cell_col = b.cell_col)"""
)
def q_points_in_cells(spark: SparkSession, sf: str) -> DataFrame:
    ok = geo.valid_position(F.col("lon"), F.col("lat"))
    p = table(spark, sf, "panoramas").filter(ok & (F.col("status") == "success"))
    cells = p.select(geo.cell_row(F.col("lat"), 75.0).alias("cell_row"), geo.cell_col(F.col("lon"), F.col("lat"), 75.0).alias("cell_col"))
    return state.points_in_cells(table(spark, sf, "banners").filter(ok).select("seq", "lon", "lat"), cells, 75.0).select("seq")


@query(
    f"""WITH p AS (SELECT lon, lat, {_CELL} FROM panoramas WHERE {_VALID} AND list_contains(list_transform(zooms, lambda z: z.level), 0)),
b AS (SELECT seq, lon, lat, {_CELL} FROM banners WHERE {_VALID})
SELECT seq FROM b WHERE NOT EXISTS (SELECT 1 FROM p WHERE abs(p.cell_row - b.cell_row) <= 1 AND abs(p.cell_col - b.cell_col) <= 1 AND
  sqrt(power((b.lon - p.lon) * 111320 * cos(radians((b.lat + p.lat) / 2)), 2) + power((b.lat - p.lat) * 111320, 2)) < 75)"""
)
def q_far_from(spark: SparkSession, sf: str) -> DataFrame:
    ok = geo.valid_position(F.col("lon"), F.col("lat"))
    guards = table(spark, sf, "panoramas").filter(ok & F.exists("zooms", lambda z: z["level"] == 0))
    return state.far_from(table(spark, sf, "banners").filter(ok).select("seq", "lon", "lat"), guards, 75.0).select("seq")


@query("SELECT seq, banner_id, CAST(NULL AS VARCHAR) AS note FROM banners WHERE seq <= 1000000 UNION ALL SELECT seq + 1000000, NULL, 'new' FROM banners WHERE brand_matched")
def q_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    b = table(spark, sf, "banners")
    # The SQL twin shifts by 1000000, which is too little once the table has seqs above that.
    shift = max(1000000, b.agg(F.max("seq")).first()[0] or 0)
    old = b.select("seq", "banner_id")
    new = b.filter("brand_matched").select((F.col("seq") + shift).alias("seq"), F.lit("new").alias("note"))
    return state.evolved([old, new], T.StructType.fromDDL("seq bigint, banner_id string, note string"))


# --- sources -----------------------------------------------------------------------------


@query(
    """SELECT DISTINCT panoid, coalesce(timestamp, 0) AS timestamp, round(coalesce(azimuth_origin, 0), 6) AS azimuth_origin, len(zooms) AS n_zooms,
  coalesce(array_to_string(list_filter(neighbor_oids, lambda o: o IS NOT NULL AND o <> ''), ','), '') AS neighbours, coalesce(nullif(address, ''), 'рядом') AS address
FROM panoramas WHERE status = 'success' AND panoid IS NOT NULL"""
)
def q_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Panoramas rendered as landed documents of three markers and parsed again: the nearest names the place."""
    raw = metadata.rendered(table(spark, sf, "panoramas"), beside="рядом")
    p = metadata.parsed(raw, oid=F.col("oid")).filter("panoid is not null")
    return p.select(
        "panoid", "timestamp", F.round("azimuth_origin", 6).alias("azimuth_origin"), F.size("zooms").alias("n_zooms"), F.array_join("neighbor_oids", ",").alias("neighbours"), "address"
    ).distinct()


@query("SELECT DISTINCT f.oid, p.panoid FROM (SELECT DISTINCT unnest(neighbor_oids) AS oid FROM panoramas) f JOIN (SELECT oid, any_value(panoid) AS panoid FROM panoramas WHERE status = 'success' GROUP BY oid) p USING (oid)")
def q_by_oid(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "panoramas")
    return metadata.by_oid(p.select(F.explode("neighbor_oids").alias("oid")), p).select("oid", "panoid")


@query(
    f"""WITH p AS (SELECT DISTINCT panoid, lon, lat FROM panoramas WHERE status = 'success' AND {_VALID}),
b AS (SELECT seq, lon, lat FROM banners WHERE {_VALID}),
j AS (SELECT seq, panoid, sqrt(power((p.lon - b.lon) * 111320 * cos(radians((b.lat + p.lat) / 2)), 2) + power((p.lat - b.lat) * 111320, 2)) AS d
  FROM b JOIN p ON p.lat BETWEEN b.lat - 0.0028 AND b.lat + 0.0028 AND p.lon BETWEEN b.lon - 0.0045 AND b.lon + 0.0045)
SELECT seq AS point_id, arg_min(panoid, (d, panoid)) AS panoid, round(min(d), 3) AS metres FROM j WHERE d <= 300 GROUP BY seq"""
)
def q_nearest(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "banners").select(F.col("seq").alias("point_id"), "lon", "lat")
    return metadata.by_coordinates(points, table(spark, sf, "panoramas"), 300.0).withColumn("metres", F.round("metres", 3))


@query(
    """SELECT round(37.9 + j * (150 / (111320 * cos(radians((44.9 + 45.1) / 2)))), 7) AS lon, round(44.9 + i * (150.0 / 111320), 7) AS lat
FROM range(0, CAST(floor((45.1 - 44.9) / (150.0 / 111320)) AS BIGINT) + 1) a(i), range(0, CAST(floor((38.1 - 37.9) / (150 / (111320 * cos(radians((44.9 + 45.1) / 2))))) AS BIGINT) + 1) b(j)"""
)
def q_lattice(spark: SparkSession, sf: str) -> DataFrame:
    return seeds.lattice(spark, (37.9, 44.9, 38.1, 45.1)).select(F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query(
    """WITH p AS (SELECT oid, any_value(lon) + 0.00000003 AS lon, any_value(lat) + 0.00000003 AS lat, any_value(neighbor_oids) AS ns FROM panoramas WHERE status = 'success' GROUP BY oid),
e AS (SELECT a.oid AS src, b.oid AS dst, a.lon AS x0, a.lat AS y0, b.lon AS x1, b.lat AS y1 FROM (SELECT oid, lon, lat, unnest(ns) AS n FROM p) a JOIN p b ON a.n = b.oid WHERE a.oid < b.oid AND (a.lon <> b.lon OR a.lat <> b.lat)),
m AS (SELECT *, greatest(1, CAST(floor(sqrt(power((x1 - x0) * 111320 * cos(radians((y0 + y1) / 2)), 2) + power((y1 - y0) * 111320, 2)) / 400) AS BIGINT)) AS n FROM e),
s AS (SELECT x0 + (x1 - x0) * k / n AS lon, y0 + (y1 - y0) * k / n AS lat FROM m, range(0, 100000) t(k) WHERE k <= n)
SELECT DISTINCT round_even(lon, 5) AS lon, round_even(lat, 5) AS lat FROM s"""
)
def q_road_points(spark: SparkSession, sf: str) -> DataFrame:
    """Seed points about every 400 m along the links between panoramas, each metre once.

    Positions are shifted by some millimetres so that none lies on a rounding edge.
    """
    p = table(spark, sf, "panoramas").filter("status = 'success'").groupBy("oid").agg((F.first("lon") + 0.00000003).alias("lon"), (F.first("lat") + 0.00000003).alias("lat"), F.first("neighbor_oids").alias("ns"))
    a = p.select(F.col("oid").alias("src"), F.col("lon").alias("x0"), F.col("lat").alias("y0"), F.explode("ns").alias("oid"))
    e = a.join(p, "oid").filter("src < oid")
    pt = lambda x, y: F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))
    roads = e.select(F.concat_ws("-", "src", "oid").alias("way_id"), F.lit("primary").alias("highway"), F.array(pt("x0", "y0"), pt("lon", "lat")).alias("pts"))
    return seeds.along_roads(roads, 400.0).select(F.bround("lon", 5).alias("lon"), F.bround("lat", 5).alias("lat"))


@query("SELECT panoid, 0 AS idx, CAST(0.1 AS DOUBLE) AS fx0, CAST(0.4 AS DOUBLE) AS fy0, CAST(0.3 AS DOUBLE) AS fx1, CAST(0.6 AS DOUBLE) AS fy1, CAST(1 AS DOUBLE) AS score, 'banner' AS label FROM (SELECT DISTINCT panoid FROM panoramas)")
def q_fixed_regions(spark: SparkSession, sf: str) -> DataFrame:
    return recognition.fixed_regions(table(spark, sf, "panoramas").select("panoid").distinct(), [(0.1, 0.4, 0.3, 0.6)])


@query("SELECT oid FROM (SELECT DISTINCT oid FROM panoramas WHERE status = 'success' AND oid IS NOT NULL) ORDER BY oid LIMIT 25 OFFSET 10")
def q_sample_page(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.page(table(spark, sf, "panoramas").filter("status = 'success'"), "oid", 10, 25)


@query("SELECT seq, category FROM banners WHERE category = 'недвижимость'")
def q_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return by_category(table(spark, sf, "banners"), category="недвижимость").select("seq", "category")


# --- export ------------------------------------------------------------------------------

_SHOWN = """seq, coalesce(address, '') AS address, coalesce(construction, '') AS construction,
  CASE WHEN coalesce(nullif(developer, ''), nullif(advertiser, ''), '') <> '' AND NOT coalesce(brand_matched, false)
    THEN coalesce(nullif(developer, ''), nullif(advertiser, '')) || ' (не опознан)' ELSE coalesce(nullif(developer, ''), nullif(advertiser, ''), '') END AS developer,
  coalesce(complex_name, '') AS complex_name, coalesce(dir_phone, '') AS dir_phone, coalesce(banner_id, '') AS banner_id"""


@query(f"SELECT {_SHOWN} FROM banners WHERE lower(coalesce(is_realty, '')) IN ('да', 'не уверен') AND NOT coalesce(personal_ad, false)")
def q_realty_export(spark: SparkSession, sf: str) -> DataFrame:
    b = realty(table(spark, sf, "banners"), personal=False)
    return presentation(b, extra=["seq"]).select("seq", "address", "construction", "developer", "complex_name", "dir_phone", "banner_id")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE lower(coalesce(is_realty, '')) = 'да') AS sure FROM banners WHERE lower(coalesce(is_realty, '')) IN ('да', 'не уверен')")
def q_realty_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "banners").agg(F.count_if(is_realty()).alias("n"), F.count_if(is_realty(include_unsure=False)).alias("sure"))
