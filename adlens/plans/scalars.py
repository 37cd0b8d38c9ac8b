"""Queries of scalar functions, predicates and per-row operators, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import boxes, contacts, geo, scoring, text
from adlens.operators.images import gray_stats
from adlens.session import spread, table
from adlens.sources import metadata

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- categories and contacts -------------------------------------------------------------


def category_sql(column: str) -> str:
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    low = r"lower(regexp_replace(coalesce(" + column + r", ''), '^[\s\p{Z}\x{85}]+|[\s\p{Z}\x{85}]+$', '', 'g'))"
    scan = [(c, w, 2) for c, w in scoring.NAMES.items()] + [(c, w, 1) for c, w in scoring.KEYWORDS.items()]
    hits = [f"{k} * (" + " + ".join(f"CAST(contains(low, {quote(x)}) AS INT)" for x in words) + f") AS h{i}" for i, (_, words, k) in enumerate(scan)]
    best = "greatest(" + ", ".join(f"h{i}" for i in range(len(scan))) + ")"
    cases = " ".join(f"WHEN h{i} = {best} THEN {quote(c)}" for i, (c, _, _) in enumerate(scan))
    return f"""SELECT seq, CASE WHEN length(low) < 4 THEN 'не определено' WHEN {best} = 0 THEN 'другое' {cases} END AS category
FROM (SELECT seq, low, {", ".join(hits)} FROM (SELECT seq, {low} AS low FROM banners))"""


@query(category_sql("text"))
def q_keyword_category(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "banners").select("seq", "text")).select("seq", scoring.keyword_category(F.col("text")).alias("category"))


# Text with every sign doubled, so that a match may begin right after another.
_SEP = r"[\s\p{Z}\x{85}.\-()‐-―]*"
def _distinct(expr: str) -> str:
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


_CONTACTS_SQL = rf"""
WITH raw AS (SELECT seq, ocr_engine, coalesce(text, '') AS t FROM banners),
found AS (SELECT seq, ocr_engine,
  list_transform(regexp_extract_all(regexp_replace(t, '(\P{{Nd}})', '\1\1', 'g'),
    '(?:^|\P{{Nd}})((?:\+*7|8){_SEP}\p{{Nd}}{{3}}{_SEP}\p{{Nd}}{{3}}{_SEP}\p{{Nd}}{{2}}{_SEP}\p{{Nd}}{{2}})(?:\P{{Nd}}|$)', 1),
    lambda x: '+7' || right(regexp_replace(x, '\P{{Nd}}', '', 'g'), 10)) AS n,
  list_filter(list_transform(regexp_extract_all(t,
    '((?:https?://)?(?:www\.)?[a-z0-9][a-z0-9\-]{{1,40}}\.(?:{"|".join(contacts.TLDS)}))(?:[^\p{{L}}\p{{N}}_]|$)', 1, 'i'),
    lambda x: regexp_replace(lower(x), '^(https?://)?(www\.)?', '')), lambda x: length(x) >= 5) AS s,
  list_transform(regexp_extract_all(t, '(?:t\.me/|telegram\.me/|@)([a-zA-Z][a-zA-Z0-9_]{{3,31}})', 1), lambda x: '@' || lower(x)) AS h
  FROM raw),
uniq AS (SELECT seq, ocr_engine, {_distinct("n")} AS n, {_distinct("s")} AS s, {_distinct("h")} AS h FROM found),
kinds AS (SELECT *, list_filter(n, lambda x: x[3:3] IN ('9', '3', '4', '8') OR x[3:5] IN ({", ".join(f"'{c}'" for c in contacts.KZ_MOBILE)})) AS p FROM uniq)
"""


def _joined(c):
    return F.array_join(c, ", ")


@query(
    _CONTACTS_SQL
    + """SELECT seq, array_to_string(p, ', ') AS phones, array_to_string(list_filter(n, lambda x: NOT list_contains(p, x)), ', ') AS phones_unreliable,
  array_to_string(s, ', ') AS sites, array_to_string(h, ', ') AS telegram FROM kinds"""
)
def q_contacts(spark: SparkSession, sf: str) -> DataFrame:
    found = spread(table(spark, sf, "banners").select("seq", "text")).select("seq", contacts.contacts(F.col("text")).alias("c"))
    return found.select("seq", *[_joined(F.col(f"c.{k}")).alias(k) for k in ("phones", "phones_unreliable", "sites", "telegram")])


@query(
    _CONTACTS_SQL
    + """SELECT seq, CASE WHEN 100 + seq % 300 < 220 THEN '' ELSE array_to_string(p, ', ') END AS phones,
  array_to_string(CASE WHEN 100 + seq % 300 < 220 THEN list_concat(list_filter(n, lambda x: NOT list_contains(p, x)), p)
    ELSE list_filter(n, lambda x: NOT list_contains(p, x)) END, ', ') AS phones_unreliable FROM kinds"""
)
def q_contacts_demoted(spark: SparkSession, sf: str) -> DataFrame:
    side = 100 + F.col("seq") % 300
    c = table(spark, sf, "banners").select("seq", contacts.demoted(contacts.contacts(F.col("text")), side, 220).alias("c"))
    return c.select("seq", _joined(F.col("c.phones")).alias("phones"), _joined(F.col("c.phones_unreliable")).alias("phones_unreliable"))


@query(
    f"""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN starts_with(c, '9') THEN 'mobile_ru'
  WHEN c IN ({", ".join(f"'{c}'" for c in contacts.KZ_MOBILE)}) THEN 'mobile_kz' WHEN c[1:1] IN ('3', '4', '8') THEN 'geo_ru' ELSE 'unknown' END AS kind
  FROM (SELECT CAST(100 + o_orderkey % 900 AS VARCHAR) AS c FROM orders)) GROUP BY kind"""
)
def q_phone_kind(spark: SparkSession, sf: str) -> DataFrame:
    code = (100 + F.col("o_orderkey") % 900).cast("string")
    return table(spark, sf, "orders").groupBy(contacts.code_kind(code).alias("kind")).agg(F.count("*").alias("n"))


@query(
    "WITH c AS ("
    + category_sql("text")
    + "), "
    + _CONTACTS_SQL.replace("WITH raw", "raw", 1)
    + """SELECT c.category, count(*) AS n, count(*) FILTER (WHERE len(p) > 0) AS with_phone, count(*) FILTER (WHERE len(s) > 0) AS with_site
FROM c JOIN kinds USING (seq) GROUP BY c.category"""
)
def q_category_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Advertisements by category after contact extraction and classification."""
    t = F.col("text")
    rows = spread(table(spark, sf, "banners").select("text")).select(
        scoring.keyword_category(t).alias("category"), (F.size(contacts.phones(t)) > 0).alias("p"), (F.size(contacts.sites(t)) > 0).alias("s")
    )
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.count_if("p").alias("with_phone"), F.count_if("s").alias("with_site"))


# --- JSON, links, keys -------------------------------------------------------------------


@query("SELECT panoid, o AS oid FROM (SELECT panoid, unnest(neighbor_oids) AS o FROM panoramas WHERE neighbor_oids IS NOT NULL) WHERE o <> ''")
def q_link_parameter(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "panoramas").select("panoid", F.explode("neighbor_oids").alias("o"))
    href = F.concat(F.lit("https://maps.example.net/?l=sta&oid="), F.col("o"), F.lit("&z=1"))
    return links.select("panoid", text.url_parameter(href, "oid").alias("oid")).filter("oid is not null")


@query(
    """SELECT engine, count(*) AS n, count(j) AS parsed, CAST(sum(CAST(j->>'$.input_tokens' AS BIGINT)) AS BIGINT) AS input_tokens, CAST(sum(CAST(j->>'$.output_tokens' AS BIGINT)) AS BIGINT) AS output_tokens
FROM (SELECT engine, CASE WHEN json_valid(usage) THEN CAST(usage AS JSON) END AS j FROM ocr_cache) GROUP BY engine"""
)
def q_usage(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "ocr_cache").select("engine", text.usage_counts(F.col("usage")).alias("u"))
    return u.groupBy("engine").agg(
        F.count("*").alias("n"), F.count("u").alias("parsed"), F.sum(F.col("u.input_tokens")).alias("input_tokens"), F.sum(F.col("u.output_tokens")).alias("output_tokens")
    )


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type")
def q_json_field(spark: SparkSession, sf: str) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


#: Answers of every kind, and what they mean: text, advertiser, whether they fail.
_ANSWERS = (
    ('{"text": "Ремонт", "advertiser": "Икс"}', "Ремонт", "Икс", False),
    ('```json\n{"text": "Окна", "phone": "8 800 1"}\n```', "Окна\n8 800 1", None, False),
    ('```\n{"text": "Окна"}\n```', "Окна", None, False),
    ('{"text": "А", "phone": null, "site": "null"}', "А", None, False),
    ('{"text": "А", "phone": 12345}', "А\n12345", None, False),
    ("просто текст", "просто текст", None, False),
    ('{"text": "обор', '{"text": "обор', None, False),
    ('["а", "б"]', None, None, True),
    ("17", None, None, True),
    ("{}", "", None, False),
    ("", "", None, False),
)


@query(
    "SELECT id, text, advertiser, failed FROM (VALUES "
    + ", ".join(f"({i}, " + ", ".join("NULL" if v is None else "'" + v + "'" for v in (t, a)) + f", {f})" for i, (_, t, a, f) in enumerate(_ANSWERS))
    + ") t(id, text, advertiser, failed)"
)
def q_broken_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers that are fenced, cut, no JSON or no object."""
    raw = spark.createDataFrame([(i, a[0]) for i, a in enumerate(_ANSWERS)], "id int, raw string")
    return raw.select("id", text.parse_answer(F.col("raw")).alias("r")).select("id", "r.text", "r.advertiser", "r.failed")


@query(
    r"""SELECT key, regexp_replace(concat_ws(chr(10), nullif(text, ''), CASE WHEN created % 2 < 1 THEN '+7 495 123-45-67' END), '^\s+|\s+$', '', 'g') AS text,
  nullif(advertiser, '') AS advertiser, nullif(trim(is_realty), '') AS is_realty, false AS failed FROM ocr_cache"""
)
def q_fenced_answers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "ocr_cache")
    phone = F.when(F.col("created") % 2 < 1, "+7 495 123-45-67").otherwise("null")
    body = F.to_json(F.struct("text", "advertiser", "is_realty", phone.alias("phone")))
    raw = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    a = rows.select("key", text.parse_answer(raw).alias("a"))
    return a.select("key", "a.text", "a.advertiser", "a.is_realty", "a.failed")


@query("SELECT panoid, idx, md5(format('{}:{:.4f}:{:.4f}', panoid, fx0, fy0))[1:12] AS banner_id FROM detections WHERE panoid IS NOT NULL")
def q_reading_id(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "detections").filter("panoid is not null")
    return d.select("panoid", "idx", text.reading_id(F.col("panoid"), F.col("fx0"), F.col("fy0")).alias("banner_id"))


@query(
    """SELECT seq, 'geo:' || CAST(round_even(lon, 4) AS VARCHAR) || ':' || CAST(round_even(lat, 4) AS VARCHAR) || ':' ||
  CAST(CAST(round_even(coalesce(bearing_deg, 0) / 10, 0) AS BIGINT) * 10 AS VARCHAR) || ':' || coalesce(category, 'None') AS dedup_key
FROM banners"""
)
def q_coarse_key(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "banners")
    return b.select("seq", text.coarse_key(F.col("lon"), F.col("lat"), F.col("bearing_deg"), F.col("category")).alias("dedup_key"))


@query(
    r"""SELECT seq, 'https://maps.example.net/?ll=' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || '&dir=' || CASE WHEN bearing_deg IS NULL THEN '0' ELSE format('{:.1f}', bearing_deg) END AS link,
  CASE WHEN timestamp IS NULL OR timestamp = 0 OR timestamp NOT BETWEEN -62135596800 AND 253402300799 THEN '' ELSE strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') END AS shot_date,
  CASE WHEN phones IS NOT NULL THEN coalesce(array_to_string(list_filter(phones, lambda x: x IS NOT NULL), ', '), '') END AS phones,
  len(list_filter(list_transform(string_split(coalesce(array_to_string(phones, ', '), ''), ','), lambda x: trim(x)), lambda x: x <> '')) AS n_phones,
  CASE WHEN coalesce(nullif(developer, ''), nullif(advertiser, ''), '') <> '' AND NOT coalesce(brand_matched, false)
    THEN coalesce(nullif(developer, ''), nullif(advertiser, '')) || ' (не опознан)' ELSE coalesce(nullif(developer, ''), nullif(advertiser, ''), '') END AS developer,
  coalesce(complex_name, '') AS complex_name, starts_with(lower(coalesce(advertiser_type, '')), 'частн') AS personal
FROM banners"""
)
def q_display(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "banners")
    c = F.col
    return b.select(
        "seq", text.deep_link(c("lon"), c("lat"), c("bearing_deg"), "https://maps.example.net/").alias("link"), text.shot_date(c("timestamp")).alias("shot_date"),
        text.joined(c("phones")).alias("phones"), F.size(text.listed(text.joined(c("phones")))).alias("n_phones"),
        text.shown_developer(c("developer"), c("advertiser"), c("brand_matched")).alias("developer"), text.or_empty(c("complex_name")).alias("complex_name"),
        text.is_personal(c("advertiser_type")).alias("personal"),
    )


@query("SELECT key, sha256(coalesce(text, '')) AS digest, engine || ':' || sha256(coalesce(text, '')) AS cache_key, to_base64(encode(coalesce(text, ''))) AS body FROM ocr_cache")
def q_content_key(spark: SparkSession, sf: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    o = table(spark, sf, "ocr_cache")
    return o.select("key", F.sha2(t, 256).alias("digest"), text.content_key(F.col("engine"), t).alias("cache_key"), F.regexp_replace(F.base64(F.encode(t, "UTF-8")), r"\s", "").alias("body"))


@query(
    r"""SELECT seq, trim(regexp_replace(replace(lower(coalesce(advertiser, '')), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g')) AS name,
  trim(regexp_replace(replace(lower(coalesce(text, '')), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')) AS body FROM banners"""
)
def q_name_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "banners").select("seq", text.name_key(F.col("advertiser")).alias("name"), text.name_key(F.col("text"), "%").alias("body"))


# --- geodesy -----------------------------------------------------------------------------

BBOX = (37.9, 44.9, 38.1, 45.1)


@query("SELECT seq FROM banners WHERE lon BETWEEN 37.9 AND 38.1 AND lat BETWEEN 44.9 AND 45.1")
def q_bbox(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "banners").filter(geo.in_bbox(F.col("lon"), F.col("lat"), BBOX)).select("seq")


_VALID = "lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AND NOT (lon = 0 AND lat = 0)"


@query(
    f"""SELECT seq, round(CASE WHEN bearing_deg IS NULL THEN lon ELSE lon + 25 * sin(radians(bearing_deg)) / (111320 * greatest(0.1, cos(radians(lat)))) END, 9) AS sign_lon,
  round(CASE WHEN bearing_deg IS NULL THEN lat ELSE lat + 25 * cos(radians(bearing_deg)) / 111320 END, 9) AS sign_lat,
  round(sqrt(power((38 - lon) * 111320 * cos(radians((lat + 45) / 2)), 2) + power((45 - lat) * 111320, 2)), 3) AS metres
FROM banners WHERE {_VALID}"""
)
def q_sign_position(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    b = table(spark, sf, "banners").filter(geo.valid_position(c("lon"), c("lat")))
    return b.select(
        "seq", F.round(geo.sign_lon(c("lon"), c("lat"), c("bearing_deg"), 25.0), 9).alias("sign_lon"), F.round(geo.sign_lat(c("lat"), c("bearing_deg"), 25.0), 9).alias("sign_lat"),
        F.round(geo.distance_m(c("lon"), c("lat"), F.lit(38.0), F.lit(45.0)), 3).alias("metres"),
    )


@query(
    f"""SELECT r, c, count(*) AS n FROM (SELECT CAST(round_even(lat / (75.0 / 111320), 0) AS BIGINT) AS r,
  CAST(round_even(lon / (75.0 / (111320 * greatest(0.1, cos(radians(lat))))), 0) AS BIGINT) AS c FROM panoramas WHERE {_VALID}) GROUP BY r, c"""
)
def q_cells(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "panoramas").filter(geo.valid_position(F.col("lon"), F.col("lat")))
    cells = p.select(geo.cell_row(F.col("lat"), 75.0).alias("r"), geo.cell_col(F.col("lon"), F.col("lat"), 75.0).alias("c"))
    return cells.groupBy("r", "c").agg(F.count("*").alias("n"))


@query(
    f"""SELECT k, count(*) AS n FROM (SELECT CAST(round_even(lat / (75.0 / 111320), 0) AS BIGINT) + i AS r,
  CAST(round_even(lon / (75.0 / (111320 * greatest(0.1, cos(radians(lat))))), 0) AS BIGINT) + j AS c, CAST(r AS VARCHAR) || ':' || CAST(c AS VARCHAR) AS k
  FROM panoramas, (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j) WHERE {_VALID}) GROUP BY k"""
)
def q_neighbour_keys(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "panoramas").filter(geo.valid_position(F.col("lon"), F.col("lat")))
    keys = geo.neighbour_keys(geo.cell_row(F.col("lat"), 75.0), geo.cell_col(F.col("lon"), F.col("lat"), 75.0))
    return p.select(F.explode(keys).alias("k")).groupBy("k").agg(F.count("*").alias("n"))


_BOXES = """WITH p AS (SELECT panoid, any_value(azimuth_origin) AS o, any_value(tile_size) AS ts, any_value(list_filter(zooms, lambda z: z.level = 2)[1]) AS z,
  any_value(list_min(list_transform(zooms, lambda z: z.level))) AS finest FROM panoramas GROUP BY panoid),
d AS (SELECT * FROM detections JOIN p USING (panoid))
"""


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    p = metadata.earliest(table(spark, sf, "panoramas"), "panoid")
    p = p.select("panoid", "azimuth_origin", "tile_size", boxes.zoom_level(F.col("zooms"), 2).alias("z"), boxes.max_zoom(F.col("zooms")).alias("finest"))
    return table(spark, sf, "detections").join(p, "panoid")


@query(
    _BOXES
    + """SELECT panoid, idx, round((fx0 + fx1) / 2, 9) AS cx, round((fy0 + fy1) / 2, 9) AS cy,
  round(((o + (fx0 + fx1) / 2 * 360) % 360 + 360) % 360, 6) AS bearing,
  round((((((o + (fx0 + fx1) / 2 * 360) % 360 + 360) % 360 - o) % 360 + 360) % 360) / 360, 6) AS back FROM d"""
)
def q_azimuth(spark: SparkSession, sf: str) -> DataFrame:
    d = _boxes(spark, sf)
    cx = (F.col("fx0") + F.col("fx1")) / 2
    az = geo.azimuth(cx, F.col("azimuth_origin"))
    return d.select(
        "panoid", "idx", F.round(cx, 9).alias("cx"), F.round((F.col("fy0") + F.col("fy1")) / 2, 9).alias("cy"), F.round(az, 6).alias("bearing"),
        F.round(geo.fraction_of_azimuth(az, F.col("azimuth_origin")), 6).alias("back"),
    )


_PX = "CAST(trunc((least(1.0, fx1) - greatest(0.0, fx0)) * z.width) AS INT)"
_PY = "CAST(trunc((least(1.0, fy1) - greatest(0.0, fy0)) * z.height) AS INT)"


@query(
    _BOXES
    + f"""SELECT panoid, idx, finest, {_PX} AS w, {_PY} AS h,
  least({_PX}, {_PY}) >= 30 AND {_PX} * {_PY} >= 1200 AND {_PX} * {_PY} <= 800000 AS passes,
  round(greatest(0.0, fx0 - (fx1 - fx0) * 0.1), 9) AS px0, round(least(1.0, fy1 + (fy1 - fy0) * 0.1), 9) AS py1,
  CAST(floor(trunc(fx0 * z.width) / ts) AS INT) AS tx0, CAST(floor(trunc(fy1 * z.height) / ts) AS INT) AS ty1 FROM d WHERE z IS NOT NULL"""
)
def q_crop_sizes(spark: SparkSession, sf: str) -> DataFrame:
    d = _boxes(spark, sf).filter("z is not null")
    b = {k: F.col(k) for k in boxes.BOX}
    w, h = boxes.pixel_size(b, F.col("z.width"), F.col("z.height"))
    pad, tiles = boxes.padded(b, 0.1), boxes.tile_range(b, F.col("z.width"), F.col("z.height"), F.col("tile_size"))
    return d.select(
        "panoid", "idx", "finest", w.alias("w"), h.alias("h"), boxes.size_gate(w, h).alias("passes"), F.round(pad["fx0"], 9).alias("px0"), F.round(pad["fy1"], 9).alias("py1"),
        tiles["tx0"].alias("tx0"), tiles["ty1"].alias("ty1"),
    )


@query(
    # NaN is told by its spelling: statistics of a file leave NaN out, and a filter on it prunes.
    """SELECT panoid, idx FROM detections WHERE pos_score >= 0.25 OR (pos_score >= 0.10 AND
  (neg_score IS NULL OR lower(CAST(neg_score AS VARCHAR)) LIKE '%nan%' OR neg_score <= pos_score + 0.10))"""
)
def q_margin_rule(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "detections")
    return d.filter(boxes.margin_rule(F.col("pos_score"), F.col("neg_score"))).select("panoid", "idx")


# --- vectors and pixels ------------------------------------------------------------------


#: Prompts that may be a constant of the plan.
MAX_PROMPTS = 1000


def _prompts(spark: SparkSession, sf: str) -> list[tuple[str, list[float]]]:
    """Mean vector of each label: a bounded set of prompts, refused when there are more."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    m = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    rows = m.orderBy("label").limit(MAX_PROMPTS + 1).collect()
    if len(rows) > MAX_PROMPTS:
        raise ValueError(f"more than {MAX_PROMPTS} labels to score against")
    return [(str(r.label), [p.x for p in r.v]) for r in rows]


_SHOT = """WITH c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM
  (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label),
s AS (SELECT vec_id, c.label AS name, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS cos FROM embeddings, c),
p AS (SELECT vec_id, name, exp(cos * {0}) / sum(exp(cos * {0})) OVER (PARTITION BY vec_id) AS p FROM s)
"""


@query(
    _SHOT.format(1)
    + "SELECT vec_id, CAST(arg_max(name, p) AS VARCHAR) AS best, round(max(p), 6) AS p FROM p GROUP BY vec_id"
)
def q_zero_shot(spark: SparkSession, sf: str) -> DataFrame:
    prompts = _prompts(spark, sf)
    e = table(spark, sf, "embeddings").select("vec_id", F.array_max(scoring.zero_shot(F.col("embedding"), prompts)).alias("b"))
    return e.select("vec_id", F.col("b.name").alias("best"), F.round("b.p", 6).alias("p"))


@query(
    _SHOT.format(1).rstrip()
    + ", b AS (SELECT vec_id, CAST(arg_max(name, p) AS VARCHAR) AS best FROM p GROUP BY vec_id), k AS ("
    + category_sql("text")
    + ") SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN b.best ELSE k.category END AS category FROM b JOIN k ON k.seq = b.vec_id"
)
def q_classified(spark: SparkSession, sf: str) -> DataFrame:
    """Categories by the picture's vector; every other picture is missing, so that the text decides."""
    e = table(spark, sf, "embeddings").select("vec_id", F.when(F.col("vec_id") % 2 == 0, F.col("embedding")).alias("embedding"))
    rows = e.join(table(spark, sf, "banners").select(F.col("seq").alias("vec_id"), "text"), "vec_id")
    return rows.select("vec_id", scoring.classified(F.col("text"), F.col("embedding"), _prompts(spark, sf)).alias("category"))


@query(_SHOT.format(100) + "SELECT vec_id, round(sum(p) FILTER (WHERE name % 2 = 0), 6) AS p_ad, sum(p) FILTER (WHERE name % 2 = 0) >= 0.5 AS is_ad FROM p GROUP BY vec_id")
def q_zero_shot_gate(spark: SparkSession, sf: str) -> DataFrame:
    prompts = _prompts(spark, sf)
    shots = scoring.zero_shot(F.col("embedding"), prompts, 100.0)
    ours = F.filter(shots, lambda s: s["name"].cast("int") % 2 == 0)
    e = table(spark, sf, "embeddings").select("vec_id", F.aggregate(ours, F.lit(0.0), lambda a, s: a + s["p"]).alias("p"))
    return e.select("vec_id", F.round("p", 6).alias("p_ad"), (F.col("p") >= 0.5).alias("is_ad"))


_GRAY = """WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(least(255, greatest(0, 128 + 400 * x))) AS DOUBLE)) AS g FROM embeddings),
s AS (SELECT vec_id, list_stddev_pop(g) AS sd, list_avg(list_transform(g, lambda x: CAST(x >= 185 AS INT))) AS bright, list_avg(list_transform(g, lambda x: CAST(x <= 100 AS INT))) AS dark,
  (list_sum(list_transform(range(1, 64), lambda i: CASE WHEN i % 8 <> 0 AND abs(g[i + 1] - g[i]) > 24 THEN 1 ELSE 0 END)) / 56.0
   + list_sum(list_transform(range(1, 57), lambda i: CASE WHEN abs(g[i + 8] - g[i]) > 24 THEN 1 ELSE 0 END)) / 56.0) / 2 AS edges FROM g)
"""


def _gray(spark: SparkSession, sf: str) -> DataFrame:
    g = F.transform("embedding", lambda x: F.round(F.least(F.lit(255.0), F.greatest(F.lit(0.0), 128 + 400 * x.cast("double")))))
    e = table(spark, sf, "embeddings").select("vec_id", g.alias("g"))
    return e.select("vec_id", *[c.alias(k) for k, c in gray_stats(F.col("g"), 8).items()])


@query(_GRAY + "SELECT vec_id, round(edges, 6) AS edge_density, round(sd, 6) AS gray_std, round(bright, 6) AS bright_ratio, round(dark, 6) AS dark_ratio FROM s")
def q_image_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _gray(spark, sf).select("vec_id", *[F.round(c, 6).alias(c) for c in ("edge_density", "gray_std", "bright_ratio", "dark_ratio")])


@query(
    _GRAY
    + """SELECT vec_id, (edges >= 0.025 AND (sd >= 18 OR 0.05 >= 0.12)) OR (edges >= 0.025 AND bright >= 0.45 AND dark >= 0.01 AND sd >= 18) OR (vec_id % 3 = 0 AND edges >= 0.025) AS is_ad,
  round_even(least(1.0, 0.5 * edges / 0.025 + 0.5 * sd / 18), 3) AS score FROM s"""
)
def q_visual_gate(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    gate = scoring.visual_gate(c("edge_density"), c("gray_std"), F.lit(0.05), c("bright_ratio"), c("dark_ratio"), c("gray_std"), c("vec_id") % 3 == 0)
    return _gray(spark, sf).select("vec_id", gate["is_ad"].alias("is_ad"), gate["score"].alias("score"))


@query(
    """WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(round(least(255, greatest(0, 128 + 400 * x))) AS DOUBLE)) AS g FROM embeddings),
px AS (SELECT vec_id, i, g[3 * i + 1] AS r, g[3 * i + 2] AS gr, g[3 * i + 3] AS b FROM g, range(0, 21) t(i))
SELECT vec_id, round(sqrt(var_pop(r - gr) + var_pop((r + gr) / 2 - b)) + 0.3 * sqrt(power(avg(r - gr), 2) + power(avg((r + gr) / 2 - b), 2)), 6) AS colorfulness,
  round(avg((greatest(r, gr, b) - least(r, gr, b)) / (greatest(r, gr, b) + 1e-6)), 6) AS saturation FROM px GROUP BY vec_id"""
)
def q_colour_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Colour statistics of pictures of 7 x 3 pixels made of the vectors."""
    from adlens.operators.images import with_visual_stats

    def run(batches):
        import numpy as np
        import pandas as pd

        for df in batches:
            data = [np.floor(np.clip(128 + 400 * np.asarray(e, np.float64), 0, 255) + 0.5).astype(np.uint8)[:63].reshape(21, 3)[:, ::-1].tobytes() for e in df.embedding]
            yield pd.DataFrame({"vec_id": df.vec_id, "width": 7, "height": 3, "data": data})

    made = table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, width int, height int, data binary")
    return with_visual_stats(made).select("vec_id", F.round("colorfulness", 6).alias("colorfulness"), F.round("saturation", 6).alias("saturation"))


_VIEWS = """WITH v AS (SELECT i AS v, radians(60.0 * i) AS yaw FROM range(6) t(i)),
px AS (SELECT v, x, y, yaw, (x + 0.5 - 8) AS a, -(y + 0.5 - 8) AS b, 8 / tan(radians(45)) AS f FROM v, range(16) tx(x), range(16) ty(y)),
n AS (SELECT v, x, y, yaw, a / sqrt(a * a + b * b + f * f) AS a, b / sqrt(a * a + b * b + f * f) AS b, f / sqrt(a * a + b * b + f * f) AS f FROM px),
w AS (SELECT v, x, y, a * cos(yaw) + f * sin(yaw) AS wx, b AS wy, f * cos(yaw) - a * sin(yaw) AS wz FROM n)
"""
_FX, _FY = "((atan2(wx, wz) / (2 * pi())) % 1 + 1) % 1", "0.5 - asin(wy) / pi()"


@query(_VIEWS + f"SELECT v, x, y, round({_FX}, 6) AS fx, round({_FY}, 6) AS fy FROM w")
def q_view_map(spark: SparkSession, sf: str) -> DataFrame:
    """Panorama fractions seen by the pixels of six views, one row per pixel."""
    from adlens.operators.images import view_map, yaws

    def run(batches):
        import pandas as pd

        for df in batches:
            for v in df.v:
                uv = view_map(512, 256, yaws()[v], 0.0, 90.0, 16, 16)
                for y in range(16):
                    yield pd.DataFrame({"v": v, "x": range(16), "y": y, "fx": uv[y, :, 0].round(6), "fy": uv[y, :, 1].round(6)})

    return spark.range(6).select(F.col("id").alias("v")).mapInPandas(run, "v long, x long, y long, fx double, fy double")


@query(
    _VIEWS
    + f""", b AS (SELECT v, s AS size, min({_FX}) AS x0, min({_FY}) AS y0, max({_FX}) AS x1, max({_FY}) AS y1 FROM w, (VALUES (2), (5), (9)) t(s)
  WHERE x >= 3 AND x < 3 + s AND y >= 4 AND y < 4 + s GROUP BY v, s)
SELECT v, size, CASE WHEN x1 - x0 <= 0.5 THEN round(x0, 6) END AS fx0, CASE WHEN x1 - x0 <= 0.5 THEN round(y0, 6) END AS fy0,
  CASE WHEN x1 - x0 <= 0.5 THEN round(x1, 6) END AS fx1, CASE WHEN x1 - x0 <= 0.5 THEN round(y1, 6) END AS fy1 FROM b"""
)
def q_box_in_panorama(spark: SparkSession, sf: str) -> DataFrame:
    """Panorama boxes of boxes seen in six views; null where they cross the seam."""
    from adlens.operators.images import box_in_panorama, view_map, yaws

    def run(batches):
        import pandas as pd

        for df in batches:
            rows = []
            for v, size in zip(df.v, df["size"]):
                uv = view_map(512, 256, yaws()[v], 0.0, 90.0, 16, 16)
                box = box_in_panorama(uv, 3, 4, 3 + size, 4 + size) or (None,) * 4
                rows.append((v, size, *[None if b is None else round(b, 6) for b in box]))
            yield pd.DataFrame(rows, columns=["v", "size", "fx0", "fy0", "fx1", "fy1"])

    asked = spark.range(6).select(F.col("id").alias("v"), F.explode(F.array(F.lit(2), F.lit(5), F.lit(9))).alias("size"))
    return asked.mapInPandas(run, "v long, size int, fx0 double, fy0 double, fx1 double, fy1 double")


# --- evaluation of readings --------------------------------------------------------------


@query(
    r"""WITH p AS (SELECT *, first_value(text) OVER o AS t0, first_value(advertiser) OVER o AS a, row_number() OVER o AS rn FROM banners WHERE banner_id IS NOT NULL WINDOW o AS (PARTITION BY banner_id ORDER BY seq)),
n AS (SELECT ocr_engine, trim(regexp_replace(replace(lower(coalesce(t0, '')), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')) AS truth,
  trim(regexp_replace(replace(lower(coalesce(text, '')), 'ё', 'е'), '[^0-9a-zа-я%]+', ' ', 'g')) AS got,
  trim(regexp_replace(replace(lower(coalesce(a, '')), 'ё', 'е'), '[^0-9a-zа-я]+', ' ', 'g')) AS adv, coalesce(a, '') AS a0, coalesce(text, '') AS g0 FROM p WHERE rn > 1),
w AS (SELECT *, list_filter(string_split(truth, ' '), lambda x: length(x) >= 3) AS ws FROM n)
SELECT ocr_engine, count(*) AS n, round(avg(CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda x: contains(got, x))) / len(ws) END), 6) AS recall,
  round(100.0 * avg(CAST(CASE WHEN a0 = '' THEN g0 = '' ELSE g0 <> '' AND contains(got, adv) END AS INT)), 6) AS advertiser_ok FROM w GROUP BY ocr_engine"""
)
def q_word_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts of later readings of a board against those of its first reading, by the later one's engine."""
    b = table(spark, sf, "banners").filter("banner_id is not null").select("banner_id", "seq", "ocr_engine", "text", "advertiser")
    first = b.groupBy("banner_id").agg(F.min_by(F.struct("seq", "text", "advertiser"), "seq").alias("t"))
    later = b.join(first, "banner_id").filter(F.col("seq") > F.col("t.seq"))
    r = later.select("ocr_engine", scoring.word_recall(F.col("t.text"), F.coalesce("text", F.lit(""))).alias("r"), scoring.answer_matches(F.col("t.advertiser"), F.col("text")).alias("m"))
    return r.groupBy("ocr_engine").agg(F.count("*").alias("n"), F.round(F.avg("r"), 6).alias("recall"), F.round(100 * F.avg(F.col("m").cast("int")), 6).alias("advertiser_ok"))
