"""Text, JSON, key and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, BLANK, "")


def name_key(c: Column, keep: str = "") -> Column:
    """Lower-case letters and digits of either alphabet, ё as е, everything else one space."""
    folded = F.translate(F.lower(F.coalesce(c, F.lit(""))), "ё", "е")
    return F.trim(F.regexp_replace(folded, f"[^0-9a-zа-я{keep}]+", " "))


def url_parameter(href: Column, name: str) -> Column:
    """Value after the first `name=` up to `&`; null if missing or empty."""
    return F.nullif(F.regexp_extract(href, f"{name}=([^&]*)", 1), F.lit(""))


def unfenced(raw: Column) -> Column:
    """A model's answer without its code fence: the part between the first two fences, less a json tag."""
    s = strip(F.coalesce(raw, F.lit("")))
    inner = F.coalesce(F.get(F.split(s, "```", 3), F.lit(1)), F.lit(""))
    fences = (F.length(s) - F.length(F.replace(s, F.lit("```"), F.lit("")))) / 3
    inner = F.when(fences >= 2, inner).otherwise(F.regexp_replace(s, "^`+|`+$", ""))
    inner = F.when(F.lower(inner).startswith("json"), F.substring(inner, 5, 1 << 30)).otherwise(inner)
    return strip(F.when(s.startswith("```"), inner).otherwise(s))


def _present(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def parse_answer(raw: Column) -> Column:
    """Fields of a recognition answer.

    Text that is no JSON is taken as the reading itself; JSON that is no object marks the
    row failed. Phone and site are appended to the text on lines of their own unless they
    are missing or spelled null.
    """
    doc = F.try_parse_json(unfenced(raw))
    kind = F.schema_of_variant(doc)
    is_object = doc.isNotNull() & kind.startswith("OBJECT")
    failed = doc.isNotNull() & ~kind.startswith("OBJECT")
    get = lambda k: F.try_variant_get(doc, f"$.{k}", "string")
    usable = lambda c: F.when(~F.lower(c).isin("null", "none", ""), c)
    joined = strip(F.concat_ws("\n", _present(get("text")), usable(get("phone")), usable(get("site"))))
    text = F.when(is_object, joined).when(~failed | doc.isNull(), F.coalesce(raw, F.lit("")))
    fields = ("advertiser", "category", "construction", "is_realty", "developer", "complex_name", "offer_type", "advertiser_type")
    return F.struct(
        text.alias("text"),
        *[F.when(is_object, _present(strip(get(f)) if i > 2 else get(f))).alias(f) for i, f in enumerate(fields)],
        F.coalesce(failed, F.lit(False)).alias("failed"),
    )


def usage_counts(usage: Column) -> Column:
    """map<string, bigint> of token counts; null if the JSON is missing, cut or no object."""
    doc = F.try_parse_json(usage)
    return F.try_variant_get(doc, "$", "map<string, bigint>")


def fixed(x: Column, places: int) -> Column:
    """Decimal spelling with `places` digits, rounded as the exact binary value demands.

    The JVM's formatter rounds the shortest spelling instead, which differs for values
    that print as ties. The error of x * 10^places is recovered by splitting x in halves.
    """
    scale = float(10**places)
    a = F.abs(x)
    product = a * scale
    big = a * 134217729.0
    high = big - (big - a)
    error = (high * scale - product) + (a - high) * scale
    whole = F.floor(product)
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    n = F.when(up, whole + 1).otherwise(whole).cast("long")
    digits = F.lpad((n % int(scale)).cast("string"), places, "0")
    return F.concat(F.when(x < 0, "-").otherwise(""), F.floor(n / int(scale)).cast("string"), F.lit("."), digits)


def reading_id(panoid: Column, fx0: Column, fy0: Column) -> Column:
    """Twelve hex digits that name a box of a panorama."""
    return F.substring(F.md5(F.concat_ws(":", panoid, fixed(fx0, 4), fixed(fy0, 4)).cast("binary")), 1, 12)


def decimal_text(c: Column) -> Column:
    """Shortest decimal spelling of a double, with at least one place."""
    return c.cast("string")


def coarse_key(lon: Column, lat: Column, bearing: Column, category: Column) -> Column:
    """Readable key of a reading; for people, not for decisions. Null positions give null."""
    tens = (F.bround(F.coalesce(bearing, F.lit(0.0)) / 10).cast("long") * 10).cast("string")
    return F.concat(F.lit("geo:"), decimal_text(F.bround(lon, 4)), F.lit(":"), decimal_text(F.bround(lat, 4)), F.lit(":"), tens, F.lit(":"), F.coalesce(category, F.lit("None")))


def deep_link(lon: Column, lat: Column, bearing: Column, base: str) -> Column:
    """Link to a panorama viewer at `base`, turned to the bearing (one decimal; 0 if null)."""
    turn = F.coalesce(fixed(bearing, 1), F.lit("0"))
    return F.concat(F.lit(base), F.lit("?ll="), decimal_text(lon), F.lit(","), decimal_text(lat), F.lit("&dir="), turn)


def joined(values: Column) -> Column:
    return F.array_join(values, ", ")


def listed(text: Column) -> Column:
    """Trimmed non-empty parts of a comma-separated list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def shot_date(seconds: Column) -> Column:
    """UTC date of epoch seconds; empty if missing, zero or beyond a timestamp's range."""
    day = F.date_format(F.timestamp_seconds(F.when(seconds.between(-62135596800, 253402300799), seconds)), "yyyy-MM-dd")
    return F.when(seconds.isNull() | (seconds == 0), F.lit("")).otherwise(F.coalesce(day, F.lit("")))


def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def shown_developer(developer: Column, advertiser: Column, matched: Column, unknown: str = " (не опознан)") -> Column:
    """Developer, else advertiser, marked when the directory doesn't know it."""
    name = F.coalesce(F.nullif(developer, F.lit("")), F.nullif(advertiser, F.lit("")), F.lit(""))
    return F.when((name != "") & ~F.coalesce(matched, F.lit(False)), F.concat(name, F.lit(unknown))).otherwise(name)


def is_personal(advertiser_type: Column) -> Column:
    return F.lower(F.coalesce(advertiser_type, F.lit(""))).startswith("частн")


def content_key(engine: Column, data: Column) -> Column:
    """Cache key of decoded content."""
    return F.concat(engine, F.lit(":"), F.sha2(data.cast("binary"), 256))
