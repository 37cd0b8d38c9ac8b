"""Canonical row types."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
    "zooms": T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("level", "width", "height")])),
}


def _row(**kinds: str) -> T.StructType:
    """Fields by type name; each name lists its columns."""
    named = [(column, kind) for kind, columns in kinds.items() for column in columns.split()]
    return T.StructType([T.StructField(c, _TYPES[k.split("_")[0]]) for c, k in named])


BANNERS = _row(
    bigint="seq", string="banner_id dedup_key panoid", double="lon lat", bigint_2="timestamp", double_2="bearing_deg", string_2="category",
    strings="phones phones_unreliable sites telegram", string_3="text advertiser brand", boolean="brand_matched",
    string_4="construction is_realty developer complex_name offer_type advertiser_type", boolean_2="personal_ad",
    string_5="ocr_engine dir_site dir_phone address", double_3="score", string_6="full_image_path crop_image_path source_url",
)
PANORAMAS = _row(
    string="oid panoid status", double="lon lat", bigint="timestamp", string_2="image_id", int="tile_size", zooms="zooms", double_2="azimuth_origin pitch_origin",
    strings="neighbor_oids", string_3="address",
)
DETECTIONS = _row(string="panoid", int="idx", double="fx0 fy0 fx1 fy1 score", string_2="label", double_2="pos_score neg_score")
OCR_CACHE = _row(
    string="key engine text advertiser category construction is_realty developer complex_name offer_type advertiser_type usage", double="created"
)
