"""Phones, sites and messenger handles as Column expressions.

Every extractor is one regular-expression scan in the JVM and keeps order of appearance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Area codes of mobile networks beside those that begin with 9.
KZ_MOBILE = (*range(700, 709), 747, 750, 751, *range(760, 765), *range(771, 779))
# Separators within a phone number, and top-level domains looked for.
SEPARATORS = r"[\s.\-()‐-―]*"
TLDS = ("ru", "рф", "com", "kz", "net", "org", "su", "pro", "info", "shop", "online", "store", "moscow")


def phone_spellings(text: Column, prefix: str = r"\+?7|8") -> Column:
    """Phone numbers as written: country prefix, then 3-3-2-2 digits, no digit around them."""
    s = SEPARATORS
    pattern = rf"(?U)(?<!\d)(?:{prefix}){s}\d{{3}}{s}\d{{3}}{s}\d{{2}}{s}\d{{2}}(?!\d)"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def code_kind(code: Column) -> Column:
    """mobile_ru, mobile_kz, geo_ru or unknown by the three-digit area code."""
    return (
        F.when(code.startswith("9"), "mobile_ru")
        .when(code.isin([str(c) for c in KZ_MOBILE]), "mobile_kz")
        .when(F.substring(code, 1, 1).isin("3", "4", "8"), "geo_ru")
        .otherwise("unknown")
    )


def numbers(text: Column, prefix: str = r"\+?7|8", country: str = "+7") -> Column:
    digits = F.transform(phone_spellings(text, prefix), lambda x: F.right(F.regexp_replace(x, r"(?U)\D", ""), F.lit(10)))
    return F.array_distinct(F.transform(digits, lambda d: F.concat(F.lit(country), d)))


def _known(number: Column, country: str) -> Column:
    return code_kind(F.substring(number, len(country) + 1, 3)) != "unknown"


def phones(text: Column, prefix: str = r"\+?7|8", country: str = "+7") -> Column:
    """Distinct numbers with a known area code, in order of appearance."""
    return F.filter(numbers(text, prefix, country), lambda n: _known(n, country))


def unreliable_phones(text: Column, prefix: str = r"\+?7|8", country: str = "+7") -> Column:
    return F.filter(numbers(text, prefix, country), lambda n: ~_known(n, country))


def sites(text: Column) -> Column:
    """Distinct lower-case hosts of one label and a known top-level domain."""
    pattern = rf"(?iuU)(?:https?://)?(?:www\.)?[a-z0-9][a-z0-9\-]{{1,40}}\.(?:{'|'.join(TLDS)})\b"
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(F.lower(x), r"^(https?://)?(www\.)?", ""))
    return F.array_distinct(F.filter(bare, lambda x: F.length(x) >= 5))


def telegram(text: Column) -> Column:
    """Distinct lower-case handles; the part of a mail address after @ counts as one."""
    pattern = r"(?:t\.me/|telegram\.me/|@)([a-zA-Z][a-zA-Z0-9_]{3,31})"
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.concat(F.lit("@"), F.lower(x))))


def contacts(text: Column) -> Column:
    """struct<phones, phones_unreliable, sites, telegram> of array<string>; null text gives empty lists."""
    return F.struct(phones(text).alias("phones"), unreliable_phones(text).alias("phones_unreliable"), sites(text).alias("sites"), telegram(text).alias("telegram"))


def demoted(contact: Column, smallest_side: Column, min_side: int) -> Column:
    """Contacts whose phones count as unreliable when read from a crop below `min_side`."""
    small = smallest_side < min_side
    none = F.array().cast("array<string>")
    return F.struct(
        F.when(small, none).otherwise(contact["phones"]).alias("phones"),
        F.when(small, F.concat(contact["phones_unreliable"], contact["phones"])).otherwise(contact["phones_unreliable"]).alias("phones_unreliable"),
        contact["sites"].alias("sites"),
        contact["telegram"].alias("telegram"),
    )
