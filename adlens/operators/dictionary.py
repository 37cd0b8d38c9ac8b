"""Advertiser lookup: exact and longest-substring complexes, exact and longest-word aliases.

The directory (checked to be small) becomes one constant array, sorted longest first, so
the whole cascade is a projection: no join, no shuffle, whatever the number of rows.
SURVEY J7-J10, S16, M8.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.binding import let
from adlens.functions.text import name_key, strip

DEFAULT_CATEGORY = "недвижимость"
#: Entries beyond which a directory no longer is a constant of the plan.
MAX_KEYS = 20_000
ENTRY = "struct<key: string, canonical: string, role: string, complex: string, site: string, phone: string, category: string>"
ANSWER = "struct<canonical: string, matched: boolean, role: string, complex_name: string, site: string, phone: string, category: string>"


def key_of(text: str) -> str:
    return re.sub(r"[^0-9a-zа-я]+", " ", (text or "").lower().replace("ё", "е")).strip(" ")


def entries(brands: Iterable[Mapping]) -> tuple[list[dict], list[dict]]:
    """(aliases, complexes) by key; of equal keys the later entry counts, at the earlier place."""
    aliases: dict[str, dict] = {}
    complexes: dict[str, dict] = {}
    for b in brands:
        base = {"canonical": b["canonical"], "role": b.get("role"), "site": b.get("site"), "phone": b.get("phone"), "category": b.get("category") or DEFAULT_CATEGORY}
        for a in (b["canonical"], *(b.get("aliases") or ())):
            if a and (k := key_of(a)):
                aliases[k] = base | {"key": k}
        for c in b.get("complexes") or ():
            if c and (k := key_of(c)):
                complexes[k] = base | {"key": k, "complex": c}
    if len(aliases) + len(complexes) > MAX_KEYS:
        raise ValueError(f"the directory has more than {MAX_KEYS} keys")
    longest = lambda d: sorted(d.values(), key=lambda e: -len(e["key"]))
    return longest(aliases), longest(complexes)


def _constant(rows: list[dict]) -> Column:
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), f"array<{ENTRY}>")


class Directory:
    def __init__(self, brands: Iterable[Mapping]):
        self.aliases, self.complexes = map(_constant, entries(brands))

    @classmethod
    def from_table(cls, brands: DataFrame, order: str = "brand_id") -> Directory:
        rows = brands.orderBy(order).limit(MAX_KEYS + 1).collect()
        return cls([r.asDict() for r in rows])

    def _complex(self, key: Column) -> Column:
        exact = F.get(F.filter(self.complexes, lambda e: e["key"] == key), F.lit(0))
        inside = F.get(F.filter(self.complexes, lambda e: (F.length(e["key"]) >= 5) & F.contains(key, e["key"])), F.lit(0))
        return F.when(key != "", F.coalesce(exact, inside))

    def _alias(self, key: Column) -> Column:
        exact = F.get(F.filter(self.aliases, lambda e: e["key"] == key), F.lit(0))
        within = lambda spaced: F.filter(self.aliases, lambda e: (F.length(e["key"]) >= 3) & F.contains(spaced, F.concat(F.lit(" "), e["key"], F.lit(" "))))
        word = F.get(let(F.concat(F.lit(" "), key, F.lit(" ")), within), F.lit(0))
        return F.when(key != "", F.coalesce(exact, word))

    def lookup(self, raw: Column, hint: Column | None = None) -> Column:
        """struct of the entry meant: complex of the hint, complex of the name, alias, else the name itself.

        Unknown names come back trimmed and unmatched; null or signless names give nulls.
        """
        by_name = lambda key: F.coalesce(self._complex(key), self._alias(key))
        hit = let(name_key(raw), by_name)
        if hint is not None:
            hit = F.coalesce(let(name_key(hint), self._complex), hit)
        return let(hit, lambda h: self._answer(h, raw))

    @staticmethod
    def _answer(hit: Column, raw: Column) -> Column:
        known = F.struct(
            hit["canonical"].alias("canonical"), F.lit(True).alias("matched"), hit["role"].alias("role"), hit["complex"].alias("complex_name"),
            hit["site"].alias("site"), hit["phone"].alias("phone"), hit["category"].alias("category"),
        )
        none = F.lit(None).cast("string")
        unknown = F.struct(
            F.when(name_key(raw) != "", strip(raw)).alias("canonical"), F.lit(False).alias("matched"), none.alias("role"), none.alias("complex_name"),
            none.alias("site"), none.alias("phone"), none.alias("category"),
        )
        return F.when(hit.isNotNull(), known).otherwise(unknown).cast(ANSWER)
