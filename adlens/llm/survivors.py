"""One surviving record per duplicate group: Bayesian fusion with copy detection.

Every reading is a source's claim about each field of its group. The operator

1. folds equal claims of a group into one value with the set of sources behind it (a bit
   mask), so a copied row of the same source counts once and a hot group of any size is
   pre-aggregated before it is shuffled; values of one mask are folded once more, so a
   group ends as a list no longer than the masks that occur in it;
2. estimates, until the accuracies stand still, the accuracy of each source in each field
   and, from the values that two sources share where both claim something - shared false
   ones weigh most - the probability that the one copies the other, and which is which;
3. scores a value by the log-odds of its sources, the vote of a likely copy discounted,
   and selects the value of highest posterior.

The prior is flat, or a rule: an order of the rows without ties, the limit of ever stronger
prior odds. No likelihood moves a choice such a prior has made, so `by_rule` selects by the
prior alone, in one combining aggregate; unusable values have prior zero in both.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.session import shared_dir

FIELDS = ("score", "timestamp", "crop_image_path", "phones")
#: Seconds at 2015-01-01 and 2026-01-01 UTC.
FIRST_SECOND, END_SECOND = 1420070400, 1767225600
#: Sources (engines, not rows) that a fusion may tell apart; more are refused.
MAX_SOURCES = 24


def complete_phones(phones: Column) -> Column:
    """Sorted distinct complete numbers (ten digits) of a list of spellings; empty if none."""

    def ten(x: Column) -> Column:
        digits = F.regexp_replace(x, r"[^0-9]", "")
        plus = F.ltrim(x).startswith("+")
        return (
            F.when((F.length(digits) == 11) & (digits.startswith("7") | (digits.startswith("8") & ~plus)), F.substring(digits, 2, 10))
            .when((F.length(digits) == 10) & ~plus, digits)
        )

    numbers = F.filter(F.transform(phones, ten), lambda x: x.isNotNull())
    return F.coalesce(F.array_sort(F.array_distinct(numbers)), F.array().cast("array<string>"))


def usable_path(path: Column) -> Column:
    return path.rlike(r"(?iU)\.(jpg|jpeg|png)\s*$")


def _usable(rows: DataFrame) -> DataFrame:
    """(banner_id, seq, source, score, stamp, path, numbers), null where unusable."""
    score = F.when(F.col("score").between(0.0, 1.0), F.col("score").cast("double"))
    stamp = F.when((F.col("timestamp") >= FIRST_SECOND) & (F.col("timestamp") < END_SECOND), F.col("timestamp").cast("long"))
    path = F.when(usable_path(F.col("crop_image_path")), F.regexp_replace("crop_image_path", r"(?U)^\s+|\s+$", ""))
    numbers = complete_phones(F.col("phones"))
    return rows.filter("banner_id is not null").select(
        F.col("banner_id"), F.col("seq").cast("long").alias("seq"), F.col("ocr_engine").alias("source"),
        score.alias("score"), stamp.alias("stamp"), path.alias("path"), F.when(F.size(numbers) > 0, numbers).alias("numbers"),
    )


def by_rule(rows: DataFrame) -> DataFrame:
    """(banner_id, field_name, seq, value) of the values that the fields' rule puts first.

    Highest score; latest timestamp; path of the latest usable timestamp; most distinct
    complete numbers; then the later usable timestamp, the higher usable score, the smaller
    seq. Only groups of two rows or more have survivors, a field without a usable value has
    no row; null ids form no group, an empty table gives no rows.
    """
    u = _usable(rows)
    last, top, back = F.coalesce("stamp", F.lit(-1)), F.coalesce("score", F.lit(-1.0)), -F.col("seq")

    def best(value: Column, main: Column, name: str) -> Column:
        key = F.struct(main.cast("double").alias("k1"), last.alias("k2"), top.alias("k3"), back.alias("back"), value.cast("string").alias("value"))
        return F.max(F.when(value.isNotNull(), key)).alias(name)

    one = u.groupBy("banner_id").agg(
        F.count(F.lit(1)).alias("n"),
        best(F.col("score"), F.col("score"), "f0"),
        best(F.col("stamp"), F.col("stamp"), "f1"),
        best(F.col("path"), last, "f2"),
        best(F.array_join("numbers", ","), F.size("numbers"), "f3"),
    )
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"f{i}").alias("w")) for i, f in enumerate(FIELDS)])
    found = one.filter("n >= 2").select("banner_id", F.explode(F.filter(each, lambda x: x["w"].isNotNull())).alias("e"))
    return found.select("banner_id", "e.field_name", (-F.col("e.w.back")).alias("seq"), F.col("e.w.value").alias("value"))


def sources_of(rows: DataFrame) -> list[str | None]:
    """The sources, most frequent first; more than MAX_SOURCES are refused."""
    top = rows.filter("banner_id is not null").groupBy("ocr_engine").count().orderBy(F.desc("count"), F.asc_nulls_last("ocr_engine")).limit(MAX_SOURCES + 1).collect()
    if len(top) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return [r[0] for r in top]


def grouped(rows: DataFrame, sources: list[str | None]) -> DataFrame:
    """(banner_id, field, n, masks): rows of the group, and its usable values by source mask.

    `masks` holds (mask, values, best): how many values have exactly these sources, and of
    them the one that the rule puts first. Its length is bounded by the masks, not the rows.
    """
    bit = F.lit(0)
    for i, name in enumerate(sources):
        bit = F.when(F.col("source").isNull() if name is None else F.col("source") == name, 1 << i).otherwise(bit)
    last, top = F.coalesce("stamp", F.lit(-1)), F.coalesce("score", F.lit(-1.0))

    def claim(field: int, value: Column, main: Column) -> Column:
        key = F.struct(main.cast("double").alias("k1"), last.alias("k2"), top.alias("k3"), (-F.col("seq")).alias("back"))
        return F.struct(F.lit(field).cast("tinyint").alias("field"), value.cast("string").alias("value"), F.when(value.isNotNull(), key).alias("key"))

    each = F.array(
        claim(0, F.col("score"), F.col("score")), claim(1, F.col("stamp"), F.col("stamp")), claim(2, F.col("path"), last), claim(3, F.array_join("numbers", ","), F.size("numbers"))
    )
    claims = _usable(rows).select("banner_id", bit.cast("int").alias("bit"), F.explode(each).alias("c"), "seq").select("banner_id", "bit", "c.*")
    values = claims.groupBy("banner_id", "field", "value").agg(F.count("*").alias("n"), F.bit_or("bit").alias("mask"), F.max("key").alias("best"))
    mask = F.when(F.col("value").isNotNull(), F.col("mask")).otherwise(0)
    by_mask = values.groupBy("banner_id", "field", mask.alias("mask")).agg(F.sum("n").alias("n"), F.count("*").alias("values"), F.max(F.struct("best", "value")).alias("best"))
    whole = by_mask.groupBy("banner_id", "field").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col("mask") > 0, F.struct("mask", "values", "best")))).alias("masks"))
    return whole.filter("n >= 2 and size(masks) > 0")


def bits(mask: int) -> list[int]:
    return [i for i in range(mask.bit_length()) if mask >> i & 1]


@dataclass
class Beliefs:
    """Accuracy by (field, source); copies[i, j]: probability that source i copies source j."""

    accuracy: np.ndarray
    copies: np.ndarray
    n_false: int
    copy_rate: float
    rounds: int = 0

    def weights(self) -> np.ndarray:
        return np.log(self.n_false * self.accuracy / (1 - self.accuracy))

    def vote(self, mask: int, field: int) -> float:
        """Log-odds of the mask's sources, each discounted by the chance that it copies another of them."""
        w, who = self.weights()[field], bits(mask)
        return float(sum(w[i] * math.prod(1 - self.copy_rate * self.copies[i, j] for j in who if j != i) for i in who))


class Evidence:
    """Sums over (group, field) from which beliefs are estimated; they add up over partitions."""

    def __init__(self, sources: int):
        n, f = sources, len(FIELDS)
        #: Values claimed and true ones by source; pairs: both true, both false, nothing shared.
        self.claimed, self.right = np.zeros((f, n)), np.zeros((f, n))
        self.true, self.false, self.apart = (np.zeros((f, n, n)) for _ in range(3))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.claimed, self.right, self.true, self.false, self.apart

    def add(self, field: int, masks: list[int], values: list[float], groups: float, chosen: int) -> None:
        """`groups` groups with these masks, `values` of each in all, `chosen` the mask of the truth."""
        shared: set[tuple[int, int]] = set()
        for mask, n in zip(masks, values):
            who = bits(mask)
            t = groups if mask == chosen else 0.0
            for i in who:
                self.claimed[field, i] += n
                self.right[field, i] += t
                for j in who:
                    if i != j:
                        self.true[field, i, j] += t
                        self.false[field, i, j] += n - t
                        shared.add((i, j))
        every = bits(int(np.bitwise_or.reduce(masks)))
        for i in every:
            for j in every:
                if i != j and (i, j) not in shared:
                    self.apart[field, i, j] += groups

    def beliefs(self, n_false: int, copy_rate: float, prior: float) -> Beliefs:
        """Accuracies, and of three hypotheses for each pair (apart, one copies, the other does) the posteriors."""
        accuracy = np.clip((self.right + 1) / (self.claimed + 2), 0.02, 0.98)
        n = accuracy.shape[1]
        copies = np.zeros((n, n))
        c = copy_rate
        for i in range(n):
            for j in range(i):
                score = [math.log(1 - prior), math.log(prior / 2), math.log(prior / 2)]
                for f in range(len(FIELDS)):
                    t, x, d = self.true[f, i, j], self.false[f, i, j], self.apart[f, i, j]
                    if not t + x + d:
                        continue
                    a, b = accuracy[f, i], accuracy[f, j]
                    p = (a * b, (1 - a) * (1 - b) / n_false)
                    p = (*p, max(1e-9, 1 - sum(p)))
                    score[0] += t * math.log(p[0]) + x * math.log(p[1]) + d * math.log(p[2])
                    for k, orig in ((1, b), (2, a)):  # i copies j; j copies i
                        score[k] += t * math.log(c * orig + (1 - c) * p[0]) + x * math.log(c * (1 - orig) + (1 - c) * p[1]) + d * math.log((1 - c) * p[2])
                top = max(score)
                odds = [math.exp(s - top) for s in score]
                copies[i, j], copies[j, i] = odds[1] / sum(odds), odds[2] / sum(odds)
        return Beliefs(accuracy, copies, n_false, copy_rate)


def believed(groups: DataFrame, sources: int, n_false: int = 10, copy_rate: float = 0.8, copy_prior: float = 0.1, tolerance: float = 1e-3, max_rounds: int = 30) -> Beliefs:
    """Beliefs over all groups, from selecting truths and estimating in turn until accuracies move less than `tolerance`.

    The choice in a group depends on the set of its masks only, so groups of one set are
    one row of a small table; every round is a pass over it, whose tasks return sums of
    fixed size.
    """
    shape = groups.select("field", F.transform("masks", lambda m: m["mask"]).alias("set"), F.transform("masks", lambda m: m["values"]).alias("values"))
    wide = shape.select("field", "set", F.posexplode("values").alias("i", "v")).groupBy("field", "set", "i").agg(F.sum("v").alias("v"), F.count("*").alias("groups"))
    sets = wide.groupBy("field", "set").agg(F.max("groups").alias("groups"), F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")).select("field", "set", "groups", F.col("v.v").alias("values")).checkpoint()
    now = Beliefs(np.full((len(FIELDS), sources), 0.8), np.zeros((sources, sources)), n_false, copy_rate)
    for rounds in range(1, max_rounds + 1):

        def run(batches: Iterator[pd.DataFrame], old: Beliefs = now) -> Iterator[pd.DataFrame]:
            e = Evidence(sources)
            for df in batches:
                for field, masks, n, values in zip(df["field"], df["set"], df["groups"], df["values"]):
                    masks = [int(m) for m in masks]
                    chosen = max(masks, key=lambda m: (old.vote(m, field), m))
                    e.add(int(field), masks, [float(v) for v in values], float(n), chosen)
            yield pd.DataFrame({"sums": [np.concatenate([p.ravel() for p in e.parts()]).tolist()]})

        e = Evidence(sources)
        for r in sets.coalesce(8).mapInPandas(run, "sums array<double>").collect():
            at = 0
            for p in e.parts():
                p += np.array(r.sums[at : at + p.size]).reshape(p.shape)
                at += p.size
        new = e.beliefs(n_false, copy_rate, copy_prior)
        moved = np.abs(new.accuracy - now.accuracy).max() if new.accuracy.size else 0.0
        now = new
        now.rounds = rounds
        if moved < tolerance:
            break
    return now


def _vote(b: Beliefs, mask: Column, field: Column) -> Column:
    """`Beliefs.vote` as an expression."""
    w, total = b.weights(), F.lit(0.0)
    has = [mask.bitwiseAND(F.lit(1 << i)) > 0 for i in range(len(b.copies))]
    for i in range(len(has)):
        part = F.element_at(F.array(*[F.lit(float(x)) for x in w[:, i]]), field.cast("int") + 1)
        for j in range(len(has)):
            if j != i and b.copies[i, j] > 0:
                part = part * F.when(has[j], float(1 - b.copy_rate * b.copies[i, j])).otherwise(1.0)
        total = total + F.when(has[i], part).otherwise(0.0)
    return total


def fuse(rows: DataFrame, n_false: int = 10, copy_rate: float = 0.8, copy_prior: float = 0.1) -> DataFrame:
    """(banner_id, field_name, seq, value, posterior) of the value of highest posterior of each field, under a flat prior.

    Votes that are equal are told apart by the field's rule (see `by_rule`). Only groups of
    two rows or more have a survivor; a field without a usable value has no row. Null ids
    form no group, null sources are one source, repeated rows of a source vote once. An
    empty table gives no rows. More than MAX_SOURCES sources are refused.
    """
    shared_dir(rows.sparkSession)
    rows = rows.select("banner_id", "seq", "ocr_engine", "score", "timestamp", "crop_image_path", "phones")
    sources = sources_of(rows)
    groups = grouped(rows, sources).checkpoint()
    b = believed(groups, len(sources), n_false, copy_rate, copy_prior)
    voted = F.transform("masks", lambda m: F.struct(_vote(b, m["mask"], F.col("field")).alias("vote"), m["best"].alias("best"), m["values"].alias("values")))
    w = F.array_max("voted")
    mass = F.aggregate("voted", F.lit(0.0), lambda s, v: s + v["values"] * F.exp(v["vote"] - F.col("w.vote")))
    return groups.withColumn("voted", voted).withColumn("w", w).select(
        "banner_id",
        F.element_at(F.array(*map(F.lit, FIELDS)), F.col("field").cast("int") + 1).alias("field_name"),
        (-F.col("w.best.best.back")).alias("seq"),
        F.col("w.best.value").alias("value"),
        (1 / mass).alias("posterior"),
    )
