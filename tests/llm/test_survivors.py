import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm.survivors import FIELDS, Beliefs, Evidence, believed, by_rule, fuse, grouped, sources_of

SCHEMA = "banner_id string, seq long, ocr_engine string, score double, timestamp long, crop_image_path string, phones array<string>"


def complete(phones):
    out = set()
    for p in phones or ():
        d = re.sub(r"\D", "", p or "")
        plus = (p or "").lstrip().startswith("+")
        if len(d) == 11 and (d[0] == "7" or d[0] == "8" and not plus):
            out.add(d[1:])
        elif len(d) == 10 and not plus:
            out.add(d)
    return out


def rule(rows):
    """The survivors by the rule, by sorting each group."""
    groups = {}
    for r in rows:
        if r[0] is not None:
            groups.setdefault(r[0], []).append(r)
    out = set()
    for b, g in groups.items():
        if len(g) < 2:
            continue
        for field in FIELDS:
            best = None
            for _, seq, _, score, ts, path, phones in g:
                sc = score if score is not None and 0 <= score <= 1 else None
                t = ts if ts is not None and 1420070400 <= ts < 1767225600 else None
                last, top = -1 if t is None else t, -1.0 if sc is None else sc
                key = {
                    "score": sc, "timestamp": t,
                    "crop_image_path": last if path and re.search(r"\.(jpg|jpeg|png)\s*$", path, re.I) else None,
                    "phones": len(complete(phones)) or None,
                }[field]
                if key is not None:
                    best = max(best or (float("-inf"),), (key, last, top, -seq))
            if best:
                out.add((b, field, -best[3]))
    return out


def rows(seed, n=400):
    r = random.Random(seed)
    out = []
    for i in range(n):
        if out and r.random() < 0.15:
            out.append((r.choice(out)[0], i, *r.choice(out)[2:]))
            continue
        out.append((
            r.choice([None, "hot", f"b{r.randrange(60)}"]), i, r.choice(["a", "b", "c", None]), r.choice([None, float("nan"), -1.0, 0.0, 1.0, 0.5, 39.5, r.random()]),
            r.choice([None, 0, 1420070399, 1420070400, 1767225599, 1767225600, r.randrange(1420070400, 1767225600), 1600000000]),
            r.choice([None, "", " ", "n/a", "x.jpg", "x.JPEG ", "x.png", "x.jpg.part"]),
            r.choice([None, [], [None], ["+7 912 345-67-89", "89123456789"], ["9123456789", "84951112233"], ["+89123456789"], ["99", "+7"], ["+9123456789"]]),
        ))
    return out


def test_rule_equals_sorting(spark):
    for seed in (1, 2):
        data = rows(seed)
        df = spark.createDataFrame(data, SCHEMA).withColumn("field", F.lit("clash")).withColumn("n", F.lit(9)).repartition(5)
        assert {(r.banner_id, r.field_name, r.seq) for r in by_rule(df).collect()} == rule(data)


def test_flat_prior_follows_the_votes_and_discounts_copies(spark):
    t0 = 1600000000
    # Three independent sources agree; the fourth disagrees with a later time.
    data = [(f"g{i}", 4 * i + k, s, 0.5, t0 + (9 if s == "d" else 0), None, None) for i in range(30) for k, s in enumerate("abcd")]
    got = {r.banner_id: r for r in fuse(spark.createDataFrame(data, SCHEMA)).filter("field_name = 'timestamp'").collect()}
    assert all(r.value == str(t0) and r.posterior > 0.5 for r in got.values()) and len(got) == 30
    # A row copied many times is one vote of its source.
    more = data + [("g0", 1000 + i, "d", 0.5, t0 + 9, None, None) for i in range(50)]
    again = {r.banner_id: r.value for r in fuse(spark.createDataFrame(more, SCHEMA)).filter("field_name = 'timestamp'").collect()}
    assert again["g0"] == str(t0)


def planted(seed, groups=400):
    """Readings of known truth: source -> accuracy; `e` copies four of five values of `d`, the least accurate."""
    r = random.Random(seed)
    accuracy = {"a": 0.9, "b": 0.85, "c": 0.75, "d": 0.55}
    data, truth, seq = [], {}, 0
    for g in range(groups):
        t = truth[f"g{g}"] = 1600000000 + 100 * g
        said = {s: t if r.random() < x else t + r.randrange(1, 8) for s, x in accuracy.items() if r.random() < 0.8}
        if "d" in said and r.random() < 0.9:
            said["e"] = said["d"] if r.random() < 0.8 else t if r.random() < 0.55 else t + r.randrange(1, 8)
        for s, v in said.items():
            data.append((f"g{g}", seq, s, None, v, None, None))
            seq += 1
    return data, truth


def test_planted_copier_is_found_and_discounted(spark):
    data, truth = planted(4)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    sources = sources_of(df)
    b = believed(grouped(df, sources), len(sources))
    at = {s: i for i, s in enumerate(sources)}
    assert b.rounds < 30
    pair = b.copies[at["d"], at["e"]] + b.copies[at["e"], at["d"]]
    assert pair > 0.95
    for x in "abc":
        for y in "abcde":
            assert x == y or b.copies[at[x], at[y]] + b.copies[at[y], at[x]] < 0.1, (x, y)
    for s, want in (("a", 0.9), ("b", 0.85), ("c", 0.75), ("d", 0.55)):
        assert abs(b.accuracy[1, at[s]] - want) < 0.08, (s, b.accuracy[1, at[s]])
    got = {r.banner_id: r for r in fuse(df).filter("field_name = 'timestamp'").collect()}
    right = sum(int(r.value) == truth[g] for g, r in got.items()) / len(got)
    votes = {}
    for g, _, _, _, v, _, _ in data:
        votes.setdefault(g, []).append(v)
    plain = sum(max(set(v), key=lambda x: (v.count(x), x)) == truth[g] for g, v in votes.items() if g in got) / len(got)
    assert right > 0.9 and right > plain + 0.03, (right, plain)
    # Posteriors are calibrated: the mean posterior is about the share of right values.
    assert abs(sum(r.posterior for r in got.values()) / len(got) - right) < 0.06


def test_values_on_which_the_other_is_silent_say_nothing():
    """Two sources share 60 values, 50 of them false: dependent, however much each says alone."""
    for alone in (0.0, 1000.0):
        e = Evidence(2)
        e.add(1, [0b11], [50.0], 50.0, 0)
        e.add(1, [0b11], [10.0], 10.0, 0b11)
        if alone:
            e.add(1, [0b01], [alone], alone, 0b01)
            e.add(1, [0b10], [alone], alone, 0b10)
        b = e.beliefs(10, 0.8, 0.1)
        assert b.copies[0, 1] + b.copies[1, 0] > 0.99, alone


def test_direction_and_votes():
    b = Beliefs(np.full((4, 3), 0.8), np.zeros((3, 3)), 10, 0.8)
    alone = b.vote(0b001, 1)
    assert abs(b.vote(0b111, 1) - 3 * alone) < 1e-9 and b.vote(0, 1) == 0
    b.copies[2, 0] = 0.9  # source 2 copies source 0
    assert abs(b.vote(0b101, 1) - alone * (1 + 1 - 0.8 * 0.9)) < 1e-9 and abs(b.vote(0b100, 1) - alone) < 1e-9


def test_empty_and_single(spark):
    df = spark.createDataFrame(rows(3), SCHEMA)
    for f in (fuse, by_rule):
        assert f(df.limit(0)).count() == 0
        assert f(df.filter("banner_id = 'hot'").limit(1)).count() == 0
        assert f(df.filter("banner_id is null")).count() == 0
    many = spark.createDataFrame([("g", i, f"s{i}", 0.5, None, None, None) for i in range(30)], SCHEMA)
    with pytest.raises(ValueError):
        fuse(many)
