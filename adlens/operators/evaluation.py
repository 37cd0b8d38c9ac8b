"""How well engines read: recall, fields, time and cost by engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.scoring import answer_matches, word_recall


def engine_report(pairs: DataFrame, price_in: float = 0.0, price_out: float = 0.0) -> DataFrame:
    """(engine, n, recall, advertiser_ok, category_ok, seconds, cost_per_100k) of readings beside their truth.

    Columns of `pairs`: engine, text, advertiser and category of the reading and of the truth
    (true_text...), failed, seconds, input_tokens, output_tokens. Failed readings don't
    count; prices are for a million tokens; shares are in percent but recall. Null texts
    recall nothing, a truth without words has no recall, missing tokens are none; an
    engine that always failed has n 0 and nulls.
    """
    c = F.col
    ok = ~F.coalesce("failed", F.lit(False))
    share = lambda name: F.round(100 * F.avg(F.when(ok, answer_matches(c(f"true_{name}"), c(name)).cast("int"))), 6)
    tokens = lambda name: F.coalesce(F.sum(F.when(ok, c(name))), F.lit(0))
    n = F.count_if(ok)
    spent = (tokens("input_tokens") * price_in + tokens("output_tokens") * price_out) / 1e6
    return pairs.groupBy("engine").agg(
        n.alias("n"),
        F.round(F.avg(F.when(ok, word_recall(c("true_text"), F.coalesce("text", F.lit(""))))), 6).alias("recall"),
        share("advertiser").alias("advertiser_ok"),
        share("category").alias("category_ok"),
        F.round(F.avg(F.when(ok, c("seconds"))), 6).alias("seconds"),
        F.round(F.try_divide(spent, n) * 100_000, 6).alias("cost_per_100k"),
    )
