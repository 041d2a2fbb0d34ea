"""Product x aspect scores and the figures derived from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import ASPECTS, MIN_REVIEWS, SENTIMENTS, SHORT
from ..functions.numbers import percent


def _score(pos, neg):
    return F.bround(F.try_divide(pos - neg, pos + neg), 3)


def aspect_counts(reviews: DataFrame) -> DataFrame:
    """product_id, n_reviews and 18 counts from reviews with a ``label`` array.

    One shuffle of map-side combined counts per product. ``n_reviews`` counts
    the reviews with a non-empty label, their first item stands for them;
    products without any valid item are left out.
    """
    items = reviews.select("product_id", F.posexplode("label").alias("no", "item"))
    counts = [
        F.count_if((F.col("item.aspect") == a) & (F.col("item.sentiment") == s)).alias(f"{a}_{SHORT[s]}")
        for a in ASPECTS for s in SENTIMENTS
    ]
    valid = F.count_if(F.col("item.aspect").isin(ASPECTS) & F.col("item.sentiment").isin(SENTIMENTS))
    return (
        items.groupBy("product_id").agg(F.count_if(F.col("no") == 0).alias("n_reviews"), valid.alias("_valid"), *counts)
        .filter("_valid > 0").drop("_valid")
    )


def aspect_scores_wide(reviews: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """One row per product: n_reviews and pos, neu, neg, score, conf per aspect."""
    return scored(aspect_counts(reviews), min_reviews)


def scored(counts: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Counts of each product with a score and a confidence per aspect."""
    columns = [F.col("product_id"), F.col("n_reviews")]
    for a in ASPECTS:
        pos, neu, neg = (F.col(f"{a}_{s}") for s in ("pos", "neu", "neg"))
        total = pos + neu + neg
        score = F.when(total >= min_reviews, F.coalesce(_score(pos, neg), F.lit(0.0)))
        conf = F.bround(F.least(total / F.lit(3 * min_reviews), F.lit(1.0)), 3)
        columns += [pos, neu, neg, score.alias(f"{a}_score"), conf.alias(f"{a}_conf")]
    return counts.select(columns)


def wide_to_long(wide: DataFrame) -> DataFrame:
    """product_id, n_reviews, aspect, pos, neu, neg, score, conf: six rows each."""
    parts = ("pos", "neu", "neg", "score", "conf")
    items = F.array(*[
        F.struct(F.lit(a).alias("aspect"), *[F.col(f"{a}_{p}").alias(p) for p in parts]) for a in ASPECTS
    ])
    return wide.select("product_id", "n_reviews", F.explode(items).alias("s")).select("product_id", "n_reviews", "s.*")


def aspect_scores(reviews: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    return wide_to_long(aspect_scores_wide(reviews, min_reviews))


def aspect_satisfaction(labels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per aspect (and ``keys``): pos, neg, total without neutral, percent, score.

    Takes rows with one sentiment column per aspect. All six aspects appear.
    """
    keys = keys or []
    counts = [
        F.count_if(F.col(a) == s).alias(f"{a}_{SHORT[s]}") for a in ASPECTS for s in ("positive", "negative")
    ]
    wide = labels.groupBy(*keys).agg(*counts)
    items = F.explode(F.array(*[
        F.struct(F.lit(a).alias("aspect"), F.col(f"{a}_pos").alias("pos"), F.col(f"{a}_neg").alias("neg"))
        for a in ASPECTS
    ]))
    long = wide.select(*keys, items.alias("s")).select(*keys, "s.*")
    return with_satisfaction(long)


def with_satisfaction(long: DataFrame) -> DataFrame:
    total = F.col("pos") + F.col("neg")
    return long.withColumns({
        "total": total,
        "pct": percent(F.col("pos"), total),
        "score": F.coalesce(_score(F.col("pos"), F.col("neg")), F.lit(0.0)),
    })


def total_analyzed(satisfaction: DataFrame, keys: list[str]) -> DataFrame:
    """Largest number of opinions over the aspects."""
    return satisfaction.groupBy(*keys).agg(F.max("total").alias("total_analyzed"))


def sentiment_distribution(items: DataFrame) -> DataFrame:
    """Counts for all 18 aspect x sentiment pairs, empty ones as 0, from
    (aspect, sentiment) rows; ``position`` is the fixed order."""
    valid = F.col("aspect").isin(ASPECTS) & F.col("sentiment").isin(SENTIMENTS)
    counts = [
        F.count_if((F.col("aspect") == a) & (F.col("sentiment") == s)).alias(f"{a}|{s}")
        for a in ASPECTS for s in ("positive", "negative", "neutral")
    ]
    one = items.filter(valid).agg(*counts)
    cells = F.posexplode(F.array(*[
        F.struct(F.lit(a).alias("aspect"), F.lit(s).alias("sentiment"), F.col(f"`{a}|{s}`").alias("n"))
        for a in ASPECTS for s in ("positive", "negative", "neutral")
    ]))
    return one.select(cells.alias("position", "c")).select("position", "c.*")
