"""Aggregations over labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECTS, SENTIMENTS, SHORT
from ..operators import scores
from . import bindings as b
from .registry import query

# Wide scores as SQL: one row per product with a valid item.
b.add_view("aspect_counts", ["labeled_heads"], "SELECT product_id, count(coalesce("
           + ", ".join(ASPECTS) + ")) AS n_reviews, "
           + ", ".join(f"count(*) FILTER (WHERE {a} = '{s}') AS {a}_{SHORT[s]}" for a in ASPECTS for s in SENTIMENTS)
           + " FROM labeled_heads GROUP BY product_id HAVING n_reviews > 0")
_cells = []
for _a in ASPECTS:
    _t = f"({_a}_pos + {_a}_neu + {_a}_neg)"
    _cells += [f"{_a}_pos", f"{_a}_neu", f"{_a}_neg",
               f"CASE WHEN {_t} >= 1 THEN coalesce(round_even(({_a}_pos - {_a}_neg) / nullif({_a}_pos + {_a}_neg, 0), 3), 0.0) END AS {_a}_score",
               f"round_even(least({_t} / 3, 1.0), 3) AS {_a}_conf"]
b.add_view("scores_wide", ["aspect_counts"], "SELECT product_id, n_reviews, " + ", ".join(_cells) + " FROM aspect_counts")
b.add_view("scores_long", ["scores_wide"], " UNION ALL ".join(
    f"SELECT product_id, n_reviews, '{a}' AS aspect, {a}_pos AS pos, {a}_neu AS neu, {a}_neg AS neg, "
    f"{a}_score AS score, {a}_conf AS conf FROM scores_wide" for a in ASPECTS))


def wide_scores(spark, sf_dir):
    return scores.aspect_scores_wide(b.labeled_heads(spark, sf_dir))


@query("aspect_scores", b.sql(["scores_long"], "SELECT * FROM scores_long"))
def aspect_scores(spark, sf_dir):
    return scores.aspect_scores(b.labeled_heads(spark, sf_dir))


@query("aspect_scores_wide", b.sql(["scores_wide"], "SELECT * FROM scores_wide"))
def aspect_scores_wide(spark, sf_dir):
    return wide_scores(spark, sf_dir)


@query("best_and_worst_products", b.sql(["scores_wide", "product_heads"], """
    , ranked AS (
        SELECT p.product_id, p.name, p.brand_name, p.price, s.n_reviews, s.quality_score, s.quality_conf
        FROM scores_wide s JOIN product_heads p USING (product_id) WHERE s.quality_score IS NOT NULL)
    SELECT * FROM (SELECT 'best' AS side, * FROM ranked ORDER BY quality_score DESC, n_reviews DESC, product_id LIMIT 10)
    UNION ALL
    SELECT * FROM (SELECT 'worst' AS side, * FROM ranked ORDER BY quality_score, n_reviews DESC, product_id LIMIT 10)"""))
def best_and_worst_products(spark, sf_dir):
    ranked = wide_scores(spark, sf_dir).filter("quality_score IS NOT NULL").join(
        b.product_heads(spark, sf_dir), "product_id"
    ).select("product_id", "name", "brand_name", "price", "n_reviews", "quality_score", "quality_conf")
    side = lambda name, first: ranked.orderBy(first, F.desc("n_reviews"), "product_id").limit(10).select(
        F.lit(name).alias("side"), "*")
    return side("best", F.desc("quality_score")).unionByName(side("worst", F.asc("quality_score")))


# Labels with one column per aspect, missing ones neutral, as predictions.
_SATISFACTION = """
    SELECT aspect, pos, neg, pos + neg AS total,
           CAST(CASE WHEN pos + neg > 0 THEN round_even(100 * pos / (pos + neg), 0) ELSE 0 END AS INTEGER) AS pct,
           CASE WHEN pos + neg > 0 THEN round_even((pos - neg) / (pos + neg), 3) ELSE 0.0 END AS score"""
b.add_view("satisfaction_counts", ["labeled_heads"], " UNION ALL ".join(
    f"SELECT product_id, '{a}' AS aspect, count(*) FILTER (WHERE {a} = 'positive') AS pos, "
    f"count(*) FILTER (WHERE {a} = 'negative') AS neg FROM labeled_heads GROUP BY product_id" for a in ASPECTS))
b.add_view("satisfaction", ["satisfaction_counts"], _SATISFACTION + ", product_id FROM satisfaction_counts")


def label_columns(df, default="neutral"):
    from ..functions.labels import label_to_columns

    return df.select("*", *label_to_columns(F.col("label"), default))


def satisfaction(spark, sf_dir):
    return scores.aspect_satisfaction(label_columns(b.labeled_heads(spark, sf_dir)), ["product_id"])


@query("aspect_satisfaction", b.sql(["satisfaction"], "SELECT * FROM satisfaction"))
def aspect_satisfaction(spark, sf_dir):
    return satisfaction(spark, sf_dir)


@query("total_analyzed", b.sql(["satisfaction"], """
    SELECT product_id, max(total) AS total_analyzed FROM satisfaction GROUP BY product_id"""))
def total_analyzed(spark, sf_dir):
    return scores.total_analyzed(satisfaction(spark, sf_dir), ["product_id"])


@query("aspect_sentiment_distribution", b.sql(["label_items"], f"""
    SELECT CAST(a.i * 3 + s.i AS INTEGER) AS position, a.aspect, s.sentiment, count(l.review_id) AS n
    FROM (SELECT unnest({b._ASPECT_LIST}) AS aspect, generate_subscripts({b._ASPECT_LIST}, 1) - 1 AS i) a
    CROSS JOIN (SELECT unnest(['positive', 'negative', 'neutral']) AS sentiment, unnest([0, 1, 2]) AS i) s
    LEFT JOIN label_items l ON l.aspect = a.aspect AND l.sentiment = s.sentiment
    GROUP BY ALL"""))
def aspect_sentiment_distribution(spark, sf_dir):
    return scores.sentiment_distribution(b.label_items(spark, sf_dir))
