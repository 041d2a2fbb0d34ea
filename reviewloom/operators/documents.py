"""Retrieval documents: product cards, aspect summaries and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ASPECT_DOC_NAMES, ASPECTS
from ..functions.identifiers import delta_doc_id
from ..functions.labels import overall_sentiment, verdict_band
from ..functions.numbers import (
    adaptive_k, format_price, negative_limit, percent, positive_limit, safe_float, safe_int,
)
from ..functions.text import clean_html_text, strip
from .layout import top_per_key
from .merge import concat_parts, of_products

# Order in which document kinds are written; the first of equal ids wins.
DOC_TYPES = ["product_card", "aspect_summary", "review", "new_review"]
# No product shows more than 14 positive and 6 negative reviews (k <= 20).
MAX_PER_POLARITY = 14
# Characters of a review that its document shows.
REVIEW_CHARS = 600
NEW_REVIEW_CHARS = 800


def details(products: DataFrame, scores: DataFrame) -> DataFrame:
    """Products with their wide scores, NULL where a product has none."""
    return products.join(scores, "product_id", "left")


def metadata_columns() -> list[Column]:
    """8 base fields, n_reviews and 4 x 6 aspect fields."""
    base = [
        F.col("product_id"), F.col("name"), F.col("brand_name"), F.col("category_name"),
        safe_int(F.col("price")).alias("price"), safe_float(F.col("rating_average")).alias("rating_average"),
        safe_int(F.col("review_count")).alias("review_count"), F.col("product_url"),
        F.col("n_reviews").alias("absa_n_reviews"),
    ]
    for a in ASPECTS:
        base += [F.col(f"{a}_{part}").alias(f"absa_{a}_{part}") for part in ("score", "pos", "neg", "conf")]
    return base


def _metadata() -> Column:
    return F.struct(*metadata_columns()).alias("metadata")


def _shown(c: Column, other: str = "n/a") -> Column:
    return F.coalesce(c.cast("string"), F.lit(other))


def _doc_id(suffix: Column | str) -> Column:
    tail = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit("prod_"), F.col("product_id").cast("string"), tail).alias("id")


def product_cards(det: DataFrame) -> DataFrame:
    """One card per product, from ``details`` with raw HTML descriptions."""
    for c in ("short_description", "ai_review_summary"):
        if c not in det.columns:
            det = det.withColumn(c, F.lit(None).cast("string"))
    def described(c: str, head: str) -> Column:
        cleaned = F.nullif(clean_html_text(F.col(c)), F.lit(""))
        return F.concat(F.lit(head), F.substring(cleaned, 1, 500))

    content = F.concat_ws(
        "\n",
        F.concat(F.lit("Sản phẩm: "), _shown(F.col("name"), "")),
        F.concat(F.lit("Thương hiệu: "), _shown(F.col("brand_name"))),
        F.concat(F.lit("Danh mục: "), _shown(F.col("category_name"))),
        F.concat(F.lit("Giá: "), format_price(F.col("price"))),
        F.concat(F.lit("Đánh giá: "), _shown(F.col("rating_average")), F.lit("/5 ("),
                 F.coalesce(safe_int(F.col("review_count")), F.lit(0)).cast("string"), F.lit(" đánh giá)")),
        described("short_description", "Mô tả: "),
        described("ai_review_summary", "Tóm tắt đánh giá: "),
    )
    return det.select(
        _doc_id("_card"), F.lit("product_card").alias("doc_type"), content.alias("content"), _metadata())


def aspect_summaries(det: DataFrame) -> DataFrame:
    """One summary per product that has opinions.

    Scored products have at least one opinion, so the test is whether a product
    is scored; a test on the sum of all counts would be correct too, but makes
    the optimizer derive constraints for every combination of the 18 counts.
    """
    lines = []
    for a in ASPECTS:
        pos, neu, neg = (F.col(f"{a}_{s}") for s in ("pos", "neu", "neg"))
        total = pos + neu + neg
        pct_pos, pct_neg = percent(pos, total), percent(neg, total)
        name = ASPECT_DOC_NAMES[a].capitalize()
        lines.append(F.when(total > 0, F.concat(
            F.lit(f"- {name}: "), verdict_band(pct_pos, pct_neg), F.lit(" ("), pct_pos.cast("string"),
            F.lit("% tích cực, "), pct_neg.cast("string"), F.lit("% tiêu cực / "), total.cast("string"),
            F.lit(" ý kiến)"))))
    body = F.concat_ws("\n", *lines)
    head = F.concat(F.lit("Tổng hợp đánh giá '"), _shown(F.col("name"), ""), F.lit("':"))
    return det.filter("n_reviews IS NOT NULL").select(
        _doc_id("_aspects"), F.lit("aspect_summary").alias("doc_type"),
        F.concat_ws("\n", head, body).alias("content"), _metadata())


def text_digest(column: str) -> Column:
    """What stands for a whole text where only equality counts."""
    return F.unhex(F.sha2(column, 256))


def top_reviews(reviews: DataFrame, chars: int | None = None) -> DataFrame:
    """The reviews that represent a product, with their 0-based ``position``
    and the first ``chars`` characters of their content (all if None).

    k comes from all reviews of the product. The longest reviews are taken per
    polarity (positive k - k/3, negative k/3, at least one each), positive
    before negative; repeated contents are dropped after that. The constant
    limit per polarity runs before the shuffle, so a hot product never gathers
    its reviews in one task; what is grouped per product is at most 28 rows.
    Size and digest stand for the whole content in the shuffles, so only the
    characters that are asked for take part in them.
    """
    content = F.col("content") if chars is None else F.substring("content", 1, chars)
    judged = reviews.select(
        "product_id", "review_id", "rating", content.alias("content"), F.length("content").alias("size"),
        text_digest("content").alias("digest"), overall_sentiment(F.col("label")).alias("overall"))
    ranked = top_per_key(
        judged.filter("overall <> 'neutral'"), ["product_id", "overall"],
        [F.desc("size"), F.asc("review_id")], MAX_PER_POLARITY)
    return shown_reviews(ranked, reviews.groupBy("product_id").agg(F.count("*").alias("n")))


def top_reviews_by_text(reviews: DataFrame, texts: DataFrame, chars: int) -> DataFrame:
    """``top_reviews`` of reviews that name their text by ``doc_id``; ``texts`` (doc_id, content).

    Size and digest of a text are taken where it lies, and the first ``chars`` characters are attached to the reviews
    that are shown, so that no text is copied for each of its reviews.
    """
    facts = texts.select("doc_id", F.length("content").alias("size"), text_digest("content").alias("digest"))
    judged = reviews.select("product_id", "review_id", "rating", "doc_id", overall_sentiment(F.col("label")).alias("overall")).filter(
        "overall <> 'neutral'").join(facts, "doc_id").withColumn("content", F.struct("doc_id", "digest")).drop("doc_id")
    ranked = top_per_key(judged, ["product_id", "overall"], [F.desc("size"), F.asc("review_id")], MAX_PER_POLARITY)
    spoken = reviews.select("product_id", "doc_id").join(texts.select("doc_id"), "doc_id")
    shown = shown_reviews(ranked, spoken.groupBy("product_id").agg(F.count("*").alias("n")))
    # Ids may repeat: a text is the one of its id and digest; a NULL text has no digest.
    said = texts.select(F.col("doc_id").alias("_id"), text_digest("content").alias("_digest"), F.substring("content", 1, chars).alias("said"))
    found = (F.col("content.doc_id") == F.col("_id")) & F.col("content.digest").eqNullSafe(F.col("_digest"))
    return shown.join(said.dropDuplicates(["_id", "_digest"]), found).select(
        "product_id", "position", "review_id", "rating", "overall", F.col("said").alias("content"))


def shown_reviews(ranked: DataFrame, counts: DataFrame) -> DataFrame:
    """Of the reviews ``ranked`` within product and polarity those that k lets through; ``counts`` (product_id, n).
    A ``digest`` tells which contents are equal; without one it is taken from the content."""
    if "digest" not in ranked.columns:
        ranked = ranked.withColumn("digest", text_digest("content"))
    k = adaptive_k(F.col("n"))
    counts = counts.select(
        "product_id", k.alias("k"), positive_limit(k).alias("pos_k"), negative_limit(k).alias("neg_k"))
    limit = F.when(F.col("overall") == "positive", F.col("pos_k")).otherwise(F.col("neg_k"))
    side = F.when(F.col("overall") == "positive", F.lit(0)).otherwise(F.lit(1))
    lists = (
        ranked.join(counts, "product_id").filter(F.col("rank") <= limit)
        .groupBy("product_id", "k").agg(F.sort_array(F.collect_list(
            F.struct(side.alias("side"), "rank", "review_id", "rating", "overall", "content", "digest"))).alias("picks"))
    )
    digests = F.transform("picks", lambda x: x.digest)
    unique = F.filter("picks", lambda x, i: F.array_position(digests, x.digest) == i + 1)
    return lists.select("product_id", F.posexplode(F.slice(unique, 1, F.col("k"))).alias("position", "r")).select(
        "product_id", "position", "r.review_id", "r.rating", "r.overall", "r.content")


def review_documents(det: DataFrame, picked: DataFrame) -> DataFrame:
    """Documents of the picked reviews; ``det`` may lack products (inner join)."""
    joined = picked.join(det, "product_id")
    content = F.concat(
        F.lit("Đánh giá ("), _shown(F.col("rating"), "n/a"), F.lit("/5) về '"), _shown(F.col("name"), ""),
        F.lit("':\n"), F.substring("content", 1, REVIEW_CHARS))
    return joined.select(
        _doc_id(F.concat(F.lit("_review_"), F.col("position").cast("string"))), F.lit("review").alias("doc_type"),
        content.alias("content"), _metadata(), safe_int(F.col("rating")).alias("review_rating"),
        F.col("overall").alias("review_overall"))


def new_review_documents(det: DataFrame, delta: DataFrame, overall: str | None = None) -> DataFrame:
    """A document for every delta review with content, beside the picked ones. ``overall`` names a column
    with the sentiment of the review where it is known; else the label tells it."""
    judged = F.col(overall) if overall else overall_sentiment(F.col("label"))
    spoken = delta.withColumn("content", strip(F.col("content"))).filter("content <> ''").select(
        "product_id", "review_id", "rating", "content", "source_file", judged.alias("overall"))
    joined = spoken.join(det, "product_id")
    content = F.concat(F.lit("Review mới về '"), _shown(F.col("name"), ""), F.lit("':\n"), F.substring("content", 1, NEW_REVIEW_CHARS))
    return joined.select(
        delta_doc_id(F.col("product_id"), F.col("content")).alias("id"), F.lit("new_review").alias("doc_type"),
        content.alias("content"), _metadata(), safe_int(F.col("rating")).alias("review_rating"),
        F.col("overall").alias("review_overall"), F.lit(True).alias("is_new_review"),
        F.lit("delta_review").alias("source"), "source_file")


def document_union(*parts: DataFrame) -> DataFrame:
    """All documents, the first of equal ids by document kind."""
    from .layout import keep_first

    both = concat_parts(list(parts))
    rank = F.array_position(F.array(*map(F.lit, DOC_TYPES)), F.col("doc_type"))
    return keep_first(both, ["id"], [rank, "content"])


def build_documents(products: DataFrame, reviews: DataFrame, scores: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Cards, summaries and picked reviews of all products; where ``texts`` are given, reviews name theirs by ``doc_id``."""
    det = details(products, scores)
    slim = det.drop("short_description", "ai_review_summary")
    return concat_parts([
        product_cards(det), aspect_summaries(slim), review_documents(
            slim, top_reviews(reviews, REVIEW_CHARS) if texts is None else top_reviews_by_text(reviews, texts, REVIEW_CHARS))])


def build_delta_documents(products: DataFrame, reviews: DataFrame, scores: DataFrame, affected: DataFrame,
                          delta: DataFrame) -> DataFrame:
    """Documents of the affected products, plus every delta review."""
    det = details(products.join(affected, "product_id", "left_semi"), scores)
    slim = det.drop("short_description", "ai_review_summary")
    return document_union(
        product_cards(det), aspect_summaries(slim),
        review_documents(slim, top_reviews(of_products(reviews, affected), REVIEW_CHARS)),
        new_review_documents(slim, delta))


def doc_type_counts(documents: DataFrame) -> DataFrame:
    """Documents per kind and in total."""
    return documents.rollup("doc_type").agg(F.count("*").alias("n")).withColumn(
        "doc_type", F.coalesce("doc_type", F.lit("total")))
