"""Flattening, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECTS, FAST_REVIEW_PAGES, FINAL_COLUMNS, REVIEWS_PER_PAGE
from ..functions import numbers, text
from ..operators import flatten, merge, scores, search
from ..operators.layout import with_position
from . import bindings as b
from .registry import query
from .scalar_queries import sql_boilerplate, sql_clean_review, sql_collapse, sql_html_text, sql_strip
from .score_queries import label_columns, wide_scores

BASE_URL = "https://shop.example.com"
#: Reviews that one task makes pages of.
PAGED_ROWS = 50_000


# --- raw payloads made from the catalogue and the reviews ------------------------
def raw_products(spark, sf_dir):
    """(product_id, payload JSON); some products lack a brand or a path."""
    part = b.table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    attribute = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    payload = F.struct(
        F.col("p_name").alias("name"), F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_size").alias("discount_rate"), (F.col("p_size") > 25).alias("has_ebook"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("item-p"), F.col("p_partkey").cast("string"))).alias("url_path"),
        F.when(F.col("p_brand") != "Brand#1", F.struct(
            F.regexp_extract("p_brand", "[0-9]+", 0).alias("id"), F.col("p_brand").alias("name"))).alias("brand"),
        F.struct(size.alias("id"), F.concat(F.lit("Seller "), size).alias("name"), F.lit(None).cast("string").alias("sku")
                 ).alias("current_seller"),
        F.struct(F.col("p_type").alias("name")).alias("categories"),
        F.struct(F.col("p_size").alias("qty")).alias("stock_item"),
        F.array(
            F.struct(F.lit("General").alias("name"), F.array(
                attribute("size", size), attribute("empty", F.lit("")), attribute("type", F.col("p_type"))).alias("attributes")),
            F.struct(F.lit("Brand").alias("name"), F.array(attribute("brand", F.col("p_brand"))).alias("attributes")),
        ).alias("specifications"),
    )
    return part.select(F.col("p_partkey").alias("product_id"), F.to_json(payload).alias("payload"))


def raw_review_pages(spark, sf_dir, per_page=REVIEWS_PER_PAGE):
    """(product_id, page, payload JSON) in the order of review ids; reviews
    rated 1 are blank, orders of status P have no author."""
    heads = b.review_heads(spark, sf_dir)
    page = (F.floor(F.col("position") / per_page) + 1).alias("page")
    # The short rows of a page meet before they get their texts, which need not be shuffled where they are sent whole.
    pieces = max(spark.sparkContext.defaultParallelism, heads.count() // PAGED_ROWS)
    placed = with_position(heads, "review_id", ["product_id"]).withColumn("page", page).repartition(pieces, "product_id", "page")
    placed = b.with_content(placed, spark, sf_dir, whole=True)
    item = F.struct(
        F.col("position").alias("at"),
        F.when(F.col("rating") == 1, F.lit("  ")).otherwise(F.concat(F.lit("\n"), F.col("content"))).alias("content"),
        F.col("rating"), F.unix_timestamp(F.col("created_at").cast("timestamp")).alias("created_at"),
        F.when(F.col("status") != "P", F.struct(F.col("customer_name").alias("name"))).alias("created_by"),
    )
    pages = placed.groupBy("product_id", "page").agg(F.sort_array(F.collect_list(item)).alias("data"))
    return pages.select("product_id", "page", F.to_json(F.struct("data")).alias("payload"))


b.add_view("placed_heads", ["review_heads"],
           "SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY review_id) - 1 AS position FROM review_heads")
b.add_view("placed_reviews", ["reviews"],
           "SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY review_id) - 1 AS position FROM reviews")


@query("flatten_product", """
    SELECT p_partkey::VARCHAR AS product_id, p_name AS name, p_retailprice::VARCHAR AS price, p_size::VARCHAR AS discount_rate,
           CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS has_ebook,
           CASE WHEN p_size > 10 THEN 'item-p' || p_partkey ELSE '' END AS url_path,
           CASE WHEN p_size > 10 THEN 'https://shop.example.com/item-p' || p_partkey ELSE '' END AS product_url,
           CASE WHEN p_brand <> 'Brand#1' THEN p_brand ELSE '' END AS brand_name,
           CASE WHEN p_brand <> 'Brand#1' THEN replace(p_brand, 'Brand#', '') ELSE '' END AS brand_id,
           'Seller ' || p_size AS seller_name, p_size::VARCHAR AS seller_id, '' AS seller_sku,
           p_type AS category_name, '' AS category_id, p_size::VARCHAR AS stock_item_qty,
           'size: ' || p_size || '; type: ' || p_type || '; brand: ' || p_brand AS specifications,
           """ + ", ".join(f"'' AS {c}" for c in (
    "short_name", "sku", "list_price", "discount", "rating_average", "review_count", "order_count", "favourite_count",
    "thumbnail_url", "short_description", "inventory_status", "stock_item_max_sale_qty", "is_fresh", "is_genuine",
    "ai_review_summary")) + " FROM part")
def flatten_product(spark, sf_dir):
    return flatten.flatten_product(raw_products(spark, sf_dir), BASE_URL)


@query("specs_text", """SELECT p_partkey AS product_id,
    'size: ' || p_size || '; type: ' || p_type || '; brand: ' || p_brand AS specifications FROM part""")
def specs_text(spark, sf_dir):
    groups = F.from_json("payload", flatten.PRODUCT_SCHEMA)["specifications"]
    return raw_products(spark, sf_dir).select("product_id", flatten.specs_text(groups).alias("specifications"))


_FLAT_REVIEW = f"""product_id, rating, {sql_strip('content')} AS content,
    CASE WHEN status <> 'P' THEN customer_name ELSE '' END AS customer_name,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM placed_reviews
    WHERE rating <> 1 AND {sql_strip('content')} <> ''"""
_REVIEW_COLUMNS = ["product_id", "rating", "content", "customer_name", "created_at"]


@query("flatten_reviews", b.sql(["placed_reviews"], f"SELECT {_FLAT_REVIEW}"))
def flatten_reviews(spark, sf_dir):
    return flatten.flatten_reviews(raw_review_pages(spark, sf_dir)).select(_REVIEW_COLUMNS)


@query("review_page_cap", b.sql(["placed_reviews"], f"SELECT {_FLAT_REVIEW} AND position < {FAST_REVIEW_PAGES} * 2"))
def review_page_cap(spark, sf_dir):
    # Pages of two reviews, so that the cap of five pages is felt.
    pages = raw_review_pages(spark, sf_dir, per_page=2)
    return flatten.flatten_reviews(pages, max_pages=FAST_REVIEW_PAGES).select(_REVIEW_COLUMNS)


@query("safe_stringify", """
    SELECT p_partkey AS product_id, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS name_text,
           CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS flag_text, p_retailprice::VARCHAR AS price_text,
           '{"brand": "' || p_brand || '", "size": ' || p_size || '}' AS nested_text, '[' || p_size || ', 1]' AS list_text
    FROM part""")
def safe_stringify(spark, sf_dir):
    values = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.when(F.col("p_size") > 25, F.col("p_name")).alias("name_text"),
        (F.col("p_size") > 25).alias("flag_text"), F.col("p_retailprice").alias("price_text"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("nested_text"),
        F.array("p_size", F.lit(1)).alias("list_text"))
    kinds = {f.name: f.dataType for f in values.schema}
    return values.select("product_id", *[
        flatten.safe_stringify(F.col(c), kinds[c]).alias(c) for c in values.columns[1:]])


@query("ai_summary_coalesce", "SELECT doc_id, CASE WHEN lang IN ('en', 'fr', 'de') THEN text ELSE '' END AS summary FROM documents")
def ai_summary_coalesce(spark, sf_dir):
    at = lambda lang: F.when(F.col("lang") == lang, F.col("text"))
    payload = F.to_json(F.struct(
        F.coalesce(at("en"), F.lit("")).alias("ai_generated_summary"),
        F.struct(at("fr").alias("review_summary"), at("de").alias("ai_summary")).alias("meta")))
    return b.text_table(spark, sf_dir, "documents").select("doc_id", flatten.ai_summary(payload).alias("summary"))


_DESCRIPTION = sql_collapse(sql_boilerplate(sql_html_text("short_description")))


@query("detail_projection", b.sql(["described_products"], f"""
    SELECT product_id, name, brand_name, category_name, price, product_url, rating_average AS rating_from_detail,
           review_count AS review_count_from_detail, length(t) AS description_length, md5(t) AS description_md5
    FROM (SELECT *, {_DESCRIPTION} AS t FROM described_products)"""))
def detail_projection(spark, sf_dir):
    detail = b.described_products(spark, sf_dir)
    blank = [c for c in flatten.DETAIL_KEEP if c not in detail.columns]
    kept = flatten.detail_projection(detail.withColumns({c: F.lit("") for c in blank}))
    return kept.select(
        "product_id", "name", "brand_name", "category_name", "price", "product_url", "rating_from_detail",
        "review_count_from_detail", F.length("short_description").cast("bigint").alias("description_length"),
        F.md5("short_description").alias("description_md5"))


@query("final_projection", b.sql(["reviews"], """
    SELECT product_id, customer_name, rating, content, created_at FROM reviews"""))
def final_projection(spark, sf_dir):
    return flatten.final_projection(b.reviews(spark, sf_dir), FINAL_COLUMNS)


@query("label_wide_table", b.sql(["labeled_heads"], """
    SELECT product_id::VARCHAR AS product_id, customer_name, CASE WHEN status = 'P' THEN 0 ELSE rating END AS rating, """
    + ", ".join(f"coalesce({a}, 'none') AS \"aspect/{a}\"" for a in ASPECTS) + " FROM labeled_heads"))
def label_wide_table(spark, sf_dir):
    rated = b.labeled_heads(spark, sf_dir).withColumn("rating", F.when(F.col("status") != "P", F.col("rating")))
    return label_columns(rated, "none").select(
        F.col("product_id").cast("string").alias("product_id"), "customer_name",
        F.coalesce("rating", F.lit(0)).alias("rating"), *[F.col(a).alias(f"aspect/{a}") for a in ASPECTS])


@query("nonempty_clean_filter", f"""
    SELECT * FROM (SELECT doc_id, {sql_clean_review('text')} AS clean_content FROM documents) WHERE clean_content <> ''""")
def nonempty_clean_filter(spark, sf_dir):
    cleaned = b.text_table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_review_text(F.col("text")).alias("clean_content"))
    return cleaned.filter(~text.is_blank(F.col("clean_content")))


b.add_view("spoken_counts", ["labeled_heads"], " UNION ALL ".join(
    f"SELECT product_id, '{a}' AS aspect, count(*) FILTER (WHERE {a} = 'positive') AS pos, "
    f"count(*) FILTER (WHERE {a} = 'negative') AS neg FROM labeled_heads WHERE rating <> 1 GROUP BY product_id"
    for a in ASPECTS))


@query("scoring_input_filter", b.sql(["spoken_counts"], f"""
    , counts AS (SELECT p_partkey AS product_id, a.aspect, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg
        FROM part CROSS JOIN (SELECT unnest({b._ASPECT_LIST}) AS aspect) a
        LEFT JOIN spoken_counts s ON s.product_id = p_partkey AND s.aspect = a.aspect)
    SELECT product_id, aspect, pos, neg, pos + neg AS total,
           CAST(CASE WHEN pos + neg > 0 THEN round_even(100 * pos / (pos + neg), 0) ELSE 0 END AS INTEGER) AS pct,
           CASE WHEN pos + neg > 0 THEN round_even((pos - neg) / (pos + neg), 3) ELSE 0.0 END AS score
    FROM counts"""))
def scoring_input_filter(spark, sf_dir):
    # Reviews rated 1 have blank content; products without content score zero.
    content = F.when(F.col("rating") == 1, F.lit("  ")).otherwise(F.col("customer_name"))
    spoken = b.labeled_heads(spark, sf_dir).withColumn("content", content).filter(~text.is_blank(F.col("content")))
    found = scores.aspect_satisfaction(label_columns(spoken), ["product_id"])
    wanted = b.product_heads(spark, sf_dir).select(
        "product_id", F.explode(F.array(*map(F.lit, ASPECTS))).alias("aspect"))
    joined = wanted.join(found, ["product_id", "aspect"], "left")
    return joined.na.fill(0, ["pos", "neg", "total", "pct"]).na.fill(0.0, ["score"])


@query("lookback_filter", b.sql(["review_heads"], """
    SELECT review_id, product_id, CASE WHEN status = 'P' THEN NULL ELSE created_at END AS created_at FROM review_heads
    WHERE status = 'P' OR created_at >= (SELECT max(created_at) FROM review_heads) - INTERVAL 365 DAY"""))
def lookback_filter(spark, sf_dir):
    heads = b.review_heads(spark, sf_dir)
    cutoff = heads.agg(F.max("created_at") - F.expr("INTERVAL 365 DAYS")).scalar()
    raw = F.when(F.col("status") == "P", F.lit("yesterday")).otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    parsed = heads.withColumn("created_at", numbers.parse_timestamp(raw).cast("timestamp_ntz"))
    return flatten.lookback(parsed, F.col("created_at"), cutoff).select("review_id", "product_id", "created_at")


@query("rag_filter", b.sql(["kb", "scores_wide"], """
    SELECT k.id, k.doc_type, k.price, k.rating_average, s.quality_score FROM kb k LEFT JOIN scores_wide s USING (product_id)
    WHERE k.doc_type IN ('type_1', 'type_2', 'type_3') AND k.rating_average >= 2.5 AND k.price BETWEEN 900 AND 940
      AND s.quality_score >= -0.2"""))
def rag_filter(spark, sf_dir):
    asked = [("doc_type", "in", ["type_1", "type_2", "type_3"]), ("rating_average", "at least", 2.5),
             ("price", "at least", 900), ("price", "at most", 940)]
    chosen = [*(search.Condition(*c) for c in asked), *search.liked({"quality": -0.2, "unknown": 0.5})]
    points = search.with_aspect_scores(b.kb(spark, sf_dir), wide_scores(spark, sf_dir))
    return points.filter(search.passing(chosen)).select(
        "id", "doc_type", "price", "rating_average", F.col("absa_quality_score").alias("quality_score"))


@query("nonblank_id_filter", """
    SELECT p_partkey::VARCHAR AS product_id, p_name AS name FROM part WHERE p_size > 5""")
def nonblank_id_filter(spark, sf_dir):
    listed = b.table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") <= 3, F.lit(" ")).when(F.col("p_size") <= 5, F.lit(None))
        .otherwise(F.col("p_partkey").cast("string")).alias("product_id"), F.col("p_name").alias("name"))
    return flatten.nonblank_ids(listed)


@query("required_columns_guard", b.sql(["reviews"], "SELECT 'reviews' AS input, count(*) AS n FROM reviews"))
def required_columns_guard(spark, sf_dir):
    inputs = {"reviews": b.reviews(spark, sf_dir), "heads": b.review_heads(spark, sf_dir)}
    usable = flatten.with_required_columns(inputs, {"product_id", "content"})
    return merge.concat_parts([
        df.agg(F.count("content").alias("n")).select(F.lit(name).alias("input"), "n") for name, df in usable.items()])
