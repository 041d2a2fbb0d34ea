"""Documents, reports and everything built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECT_DOC_NAMES, ASPECT_REPORT_NAMES, ASPECTS
from ..operators import conversations, documents as d, merge, ranking
from ..session import materialize, shared_dir
from . import bindings as b
from .registry import query
from .scalar_queries import OVERALL_SQL, REPORT_MARK_SQL, REPORT_NOTE_SQL, VERDICT_SQL, sql_clean_html, sql_strip
from .score_queries import satisfaction, wide_scores
from .stored import stored

SHOP = "Shop"

# --- views ------------------------------------------------------------------------
_META = ["product_id", "name", "brand_name", "category_name", "price", "rating_average", "review_count", "product_url"]
_META_SQL = ", ".join(_META) + ", n_reviews AS absa_n_reviews, " + ", ".join(
    f"{a}_{p} AS absa_{a}_{p}" for a in ASPECTS for p in ("score", "pos", "neg", "conf"))
b.add_view("details", ["products", "scores_wide"], "SELECT * FROM products LEFT JOIN scores_wide USING (product_id)")
b.add_view("adaptive", ["review_heads"], """
    SELECT *, greatest(1, k - k // 3) AS pos_k, greatest(1, k // 3) AS neg_k FROM (
        SELECT product_id, count(*) AS n, CAST(CASE WHEN n <= 3 THEN n WHEN n <= 10 THEN 4 WHEN n <= 20 THEN 5
            WHEN n <= 50 THEN 6 WHEN n <= 100 THEN 8
            ELSE least(greatest(round_even(n * 0.08::DOUBLE, 0), 8), 20) END AS INTEGER) AS k
        FROM review_heads GROUP BY product_id)""")
b.add_view("top_reviews", ["labeled_reviews", "adaptive"], f"""
    SELECT product_id, CAST(row_number() OVER (PARTITION BY product_id ORDER BY side, rank) - 1 AS INTEGER) AS position, review_id,
           rating, overall, content, k
    FROM (SELECT *, row_number() OVER (PARTITION BY product_id, content ORDER BY side, rank) AS copy FROM (
        SELECT r.*, a.k, a.pos_k, a.neg_k, CASE overall WHEN 'positive' THEN 0 ELSE 1 END AS side, row_number() OVER (
            PARTITION BY r.product_id, overall ORDER BY length(content) DESC, review_id) AS rank
        FROM (SELECT *, {OVERALL_SQL} AS overall FROM labeled_reviews) r JOIN adaptive a USING (product_id)
        WHERE overall <> 'neutral') WHERE rank <= CASE side WHEN 0 THEN pos_k ELSE neg_k END) WHERE copy = 1
    QUALIFY position < k""")
SUMMARY_LINES = []
for _a in ASPECTS:
    _t = f"({_a}_pos + {_a}_neu + {_a}_neg)"
    _p, _n = (f"CAST(round_even(100 * {_a}_{s} / {_t}, 0) AS INTEGER)" for s in ("pos", "neg"))
    _verdict = VERDICT_SQL.replace("pct_pos", _p).replace("pct_neg", _n)
    SUMMARY_LINES.append(f"CASE WHEN {_t} > 0 THEN '- {ASPECT_DOC_NAMES[_a].capitalize()}: ' || {_verdict} || ' (' || {_p} || "
                  f"'% tích cực, ' || {_n} || '% tiêu cực / ' || {_t} || ' ý kiến)' END")
b.add_view("aspect_docs", ["details"], f"""
    SELECT 'prod_' || product_id || '_aspects' AS id, 'aspect_summary' AS doc_type, product_id,
           'Tổng hợp đánh giá ''' || name || ''':' || chr(10) || concat_ws(chr(10), {', '.join(SUMMARY_LINES)}) AS content
    FROM details WHERE n_reviews IS NOT NULL""")
_CARD_HEAD = """'Sản phẩm: ' || name, 'Thương hiệu: ' || coalesce(brand_name, 'n/a'), 'Danh mục: ' || coalesce(category_name, 'n/a'),
    'Giá: ' || replace(format('{:,}', price), ',', '.') || 'đ',
    'Đánh giá: ' || coalesce(rating_average::VARCHAR, 'n/a') || '/5 (' || coalesce(review_count, 0) || ' đánh giá)'"""
b.add_view("card_docs", ["described_products"], f"""
    SELECT 'prod_' || product_id || '_card' AS id, 'product_card' AS doc_type, product_id,
           concat_ws(chr(10), {_CARD_HEAD}, CASE WHEN t <> '' THEN 'Mô tả: ' || substring(t, 1, 500) END) AS content
    FROM (SELECT *, {sql_clean_html('short_description')} AS t FROM described_products)""")
b.add_view("review_docs", ["top_reviews", "product_heads"], """
    SELECT 'prod_' || product_id || '_review_' || position AS id, 'review' AS doc_type, product_id,
           'Đánh giá (' || rating || '/5) về ''' || name || ''':' || chr(10) || substring(content, 1, 600) AS content,
           rating AS review_rating, overall AS review_overall, position
    FROM top_reviews JOIN product_heads USING (product_id)""")
# The daily increment: the reviews of the last 90 days.
b.add_view("pending", ["labeled_reviews"], f"""
    SELECT *, {OVERALL_SQL} AS overall FROM labeled_reviews WHERE created_at >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""")
b.add_view("delta", ["pending"], """
    SELECT * FROM pending QUALIFY row_number() OVER (PARTITION BY product_id, content ORDER BY source_file, review_id) = 1""")
b.add_view("new_docs", ["delta", "product_heads"], f"""
    SELECT 'prod_' || product_id || '_delta_review_' || substring(md5(product_id || '|' || {sql_strip('content')}), 1, 16) AS id,
           'new_review' AS doc_type, product_id,
           'Review mới về ''' || name || ''':' || chr(10) || substring({sql_strip('content')}, 1, 800) AS content,
           rating AS review_rating, overall AS review_overall, source_file
    FROM delta JOIN product_heads USING (product_id) WHERE {sql_strip('content')} <> ''""")
b.add_view("base_docs", ["card_docs", "aspect_docs", "review_docs"], """
    SELECT id, doc_type, product_id, content FROM card_docs UNION ALL SELECT id, doc_type, product_id, content FROM aspect_docs
    UNION ALL SELECT id, doc_type, product_id, content FROM review_docs""")
b.add_view("delta_docs", ["base_docs", "new_docs"], """
    SELECT id, doc_type, product_id, content FROM base_docs WHERE product_id IN (SELECT product_id FROM pending)
    UNION ALL SELECT DISTINCT ON (id) id, doc_type, product_id, content FROM new_docs ORDER BY id, content""")


def details(spark, sf_dir):
    return d.details(b.products(spark, sf_dir), wide_scores(spark, sf_dir))


def described_details(spark, sf_dir):
    return d.details(b.described_products(spark, sf_dir), wide_scores(spark, sf_dir))


def pending(spark, sf_dir):
    reviews = b.labeled_reviews(spark, sf_dir)
    newest = b.table(spark, sf_dir, "orders").agg(F.max("o_orderdate") - F.expr("INTERVAL 90 DAYS")).scalar()
    return reviews.filter(F.col("created_at") >= newest)


def delta(spark, sf_dir):
    return merge.delta_reviews(pending(spark, sf_dir), ["source_file", "review_id"])


def stored_scores(spark, sf_dir):
    """Scores as a stored table: three kinds of documents read them."""
    return materialize(wide_scores(spark, sf_dir), "scores")


def all_documents(spark, sf_dir):
    return d.build_documents(
        b.described_products(spark, sf_dir), b.labeled_by_text(spark, sf_dir), stored_scores(spark, sf_dir), b.texts(spark, sf_dir))


def delta_documents(spark, sf_dir):
    """Scores and the day's reviews are stored once and read several times."""
    day = materialize(pending(spark, sf_dir), "pending")
    return d.build_delta_documents(
        b.described_products(spark, sf_dir), b.labeled_reviews(spark, sf_dir), stored_scores(spark, sf_dir),
        merge.affected_ids(day), merge.delta_reviews(day, ["source_file", "review_id"]))


def flat(docs, *extra):
    return docs.select("id", "doc_type", "metadata.product_id", "content", *extra)


@query("adaptive_k", b.sql(["adaptive"], "SELECT * FROM adaptive"))
def adaptive_k(spark, sf_dir):
    from ..functions import numbers

    k = numbers.adaptive_k(F.col("n"))
    return b.review_heads(spark, sf_dir).groupBy("product_id").agg(F.count("*").alias("n")).select(
        "product_id", "n", k.alias("k"), numbers.positive_limit(k).alias("pos_k"), numbers.negative_limit(k).alias("neg_k"))


@query("top_reviews", b.sql(["top_reviews"], "SELECT product_id, position, review_id, rating, overall FROM top_reviews"))
def top_reviews(spark, sf_dir):
    return d.top_reviews(b.labeled_reviews(spark, sf_dir), 0).drop("content")


@query("review_doc_index", b.sql(["top_reviews"], """
    SELECT review_id, 'prod_' || product_id || '_review_' || position AS id FROM top_reviews"""))
def review_doc_index(spark, sf_dir):
    return d.top_reviews(b.labeled_reviews(spark, sf_dir), 0).select(
        "review_id", F.concat(F.lit("prod_"), "product_id", F.lit("_review_"), "position").alias("id"))


@query("doc_metadata", b.sql(["details"], f"SELECT {_META_SQL} FROM details"))
def doc_metadata(spark, sf_dir):
    return details(spark, sf_dir).select(*d.metadata_columns())


@query("doc_product_card", b.sql(["card_docs"], "SELECT * FROM card_docs"))
def doc_product_card(spark, sf_dir):
    return flat(d.product_cards(described_details(spark, sf_dir)))


@query("doc_aspect_summary", b.sql(["aspect_docs"], "SELECT * FROM aspect_docs"))
def doc_aspect_summary(spark, sf_dir):
    return flat(d.aspect_summaries(details(spark, sf_dir)))


@query("doc_reviews", b.sql(["review_docs"], """
    SELECT id, doc_type, product_id, content, review_rating::BIGINT AS review_rating, review_overall FROM review_docs"""))
def doc_reviews(spark, sf_dir):
    picked = d.top_reviews_by_text(b.labeled_by_text(spark, sf_dir), b.texts(spark, sf_dir), d.REVIEW_CHARS)
    return flat(d.review_documents(details(spark, sf_dir), picked), "review_rating", "review_overall")


@query("doc_new_reviews", b.sql(["new_docs"], """
    SELECT id, doc_type, product_id, content, review_rating::BIGINT AS review_rating, review_overall, source_file,
           true AS is_new_review, 'delta_review' AS source FROM new_docs"""))
def doc_new_reviews(spark, sf_dir):
    docs = d.new_review_documents(details(spark, sf_dir), delta(spark, sf_dir))
    return flat(docs, "review_rating", "review_overall", "source_file", "is_new_review", "source")


@query("document_union", b.sql(["delta_docs"], "SELECT * FROM delta_docs"))
def document_union(spark, sf_dir):
    return flat(delta_documents(spark, sf_dir))


@query("doc_type_counts", b.sql(["base_docs"], """
    SELECT coalesce(doc_type, 'total') AS doc_type, count(*) AS n FROM base_docs GROUP BY ROLLUP (doc_type)"""))
def doc_type_counts(spark, sf_dir):
    return d.doc_type_counts(all_documents(spark, sf_dir))


@query("unique_id_check", b.sql(["base_docs"], """
    SELECT 'documents' AS input, count(*) AS n FROM (SELECT id FROM base_docs GROUP BY id HAVING count(*) > 1)
    UNION ALL SELECT 'cards', count(*) - count(*) FROM card_docs
    UNION ALL SELECT 'texts', count(*) FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)"""))
def unique_id_check(spark, sf_dir):
    inputs = {"documents": (all_documents(spark, sf_dir), "id"),
              "cards": (d.product_cards(described_details(spark, sf_dir)), "id"),
              "texts": (b.table(spark, sf_dir, "documents"), "text")}
    return merge.concat_parts([
        merge.repeated_ids(df, key).agg(F.count("*").alias("n")).select(F.lit(name).alias("input"), "n")
        for name, (df, key) in inputs.items()])


@query("kb_replace_products", b.sql(["base_docs", "delta_docs"], """
    SELECT id, doc_type, product_id, content FROM base_docs WHERE product_id NOT IN (SELECT product_id FROM delta_docs)
    UNION ALL SELECT * FROM delta_docs"""))
def kb_replace_products(spark, sf_dir):
    """The touched buckets of the stored base are written anew beside it, as other queries read it."""
    delta = materialize(flat(delta_documents(spark, sf_dir)), "delta-documents")
    return merge.kb_replaced(spark, stored_kb(spark, sf_dir), shared_dir(spark, "kb-updated"), delta).drop("bucket")


def stored_kb(spark, sf_dir) -> str:
    """Folder of the base knowledge base, built by the first query that needs it after its tables changed."""
    return stored(spark, sf_dir, "kb", ["orders", "lineitem", "part", "documents", "pages"],
                  lambda path: merge.kb_rebuild(flat(all_documents(spark, sf_dir)), path))


@query("kb_full_rebuild", b.sql(["base_docs"], "SELECT id, doc_type, product_id, content FROM base_docs"))
def kb_full_rebuild(spark, sf_dir):
    path = shared_dir(spark, "kb-rebuilt")
    merge.kb_rebuild(flat(all_documents(spark, sf_dir)), path)
    return spark.read.parquet(path).drop("bucket")


# --- reports -----------------------------------------------------------------------
_REPORT_LINES = f"""
    , lines AS (SELECT product_id, max(total) AS total_analyzed, string_agg({REPORT_MARK_SQL} || ' **' || CASE aspect """ + " ".join(
    f"WHEN '{a}' THEN '{n}'" for a, n in ASPECT_REPORT_NAMES.items()) + f""" END || '**: ' || {REPORT_NOTE_SQL}, chr(10)
            ORDER BY list_position({b._ASPECT_LIST}, aspect)) AS aspect_lines FROM satisfaction GROUP BY product_id),
    quotes AS (SELECT product_id, string_agg('> ' || repeat('⭐', rating) || ' *"' || content || '"*' || chr(10), chr(10)
            ORDER BY rank) AS quotes FROM samples WHERE rank <= 3 GROUP BY product_id)
    SELECT product_id, concat_ws(chr(10), '## 📊 Phân tích sản phẩm', '', '**' || name || '**',
        '💰 ' || format('{{:,}}', price) || 'đ · ⭐ ' || rating_average || '/5 (' || format('{{:,}}', review_count) || ' đánh giá)',
        '🏷️ ' || brand_name || ' · 📦 ' || category_name, '🔗 [Xem trên {SHOP}](' || product_url || ')', '',
        '*Nguồn: 🔄 Crawl + phân tích mới*', '',
        '### 🔍 Phân tích theo khía cạnh (' || total_analyzed || ' đánh giá đã phân tích)', '', aspect_lines,
        chr(10) || '### 💬 Một số đánh giá tiêu biểu' || chr(10) || chr(10) || quotes, '---',
        '*Xem đầy đủ đánh giá trên [{SHOP}](' || product_url || ')*') AS report
    FROM products JOIN lines USING (product_id) LEFT JOIN quotes USING (product_id)"""
b.add_view("samples", ["reviews"], """
    SELECT product_id, CAST(rank AS INTEGER) AS rank, review_id, rating, substring(content, 1, 200) AS content FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY length(content) DESC, review_id) AS rank FROM reviews)
    WHERE rank <= 5""")


@query("sample_reviews", b.sql(["samples"], "SELECT * FROM samples"))
def sample_reviews(spark, sf_dir):
    return ranking.sample_reviews(b.reviews(spark, sf_dir))


def reports(spark, sf_dir, wanted=None):
    """Reports of all products, or of the ``wanted`` ones, whose texts alone are then read."""
    of = lambda df: df if wanted is None else df.join(wanted, "product_id", "left_semi")
    said = b.reviews(spark, sf_dir) if wanted is None else b.with_content(of(b.review_heads(spark, sf_dir)), spark, sf_dir)
    return conversations.product_reports(
        of(b.products(spark, sf_dir)), of(satisfaction(spark, sf_dir)), ranking.sample_reviews(said),
        F.lit("🔄 Crawl + phân tích mới"), SHOP)


b.add_view("reports", ["products", "satisfaction", "samples"], "WITH " + _REPORT_LINES.strip().removeprefix(", "))


@query("product_report", b.sql(["reports"], "SELECT * FROM reports"))
def product_report(spark, sf_dir):
    return reports(spark, sf_dir)


# --- look-ups by product ---------------------------------------------------------------
b.add_view("linked_ids", ["chat"], r"""
    SELECT DISTINCT CAST(regexp_extract(text, '(?:-p|pid=)([0-9]+)', 1) AS BIGINT) AS product_id FROM chat
    WHERE role = 'user' AND regexp_extract(text, '(?:-p|pid=)([0-9]+)', 1) <> ''""")


def linked_ids(spark, sf_dir):
    from ..functions.identifiers import extract_chat_product_id

    return b.chat(spark, sf_dir).filter("role = 'user'").select(
        extract_chat_product_id(F.col("text")).cast("bigint").alias("product_id")
    ).filter("product_id IS NOT NULL").distinct()


@query("kb_point_lookup", b.sql(["linked_ids", "card_docs", "review_docs"], """
    SELECT product_id, c.id AS card_id, c.content AS card, r.id AS review_doc, substring(r.content, 1, 200) AS sample
    FROM linked_ids JOIN card_docs c USING (product_id)
    LEFT JOIN (SELECT * FROM review_docs WHERE position < 5) r USING (product_id)"""))
def kb_point_lookup(spark, sf_dir):
    docs = merge.kb_lookup(spark, stored_kb(spark, sf_dir), linked_ids(spark, sf_dir))
    cards = docs.filter("doc_type = 'product_card'").select(
        "product_id", F.col("id").alias("card_id"), F.col("content").alias("card"))
    place = F.regexp_extract("id", "_review_([0-9]+)$", 1).cast("int")
    samples = docs.filter("doc_type = 'review'").filter(place < 5).select(
        "product_id", F.col("id").alias("review_doc"), F.substring("content", 1, 200).alias("sample"))
    return cards.join(samples, "product_id", "left")


@query("tiered_lookup", b.sql(["linked_ids", "card_docs", "reports", "review_heads"], """
    , cached AS (SELECT DISTINCT product_id FROM review_heads WHERE created_at >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY),
    known AS (SELECT * FROM card_docs JOIN (SELECT product_id FROM review_heads GROUP BY 1 HAVING count(*) > 8) USING (product_id))
    SELECT i.product_id, CASE WHEN c.product_id IS NOT NULL THEN 'cache' WHEN k.product_id IS NOT NULL THEN 'kb'
           WHEN r.product_id IS NOT NULL THEN 'crawl' END AS source,
           CASE WHEN c.product_id IS NOT NULL THEN 'cached ' || c.product_id ELSE coalesce(k.content, r.report) END AS report
    FROM linked_ids i LEFT JOIN cached c USING (product_id) LEFT JOIN known k USING (product_id) LEFT JOIN reports r USING (product_id)"""))
def tiered_lookup(spark, sf_dir):
    # Recently reviewed products have a cached report, well reviewed ones a card.
    # The last tier makes reports only for products that the others lack.
    heads, ids = b.review_heads(spark, sf_dir), linked_ids(spark, sf_dir)
    newest = heads.agg(F.max("created_at") - F.expr("INTERVAL 90 DAYS")).scalar()
    cached = heads.filter(F.col("created_at") >= newest).select("product_id").distinct().withColumn(
        "report", F.concat(F.lit("cached "), F.col("product_id").cast("string")))
    cards = merge.kb_lookup(spark, stored_kb(spark, sf_dir), ids).filter("doc_type = 'product_card'")
    known = cards.select("product_id", F.col("content").alias("report")).join(
        heads.groupBy("product_id").count().filter("count > 8"), "product_id", "left_semi")
    lacking = ids.join(cached, "product_id", "left_anti").join(known, "product_id", "left_anti")
    return merge.tiered_lookup(ids, cached, known, reports(spark, sf_dir, lacking))


# --- facets and warm-up queries ------------------------------------------------------------
_FACETS = """SELECT DISTINCT 'brand' AS facet, brand_name AS value FROM product_heads WHERE brand_name <> ''
    UNION ALL SELECT DISTINCT 'category', category_name FROM product_heads WHERE category_name <> ''
    UNION ALL SELECT DISTINCT 'name', substring(name, 1, 60) FROM product_heads WHERE name <> ''"""
b.add_view("facets", ["product_heads"], _FACETS)


def facets(spark, sf_dir):
    from ..operators.profiling import kb_facets as build

    return build(b.product_heads(spark, sf_dir))


@query("kb_facets", b.sql(["facets"], "SELECT * FROM facets"))
def kb_facets(spark, sf_dir):
    return facets(spark, sf_dir)


def _warm_sql():
    from ..constants import BRAND_TEMPLATES, CATEGORY_TEMPLATES, WARM_QUERIES

    fill = lambda t: "'" + t.replace("%s", "' || value || '") + "'"
    parts = [f"SELECT {fill(t)} AS query FROM facets WHERE facet = 'brand'" for t in BRAND_TEMPLATES]
    parts += [f"SELECT {fill(t)} FROM facets WHERE facet = 'category' AND value <> 'Root'" for t in CATEGORY_TEMPLATES]
    parts += ["SELECT * FROM (SELECT value FROM facets WHERE facet = 'name' ORDER BY value LIMIT 20)"]
    parts += [f"SELECT unnest([{', '.join(repr(q) for q in WARM_QUERIES)}])"]
    return " UNION ".join(parts)


@query("warm_query_set", b.sql(["facets"], _warm_sql()))
def warm_query_set(spark, sf_dir):
    from ..operators.profiling import warm_queries

    return warm_queries(facets(spark, sf_dir))
