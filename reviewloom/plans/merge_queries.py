"""Joins, unions, windows and updates of review tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECTS, CHUNK_SIZE, FINAL_COLUMNS, WS
from ..functions import text
from ..operators import conversations, evaluation, flatten, layout, merge, ranking
from ..session import STORED, materialize, shared_dir
from . import bindings as b
from .document_queries import details
from .project_queries import BASE_URL, raw_review_pages
from .registry import query
from .scalar_queries import (
    FOLLOWUP_SQL, INTENT_SQL, _ITEMS, _items_text, sql_clean_review, sql_compact,
)
from .score_queries import wide_scores

# Main table: finished reviews (F). Pending files: the others (O, P).
MAIN, PENDING = "status = 'F'", "status <> 'F'"


# --- joins ----------------------------------------------------------------------------
@query("detail_scores_join", b.sql(["details"], """
    SELECT product_id, name, price, n_reviews, quality_score, price_score FROM details"""))
def detail_scores_join(spark, sf_dir):
    return details(spark, sf_dir).select("product_id", "name", "price", "n_reviews", "quality_score", "price_score")


@query("detail_reviews_join", b.sql(["product_heads", "review_heads"], """
    SELECT p.product_id, p.name, r.review_id, r.rating FROM product_heads p LEFT JOIN review_heads r USING (product_id)"""))
def detail_reviews_join(spark, sf_dir):
    one = b.product_heads(spark, sf_dir).select("product_id", "name")
    many = b.review_heads(spark, sf_dir).select("product_id", "review_id", "rating")
    return merge.one_to_many(one, many).select("product_id", "name", "review_id", "rating")


b.add_view("recent", ["review_heads"], """
    SELECT * FROM review_heads WHERE created_at >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""")


def recent(spark, sf_dir):
    heads = b.review_heads(spark, sf_dir)
    newest = heads.agg(F.max("created_at") - F.expr("INTERVAL 90 DAYS")).scalar()
    return heads.filter(F.col("created_at") >= newest)


@query("affected_products_semi", b.sql(["recent", "product_heads", "scores_wide"], """
    SELECT kind, product_id, id FROM (
        SELECT 'detail' AS kind, product_id, product_id AS id FROM product_heads UNION ALL
        SELECT 'scores', product_id, product_id FROM scores_wide UNION ALL
        SELECT 'review', product_id, review_id FROM review_heads) WHERE product_id IN (SELECT product_id FROM recent)"""))
def affected_products_semi(spark, sf_dir):
    ids = merge.affected_ids(recent(spark, sf_dir))
    one = lambda df, kind: df.join(ids, "product_id", "left_semi").select(
        F.lit(kind).alias("kind"), "product_id", F.col("product_id").alias("id"))
    kept = merge.of_products(b.review_heads(spark, sf_dir), ids).select(
        F.lit("review").alias("kind"), "product_id", F.col("review_id").alias("id"))
    return merge.concat_parts([
        one(b.product_heads(spark, sf_dir), "detail"), one(wide_scores(spark, sf_dir), "scores"), kept])


@query("delta_reviews_join", b.sql(["recent", "product_heads"], """
    SELECT product_id, name, review_id, rating FROM recent JOIN product_heads USING (product_id)"""))
def delta_reviews_join(spark, sf_dir):
    return recent(spark, sf_dir).select("product_id", "review_id", "rating").join(
        b.product_heads(spark, sf_dir).select("product_id", "name"), "product_id")


b.add_view("new_reviews", ["reviews"], """
    SELECT * FROM (SELECT *, min(source_file) OVER (PARTITION BY product_id, content) AS first_file FROM reviews p
        WHERE status <> 'F' AND NOT EXISTS (SELECT 1 FROM reviews m WHERE m.status = 'F'
              AND m.product_id = p.product_id AND m.content = p.content))
    WHERE source_file = first_file""")


def main_and_pending(spark, sf_dir):
    reviews = b.reviews(spark, sf_dir)
    return reviews.filter(MAIN), reviews.filter(PENDING)


@query("new_reviews_anti", b.sql(["new_reviews"], "SELECT review_id, product_id, source_file FROM new_reviews"))
def new_reviews_anti(spark, sf_dir):
    main, pending = main_and_pending(spark, sf_dir)
    return merge.new_reviews(pending, main).select("review_id", "product_id", "source_file")


@query("affected_ids", b.sql(["recent"], "SELECT DISTINCT product_id FROM recent"))
def affected_ids(spark, sf_dir):
    return merge.affected_ids(recent(spark, sf_dir))


@query("checkpoint_resume_join", b.sql(["labeled_heads"], f"""
    , done AS (SELECT product_id, customer_name, created_at, min_by({_ITEMS}, review_id) AS items FROM labeled_heads
        WHERE status = 'F' GROUP BY product_id, customer_name, created_at)
    SELECT h.review_id, d.items, d.product_id IS NULL AS todo FROM labeled_heads h
    LEFT JOIN done d USING (product_id, customer_name, created_at)"""))
def checkpoint_resume_join(spark, sf_dir):
    labeled = b.labeled_heads(spark, sf_dir)
    keys = ["product_id", "customer_name", "created_at"]
    resumed = merge.resume(labeled.drop("label"), labeled.filter(MAIN), keys, ["label"], "review_id")
    return resumed.select(
        "review_id", F.when(F.col("label").isNotNull(), _items_text(F.col("label"))).alias("items"),
        F.col("label").isNull().alias("todo"))


_CLEANED = f"""(SELECT text, {sql_clean_review('text')} AS clean FROM (SELECT DISTINCT text FROM documents))"""


@query("error_stage_anti", b.sql(["labeled_reviews"], f"""
    SELECT review_id, product_id, customer_name, created_at,
           CASE WHEN clean = '' THEN 'FAILED_PREPROCESS' ELSE 'FAILED_LABELING' END AS error_stage
    FROM labeled_reviews JOIN {_CLEANED} t ON t.text = content
    WHERE clean = '' OR coalesce({', '.join(ASPECTS)}) IS NULL"""))
def error_stage_anti(spark, sf_dir):
    raw = b.labeled_reviews(spark, sf_dir)
    processed = raw.filter(~text.is_blank(text.clean_review_text(F.col("content"))))
    return merge.error_stages(raw, processed, processed.filter(F.size("label") > 0)).select(
        "review_id", "product_id", "customer_name", "created_at", "error_stage")


@query("review_count_change", b.sql(["review_heads"], """
    , state AS (SELECT product_id, count(*) AS n FROM review_heads WHERE created_at < (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY
                GROUP BY 1 HAVING max(rating) > 3),
    now AS (SELECT product_id, count(*) AS n FROM review_heads GROUP BY 1 HAVING min(rating) < 3)
    SELECT product_id, coalesce(s.n, -1) AS previous_count, now.n AS current_count, now.n - s.n AS delta
    FROM now LEFT JOIN state s USING (product_id) WHERE coalesce(s.n, -1) <> now.n"""))
def review_count_change(spark, sf_dir):
    # Products without a bad review could not be fetched, those without a good
    # one are not in the stored state.
    heads = b.review_heads(spark, sf_dir)
    newest = heads.agg(F.max("created_at") - F.expr("INTERVAL 90 DAYS")).scalar()
    state = heads.filter(F.col("created_at") < newest).groupBy("product_id").agg(
        F.count("*").alias("review_count"), F.max("rating").alias("r")).filter("r > 3")
    current = heads.groupBy("product_id").agg(
        F.when(F.min("rating") < 3, F.count("*")).alias("review_count"))
    return merge.review_count_changes(current, state)


@query("has_review_semi", b.sql(["reviews", "product_heads"], """
    SELECT product_id, name FROM product_heads WHERE product_id IN (
        SELECT product_id FROM reviews WHERE trim(content) <> '')"""))
def has_review_semi(spark, sf_dir):
    spoken = b.reviews(spark, sf_dir).filter(~text.is_blank(F.col("content")))
    return b.product_heads(spark, sf_dir).join(
        spoken.select("product_id").distinct(), "product_id", "left_semi").select("product_id", "name")


# --- unions and updates ------------------------------------------------------------------
@query("concat_chunks", b.sql(["reviews"], """
    SELECT product_id, customer_name, rating, content, created_at FROM reviews"""))
def concat_chunks(spark, sf_dir):
    # Short rows are numbered, their texts are not shuffled for it.
    heads = ranking.chunk_assignment(b.spoken_heads(spark, sf_dir), "review_id", "reviews")
    path = shared_dir(spark, "chunks")
    b.with_content(heads, spark, sf_dir).write.options(**STORED).parquet(path)
    return flatten.final_projection(spark.read.parquet(path), FINAL_COLUMNS)


@query("incremental_concat", b.sql(["reviews"], """
    SELECT review_id, status FROM reviews QUALIFY row_number() OVER (
        PARTITION BY product_id, customer_name, rating, content ORDER BY CASE WHEN status = 'F' THEN 0 ELSE 1 END, review_id) = 1"""))
def incremental_concat(spark, sf_dir):
    base, new = main_and_pending(spark, sf_dir)
    return merge.incremental_concat(base, new, ["review_id"]).select("review_id", "status")


@query("merge_labeled_reviews", b.sql(["new_reviews"], """
    SELECT review_id, false AS is_new FROM reviews WHERE status = 'F' UNION ALL SELECT review_id, true FROM new_reviews"""))
def merge_labeled_reviews(spark, sf_dir):
    main, pending = main_and_pending(spark, sf_dir)
    return merge.merge_labeled(main, pending).select("review_id", "is_new")


@query("merge_figures", b.sql(["new_reviews"], """
    SELECT (SELECT count(*) FROM new_reviews) AS added,
           (SELECT count(*) FROM new_reviews) + (SELECT count(*) FROM reviews WHERE status = 'F') AS total,
           (SELECT count(DISTINCT product_id) FROM reviews WHERE status <> 'F') AS affected"""))
def merge_figures(spark, sf_dir):
    main, pending = main_and_pending(spark, sf_dir)
    return merge.merge_figures(main, pending)


@query("delta_reviews", b.sql(["reviews"], """
    SELECT review_id, product_id, source_file FROM reviews WHERE status <> 'F'
    QUALIFY row_number() OVER (PARTITION BY product_id, content ORDER BY source_file, review_id) = 1"""))
def delta_reviews(spark, sf_dir):
    return merge.delta_reviews(main_and_pending(spark, sf_dir)[1], ["source_file", "review_id"]).select(
        "review_id", "product_id", "source_file")


_SPLIT = """CASE WHEN h < 8 THEN 'train' WHEN h = 8 THEN 'dev' ELSE 'test' END AS split"""
_HASH = "('0x' || substring(md5(review_id::VARCHAR), 1, 8))::BIGINT % 10 AS h"


@query("dataset_split", b.sql(["review_heads"], f"""
    SELECT review_id, {_SPLIT} FROM (SELECT review_id, {_HASH} FROM review_heads)"""))
def dataset_split(spark, sf_dir):
    return merge.dataset_split(b.review_heads(spark, sf_dir).select("review_id"), F.col("review_id").cast("string"))


def dataset(spark, sf_dir, reviews):
    """text and one column per aspect, from labelled reviews."""
    from ..functions.labels import label_to_columns

    return reviews.select("review_id", text.clean_review_text(F.col("content")).alias("text"), *label_to_columns(F.col("label")))


@query("dataset_append_version", b.sql(["labeled_reviews"], f"""
    SELECT review_id, md5(clean) AS text_md5, {', '.join(f"coalesce({a}, 'none') AS {a}" for a in ASPECTS)}, 'v2' AS version, {_SPLIT}
    FROM (SELECT *, {_HASH} FROM labeled_reviews JOIN {_CLEANED} t ON t.text = content)"""))
def dataset_append_version(spark, sf_dir):
    reviews = b.labeled_reviews(spark, sf_dir)
    both = merge.concat_parts([dataset(spark, sf_dir, reviews.filter(c)) for c in (MAIN, PENDING)])
    split = merge.dataset_split(both.withColumn("version", F.lit("v2")), F.col("review_id").cast("string"))
    return split.withColumn("text_md5", F.md5("text")).drop("text")


# --- windows -------------------------------------------------------------------------------
_SETS = {
    "content": ["content"],
    "product_content": ["product_id", "content"],
    "identity": ["product_id", "customer_name", "rating", "content"],
    "checkpoint": ["product_id", "customer_name", "created_at", "content"],
}


@query("dedup_keep_first", b.sql(["reviews"], " UNION ALL ".join(
    f"(SELECT '{n}' AS key_set, review_id FROM reviews QUALIFY row_number() OVER (PARTITION BY {', '.join(k)} ORDER BY review_id) = 1)"
    for n, k in _SETS.items())))
def dedup_keep_first(spark, sf_dir):
    reviews = b.reviews(spark, sf_dir)
    return merge.concat_parts([
        merge.dedup_keep_first(reviews, k, ["review_id"]).select(F.lit(n).alias("key_set"), "review_id")
        for n, k in _SETS.items()])


@query("product_list_dedup", """
    SELECT l_partkey AS product_id, l_orderkey AS page, l_linenumber::BIGINT * 1000000 + l_suppkey AS "at",
           'https://shop.example.com/item-p' || l_partkey AS product_url FROM lineitem WHERE l_partkey <> 0
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1""")
def product_list_dedup(spark, sf_dir):
    listed = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_orderkey").alias("page"),
        (F.col("l_linenumber").cast("bigint") * 1000000 + F.col("l_suppkey")).alias("at"))
    path = F.concat(F.lit("item-p"), F.col("product_id").cast("string"))
    return flatten.product_list(listed).withColumn("product_url", flatten.product_url(path, BASE_URL))


@query("take_while_recent", b.sql(["placed_heads"], """
    , cut AS (SELECT max(o_orderdate) - INTERVAL 2000 DAY AS t FROM orders),
    stops AS (SELECT product_id, min(position) AS stop FROM placed_heads, cut WHERE created_at < t GROUP BY 1)
    SELECT s.product_id, s.position // 20 + 1 AS page, (s.position % 20)::INTEGER AS at, s.rating FROM placed_heads s
    JOIN (SELECT doc_id, trim(text) <> '' AS spoken FROM documents) d ON d.doc_id = s.review_id % (SELECT count(*) FROM documents)
    LEFT JOIN stops USING (product_id) WHERE (stop IS NULL OR s.position < stop) AND rating <> 1 AND spoken"""))
def take_while_recent(spark, sf_dir):
    # Crawled pages are stored before they are read.
    served = flatten.served_reviews(materialize(raw_review_pages(spark, sf_dir), "pages"))
    cutoff = b.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("timestamp") - F.expr("INTERVAL 2000 DAYS")).scalar()
    return flatten.with_content(ranking.take_while_recent(served, "created_ts", cutoff)).select(
        "product_id", "place.page", "place.at", "rating")


@query("chunk_assignment", b.sql(["review_heads"], f"""
    SELECT review_id, position, position // {CHUNK_SIZE} AS chunk, 'reviews_chunk_' || lpad((position // {CHUNK_SIZE})::VARCHAR, 3, '0') AS chunk_name
    FROM (SELECT review_id, row_number() OVER (ORDER BY review_id) - 1 AS position FROM review_heads)"""))
def chunk_assignment(spark, sf_dir):
    return ranking.chunk_assignment(b.review_heads(spark, sf_dir).select("review_id"), "review_id", "reviews")


@query("chunk_progress", b.sql(["labeled_heads"], f"""
    SELECT chunk, bool_and(coalesce({', '.join(ASPECTS)}) IS NOT NULL) AS done FROM (
        SELECT *, (row_number() OVER (ORDER BY review_id) - 1) // 50 AS chunk FROM labeled_heads) GROUP BY chunk"""))
def chunk_progress(spark, sf_dir):
    chunks = ranking.chunk_assignment(b.labeled_heads(spark, sf_dir), "review_id", "reviews", size=50)
    done = chunks.groupBy("chunk").agg(F.bool_and(F.size("label") > 0).alias("all")).filter("all")
    return ranking.chunk_progress(chunks, done)


# --- tokens -----------------------------------------------------------------------------------
def tokens(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(text.words(F.lower("text"))).alias("pos", "token"))


b.add_view("doc_tokens", [], f"""
    SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS token FROM (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[{WS}]+'), lambda w: w <> '') AS w FROM documents)""")
b.add_view("vocab", ["doc_tokens"], """
    SELECT '<pad>' AS token, 0::BIGINT AS id, 0::BIGINT AS freq UNION ALL SELECT '<unk>', 1, 0
    UNION ALL SELECT token, 1 + row_number() OVER (ORDER BY doc, pos), freq FROM (
        SELECT token, count(*) AS freq, min(doc_id) AS doc, arg_min(pos, doc_id * 10000000 + pos) AS pos
        FROM doc_tokens GROUP BY token HAVING count(*) >= 2)""")


@query("vocab_index", b.sql(["vocab"], "SELECT * FROM vocab"))
def vocab_index(spark, sf_dir):
    return ranking.vocabulary(tokens(spark, sf_dir))


@query("encode_tokens", b.sql(["vocab"], """
    SELECT doc_id, array_to_string(list_concat(list(coalesce(v.id, 1) ORDER BY pos),
           list_resize([]::BIGINT[], 128 - count(*), 0::BIGINT)), ' ') AS ids
    FROM doc_tokens LEFT JOIN vocab v USING (token) WHERE pos < 128 GROUP BY doc_id
    UNION ALL SELECT doc_id, array_to_string(list_resize([]::BIGINT[], 128, 0::BIGINT), ' ') FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM doc_tokens)"""))
def encode_tokens(spark, sf_dir):
    words = tokens(spark, sf_dir)
    encoded = ranking.encode_tokens(words, ranking.vocabulary(words), 128, b.table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


# --- chat ------------------------------------------------------------------------------------
b.add_view("remembered", ["chat"], f"""
    SELECT conv_id, turn, role, CASE role WHEN 'user' THEN {sql_compact('text', 1200)} ELSE {sql_compact('text', 2500)} END AS content
    FROM chat WHERE role IN ('user', 'assistant')""")


@query("history_window", b.sql(["remembered"], """
    SELECT conv_id, turn, CAST(rank AS INTEGER) AS rank, role, content FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rank FROM remembered) WHERE rank <= 8"""))
def history_window(spark, sf_dir):
    return conversations.final_history(b.chat(spark, sf_dir))


@query("history_window_asof", b.sql(["remembered"], """
    SELECT conv_id, turn, count(*) OVER w AS n, coalesce(string_agg(role || ': ' || content, chr(10)) OVER w, '') AS history
    FROM remembered WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)"""))
def history_window_asof(spark, sf_dir):
    told = F.transform("history", lambda m: F.concat(m.role, F.lit(": "), m.content))
    return conversations.history_before(b.chat(spark, sf_dir)).select(
        "conv_id", "turn", F.size("history").cast("bigint").alias("n"), F.array_join(told, "\n").alias("history"))


b.add_view("chat_products", ["chat"], r"""
    SELECT *, last_value(linked IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS current_product
    FROM (SELECT *, CASE WHEN role = 'user' THEN CAST(nullif(regexp_extract(
              regexp_extract(text, '(https?://(?:www\.)?shop\.example\.com/\S+)', 1), '(?:-p|pid=)([0-9]+)', 1), '') AS BIGINT) END AS linked
          FROM chat)""")


def chat_with_products(spark, sf_dir):
    chat = conversations.with_current_product(b.chat(spark, sf_dir), "shop.example.com")
    facts = b.product_heads(spark, sf_dir).withColumnRenamed("product_id", "current_product").withColumn(
        "report", F.concat(F.lit("Báo cáo "), F.col("name")))
    return chat.join(facts, "current_product", "left")


b.add_view("chat_facts", ["chat_products", "product_heads"], """
    SELECT c.*, p.name, p.category_name, p.product_url, format('{:,}', p.price) || 'đ' AS price_text
    FROM chat_products c LEFT JOIN product_heads p ON p.product_id = c.current_product""")


@query("current_product_asof", b.sql(["chat_products"], "SELECT conv_id, turn, current_product FROM chat_products"))
def current_product_asof(spark, sf_dir):
    return conversations.with_current_product(b.chat(spark, sf_dir), "shop.example.com").select(
        "conv_id", "turn", "current_product")


_SEARCH = f"""CASE WHEN current_product IS NULL THEN text WHEN {INTENT_SQL} = 'alternative_recommendation'
    THEN text || '. Tìm sản phẩm thay thế hoặc sản phẩm tương tự cùng phân khúc cho sản phẩm hiện tại: ' || name ||
         '. Ngành hàng: ' || category_name || '. Giá tham chiếu: ' || price_text || '. Product ID: ' || current_product || '.'
    WHEN {FOLLOWUP_SQL} THEN text || '. Câu hỏi đang nói về sản phẩm hiện tại: ' || name || '. Ngành hàng: ' || category_name ||
         '. Giá: ' || price_text || '. Product ID: ' || current_product || '.' ELSE text END"""


@query("search_query_rewrite", b.sql(["chat_facts"], f"""
    SELECT conv_id, turn, current_product, {INTENT_SQL} AS intent,
           CASE WHEN {INTENT_SQL} = 'alternative_recommendation' THEN 8 ELSE 5 END AS top_k, {_SEARCH} AS search_query
    FROM chat_facts WHERE role = 'user'"""))
def search_query_rewrite(spark, sf_dir):
    return conversations.search_queries(chat_with_products(spark, sf_dir))


def _augmented_sql():
    from ..constants import REMEMBER_TEXT

    block = ("'[CURRENT_PRODUCT_CONTEXT]', 'Sản phẩm hiện tại trong hội thoại:', '- Product ID: ' || current_product, "
             "'- Tên sản phẩm: ' || name, '- Giá: ' || price_text, '- Ngành hàng: ' || category_name, '- URL: ' || product_url, '', "
             "'Báo cáo phân tích gần nhất:', 'Báo cáo ' || name, '[/CURRENT_PRODUCT_CONTEXT]'")
    remember = "'" + REMEMBER_TEXT.replace("'", "''") + "'"
    return f"""
    , past AS (SELECT conv_id, turn, coalesce(string_agg(role || ': ' || content, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), '') AS history FROM remembered)
    SELECT conv_id, turn, concat_ws(chr(10), CASE WHEN current_product IS NOT NULL AND ({FOLLOWUP_SQL} OR {INTENT_SQL} <> 'general_qa')
        THEN 'assistant: ' || {remember} || concat_ws(chr(10), {block}) END, nullif(history, '')) AS history
    FROM chat_facts JOIN past USING (conv_id, turn) WHERE role = 'user'"""


@query("augmented_history", b.sql(["chat_facts", "remembered"], _augmented_sql()))
def augmented_history(spark, sf_dir):
    from ..functions import chat_rules

    past = conversations.history_before(b.chat(spark, sf_dir)).select("conv_id", "turn", "history")
    rows = chat_with_products(spark, sf_dir).filter("role = 'user'").join(past, ["conv_id", "turn"])
    history = chat_rules.augmented_history(F.col("history"), F.col("text"), conversations.product_columns())
    told = F.transform(history, lambda m: F.concat(m.role, F.lit(": "), m.content))
    return rows.select("conv_id", "turn", F.array_join(told, "\n").alias("history"))
