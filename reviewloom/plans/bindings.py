"""Review views over the driver's tables, in Spark and in SQL.

Orders play the reviews, parts the products, line items the aspect labels,
documents the texts, pages the raw descriptions, embeddings the knowledge base
and conversations the chat. Every view reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import ASPECTS
from ..functions.labels import LABEL_TYPE
from ..operators.layout import spread

SENTIMENT_OF_FLAG = {"A": "positive", "N": "neutral", "R": "negative"}
CHAT_LINK = "https://shop.example.com/item-p"
# What a user of the chat asks after the message text, chosen by its length.
CHAT_QUESTIONS = [
    "Có nên mua sản phẩm này không?", "Tìm sản phẩm khác cùng phân khúc", "Người dùng nói gì về món này?",
    "Giá bao nhiêu?", "Nó dùng có bền không?",
]

#: Bytes of texts that are sent to every task, at most so much and this part of the driver's memory, which they pass.
SENT_BYTES, SENT_SHARE = 200_000_000, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark, sf_dir, name) -> DataFrame:
    """A table whose rows are costly to work on, over all cores."""
    keys = {"documents": "doc_id", "pages": "page_id", "part": "p_partkey", "embeddings": "vec_id"}
    return spread(table(spark, sf_dir, name), keys[name])


def rows_in(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def sentiment_of(flag: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in SENTIMENT_OF_FLAG.items() for x in kv]), flag)


def aspect_of(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ASPECTS)), ((number - 1) % 6 + 1).cast("int"))


def review_heads(spark, sf_dir) -> DataFrame:
    """Reviews without their text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("product_id"),
        F.concat(F.lit("buyer "), F.col("o_custkey").cast("string")).alias("customer_name"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("labeled_reviews_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("source_file"),
    )


def reviews(spark, sf_dir) -> DataFrame:
    return with_content(spread(review_heads(spark, sf_dir), "review_id"), spark, sf_dir)


def with_content(heads, spark, sf_dir, whole: bool = False) -> DataFrame:
    """``heads`` with their texts; ``whole`` keeps their partitioning where the texts are few enough."""
    docs = table(spark, sf_dir, "documents")
    said = docs.select("doc_id", F.col("text").alias("content"))
    return _with_doc_id(heads, docs).join(sent_whole(said, "content") if whole else said, "doc_id").drop("doc_id")


def sent_whole(df, text: str) -> DataFrame:
    """Asks Spark to send ``df`` to every task where its texts are small enough for that by their own bytes; Spark goes by
    the size of files or shuffles and a limit for tables that many joins send at once."""
    heap = df.sparkSession._jvm.java.lang.Runtime.getRuntime().maxMemory()
    size = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= min(SENT_BYTES, heap // SENT_SHARE) else df


def _with_doc_id(heads, docs) -> DataFrame:
    return heads.withColumn("doc_id", F.col("review_id") % rows_in(docs))


def spoken_heads(spark, sf_dir) -> DataFrame:
    """The reviews that ``with_content`` finds a text for, still without it."""
    docs = table(spark, sf_dir, "documents")
    return _with_doc_id(review_heads(spark, sf_dir), docs).join(docs.select("doc_id"), "doc_id", "left_semi").drop("doc_id")


def review_labels(spark, sf_dir) -> DataFrame:
    """review_id -> label with at most one item per aspect, the last line wins.

    The place of a line (number, part, supplier: up to 13 digits each) and its
    sentiment's code are one number, so the last one is a plain maximum, which
    Spark keeps in a hash table without sorting the lines.
    """
    names = list(SENTIMENT_OF_FLAG.values())
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    code = F.coalesce(*[F.when(F.col("l_returnflag") == flag, F.lit(i + 1)) for i, flag in enumerate(SENTIMENT_OF_FLAG)], F.lit(0))
    place = whole("l_linenumber") * F.lit(10**13).cast("decimal(38,0)") + whole("l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("review_id"), ((F.col("l_linenumber") - 1) % 6).alias("aspect"),
        (place * F.lit(10**14).cast("decimal(38,0)") + whole("l_suppkey") * 10 + code).alias("packed"))
    last = [F.max(F.when(F.col("aspect") == i, F.col("packed"))).alias(a) for i, a in enumerate(ASPECTS)]
    told = lambda a: F.try_element_at(F.array(*map(F.lit, names)), F.nullif((F.col(a) % 10).cast("int"), F.lit(0)))
    items = F.array(*[F.struct(F.lit(a).alias("aspect"), told(a).alias("sentiment")) for a in ASPECTS])
    return lines.groupBy("review_id").agg(*last).select(
        "review_id", F.filter(items, lambda x: x.sentiment.isNotNull()).alias("label")
    )


def _with_labels(df, spark, sf_dir) -> DataFrame:
    return df.join(review_labels(spark, sf_dir), "review_id", "left").withColumn(
        "label", F.coalesce("label", F.array().cast(LABEL_TYPE))
    )


def labeled_heads(spark, sf_dir) -> DataFrame:
    return _with_labels(review_heads(spark, sf_dir), spark, sf_dir)


def labeled_reviews(spark, sf_dir) -> DataFrame:
    """Labels meet the short rows; the texts come last and are not shuffled
    for them. The pieces are made before, so that work on texts uses all cores."""
    cores = spark.sparkContext.defaultParallelism
    return with_content(labeled_heads(spark, sf_dir).repartition(cores, "review_id"), spark, sf_dir)


def texts(spark, sf_dir) -> DataFrame:
    """What ``doc_id`` of a review stands for."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))


def labeled_by_text(spark, sf_dir) -> DataFrame:
    """Labeled reviews with the id of their text instead of the text; some texts may be missing."""
    return _with_doc_id(labeled_heads(spark, sf_dir), table(spark, sf_dir, "documents"))


def label_items(spark, sf_dir) -> DataFrame:
    """One row per line: repeated aspects stay, ``item_no`` orders them."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("item_no"),
        aspect_of(F.col("l_linenumber")).alias("aspect"),
        sentiment_of(F.col("l_returnflag")).alias("sentiment"),
    )


def product_heads(spark, sf_dir) -> DataFrame:
    """Catalogue columns without description and review figures."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("category_name"),
        F.floor("p_retailprice").cast("bigint").alias("price"),
        F.concat(F.lit("https://shop.example.com/item-p"), F.col("p_partkey").cast("string")).alias("product_url"),
    )


def products(spark, sf_dir) -> DataFrame:
    """Catalogue columns with the review figures of each product."""
    figures = review_heads(spark, sf_dir).groupBy("product_id").agg(
        F.bround(F.sum("rating") / F.count("*"), 2).alias("rating_average"),
        F.count("*").alias("review_count"),
    )
    return product_heads(spark, sf_dir).join(figures, "product_id", "left")


def described_products(spark, sf_dir) -> DataFrame:
    """Products with a raw HTML description."""
    pages = table(spark, sf_dir, "pages")
    # Small rows go over all cores before the long descriptions are attached.
    cores = spark.sparkContext.defaultParallelism
    found = products(spark, sf_dir).repartition(cores, "product_id").withColumn("page_id", F.col("product_id") % rows_in(pages))
    return found.join(pages.select("page_id", F.col("html").alias("short_description")), "page_id").drop("page_id")


def kb(spark, sf_dir) -> DataFrame:
    """Knowledge base points with the figures of their product."""
    parts = table(spark, sf_dir, "part")
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("type_"), F.col("label").cast("string")).alias("doc_type"),
        "embedding",
        (F.col("vec_id") % rows_in(parts)).alias("product_id"),
    )
    return points.join(products(spark, sf_dir), "product_id", "left")


def kb_queries(spark, sf_dir) -> DataFrame:
    """One query vector per document type: the mean of its vectors."""
    dims = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
    means = dims.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda p: p.x).alias("embedding")
    )


def chat(spark, sf_dir) -> DataFrame:
    """Chat messages; user messages end in a question, some carry a link."""
    parts = rows_in(table(spark, sf_dir, "part"))
    size = F.length("text")
    question = F.element_at(F.array(*map(F.lit, CHAT_QUESTIONS)), (size % 5 + 1).cast("int"))
    link = F.when((F.col("turn") <= 1) | (size > 200), F.concat(
        F.lit(" " + CHAT_LINK), ((F.col("conv_id") * 7 + F.col("turn")) % parts).cast("string")))
    said = F.concat(F.col("text"), F.lit(" "), question, F.coalesce(link, F.lit("")))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.when(F.col("role") == "user", said).otherwise(F.col("text")).alias("text")
    )


def interactions(spark, sf_dir) -> DataFrame:
    """Request log: one row per served request."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").alias("failed"), "event_type", "props",
    )


# --- the same views as SQL ---------------------------------------------------

_ASPECT_LIST = "[" + ", ".join(f"'{a}'" for a in ASPECTS) + "]"
_SENTIMENT_CASE = "CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'N' THEN 'neutral' WHEN 'R' THEN 'negative' END"
_QUESTIONS = "[" + ", ".join(f"'{q}'" for q in CHAT_QUESTIONS) + "]"

# name -> (views it needs, definition)
SQL_VIEWS: dict[str, tuple[list[str], str]] = {
    "review_heads": ([], """
        SELECT o_orderkey AS review_id, o_custkey AS product_id, 'buyer ' || o_custkey AS customer_name,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS rating, o_orderdate AS created_at,
               o_orderstatus AS status,
               'labeled_reviews_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS source_file
        FROM orders"""),
    "reviews": (["review_heads"], """
        SELECT h.*, d.text AS content FROM review_heads h
        JOIN documents d ON d.doc_id = h.review_id % (SELECT count(*) FROM documents)"""),
    "label_items": ([], f"""
        SELECT l_orderkey AS review_id, l_linenumber, l_partkey, l_suppkey,
               list_extract({_ASPECT_LIST}, (l_linenumber - 1) % 6 + 1) AS aspect,
               {_SENTIMENT_CASE} AS sentiment
        FROM lineitem"""),
    "review_sentiments": (["label_items"], """
        SELECT review_id, aspect, last(sentiment ORDER BY l_linenumber, l_partkey, l_suppkey) AS sentiment
        FROM label_items GROUP BY ALL"""),
    "review_labels": (["review_sentiments"], "SELECT review_id, " + ", ".join(
        f"max(sentiment) FILTER (WHERE aspect = '{a}') AS {a}" for a in ASPECTS)
        + " FROM review_sentiments GROUP BY review_id"),
    "labeled_heads": (["review_heads", "review_labels"], """
        SELECT * FROM review_heads LEFT JOIN review_labels USING (review_id)"""),
    "labeled_reviews": (["reviews", "review_labels"], """
        SELECT * FROM reviews LEFT JOIN review_labels USING (review_id)"""),
    "product_heads": ([], """
        SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand_name, p_type AS category_name,
               CAST(floor(p_retailprice) AS BIGINT) AS price,
               'https://shop.example.com/item-p' || p_partkey AS product_url
        FROM part"""),
    "products": (["product_heads", "review_heads"], """
        SELECT p.*, f.rating_average, f.review_count FROM product_heads p LEFT JOIN (
            SELECT product_id, round_even(sum(rating) / count(*), 2) AS rating_average, count(*) AS review_count
            FROM review_heads GROUP BY product_id) f USING (product_id)"""),
    "described_products": (["products"], """
        SELECT p.*, g.html AS short_description FROM products p
        JOIN pages g ON g.page_id = p.product_id % (SELECT count(*) FROM pages)"""),
    "kb": (["products"], """
        SELECT e.vec_id AS id, 'type_' || e.label AS doc_type, e.embedding, p.* FROM embeddings e
        LEFT JOIN products p ON p.product_id = e.vec_id % (SELECT count(*) FROM part)"""),
    "kb_queries": ([], """
        SELECT label AS query_id, list(x ORDER BY dim) AS embedding FROM (
            SELECT CAST(label AS BIGINT) AS label, dim, avg(CAST(x AS DOUBLE)) AS x FROM (
                SELECT label, generate_subscripts(embedding, 1) AS dim, unnest(embedding) AS x FROM embeddings)
            GROUP BY ALL) GROUP BY label"""),
    "chat": ([], f"""
        SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN text || ' ' ||
               list_extract({_QUESTIONS}, length(text) % 5 + 1) ||
               CASE WHEN turn <= 1 OR length(text) > 200
                    THEN ' {CHAT_LINK}' || ((conv_id * 7 + turn) % (SELECT count(*) FROM part)) ELSE '' END
               ELSE text END AS text
        FROM conversations"""),
    "interactions": ([], """
        SELECT event_id, ts, user_id, value AS latency_ms, event_type = 'error' AS failed, event_type, props
        FROM events"""),
}


def add_view(name: str, needs: list[str], body: str) -> None:
    SQL_VIEWS[name] = (needs, body)


def sql(views: list[str], body: str) -> str:
    """``body`` behind a WITH clause holding the views it needs."""
    ordered: list[str] = []

    def visit(name):
        for need in SQL_VIEWS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        visit(view)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v][1]})" for v in ordered) + "\n" + body
