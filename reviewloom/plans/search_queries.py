"""Dense, lexical and fused search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import RERANK_WEIGHT, SMOKE_MIN_HITS, WORD
from ..operators import conversations, lexical_index, search, vector_index
from . import bindings as b
from .registry import query
from .score_queries import wide_scores
from .stored import stored

CONDITIONS = [search.Condition("rating_average", "at least", 2.5), search.Condition("price", "at most", 2000)]
PREFERENCES = {"quality": -0.9, "price": -0.9, "unknown": 0.1}


def points(spark, sf_dir):
    """Knowledge base points with figures and scores of their product."""
    return search.with_aspect_scores(b.kb(spark, sf_dir), wide_scores(spark, sf_dir))


def stored_points(spark, sf_dir) -> str:
    """Folder of the points as codes and vectors."""
    return stored(spark, sf_dir, "points", ["embeddings", "part", "orders", "lineitem"],
                  lambda path: vector_index.store_vectors(points(spark, sf_dir), path))


_COSINE = "round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.embedding), 12)"
b.add_view("knn", ["kb_queries"], f"""
    SELECT q.query_id, e.vec_id AS id, {_COSINE} AS score,
           row_number() OVER (PARTITION BY q.query_id ORDER BY {_COSINE} DESC, e.vec_id) AS rank
    FROM embeddings e, kb_queries q""")


def knn(spark, sf_dir, k):
    return vector_index.vector_knn(spark, stored_points(spark, sf_dir), b.kb_queries(spark, sf_dir), k)


@query("vector_knn_join", b.sql(["knn"], """
    SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM knn WHERE rank <= 20"""))
def vector_knn_join(spark, sf_dir):
    return knn(spark, sf_dir, 20).withColumn("score", F.round("score", 6))


def _topk_sql(k, extra=""):
    return f"""
    , dense AS (SELECT q.query_id, e.id, {_COSINE} AS cosine, row_number() OVER (PARTITION BY q.query_id ORDER BY {_COSINE} DESC, e.id) AS dense_rank,
            (coalesce(s.quality_score, 0) + coalesce(s.price_score, 0)) / 3 AS boost
        FROM kb e JOIN scores_wide s ON s.product_id = e.product_id, kb_queries q
        WHERE e.rating_average >= 2.5 AND e.price <= 2000 AND s.quality_score >= -0.9 AND s.price_score >= -0.9
        QUALIFY dense_rank <= {2 * k}),
    ranked AS (SELECT *, cosine + {RERANK_WEIGHT}::DOUBLE * boost AS score, row_number() OVER (PARTITION BY query_id
            ORDER BY round(cosine + {RERANK_WEIGHT}::DOUBLE * boost, 12) DESC, dense_rank) AS rank FROM dense){extra}"""


def top(spark, sf_dir, k):
    return vector_index.vector_topk(spark, stored_points(spark, sf_dir), b.kb_queries(spark, sf_dir), k, CONDITIONS, PREFERENCES)


@query("vector_topk", b.sql(["kb", "scores_wide", "kb_queries"], _topk_sql(5) + """
    SELECT query_id, id, round(cosine, 6) AS cosine, round(boost, 6) AS boost, round(score, 6) AS score, rank::INTEGER AS rank
    FROM ranked WHERE rank <= 5"""))
def vector_topk(spark, sf_dir):
    return top(spark, sf_dir, 5).select(
        "query_id", "id", F.round("cosine", 6).alias("cosine"), F.round("boost", 6).alias("boost"),
        F.round("score", 6).alias("score"), "rank")


@query("similar_products", b.sql(["kb", "scores_wide", "kb_queries"], _topk_sql(8) + """
    SELECT query_id, r.id, k.product_id, k.name, round(score, 6) AS score, rank::INTEGER AS rank
    FROM ranked r JOIN kb k ON k.id = r.id WHERE rank <= 8"""))
def similar_products(spark, sf_dir):
    return top(spark, sf_dir, 8).select("query_id", "id", "product_id", "name", F.round("score", 6).alias("score"), "rank")


@query("vector_lsh_topk")
def vector_lsh_topk(spark, sf_dir):
    """Approximate, from cells; every vector whose id is divisible by 20 asks. Recall is tested with pytest."""
    vectors = b.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    path = stored(spark, sf_dir, "cells", ["embeddings"], lambda path: vector_index.build_cells(vectors, path, "label"))
    asking = vectors.filter("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding")
    return vector_index.vector_cells_topk(spark, vector_index.open_cells(spark, path), asking, 10)


# --- lexical ------------------------------------------------------------------------
def _bm25(queries, name):
    tokens = f"regexp_extract_all(lower(text), '[{WORD}]{{2,}}')"
    return f"""
    , {name}_terms AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({tokens}) AS term FROM ({queries})) GROUP BY ALL),
    {name}_docs AS (SELECT doc_id AS id, {tokens} AS t FROM documents),
    {name}_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM {name}_docs) GROUP BY ALL),
    {name}_df AS (SELECT term, count(*) AS df FROM {name}_tf GROUP BY term),
    {name}_n AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM {name}_docs),
    {name} AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
        SELECT q.query_id, f.id, round(sum(q.qtf * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
               / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(d.t) / mean))), 9) AS score
        FROM {name}_terms q JOIN {name}_tf f USING (term) JOIN {name}_df USING (term) JOIN {name}_docs d ON d.id = f.id, {name}_n
        GROUP BY ALL))"""


def lexical(spark, sf_dir, queries, k):
    docs = b.text_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    path = stored(spark, sf_dir, "postings", ["documents"], lambda path: lexical_index.build(docs, path))
    return lexical_index.lexical_topk(spark, path, queries, k)


b.add_view("no_view", [], "SELECT 1")


@query("lexical_topk", b.sql(["no_view"], _bm25("SELECT item_id AS query_id, text FROM benchmark", "lexical") + """
    SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM lexical WHERE rank <= 10"""))
def lexical_topk(spark, sf_dir):
    queries = b.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return lexical(spark, sf_dir, queries, 10).withColumn("score", F.round("score", 6))


# Every item of the benchmark asks with its text and with the mean vector of a document type.
b.add_view("asked", ["kb_queries"], """
    SELECT item_id AS query_id, text, embedding FROM benchmark
    JOIN kb_queries q ON q.query_id = item_id % (SELECT count(*) FROM kb_queries)""")


def asked(spark, sf_dir):
    types = b.kb_queries(spark, sf_dir).withColumnRenamed("query_id", "type")
    items = b.table(spark, sf_dir, "benchmark").withColumn("type", F.col("item_id") % b.rows_in(types))
    return items.join(types, "type").select(F.col("item_id").alias("query_id"), "text", "embedding")


@query("hybrid_topk", b.sql(["asked"], f"""
    , knn AS (SELECT q.query_id, e.vec_id AS id, row_number() OVER (PARTITION BY q.query_id ORDER BY {_COSINE} DESC, e.vec_id) AS rank
        FROM embeddings e, asked q)""" + _bm25("SELECT query_id, text FROM asked", "lexical") + """
    , fused AS (SELECT coalesce(a.query_id, z.query_id) AS query_id, coalesce(a.id, z.id) AS id, a.rank AS dense_rank, z.rank AS lexical_rank,
            coalesce(1 / (60 + a.rank), 0) + coalesce(1 / (60 + z.rank), 0) AS score
        FROM (SELECT * FROM knn WHERE rank <= 20) a FULL JOIN (SELECT * FROM lexical WHERE rank <= 20) z
          ON a.query_id = z.query_id AND a.id = z.id)
    SELECT query_id, id, dense_rank::INTEGER AS dense_rank, lexical_rank::INTEGER AS lexical_rank, round(score, 6) AS score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS INTEGER) AS rank
    FROM fused QUALIFY rank <= 10"""))
def hybrid_topk(spark, sf_dir):
    queries = asked(spark, sf_dir)
    near = vector_index.vector_knn(spark, stored_points(spark, sf_dir), queries.select("query_id", "embedding"), 20)
    words = lexical(spark, sf_dir, queries.select("query_id", "text"), 20)
    return search.hybrid_topk(near, words, 10).withColumn("score", F.round("score", 6))


@query("retrieval_smoke", b.sql(["no_view"], _bm25("SELECT item_id AS query_id, text FROM benchmark", "lexical") + f"""
    SELECT b.item_id AS query_id, count(l.id) AS hits, count(l.id) >= {SMOKE_MIN_HITS} AS passed FROM benchmark b
    LEFT JOIN (SELECT * FROM lexical WHERE rank <= 3) l ON l.query_id = b.item_id GROUP BY ALL"""))
def retrieval_smoke(spark, sf_dir):
    queries = b.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.retrieval_smoke(lexical(spark, sf_dir, queries, 3), queries, SMOKE_MIN_HITS)


# --- what is made of the hits ----------------------------------------------------------
@query("context_sources_join", b.sql(["kb", "scores_wide", "kb_queries"], _topk_sql(5) + """
    SELECT query_id, count(*) AS n_docs, string_agg(k.doc_type || ' | ' || k.name || ' | ' || printf('%.3f', score), chr(10) ORDER BY rank) AS sources
    FROM ranked r JOIN kb k ON k.id = r.id WHERE rank <= 5 GROUP BY query_id"""))
def context_sources_join(spark, sf_dir):
    source = F.concat_ws(" | ", "doc_type", "name", F.format_string("%.3f", "score"))
    return top(spark, sf_dir, 5).groupBy("query_id").agg(
        F.count("*").alias("n_docs"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", source.alias("s")))), lambda x: x.s), "\n").alias("sources"))


_CONTEXT = """'[Nguồn ' || rank || '] (' || k.doc_type || ') ' || k.name || ' — ' || format('{:,}', k.price) || 'đ — ' || k.rating_average || '/5 (' ||
    k.review_count || ' đánh giá)' || chr(10) || d.text || chr(10) || 'Phân tích đánh giá:' || chr(10) || concat_ws(chr(10), """


def _context_sql():
    from ..constants import ASPECT_REPORT_NAMES

    lines = []
    for a, name in ASPECT_REPORT_NAMES.items():
        pct = f"CAST(CASE WHEN {a}_pos + {a}_neg > 0 THEN round_even(100 * {a}_pos / ({a}_pos + {a}_neg), 0) ELSE 0 END AS INTEGER)"
        lines.append(f"CASE WHEN s.{a}_score IS NOT NULL THEN '  {name}: ' || {pct} || '% hài lòng (' || {a}_pos || ' khen / ' || {a}_neg || ' chê)' END")
    return _CONTEXT + ", ".join(lines) + ")"


@query("rag_context", b.sql(["kb", "scores_wide", "kb_queries"], _topk_sql(5) + f"""
    SELECT query_id, chr(10) || chr(10) || repeat('=', 50) || string_agg({_context_sql()}, chr(10) || chr(10) ORDER BY rank) AS context
    FROM ranked r JOIN kb k ON k.id = r.id JOIN scores_wide s ON s.product_id = k.product_id
    JOIN documents d ON d.doc_id = k.id % (SELECT count(*) FROM documents)
    WHERE rank <= 5 GROUP BY query_id"""))
def rag_context(spark, sf_dir):
    docs = b.text_table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", "text")
    hits = top(spark, sf_dir, 5).drop(*[f"absa_{a}_score" for a in ("quality", "price")]).withColumn(
        "doc_id", F.col("id") % b.rows_in(docs)).join(texts, "doc_id")
    from ..constants import ASPECTS

    parts = [F.col(f"{a}_{p}").alias(f"absa_{a}_{p}") for a in ASPECTS for p in ("pos", "neg", "score")]
    facts = wide_scores(spark, sf_dir).select("product_id", *parts)
    kept = ["query_id", "rank", "product_id", "doc_type", "name", "price", "rating_average", "review_count", "text"]
    return conversations.rag_context(hits.select(kept).join(facts, "product_id"))


@query("sorted_ids", b.sql(["recent"], "SELECT DISTINCT product_id FROM recent ORDER BY 1"))
def sorted_ids(spark, sf_dir):
    from ..operators.merge import affected_ids
    from .merge_queries import recent

    return affected_ids(recent(spark, sf_dir)).orderBy("product_id")


@query("limit_scan", b.sql(["kb"], "SELECT id, product_id, name FROM kb WHERE doc_type = 'type_1' ORDER BY id LIMIT 10"))
def limit_scan(spark, sf_dir):
    return b.kb(spark, sf_dir).filter("doc_type = 'type_1'").orderBy("id").limit(10).select("id", "product_id", "name")
