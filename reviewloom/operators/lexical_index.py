"""BM25 over a stored postings table in blocks that know their largest weight.

Documents are dealt to blocks of about ``BLOCK_DOCUMENTS`` by a hash of their id. A row of the table holds the
documents of one block that have one term, with its count in each and their lengths, which tell its weight, and the
largest of these weights. The sum of the largest weights of a query's terms bounds the score of every document of a block, so that blocks which
cannot reach the k-th best score are never opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import terms
from ..session import STORED, materialize
from .layout import top_per_key

BLOCK_DOCUMENTS = 1024
#: Blocks whose postings one task makes, on average.
TASK_BLOCKS = 4
#: Blocks of one file.
FILE_BLOCKS = 64
#: Postings of one folder of terms.
PART_POSTINGS = 20_000_000
#: Rows of terms and blocks that go to every task; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
DIGITS = 12
TERMS = "term string, df long, part int"
BLOCKS = "term string, block long, most double, df long, documents array<struct<id: long, tf: int, length: int>>, part int"


def _weight(tf: Column, length: Column, mean: float, k1: float, b: float) -> Column:
    """tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length))."""
    return tf * F.lit(k1 + 1) / (tf + F.lit(k1) * (F.lit(1 - b) + F.lit(b) * length / F.lit(mean)))


def build(docs: DataFrame, path: str, k1: float = 1.2, b: float = 0.75) -> str:
    """Stores the postings of ``docs`` (id, text). The texts themselves are dealt to the tasks by block, so that
    postings are counted and gathered where they arise and only whole rows of the table are shuffled, once; document
    frequencies are sums over the blocks. Documents without terms count in the mean length only.
    """
    spark = docs.sparkSession
    told = terms(F.col("text"))
    n, total = docs.agg(F.count("*"), F.coalesce(F.sum(F.size(told)), F.lit(0))).first()
    mean, blocks, parts = total / max(1, n), max(1, -(-n // BLOCK_DOCUMENTS)), max(1, -(-total // PART_POSTINGS))
    spark.createDataFrame([(n, blocks, parts, mean, k1, b)], "n long, blocks long, parts int, mean double, k1 double, b double").write.parquet(
        f"{path}/figures")

    tasks = max(spark.sparkContext.defaultParallelism, -(-blocks // TASK_BLOCKS))
    dealt = docs.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "text").repartition(tasks, "block")
    listed = dealt.select("block", "id", told.alias("terms")).select(
        "block", "id", F.size("terms").alias("length"), F.explode("terms").alias("term"))
    found = listed.groupBy("block", "id", "length", "term").agg(F.count("*").cast("int").alias("tf"))
    rows = found.groupBy("block", "term").agg(
        F.max(_weight(F.col("tf"), F.col("length"), mean, k1, b)).alias("most"), F.count("*").alias("df"),
        F.collect_list(F.struct(F.col("id").cast("long").alias("id"), "tf", "length")).alias("documents"))
    part = F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")
    rows.withColumn("part", part).repartition("part", F.floor(F.col("block") / FILE_BLOCKS)).sortWithinPartitions(
        "term", "block").write.options(**STORED).partitionBy("part").parquet(f"{path}/blocks")
    counts = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part", "term").agg(F.sum("df").alias("df"))
    counts.write.options(**STORED).partitionBy("part").parquet(f"{path}/terms")
    return path


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def query_terms(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """(query_id, term, part, factor) of the stored terms in ``queries`` (query_id, text); factor = times in the query
    * ln(1 + (n - df + 0.5) / (df + 0.5))."""
    figures = spark.read.parquet(f"{path}/figures").first()
    asked = queries.select("query_id", F.explode_outer(terms(F.col("text"))).alias("term")).filter("term IS NOT NULL").groupBy(
        "query_id", "term").agg(F.count("*").alias("qtf")).withColumn("part", F.pmod(F.xxhash64("term"), F.lit(figures.parts)).cast("int"))
    asked = materialize(asked, "asked")
    idf = F.log(F.lit(1) + (F.lit(figures.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = spark.read.schema(TERMS).parquet(f"{path}/terms").join(_small(asked), ["part", "term"])
    return materialize(known.select("query_id", "term", "part", (F.col("qtf") * idf).alias("factor")), "query-terms")


def block_bounds(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """(query_id, block, bound) of all blocks with a term of the query, from the largest weights alone."""
    rows = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("part", "term", "block", "most")
    return rows.join(_small(asked), ["part", "term"]).groupBy("query_id", "block").agg(F.sum(F.col("most") * F.col("factor")).alias("bound"))


def block_scores(spark: SparkSession, path: str, asked: DataFrame, opened: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) of the best ``k`` documents of each query in the ``opened`` blocks (query_id, block)."""
    wanted = materialize(opened.select("query_id", "block").join(asked, "query_id"), "opened")
    rows = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("part", "term", "block", "documents").join(_small(wanted), ["part", "term", "block"])
    each = rows.select("query_id", "factor", F.explode("documents").alias("d"))
    figures = spark.read.parquet(f"{path}/figures").first()
    weight = _weight(F.col("d.tf"), F.col("d.length"), figures.mean, figures.k1, figures.b)
    scores = each.groupBy("query_id", "d.id").agg(F.round(F.sum(weight * F.col("factor")), DIGITS).alias("score"))
    return top_per_key(scores, ["query_id"], [F.desc("score"), F.asc("id")], k).drop("rank")


def opened_blocks(bounds: DataFrame, scores: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Of the blocks not opened yet those whose bound reaches the k-th best score so far."""
    least = scores.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
    return bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti").join(least, "query_id").filter(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - 10.0 ** (2 - DIGITS)))


def lexical_topk(spark: SparkSession, path: str, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best stored documents of each text query (query_id, text), by id where scores are equal.

    Each query's ``k`` most promising blocks are opened first; the k-th score found there closes all blocks whose
    bound stays below it. What a task holds is a block of documents, whatever words are asked for; nothing but the
    stored counts of documents and blocks comes to the driver. Queries without a known term find nothing.
    """
    asked = query_terms(spark, path, queries)
    bounds = materialize(block_bounds(spark, path, asked), "bounds")
    first = materialize(top_per_key(bounds, ["query_id"], [F.desc("bound"), F.asc("block")], k), "first-blocks")
    scores = materialize(block_scores(spark, path, asked, first, k), "first-scores")
    rest = block_scores(spark, path, asked, opened_blocks(bounds, scores, first, k), k)
    return top_per_key(scores.unionByName(rest), ["query_id"], [F.desc("score"), F.asc("id")], k)
