"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECTS
from ..functions import text
from ..functions.numbers import safe_int
from ..operators import evaluation as ev, merge
from ..session import shared_dir
from ..sources import files
from ..streaming import jobs
from . import bindings as b
from .document_queries import all_documents, flat
from .evaluation_queries import MODEL_KEYS, _KEYS, _ROUND4, metrics, pairs, rounded
from .merge_queries import _CLEANED, _HASH, _SPLIT, dataset, recent
from .project_queries import BASE_URL, raw_products
from .registry import query
from .score_queries import wide_scores


@query("scan_reviews", b.sql(["labeled_reviews"], """
    SELECT product_id, customer_name, rating, content, created_at, '[' || concat_ws(',', """ + ", ".join(
    f"'{{\"aspect\":\"{a}\",\"sentiment\":\"' || {a} || '\"}}'" for a in ASPECTS) + ") || ']' AS label FROM labeled_reviews"))
def scan_reviews(spark, sf_dir):
    path = shared_dir(spark, "reviews-csv")
    rows = b.labeled_reviews(spark, sf_dir).select(
        "product_id", "customer_name", "rating", "content", F.col("created_at").cast("timestamp").alias("created_at"),
        F.lit("").alias("clean_content"), F.to_json("label").alias("label"))
    files.write_csv(rows, path)
    return files.read_csv(spark, path, files.LABELED_REVIEW).drop("clean_content").withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz"))


@query("scan_product_detail", b.sql(["product_heads"], """
    SELECT p_partkey AS product_id, p_name AS name, trunc(p_retailprice)::BIGINT AS price, p_size::BIGINT AS discount_rate,
           CASE WHEN p_size > 10 THEN 'https://shop.example.com/item-p' || p_partkey END AS product_url FROM part"""))
def scan_product_detail(spark, sf_dir):
    from ..operators.flatten import flatten_product

    path = shared_dir(spark, "detail-csv")
    files.write_csv(flatten_product(raw_products(spark, sf_dir), BASE_URL), path)
    read = files.read_csv(spark, path, files.DETAIL)
    return read.select(
        safe_int(F.col("product_id")).alias("product_id"), "name", safe_int(F.col("price")).alias("price"),
        safe_int(F.col("discount_rate")).alias("discount_rate"), F.nullif("product_url", F.lit("")).alias("product_url"))


def _stored_scores(spark, sf_dir):
    path = shared_dir(spark, "scores")
    wide_scores(spark, sf_dir).write.parquet(path)
    return path


@query("sink_scores", b.sql(["scores_wide"], "SELECT * FROM scores_wide"))
def sink_scores(spark, sf_dir):
    return spark.read.parquet(_stored_scores(spark, sf_dir))


@query("scan_scores", b.sql(["scores_wide"], "SELECT product_id, quality_pos, quality_score FROM scores_wide"))
def scan_scores(spark, sf_dir):
    scores = spark.read.schema(files.SCORES).parquet(_stored_scores(spark, sf_dir))
    return scores.select("product_id", "quality_pos", "quality_score")


def _stored_documents(spark, sf_dir):
    path = shared_dir(spark, "documents")
    docs = all_documents(spark, sf_dir)
    files.write_json_lines(docs, path)
    return files.read_json_lines(spark, path, docs.schema)


@query("sink_documents", b.sql(["base_docs"], "SELECT id, doc_type, product_id, content FROM base_docs"))
def sink_documents(spark, sf_dir):
    return flat(_stored_documents(spark, sf_dir))


@query("scan_documents", b.sql(["base_docs"], "SELECT doc_type, count(*) AS n, count(DISTINCT product_id) AS products FROM base_docs GROUP BY ALL"))
def scan_documents(spark, sf_dir):
    per_product = flat(_stored_documents(spark, sf_dir)).groupBy("doc_type", "product_id").agg(F.count("*").alias("n"))
    return per_product.groupBy("doc_type").agg(F.sum("n").alias("n"), F.count("*").alias("products"))


def _split_dataset(spark, sf_dir):
    rows = dataset(spark, sf_dir, b.labeled_reviews(spark, sf_dir))
    return merge.dataset_split(rows, F.col("review_id").cast("string")).drop("review_id")


_DATASET = f"""SELECT md5(clean) AS text_md5, {', '.join(f"coalesce({a}, 'none') AS {a}" for a in ASPECTS)}, 'v2' AS version, {_SPLIT}
    FROM (SELECT *, {_HASH} FROM labeled_reviews JOIN {_CLEANED} t ON t.text = content)"""


@query("sink_dataset", b.sql(["labeled_reviews"], _DATASET))
def sink_dataset(spark, sf_dir):
    path = shared_dir(spark, "dataset")
    files.write_dataset(_split_dataset(spark, sf_dir), path, "v2")
    return files.read_dataset(spark, path).withColumn("text_md5", F.md5("text")).drop("text")


@query("scan_dataset", b.sql(["labeled_reviews"], f"SELECT version, split, quality, count(*) AS n FROM ({_DATASET}) GROUP BY ALL"))
def scan_dataset(spark, sf_dir):
    path = shared_dir(spark, "dataset")
    files.write_dataset(_split_dataset(spark, sf_dir), path, "v2")
    return files.read_dataset(spark, path).groupBy("version", "split", "quality").agg(F.count("*").alias("n"))


def _stored_evaluations(spark, sf_dir):
    """Nested evaluation JSON per model and version, from the metrics."""
    figures = metrics(spark, sf_dir)
    names = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]
    counted = pairs(spark, sf_dir).groupBy("model", "dataset_version").agg(F.count("*").alias("n"))
    nested = figures.groupBy("model", "dataset_version").agg(
        F.map_from_entries(F.collect_list(F.struct("aspect", F.struct(F.struct(*names).alias("metrics"))))).alias("aspect_results"),
        F.avg("f1_macro").alias("avg_f1_macro"),
    ).join(counted, ["model", "dataset_version"]).select(
        F.col("model").alias("model_name"), "dataset_version", "avg_f1_macro",
        (F.col("n") / 1000).alias("evaluation_time_seconds"), "aspect_results")
    path = shared_dir(spark, "evaluations")
    files.write_json_lines(nested, path)
    return files.read_json_lines(spark, path, files.EVALUATION)


@query("scan_eval_results", b.sql(["metrics"], f"SELECT {_KEYS}, {_ROUND4} FROM metrics"))
def scan_eval_results(spark, sf_dir):
    rows = files.explode_evaluations(_stored_evaluations(spark, sf_dir))
    return rounded(rows, ["accuracy", "precision_macro", "recall_macro", "f1_macro"])


@query("eval_time_table", b.sql(["pairs"], """
    SELECT model, dataset_version, count(*) / 1000 AS evaluation_time_seconds FROM pairs GROUP BY ALL"""))
def eval_time_table(spark, sf_dir):
    return files.evaluation_times(_stored_evaluations(spark, sf_dir))


def interaction_log(spark, sf_dir):
    """Requests as they are logged; views found no context."""
    log = b.interactions(spark, sf_dir)
    contexts = F.when(F.col("event_type") == "view", F.array().cast("array<string>")).otherwise(F.array("props"))
    return log.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.concat(F.lit("q"), F.col("event_id")).alias("question"),
        F.col("event_type").alias("answer"), contexts.alias("contexts"),
        F.array(F.struct(F.col("event_type").alias("doc_type"), F.col("props").alias("name"),
                         F.round("latency_ms", 3).alias("score"))).alias("sources"),
        F.round("latency_ms").cast("bigint").alias("latency_ms"), F.lit(1).alias("n_docs"))


_INTERACTIONS = """SELECT 'q' || event_id AS question, event_type AS answer, props AS context, round(latency_ms, 3) AS score,
    round(latency_ms)::BIGINT AS latency_ms FROM interactions"""


def _stored_interactions(spark, sf_dir):
    """The log in two appends, with a broken line in between."""
    path = shared_dir(spark, "interactions")
    log = interaction_log(spark, sf_dir)
    files.append_interactions(log.filter("answer = 'error'"), path)
    log.limit(1).select(F.lit('{"question": "cut').alias("value")).write.mode("append").text(path)
    files.append_interactions(log.filter("answer <> 'error'"), path)
    return path


@query("scan_interactions", b.sql(["interactions"], f"SELECT * FROM ({_INTERACTIONS}) WHERE answer <> 'view'"))
def scan_interactions(spark, sf_dir):
    return files.read_interactions(spark, _stored_interactions(spark, sf_dir)).select(
        "question", "answer", F.col("contexts")[0].alias("context"), F.col("sources")[0]["score"].alias("score"), "latency_ms")


@query("sink_interactions", b.sql(["interactions"], "SELECT event_type AS answer, count(*) AS n FROM interactions GROUP BY ALL"))
def sink_interactions(spark, sf_dir):
    path = _stored_interactions(spark, sf_dir)
    log = spark.read.schema(files.INTERACTION).option("mode", "DROPMALFORMED").json(path)
    return log.filter("answer IS NOT NULL").groupBy("answer").agg(F.count("*").alias("n"))


def _stored_ids(spark, sf_dir):
    path = shared_dir(spark, "ids")
    files.write_id_list(merge.affected_ids(recent(spark, sf_dir)), path)
    return path


@query("scan_id_list", b.sql(["recent"], "SELECT DISTINCT product_id FROM recent"))
def scan_id_list(spark, sf_dir):
    return files.read_id_list(spark, _stored_ids(spark, sf_dir))


@query("sink_id_list", b.sql(["recent"], "SELECT DISTINCT product_id::VARCHAR AS line FROM recent"))
def sink_id_list(spark, sf_dir):
    return spark.read.text(_stored_ids(spark, sf_dir)).select(F.col("value").alias("line"))


def _daily(spark, sf_dir, condition=None):
    """Reviews in one folder per month of their date, named by its first day."""
    heads = b.review_heads(spark, sf_dir)
    rows = heads.filter(condition) if condition is not None else heads
    return rows.withColumn("ingest_date", F.date_format(F.trunc("created_at", "month"), "yyyyMMdd"))


@query("sink_daily_append", b.sql(["review_heads"], """
    SELECT strftime(date_trunc('month', created_at), '%Y%m%d') AS ingest_date, count(*) AS n, min(review_id) AS first_id FROM review_heads GROUP BY ALL"""))
def sink_daily_append(spark, sf_dir):
    path = shared_dir(spark, "daily")
    for part in ("rating > 3", "rating <= 3"):
        files.append_daily(_daily(spark, sf_dir, part), path)
    read = spark.read.schema("review_id bigint, ingest_date string").parquet(path)
    return read.groupBy("ingest_date").agg(F.count("*").alias("n"), F.min("review_id").alias("first_id"))


@query("pending_files", b.sql(["review_heads"], """
    SELECT DISTINCT strftime(date_trunc('month', created_at), '%Y%m%d') AS day FROM review_heads EXCEPT
    SELECT DISTINCT strftime(date_trunc('month', created_at), '%Y%m%d') FROM review_heads WHERE created_at < (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY"""))
def pending_files(spark, sf_dir):
    newest = b.table(spark, sf_dir, "orders").agg(F.max("o_orderdate") - F.expr("INTERVAL 365 DAYS")).scalar()
    raw, clean = shared_dir(spark, "raw"), shared_dir(spark, "clean")
    files.append_daily(_daily(spark, sf_dir), raw)
    files.append_daily(_daily(spark, sf_dir, F.col("created_at") < newest), clean)
    listed = [files.file_names(spark, p).select(
        F.regexp_extract("path", r"ingest_date=\d{8}", 0).alias("path")) for p in (raw, clean)]
    return files.pending_files(*listed).select("day").distinct()


@query("latest_snapshot", b.sql(["review_heads"], "SELECT 'final=2' AS snapshot, count(*) AS n FROM review_heads"))
def latest_snapshot(spark, sf_dir):
    path = shared_dir(spark, "final")
    heads = b.review_heads(spark, sf_dir).select("review_id", "status")
    for i, rows in enumerate((heads.filter("status = 'F'"), heads.filter("status <> 'O'"), heads)):
        rows.write.parquet(f"{path}/final={i}")
    stored = spark.read.parquet(path)
    newest = files.latest_snapshot(files.file_names(spark, path)).select(
        F.regexp_extract("path", r"(final=\d+)", 1).alias("snapshot"))
    named = stored.withColumn("snapshot", F.regexp_extract(F.col("_metadata.file_path"), r"(final=\d+)", 1))
    return named.join(newest, "snapshot", "left_semi").groupBy("snapshot").agg(F.count("*").alias("n"))


@query("archive_processed", b.sql(["review_heads"], """
    SELECT status, count(*) AS n FROM review_heads GROUP BY ALL"""))
def archive_processed(spark, sf_dir):
    """Reviews arrive by status in three rounds; every file is consumed, moved to the archive, and read from there."""
    inbox, done, folder = (shared_dir(spark, x) for x in ("inbox", "archive", "consume"))
    schema = "review_id bigint, status string"
    for part in ("status = 'F'", "status = 'O'", "status NOT IN ('F', 'O')"):
        b.review_heads(spark, sf_dir).select("review_id", "status").filter(part).write.mode("append").parquet(inbox)
        jobs.consume(spark, inbox, schema, done, folder)
    return spark.read.schema(schema).parquet(jobs.archived(done, inbox)).groupBy("status").agg(F.count("*").alias("n"))


@query("object_store_io", b.sql(["reviews"], "SELECT product_id, rating, content FROM reviews"))
def object_store_io(spark, sf_dir):
    """Write and read one key of a store: any path Spark understands will do."""
    path = shared_dir(spark, "bucket") + "/processed/preprocessed/reviews.csv"
    rows = b.reviews(spark, sf_dir)
    files.write_csv(rows.select("product_id", "customer_name", "rating", "content",
                                F.col("created_at").cast("timestamp").alias("created_at")), path)
    return files.read_csv(spark, path, files.RAW_REVIEW).select("product_id", "rating", "content")
