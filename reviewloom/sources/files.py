"""Tables at the edges: CSV, JSON, JSON Lines, Parquet and id lists.

Paths may name any file system Spark reaches (object stores included); no
reader infers a schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import ASPECTS, DETAIL_FIELDS
from ..session import settings

RAW_REVIEW = "product_id bigint, customer_name string, rating int, content string, created_at timestamp"
CLEAN_REVIEW = RAW_REVIEW + ", clean_content string"
LABELED_REVIEW = CLEAN_REVIEW + ", label string"
DETAIL = ", ".join(f"{c} string" for c in DETAIL_FIELDS)
DATASET = "text string, " + ", ".join(f"{a} string" for a in ASPECTS)
INTERACTION = ("timestamp timestamp, question string, answer string, contexts array<string>, "
               "sources array<struct<doc_type:string,name:string,score:double>>, latency_ms bigint, n_docs int")
EVALUATION = ("model_name string, dataset_version string, avg_f1_macro double, evaluation_time_seconds double, "
              "aspect_results map<string,struct<metrics:struct<accuracy:double,precision_macro:double,"
              "recall_macro:double,f1_macro:double>,confusion_matrix:array<array<bigint>>>>")
SCORE_PARTS = "pos bigint, {a}_neu bigint, {a}_neg bigint, {a}_score double, {a}_conf double"
SCORES = "product_id bigint, n_reviews bigint, " + ", ".join(
    f"{a}_" + SCORE_PARTS.format(a=a) for a in ASPECTS)

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
        "timestampFormat": "yyyy-MM-dd HH:mm:ss", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Text files are written compressed, as fast as gzip can; readers tell by the ending.
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def read_csv(spark: SparkSession, path, schema: str) -> DataFrame:
    """Headered CSV with quoted commas, doubled quotes and line breaks inside
    quotes. A file with such line breaks is one task: keep files moderate."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).options(**_CSV, **_GZIP, quoteAll="true")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def read_json_lines(spark: SparkSession, path, schema) -> DataFrame:
    """One JSON value per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**_GZIP, ignoreNullFields="false").json(path)


def read_json_array(spark: SparkSession, path, schema: str) -> DataFrame:
    """Files that hold one JSON array of records each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def write_dataset(split: DataFrame, path: str, version: str) -> None:
    """A split dataset below ``version=<v>/split=<train|dev|test>``. A task holds the files of its splits open side by
    side, so that its texts are not sorted by split."""
    with settings(split.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": 8}):
        split.withColumn("version", F.lit(version)).write.options(**_GZIP).partitionBy("version", "split").json(path)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATASET + ", version string, split string").json(path)


def read_interactions(spark: SparkSession, path, least: int = 0) -> DataFrame:
    """Requests with contexts from the log; malformed lines are dropped. An
    evaluation that is worth nothing on a short log asks for ``least`` readable
    lines and gets an empty table below (``MIN_INTERACTIONS`` is usual)."""
    log = spark.read.schema(INTERACTION).option("mode", "DROPMALFORMED").json(path)
    readable = log.agg(F.count("question")).scalar()
    return log.filter(F.size("contexts") > 0).filter(readable >= least)


def append_interactions(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def read_id_list(spark: SparkSession, path) -> DataFrame:
    """One id per line; blank lines are skipped, ids are distinct."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("product_id")).filter(
        "product_id IS NOT NULL").distinct()


def write_id_list(ids: DataFrame, path: str) -> None:
    """Sorted distinct ids, one per line; the part files follow the order."""
    ids.select("product_id").distinct().orderBy("product_id").select(F.col("product_id").cast("string")).write.text(path)


def explode_evaluations(results: DataFrame) -> DataFrame:
    """Nested evaluation results to one row per model, version and aspect."""
    return results.select(
        F.col("model_name").alias("model"), "dataset_version", F.explode("aspect_results").alias("aspect", "r")
    ).select("model", "dataset_version", "aspect", "r.metrics.*")


def evaluation_times(results: DataFrame) -> DataFrame:
    return results.select(F.col("model_name").alias("model"), "dataset_version", "evaluation_time_seconds")


def append_daily(rows: DataFrame, path: str) -> None:
    """Appends rows to the folder of their ``ingest_date``."""
    rows.write.mode("append").partitionBy("ingest_date").parquet(path)


def dates_in(files: DataFrame, column: str = "path") -> DataFrame:
    """Dates (YYYYMMDD) in file names, with the file."""
    day = F.regexp_extract(column, r"(\d{8})", 1)
    return files.select(F.col(column).alias("path"), day.alias("day")).filter("day <> ''")


def file_names(spark: SparkSession, path) -> DataFrame:
    """The files below ``path`` with their age. Only the listing is read, not what they hold."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", F.col("modificationTime").alias("modified"))


def pending_files(upstream: DataFrame, downstream: DataFrame) -> DataFrame:
    """Upstream files of days that have no downstream file yet."""
    return dates_in(upstream).join(dates_in(downstream).select("day").distinct(), "day", "left_anti")


def latest_snapshot(files: DataFrame) -> DataFrame:
    """The newest file (path, modified); no row when there is none."""
    newest = files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"))
    return newest.filter("path IS NOT NULL")
