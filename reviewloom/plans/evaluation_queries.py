"""Evaluation, profiling and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ASPECTS
from ..functions import text
from ..operators import evaluation as ev, profiling, sketches
from ..session import shared_dir
from . import bindings as b
from .registry import query
from .scalar_queries import sql_clean_review

MODEL_KEYS = ["model", "dataset_version", "aspect"]
VERSIONS = ["logreg_v1", "logreg_v2", "random_forest_v1", "random_forest_v2"]


def rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- two classifiers on two data versions: line items hold truth and answers --------
def pairs(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    from ..functions.labels import label_code

    answers = F.explode(F.array(
        F.struct(F.lit("logreg").alias("model"), (F.floor("l_quantity") % 3).cast("int").alias("p")),
        F.struct(F.lit("random_forest").alias("model"), (F.col("l_suppkey") % 3).cast("int").alias("p"))))
    return lines.select(
        F.when(F.col("l_linestatus") == "O", "v1").otherwise("v2").alias("dataset_version"),
        b.aspect_of(F.col("l_linenumber")).alias("aspect"),
        label_code(b.sentiment_of(F.col("l_returnflag"))).alias("y"), answers.alias("a"),
    ).select("a.model", "dataset_version", "aspect", "y", "a.p")


_CODE = "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 WHEN 'A' THEN 2 END"
b.add_view("pairs", [], f"""
    SELECT model, CASE WHEN l_linestatus = 'O' THEN 'v1' ELSE 'v2' END AS dataset_version,
           list_extract({b._ASPECT_LIST}, (l_linenumber - 1) % 6 + 1) AS aspect, {_CODE} AS y, p
    FROM (SELECT *, 'logreg' AS model, CAST(floor(l_quantity) AS BIGINT) % 3 AS p FROM lineitem
          UNION ALL SELECT *, 'random_forest', l_suppkey % 3 FROM lineitem)""")
_KEYS = ", ".join(MODEL_KEYS)
b.add_view("classes", ["pairs"], f"""
    SELECT {_KEYS}, k, count(*) FILTER (WHERE y = k AND p = k) AS tp, count(*) FILTER (WHERE p = k) AS told,
           count(*) FILTER (WHERE y = k) AS support
    FROM pairs, (SELECT unnest([0, 1, 2]) AS k) GROUP BY ALL""")
b.add_view("class_report", ["classes"], f"""
    SELECT {_KEYS}, k, support, told, tp, CASE WHEN told > 0 THEN tp / told ELSE 0 END AS precision,
           CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
           CASE WHEN told + support > 0 THEN 2 * tp / (told + support) ELSE 0 END AS f1 FROM classes""")
b.add_view("metrics", ["class_report"], f"""
    SELECT {_KEYS}, sum(tp) / sum(support) AS accuracy, avg(precision) FILTER (WHERE told + support > 0) AS precision_macro,
           avg(recall) FILTER (WHERE told + support > 0) AS recall_macro, avg(f1) FILTER (WHERE told + support > 0) AS f1_macro
    FROM class_report GROUP BY ALL""")
_ROUND4 = ", ".join(f"round({m}, 6) AS {m}" for m in ("accuracy", "precision_macro", "recall_macro", "f1_macro"))


def metrics(spark, sf_dir):
    return ev.classification_metrics(pairs(spark, sf_dir), MODEL_KEYS)


@query("confusion_matrix", b.sql(["pairs"], f"""
    SELECT {_KEYS}, y, p, count(q.model) AS n FROM (SELECT DISTINCT {_KEYS} FROM pairs)
    CROSS JOIN (SELECT unnest([0, 1, 2]) AS y) CROSS JOIN (SELECT unnest([0, 1, 2]) AS p)
    LEFT JOIN pairs q USING ({_KEYS}, y, p) GROUP BY ALL"""))
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(pairs(spark, sf_dir), MODEL_KEYS)


@query("classification_metrics", b.sql(["metrics"], f"SELECT {_KEYS}, {_ROUND4} FROM metrics"))
def classification_metrics(spark, sf_dir):
    return rounded(metrics(spark, sf_dir), ["accuracy", "precision_macro", "recall_macro", "f1_macro"])


_REPORT_ROWS = f"""
    SELECT {_KEYS}, CASE k WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS part,
           precision, recall, f1, support FROM class_report
    UNION ALL SELECT {_KEYS}, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM class_report GROUP BY {_KEYS}
    UNION ALL SELECT {_KEYS}, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
           sum(f1 * support) / sum(support), sum(support) FROM class_report GROUP BY {_KEYS}"""


@query("classification_report", b.sql(["class_report"], f"""
    SELECT {_KEYS}, part, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           support::BIGINT AS support FROM ({_REPORT_ROWS})"""))
def classification_report(spark, sf_dir):
    return rounded(ev.classification_report(pairs(spark, sf_dir), MODEL_KEYS), ["precision", "recall", "f1"])


b.add_view("avg_f1", ["metrics"], "SELECT model, dataset_version, avg(f1_macro) AS avg_f1 FROM metrics GROUP BY ALL")


@query("avg_f1", b.sql(["avg_f1"], "SELECT model, dataset_version, round(avg_f1, 6) AS avg_f1 FROM avg_f1"))
def avg_f1(spark, sf_dir):
    return rounded(ev.avg_f1(metrics(spark, sf_dir), ["model", "dataset_version"]), ["avg_f1"])


@query("f1_pivot", b.sql(["metrics"], "SELECT aspect, " + ", ".join(
    f"round(avg(f1_macro) FILTER (WHERE model || '_' || dataset_version = '{v}'), 6) AS {v}" for v in VERSIONS)
    + " FROM metrics GROUP BY aspect"))
def f1_pivot(spark, sf_dir):
    return rounded(ev.f1_pivot(metrics(spark, sf_dir), VERSIONS), VERSIONS)


@query("best_model", b.sql(["avg_f1"], """
    SELECT model, dataset_version, round(avg_f1, 6) AS avg_f1 FROM avg_f1
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY avg_f1 DESC, dataset_version) = 1"""))
def best_model(spark, sf_dir):
    runs = ev.avg_f1(metrics(spark, sf_dir), ["model", "dataset_version"])
    return rounded(ev.best_model(runs), ["avg_f1"])


_REASON_1 = "CASE WHEN n >= 250 THEN 'Data volume: ' || n || ' reviews mới >= 250' END"
_REASON_2 = "CASE WHEN f < 0.848 * 0.95 THEN 'Performance drift: F1 ' || format('{:.3f}', f) || ' < threshold 0.806' END"


@query("retrain_trigger", b.sql(["avg_f1", "labeled_heads"], f"""
    SELECT n AS new_reviews, round(f, 6) AS best_f1, concat_ws(chr(10), {_REASON_1}, {_REASON_2}) AS reasons,
           n >= 250 OR f < 0.848 * 0.95 AS triggered
    FROM (SELECT (SELECT count(*) FROM labeled_heads WHERE status = 'O') AS n, (SELECT max(avg_f1) FROM avg_f1) AS f)"""))
def retrain_trigger(spark, sf_dir):
    runs = ev.avg_f1(metrics(spark, sf_dir), ["model", "dataset_version"])
    labeled = b.review_heads(spark, sf_dir).filter("status = 'O'")
    return rounded(ev.retrain_trigger(labeled, runs), ["best_f1"])


@query("pipeline_row_metrics", b.sql(["labeled_reviews"], f"""
    , counts AS (SELECT count(*) AS a, count(*) FILTER (WHERE clean <> '') AS z,
        count(*) FILTER (WHERE clean <> '' AND coalesce({', '.join(ASPECTS)}) IS NOT NULL) AS l
        FROM labeled_reviews JOIN (SELECT text, {sql_clean_review('text')} AS clean FROM (SELECT DISTINCT text FROM documents)) t
          ON t.text = content)
    SELECT a AS rows_input, z AS rows_after_preprocess, l AS rows_labeled, a - z AS rows_dropped, z - l AS rows_failed,
           CASE WHEN z > 0 THEN round_even(l / z * 100, 2) ELSE 0 END AS success_pct, l * 230 AS tokens,
           round_even(l * 150 / 1e6 * 0.075::DOUBLE + l * 80 / 1e6 * 0.3::DOUBLE, 5) AS cost_usd FROM counts"""))
def pipeline_row_metrics(spark, sf_dir):
    raw = b.labeled_reviews(spark, sf_dir)
    processed = ~text.is_blank(text.clean_review_text(F.col("content")))
    return ev.label_and_count(raw, processed, F.size("label") > 0, shared_dir(spark, "labelled"))


@query("serving_metrics", b.sql(["interactions"], """
    SELECT window_start, count(*) AS requests, round(count(*) / 3600, 6) AS rate, round(avg(latency_ms), 6) AS mean_latency,
           round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency,
           round(count(*) FILTER (WHERE failed) * 100 / count(*), 6) AS error_pct
    FROM (SELECT *, date_trunc('hour', ts) AS window_start FROM interactions) GROUP BY ALL"""))
def serving_metrics(spark, sf_dir):
    log = b.interactions(spark, sf_dir)
    return rounded(ev.serving_metrics(log, "1 hour"), ["rate", "mean_latency", "p95_latency", "error_pct"])


@query("serving_metrics_by_month")
def serving_metrics_by_month(spark, sf_dir):
    """From daily sketches: users and percentiles are estimates, whose errors are tested."""
    path = shared_dir(spark, "sketches")
    sketches.store_days(b.interactions(spark, sf_dir).withColumn("latency_ms", F.col("latency_ms").cast("double")), path)
    return rounded(sketches.merge_days(spark, path), ["mean_latency", "error_pct"])


@query("eval_score_means", """
    SELECT round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic, count(*) AS n_samples FROM labels""")
def eval_score_means(spark, sf_dir):
    return rounded(ev.eval_score_means(b.table(spark, sf_dir, "labels"), ["quality", "toxic"]), ["quality", "toxic"])


# --- profiles -------------------------------------------------------------------------
PROFILED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


def _with_gaps(spark, sf_dir):
    """Documents with NULLs and a constant column, as raw details have."""
    docs = b.text_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.when(F.col("lang") != "de", F.col("text")).alias("text"), F.nullif("lang", F.lit("es")).alias("lang"),
        F.lit("web").alias("channel"), F.lit(None).cast("string").alias("short_name"))


b.add_view("gaps", [], """SELECT doc_id, CASE WHEN lang <> 'de' THEN text END AS text, nullif(lang, 'es') AS lang,
    'web' AS channel, NULL::VARCHAR AS short_name FROM documents""")
_GAPS = ["doc_id", "text", "lang", "channel", "short_name"]


@query("null_counts", b.sql(["gaps"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM gaps" for c in _GAPS)))
def null_counts(spark, sf_dir):
    return profiling.null_counts(_with_gaps(spark, sf_dir)).orderBy(F.desc("nulls"))


@query("distinct_counts", b.sql(["gaps"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM gaps" for c in _GAPS)))
def distinct_counts(spark, sf_dir):
    return profiling.distinct_counts(_with_gaps(spark, sf_dir))


@query("constant_columns", b.sql(["gaps"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c})::VARCHAR AS value FROM gaps HAVING count(DISTINCT {c}) = 1" for c in _GAPS)))
def constant_columns(spark, sf_dir):
    return profiling.constant_columns(_with_gaps(spark, sf_dir))


@query("duplicate_rows", """
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS duplicates FROM documents""")
def duplicate_rows(spark, sf_dir):
    return profiling.duplicate_rows(b.text_table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query("table_profile", b.sql(["gaps"], " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null, '{k}' AS kind, "
    f"5::INTEGER AS columns FROM gaps" for i, (c, k) in enumerate(zip(_GAPS, ["bigint"] + ["string"] * 4)))))
def table_profile(spark, sf_dir):
    return profiling.table_profile(_with_gaps(spark, sf_dir))


@query("value_counts", b.sql(["labeled_heads"], " UNION ALL ".join(
    f"SELECT '{a}' AS column_name, coalesce({a}, 'none') AS value, count(*) AS n FROM labeled_heads GROUP BY ALL"
    for a in ASPECTS)))
def value_counts(spark, sf_dir):
    from .score_queries import label_columns

    return profiling.value_counts(label_columns(b.labeled_heads(spark, sf_dir), "none"), ASPECTS)


_WORDS = r"len(list_filter(regexp_split_to_array(text, '[%s]+'), lambda w: w <> ''))"


def _lengths(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


def _words_sql():
    from ..constants import WS

    return f"SELECT doc_id, {_WORDS % WS} AS words FROM documents"


b.add_view("lengths", [], _words_sql())


@query("review_length_histogram", b.sql(["lengths"], """
    , lim AS (SELECT min(words) AS lo, max(words) AS hi FROM lengths),
    binned AS (SELECT least(50, 1 + CAST(floor(50::DOUBLE * (words - lo) / (hi - lo)) AS INTEGER)) AS bin FROM lengths, lim)
    SELECT d.bin, count(x.bin) AS n FROM (SELECT unnest(range(1, 51))::INTEGER AS bin) d LEFT JOIN binned x USING (bin) GROUP BY d.bin"""))
def review_length_histogram(spark, sf_dir):
    return profiling.histogram(_lengths(spark, sf_dir), "words", 50)


@query("review_length_describe", b.sql(["lengths"], """
    SELECT count(*) AS count, round(avg(words), 6) AS mean, round(stddev_samp(words), 6) AS std, min(words)::INTEGER AS min,
           quantile_cont(words, 0.25) AS p25, quantile_cont(words, 0.5) AS p50, quantile_cont(words, 0.75) AS p75,
           max(words)::INTEGER AS max FROM lengths"""))
def review_length_describe(spark, sf_dir):
    return rounded(profiling.describe(_lengths(spark, sf_dir), "words"), ["mean", "std"])
