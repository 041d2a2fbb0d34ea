"""Request figures of long spans from small daily sketches, beside the exact ones.

A day is one row: counts, a HyperLogLog sketch of the users and a KLL sketch of the latencies, a few kilobytes
whatever the day's traffic. Spans of days are merged from these rows; the log is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: log2 of the buckets of a distinct count: its standard error is 1.04 / sqrt(4096), 1.6 %.
USER_BITS = 12
#: Size of a quantile sketch: the rank of a quantile is wrong by less than 1.7 % with a probability of 0.99.
LATENCY_SIZE = 200
SHARES = (0.5, 0.95, 0.99)
DAY = "requests long, errors long, latency_sum double, users binary, latencies binary, day date"


def store_days(log: DataFrame, path: str) -> None:
    """Writes a row of sketches for every day in ``log`` (ts, user_id, latency_ms, failed); a day that is there
    already is replaced. Partial sketches are merged before the shuffle, so a busy day is a row per task. Null
    users and latencies are not counted in their sketches; rows without a time are left out."""
    days = log.filter("ts IS NOT NULL").groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("requests"), F.count_if("failed").alias("errors"), F.sum("latency_ms").alias("latency_sum"),
        F.hll_sketch_agg("user_id", F.lit(USER_BITS)).alias("users"),
        F.kll_sketch_agg_double("latency_ms", F.lit(LATENCY_SIZE)).alias("latencies"))
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def merge_days(spark: SparkSession, path: str, unit: str = "month") -> DataFrame:
    """span, days, requests, users, mean_latency, p50_latency, p95_latency, p99_latency, error_pct of every ``unit``
    (week, month, quarter, year) of the stored days. Users are distinct over the whole span, not summed; they and
    the percentiles are estimates. A span without a latency has null percentiles."""
    days = spark.read.schema(DAY).parquet(path)
    spans = days.groupBy(F.date_trunc(unit, "day").cast("date").alias("span")).agg(
        F.count("*").alias("days"), F.sum("requests").alias("requests"), F.sum("errors").alias("errors"),
        F.sum("latency_sum").alias("latency_sum"), F.hll_union_agg("users").alias("users"),
        F.kll_merge_agg_double("latencies").alias("latencies"))
    n = F.kll_sketch_get_n_double("latencies")
    quantiles = [F.when(n > 0, F.kll_sketch_get_quantile_double("latencies", F.lit(s))).alias(f"p{round(100 * s)}_latency") for s in SHARES]
    return spans.select(
        "span", "days", "requests", F.hll_sketch_estimate("users").alias("users"),
        F.try_divide("latency_sum", n).alias("mean_latency"), *quantiles, (F.col("errors") * 100 / F.col("requests")).alias("error_pct"))
