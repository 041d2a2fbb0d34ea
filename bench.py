"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from reviewloom.plans import QUERIES
from reviewloom.session import build_session

HEADLINE = [
    "aspect_scores", "aspect_scores_wide", "best_and_worst_products", "aspect_satisfaction",
    "aspect_sentiment_distribution", "clean_review_text", "parse_label", "normalize_label", "new_reviews_anti",
    "dedup_keep_first", "merge_labeled_reviews", "checkpoint_resume_join", "review_count_change", "top_reviews",
    "doc_product_card", "doc_aspect_summary", "doc_reviews", "kb_full_rebuild", "kb_replace_products", "product_report", "vector_topk",
    "lexical_topk", "hybrid_topk", "rag_context", "classification_report", "serving_metrics",
    "review_length_describe", "vocab_index", "tfidf_features", "history_window_asof", "flatten_reviews",
    "stream_aspect_scores", "batch_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", cpus, spark__sql__shuffle__partitions=cpus, spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="reviewloom-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
