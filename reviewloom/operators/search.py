"""What searches over a knowledge base share: filters, blocks of queries, best rows, fused ranks.

A batch of queries is scored against points in one pass: Spark splits the
points over tasks, every task multiplies its Arrow batches with the query
matrix and keeps the best few per query, and only those reach the shuffle. The
query side is sent to the tasks in blocks of a fixed number of queries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ASPECTS
from .layout import top_per_key

QUERY_BLOCK = 2048
ROW_BLOCK = 1024
DIGITS = 12


class Condition(NamedTuple):
    """``column`` compared with ``value``: one of the keys of ``COMPARE``."""

    column: str
    is_: str
    value: object


COMPARE = {"in": Column.isin, "at least": Column.__ge__, "at most": Column.__le__}


def liked(preferences: dict[str, float]) -> list[Condition]:
    """Least scores of known aspects as conditions; unknown aspects ask nothing."""
    return [Condition(f"absa_{a}_score", "at least", least) for a, least in preferences.items() if a in ASPECTS]


def passing(conditions: Iterable[Condition]) -> Column:
    """Rows that meet all conditions; a NULL value meets none."""
    return reduce(lambda keep, c: keep & COMPARE[c.is_](F.col(c.column), c.value), conditions, F.lit(True))


def with_aspect_scores(points: DataFrame, scores: DataFrame) -> DataFrame:
    """Points with the aspect scores of their product."""
    columns = [F.col(f"{a}_score").alias(f"absa_{a}_score") for a in ASPECTS]
    return points.join(scores.select("product_id", *columns), "product_id", "left")


def aspect_boost(preferences: Iterable[str]) -> Column:
    """Mean of the preferred aspect scores; NULL and unknown aspects count 0."""
    wanted = list(preferences)
    known = [F.coalesce(F.col(f"absa_{a}_score"), F.lit(0.0)) for a in wanted if a in ASPECTS]
    return reduce(Column.__add__, known, F.lit(0.0)) / max(len(wanted), 1)


def with_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows that can be ranked: the vector is there and all of it is a finite number. Points not encoded
    yet, and broken ones, are left out; all others are ranked."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter((F.size(vector) > 0) & sound)


# --- blocks of queries ----------------------------------------------------------
def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> Iterator[list]:
    """The query rows in lists of about ``size``: one look-up of the count, then
    one bounded list at a time, so the driver holds a single block."""
    blocks = -(-queries.count() // size)
    for i in range(blocks):
        mine = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i)
        rows = mine.collect()
        if rows:
            yield rows


def best(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int, floor: float = -np.inf):
    """The best ``k`` rows of each column. Scores are rounded first, so that
    equal points tie whatever their place in a batch; rows that tie with the
    k-th score are kept, the ranking by id decides later."""
    scores = np.round(scores, DIGITS)
    n = scores.shape[0]
    if n > k:
        kth = np.partition(scores, n - k, axis=0)[n - k]
        row, col = np.nonzero((scores >= kth) & (scores > floor))
    else:
        row, col = np.nonzero(scores > floor)
    return query_ids[col], ids[row], scores[row, col]


def _batch(parts):
    q, i, s = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], ["query_id", "id", "score"])


def keep_best(parts, k):
    """Task-wide best ``k`` per query out of the batch-wise lists (ties kept)."""
    q, i, s = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    start = np.r_[0, np.flatnonzero(np.diff(q)) + 1]
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    keep = rank < k
    return q[keep], i[keep], s[keep]


def scored(points: DataFrame, score_batch, k: int) -> DataFrame:
    """Runs ``score_batch(record batch) -> lists of (query, id, score)`` in every
    task and passes on the best ``k`` per query and task."""
    def run(batches):
        kept = None
        for batch in batches:
            found = [p for p in score_batch(batch) if len(p[0])]
            if found:
                kept = keep_best(found if kept is None else [kept, *found], k)
        if kept is not None:
            yield _batch([kept])

    return points.mapInArrow(run, "query_id long, id long, score double")


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


# --- fused search ------------------------------------------------------------------
def hybrid_topk(dense: DataFrame, lexical: DataFrame, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists per query."""
    a = dense.select("query_id", "id", F.col("rank").alias("dense_rank"))
    z = lexical.select("query_id", "id", F.col("rank").alias("lexical_rank"))
    share = lambda c: F.coalesce(F.lit(1.0) / (F.col(c) + constant), F.lit(0.0))
    fused = a.join(z, ["query_id", "id"], "full").withColumn("score", share("dense_rank") + share("lexical_rank"))
    return top_per_key(fused, ["query_id"], [F.desc(F.round("score", 12)), F.asc("id")], k)


def retrieval_smoke(hits: DataFrame, queries: DataFrame, least: int) -> DataFrame:
    """Hits per query and whether there are enough."""
    counts = hits.groupBy("query_id").agg(F.count("*").alias("hits"))
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("hits", F.lit(0)).alias("hits"),
        (F.coalesce("hits", F.lit(0)) >= least).alias("passed"))
