"""Stored vectors: 8-bit codes for exact search, cells for approximate search.

Both are made from (id, embedding, ...) once and searched many times. Points whose vector is missing, not
finite or of another length than most are left out; zero vectors have the cosine 0 with everything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from ..constants import RERANK_WEIGHT
from ..session import materialize
from .layout import top_per_key
from .merge import concat_parts
from .search import DIGITS, ROW_BLOCK, Condition, aspect_boost, best, liked, passing, query_blocks, scored, units, with_vectors

#: Rows of a part of the full vectors; a search reads the parts that hold what it ranks.
PART_ROWS = 100_000
#: Rows sent to every task to find their vectors; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: What rounding in products of codes may add to the error of a code.
SLACK = 1e-9
#: Vectors that cells are fitted on, cells at most, and points of one file of a cell.
SAMPLE_ROWS, MOST_CELLS, FILE_ROWS = 1 << 16, 1 << 13, 250_000
#: Points that ask for their nearest others when an index is built, and the share of these that must be found.
ASKING, ASKED_FOR, RECALL = 256, 10, 0.94


def dimension(points: DataFrame) -> int:
    """The length that most vectors have, of equally frequent ones the largest; 0 without vectors."""
    sizes = points.select(F.size("embedding").alias("d")).filter("d > 0").groupBy("d").agg(F.count("*").alias("n"))
    return sizes.agg(F.max(F.struct("n", "d"))["d"]).first()[0] or 0


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


# --- codes: exact search ---------------------------------------------------------------
def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, scale, error) of unit vectors: ``scale * code`` is at most ``error`` away from the vector, so the
    product of either with a unit vector differs by at most ``error``."""
    scale = np.abs(vectors).max(axis=1, initial=0) / 127
    code = np.rint(np.divide(vectors, scale[:, None], out=np.zeros_like(vectors), where=scale[:, None] > 0)).astype(np.int8)
    apart = vectors - code * scale[:, None]
    return code, scale, np.sqrt((apart * apart).sum(axis=1)) + SLACK


@F.arrow_udf(StructType([StructField("code", BinaryType()), StructField("scale", DoubleType()), StructField("error", DoubleType())]))
def _coded(embedding: pa.Array) -> pa.Array:
    width = len(embedding[0]) if len(embedding) else 0
    code, scale, error = codes(units(rows_of(embedding, width)))
    return pa.StructArray.from_arrays([pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), pa.array(error)],
                                      ["code", "scale", "error"])


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")


def store_vectors(points: DataFrame, path: str) -> str:
    """Writes ``points`` (id, embedding, ...) as a table of codes, with all other columns, which a search reads as a
    whole, and a table of full vectors in parts by id, of which it reads what is left to be ranked."""
    dim = dimension(points)
    kept = with_vectors(points).filter(F.size("embedding") == dim)
    coded = kept.withColumn("_c", _coded("embedding")).select(
        *[c for c in points.columns if c != "embedding"], "_c.code", "_c.scale", "_c.error", F.lit(dim).alias("dim"))
    coded.write.parquet(f"{path}/codes")
    spark = points.sparkSession
    parts = max(1, -(-spark.read.parquet(f"{path}/codes").count() // PART_ROWS))
    kept.select("id", "embedding", _part(parts).alias("part")).repartition("part").write.partitionBy("part").parquet(f"{path}/vectors")
    return path


def _reaching(queries: np.ndarray, query_ids: np.ndarray, k: int):
    """Batches of codes to (query, id, lower, upper) of all points that could be among the best ``k`` as far as one
    task can tell: their upper bound reaches the task's k-th lower bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.full((k, len(queries)), -np.inf)  # the best lower bounds so far
        found: list[tuple] = []

        def pruned() -> tuple:
            q, i, low, high = (np.concatenate(x) for x in zip(*found))
            keep = high >= held[0][q]
            return q[keep], i[keep], low[keep], high[keep]

        rows = 0
        for batch in batches:
            ids, n = batch.column(0).to_numpy(zero_copy_only=False), batch.num_rows
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int8).reshape(n, queries.shape[1])
            scale, error = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            for at in range(0, n, ROW_BLOCK):
                part = slice(at, at + ROW_BLOCK)
                score = (code[part].astype(np.float64) @ queries.T) * scale[part, None]
                low, high = score - error[part, None], score + error[part, None]
                held = np.partition(np.vstack([held, low]), -k, axis=0)[-k:]
                held = held[np.argsort(held, axis=0), np.arange(len(queries))]
                row, q = np.nonzero(high >= held[0])
                found.append((q, ids[part][row], low[row, q], high[row, q]))
                rows += len(q)
                if rows > 1 << 20:
                    found = [pruned()]
                    rows = len(found[0][0])
        if found:
            q, i, low, high = pruned()
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[q]), pa.array(i), pa.array(low), pa.array(high)], ["query_id", "id", "low", "high"])

    return run


def _ranked(queries: np.ndarray, query_ids: np.ndarray):
    """(query_id, id, embedding) to the cosine of both."""
    place = {int(q): i for i, q in enumerate(query_ids)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array([place[q] for q in batch.column(0).to_pylist()], np.int64)
            vectors = units(rows_of(batch.column(2), queries.shape[1]))
            score = np.round((vectors * queries[at]).sum(axis=1), DIGITS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["query_id", "id", "score"])

    return run


def vector_knn(spark: SparkSession, path: str, queries: DataFrame, k: int, keep: Column | None = None) -> DataFrame:
    """Exact ``k`` nearest stored points of each query (query_id, embedding) with score and rank, of the points
    that pass ``keep``.

    One scan of the codes, a byte a dimension, gives every point a score with a bound of its error. A point
    can be among the best ``k`` only if its upper bound reaches the k-th lower bound; tasks apply that to what
    they see, the rest is dropped once all have been. The full vectors of the few that remain are looked up and
    ranked. Queries without a sound vector of the stored length find nothing.
    """
    table = spark.read.parquet(f"{path}/codes")
    first = table.select("dim").first()
    empty = spark.createDataFrame([], "query_id long, id long, score double, rank int")
    if first is None:
        return empty
    kept = table if keep is None else table.filter(keep)
    vectors, parts = spark.read.parquet(f"{path}/vectors"), []
    n_parts = max(1, -(-table.count() // PART_ROWS))
    for rows in query_blocks(with_vectors(queries.select("query_id", "embedding")).filter(F.size("embedding") == first.dim)):
        matrix = units(np.array([r.embedding for r in rows], np.float64))
        query_ids = np.array([r.query_id for r in rows], np.int64)
        maybe = materialize(kept.select("id", "code", "scale", "error").mapInArrow(
            _reaching(matrix, query_ids, k), "query_id long, id long, low double, high double"), "maybe")
        least = top_per_key(maybe, ["query_id"], [F.desc("low")], k).groupBy("query_id").agg(
            F.when(F.count("*") == k, F.min("low")).alias("least"))
        left = materialize(maybe.join(F.broadcast(least), "query_id").filter("least IS NULL OR high >= least").select(
            "query_id", "id", _part(n_parts).alias("part")), "left")
        side = F.broadcast(left) if left.count() <= BROADCAST_ROWS else left
        parts.append(vectors.join(side, ["part", "id"]).select("query_id", "id", "embedding").mapInArrow(
            _ranked(matrix, query_ids), "query_id long, id long, score double"))
    if not parts:
        return empty
    return top_per_key(concat_parts(parts), ["query_id"], [F.desc("score"), F.asc("id")], k)


def vector_topk(spark: SparkSession, path: str, queries: DataFrame, top_k: int, conditions: Iterable[Condition] = (),
                preferences: dict[str, float] | None = None, weight: float = RERANK_WEIGHT) -> DataFrame:
    """Filtered cosine search: 2 * top_k by similarity, re-ranked by the mean of
    the preferred aspect scores, best ``top_k`` kept.

    The filter runs before any scoring; the figures of a product are looked up
    again only for the 2 * top_k survivors of each query.
    """
    preferences = preferences or {}
    keep = passing([*conditions, *liked(preferences)])
    near = vector_knn(spark, path, queries, 2 * top_k, keep).withColumnsRenamed({"score": "cosine", "rank": "dense_rank"})
    payload = spark.read.parquet(f"{path}/codes").drop("code", "scale", "error", "dim").withColumn("boost", aspect_boost(preferences))
    rescored = near.join(payload, "id").withColumn("score", F.col("cosine") + F.lit(weight) * F.col("boost"))
    return top_per_key(rescored, ["query_id"], [F.desc(F.round("score", 12)), F.asc("dense_rank")], top_k)


# --- cells: approximate search -----------------------------------------------------------
@dataclass(frozen=True)
class Cells:
    """A stored index: where it is, the centres, how many points each cell holds, and the cells that a query reads."""

    path: str
    centres: np.ndarray
    sizes: np.ndarray
    probes: int

    def nearest(self, queries: np.ndarray, probes: int | None = None) -> np.ndarray:
        """The cells that each query reads."""
        return np.argsort(-(queries @ self.centres.T), axis=1, kind="stable")[:, :probes or self.probes]

    def share_read(self, queries: np.ndarray, probes: int | None = None) -> float:
        """The mean share of all points that a query is compared with."""
        return float(self.sizes[self.nearest(units(queries), probes)].sum(axis=1).mean() / max(1, self.sizes.sum()))


def fitting_sample(points: DataFrame, label: str | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` of ``points``, by a hash of their id: where ``label`` names a column, one of each label
    first, then a second one of each, and so on, so that every label is there if there are at most ``rows``."""
    order = F.xxhash64("id")
    if label is None:
        return points.orderBy(order, "id").limit(rows)
    return top_per_key(points, [label], [order, F.col("id")], rows, "_place").orderBy("_place", order, "id").limit(rows).drop("_place")


def build_cells(points: DataFrame, path: str, label: str | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
    """Stores ``points`` (id, embedding) by the nearest of about sqrt(n) centres, at most ``MOST_CELLS``.

    The centres are those of a k-means over a bounded sample (:func:`fitting_sample`); every point is placed
    and stored. Cells that no point is nearest to have no files; a large cell is written by several tasks. The
    number of cells that a query reads is measured: ``ASKING`` points of the sample are compared with all points,
    and as many cells are read as hold ``RECALL`` of their ``ASKED_FOR`` nearest ones.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark, dim = points.sparkSession, dimension(points)
    kept = with_vectors(points).filter(F.size("embedding") == dim).withColumn("embedding", F.col("embedding").cast("array<double>"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    sample = materialize(fitting_sample(kept.filter(norm > 0), label, sample_rows).select(
        "id", array_to_vector("embedding").alias("features")), "sample")
    k = int(min(MOST_CELLS, max(1, round(kept.count() ** 0.5)), max(1, sample.count())))
    if k > 1:
        found = KMeans(k=k, seed=1, maxIter=10, distanceMeasure="cosine").fit(sample.coalesce(1) if k < 1000 else sample)
        centres = units(np.array(found.clusterCenters()))
    else:
        centres = np.ones((1, max(1, dim)))
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>").write.parquet(f"{path}/centres")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (units(rows_of(batch.column(1), dim)) @ centres.T).argmax(axis=1) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], ["id", "embedding", "cell"])

    placed = materialize(kept.select("id", "embedding").mapInArrow(place, "id long, embedding array<double>, cell int"), "placed")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    sizes.coalesce(1).write.parquet(f"{path}/sizes")
    files = F.ceil(F.col("n") / FILE_ROWS).cast("int")
    placed.join(F.broadcast(spark.read.parquet(f"{path}/sizes")), "cell").withColumn("file", F.pmod(F.xxhash64("id"), files)).repartition(
        "cell", "file").select("id", "embedding", "cell").write.partitionBy("cell").parquet(f"{path}/points")
    probes = _probes(Cells(path, centres, np.zeros(0), 0), placed, sample)
    spark.createDataFrame([(probes,)], "probes int").write.parquet(f"{path}/probes")


def _probes(index: Cells, placed: DataFrame, asking: DataFrame) -> int:
    """How many of its nearest cells a query must read, from an exact search for the points of ``asking`` (id, features)."""
    rows = asking.orderBy(F.xxhash64("id", F.lit("ask")), "id").limit(ASKING).collect()
    if not rows or len(index.centres) < 2:
        return 1
    matrix, query_ids = units(np.array([r.features.toArray() for r in rows])), np.arange(len(rows))

    def score(batch: pa.RecordBatch):
        ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), units(rows_of(batch.column(1), matrix.shape[1]))
        for at in range(0, len(ids), ROW_BLOCK):
            yield best(vectors[at:at + ROW_BLOCK] @ matrix.T, ids[at:at + ROW_BLOCK], query_ids, ASKED_FOR + 1)

    near = top_per_key(scored(placed.select("id", "embedding"), score, ASKED_FOR + 1), ["query_id"], [F.desc("score"), F.asc("id")],
                       ASKED_FOR + 1).filter("rank > 1")  # the first is the point itself, or its copy
    found = placed.select("id", "cell").join(F.broadcast(materialize(near.select("query_id", "id"), "near")), "id").select("query_id", "cell").collect()
    order = index.nearest(matrix, len(index.centres))
    place = np.argsort(order, axis=1)
    depth = np.sort([place[r.query_id, r.cell] for r in found])
    return int(depth[min(len(depth) - 1, int(np.ceil(RECALL * len(depth))))]) + 1 if len(depth) else 1


def open_cells(spark: SparkSession, path: str) -> Cells:
    """The index below ``path``: at most ``MOST_CELLS`` centres and sizes."""
    centres = np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])
    sizes = np.zeros(len(centres), np.int64)
    for r in spark.read.parquet(f"{path}/sizes").collect():
        sizes[r.cell] = r.n
    return Cells(path, centres, sizes, spark.read.parquet(f"{path}/probes").first().probes)


def vector_cells_topk(spark: SparkSession, index: Cells, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
    """Approximate ``k`` nearest points of each query: the points of its nearest cells, ranked by the full vectors.
    Only the folders of those cells are read; each cell is compared with the queries that ask it."""
    parts = []
    for rows in query_blocks(with_vectors(queries.select("query_id", "embedding")).filter(F.size("embedding") == index.centres.shape[1])):
        matrix = units(np.array([r.embedding for r in rows], np.float64))
        query_ids = np.array([r.query_id for r in rows], np.int64)
        near = index.nearest(matrix, probes)
        asked = {int(c): np.flatnonzero((near == c).any(axis=1)) for c in np.unique(near) if index.sizes[c]}
        if not asked:
            continue

        def score(batch, matrix=matrix, query_ids=query_ids, asked=asked):
            cells, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 0))
            vectors = units(rows_of(batch.column(1), matrix.shape[1]))
            for cell in np.unique(cells):
                mine = np.flatnonzero(cells == cell)
                for at in range(0, len(mine), ROW_BLOCK):
                    part, who = mine[at:at + ROW_BLOCK], asked[int(cell)]
                    yield best(vectors[part] @ matrix[who].T, ids[part], query_ids[who], k)

        points = spark.read.parquet(f"{index.path}/points").filter(F.col("cell").isin(list(asked)))
        parts.append(scored(points.select("id", "embedding", "cell"), score, k))
    found = concat_parts(parts) if parts else spark.createDataFrame([], "query_id long, id long, score double")
    return top_per_key(found, ["query_id"], [F.desc("score"), F.asc("id")], k)
