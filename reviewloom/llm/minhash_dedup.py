"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, exact confirmation.

A signature has ``CHUNKS * SYMBOLS`` symbols of 16 bits: the low bits of that many minima over the
document's shingle set. Two signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` symbols
agree in some chunk up to one symbol (pigeonhole), so all pairs under that distance share a key when
every chunk is entered once for each place where the error may be. At similarity 0.75 a chunk
matches with probability 0.74; a pair stays unseen with probability 2e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewloom.session import materialize
from .components import components
from .groups import by_group
from .words import constants, shingle_sets

CHUNKS, SYMBOLS, ERRORS = 8, 4, 1
SIGNATURE = CHUNKS * SYMBOLS
#: Signatures further apart are not confirmed: at similarity 0.75 that happens once in a million pairs.
MOST_DIFFERENT = 20
#: 100 * intersection >= PERCENT * union.
PERCENT = 75
SHINGLE = 5
#: Classes of a bucket that one task compares by signature; those of a larger bucket become one cluster.
BUCKET = 4096
SMALL_BUCKET = 64
#: Sets, and shingles in them, that one task compares with each other or with as many others.
BLOCK_SETS, BLOCK_SHINGLES = 4096, 4_000_000
#: Sets of a cluster that every block of it gets, so that its linked parts are known as one early.
ANCHORS = 8
COLUMNS, ROWS_AT_ONCE = 2048, 256


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signatures(size: int):
    factors, shifts = constants(101, SIGNATURE), constants(202, SIGNATURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes, signs = [], [], []
            for found in shingle_sets(batch.column(1), size):
                counts.append(len(found))
                nodes.append(_node(found) if len(found) else None)
                least = np.full(SIGNATURE, np.iinfo(np.uint64).max)
                for part in range(0, len(found), 4096):
                    hashed = (found[None, part:part + 4096] ^ shifts[:, None]) * factors[:, None]
                    least = np.minimum(least, hashed.min(axis=1))
                signs.append(least.astype(np.uint16).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(signs, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "node", "signature"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in shingle_sets(batch.column(0), size):  # a row a batch: sets of long texts stay small batches
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_node(found)], pa.int64()), pa.array([found.view(np.int64)], pa.list_(pa.int64()))],
                        ["node", "shingles"])

    return run


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, signature): ``node`` is a 64-bit hash of the shingle set, so copies
    share it; it and the signature are null for an empty set."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash")).mapInArrow(
        _signatures(size), "doc_id long, text_hash long, n_shingles long, node long, signature array<long>")


def _signed(x: int) -> int:
    return (x + 2**63) % 2**64 - 2**63


def chunk_keys(signature: str = "signature") -> list:
    """One key for every chunk (a long of four symbols) and every place in it where two may differ."""
    return [
        F.xxhash64(F.lit(c * SYMBOLS + i), F.col(signature)[c].bitwiseAND(F.lit(_signed(~(0xFFFF << 16 * i)))))
        for c in range(CHUNKS) for i in range(SYMBOLS)]


def _close(percent: int):
    """Sorted buckets to edges (a, b) that join what could be similar: sizes and signatures are near. Only a
    spanning forest of each bucket comes out."""

    def flush(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        node, size = rows["node"].combine_chunks().to_numpy(), rows["n_shingles"].combine_chunks().to_numpy()
        signs = rows["signature"].combine_chunks().flatten().to_numpy().reshape(len(rows), CHUNKS).view(np.uint16)
        ends = np.append(starts[1:], len(rows))

        def near(i, j):
            fits = 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            return fits & ((signs[i] != signs[j]).sum(axis=-1) <= MOST_DIFFERENT)

        left, right = [], []
        first, stop = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)
        small = np.flatnonzero(stop - first <= SMALL_BUCKET)
        after = stop[small] - small - 1
        for part in np.array_split(np.arange(len(small)), max(1, int(after.sum()) >> 17)):
            i = np.repeat(small[part], after[part])
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after[part]) - after[part], after[part])
            fits = near(i, j)
            left.append(i[fits])
            right.append(j[fits])
        for start, end in zip(starts, ends):
            if end - start > SMALL_BUCKET:  # walk from row to row, each compared with those not reached yet
                rest = np.arange(start, end)
                while len(rest):
                    queue, rest = [rest[0]], rest[1:]
                    while queue and len(rest):
                        i = queue.pop()
                        fits = near(i, rest)
                        right.append(rest[fits])
                        left.append(np.full(len(right[-1]), i))
                        queue.extend(rest[fits])
                        rest = rest[~fits]
        i, j = np.concatenate(left).astype(np.int64), np.concatenate(right).astype(np.int64)
        pairs = np.unique(node[_forest(i, j, len(rows))], axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return lambda batches: by_group(batches, ["key"], flush)


def _shared(sets: list[np.ndarray], mine: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, sizes) for a few of the rows ``mine`` at a time: the sizes of their intersections with every set,
    by products of 0/1 blocks over the shingles that several sets hold."""
    flat = np.concatenate(sets)
    _, coded, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = (times > 1)[coded]
    coded = (np.cumsum(times > 1) - 1)[coded][often]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[often]
    order = np.argsort(coded, kind="stable")
    coded, rows = coded[order], rows[order]
    total = np.zeros((len(mine), len(sets)), np.float32)
    for low in range(0, int(coded[-1]) + 1 if len(coded) else 0, COLUMNS):
        part = slice(*np.searchsorted(coded, [low, low + COLUMNS]))
        ones = np.zeros((len(sets), COLUMNS), np.float32)
        ones[rows[part], coded[part] - low] = 1
        total += ones[mine] @ ones.T
    for at in range(0, len(mine), ROWS_AT_ONCE):
        yield mine[at:at + ROWS_AT_ONCE], total[at:at + ROWS_AT_ONCE]


def _confirmed(percent: int):
    """Sorted groups of sets to the links found in each: rows with ``open`` against all others that have
    another root. Only a spanning forest of a group's links comes out."""

    def flush(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        node, root = rows["node"].combine_chunks().to_numpy(), rows["root"].combine_chunks().to_numpy()
        opened = rows["open"].combine_chunks().to_numpy(zero_copy_only=False)
        lists = rows["shingles"].combine_chunks()
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
        found = []
        for start, end in zip(starts, np.append(starts[1:], len(rows))):
            n, size, names, roots = end - start, np.diff(at[start:end + 1]), node[start:end], root[start:end]
            mine = np.flatnonzero(opened[start:end])
            if not len(mine) or n < 2:
                continue
            sets = [flat[at[i]:at[i + 1]] for i in range(start, end)]
            if n == 2:  # the usual case: one pair
                parts = [(mine, np.full((len(mine), 2), len(np.intersect1d(*sets, assume_unique=True))))]
            else:
                parts = _shared(sets, mine)
            left, right = [], []
            for some, shared in parts:
                linked = 100 * shared >= percent * (size[some][:, None] + size - shared)
                linked &= (roots[some][:, None] != roots) & (names[some][:, None] != names)
                i, j = np.nonzero(linked)
                left.append(some[i])
                right.append(j)
            found.append(_forest(np.concatenate(left), np.concatenate(right), n) + start)
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], ["a", "b"])

    return lambda batches: by_group(batches, ["cluster", "x", "y"], flush)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """(row, smallest row it reaches) for every row of links i-j that reaches a smaller one."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, i, least[j])
        np.minimum.at(least, j, least[i])
        least = least[least]
        if (least == before).all():
            moved = np.flatnonzero(least != np.arange(n))
            return np.stack([moved, least[moved]], axis=1)


def _edges(index: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges whose components hold every pair that shares a key and could be similar."""
    hot = index.filter(F.col("n") > BUCKET).select(F.col("node").alias("a"), F.col("m").alias("b"))
    cold = index.filter(F.col("n") <= BUCKET).select("key", "node").join(
        classes.select("node", "n_shingles", "signature"), "node")
    return cold.repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        _close(percent), "a long, b long").unionByName(hot)


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(rows / BLOCK_SETS, shingles / BLOCK_SHINGLES)).cast("int")


def _spread(of: str, by: int) -> Column:
    """A block number below column ``of`` from the node."""
    return F.pmod(F.xxhash64("node", F.lit(by)), F.col(of)).cast("int")


def _confirm(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    return groups.join(sets, "node").repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y").mapInArrow(
        _confirmed(percent), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Copies become one class first. Classes that share a key and are near by size and signature fall into one
    cluster (a bucket of more than ``BUCKET`` classes falls into one as a whole), so every candidate pair
    lies within a cluster. The full sets of a cluster are sent to tasks in blocks and compared there: first
    each block with itself and a few anchors of the cluster, then what is not linked to the cluster's
    largest part with every block. So each set travels once unless its cluster is large, a large group that
    is linked costs in proportion to its size, and only spanning edges, never pairs, are written.

    Defined cases: null, empty or white-space texts have an empty set and link with nothing; rows that
    repeat an id or a text are rows of the result each; a null doc_id takes part and is never the
    smallest unless its whole component has none; ``kept`` compares null-safely. An empty table gives
    an empty result. Other columns of ``docs`` are not read.
    """
    return _grouped(docs, size, percent).select(
        "doc_id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node, component_id and root, the component's node, for every row of ``docs``;
    the last three are null for an empty set."""
    signed = materialize(signatures(docs, size), "signatures")
    classes = materialize(
        signed.filter("node is not null").groupBy("node", "n_shingles", "signature").agg(F.min("doc_id").alias("doc_id")),
        "classes")
    keyed = classes.select(F.explode(F.array(*chunk_keys())).alias("key"), "node")
    several = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("m")).filter("n > 1")
    index = materialize(keyed.join(several, "key"), "index")  # only keys that several classes share
    near = components(_edges(index, classes, percent)).withColumnRenamed("root", "cluster")
    members = near.join(classes.select("node", "n_shingles", "doc_id"), "node")
    total = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles"))
    members = materialize(
        members.join(total.select("cluster", _blocks(F.col("rows"), F.col("shingles")).alias("blocks")), "cluster"), "members")
    sets = materialize(_full_sets(members, docs, size), "shingles")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    group = lambda x, y, opened, root: ["node", "cluster", x, y, opened.alias("open"), root.alias("root")]
    zero, itself = F.lit(0).alias("y"), F.col("node")
    own = members.select(*group(_spread("blocks", 0).alias("x"), zero, F.lit(True), itself))
    first = F.row_number().over(Window.partitionBy("cluster").orderBy("node"))
    anchors = members.filter("blocks > 1").withColumn("r", first).filter(F.col("r") <= ANCHORS).withColumn("x", every("blocks"))
    anchors = anchors.filter(F.col("x") != _spread("blocks", 0)).select(*group("x", zero, F.lit(False), itself))
    links = materialize(_confirm(own.unionByName(anchors), sets, percent), "links")
    roots = materialize(components(links), "roots")

    if not members.filter("blocks > 1").isEmpty():  # else every pair of a cluster has met
        large = members.filter("blocks > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = large.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
        main = parts.groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
        rest = parts.join(main, "cluster").filter("root != main").groupBy("cluster").agg(
            _blocks(F.sum("n"), F.sum("s")).alias("opens"))
        large = materialize(large.join(main, "cluster").join(rest, "cluster"), "large")
        opened = large.filter("root != main").withColumn("y", every("blocks")).select(
            *group(_spread("opens", 1).alias("x"), "y", F.lit(True), F.col("root")))
        against = large.withColumn("x", every("opens")).select(
            *group("x", _spread("blocks", 0).alias("y"), F.lit(False), F.col("root")))
        links = links.unionByName(_confirm(opened.unionByName(against), sets, percent))
        roots = materialize(components(links), "roots")

    placed = classes.select("node", "doc_id").join(roots, "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root"))
    named = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(named, "root").select("node", "component_id", "root")
    return signed.drop("signature").join(named, "node", "left")


def _full_sets(members: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of every member, from the text of its first document."""
    lowest = F.lit(-(2**63)).cast("long")
    first = members.select(F.coalesce("doc_id", lowest).alias("_id")).distinct()
    found = (
        docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("_id"), F.col("text").cast("string"))
        .join(first, "_id", "left_semi").select("text").mapInArrow(_sets(size), "node long, shingles array<long>"))
    return found.dropDuplicates(["node"])


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that repeat another: one row of each group, with all columns.

    Of a group the row with the smallest doc_id stays, and of its texts the one with the smallest hash; a null
    doc_id comes last. Rows with an empty set are in no group: they stay once for every doc_id and text.
    """
    rows = materialize(_grouped(docs, size, percent), "grouped")
    first = rows.filter("root is not null").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")).select("first.doc_id", "first.text_hash")
    alone = rows.filter("root is null").select("doc_id", "text_hash").distinct()
    kept = first.unionByName(alone).select(F.col("doc_id").alias("_near_kept"), F.col("text_hash").alias("_near_text"))
    ided = docs.withColumn("_near_id", F.col("doc_id").cast("long")).withColumn("_near_hash", F.xxhash64(F.col("text").cast("string")))
    return (
        ided.join(kept, F.col("_near_id").eqNullSafe(F.col("_near_kept")) & (F.col("_near_hash") == F.col("_near_text")), "left_semi")
        .withColumn("_near_rank", F.row_number().over(Window.partitionBy("_near_id", "_near_hash").orderBy("text")))
        .filter("_near_rank = 1").drop("_near_id", "_near_hash", "_near_rank"))
