"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, several probes, exact check."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.session import materialize
from .components import components
from .groups import by_group
from .words import constants, mix

COSINE = 0.98
#: Buckets of each table that a vector looks into, its own included.
PROBES = 4
#: Tables by the number of hash functions a bucket combines: at cosine 0.98 a pair in 64 dimensions meets in a
#: table with probability 0.93, 0.83, 0.70 and 0.6 (simulated), so that at most one in 10^5 is not seen.
TABLES = {2: 5, 3: 7, 4: 10, 5: 13}
#: Coordinates of each rotation that probes choose from.
CHOICES = 4
#: Rows of a bucket that are compared by one task with each other, or with as many others.
BLOCK = 2048
PAIRS_AT_ONCE = 1 << 16


def functions_for(vectors: int, dimension: int) -> int:
    """As many hash functions as give about one bucket per vector, 2 to 5."""
    sides = 2 * _padded(dimension)
    return min(max(TABLES), max(2, math.ceil(math.log(max(vectors, 2)) / math.log(sides))))


def _padded(dimension: int) -> int:
    return 1 << max(1, (dimension - 1).bit_length())


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, length preserved."""
    rows, n = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(rows, n // (2 * half), 2, half)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(rows, n)
        half *= 2
    return x / math.sqrt(n)


def _rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform."""
    signs = np.random.default_rng(seed)
    for _ in range(3):
        x = _hadamard(x * signs.choice([-1.0, 1.0], x.shape[1]))
    return x


def bucket_keys(vectors: np.ndarray, functions: int, tables: int, probes: int) -> np.ndarray:
    """(rows, tables, probes) of 64-bit bucket keys, the vector's own bucket first, then the next likely ones.

    The bucket of one function is the largest coordinate of the rotated vector with its sign: the nearest
    vertex of the cross-polytope. A probe takes nearby vertices instead, those with the smallest loss first.
    """
    size = _padded(vectors.shape[1])
    x = np.zeros((len(vectors), size))
    x[:, :vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    choices = min(CHOICES, size)
    options = np.stack(np.meshgrid(*[np.arange(choices)] * functions, indexing="ij"), -1).reshape(-1, functions)
    out = np.empty((len(x), tables, probes), np.uint64)
    for t in range(tables):
        codes, losses = [], []
        for k in range(functions):
            z = _rotate(x, 1_000 * t + k)
            strength = np.abs(z)
            top = np.argsort(-strength, axis=1, kind="stable")[:, :choices]
            best = np.take_along_axis(strength, top, 1)
            codes.append(2 * top + (np.take_along_axis(z, top, 1) < 0))
            losses.append((best[:, :1] - best) ** 2)
        loss = sum(losses[k][:, options[:, k]] for k in range(functions))
        pick = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        key = np.full(pick.shape, np.uint64(t * 1_000_003 + size))
        for k in range(functions):
            key = mix(key ^ (np.take_along_axis(codes[k], options[:, k][pick], 1).astype(np.uint64) + np.uint64(1)) * constants(7, 1)[0])
        out[:, t, :key.shape[1]] = key
        out[:, t, key.shape[1]:] = key[:, :1]  # fewer vertices than probes
    return out


def _hashed(functions: int, tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, groups = batch.column("vector"), batch.column("group").to_numpy().astype(np.uint64)
            sizes = np.diff(vectors.offsets.to_numpy())
            own = np.empty((len(sizes), tables, probes), np.uint64)
            flat, starts = vectors.values.to_numpy(), vectors.offsets.to_numpy()[:-1]
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own[rows] = bucket_keys(flat[starts[rows][:, None] + np.arange(size)], functions, tables, probes)
            own = mix(own ^ groups[:, None, None]).view(np.int64)
            as_list = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x[0].size).cast(pa.list_(pa.int64()))
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, as_list(own[:, :, 0]), as_list(own[:, :, 1:])], [*batch.schema.names, "homes", "probes"])

    return run


def _linked(cosine: float):
    """Rows of sorted buckets to (node, links, root) for each row that has links.

    A pair is counted in the first of the places where it meets, told from the keys that both rows carry,
    so it counts once however many buckets it shares.
    """

    def flush(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        n = len(table)
        col = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
        wide = lambda c: table[c].combine_chunks().flatten().to_numpy().reshape(n, -1)
        node, group, copies, block, cross = col("node"), col("group"), col("copies"), col("block"), col("bi") != col("bj")
        home, homes, probes = col("home"), wide("homes"), wide("probes")
        key = col("key")
        vectors, sizes = table["vector"].combine_chunks(), None
        offsets = vectors.offsets.to_numpy() - vectors.offsets.to_numpy()[0]
        sizes, flat = np.diff(offsets), vectors.flatten().to_numpy()
        x = np.zeros((n, sizes.max()))
        x[np.repeat(np.arange(n), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1], sizes)] = flat
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        first = np.repeat(starts, np.diff(np.append(starts, n)))
        place = np.arange(n) - first
        mains = np.add.reduceat(home.astype(np.int64), starts)[np.searchsorted(starts, first)]
        partners = np.minimum(place, mains)
        ends = np.cumsum(partners)
        left, right = [], []
        at = 0
        while at < n:
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] - partners[at] + PAIRS_AT_ONCE, "right")))
            count = partners[at:stop]
            i = np.repeat(np.arange(at, stop), count)
            j = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            at = stop
            fits = (group[i] == group[j]) & (sizes[i] == sizes[j]) & (~cross[i] | (block[i] != block[j])) & (node[i] != node[j])
            i, j = i[fits], j[fits]
            near = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
            i, j = i[near], j[near]
            first_place = np.ones(len(i), bool)
            for s in range(0, len(i), 4096):  # j is at home here; i is at home or probes
                a, b = i[s:s + 4096], j[s:s + 4096]
                tables = homes.shape[1]
                pa_, pb = probes[a].reshape(len(a), tables, -1), probes[b].reshape(len(b), tables, -1)
                a_in_b = (homes[a][:, :, None] == pb).any(axis=2) | (homes[a] == homes[b])
                b_in_a = (homes[b][:, :, None] == pa_).any(axis=2)
                meets = a_in_b | b_in_a
                table_at = (homes[b] == key[b][:, None]).argmax(axis=1)
                earliest = meets.argmax(axis=1) == table_at
                row = np.arange(len(a))
                twice = a_in_b[row, table_at] & b_in_a[row, table_at] & (homes[a][row, table_at] != homes[b][row, table_at])
                first_place[s:s + 4096] = earliest & (~twice | (node[b] < node[a]))
            left.append(i[first_place])
            right.append(j[first_place])
        i, j = np.concatenate(left), np.concatenate(right)
        links = np.zeros(n, np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = np.arange(n)
        while True:
            before = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            root = root[root]
            if (root == before).all():
                break
        has = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(node[has]), pa.array(links[has]), pa.array(node[root[has]])], ["node", "links", "root"])

    return lambda batches: by_group(batches, ["key", "bi", "bj"], flush)


def _usable(vector: Column, label: Column) -> Column:
    """Label and vector there, no component missing or not finite, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Equal vectors of a label become one class with a count. Classes are hashed; only classes that share a
    bucket with another one (one at home there at least) are sent to it with their vector. A bucket of more
    than ``block`` rows is cut into blocks and every two blocks meet in a task of their own, so a hot group
    is spread and never collected; links leave a task as counts and as one edge per row, not as pairs.

    Defined cases: vectors that are null, zero or hold null, NaN or infinite components, and rows with a
    null label, link with nothing and are kept; vectors of different length do not compare; rows that
    repeat count as copies, also under one vec_id; a null vec_id is never the smallest unless its whole
    component has none. An empty table gives an empty result; other columns are not read.
    """
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))  # -0.0 is 0.0
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vector.alias("vector"))
    node = F.when(_usable(F.col("vector"), F.col("label")), F.xxhash64("label", "vector"))
    rows = rows.withColumn("node", node)
    classes = rows.filter("node is not null").groupBy("node", "label", "vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = materialize(classes.select("node", F.xxhash64("label").alias("group"), "vector", "copies", "least"), "classes")
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    functions = functions_for(size["n"], size["d"] or 1)
    tables = TABLES[functions]
    schema = "node long, `group` long, vector array<double>, copies long, least long, homes array<long>, probes array<long>"
    hashed = materialize(classes.mapInArrow(_hashed(functions, tables, probes), schema), "hashed")

    entries = hashed.select("node", F.explode("homes").alias("key"), F.lit(True).alias("home")).unionByName(
        hashed.select("node", F.explode("probes").alias("key"), F.lit(False).alias("home")))
    shared = entries.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(F.col("home"), 1)).alias("m")).filter(
        "n > 1 and m > 0").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    meetings = entries.join(shared, "key").withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "key", "home", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    carried = hashed.select("node", "group", "vector", "copies", "homes", "probes")
    found = (
        meetings.join(carried, "node").repartition("key", "bi", "bj")
        .sortWithinPartitions("key", "bi", "bj", F.col("home").desc(), "node")
        .mapInArrow(_linked(cosine), "node long, links long, root long"))
    found = materialize(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = materialize(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "roots")

    placed = classes.select("node", "least", "copies").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = placed.join(named, "root").join(links, "node", "left").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "node").join(facts, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
