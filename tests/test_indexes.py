"""Stored codes, cells and postings against brute force."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.operators import lexical_index, search, vector_index


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def unit(vectors):
    vectors = np.asarray(vectors, np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


# --- codes ---------------------------------------------------------------------------
def points(spark, n=400, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((n, dim)).astype(np.float32)
    vectors[n // 2:] = vectors[0]  # half of the points are copies of one
    data = [(i, vectors[i].tolist(), f"t{i % 3}", i, 4.0 if i % 2 else None, None if i % 5 == 0 else (i % 7) / 7) for i in range(n)]
    df = spark.createDataFrame(
        data, "id bigint, embedding array<float>, doc_type string, price bigint, rating_average double, absa_quality_score double")
    return vectors, data, df.repartition(5)


@pytest.mark.parametrize("block", [2, 2048])
def test_vector_topk(spark, folder, monkeypatch, block):
    monkeypatch.setattr(search.query_blocks, "__defaults__", (block,))
    vectors, data, df = points(spark)
    queries = spark.createDataFrame([(q, vectors[q].tolist()) for q in (0, 1, 2, 3, 4)] + [(9, [1.0]), (10, None)],
                                    "query_id bigint, embedding array<float>")
    asked = [search.Condition(*c) for c in (("doc_type", "in", ["t0", "t1"]), ("rating_average", "at least", 3), ("price", "at most", 390))]
    got = {}
    broken = [None, [float("nan")] * 16, [None] * 16, [float("inf")] * 16, [], [1.0] * 15, [1.0] * 17]
    df = df.union(spark.createDataFrame([(1000 + i, v, "t0", 1, 4.0, 0.5) for i, v in enumerate(broken)], df.schema))
    vector_index.store_vectors(df, folder)
    for r in vector_index.vector_topk(spark, folder, queries, 3, asked, {"quality": 0.1, "x": 1}).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    own = unit(vectors)
    assert set(got) == set(range(5))
    for q in range(5):
        ok = [d for d in data if d[2] in ("t0", "t1") and (d[4] or 0) >= 3 and d[3] <= 390 and d[5] is not None and d[5] >= 0.1]
        near = sorted(ok, key=lambda d: (-round(float(own[d[0]] @ own[q]), 12), d[0]))[:6]
        ranked = sorted(enumerate(near), key=lambda e: (-round(round(float(own[e[1][0]] @ own[q]), 12) + 0.15 * e[1][5] / 2, 12), e[0]))
        assert sorted(got[q]) == [(i + 1, d[0]) for i, (_, d) in enumerate(ranked[:3])]


def test_codes_keep_their_bound():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 64, 300):
        vectors, asked = unit(rng.standard_t(2, size=(200, dim))), unit(rng.normal(size=(50, dim)))
        code, scale, error = vector_index.codes(vectors)
        assert code.dtype == np.int8 and (error < 0.01 * math.sqrt(dim)).all()
        assert (np.abs(vectors @ asked.T - (code.astype(float) @ asked.T) * scale[:, None]) <= error[:, None]).all()
    assert [x.tolist() for x in vector_index.codes(np.zeros((1, 3)))[:2]] == [[[0, 0, 0]], [0.0]]


@pytest.mark.parametrize("k", [1, 10, 5000])
def test_exact_among_close_points(spark, folder, monkeypatch, k):
    """Points closer to each other than the codes can tell, zero vectors, over many tasks and parts."""
    monkeypatch.setattr(vector_index, "PART_ROWS", 300)
    rng = np.random.default_rng(2)
    vectors = np.vstack([unit(np.ones((1, 24)) + 1e-4 * rng.normal(size=(1500, 24))), rng.normal(size=(1500, 24)), np.zeros((3, 24))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, embedding array<double>").repartition(7)
    vector_index.store_vectors(df, folder)
    asked = np.vstack([vectors[:3], vectors[1500:1502], np.zeros((1, 24))])
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in enumerate(asked)], "query_id bigint, embedding array<double>")
    got = rows(vector_index.vector_knn(spark, folder, queries, k), "query_id", "rank", "id")
    own, norm = search.units(vectors), search.units(asked)
    for q in range(len(asked)):
        score = np.round((own * norm[q]).sum(axis=1), 12)
        want = np.lexsort((np.arange(len(own)), -score))[:k]
        assert [i for a, _, i in got if a == q] == want.tolist()


def test_bytes_of_a_point(spark, folder):
    """The scan reads about a byte a dimension, a quarter of the single precision vectors."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(4000, 256)))], "id bigint, embedding array<float>")
    vector_index.store_vectors(df.coalesce(1), folder)
    assert size(f"{folder}/codes") / 4000 < 256 + 40 and size(f"{folder}/vectors") / 4000 > 3.5 * 256


def test_no_vectors(spark, folder):
    none = spark.createDataFrame([(1, None)], "id bigint, embedding array<float>")
    vector_index.store_vectors(none, folder)
    queries = spark.createDataFrame([(1, [1.0])], "query_id bigint, embedding array<float>")
    assert vector_index.vector_knn(spark, folder, queries, 3).count() == 0


# --- cells ---------------------------------------------------------------------------
def recall(spark, df, path, label=None):
    """Recall at 10 of the points whose id is divisible by 20, and the share of points that they are compared with."""
    vector_index.build_cells(df, path, label)
    index = vector_index.open_cells(spark, path)
    data = {r.id: r.embedding for r in df.collect()}
    asked = [i for i in data if i % 20 == 0]
    queries = spark.createDataFrame([(i, [float(x) for x in data[i]]) for i in asked], "query_id bigint, embedding array<double>")
    got = {}
    for r in vector_index.vector_cells_topk(spark, index, queries, 10).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    ids, own, hit = list(data), unit(list(data.values())), 0
    for q in asked:
        score = own @ own[ids.index(q)]
        hit += len({ids[i] for i in np.argsort(-score, kind="stable")[:10]} & got[q])
    assert index.sizes.sum() == len(data)
    return hit / (10 * len(asked)), index.share_read(np.array([data[i] for i in asked]))


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall_of_cells(spark, folder, name):
    df = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding", "label")
    found, share = recall(spark, df, folder, "label")
    assert found >= 0.9 and share < 0.8


def test_share_read_falls_as_the_table_grows(spark, folder):
    rng, shares = np.random.default_rng(3), []
    centres = rng.normal(size=(30, 32))
    for n in (500, 8000):
        df = spark.createDataFrame([(i, (centres[i % 30] + 0.5 * rng.normal(size=32)).tolist()) for i in range(n)],
                                   "id bigint, embedding array<double>")
        found, share = recall(spark, df, f"{folder}/{n}")
        assert found >= 0.9
        shares.append(share)
    assert shares[1] < 0.7 * shares[0] < 0.1


def test_odd_cells(spark, folder):
    """One vector holds a third of the rows; cells without points, zero, null and broken vectors."""
    rng = np.random.default_rng(5)
    data = [(i, (rng.normal(size=8) if i % 3 else np.ones(8)).tolist()) for i in range(600)]
    data += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [1.0]), (1004, [None] * 8)]
    df = spark.createDataFrame(data, "id bigint, embedding array<double>")
    vector_index.build_cells(df, folder)
    index = vector_index.open_cells(spark, folder)
    assert index.sizes.sum() == 601
    queries = spark.createDataFrame([(1, [1.0] * 8), (2, [0.0] * 8), (3, [1.0]), (4, None)], "query_id bigint, embedding array<double>")
    got = vector_index.vector_cells_topk(spark, index, queries, 5, probes=len(index.centres)).collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 1] == [0, 3, 6, 9, 12]
    assert {r.query_id for r in got} == {1, 2}
    emptied = vector_index.Cells(folder, np.vstack([index.centres, -np.ones((1, 8)) / math.sqrt(8)]), np.append(index.sizes, 0), 1)
    assert vector_index.vector_cells_topk(spark, emptied, queries.filter("query_id = 1"), 5, probes=len(emptied.centres)).count() == 5


def test_sample_covers_every_label(spark):
    df = spark.createDataFrame([(i, 0 if i < 900 else i) for i in range(1000)], "id bigint, label bigint")
    got = vector_index.fitting_sample(df, "label", 150).collect()
    assert len(got) == 150 and {r.label for r in got} == {0, *range(900, 1000)}
    assert vector_index.fitting_sample(df, None, 10).count() == 10


# --- postings ------------------------------------------------------------------------
def bm25(docs, queries, k, k1=1.2, b=0.75):
    split = lambda t: re.findall(r"\w\w+", (t or "").lower())
    found = {i: split(t) for i, t in docs}
    mean = sum(map(len, found.values())) / len(found)
    df = Counter(t for x in found.values() for t in set(x))
    out = {}
    for q, text in queries:
        scores = {}
        for i, x in found.items():
            tf = Counter(x)
            s = sum(math.log(1 + (len(found) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(x) / mean))
                    for t in split(text) if tf[t])
            if s:
                scores[i] = s
        out[q] = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}x" for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "rare rare"), (n + 3, "w1x " * 5000)]


@pytest.mark.parametrize("block,bound", [(16, 200_000), (16, 0), (1024, 200_000)])
def test_lexical_topk(spark, folder, monkeypatch, block, bound):
    monkeypatch.setattr(lexical_index, "BLOCK_DOCUMENTS", block)
    monkeypatch.setattr(lexical_index, "BROADCAST_ROWS", bound)
    monkeypatch.setattr(lexical_index, "PART_POSTINGS", 2000)
    docs = corpus(600, 1)
    asked = [(0, "w1x w2x"), (1, "rare w3x w3x"), (2, "???"), (3, None), (4, "nowhere"), (5, " ".join(f"w{i}x" for i in range(1, 120)))]
    lexical_index.build(spark.createDataFrame(docs, "id bigint, text string"), folder)
    queries = spark.createDataFrame(asked, "query_id bigint, text string")
    hits = lexical_index.lexical_topk(spark, folder, queries, 7)
    got = {}
    for r in sorted(hits.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.id)
    assert got == {q: ids for q, ids in bm25(docs, asked, 7).items() if ids}


def test_blocks_are_skipped(spark, folder, monkeypatch):
    """Blocks whose bound stays below the k-th score are not opened."""
    monkeypatch.setattr(lexical_index, "BLOCK_DOCUMENTS", 8)
    docs = [(i, "common " + " ".join(f"f{i}y{j}" for j in range(i % 40))) for i in range(800)] + [(1000 + i, "common " * 9) for i in range(20)]
    lexical_index.build(spark.createDataFrame(docs, "id bigint, text string"), folder)
    asked = lexical_index.query_terms(spark, folder, spark.createDataFrame([(1, "common")], "query_id bigint, text string"))
    bounds = lexical_index.block_bounds(spark, folder, asked)
    first = bounds.orderBy(F.desc("bound"), "block").limit(3)
    scores = lexical_index.block_scores(spark, folder, asked, first, 3)
    assert bounds.count() > 80 and lexical_index.opened_blocks(bounds, scores, first, 3).count() < 25


def test_no_hits(spark, folder):
    lexical_index.build(spark.createDataFrame([(1, "hello world")], "id bigint, text string"), folder)
    queries = spark.createDataFrame([(1, "???"), (2, "hello")], "query_id bigint, text string")
    hits = lexical_index.lexical_topk(spark, folder, queries, 5)
    assert rows(hits, "query_id", "id") == [(2, 1)]
    assert rows(search.retrieval_smoke(hits, queries, 1), "query_id", "hits", "passed") == [(1, 0, False), (2, 1, True)]
    lexical_index.build(spark.createDataFrame([], "id bigint, text string"), f"{folder}/none")
    assert lexical_index.lexical_topk(spark, f"{folder}/none", queries, 5).count() == 0
