"""Whitening, spelling variants and benchmark passages against plain Python, and on rows that are odd."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from reviewloom.llm import contamination, spelling, whitening
from reviewloom.llm.queries import QUERIES, misspelt

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# 11: whitening

def spectrum(values, seed=0):
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return turn @ np.diag(values) @ turn.T


@pytest.mark.parametrize("values", [
    [1.0], [3.0, 1.0], np.linspace(1, 9, 64), 2.0 ** -np.arange(40), [0.0] * 8, [5.0] * 30 + [0.0] * 20,
    np.r_[[4.0] * 3, [2.0] * 2, np.linspace(0, 1, 40)], 1 + 1e-9 * np.arange(30), np.r_[1 + 1e-14 * np.arange(9), np.linspace(0, 0.5, 9)],
    -np.arange(1.0, 12.0),
])
def test_leading_eigenpairs(values):
    """Right values, residuals and angles, whether eigenvalues are apart, close, equal or zero."""
    a = spectrum(np.asarray(values, float))
    own, vectors = whitening.leading_eigenpairs(a, 32)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:32]
    scale = max(np.abs(want).max(), 1e-300)
    assert np.abs(own - want).max() <= 1e-13 * scale
    assert np.abs(a @ vectors - vectors * own).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(own))).max() <= 1e-13


def test_counts_above():
    values = np.array([-3.0, -1.0, 0.5, 0.5, 2.0, 7.0])
    diagonal, off = whitening.tridiagonal(spectrum(values))
    shifts = np.array([-4, -2, 0, 0.4, 0.6, 6.9, 7.1])
    assert whitening.counts_above(diagonal, off, shifts).tolist() == [(values > s).sum() for s in shifts]


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    kept, n, deviation, want, explained = brute.whitened([r.embedding for r in rows])
    got = {(r.vec_id, r.component): r for r in QUERIES["op11_spectrum_slicing"](spark, SF).collect()}
    assert len(got) == n * 32
    for c in range(32):
        column = [got[rows[i].vec_id, c + 1] for i in kept]
        own = np.array([r.whitened for r in column])
        assert np.allclose(own * np.sign(own @ want[:, c]), want[:, c], rtol=1e-9, atol=1e-9)
        assert all(abs(r.explained / explained[c] - 1) < 1e-12 and r.n == n for r in column)
        assert [r.deviation for r in column] == deviation
    assert len({r.identity_error for r in got.values()}) == 1 and 0 <= got[rows[kept[0]].vec_id, 1].identity_error < 1e-9


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=5)], "x") for i in range(50)]
    odd = [(50, None, "x"), (51, [NAN] * 5, "x"), (52, [1.0, INF, 0.0, 0.0, 0.0], "x"), (53, [None] * 5, None), (54, [1.0], "x"), (55, [], "x"),
           (56, [1e300] * 5, "x"), (None, rows[0][1], None), (0, rows[0][1], "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, component string")
    used = [r[1] for r in rows] + [rows[0][1]] * 2
    _, n, deviation, want, explained = brute.whitened(used)
    got = whitening.whitened(df).collect()
    assert n == 52 and len(got) == 52 * 5 and sorted({r.vec_id for r in got if r.vec_id is not None}) == list(range(50))
    assert sum(r.vec_id is None for r in got) == 5 and sum(r.vec_id == 0 for r in got) == 10
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    assert max(r.identity_error for r in got) < 1e-12
    assert np.allclose(sorted(abs(r.whitened) for r in got if r.component == 2), sorted(abs(want[:, 1])))
    assert whitening.whitened(df.limit(0)).count() == 0 and whitening.whitened(df.filter("vec_id > 49 and vec_id < 54")).count() == 0
    same = whitening.whitened(df.filter("vec_id = 0")).collect()
    assert len(same) == 10 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)


def test_deviation_beyond_a_long():
    apart, rest = np.array([[3, -4], [2**40, 1]]), np.array([1, 0])
    assert whitening._deviation(apart, rest, 10) == [29**2 + 40**2, None]


# 12: spelling variants

def as_variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    counts = brute.spelt_words(rows)
    want = brute.word_variants(counts)
    assert sum(v[0] is not None for v in want.values()) > 5
    assert as_variants(QUERIES["op12_permuterm"](spark, SF)) == want


def test_variants_of_short_alphabets(spark):
    """Words over two letters have many near words, repeated letters and ties."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(400)} | {"aaaa", "aaaaa", "aaaaaa", "b"}
    counts = {w: rng.choice((1, 1, 2, 5, 5, 10, 25, 26, 130)) for w in words}
    got = as_variants(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n int").withColumn("root", F.lit(1))))
    assert got == brute.word_variants(counts)


def test_chain_of_forms(spark):
    """Roots at the end of long chains are found by doubling."""
    chain = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg", "akjihg", "lkjihg"]
    counts = {w: 5 * 6 ** k for k, w in enumerate(chain)}
    got = as_variants(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute.word_variants(counts) and all(v[1] == "lkjihg" for v in got.values())


def test_odd_words(spark):
    rows = [(1, "Straßen straßen STRAßen straßem  straßen×", "x"), (2, None, "x"), (3, "", None), (None, "Éclairs éclairs eclairs eclairs", "x"),
            (4, "eclairs " * 40_000, "x"), (4, "eclairs " * 40_000, "x"), (5, "straßen " * 30 + "日本語 ½½½½½½½ $$$$$$$", "x"), (6, "éclairs " * 6, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    counts = brute.spelt_words([r[:2] for r in rows])
    got = as_variants(spelling.variants(spelling.vocabulary(df, misspelt)))
    assert got == brute.word_variants(counts) and got["éclairs"][0] == "eclairs"
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == brute.spelt_words([r[:2] for r in rows], every=1 << 40)
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(df.select("word", F.lit(1).alias("n")), ratio=1)


# 13: benchmark passages

def as_hits(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=str)


def test_benchmark_passages(spark):
    """A small alphabet of words makes common k-grams, overlapping windows, short items and repeated ones."""
    rng = random.Random(1)
    text = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    words = [f"w{i}" for i in range(60)]
    items = [(str(i), text(rng.choice((3, 5, 9, 10, 11, 14, 30)), words)) for i in range(40)]
    items += [("dup", items[0][1]), ("dup", items[1][1]), (None, text(12, words)), ("none", None), ("gap", " -- "), ("one", "w3 Ünïq")]
    rows = []
    for i in range(120):
        parts = [text(rng.randint(0, 25), words)]
        for _ in range(rng.randint(0, 3)):
            part = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, max(0, len(part) - 10))
            parts += [", ".join(part[cut:cut + rng.choice((9, 10, 12, 40))]).upper(), text(rng.randint(0, 9), words)]
        rows.append((i, " ".join(parts), "x"))
    rows += [(500, None, "x"), (501, "", None), (502, " \n ", "x"), (None, items[2][1], "x"), (None, None, None), (503, "Ünïq w3 ünïq", "x"),
             (504, "w3;ÜnïQ", "x"), (505, "w3 Ünïq", "x"), (7, rows[7][1], "x"), (7, items[3][1], "x"),
             (506, (items[3][1] + " ") * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id string, text string").withColumn("window", F.lit(1))
    want = sorted(brute.benchmark_hits([r[:2] for r in rows], items), key=str)
    assert as_hits(contamination.contaminated(docs, bench)) == want and sum(w[2] > 0 for w in want) > 40
    got = contamination.contaminated(docs, bench).collect()
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    assert contamination.contaminated(docs.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 and not r.contaminated and r["items"] == [] for r in contamination.contaminated(docs, bench.limit(0)).collect())


def test_benchmark_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination.contaminated(docs, bench)
    want = brute.benchmark_hits([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    assert as_hits(found) == sorted(want, key=str)
    digests = {r.doc_id: (r.n_items, r.items_sha256) for r in QUERIES["op13_winnowing"](spark, SF).collect()}
    assert digests == {i: (len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()) for i, _, _, ids in want}


@pytest.mark.parametrize("length", range(1, 11))
def test_every_shared_span_shares_a_fingerprint(spark, length):
    """Winnowing's guarantee: every window of ``length`` words holds a place that was kept, and the smallest one."""
    rng = random.Random(length)
    hashes = [[rng.randint(0, 9) for _ in range(rng.randint(0, 40))] for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(hashes)), "i int, hashes array<long>")
    k, w = contamination.gram_and_span(length)
    found = contamination.fingerprints(df, ["i"], length).collect()
    assert len({(r.i, r.place) for r in found}) == len(found)
    kept = {(r.i, r.place): r["print"] for r in found}
    grams = {}
    for (i, place), value in kept.items():  # equal k-grams have equal fingerprints
        assert grams.setdefault(tuple(hashes[i][place:place + k]), value) == value
    for i, row in enumerate(hashes):
        for s in range(len(row) - length + 1):
            assert any((i, p) in kept for p in range(s, s + w))
