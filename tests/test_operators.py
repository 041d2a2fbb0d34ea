"""Operators against brute force, with one key holding a third of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.constants import ASPECTS
from reviewloom.functions import labels
from reviewloom.operators import (
    conversations, documents, evaluation, flatten, layout, learning, merge, profiling, ranking, scores, search, sketches,
)

LABEL = "array<struct<aspect:string,sentiment:string>>"


def skewed(n=300, keys=20, seed=1):
    rnd = random.Random(seed)
    return [(0 if i % 3 == 0 else rnd.randrange(1, keys), i) for i in range(n)]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_positions(spark, block):
    data = [(k, i * 3 + 1) for k, i in skewed()]
    df = spark.createDataFrame(data, "k int, o bigint")
    per_key = {}
    for k, o in sorted(data, key=lambda r: r[1]):
        per_key.setdefault(k, []).append(o)
    want = sorted((k, o, i) for k, os in per_key.items() for i, o in enumerate(os))
    assert rows(layout.with_position(df, "o", ["k"], block_rows=block), "k", "o", "position") == want
    whole = sorted((o, i) for i, o in enumerate(sorted(o for _, o in data)))
    assert rows(layout.with_position(df, "o", block_rows=block), "o", "position") == whole


@pytest.mark.parametrize("block", [9, 1000])
def test_last_value_and_previous_rows(spark, block):
    data = [(k, i, i if i % 5 == 0 else None) for k, i in skewed()]
    df = spark.createDataFrame(data, "k int, o bigint, v bigint")
    want, past, seen, before = [], [], {}, {}
    for k, o, v in sorted(data, key=lambda r: r[1]):
        seen[k] = v if v is not None else seen.get(k)
        want.append((k, o, seen[k] if seen[k] is not None else -1))
        past.append((k, o, tuple(before.get(k, [])[-8:])))
        before.setdefault(k, []).append(o)
    got = layout.last_value_so_far(df, ["k"], "o", "v", "last", block).na.fill(-1, ["last"])
    assert rows(got, "k", "o", "last") == sorted(want)
    got = layout.previous_rows(df, ["k"], "o", F.col("o"), 8, "past", block)
    assert sorted((r.k, r.o, tuple(r.past)) for r in got.collect()) == sorted(past)


def test_new_reviews(spark):
    main = spark.createDataFrame([(1, 1, "old")], "review_id bigint, product_id bigint, content string")
    pending = spark.createDataFrame([
        (2, 1, "old", "f1"), (3, 1, "new", "f2"), (4, 1, "new", "f1"), (5, 1, "new", "f1"), (6, 2, "new", "f2"), (7, 2, None, "f1"),
    ], "review_id bigint, product_id bigint, content string, source_file string")
    assert rows(merge.new_reviews(pending, main), "review_id") == [(4,), (5,), (6,), (7,)]
    figures = merge.merge_figures(main, pending).first()
    assert (figures.added, figures.total, figures.affected) == (4, 5, 2)
    assert rows(merge.delta_reviews(pending, ["source_file", "review_id"]), "review_id") == [(2,), (4,), (6,), (7,)]


def test_many_copies_of_one_review(spark):
    """A third of the pending rows are copies of one review in one file."""
    pending = spark.createDataFrame(
        [(i, 1 if i % 3 == 0 else i, "same" if i % 3 == 0 else f"c{i}", "f1") for i in range(300)],
        "review_id bigint, product_id bigint, content string, source_file string")
    main = spark.createDataFrame([(1000, 5, "c5")], "review_id bigint, product_id bigint, content string")
    assert merge.new_reviews(pending, main).count() == 299
    assert merge.delta_reviews(pending, ["source_file", "review_id"]).count() == 201


def test_resume_and_errors(spark):
    df = spark.createDataFrame([(1, "a ", None), (2, None, None), (3, "c", None)], "id bigint, k string, v string")
    done = spark.createDataFrame([(9, "a", "x"), (8, "Unknown", "y"), (7, "a", "z"), (6, "c", None)], "id bigint, k string, v string")
    assert sorted(map(str, rows(merge.resume(df, done, ["k"], ["v"], "id"), "id", "v"))) == [
        "(1, 'z')", "(2, 'y')", "(3, None)"]
    raw, processed, labeled = (spark.range(n).withColumnRenamed("id", "review_id") for n in (5, 4, 2))
    assert rows(merge.error_stages(raw, processed, labeled), "review_id", "error_stage") == [
        (2, "FAILED_LABELING"), (3, "FAILED_LABELING"), (4, "FAILED_PREPROCESS")]


def test_review_count_changes(spark):
    now = spark.createDataFrame([(1, 5), (2, 3), (3, None), (4, 0)], "product_id bigint, review_count bigint")
    state = spark.createDataFrame([(1, 5), (2, 1), (3, 1)], "product_id bigint, review_count bigint")
    got = {r.product_id: (r.previous_count, r.current_count, r.delta) for r in merge.review_count_changes(now, state).collect()}
    assert got == {2: (1, 3, 2), 4: (-1, 0, None)}


def label(*pairs):
    return [{"aspect": a, "sentiment": s} for a, s in pairs]


def test_scores(spark):
    df = spark.createDataFrame([
        (1, label(("price", "positive"), ("price", "negative"), ("bad", "positive"))), (1, label(("quality", "neutral"))),
        (1, label(("bad", "worse"))), (1, []), (2, label(("bad", "positive"))), (3, None),
    ], f"product_id bigint, label {LABEL}")
    got = {(r.product_id, r.aspect): r for r in scores.aspect_scores(df).collect()}
    assert {p for p, _ in got} == {1} and got[1, "price"].n_reviews == 3
    assert (got[1, "price"].score, got[1, "price"].conf) == (0.0, 0.667)
    assert (got[1, "quality"].score, got[1, "quality"].neu) == (0.0, 1)
    assert (got[1, "service"].score, got[1, "service"].conf) == (None, 0.0)


def test_top_reviews(spark):
    def review(i, pid, content, sentiment):
        return (i, pid, 5, content, label(("price", sentiment)))

    data = [review(i, 0, "x" * (i + 1), "positive" if i % 4 else "negative") for i in range(300)]
    data += [review(900, 1, "same", "positive"), review(901, 1, "same", "negative"), review(902, 1, "n", "neutral")]
    df = spark.createDataFrame(data, f"review_id bigint, product_id bigint, rating int, content string, label {LABEL}")
    got = rows(documents.top_reviews(df), "product_id", "position", "review_id")
    pos = [i for i in range(299, -1, -1) if i % 4][:14]
    neg = [i for i in range(299, -1, -1) if i % 4 == 0][:6]
    assert [r[2] for r in got if r[0] == 0] == pos + neg
    # The limits come before the content dedup: equal contents leave one review.
    assert [r[2] for r in got if r[0] == 1] == [900]


def test_kb_replace_stored(spark, folder):
    kb = spark.createDataFrame([(f"d{i}", i % 10) for i in range(100)], "id string, product_id bigint")
    merge.kb_rebuild(kb, folder, 4)
    delta = spark.createDataFrame([("new1", 3), ("new2", 42)], "id string, product_id bigint")
    for _ in range(2):
        merge.kb_replace_stored(spark, folder, delta, 4)
        got = rows(spark.read.parquet(folder), "id", "product_id")
        assert got == sorted([(f"d{i}", i % 10) for i in range(100) if i % 10 != 3] + [("new1", 3), ("new2", 42)])
    with pytest.raises(ValueError):
        merge.kb_rebuild(kb.unionByName(kb), folder + "x")


def test_write_if_changed(spark, folder):
    main = spark.createDataFrame([(1, False)], "id bigint, is_new boolean")
    assert not merge.write_if_changed(main, folder + "/a")
    assert merge.write_if_changed(main.unionByName(spark.createDataFrame([(2, True)], main.schema)), folder + "/b")
    assert spark.read.parquet(folder + "/b").count() == 2


def test_take_while_recent(spark):
    df = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 2, 5), (1, 3, 3, 12), (2, 4, 1, None), (2, 5, 2, 11)],
                               "product_id bigint, review_id bigint, place int, created int")
    assert rows(ranking.take_while_recent(df, "created", F.lit(8)), "review_id") == [(1,), (4,), (5,)]


def test_lookback(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, None)], "id int, created int")
    assert rows(flatten.lookback(df, F.col("created"), F.lit(10)), "id") == [(1,), (3,)]


def test_chunks_and_vocabulary(spark):
    df = spark.createDataFrame([(i * 2,) for i in range(25)], "id bigint")
    got = rows(ranking.chunk_assignment(df, "id", "b", size=10, block_rows=7), "id", "chunk_name")
    assert got == [(i * 2, f"b_chunk_{i // 10:03d}") for i in range(25)]
    words = spark.createDataFrame([(0, 0, "b"), (0, 1, "a"), (1, 0, "a"), (3, 0, "b"), (3, 1, "c")], "doc_id bigint, pos int, token string")
    vocab = ranking.vocabulary(words)
    assert rows(vocab, "token", "id") == [("<pad>", 0), ("<unk>", 1), ("a", 3), ("b", 2)]
    assert rows(ranking.encode_tokens(words, vocab, 3, spark.range(4).withColumnRenamed("id", "doc_id")), "doc_id", "ids") == [
        (0, [2, 3, 0]), (1, [3, 0, 0]), (2, [0, 0, 0]), (3, [2, 1, 0])]


def test_metrics_known_values(spark):
    matrix = [[56, 21, 5], [16, 727, 55], [4, 45, 198]]
    pairs = spark.createDataFrame(
        [("d", y, p) for y in range(3) for p in range(3) for _ in range(matrix[y][p])], "aspect string, y int, p int")
    got = evaluation.classification_metrics(pairs, ["aspect"]).first()
    assert got.accuracy == pytest.approx(0.870452528837622) and got.precision_macro == pytest.approx(0.8070185728552003)
    assert got.recall_macro == pytest.approx(0.798524610462993) and got.f1_macro == pytest.approx(0.8023032700520408)
    report = {r.part: r for r in evaluation.classification_report(pairs, ["aspect"]).collect()}
    assert report["weighted avg"].f1 == pytest.approx(0.8705398736276881)
    assert [report[n].support for n in ("negative", "neutral", "positive")] == [82, 798, 247]


def test_retrain_trigger(spark):
    runs = spark.createDataFrame([(0.9,)], "avg_f1 double")
    assert not evaluation.retrain_trigger(spark.range(249), runs).first().triggered
    assert evaluation.retrain_trigger(spark.range(250), runs).first().reasons == "Data volume: 250 reviews mới >= 250"
    assert evaluation.retrain_trigger(spark.range(1), runs.select(F.lit(0.8).alias("avg_f1"))).first().triggered


def test_running_totals(spark):
    rng = np.random.default_rng(4)
    blocks = sorted({int(x) for x in rng.integers(0, 1 << 40, 200)} | set(range(50)))
    df = spark.createDataFrame([(x, i % 5) for i, x in enumerate(blocks)], "b long, n long")
    want, total = {}, 0
    for i, x in enumerate(blocks):
        want[x], total = total, total + i % 5
    for levels, width in ((0, 4), (2, 1 << 16), (3, 7)):
        assert dict(map(tuple, layout.running_totals(df, "b", "n", levels, width).collect())) == want


def test_embed_with_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "")], "id int, content string")
    load = lambda: lambda texts: [[float(len(t))] for t in texts]
    assert sorted(map(tuple, learning.embed_with(df, load).select("id", "embedding").collect())) == [
        (1, [1.0]), (2, None), (3, [1.0]), (4, [0.0])]


def test_labels_are_whole_lists(spark):
    texts = ['[{"aspect": "price", "sentiment": "positive"}]', '[{"aspect": "price", "sentiment": "positive"}] x',
             '{"aspect": "price", "sentiment": "positive"}', " [] ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(F.size(labels.parse_label(F.col("t")))).collect()] == [1, 0, 0, 0, 0]


def test_all_pages_and_blank_stops(spark):
    page = lambda p, items: (1, p, '{"data": [' + ", ".join(items) + "]}")
    item = lambda text, at: f'{{"content": "{text}", "rating": 5, "created_at": {at}}}'
    pages = spark.createDataFrame([page(p, [item(f"r{p}", 1_700_000_000)]) for p in range(1, 14)], "product_id long, page long, payload string")
    assert flatten.flatten_reviews(pages).count() == 13 and flatten.flatten_reviews(pages, max_pages=5).count() == 5
    old = spark.createDataFrame([page(1, [item("ok", 1_700_000_000), item(" ", 1_000_000_000), item("later", 1_700_000_000)])], pages.schema)
    recent = ranking.take_while_recent(flatten.served_reviews(old), "created_ts", F.timestamp_seconds(F.lit(1_600_000_000)))
    assert [r.content for r in flatten.with_content(recent).collect()] == ["ok"]


def test_kb_rebuild_checks(spark, folder):
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "id string, product_id long")
    merge.kb_rebuild(docs, folder)
    assert spark.read.parquet(folder).count() == 2
    for wrong in (docs.limit(0), docs.union(docs)):
        with pytest.raises(ValueError):
            merge.kb_rebuild(wrong, folder)


def test_kb_replaced_beside_its_base(spark, folder):
    docs = spark.createDataFrame([(f"d{i}", i % 40) for i in range(200)], "id string, product_id long")
    merge.kb_rebuild(docs, f"{folder}/base")
    delta = spark.createDataFrame([("new3", 3), ("new7", 7), ("fresh", 99)], docs.schema)
    want = rows(merge.kb_replace(docs, delta), "id", "product_id")
    assert rows(merge.kb_replaced(spark, f"{folder}/base", f"{folder}/new", delta), "id", "product_id") == want
    assert rows(spark.read.parquet(f"{folder}/base"), "id") == rows(docs, "id")
    merge.kb_replace_stored(spark, f"{folder}/base", delta)  # in place, for a base without other readers
    assert rows(spark.read.parquet(f"{folder}/base"), "id", "product_id") == want


def test_boost_counts_null_as_zero(spark):
    df = spark.createDataFrame([(None,), (0.5,)], "absa_price_score double")
    assert [r[0] for r in df.select(search.aspect_boost(["price", "nothing"])).collect()] == [0.0, 0.25]


def test_chat_history(spark):
    chat = spark.createDataFrame(
        [(0, t, "user" if t % 2 == 0 else "assistant", f"m{t}" + (" https://s.vn/x-p7" if t == 4 else "")) for t in range(30)],
        "conv_id bigint, turn bigint, role string, text string")
    assert rows(conversations.final_history(chat), "turn") == [(t,) for t in range(22, 30)]
    past = {r.turn: [m.content[:3].strip() for m in r.history] for r in conversations.history_before(chat, block_rows=5).collect()}
    assert past[0] == [] and past[20] == [f"m{t}" for t in range(12, 20)]
    current = dict(rows(conversations.with_current_product(chat, "s.vn", block_rows=5).na.fill(-1), "turn", "current_product"))
    assert [current[t] for t in (3, 4, 29)] == [-1, 7, 7]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (1, None, None)], "x int, y string, z string")
    assert rows(profiling.null_counts(df), "column_name", "nulls") == [("x", 0), ("y", 1), ("z", 3)]
    assert rows(profiling.distinct_counts(df), "column_name", "distinct_values") == [("x", 1), ("y", 2), ("z", 0)]
    assert rows(profiling.distinct_counts(df, approximate=True), "distinct_values") == [(0,), (1,), (2,)]
    assert rows(profiling.constant_columns(df), "column_name", "value") == [("x", "1")]
    assert profiling.duplicate_rows(df.select("x")).first()[0] == 2
    values = spark.createDataFrame([(v,) for v in (1, 2, 2, 51)], "v int")
    got = dict(rows(profiling.histogram(values, "v", 50), "bin", "n"))
    assert (len(got), got[1], got[2], got[50]) == (50, 1, 2, 1)


@pytest.mark.parametrize("limit,blocks", [(2_000_000, None), (2_000_000, 1), (0, None)])
def test_main_is_filtered_before_its_shuffle(spark, monkeypatch, limit, blocks):
    """Exact whether the filter is large, far too small or left out; a large one lets few others pass."""
    monkeypatch.setattr(merge, "FILTER_BLOCKS", limit)
    main = spark.range(30_000).select(F.sha2(F.col("id").cast("string"), 256).alias("_key"), "id")
    wanted = spark.range(29_000, 31_000).select(F.sha2(F.col("id").cast("string"), 256).alias("_key"))
    passed = merge.possible_matches(main, wanted, blocks=blocks)
    ids = {r.id for r in passed.collect()}
    assert set(range(29_000, 30_000)) <= ids and (len(ids) < 1400 if limit and not blocks else len(ids) > 20_000)
    old = spark.createDataFrame([(i % 7, f"c{i}", "f") for i in range(500)], "product_id long, content string, source_file string")
    day = spark.createDataFrame([(i % 7, f"c{i}", f) for i in range(490, 600) for f in "ab"] + [(None, "c1", "a"), (1, None, "a")], old.schema)
    assert rows(merge.new_reviews(day, old).na.fill("-").na.fill(-1), *old.columns) == sorted(
        [(i % 7, f"c{i}", "a") for i in range(500, 600)] + [(-1, "c1", "a"), (1, "-", "a")])


def test_label_and_count(spark, folder):
    data = [(i, None if i % 4 == 0 else "x", i % 3) for i in range(100)]
    raw = spark.createDataFrame(data, "i int, text string, k int").repartition(7)
    got = evaluation.label_and_count(raw, F.col("text").isNotNull(), F.nullif(F.col("k"), F.lit(0)) > 0, folder).first()
    assert (got.rows_input, got.rows_after_preprocess, got.rows_labeled, got.rows_dropped, got.rows_failed) == (100, 75, 50, 25, 25)
    assert spark.read.parquet(folder).count() == 50 and spark.read.parquet(folder).columns == raw.columns
    none = evaluation.label_and_count(raw.limit(0), F.lit(True), F.lit(True), f"{folder}/none").first()
    assert (none.rows_input, none.success_pct) == (0, 0.0)


def test_stored_follows_the_tables(spark, folder):
    """What is stored is built once, and again when a table's files change."""
    from reviewloom.plans.stored import stored

    built = []
    for k in range(4):
        if k != 1:
            spark.range(k + 1).write.mode("append").parquet(f"{folder}/t.parquet")
        stored(spark, folder, "x", ["t"], built.append)
    assert len(built) == 3


def test_daily_sketches(spark, folder):
    """Merged days against exact figures; a day's size does not follow its rows; a day done again changes nothing."""
    rng = np.random.default_rng(7)
    n = 60_000
    data = [(int(d), int(u), float(x), bool(f)) for d, u, x, f in zip(
        np.minimum(rng.geometric(0.1, n), 59), rng.integers(0, 9000, n), rng.lognormal(3, 1, n), rng.random(n) < 0.02)]
    log = spark.createDataFrame(data + [(5, None, None, False), (200, 1, None, True)], "d int, user_id bigint, latency_ms double, failed boolean").select(
        F.expr("timestamp '2024-01-01 12:00:00' + make_interval(0, 0, 0, d)").alias("ts"), "user_id", "latency_ms", "failed")
    sketches.store_days(log.repartition(9), folder)
    sketches.store_days(log.filter("day(ts) = 7"), folder)
    got = {str(r.span): r for r in sketches.merge_days(spark, folder, "year").collect()}["2024-01-01"]
    assert (got.requests, got.days) == (n + 2, len({d for d, *_ in data}) + 1)
    assert got.error_pct == pytest.approx(100 * (1 + sum(f for *_, f in data)) / (n + 2))
    assert got.users == pytest.approx(len({u for _, u, *_ in data}), rel=0.05)
    latency = np.sort([x for _, _, x, _ in data])
    assert got.mean_latency == pytest.approx(latency.mean())
    for share in sketches.SHARES:
        assert abs(np.searchsorted(latency, got[f"p{round(100 * share)}_latency"]) / n - share) < 0.02
    sizes = spark.read.schema(sketches.DAY).parquet(folder).selectExpr("max(length(users) + length(latencies)) AS s").first().s
    assert sizes < 16_000
    july = [r for r in sketches.merge_days(spark, folder).collect() if str(r.span) == "2024-07-01"]
    assert len(july) == 1 and july[0].p95_latency is None and july[0].mean_latency is None and july[0].users == 1
    sketches.store_days(log.limit(0), f"{folder}/none")
    assert sketches.merge_days(spark, f"{folder}/none").count() == 0


def test_guards(spark):
    df = spark.range(1)
    assert list(flatten.with_required_columns({"a": df, "b": df.withColumn("x", F.lit(1))}, {"x"})) == ["b"]
    with pytest.raises(ValueError):
        flatten.require_columns(df, {"product_id"}, "main table")


def test_model_hooks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a")], "id bigint, content string")
    scored = learning.score_with(df, lambda: (lambda b: b.assign(n=b.content.str.len())), "id bigint, content string, n bigint")
    assert rows(scored, "id", "n") == [(1, 1), (2, 2), (3, 1)]
    embedded = learning.embed_with(df, lambda: (lambda texts: [[len(t), 1.0] for t in texts]))
    assert rows(embedded, "id", "embedding") == [(1, [1.0, 1.0]), (2, [2.0, 1.0]), (3, [1.0, 1.0])]


def test_batch_scoring(spark):
    good = [(i, "rất tốt đẹp" if i % 2 else "rất xấu tệ", 2 if i % 2 else 0, "dev" if i % 5 == 0 else "train") for i in range(60)]
    data = learning.with_grams(spark.createDataFrame(good, "id bigint, text string, quality int, split string"))
    runs, model = learning.grid_search(data, ["quality"], learning.fit_logreg, {"max_features": [50], "c": [0.1, 1.0]})
    assert runs.agg(F.max("avg_f1")).first()[0] == 1.0
    figures = learning.score_and_aggregate(
        model, spark.createDataFrame([("p", "tốt đẹp"), ("p", "tệ"), ("p", "  ")], "k string, text string"), ["quality"], ["k"])
    got = {r.aspect: (r.pos, r.neg, r.pct) for r in figures.collect()}
    assert len(got) == len(ASPECTS) and got["quality"] == (1, 1, 50) and got["price"] == (0, 0, 0)
    forest = learning.train(data, ["quality"], 50, learning.fit_forest, trees=5)
    assert learning.evaluate(forest, data.filter("split = 'dev'"), ["quality"]).first().f1_macro == 1.0
