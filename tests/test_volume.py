"""What is moved and written: texts are cut before they are shuffled, and stored compressed."""

import collections
import random
import threading
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter, Row, functions as F

from reviewloom import constants
from reviewloom.functions import text
from reviewloom.operators import documents, learning, lexical_index, merge, ranking, scores
from reviewloom.plans import bindings, merge_queries, project_queries
from reviewloom.session import materialize
from reviewloom.sources import files
from reviewloom.streaming import jobs, keyed, knowledge_base

LABEL = "array<struct<aspect:string,sentiment:string>>"
CHARS, REVIEWS = 5000, 200


def shuffled(df) -> int:
    """Runs ``df`` and returns the bytes of all rows that went through its shuffles."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()

    def total(node) -> int:
        if node.nodeName() == "AdaptiveSparkPlan":
            return total(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return total(node.plan())
        own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
        return own + sum(total(node.children().apply(i)) for i in range(node.children().size()))

    return total(plan)


def size_of(path: str) -> int:
    return sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("part-*"))


@pytest.fixture(scope="module")
def reviews(spark):
    rnd = random.Random(3)
    rows = [(i, i % 20, 5, "".join(rnd.choices("abcdefgh ", k=CHARS + i)), [("price", "positive")]) for i in range(REVIEWS)]
    return spark.createDataFrame(rows, f"review_id bigint, product_id bigint, rating int, content string, label {LABEL}").localCheckpoint()


def test_top_reviews_shuffle_what_is_shown(spark, reviews):
    """Contents that are alike in the shown part alone stay two reviews."""
    cut, whole = documents.top_reviews(reviews, 600), documents.top_reviews(reviews)
    assert shuffled(cut) < REVIEWS * CHARS / 2 < shuffled(whole)
    of = lambda df, c: sorted((r.product_id, r.position, r.review_id, r[c]) for r in df.collect())
    assert of(cut, "content") == of(whole.withColumn("content", F.substring("content", 1, 600)), "content")
    twins = spark.createDataFrame(
        [(i, 1, 5, "x" * 700 + end, [("price", "positive")]) for i, end in enumerate(["a", "b", "a"])], reviews.schema)
    assert sorted(r.review_id for r in documents.top_reviews(twins, 600).collect()) == [0, 1]


def test_documents_shuffle_what_is_shown(spark, reviews):
    products = spark.createDataFrame(
        [(i, "n", "b", "c", 1, "u", 4.0, 3) for i in range(20)],
        "product_id bigint, name string, brand_name string, category_name string, price bigint, product_url string, "
        "rating_average double, review_count bigint")
    wide = scores.aspect_scores_wide(reviews)
    docs = documents.build_documents(products, reviews, wide)
    assert shuffled(docs.filter("doc_type = 'review'")) < REVIEWS * CHARS / 2


def test_samples_are_cut_before_the_shuffle(reviews):
    assert shuffled(ranking.sample_reviews(reviews)) < REVIEWS * CHARS / 4


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Reviews of one text each, more in bytes than all that is said about them."""
    path, rnd = tmp_path_factory.mktemp("tables"), random.Random(5)
    spark.range(2000).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "concat(id % 5 + 1, '-X') AS o_orderpriority",
        "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS o_orderdate", "substr('FOP', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus",
    ).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(i, "".join(rnd.choices("abcdefgh ", k=3000))) for i in range(100)], "doc_id bigint, text string").coalesce(
        1).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_chunks_are_numbered_without_texts(spark, tables):
    heads = bindings.spoken_heads(spark, tables)
    chunks = bindings.with_content(ranking.chunk_assignment(heads, "review_id", "reviews"), spark, tables)
    assert shuffled(chunks) < 2000 * 1000
    got = merge_queries.concat_chunks(spark, tables)
    assert got.count() == 2000 and got.agg(F.sum(F.length("content"))).first()[0] == 2000 * 3000


def test_review_pages_are_made_without_a_shuffle_of_texts(spark, tables):
    pages = project_queries.raw_review_pages(spark, tables)
    assert shuffled(pages) < 2000 * 1000
    got = project_queries.flatten_reviews(spark, tables)
    assert got.count() == 1600 and got.select(F.length(F.trim("content"))).agg(F.max("length(trim(content))")).first()[0] <= 3000


def test_review_pages_send_texts_whole_beyond_the_limit_of_spark(spark, tables, monkeypatch):
    """By the bytes of the texts; where these are too many, they are shuffled."""
    key, rows = "spark.sql.autoBroadcastJoinThreshold", lambda: project_queries.flatten_reviews(spark, tables)
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert shuffled(project_queries.raw_review_pages(spark, tables)) < 2000 * 1000
        got = rows().localCheckpoint()
        monkeypatch.setattr(bindings, "SENT_BYTES", 0)
        assert shuffled(project_queries.raw_review_pages(spark, tables)) > 2000 * 1000
        assert got.count() == 1600 and got.exceptAll(rows()).isEmpty()
    finally:
        spark.conf.set(key, before)


def test_texts_are_stored_compressed(spark, reviews, folder):
    raw = REVIEWS * CHARS
    files.write_csv(reviews.select("product_id", F.lit("n").alias("customer_name"), "rating", "content"), folder + "/csv")
    files.write_json_lines(reviews, folder + "/json")
    for kind in ("csv", "json"):
        assert size_of(f"{folder}/{kind}") < 0.6 * raw, kind
    assert files.read_json_lines(spark, folder + "/json", reviews.schema).exceptAll(reviews).isEmpty()
    read = files.read_csv(spark, folder + "/csv", "product_id bigint, customer_name string, rating int, content string")
    assert read.count() == REVIEWS and read.join(reviews.select("content"), "content").count() == REVIEWS
    stored = materialize(reviews, "texts")
    assert all(f.endswith(".zstd.parquet") or ".zstd." in f for f in (Path(p).name for p in stored.inputFiles()))
    base, kb = folder + "/kb", reviews.select(F.col("review_id").cast("string").alias("id"), "product_id", "content")
    merge.kb_rebuild(kb, base)
    assert all(".zstd." in Path(p).name for p in spark.read.parquet(base).inputFiles())


def test_cleaning_walks_a_text_a_few_times(spark):
    """The same as one replacement after another, in four passes of the matcher."""
    def plain(c):
        c = F.lower(F.coalesce(c, F.lit("")))
        for short, full in constants.ABBREVIATIONS:
            c = F.regexp_replace(c, f"(?:{short})(?![{constants.WORD}])(?<![{constants.WORD}](?:{short}))", full)
        c = F.regexp_replace(text._loose_marks_to_blanks(c), f"(?![a-z0-9 ])[^{constants.VIETNAMESE_LETTERS}{constants.WS}]", "")
        return F.trim(F.regexp_replace(c, f"[{constants.WS}]+", " "))

    rnd = random.Random(7)
    bits = [a for s, _ in constants.ABBREVIATIONS for a in s.split("|")] + [
        " ", "  ", "\t", "\n", "\xa0", ".", "/", "1", "_", "x", "é", "đ", "́", "", "", "-", "SP"]
    df = spark.createDataFrame([("".join(rnd.choices(bits, k=rnd.randrange(14))),) for _ in range(5000)] + [(None,)], "t string")
    assert df.filter(~plain(F.col("t")).eqNullSafe(text.clean_review_text(F.col("t")))).isEmpty()
    assert str(text.clean_review_text(F.col("t"))._jc.toString()).count("regexp_replace(") <= 4


def test_cleaning_leaves_no_pattern_to_the_matcher_of_java(spark, monkeypatch):
    """Whatever the slices of a batch; a letter beyond the first plane is a letter of its word, as in SQL."""
    assert "regexp" not in str(text.clean_review_text(F.col("t"))._jc.toString())
    rows = ["\U0001d41asp", "sp sp sp", "1.2/3.x", None, "", "KO  thanks\u3000đc!"] * 3
    for size in (1, 20, 1 << 20):
        assert [*text._cleaned.func(pd.Series([(r or "").lower() for r in rows]))] == [
            "sp", "sản phẩm sản phẩm sản phẩm", "123 x", "", "", "không cảm ơn được"] * 3
        monkeypatch.setattr(text, "CLEANED_BYTES", size)
    assert text._cleaned.func(pd.Series([], dtype=object)).empty
    got = spark.createDataFrame([(r,) for r in rows], "t string").coalesce(1).select(text.clean_review_text(F.col("t")).alias("t"))
    assert [r.t for r in got.collect()][:3] == ["sp", "sản phẩm sản phẩm sản phẩm", "123 x"]


def test_files_of_splits_are_written_side_by_side(spark, folder, monkeypatch):
    """A task that sorts its texts by split spills them; files of a split may lie in any order."""
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.json
    monkeypatch.setattr(DataFrameWriter, "json", lambda self, path: (seen.append(int(spark.conf.get(key))), write(self, path))[1])
    rows = spark.range(90).select(F.col("id").cast("string").alias("text"), *[F.lit("none").alias(a) for a in constants.ASPECTS], F.element_at(
        F.array(*map(F.lit, ("train", "dev", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("split")).coalesce(1)
    before = spark.conf.get(key)
    files.write_dataset(rows, folder, "v2")
    assert seen[0] >= 3 and spark.conf.get(key) == before
    got = files.read_dataset(spark, folder)
    assert got.count() == 90 and got.select("text", "split").exceptAll(rows.select("text", "split")).isEmpty()


def test_a_user_has_one_timer(spark):
    """However many sessions are open, the first end alone is set; what has ended by then comes out at once."""
    minute = 60_000_000

    class Handle:
        kept, timers, calls = [], set(), 0

        def getListState(self, *_):
            return self

        def exists(self):
            return bool(self.kept)

        def get(self):
            return iter(self.kept)

        def put(self, rows):
            self.kept = list(rows)

        def clear(self):
            self.kept = []

        def registerTimer(self, at):
            self.timers.add(at)
            self.calls += 1

        def deleteTimer(self, at):
            self.timers.discard(at)

    class Times:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

        getExpiryTimeInMs = getCurrentWatermarkInMs

    handle, sessions = Handle(), keyed.Sessions(30 * minute)
    sessions.init(handle)
    list(sessions.handleInputRows((1,), iter([pd.DataFrame({"at": [i * 60 * minute for i in range(100)]})]), Times(0)))
    assert len(handle.kept) == 100 and handle.timers == {30 * 60_000} and handle.calls == 1
    out = list(sessions.handleExpiredTimer((1,), Times(50 * 3_600_000), Times(30 * 60_000)))
    assert len(out) == 1 and len(out[0]) == 50 and len(handle.kept) == 50 and handle.calls == 2


class _Values:
    """State variables of one key, in memory."""

    def __init__(self):
        self.value, self.rows = None, []

    def getValueState(self, *_):
        return self

    def getListState(self, *_):
        return _Values()

    def exists(self):
        return self.value is not None or bool(self.rows)

    def get(self):
        return self.value if self.value is not None else iter(self.rows)

    def update(self, value):
        self.value = value

    def put(self, rows):
        self.rows = list(rows)


def test_a_product_is_one_frame():
    """What a product puts out comes in one frame, and a scan without a change in none."""
    job, rows = knowledge_base.ProductReviews(), []
    job.init(_Values())
    for i, (overall, content, rating) in enumerate([("positive", "long one", 5.0), ("negative", "x", None), ("neutral", None, 3.0)]):
        rows.append((7, i, rating, overall, content, "f.csv", *[1] * len(knowledge_base.FIGURES)))
    part = pd.DataFrame(rows, columns=[c.split()[0] for c in knowledge_base.NEW.split(", ")])
    (out,) = job.handleInputRows((7,), iter([part]), None)
    assert list(zip(out["kind"], out["rank"], out["review_id"], out["rating"])) == [
        ("new", None, 0, 5), ("new", None, 1, None), ("new", None, 2, 3), ("figures", None, None, None),
        ("review", 1, 0, 5), ("review", 1, 1, None)]
    assert list(out["n_reviews"]) == [1, 1, 1, 3, None, None]
    counts = keyed.Counts()
    counts.init(_Values())
    scans = lambda *x: iter([pd.DataFrame(x, columns=["product_id", "scan", "review_count"])])
    (found,) = counts.handleInputRows((7,), scans((7, 2, 5), (7, 1, 5), (7, 3, 6)), None)
    assert found.values.tolist() == [[7, 1, -1, 5], [7, 3, 5, 6]]
    assert list(counts.handleInputRows((7,), scans((7, 4, 6)), None)) == []


def test_counts_are_told_by_rows(spark, folder):
    """No frame for a product; a count that stays the same is not written again."""
    counts = keyed.CountRows()
    counts.init(_Values())
    scans = lambda *x: iter([Row(product_id=7, scan=s, review_count=n) for s, n in x])
    assert [tuple(r) for r in counts.handleInputRows((7,), scans((2, 5), (1, 5), (3, 6)), None)] == [(7, 1, -1, 5), (7, 3, 5, 6)]
    counts.known.update = None
    assert list(counts.handleInputRows((7,), scans((4, 6)), None)) == []
    spark.createDataFrame([(1, 1, 4), (2, 1, 0)], "product_id bigint, scan bigint, review_count bigint").write.parquet(folder + "/in")
    with jobs.rocksdb(spark):
        plan = keyed.changes(jobs.read(spark, folder + "/in", "product_id bigint, scan bigint, review_count bigint"))
        assert "InPySpark" in plan._jdf.queryExecution().analyzed().toString()
    got = keyed.count_changes(jobs.read(spark, folder + "/in", "product_id bigint, scan bigint, review_count bigint"), folder)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, -1, 4), (2, 1, -1, 0)]


def test_figures_of_a_product_are_one_column(spark):
    """Every column of a frame costs more than the few rows of a product."""
    job = knowledge_base.ProductReviews()
    job.init(_Values())
    row = (7, 1, 5, "positive", "good", "f.csv", *range(len(knowledge_base.FIGURES)))
    (out,) = job.handleInputRows((7,), iter([pd.DataFrame([row], columns=[c.split()[0] for c in knowledge_base.NEW.split(", ")])]), None)
    sent = [c.split()[0] for c in knowledge_base._PACKED.split(", ")]
    assert len(sent) < 10 and set(sent) <= set(out.columns)
    assert [x and list(x) for x in out["packed"]] == [[*range(len(knowledge_base.FIGURES))]] * 2 + [None]


def test_rare_terms_are_not_shuffled(spark):
    """A few words fill the vocabulary; the many words and pairs of one document each stay where they are."""
    rnd = random.Random(5)
    texts = [" ".join([*rnd.choices(["alpha", "beta", "gamma"], k=40), *(f"rare{i}x{j}" for j in range(200))]) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").localCheckpoint()
    assert shuffled(learning.tfidf_features(docs, 5)) < 100 * 200 * 8


@pytest.mark.parametrize("classes", [1, 7, 1 << 20])
def test_frequent_terms_are_exact(spark, classes):
    """Also where rare terms share their class with frequent ones, and counts are equal at the cut."""
    words = [w for i in range(60) for w in [f"w{i:02}"] * (1 + i // 4)]
    listed = spark.createDataFrame([(w,) for w in words], "term string")
    want = sorted(collections.Counter(words).items(), key=lambda x: (-x[1], x[0]))
    for k in (2, 9, 100):
        got = sorted((r.place, r.term, r.total) for r in learning.frequent_terms(listed, k, classes).collect())
        assert got == [(i + 1, *x) for i, x in enumerate(want[:k])]


def test_postings_are_shuffled_once(spark, folder, monkeypatch):
    """A text comes to the task of its block; what is stored of a posting is its document, count and length."""
    rnd = random.Random(7)
    docs = spark.createDataFrame([(i, " ".join(rnd.choices([f"word{j}" for j in range(900)], k=300))) for i in range(600)], "id bigint, text string")
    monkeypatch.setattr(lexical_index, "BLOCK_DOCUMENTS", 100)
    written, whole = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (written.append(path), whole(self, path, *a, **k))[1])
    lexical_index.build(docs.localCheckpoint(), folder)
    monkeypatch.undo()
    assert sorted(p.rsplit("/", 1)[1] for p in written) == ["blocks", "figures", "terms"]
    assert size_of(f"{folder}/blocks") < 8 * spark.read.parquet(f"{folder}/blocks").agg(F.sum(F.size("documents"))).first()[0]


def test_texts_meet_the_shown_reviews_alone(spark):
    """Also where ids of texts repeat, with the same text or another, and where a text is NULL or missing."""
    rnd = random.Random(11)
    said = [(i, "".join(rnd.choices("abcdefgh ", k=CHARS + i))) for i in range(20)]
    texts = spark.createDataFrame([*said, said[3], (4, "z" * 700), (5, None), (6, "")], "doc_id bigint, content string").localCheckpoint()
    label = [[("price", "positive")], [("price", "negative")], [], [("price", "neutral")]]
    named = spark.createDataFrame(
        [(i, i % 7, 1 + i % 5, label[i % 11 % 4], i % 23) for i in range(REVIEWS)],
        f"product_id bigint, review_id bigint, rating int, label {LABEL}, doc_id bigint").withColumns(
        {"review_id": F.col("product_id"), "product_id": F.col("review_id")}).localCheckpoint()
    late, early = documents.top_reviews_by_text(named, texts, 50), documents.top_reviews(named.join(texts, "doc_id"), 50)
    of = lambda df: sorted((r.product_id, r.position, r.review_id, r.rating, r.overall, r.content or "") for r in df.collect())
    assert of(late) == of(early) and late.count() > 30


def test_base_documents_copy_no_text(spark):
    """A text is shuffled at most once, cut, however many reviews it has."""
    texts = spark.createDataFrame([(i, str(i) * CHARS) for i in range(4)], "doc_id bigint, content string").localCheckpoint()
    named = spark.createDataFrame([(i, i, 5, [("price", "positive")], i % 4) for i in range(2000)],
                                  f"product_id bigint, review_id bigint, rating int, label {LABEL}, doc_id bigint").localCheckpoint()
    assert shuffled(documents.top_reviews_by_text(named, texts, 600)) < 2000 * 600 / 2 < shuffled(
        documents.top_reviews(named.join(texts, "doc_id"), 600))


def test_a_text_is_cut_into_tokens_once(spark):
    df = spark.createDataFrame([("một hai ba",), ("x y",), ("một",), (None,)], "text string")
    cut = df.select(learning.grams(F.col("text")).alias("g"))
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert [r.g for r in cut.collect()] == [["một", "hai", "ba", "một hai", "hai ba"], [], ["một"], []]


def test_models_are_fitted_side_by_side(spark):
    """Every fit of a size of the vocabulary waits for all others."""
    data = learning.with_grams(spark.createDataFrame(
        [(f"tốt đẹp w{i}" if i % 2 else f"xấu tệ w{i}", 2 if i % 2 else 0, "dev" if i % 5 == 0 else "train") for i in range(40)],
        "text string, quality int, split string"))
    fits = threading.Barrier(2, timeout=60)

    def fit(rows, target, c):
        fits.wait()
        return learning.fit_logreg(rows, target, c)

    runs, _ = learning.grid_search(data, ["quality"], fit, {"max_features": [50], "c": [0.1, 1.0]})
    assert [r.settings for r in runs.collect()] == [str({"max_features": 50, "c": c}) for c in (0.1, 1.0)]
