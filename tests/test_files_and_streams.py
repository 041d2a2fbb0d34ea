"""Sources, sinks and streaming jobs."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from reviewloom.operators import documents, scores
from reviewloom.sources import files
from reviewloom.streaming import jobs, keyed, knowledge_base

LABEL = "array<struct<aspect:string,sentiment:string>>"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def put(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_csv(spark, folder):
    data = [(1, "a, b", 5, 'say "hi"\nnext', dt.datetime(2024, 1, 2, 3, 4, 5)), (2, "é", None, " x ", None)]
    df = spark.createDataFrame(data, files.RAW_REVIEW)
    files.write_csv(df, folder)
    assert rows(files.read_csv(spark, folder, files.RAW_REVIEW), *df.columns) == rows(df, *df.columns)


def test_interactions(spark, folder):
    line = '{"timestamp":"2024-01-01T00:00:00","question":"q%d","answer":"a","contexts":%s,"sources":[],"latency_ms":1,"n_docs":1}'
    put(spark, folder, *[line % (i, '["c"]' if i % 2 else "[]") for i in range(9)], "{broken", "")
    assert files.read_interactions(spark, folder, least=10).count() == 0
    put(spark, folder, line % (9, '["c"]'))
    assert files.read_interactions(spark, folder).count() == 5


def test_ids_and_json(spark, folder):
    put(spark, folder + "/ids", "5", " 3 ", "", "5")
    assert rows(files.read_id_list(spark, folder + "/ids"), "product_id") == [(3,), (5,)]
    files.write_id_list(files.read_id_list(spark, folder + "/ids"), folder + "/out")
    assert [r.value for r in spark.read.text(folder + "/out").collect()] == ["3", "5"]
    put(spark, folder + "/array", '[{"text":"a","price":"none"},', '{"text":"b","price":"positive"}]')
    assert rows(files.read_json_array(spark, folder + "/array", files.DATASET), "text", "price") == [("a", "none"), ("b", "positive")]


def test_pending_and_latest(spark):
    names = lambda *n: spark.createDataFrame([(x, i) for i, x in enumerate(n)], "path string, modified int")
    up, down = names("raw/reviews_20240101.csv", "raw/reviews_20240102.csv", "raw/x.csv"), names("clean/reviews_clean_20240101.csv")
    assert rows(files.pending_files(up, down), "day") == [("20240102",)]
    assert files.latest_snapshot(up).first().path == "raw/x.csv"
    assert files.latest_snapshot(up.limit(0)).count() == 0


def test_archive(spark, folder):
    """Files move after the batch that read them, nothing is read twice, and files of one name are kept apart."""
    inbox, done = f"{folder}/in", f"{folder}/done"
    names = lambda path: {f.rpartition("/")[2] for f in spark.read.schema("id bigint").parquet(path).inputFiles()}
    for k in range(3):
        spark.range(k * 10, k * 10 + 3).coalesce(1).write.mode("append").parquet(inbox)
        held = names(inbox)
        assert rows(jobs.consume(spark, inbox, "id bigint", done, f"{folder}/job"), "id") == sorted(
            [(i,) for x in range(k + 1) for i in range(x * 10, x * 10 + 3)], key=str)
        assert held <= names(jobs.archived(done, inbox)) and not held & names(inbox)
    for k in range(2):  # files of one name in two folders
        spark.range(1).coalesce(1).write.parquet(f"{folder}/other{k}/same.parquet")
        assert jobs.consume(spark, f"{folder}/other{k}/same.parquet", "id bigint", done, f"{folder}/job{k}").count() == 1
    assert all(spark.read.parquet(jobs.archived(done, f"{folder}/other{k}/same.parquet")).count() == 1 for k in range(2))


PRODUCT = ("product_id bigint, name string, brand_name string, category_name string, price bigint, rating_average double, "
           "review_count bigint, product_url string, short_description string")
REVIEW = f"review_id bigint, product_id bigint, rating int, content string, label {LABEL}, source_file string"


def review(i, pid, content, sentiment="positive", file="a"):
    return (i, pid, 5, content, [{"aspect": "price", "sentiment": sentiment}] if sentiment else [], file)


def products(spark, n=4):
    return spark.createDataFrame([(p, f"n{p}", "b", "c", 1, 4.0, 1, "u", "<p>text</p>") for p in range(n)], PRODUCT)


def feed(spark, folder, parts, **options):
    for part in parts:
        spark.createDataFrame(part, REVIEW).coalesce(1).write.mode("append").parquet(folder + "/in")
    return jobs.read(spark, folder + "/in", REVIEW, **options)


def test_kb_update(spark, folder):
    """Every kind of document, from the merged reviews; known reviews and repeated batches change nothing."""
    rounds = [
        [review(1, 0, "long and good"), review(2, 0, "bad", "negative"), review(3, 1, "fine"), review(9, 0, "bad", "positive", "b"),
         review(8, None, "nobody's"), review(7, 99, "of no product")],
        [review(3, 1, "fine"), review(4, 1, "fine"), review(5, 1, " "), review(6, 2, None, None), review(10, 0, "neither", "neutral")],
        [review(1, 0, "long and good"), review(5, 1, " ")]]
    kept = [rounds[0][0], rounds[0][1], rounds[0][2], rounds[1][2], rounds[1][3], rounds[1][4]]
    table = products(spark)
    whole = spark.createDataFrame(kept, REVIEW)
    for k, part in enumerate(rounds):
        kb = knowledge_base.update(feed(spark, folder, [part]), table, folder)
        if k == 1:
            before = rows(kb, *kb.columns)
    assert rows(kb, *kb.columns) == before
    det = documents.details(table, scores.aspect_scores_wide(whole)).filter("product_id < 3")
    want = documents.document_union(
        documents.product_cards(det), documents.aspect_summaries(det), documents.review_documents(det, documents.top_reviews(whole)),
        documents.new_review_documents(det, spark.createDataFrame([kept[2], kept[4], kept[5]], REVIEW).filter("review_id <> 3 OR product_id <> 1")))
    assert rows(kb, "id", "content") == rows(want, "id", "content")
    assert {r.doc_type for r in kb.collect()} == {"product_card", "aspect_summary", "review", "new_review"}


def test_kb_update_keeps_the_longest(spark, folder):
    """More reviews than a product shows, over several batches, with ties in length."""
    rng = random.Random(1)
    told = [review(i, 0, f"{'x' * rng.randint(1, 30)}{i:03}", rng.choice(["positive", "negative", "neutral"])) for i in range(300)]
    kb = knowledge_base.update(feed(spark, folder, [told[:200], told[200:]], maxFilesPerTrigger="1"), products(spark, 1), folder)
    det = documents.details(products(spark, 1), scores.aspect_scores_wide(spark.createDataFrame(told, REVIEW)))
    want = documents.review_documents(det, documents.top_reviews(spark.createDataFrame(told, REVIEW)))
    assert rows(kb.filter("doc_type = 'review'"), "id", "content") == rows(want, "id", "content")


def test_kb_update_work_follows_the_batch(spark, folder):
    """The 19th batch writes as much state as the second, and reads its own rows only."""
    parts = [[review(10 * k + j, j, f"text {k} {j}", None) for j in range(3)] for k in range(20)]
    stream = feed(spark, folder, parts, maxFilesPerTrigger="1")
    with jobs.rocksdb(spark):
        job = knowledge_base.changed_products(stream, buckets=4).writeStream.foreachBatch(lambda batch, i: batch.count()).option(
            "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        job.awaitTermination()
    done = [p for p in job.recentProgress if p["numInputRows"]]
    work = [(p["numInputRows"], [o["numRowsUpdated"] for o in p["stateOperators"]]) for p in done]
    assert len(work) == 20 and len({str(w) for w in work[1:]}) == 1


def test_repeated_batch_changes_nothing(spark, folder):
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    for _ in range(2):
        jobs.write_batch(df, folder, 0)
    jobs.write_batch(spark.createDataFrame([(1, "b")], df.schema), folder, 1)
    back = jobs.read_batches(spark, folder, "k bigint, v string")
    assert rows(jobs.newest(back, ["k"]), "k", "v") == [(1, "b")]
    assert rows(jobs.read_batches(spark, folder, "k bigint, v string", 1), "v") == [("a",)]
    assert jobs.read_batches(spark, folder + "/none", "k bigint, v string").count() == 0


def test_count_changes(spark, folder):
    schema = "product_id bigint, scan bigint, review_count bigint"
    for part in ([(1, 1, 5), (2, 1, 3)], [(1, 2, 5), (2, 2, None), (2, 3, 4), (3, 3, 0)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder + "/in")
        changes = keyed.count_changes(jobs.read(spark, folder + "/in", schema), folder)
    assert rows(changes, "product_id", "scan", "previous_count", "current_count") == [
        (1, 1, -1, 5), (2, 1, -1, 3), (2, 3, 3, 4), (3, 3, -1, 0)]


MESSAGE = "conv_id bigint, turn bigint, role string, content string, product_id bigint"


def message(t, p=None, conv=1):
    return (conv, t, "user", f"m{t}", p)


def test_session_history(spark, folder):
    """Histories of two batches, out of order; a batch adds its messages to the state and no others."""
    parts = ([message(t) for t in (5, 3, 1)] + [message(0, 7)] + [message(t) for t in range(6, 12)] + [message(1, conv=2)],
             [message(12), message(2, 9), message(13), (None, 1, "user", "x", None)])
    for part in parts:
        spark.createDataFrame(part, MESSAGE).write.mode("append").parquet(folder + "/in")
        history = keyed.session_history(jobs.read(spark, folder + "/in", MESSAGE), folder)
    got = rows(history.filter("conv_id = 1"), "turn", "product_id")
    assert [t for t, _ in sorted(got)] == list(range(6, 14)) and sorted(got)[-1] == (13, 9)
    told = keyed.state(spark, folder, "history", "told").select("key.conv_id", "list_element.*")
    assert told.filter("conv_id = 1").count() == 8 + 3  # what the second batch found stays, its three messages are added
    spoken = keyed.state(spark, folder, "history", "product").select("key.conv_id", "value.*")
    assert rows(spoken, "conv_id", "product_id", "turn") == [(1, 9, 2)]


def test_state_expires(spark, folder):
    """With a time to live a conversation that got no message is forgotten."""
    seen = {}
    told = lambda batch, i: seen.update({r.turn: (r.product_id, r.told) for r in batch.withColumn("told", F.lit(i)).collect()})

    def until(turn):
        for _ in range(300):
            if turn in seen:
                return
            time.sleep(0.1)

    spark.createDataFrame([message(1, 7)], MESSAGE).write.parquet(folder + "/in")
    with jobs.rocksdb(spark):
        job = keyed.histories(jobs.read(spark, folder + "/in", MESSAGE), ttl_ms=500).writeStream.foreachBatch(told).option(
            "checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="1 second").start()
        until(1)
        first = seen.pop(1)
        time.sleep(1.5)
        spark.createDataFrame([message(2)], MESSAGE).write.mode("append").parquet(folder + "/in")
        until(2)
        job.stop()
    assert first[0] == 7 and set(seen) == {2} and seen[2][0] is None


def test_chat_sessions(spark, folder):
    """Out-of-order events merge sessions, late ones are dropped, timers close, and the open tail is flagged."""
    at = lambda m, u=1: (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), u)
    schema = "ts timestamp, user_id bigint"
    rounds = [[at(0), at(38), at(5), at(3, 2)],  # two sessions of user 1, the watermark at 28
              [at(30), at(60, 2), (None, 1), at(1, None)],  # between the two: they are one
              [at(300, 3), at(310, 3)],  # all others end
              [at(200, 4), at(305, 3)]]  # user 4 comes too late
    for part in rounds:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        got = keyed.chat_sessions(jobs.read(spark, folder + "/in", schema), folder)
    told = sorted((r.user_id, r.session_start.hour * 60 + r.session_start.minute, r.session_end.hour * 60 + r.session_end.minute, r.events, r.open)
                  for r in got.collect())
    assert told == [(1, 0, 68, 4, False), (2, 3, 33, 1, False), (2, 60, 90, 1, False), (3, 300, 340, 3, True)]
    assert rows(keyed.state(spark, folder, "sessions", "open").select("key.user_id"), "user_id") == [(3,)]
    spark.createDataFrame([at(2000, 5), at(2001, 5)], schema).write.mode("append").parquet(folder + "/in")
    keyed.chat_sessions(jobs.read(spark, folder + "/in", schema), folder)
    assert rows(keyed.state(spark, folder, "sessions", "open").select("key.user_id"), "user_id") == [(5,)]


def test_dedup_and_late(spark, folder):
    day = lambda d: dt.datetime(2024, 1, d)
    schema = "k bigint, created_at timestamp"
    for part in ([(1, day(1)), (1, day(1)), (2, day(2))], [(2, day(2)), (3, day(3))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = jobs.read(spark, folder + "/in", schema, maxFilesPerTrigger="1")
    assert rows(jobs.run(jobs.dedup(stream, ["k"]), folder, name="dedup"), "k") == [(1,), (2,), (3,)]
    late = jobs.run(jobs.late_filter(stream, day(2)), folder, name="late")
    assert rows(late, "k") == [(2,), (2,), (3,)]


def test_clean_stream_equals_batch(spark, folder):
    df = spark.createDataFrame([("SP tốt",), ("...",), (None,)], "content string")
    df.write.parquet(folder + "/in")
    out = jobs.run(jobs.ingest_reviews(jobs.read(spark, folder + "/in", "content string")), folder)
    assert rows(out, "clean_content") == [("sản phẩm tốt",)]
    assert rows(jobs.ingest_reviews(df), "clean_content") == [("sản phẩm tốt",)]
