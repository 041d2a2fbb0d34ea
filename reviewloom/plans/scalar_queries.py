"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ABBREVIATIONS, ASPECTS, BOILERPLATE, INTENTS, FOLLOWUP_HINTS, VIETNAMESE_LETTERS, WORD, WS
from ..functions import chat_rules, identifiers, labels, numbers, text, vectors
from ..operators import scores
from . import bindings as b
from .registry import query
from .score_queries import satisfaction, wide_scores

# --- text, as SQL ------------------------------------------------------------
_KEPT_DOT, _KEPT_SLASH = "\ue000", "\ue001"


def sql_collapse(e):
    return f"trim(regexp_replace({e}, '[{WS}]+', ' ', 'g'))"


def sql_strip(e):
    return f"regexp_replace({e}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _sql_marks(e):
    """Marks between digits are set aside, the others become blanks."""
    for mark, kept in ((".", _KEPT_DOT), ("/", _KEPT_SLASH)):
        for _ in range(2):
            e = rf"regexp_replace({e}, '(\p{{Nd}})\{mark}(\p{{Nd}})', '\1{kept}\2', 'g')"
        e = f"replace({e}, '{mark}', ' ')"
    return e


def sql_clean_review(e):
    e = f"lower(coalesce({e}, ''))"
    for short, full in ABBREVIATIONS:
        for _ in range(2):
            e = rf"regexp_replace({e}, '(^|[^{WORD}])(?:{short})([^{WORD}]|$)', '\1{full}\2', 'g')"
    return sql_collapse(f"regexp_replace({_sql_marks(e)}, '[^a-z0-9{VIETNAMESE_LETTERS}{WS}]', '', 'g')")


def sql_clean_label(e):
    kept = f"regexp_replace({_sql_marks(f'lower(coalesce({e}, {chr(39) * 2}))')}, " \
           f"'[^a-z0-9{VIETNAMESE_LETTERS}{WS}{_KEPT_DOT}{_KEPT_SLASH}]', '', 'g')"
    return sql_collapse(f"replace(replace({kept}, '{_KEPT_DOT}', '.'), '{_KEPT_SLASH}', '/')")


def sql_unescape(e):
    """The entities that occur in the pages."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        e = f"regexp_replace({e}, '&{name};?', '{char}', 'g')"
    return e


def sql_clean_html(e):
    return sql_collapse(f"regexp_replace({sql_unescape(f'coalesce({e}, {chr(39) * 2})')}, '<[^>]+>', ' ', 'g')")


def sql_quote(s):
    return "'" + s.replace("'", "''") + "'"


@query("clean_review_text", f"SELECT doc_id, {sql_clean_review('text')} AS clean_content FROM documents")
def clean_review_text(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_review_text(F.col("text")).alias("clean_content"))


@query("clean_label_text", f"SELECT doc_id, {sql_clean_label('text')} AS normalized_content FROM documents")
def clean_label_text(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_label_text(F.col("text")).alias("normalized_content"))


@query("clean_html_text", f"SELECT page_id, {sql_clean_html('html')} AS text FROM pages")
def clean_html_text(spark, sf_dir):
    return b.text_table(spark, sf_dir, "pages").select("page_id", text.clean_html_text(F.col("html")).alias("text"))


def sql_html_text(e):
    hidden = "(?is)<!doctype[^>]*>|<!--.*?-->|<script.*?</script>|<style.*?</style>|<template.*?</template>"
    bare = f"regexp_replace({e}, '{hidden}', ' ', 'g')"
    return sql_collapse(sql_unescape(f"regexp_replace({bare}, '<[^>]+>', ' ', 'g')"))


def sql_boilerplate(e):
    for phrase in BOILERPLATE:
        e = f"replace({e}, '{phrase}', '')"
    return e


@query("html_to_text", f"SELECT page_id, {sql_html_text('html')} AS text FROM pages")
def html_to_text(spark, sf_dir):
    return b.text_table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query("strip_boilerplate", f"SELECT doc_id, {sql_collapse(sql_boilerplate('text'))} AS text FROM documents")
def strip_boilerplate(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select("doc_id", text.strip_boilerplate(F.col("text")).alias("text"))


def sql_compact(e, limit):
    return (f"CASE WHEN length({sql_strip(e)}) > {limit} THEN regexp_replace(substring({sql_strip(e)}, 1, {limit}), "
            f"'[{WS}]+$', '') || chr(10) || '...[đã rút gọn]' ELSE {sql_strip(e)} END")


@query("truncate_text", f"""SELECT doc_id, substring(text, 1, 200) AS sample, {sql_compact('text', 1200)} AS user_text,
    {sql_compact('text', 2500)} AS assistant_text FROM documents""")
def truncate_text(spark, sf_dir):
    c = F.col("text")
    return b.text_table(spark, sf_dir, "documents").select(
        "doc_id", F.substring(c, 1, 200).alias("sample"), text.compact_text(c, 1200).alias("user_text"),
        text.compact_text(c, 2500).alias("assistant_text"))


@query("word_count", f"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[{WS}]+'), lambda w: w <> '')) "
                     "AS INTEGER) AS words FROM documents")
def word_count(spark, sf_dir):
    return b.text_table(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("words"))


# --- numbers and times ---------------------------------------------------------
@query("format_price", """SELECT p_partkey AS product_id,
    replace(format('{:,}', CAST(trunc(p_retailprice * 1000) AS BIGINT)), ',', '.') || 'đ' AS price_text FROM part""")
def format_price(spark, sf_dir):
    return b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), numbers.format_price(F.col("p_retailprice") * 1000).alias("price_text"))


def _raw_number():
    """Numbers as text, with the junk a raw payload holds."""
    return (F.when(F.col("event_type") == "error", "nan").when(F.col("event_type") == "signup", F.col("props"))
            .otherwise(F.col("value").cast("string")))


_RAW_NUMBER = ("CASE event_type WHEN 'error' THEN 'nan' WHEN 'signup' THEN props ELSE CAST(value AS VARCHAR) END")
_NUMBER = f"try_cast(nullif({_RAW_NUMBER}, 'nan') AS DOUBLE)"


@query("safe_int", f"SELECT event_id, CAST(trunc({_NUMBER}) AS BIGINT) AS number FROM events")
def safe_int(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", numbers.safe_int(_raw_number()).alias("number"))


@query("safe_float", f"SELECT event_id, round_even({_NUMBER}, 2) AS number FROM events")
def safe_float(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", numbers.safe_float(_raw_number()).alias("number"))


@query("parse_timestamp", """
    SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts) WHEN 'view' THEN ts END AS created_at,
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN 'error' THEN 'not a date' ELSE '' END AS created_text
    FROM events""")
def parse_timestamp(spark, sf_dir):
    kind = F.col("event_type")
    raw = (F.when(kind == "click", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("string"))
           .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
           .when(kind == "error", "not a date"))
    return b.table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select(
        "event_id", numbers.parse_timestamp(F.col("raw")).cast("timestamp_ntz").alias("created_at"),
        numbers.timestamp_text(F.col("raw")).alias("created_text"))


# --- ids -------------------------------------------------------------------------
@query("extract_product_id", b.sql(["chat"], rf"""
    SELECT 'page' AS kind, page_id AS id, 0::BIGINT AS turn, coalesce(
        nullif(regexp_extract(url, '-p([0-9]+)', 1), ''), nullif(regexp_extract(url, 'product[_/]?([0-9]+)', 1), ''),
        nullif(regexp_extract({sql_strip('url')}, '^([0-9]+)$', 1), '')) AS product_id FROM pages
    UNION ALL SELECT 'chat', conv_id, turn, nullif(regexp_extract(text, '(?:-p|pid=)([0-9]+)', 1), '') FROM chat"""))
def extract_product_id(spark, sf_dir):
    pages = b.text_table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.lit(0).cast("bigint").alias("turn"),
        identifiers.extract_product_id(F.col("url")).alias("product_id"))
    chats = b.chat(spark, sf_dir).select(
        F.lit("chat").alias("kind"), F.col("conv_id").alias("id"), "turn",
        identifiers.extract_chat_product_id(F.col("text")).alias("product_id"))
    return pages.unionByName(chats)


@query("extract_urls", b.sql(["chat"], r"""
    SELECT conv_id, turn, regexp_extract(text, '(https?://(?:www\.)?shop\.example\.com/\S+)', 1) AS url FROM chat
    WHERE regexp_extract(text, '(https?://(?:www\.)?shop\.example\.com/\S+)', 1) <> ''"""))
def extract_urls(spark, sf_dir):
    return b.chat(spark, sf_dir).select(
        "conv_id", "turn", identifiers.extract_url(F.col("text"), "shop.example.com").alias("url")
    ).filter("url IS NOT NULL")


@query("delta_doc_id", b.sql(["reviews"], """
    SELECT review_id, 'prod_' || product_id || '_delta_review_' || substring(md5(product_id || '|' || content), 1, 16)
           AS doc_id FROM reviews"""))
def delta_doc_id(spark, sf_dir):
    return b.reviews(spark, sf_dir).select(
        "review_id", identifiers.delta_doc_id(F.col("product_id"), F.col("content")).alias("doc_id"))


@query("stable_point_id", """
    SELECT doc_id, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' ||
           format('{:x}', (('0x' || substring(h, 17, 1))::BIGINT & 3) | 8) || substring(h, 18, 3) || '-' ||
           substring(h, 21, 12) AS point_id
    FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(doc_id)) AS h
          FROM (SELECT 'prod_' || p_partkey || '_card' AS doc_id FROM part))""")
def stable_point_id(spark, sf_dir):
    doc_id = F.concat(F.lit("prod_"), F.col("p_partkey").cast("string"), F.lit("_card"))
    return b.table(spark, sf_dir, "part").select(doc_id.alias("doc_id")).withColumn(
        "point_id", identifiers.stable_point_id(F.col("doc_id")))


@query("query_cache_key", b.sql(["chat"], """
    SELECT DISTINCT 'emb:' || md5(text) AS cache_key, text FROM chat WHERE role = 'user'"""))
def query_cache_key(spark, sf_dir):
    users = b.chat(spark, sf_dir).filter("role = 'user'").select("text").distinct()
    return users.select(identifiers.query_cache_key(F.col("text")).alias("cache_key"), "text")


# --- labels ------------------------------------------------------------------------
_ITEMS = "concat_ws(';', " + ", ".join(f"'{a}=' || {a}" for a in ASPECTS) + ")"


def _items_text(label):
    return F.concat_ws(";", F.transform(label, lambda x: F.concat(x.aspect, F.lit("="), x.sentiment)))


def label_texts(spark, sf_dir):
    """Labels as text: JSON, Python literals or cut off, by review status."""
    json = F.to_json("label")
    raw = (F.when(F.col("status") == "F", json).when(F.col("status") == "O", F.replace(json, F.lit('"'), F.lit("'")))
           .otherwise(F.expr("left(to_json(label), length(to_json(label)) - 1)")))
    return b.labeled_heads(spark, sf_dir).select("review_id", raw.alias("label_text"))


@query("parse_label", b.sql(["labeled_heads"], f"""
    SELECT review_id, CASE WHEN status = 'P' THEN '' ELSE {_ITEMS} END AS items FROM labeled_heads"""))
def parse_label(spark, sf_dir):
    return label_texts(spark, sf_dir).select(
        "review_id", _items_text(labels.parse_label(F.col("label_text"))).alias("items"))


@query("label_to_columns", b.sql(["labeled_heads"], "SELECT review_id, " + ", ".join(
    f"coalesce({a}, 'none') AS {a}" for a in ASPECTS) + " FROM labeled_heads"))
def label_to_columns(spark, sf_dir):
    return b.labeled_heads(spark, sf_dir).select("review_id", *labels.label_to_columns(F.col("label")))


@query("normalize_label", b.sql(["labeled_heads"], "SELECT review_id, " + " || ';' || ".join(
    f"'{a}=' || coalesce({a}, 'neutral')" for a in ASPECTS) + " AS items FROM labeled_heads WHERE coalesce("
    + ", ".join(ASPECTS) + ") IS NOT NULL"))
def normalize_label(spark, sf_dir):
    untidy = F.transform("label", lambda x: F.struct(
        F.concat(F.lit(" "), F.upper(x.aspect)).alias("aspect"), x.sentiment.alias("sentiment")))
    fixed = labels.normalize_label(untidy)
    return b.labeled_heads(spark, sf_dir).select("review_id", fixed.alias("label")).filter(
        "label IS NOT NULL").select("review_id", _items_text(F.col("label")).alias("items"))


@query("make_label", b.sql(["labeled_heads"], "SELECT review_id, '[' || " + " || ', ' || ".join(
    f"'{{\"aspect\": \"{a}\", \"sentiment\": \"' || coalesce({a}, 'neutral') || '\"}}'" for a in ASPECTS)
    + " || ']' AS label FROM labeled_heads"))
def make_label(spark, sf_dir):
    columns = labels.label_to_columns(F.col("label"), "neutral")
    return b.labeled_heads(spark, sf_dir).select("review_id", *columns).select(
        "review_id", labels.make_label([F.col(a) for a in ASPECTS]).alias("label"))


def _sql_count(s):
    return "(" + " + ".join(f"coalesce(({a} = '{s}')::INT, 0)" for a in ASPECTS) + ")"


OVERALL_SQL = (f"CASE WHEN {_sql_count('positive')} > {_sql_count('negative')} THEN 'positive' "
               f"WHEN {_sql_count('negative')} > {_sql_count('positive')} THEN 'negative' ELSE 'neutral' END")


@query("overall_sentiment", b.sql(["labeled_heads"], f"SELECT review_id, {OVERALL_SQL} AS overall FROM labeled_heads"))
def overall_sentiment(spark, sf_dir):
    return b.labeled_heads(spark, sf_dir).select(
        "review_id", labels.overall_sentiment(F.col("label")).alias("overall"))


@query("label_code", b.sql(["label_items"], """
    SELECT review_id, l_linenumber, l_partkey, l_suppkey,
           CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 END::INTEGER AS code,
           sentiment FROM label_items"""))
def label_code(spark, sf_dir):
    return b.label_items(spark, sf_dir).select(
        "review_id", "item_no.*", labels.label_code(F.col("sentiment")).alias("code"),
        labels.code_label(labels.label_code(F.col("sentiment"))).alias("sentiment"))


_PCTS = """SELECT *, CAST(round_even(100 * pos / (pos + neu + neg), 0) AS INTEGER) AS pct_pos,
    CAST(round_even(100 * neg / (pos + neu + neg), 0) AS INTEGER) AS pct_neg
    FROM scores_long WHERE pos + neu + neg > 0"""
VERDICT_SQL = """CASE WHEN pct_pos >= 70 THEN 'đa số khen' WHEN pct_pos >= 50 THEN 'khá tích cực'
    WHEN pct_neg >= 50 THEN 'đa số chê' ELSE 'ý kiến trái chiều' END"""
b.add_view("score_percents", ["scores_long"], _PCTS)


@query("verdict_band", b.sql(["score_percents"], f"""
    SELECT product_id, aspect, pct_pos, pct_neg, {VERDICT_SQL} AS verdict FROM score_percents"""))
def verdict_band(spark, sf_dir):
    total = F.col("pos") + F.col("neu") + F.col("neg")
    return scores.wide_to_long(wide_scores(spark, sf_dir)).filter(total > 0).select(
        "product_id", "aspect", numbers.percent(F.col("pos"), total).alias("pct_pos"),
        numbers.percent(F.col("neg"), total).alias("pct_neg")
    ).withColumn("verdict", labels.verdict_band(F.col("pct_pos"), F.col("pct_neg")))


_COUNTS = "pct || '% hài lòng (' || pos || ' khen / ' || neg || ' chê)'"
REPORT_MARK_SQL = "CASE WHEN total = 0 THEN '❓' WHEN pct >= 70 THEN '✅' WHEN pct >= 40 THEN '⚠️' ELSE '❌' END"
REPORT_NOTE_SQL = f"""(CASE WHEN total = 0 THEN 'Chưa có đánh giá' WHEN pct >= 40 THEN {_COUNTS}
    ELSE 'Chỉ ' || {_COUNTS} END || CASE WHEN total > 0 AND total < 5 THEN ' · ⚠️ mẫu nhỏ' ELSE '' END)"""


@query("report_band", b.sql(["satisfaction"], f"""
    SELECT product_id, aspect, {REPORT_MARK_SQL} AS mark, {REPORT_NOTE_SQL} AS note FROM satisfaction"""))
def report_band(spark, sf_dir):
    band = labels.report_band(*[F.col(c) for c in ("pct", "pos", "neg", "total")])
    return satisfaction(spark, sf_dir).select("product_id", "aspect", band.alias("s")).select(
        "product_id", "aspect", "s.*")


# Labelling batches of 50 reviews; a partly answered batch starts with status P.
_LABEL_BATCH = 50


@query("parse_label_response", b.sql(["labeled_heads"], f"""
    SELECT review_id, CASE WHEN first(status ORDER BY review_id) OVER w = 'P' AND max(review_id) OVER w > min(review_id) OVER w
           THEN NULL ELSE {_ITEMS} END AS items
    FROM labeled_heads WINDOW w AS (PARTITION BY review_id // {_LABEL_BATCH})"""))
def parse_label_response(spark, sf_dir):
    batches = b.labeled_heads(spark, sf_dir).select(
        F.floor(F.col("review_id") / _LABEL_BATCH).alias("batch"), "review_id", "status",
        F.to_json(F.struct(F.col("label").alias("aspect_sentiments"))).alias("entry"),
    ).groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("review_id", "status", "entry"))).alias("rows"))
    entries = F.transform("rows", lambda r: r.entry)
    cut = (F.col("rows")[0]["status"] == "P") & (F.size("rows") > 1)
    answered = F.when(cut, F.slice(entries, 1, F.size(entries) - 1)).otherwise(entries)
    reply = F.concat(F.lit("Kết quả:\n["), F.array_join(answered, ",\n"), F.lit("]\nHết."))
    parsed = labels.parse_label_response(reply, F.size("rows"))
    return batches.select("rows", parsed.alias("labels")).select(
        F.explode(F.arrays_zip("rows", "labels")).alias("z")
    ).select(F.col("z.rows.review_id").alias("review_id"),
             F.when(F.col("z.labels").isNotNull(), _items_text(F.col("z.labels"))).alias("items"))


# Spelling batches of 20 texts; the reply leaves out the last text of batches
# that end in an English document.
_SPELL_BATCH = 20


@query("realign_batch_lines", f"""
    WITH lines AS (SELECT doc_id, lang, {sql_clean_label('text')} AS line FROM documents)
    SELECT doc_id, CASE WHEN doc_id = max(doc_id) OVER w AND lang = 'en' AND count(*) OVER w > 1
           THEN line ELSE upper(line) END AS line
    FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY doc_id // {_SPELL_BATCH})""")
def realign_batch_lines(spark, sf_dir):
    lines = b.text_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", text.clean_label_text(F.col("text")).alias("line")).filter("line <> ''")
    batches = lines.groupBy(F.floor(F.col("doc_id") / _SPELL_BATCH).alias("batch")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "lang", "line"))).alias("rows"))
    cut = (F.element_at("rows", -1)["lang"] == "en") & (F.size("rows") > 1)
    kept = F.when(cut, F.slice("rows", 1, F.size("rows") - 1)).otherwise(F.col("rows"))
    numbered = F.transform(kept, lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), F.upper(r.line)))
    answer = labels.realign_batch_lines(F.array_join(numbered, "\n\n"), F.transform("rows", lambda r: r.line))
    return batches.select("rows", answer.alias("lines")).select(
        F.explode(F.arrays_zip("rows", "lines")).alias("z")
    ).select(F.col("z.rows.doc_id").alias("doc_id"), F.col("z.lines").alias("line"))


# --- chat rules ------------------------------------------------------------------------
def sql_contains(e, hints):
    return "(" + " OR ".join(f"contains(lower({e}), '{h}')" for h in hints) + ")"


INTENT_SQL = "CASE " + " ".join(
    f"WHEN {sql_contains('text', hints)} THEN '{name}'" for name, hints in INTENTS) + " ELSE 'general_qa' END"
FOLLOWUP_SQL = sql_contains("text", FOLLOWUP_HINTS)


@query("detect_intent", b.sql(["chat"], f"SELECT conv_id, turn, {INTENT_SQL} AS intent FROM chat WHERE role = 'user'"))
def detect_intent(spark, sf_dir):
    return b.chat(spark, sf_dir).filter("role = 'user'").select(
        "conv_id", "turn", chat_rules.detect_intent(F.col("text")).alias("intent"))


@query("is_followup", b.sql(["chat"], f"SELECT conv_id, turn, {FOLLOWUP_SQL} AS followup FROM chat WHERE role = 'user'"))
def is_followup(spark, sf_dir):
    return b.chat(spark, sf_dir).filter("role = 'user'").select(
        "conv_id", "turn", chat_rules.is_followup(F.col("text")).alias("followup"))


# --- vectors -----------------------------------------------------------------------------
_DIMS = "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"


@query("sparse_vector", f"SELECT vec_id, CAST(dim AS INTEGER) AS term, round(x, 6) AS weight FROM ({_DIMS}) WHERE x >= 0")
def sparse_vector(spark, sf_dir):
    # Negative weights carry a key that is no number, so they must drop out.
    entries = F.transform("embedding", lambda x, i: F.struct(
        F.concat(F.when(x < 0, F.lit("x")).otherwise(F.lit("")), i.cast("string")).alias("key"),
        x.cast("double").cast("string").alias("value")))
    sparse = vectors.sparse_vector(F.map_from_entries(entries))
    return b.table(spark, sf_dir, "embeddings").select("vec_id", sparse.alias("s")).select(
        "vec_id", F.explode(F.arrays_zip("s.indices", "s.values")).alias("z")
    ).select("vec_id", F.col("z.indices").alias("term"), F.round("z.values", 6).alias("weight"))


@query("l2_normalize", f"""
    SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(CASE WHEN n > 0 THEN x / n ELSE x END, 6) AS x
    FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS n FROM (
        SELECT vec_id, dim, x * (vec_id + 1) AS x FROM ({_DIMS})))""")
def l2_normalize(spark, sf_dir):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 1))
    return b.table(spark, sf_dir, "embeddings").select("vec_id", vectors.l2_normalize(scaled).alias("v")).select(
        "vec_id", F.posexplode("v").alias("dim", "x")).withColumn("x", F.round("x", 6))


@query("argmax_decode", "SELECT vec_id, " + ", ".join(
    f"list_extract(['negative', 'neutral', 'positive'], list_position(embedding[{3 * i + 1}:{3 * i + 3}], "
    f"list_max(embedding[{3 * i + 1}:{3 * i + 3}]))) AS {a}" for i, a in enumerate(ASPECTS)) + " FROM embeddings")
def argmax_decode(spark, sf_dir):
    logits = F.array(*[F.slice("embedding", 3 * i + 1, 3) for i in range(len(ASPECTS))])
    label = labels.argmax_decode(logits)
    return b.table(spark, sf_dir, "embeddings").select(
        "vec_id", *[label[i]["sentiment"].alias(a) for i, a in enumerate(ASPECTS)])
