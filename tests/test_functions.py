"""Scalar functions on edge rows and known values."""

import html
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from reviewloom.constants import ABBREVIATIONS, ASPECTS, VIETNAMESE_LETTERS
from reviewloom.functions import chat_rules, identifiers, labels, numbers, text, vectors


def apply(spark, fn, values, schema="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {schema}").select("i", fn(F.col("v")).alias("out"))
    return [r.out for r in df.orderBy("i").collect()]


TEXTS = [
    None, "", "   ", "Bình thường nhựa", "Hàng đúng như mô tả, không có chỗ chê", "sp tốt　lắm", "😀 ok 😀",
    "giá 3.5 và 1/2, a.b a/b 1.2.3 .5 5.", "kẻ đcx đc re rẻ RE", "ko k ko\nship vs tks thanks", "re re re sp",
    "a\x1cb\x85c", "sp_k", "k.k", "j?", "é", "1./2",
]


def plain_clean(value, abbreviate, keep):
    """The cleaning rules in plain Python."""
    s = (value or "").lower()
    if abbreviate:
        for short, full in ABBREVIATIONS:
            s = re.sub("|".join(rf"\b{p}\b" for p in short.split("|")), full, s)
    s = re.sub(r"(?<!\d)[./]|[./](?!\d)", " ", s)
    s = re.sub(f"[^a-z0-9{VIETNAMESE_LETTERS}\\s{keep}]", "", s)
    return " ".join(s.split())


def test_clean_review_text(spark):
    assert apply(spark, text.clean_review_text, TEXTS) == [plain_clean(t, True, "") for t in TEXTS]


def test_clean_label_text(spark):
    assert apply(spark, text.clean_label_text, TEXTS) == [plain_clean(t, False, "./") for t in TEXTS]


def test_known_clean_values(spark):
    got = apply(spark, text.clean_review_text, [
        "Bình thường nhựa", "Hàng đúng như mô tả, không có chỗ chê", "giá 3.5"])
    assert got == ["bình thường nhựa", "hàng đúng như mô tả không có chỗ chê", "giá 35"]


def test_html(spark):
    raw = ["<p>A &amp; B&nbsp;&eacute;&#233;&lt;x</p>", None, "a<br>b", "&copy 2020"]
    want = [re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", html.unescape(r or ""))).strip() for r in raw]
    assert apply(spark, text.clean_html_text, raw) == want
    page = "<html><style>p{}</style><script>var a='<b>';</script><p>x <b>y</b></p><!-- c --><template>t</template></html>"
    assert apply(spark, text.html_to_text, [page, None]) == ["x y", ""]


def test_texts(spark):
    assert apply(spark, text.strip_boilerplate, ["shop cam kết tốt  liên hệ shop", None]) == ["tốt", ""]
    assert apply(spark, lambda c: text.compact_text(c, 5), ["  ab  ", "abcd efg", None]) == [
        "ab", "abcd\n...[đã rút gọn]", ""]
    assert apply(spark, text.word_count, ["a  b c", "", None]) == [3, 0, 0]
    assert apply(spark, text.strip, ["　 a b\x1c\n", "\t"]) == ["a b", ""]


def test_numbers(spark):
    values = ["5.0", "nan", "abc", None, "-3.9", "2.675", "1e3"]
    assert apply(spark, numbers.safe_int, values) == [5, None, None, None, -3, 2, 1000]
    assert apply(spark, numbers.safe_float, values) == [5.0, None, None, None, -3.9, 2.68, 1000.0]
    assert apply(spark, numbers.format_price, ["1234567", "x", None, "999"]) == ["1.234.567đ", "n/a", "n/a", "999đ"]
    assert apply(spark, numbers.timestamp_text, ["1714010000", "junk", None]) == ["2024-04-25 01:53:20", "junk", ""]
    assert [str(t) if t else None for t in apply(spark, numbers.parse_timestamp, ["1714010000", "2024-04-25 01:53:20", "junk", None])] == [
        "2024-04-25 01:53:20", "2024-04-25 01:53:20", None, None]


def test_adaptive_k(spark):
    n = [0, 3, 4, 10, 11, 20, 21, 50, 51, 100, 101, 150, 250, 1000]
    assert apply(spark, numbers.adaptive_k, n, "bigint") == [0, 3, 4, 4, 5, 5, 6, 6, 8, 8, 8, 12, 20, 20]
    k = [1, 3, 4, 6, 8, 20]
    assert apply(spark, numbers.positive_limit, k, "int") == [1, 2, 3, 4, 6, 14]
    assert apply(spark, numbers.negative_limit, k, "int") == [1, 1, 1, 2, 2, 6]


def test_ids(spark):
    assert apply(spark, identifiers.stable_point_id, ["prod_1_card", "é"]) == [
        "92c5b7d4-97c0-5ca9-8da9-ff84e1b8f8d7", str(uuid.uuid5(uuid.NAMESPACE_URL, "é"))]
    assert apply(spark, lambda c: identifiers.delta_doc_id(F.lit(1), c), ["x"]) == ["prod_1_delta_review_e9a3b1d2e3e68958"]
    assert apply(spark, identifiers.extract_product_id, [
        "https://s.vn/a-p12.html", "x/product/34", "product_5", " 678 ", "none"]) == ["12", "34", "5", "678", None]
    assert apply(spark, identifiers.extract_chat_product_id, ["a-p9", "?pid=7", "8"]) == ["9", "7", None]
    assert apply(spark, lambda c: identifiers.extract_url(c, "s.vn"), ["see https://www.s.vn/a-p1 now", "http://t.vn/x"]) == [
        "https://www.s.vn/a-p1", None]


def items(label):
    return None if label is None else [(x.aspect, x.sentiment) for x in label]


def test_parse_label(spark):
    raw = ['[{"aspect": "price", "sentiment": "positive"}]', "[{'aspect': 'price', 'sentiment': None}]", "[]", None, "nan", "[{"]
    got = [items(x) for x in apply(spark, labels.parse_label, raw)]
    assert got == [[("price", "positive")], [("price", None)], [], [], [], []]


def test_label_forms(spark):
    raw = json.dumps([{"aspect": " Price ", "sentiment": "negative"}, {"aspect": "price", "sentiment": "positive"},
                      {"aspect": "other", "sentiment": "positive"}])
    fixed = apply(spark, lambda c: labels.normalize_label(labels.parse_label(c)), [raw, "[]"])
    assert items(fixed[0]) == [(a, "positive" if a == "price" else "neutral") for a in ASPECTS] and fixed[1] is None
    last = apply(spark, lambda c: F.struct(*labels.label_to_columns(labels.parse_label(c))), [raw])[0]
    assert last.price == "positive" and last.quality == "none"
    assert apply(spark, lambda c: labels.overall_sentiment(labels.parse_label(c)), [raw, "[]", None]) == [
        "positive", "neutral", "neutral"]


def test_label_reply(spark):
    entry = '{"aspect_sentiments": [{"aspect": "price", "sentiment": "positive"}]}'
    reply = [f"ok [{entry}, {{}}] end", f"[{entry}]", "no list"]
    got = apply(spark, lambda c: labels.parse_label_response(c, F.lit(2)), reply)
    assert [[items(x) for x in r] for r in got] == [[[("price", "positive")], []], [None, None], [None, None]]


def test_realign(spark):
    batch = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert apply(spark, lambda c: labels.realign_batch_lines(c, batch), ["1. A\n\n2.  B", "A\nB\nC\nD", ""]) == [
        ["A", "B", "c"], ["A", "B", "C"], ["a", "b", "c"]]


def test_bands(spark):
    got = apply(spark, lambda c: labels.report_band(c, F.lit(7), F.lit(3), F.lit(10)).mark, [70, 69, 40, 39], "int")
    assert got == ["✅", "⚠️", "⚠️", "❌"]
    assert apply(spark, lambda c: labels.verdict_band(c, F.lit(60)), [70, 50, 49], "int") == [
        "đa số khen", "khá tích cực", "đa số chê"]


def test_chat_rules(spark):
    said = ["Tìm mẫu khác, có nên mua?", "Có nên mua", "review đi", "???", "a"]
    assert apply(spark, chat_rules.detect_intent, said) == [
        "alternative_recommendation", "purchase_advice", "review_summary", "general_qa", "general_qa"]
    assert apply(spark, chat_rules.is_followup, ["NÓ tốt không", "nón", "hàng"]) == [True, True, False]


def test_vectors(spark):
    unit = apply(spark, vectors.l2_normalize, [[3.0, 4.0], [0.0, 0.0]], "array<float>")
    assert unit[0] == pytest.approx([0.6, 0.8]) and unit[1] == [0.0, 0.0]
    sparse = apply(spark, vectors.sparse_vector, [{"5": "0.5", "x": "1", "7": "bad"}], "map<string,string>")[0]
    assert (sparse.indices, sparse.values) == ([5], [0.5])
    logits = [[[1.0, 1.0, 0.0]] * 6]
    assert items(apply(spark, labels.argmax_decode, logits, "array<array<double>>")[0]) == [(a, "negative") for a in ASPECTS]
