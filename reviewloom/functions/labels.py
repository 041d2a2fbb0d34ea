"""Expressions over aspect labels: ARRAY<STRUCT<aspect, sentiment>>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import ASPECTS, LABEL_CODES, SENTIMENTS
from .json_text import quoted
from .text import strip

LABEL_TYPE = "array<struct<aspect:string,sentiment:string>>"


def parse_label(c: Column) -> Column:
    """JSON or Python-literal list to a label; anything else, such as a bare
    object or a list with more text around it, is empty."""
    listed = F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), c)
    direct = F.from_json(listed, LABEL_TYPE)
    without_none = F.from_json(F.regexp_replace(listed, r":\s*None\b", ": null"), LABEL_TYPE)
    return F.coalesce(direct, without_none, F.array().cast(LABEL_TYPE))


def valid_items(label: Column) -> Column:
    return F.filter(label, lambda x: x.aspect.isin(ASPECTS) & x.sentiment.isin(SENTIMENTS))


def count_sentiment(label: Column, sentiment: str) -> Column:
    return F.size(F.filter(label, lambda x: x.sentiment == sentiment))


def overall_sentiment(label: Column) -> Column:
    pos, neg = count_sentiment(label, "positive"), count_sentiment(label, "negative")
    return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")


def last_sentiment(label: Column, aspect: str) -> Column:
    """Sentiment of the last item naming ``aspect``, else NULL."""
    hits = F.filter(label, lambda x: x.aspect == aspect)
    return F.element_at(F.when(F.size(hits) > 0, hits), -1)["sentiment"]


def label_to_columns(label: Column, default: str = "none") -> list[Column]:
    return [F.coalesce(last_sentiment(label, a), F.lit(default)).alias(a) for a in ASPECTS]


def normalize_label(label: Column) -> Column:
    """All six aspects in order, missing ones neutral; an empty label is NULL."""
    tidy = F.transform(
        label,
        lambda x: F.struct(F.lower(F.trim(x.aspect)).alias("aspect"), x.sentiment.alias("sentiment")),
    )
    full = F.array(*[
        F.struct(F.lit(a).alias("aspect"), F.coalesce(last_sentiment(tidy, a), F.lit("neutral")).alias("sentiment"))
        for a in ASPECTS
    ])
    return F.when(F.size(label) > 0, full)


def make_label(columns: list[Column]) -> Column:
    """Six sentiments in aspect order to the JSON text of a label."""
    items = [F.concat(F.lit(f'{{"aspect": "{a}", "sentiment": '), quoted(c), F.lit("}")) for a, c in zip(ASPECTS, columns)]
    return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))


def label_code(sentiment: Column) -> Column:
    code = F.lit(None).cast("int")
    for name, value in LABEL_CODES.items():
        code = F.when(sentiment == name, F.lit(value)).otherwise(code)
    return code


def code_label(code: Column) -> Column:
    name = F.lit(None).cast("string")
    for text, value in LABEL_CODES.items():
        name = F.when(code == value, F.lit(text)).otherwise(name)
    return name


def argmax_decode(logits: Column) -> Column:
    """[aspect][class] scores to a label; the first maximum wins."""
    def decode(i: int) -> Column:
        row = logits[i]
        return code_label((F.array_position(row, F.array_max(row)) - 1).cast("int"))

    return F.array(*[
        F.struct(F.lit(a).alias("aspect"), decode(i).alias("sentiment")) for i, a in enumerate(ASPECTS)
    ])


def verdict_band(pct_pos: Column, pct_neg: Column) -> Column:
    return (
        F.when(pct_pos >= 70, "đa số khen").when(pct_pos >= 50, "khá tích cực")
        .when(pct_neg >= 50, "đa số chê").otherwise("ý kiến trái chiều")
    )


def report_band(pct: Column, pos: Column, neg: Column, total: Column) -> Column:
    """Mark and note of one aspect line in a product report."""
    counts = F.concat(pct.cast("string"), F.lit("% hài lòng ("), pos.cast("string"), F.lit(" khen / "),
                      neg.cast("string"), F.lit(" chê)"))
    mark = F.when(total == 0, "❓").when(pct >= 70, "✅").when(pct >= 40, "⚠️").otherwise("❌")
    note = (
        F.when(total == 0, F.lit("Chưa có đánh giá")).when(pct >= 40, counts)
        .otherwise(F.concat(F.lit("Chỉ "), counts))
    )
    small = F.when((total > 0) & (total < 5), F.lit(" · ⚠️ mẫu nhỏ")).otherwise("")
    return F.struct(mark.alias("mark"), F.concat(note, small).alias("note"))


def parse_label_response(reply: Column, n: Column) -> Column:
    """Reply text of a labelling batch to one label per row of the batch.

    The widest ``[...]`` part is read as JSON; when it does not hold exactly
    ``n`` entries every row of the batch is NULL.
    """
    wide = F.regexp_extract(reply, r"(?s)\[.*\]", 0)
    rows = F.from_json(
        F.when(wide != "", wide).otherwise(F.trim(reply)),
        f"array<struct<aspect_sentiments:{LABEL_TYPE}>>",
    )
    labels = F.transform(rows, lambda r: F.coalesce(r.aspect_sentiments, F.array().cast(LABEL_TYPE)))
    nothing = F.array_repeat(F.lit(None).cast(LABEL_TYPE), n.cast("int"))
    return F.when(F.size(labels) == n, labels).otherwise(nothing)


def realign_batch_lines(reply: Column, batch: Column) -> Column:
    """Numbered reply lines matched to the inputs they answer."""
    lines = F.transform(
        F.filter(F.split(reply, "\n"), lambda s: strip(s) != ""),
        lambda s: strip(F.regexp_replace(s, r"^[0-9]+\.\s*", "")),
    )
    kept = F.slice(lines, 1, F.size(batch))
    missing = F.size(batch) - F.size(kept)
    return F.when(missing > 0, F.concat(kept, F.slice(batch, F.size(kept) + 1, missing))).otherwise(kept)
