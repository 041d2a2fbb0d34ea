"""Chat state: history, current product, search texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ASSISTANT_CHARS, MAX_HISTORY, USER_CHARS
from ..functions import chat_rules
from ..functions.identifiers import extract_chat_product_id, extract_url
from ..functions.numbers import thousands
from ..functions.text import compact_text
from .layout import BLOCK_ROWS, last_value_so_far, previous_rows, top_per_key


def _message() -> Column:
    """Messages of user and assistant as they are remembered."""
    text = F.when(F.col("role") == "user", compact_text(F.col("text"), USER_CHARS)).otherwise(
        compact_text(F.col("text"), ASSISTANT_CHARS))
    return F.struct(F.col("role").alias("role"), text.alias("content"))


def spoken(chat: DataFrame) -> DataFrame:
    return chat.filter(F.col("role").isin("user", "assistant"))


def final_history(chat: DataFrame, n: int = MAX_HISTORY) -> DataFrame:
    """The last ``n`` messages of each conversation, newest rank 1."""
    return top_per_key(spoken(chat), ["conv_id"], [F.desc("turn")], n).select(
        "conv_id", "turn", "rank", _message().alias("m")).select("conv_id", "turn", "rank", "m.*")


def history_before(chat: DataFrame, n: int = MAX_HISTORY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every message with the ``n`` messages before it, oldest first."""
    return previous_rows(spoken(chat), ["conv_id"], "turn", _message(), n, "history", block_rows)


def with_current_product(chat: DataFrame, host: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every message with the product the conversation is about: the last one
    linked by the user so far."""
    linked = F.when(F.col("role") == "user", extract_chat_product_id(extract_url(F.col("text"), host)))
    rows = chat.withColumn("linked_product", linked.cast("bigint"))
    return last_value_so_far(rows, ["conv_id"], "turn", "linked_product", "current_product", block_rows)


def product_columns(price: str = "price") -> dict[str, Column]:
    """The current product of a row as the chat rules expect it."""
    return {
        "id": F.col("current_product"), "name": F.col("name"), "category": F.col("category_name"),
        "url": F.col("product_url"), "price_text": F.concat(thousands(F.col(price), ","), F.lit("đ")),
        "report": F.col("report"),
    }


def search_queries(chat: DataFrame) -> DataFrame:
    """User messages with intent, number of results wanted and search text."""
    users = chat.filter("role = 'user'")
    intent = chat_rules.detect_intent(F.col("text"))
    return users.select(
        "conv_id", "turn", "current_product", intent.alias("intent"),
        F.when(intent == "alternative_recommendation", 8).otherwise(5).alias("top_k"),
        chat_rules.search_query(F.col("text"), product_columns()).alias("search_query"))


def rag_context(hits: DataFrame) -> DataFrame:
    """One context text per query from ranked hits with their payload.

    ``hits`` are at most a few rows per query, already cut to top-k.
    """
    from ..constants import ASPECT_REPORT_NAMES
    from ..functions.numbers import percent

    head = F.concat(
        F.lit("[Nguồn "), F.col("rank").cast("string"), F.lit("] ("), F.col("doc_type"), F.lit(")"),
        F.when(F.coalesce("name", F.lit("")) != "", F.concat(
            F.lit(" "), F.col("name"),
            F.when(F.coalesce("price", F.lit(0)) != 0,
                   F.concat(F.lit(" — "), thousands(F.col("price"), ","), F.lit("đ"))).otherwise(""),
            F.when(F.coalesce("rating_average", F.lit(0.0)) != 0, F.concat(
                F.lit(" — "), F.col("rating_average").cast("string"), F.lit("/5 ("),
                F.coalesce(F.col("review_count").cast("string"), F.lit("?")), F.lit(" đánh giá)"))).otherwise("")
        )).otherwise(""),
    )
    lines = []
    for aspect, name in ASPECT_REPORT_NAMES.items():
        pos, neg = (F.coalesce(F.col(f"absa_{aspect}_{s}"), F.lit(0)) for s in ("pos", "neg"))
        lines.append(F.when(F.col(f"absa_{aspect}_score").isNotNull(), F.concat(
            F.lit(f"  {name}: "), percent(pos, pos + neg).cast("string"), F.lit("% hài lòng ("),
            pos.cast("string"), F.lit(" khen / "), neg.cast("string"), F.lit(" chê)"))))
    body = F.concat_ws("\n", *lines)
    block = F.when(body != "", F.concat(F.lit("\nPhân tích đánh giá:\n"), body)).otherwise("")
    text = F.when(F.coalesce("text", F.lit("")) != "", F.col("text")).otherwise("(không có nội dung text)")
    part = F.concat(head, F.lit("\n"), text, block)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("rank", part.alias("part")))), lambda p: p.part)
    return hits.groupBy("query_id").agg(F.array_join(parts, "\n\n").alias("joined")).select(
        "query_id", F.concat(F.lit("\n\n" + "=" * 50), F.col("joined")).alias("context"))


def product_reports(products: DataFrame, satisfaction: DataFrame, samples: DataFrame, source_text: Column,
                    shop: str) -> DataFrame:
    """Report text of each product: figures, one line per aspect, up to three
    sample reviews. ``samples`` are few rows per product with their rank."""
    from ..constants import ASPECT_REPORT_NAMES, ASPECTS
    from ..functions.labels import report_band

    band = report_band(*[F.col(c) for c in ("pct", "pos", "neg", "total")])
    name = F.element_at(F.create_map(*[F.lit(x) for kv in ASPECT_REPORT_NAMES.items() for x in kv]), F.col("aspect"))
    line = F.concat(band.mark, F.lit(" **"), name, F.lit("**: "), band.note)
    order = F.array_position(F.array(*map(F.lit, ASPECTS)), F.col("aspect"))
    aspect_lines = satisfaction.groupBy("product_id").agg(
        F.max("total").alias("total_analyzed"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), line.alias("l")))),
                                 lambda x: x.l), "\n").alias("aspect_lines"))
    quote = F.concat(F.lit("> "), F.repeat(F.lit("⭐"), F.coalesce("rating", F.lit(0))), F.lit(' *"'), F.col("content"), F.lit('"*\n'))
    quotes = samples.filter("rank <= 3").groupBy("product_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", quote.alias("q")))),
                                 lambda x: x.q), "\n").alias("quotes"))
    joined = products.join(aspect_lines, "product_id").join(quotes, "product_id", "left")
    report = F.concat_ws(
        "\n",
        F.lit("## 📊 Phân tích sản phẩm"), F.lit(""),
        F.concat(F.lit("**"), F.col("name"), F.lit("**")),
        F.concat(F.lit("💰 "), F.coalesce(thousands(F.col("price"), ","), F.lit("n/a")), F.lit("đ · ⭐ "),
                 F.coalesce(F.col("rating_average").cast("string"), F.lit("n/a")), F.lit("/5 ("),
                 F.coalesce(thousands(F.col("review_count"), ","), F.lit("0")), F.lit(" đánh giá)")),
        F.concat(F.lit("🏷️ "), F.col("brand_name"), F.lit(" · 📦 "), F.col("category_name")),
        F.concat(F.lit(f"🔗 [Xem trên {shop}]("), F.col("product_url"), F.lit(")")), F.lit(""),
        F.concat(F.lit("*Nguồn: "), source_text, F.lit("*")), F.lit(""),
        F.concat(F.lit("### 🔍 Phân tích theo khía cạnh ("), F.col("total_analyzed").cast("string"),
                 F.lit(" đánh giá đã phân tích)")), F.lit(""),
        F.col("aspect_lines"),
        F.when(F.col("quotes").isNotNull(), F.concat(F.lit("\n### 💬 Một số đánh giá tiêu biểu\n\n"), F.col("quotes"))),
        F.lit("---"),
        F.concat(F.lit(f"*Xem đầy đủ đánh giá trên [{shop}]("), F.col("product_url"), F.lit(")*")),
    )
    return joined.select("product_id", report.alias("report"))
