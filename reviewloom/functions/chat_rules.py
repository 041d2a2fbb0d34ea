"""Rules on chat messages: intent, follow-up, search text, injected context."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import FOLLOWUP_HINTS, INTENTS, PRODUCT_CONTEXT_CHARS, REMEMBER_TEXT
from .text import compact_text, contains_any


def detect_intent(query: Column) -> Column:
    intent = F.lit("general_qa")
    for name, hints in reversed(INTENTS):
        intent = F.when(contains_any(query, hints), F.lit(name)).otherwise(intent)
    return intent


def is_followup(query: Column) -> Column:
    return contains_any(query, FOLLOWUP_HINTS)


def search_query(query: Column, product: dict[str, Column]) -> Column:
    """Search text of a message, given the product the chat is about.

    ``product`` holds the columns id, name, category and price_text; without a
    current product (id NULL) the message is searched as it is.
    """
    p = {k: F.coalesce(v.cast("string"), F.lit("")) for k, v in product.items()}
    alternative = F.concat(
        query, F.lit(". Tìm sản phẩm thay thế hoặc sản phẩm tương tự cùng phân khúc cho sản phẩm hiện tại: "),
        p["name"], F.lit(". Ngành hàng: "), p["category"], F.lit(". Giá tham chiếu: "), p["price_text"],
        F.lit(". Product ID: "), p["id"], F.lit("."),
    )
    about = F.concat(
        query, F.lit(". Câu hỏi đang nói về sản phẩm hiện tại: "), p["name"], F.lit(". Ngành hàng: "),
        p["category"], F.lit(". Giá: "), p["price_text"], F.lit(". Product ID: "), p["id"], F.lit("."),
    )
    return (
        F.when(product["id"].isNull(), query)
        .when(detect_intent(query) == "alternative_recommendation", alternative)
        .when(is_followup(query), about)
        .otherwise(query)
    )


def product_context(product: dict[str, Column]) -> Column:
    """Text block describing the current product; '' without one."""
    shown = lambda key, other: F.coalesce(F.nullif(product[key].cast("string"), F.lit("")), F.lit(other))
    block = F.concat_ws(
        "\n",
        F.lit("[CURRENT_PRODUCT_CONTEXT]"),
        F.lit("Sản phẩm hiện tại trong hội thoại:"),
        F.concat(F.lit("- Product ID: "), shown("id", "Không rõ ID")),
        F.concat(F.lit("- Tên sản phẩm: "), shown("name", "Không rõ tên")),
        F.concat(F.lit("- Giá: "), shown("price_text", "Không rõ giá")),
        F.concat(F.lit("- Ngành hàng: "), shown("category", "Không rõ ngành hàng")),
        F.concat(F.lit("- URL: "), shown("url", "")),
        F.lit(""),
        F.lit("Báo cáo phân tích gần nhất:"),
        compact_text(product["report"], PRODUCT_CONTEXT_CHARS),
        F.lit("[/CURRENT_PRODUCT_CONTEXT]"),
    )
    return F.when(product["id"].isNull(), F.lit("")).otherwise(block)


def augmented_history(history: Column, query: Column, product: dict[str, Column]) -> Column:
    """ARRAY<STRUCT<role, content>> with the product context put in front when
    the message is about the current product."""
    memory = F.struct(
        F.lit("assistant").alias("role"), F.concat(F.lit(REMEMBER_TEXT), product_context(product)).alias("content")
    )
    wanted = product["id"].isNotNull() & (is_followup(query) | (detect_intent(query) != "general_qa"))
    return F.when(wanted, F.concat(F.array(memory), history)).otherwise(history)
