"""Raw catalogue and review payloads to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StructType

from ..constants import DETAIL_FIELDS, DETAIL_KEEP, DETAIL_RENAME
from ..functions.json_text import json_text
from ..functions.numbers import parse_timestamp, timestamp_text
from ..functions.text import html_to_text, is_blank, strip, strip_boilerplate

PRODUCT_SCHEMA = """
    name string, short_name string, sku string, price string, list_price string, discount string,
    discount_rate string, rating_average string, review_count string, order_count string,
    favourite_count string, thumbnail_url string, short_description string, inventory_status string,
    has_ebook boolean, is_fresh boolean, is_genuine boolean, url_path string,
    brand struct<id:string,name:string>,
    current_seller struct<id:string,name:string,sku:string>,
    categories struct<id:string,name:string>,
    stock_item struct<qty:string,max_sale_qty:string>,
    specifications array<struct<name:string,attributes:array<struct<name:string,value:string>>>>
"""
REVIEW_PAGE_SCHEMA = """
    data array<struct<content:string,rating:string,created_at:string,created_by:struct<name:string>>>,
    paging struct<last_page:int,total_pages:int>
"""
SUMMARY_SCHEMA = "ai_generated_summary string, meta struct<review_summary:string,ai_summary:string>"

# Flat column -> place in the payload, where the two differ.
_NESTED = {
    "brand_name": "brand.name", "brand_id": "brand.id",
    "seller_name": "current_seller.name", "seller_id": "current_seller.id", "seller_sku": "current_seller.sku",
    "category_name": "categories.name", "category_id": "categories.id",
    "stock_item_qty": "stock_item.qty", "stock_item_max_sale_qty": "stock_item.max_sale_qty",
}


def safe_stringify(c: Column, kind: DataType) -> Column:
    """NULL to '', nested values to JSON, truth values capitalised, else text."""
    if isinstance(kind, (ArrayType, MapType, StructType)):
        value = F.when(c.isNotNull(), json_text(c, kind))
    elif isinstance(kind, BooleanType):
        value = F.initcap(c.cast("string"))
    else:
        value = c.cast("string")
    return F.coalesce(value, F.lit(""))


def specs_text(groups: Column) -> Column:
    """``name: value; ...`` over all groups, attributes without value skipped."""
    lists = F.transform(F.coalesce(groups, F.array()), lambda g: F.coalesce(g.attributes, F.array()))
    shown = F.filter(F.flatten(lists), lambda a: F.coalesce(a.value, F.lit("")) != "")
    return F.concat_ws("; ", F.transform(
        shown, lambda a: F.concat(F.coalesce(a["name"], F.lit("")), F.lit(": "), a.value)))


def product_url(url_path: Column, base_url: str) -> Column:
    path = F.coalesce(url_path, F.lit(""))
    return F.when(path != "", F.concat(F.lit(base_url.rstrip("/") + "/"), path)).otherwise("")


def flatten_product(raw: DataFrame, base_url: str) -> DataFrame:
    """(product_id, payload JSON) to the 31 detail columns, all text."""
    p = raw.select("product_id", F.from_json("payload", PRODUCT_SCHEMA).alias("p"))
    kinds = {f.name: f.dataType for f in p.schema["p"].dataType}
    columns = []
    for name in DETAIL_FIELDS:
        if name == "product_id":
            value = F.col("product_id").cast("string")
        elif name == "specifications":
            value = specs_text(F.col("p.specifications"))
        elif name == "product_url":
            value = product_url(F.col("p.url_path"), base_url)
        elif name == "ai_review_summary":
            value = F.lit("")
        elif name in _NESTED:
            value = F.coalesce(F.col(f"p.{_NESTED[name]}"), F.lit(""))
        else:
            value = safe_stringify(F.col(f"p.{name}"), kinds[name])
        columns.append(value.alias(name))
    return p.select(columns)


def ai_summary(payload: Column) -> Column:
    """First non-empty of the three places a summary may be in."""
    s = F.from_json(payload, SUMMARY_SCHEMA)
    return F.coalesce(*[
        F.nullif(c, F.lit(""))
        for c in (s.ai_generated_summary, s.meta.review_summary, s.meta.ai_summary)
    ], F.lit(""))


def served_reviews(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(product_id, page, payload JSON) to one row per served review, blank ones
    included.

    ``place`` keeps the order in which they were served. All pages are read;
    ``max_pages`` is for a caller that wants the first ones (they count from 1).
    """
    wanted = pages if max_pages is None else pages.filter(F.col("page") <= max_pages)
    served = wanted.select(
        "product_id", "page", F.posexplode(F.from_json("payload", REVIEW_PAGE_SCHEMA)["data"]).alias("at", "r"))
    return served.select(
        "product_id",
        F.struct("page", "at").alias("place"),
        F.coalesce("r.created_by.name", F.lit("")).alias("customer_name"),
        F.col("r.rating").try_cast("int").alias("rating"),
        strip(F.col("r.content")).alias("content"),
        timestamp_text(F.col("r.created_at")).alias("created_at"),
        parse_timestamp(F.col("r.created_at")).alias("created_ts"),
    )


def with_content(served: DataFrame) -> DataFrame:
    return served.filter(~is_blank(F.col("content")))


def flatten_reviews(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The served reviews that have content."""
    return with_content(served_reviews(pages, max_pages))


def product_list(listed: DataFrame) -> DataFrame:
    """First listing of every product over the category pages, in page order."""
    from .layout import keep_first

    valid = listed.filter(F.coalesce(F.col("product_id"), F.lit(0)) != 0)
    return keep_first(valid, ["product_id"], ["page", "at"])


def nonblank_ids(df: DataFrame, column: str = "product_id") -> DataFrame:
    return df.filter(~is_blank(F.col(column)))


def detail_projection(detail: DataFrame) -> DataFrame:
    """22 of the 31 columns, texts cleaned, two renamed."""
    cleaned = {c: strip_boilerplate(html_to_text(F.col(c))) for c in ("short_description", "specifications")}
    return detail.select(DETAIL_KEEP).withColumns(cleaned).withColumnsRenamed(DETAIL_RENAME)


def final_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """The ordered subset of ``columns`` that exists."""
    return df.select([c for c in columns if c in df.columns])


def lookback(df: DataFrame, created: Column, cutoff: Column) -> DataFrame:
    """Rows at or after the cutoff; rows without a readable date stay."""
    return df.filter((created >= cutoff) | created.isNull())


def missing_columns(df: DataFrame, required: set[str]) -> set[str]:
    return required - set(df.columns)


def require_columns(df: DataFrame, required: set[str], what: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} lacks columns {sorted(missing)}")
    return df


def with_required_columns(inputs: dict[str, DataFrame], required: set[str]) -> dict[str, DataFrame]:
    """The inputs that hold all required columns; the others are skipped."""
    return {name: df for name, df in inputs.items() if not missing_columns(df, required)}
