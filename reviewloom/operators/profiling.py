"""Table profiles, distributions and facets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import BRAND_TEMPLATES, CATEGORY_TEMPLATES, WARM_QUERIES
from .merge import concat_parts


def _per_column(df: DataFrame, measures: dict) -> DataFrame:
    """One pass over the table, then one row per column; ``measures`` maps a
    name to a function of the column name."""
    names = df.columns
    one = df.agg(*[make(c).alias(f"{m}|{c}") for m, make in measures.items() for c in names])
    rows = F.posexplode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{m}|{c}`").alias(m) for m in measures]) for c in names]))
    return one.select(rows.alias("position", "r")).select("position", "r.*")


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, {"nulls": lambda c: F.count_if(F.col(c).isNull())}).drop("position")


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    Exact counts explode every row into (column, digest of value) pairs and
    deduplicate them with a map-side combine, instead of one expanded
    aggregate per column.
    """
    if approximate:
        return _per_column(df, {"distinct_values": lambda c: F.approx_count_distinct(c)}).drop("position")
    return _value_counts(df).groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def _value_counts(df: DataFrame) -> DataFrame:
    """Distinct (column, value as text) pairs; every column has a NULL row so
    that it is listed even without values."""
    pairs = F.explode(F.flatten(F.array(*[
        F.array(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")),
                F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value"))) for c in df.columns])))
    return df.select(pairs.alias("p")).select("p.*").distinct()


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns holding one single value, with it, in one map-side combined pass."""
    return _per_column(df, {
        "low": lambda c: F.min(F.col(c).cast("string")), "high": lambda c: F.max(F.col(c).cast("string")),
    }).filter("low = high").select("column_name", F.col("low").alias("value"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in all columns."""
    key = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    groups = df.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def table_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and non-NULL rows of every column."""
    types = dict(df.dtypes)
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in types.items() for x in kv]), F.col("column_name"))
    profile = _per_column(df, {"rows": lambda c: F.count("*"), "non_null": lambda c: F.count(c)})
    return profile.withColumns({"kind": kind, "columns": F.lit(len(types))})


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each column, largest first within a column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p"))
    return long.select("p.*").filter("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count("*").alias("n")).orderBy("column_name", F.desc("n"), "value")


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last one is closed.

    Empty bins are listed with 0.
    """
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    binned = F.least(F.lit(bins), F.when(high > low, F.width_bucket(
        F.col(value).cast("double"), low.cast("double"), high.cast("double"), F.lit(bins))).otherwise(1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(binned.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    domain = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return domain.join(counts, "bin", "left").na.fill(0, ["n"])


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a small-domain number.

    Equal values are counted first, so the exact percentiles work on distinct
    values with their frequency rather than on all rows.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("f"))
    quart = lambda p: F.percentile(value, F.lit(p), F.col("f"))
    x, f = F.col(value).cast("double"), F.col("f")
    total, mean = F.sum("f"), F.sum(x * f) / F.sum("f")
    variance = F.try_divide(F.sum(x * x * f) - F.sum(f) * F.pow(mean, F.lit(2)), total - 1)
    return counted.agg(
        total.alias("count"), mean.alias("mean"), F.sqrt(F.greatest(variance, F.lit(0.0))).alias("std"),
        F.min(value).alias("min"), quart(0.25).alias("p25"), quart(0.5).alias("p50"), quart(0.75).alias("p75"),
        F.max(value).alias("max"))


def kb_facets(cards: DataFrame) -> DataFrame:
    """Distinct brands, categories and shortened names of product cards."""
    values = F.explode(F.array(*[
        F.struct(F.lit(facet).alias("facet"), value.alias("value")) for facet, value in (
            ("brand", F.col("brand_name")), ("category", F.col("category_name")), ("name", F.substring("name", 1, 60)))]))
    return cards.select(values.alias("f")).select("f.*").filter("value <> ''").distinct()


def warm_queries(facets: DataFrame, names: int = 20) -> DataFrame:
    """Queries worth asking beforehand: templates over brands and categories,
    the first ``names`` product names, and the fixed ones."""
    def filled(facet, template):
        rows = facets.filter((F.col("facet") == facet) & (F.col("value") != "Root"))
        return rows.select(F.format_string(template, "value").alias("query"))

    parts = [filled("brand", t) for t in BRAND_TEMPLATES] + [filled("category", t) for t in CATEGORY_TEMPLATES]
    parts.append(facets.filter("facet = 'name'").orderBy("value").limit(names).select(F.col("value").alias("query")))
    parts.append(facets.sparkSession.createDataFrame([(q,) for q in WARM_QUERIES], "query string"))
    return concat_parts(parts).distinct()
