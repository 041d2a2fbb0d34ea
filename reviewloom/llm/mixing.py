"""Mixing sources to target weights by systematic sampling of whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: No source, and so no document, is taken more often than this.
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Blocks that a source is cut into for its prefix sums: 20 size classes a decade, each in so many slots.
CLASSES_A_DECADE, SLOTS = 20, 256
SEED = "mix"

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, target: the total of all sizes shared out by weight.

    ``sizes`` has one row per source (source, source_size); sources take the weights in turn, by code
    point, null last. A target stops at ``most`` times its source's size and the excess goes to the
    others by weight, until none is above: with sources in the order of size / weight, the first one
    whose share of what is left stays below its limit sets the level for all after it. The windows run
    over the table of sources, whose length is the number of sources, not of documents.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    table = sizes.withColumn("w", weight.cast("long")).withColumn("limit", most * F.col("source_size"))
    order = everything.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    table = table.select(
        "*", F.row_number().over(order).alias("at"),
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("left"),
        F.sum("w").over(onward).alias("w_left"))
    share = F.col("left").cast("double") / F.col("w_left")
    free = F.when(F.col("limit") > share * F.col("w"), F.struct("at", share.alias("level")))
    level = F.min(free).over(everything)["level"]
    return table.select("source", "source_size", F.least(F.col("limit").cast("double"), level * F.col("w")).alias("target"))


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) with 16 bits from the md5 of some text."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 4), 16, 10).cast("double") / 65536


def mix(docs: DataFrame, size: Column, name: str = "mix", weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, source, ...) with a struct ``name``: size, source_size, target, copies, taken.

    Every document of a source expects target / source_size copies. These are summed up along the source,
    one offset per source is added, and a document is emitted once for each integer that its own part of
    the sum crosses. Documents come in the order of their size class and a hash of the id, so that the
    words taken, not only the documents, come near the target. The sums are built from block totals: a
    block is a slot of ids within a size class, so a hot source is cut into thousands of blocks and only
    the (bounded) block totals of a source come together.

    Defined cases: a null source is a source; a null size is 0, and such documents take no words; rows
    that repeat an id count each; a source without words has the target 0. Reruns agree. A column called
    ``name`` is replaced, columns of other names pass through.
    """
    source = F.col("source").cast("string")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    table = docs.drop(name).withColumn("_mix_size", F.coalesce(size.cast("long"), F.lit(0))).withColumn("_mix_key", key)
    class_ = F.floor(CLASSES_A_DECADE * F.log10(F.col("_mix_size") + 1)).cast("int")
    slot = F.pmod(F.conv(F.substring("_mix_key", 1, 4), 16, 10).cast("int"), F.lit(SLOTS))
    table = table.withColumn("_mix_class", class_).withColumn("_mix_slot", slot)

    totals = table.groupBy(source.alias("_mix_source"), "_mix_class", "_mix_slot").agg(
        F.count("*").alias("n"), F.sum("_mix_size").alias("words"))
    sources = targets(totals.groupBy(F.col("_mix_source").alias("source")).agg(F.sum("words").alias("source_size")),
                      weights, most)
    before = Window.partitionBy("_mix_source").orderBy("_mix_class", "_mix_slot").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.select(
        "_mix_source", "_mix_class", "_mix_slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_start")
    ).join(sources, F.col("_mix_source").eqNullSafe(F.col("source"))).select(
        F.col("_mix_source").alias("_mix_s"), F.col("_mix_class").alias("_mix_c"), F.col("_mix_slot").alias("_mix_t"),
        "_mix_start", F.col("source_size").alias("_mix_total"), F.col("target").alias("_mix_target"))

    inside = Window.partitionBy(source, "_mix_class", "_mix_slot").orderBy("_mix_key", "doc_id", "_mix_size")
    placed = table.withColumn("_mix_at", F.row_number().over(inside)).join(
        blocks, source.eqNullSafe(F.col("_mix_s")) & (F.col("_mix_class") == F.col("_mix_c"))
        & (F.col("_mix_slot") == F.col("_mix_t")))
    rate = F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total")).otherwise(0.0)
    offset = _unit(F.lit(seed), F.coalesce(source, F.lit("")))
    rank = F.col("_mix_start") + F.col("_mix_at")
    copies = F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)
    return placed.withColumn("_mix_copies", copies).select(*docs.drop(name).columns, F.struct(
        F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"),
        F.col("_mix_copies").alias("copies"), (F.col("_mix_copies") * F.col("_mix_size")).alias("taken")).alias(name))


def mixed(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    taken = mix(docs, size, name="_mix", **options).filter("_mix.copies > 0")
    return taken.withColumn("_mix", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix.copies")))).drop("_mix")


#: The weights, limit and blocks as above; word counts and md5 are the same in both engines.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
b AS (SELECT *, floor(20 * log10(size + 1))::INTEGER AS c, ('0x' || substr(k, 1, 4))::INTEGER % 256 AS t FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST) AS pos,
         (sum(source_size) OVER ())
         - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest FROM s),
g AS (SELECT arg_min(rest::DOUBLE / w_rest::DOUBLE, pos) AS level FROM o
      WHERE 3 * source_size > rest::DOUBLE / w_rest::DOUBLE * w),
g2 AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, (SELECT level FROM g) * w) AS target FROM s),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY c, t, k, doc_id, size) AS rank,
         ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 4))::INTEGER / 65536::DOUBLE AS u FROM b),
q AS (
  SELECT doc_id, size, g2.source_size, g2.target, u, rank,
         CASE WHEN g2.source_size > 0 THEN g2.target / g2.source_size ELSE 0 END AS rate
  FROM r JOIN g2 ON r.source IS NOT DISTINCT FROM g2.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate * rank + u) - floor(rate * (rank - 1) + u))::BIGINT * size)::BIGINT AS taken
FROM q
"""
