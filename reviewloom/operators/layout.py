"""Row order, positions and joins that stay balanced when one key is hot.

Nothing here gathers a whole group in one task: groups are cut into blocks of
bounded size first, or reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 100_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spreads a table that comes in too few pieces to occupy the cluster, such
    as one file with a single row group, before costly work on each row. A
    table with enough pieces stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``. The limit of one row per key is
    applied before the shuffle as well, so a hot key sends one row per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their 1-based rank; ``k`` is a literal
    so that the limit also runs before the shuffle."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def running_totals(counts: DataFrame, block: str, n: str, levels: int = 2, width: int = 1 << 16) -> DataFrame:
    """(block, _start): the sum of ``n`` over all smaller blocks, one row per block.

    Blocks are summed up in runs of ``width`` numbers, those in runs again, and so on: no window holds
    more than ``width`` rows, but for the last, whose rows are the runs of the highest level. With two
    levels that is a few thousand even for numbers that are spread over all 64 bits.
    """
    before = lambda window: F.coalesce(F.sum(n).over(
        window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if not levels:
        return counts.select(block, before(Window.partitionBy(F.lit(0))).alias("_start"))
    run = f"_run{levels}"
    runs = counts.withColumn(run, F.floor(F.col(block) / width))
    starts = running_totals(runs.groupBy(run).agg(F.sum(n).alias(n)), run, n, levels - 1, width)
    inside = runs.select(block, run, before(Window.partitionBy(run)).alias("_inside"))
    return inside.join(starts, run).select(block, (F.col("_start") + F.col("_inside")).alias("_start"))


def with_position(
    df: DataFrame, order: str, keys: list[str] | None = None, name: str = "position", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """0-based position by the unique non-negative integer column ``order``,
    over the table or within ``keys``.

    Two passes: rows are numbered inside blocks of consecutive order values and
    the block sizes are summed up in front of them, so neither the table nor a
    hot key is ever sorted in one task.
    """
    keys = keys or []
    block = F.floor(F.col(order) / block_rows)
    blocked = df.withColumn("_block", block)
    counts = df.select(*keys, block.alias("_block")).groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    if keys:
        before = F.sum("_n").over(
            Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
        starts = counts.select(*keys, "_block", F.coalesce(before, F.lit(0)).alias("_start"))
    else:
        starts = running_totals(counts, "_block", "_n")
    inside = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(order))
    return (
        blocked.withColumn("_inside", inside).join(starts, [*keys, "_block"])
        .withColumn(name, F.col("_start") + F.col("_inside") - 1)
        .drop("_block", "_start", "_inside")
    )


def last_value_so_far(df: DataFrame, keys: list[str], order: str, value: str, name: str,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Last non-NULL ``value`` up to and including each row, within ``keys`` by
    ``order``; blocks carry their last value forward to the next block."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / block_rows))
    ends = (
        blocked.filter(F.col(value).isNotNull()).groupBy(*keys, "_block")
        .agg(F.max_by(value, order).alias("_end"))
    )
    blocks = df.select(*keys, F.floor(F.col(order) / block_rows).alias("_block")).distinct()
    carried = F.last("_end", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = blocks.join(ends, [*keys, "_block"], "left").select(*keys, "_block", carried.alias("_carried"))
    inside = F.last(value, ignorenulls=True).over(
        Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        blocked.withColumn("_inside", inside).join(carry, [*keys, "_block"])
        .withColumn(name, F.coalesce("_inside", "_carried")).drop("_block", "_inside", "_carried")
    )


def previous_rows(df: DataFrame, keys: list[str], order: str, item: Column, n: int, name: str,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Array of the ``n`` items before each row, oldest first, within ``keys``.

    Every block also gets the ``n`` rows in front of it, so a long group is
    handled by many tasks and none sees more than ``block_rows + n`` rows.
    """
    placed = with_position(df, order, keys, "_at", block_rows).withColumn("_item", item)
    home = F.floor(F.col("_at") / block_rows)
    last = F.floor((F.col("_at") + n) / block_rows)
    copies = placed.withColumn("_block", F.explode(F.sequence(home, last)))
    window = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(-n, -1)
    return (
        copies.withColumn(name, F.collect_list("_item").over(window))
        .filter(F.col("_block") == home).drop("_at", "_item", "_block")
    )
