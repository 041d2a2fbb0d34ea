"""Merging daily increments: joins, unions and replacements.

Text columns take part in keys through their SHA-256 digest, so shuffles and
replicated keys stay short whatever the length of a review.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import DEDUP_COLUMNS
from ..functions.text import strip
from ..session import STORED
from .layout import keep_first


#: Blocks of 8 bytes of a filter that goes to every task.
FILTER_BLOCKS = 2_000_000


def digest(*columns: str) -> Column:
    """One digest for a combination of columns; NULL differs from ''."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def _with_key(df: DataFrame, columns: list[str], name: str = "_key") -> DataFrame:
    return df.withColumn(name, digest(*columns))


def dedup_keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Drops later rows with equal ``keys``, in the given order."""
    return keep_first(_with_key(df, keys), ["_key"], order).drop("_key")


def possible_matches(rows: DataFrame, wanted: DataFrame, key: str = "_key", blocks: int | None = None) -> DataFrame:
    """Rows whose ``key`` may be among those of ``wanted``: all that are, and a few others, without a shuffle of ``rows``.

    A Bloom filter in blocks of 64 bits, four a key, aggregated from ``wanted``, goes to every task; with 16 bits a
    key about one other row in 400 passes. A filter of fewer ``blocks`` lets more pass, never less. Where it would
    have more than ``FILTER_BLOCKS`` blocks there is none, and all rows pass.
    """
    if blocks is None:
        blocks = max(1, wanted.count() // 4)
    if blocks > FILTER_BLOCKS:
        return rows
    block = F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks).cast("long"))
    hashed, mask = F.xxhash64(F.lit("bits"), F.col(key)), F.lit(0).cast("long")
    for i in range(4):
        bit = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    bits = wanted.select(block.alias("_block"), mask.alias("_mask")).groupBy("_block").agg(F.bit_or("_mask").alias("_bits"))
    probed = rows.withColumn("_block", block).withColumn("_mask", mask).join(F.broadcast(bits), "_block")
    return probed.filter(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).drop("_block", "_mask", "_bits")


def new_reviews(pending: DataFrame, main: DataFrame, keys=("product_id", "content")):
    """Pending reviews whose key is not in ``main``. Of the main table only keys that the day may hold are shuffled.

    Of several files with the same key the first by name wins; copies inside
    that file stay. Copies are reduced to one key before any shuffle, and the
    rows find their key again by a join that Spark splits where a key is hot.
    """
    rows = _with_key(pending, list(keys))
    known = possible_matches(_with_key(main, list(keys)).select("_key"), rows.select("_key")).distinct()
    first = rows.groupBy("_key").agg(F.min("source_file").alias("source_file")).join(known, "_key", "left_anti")
    return rows.join(first, ["_key", "source_file"], "left_semi").drop("_key")


def affected_ids(pending: DataFrame) -> DataFrame:
    """Products of all pending rows, whether new or not."""
    return pending.select("product_id").filter("product_id IS NOT NULL").distinct()


def of_products(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the given products, a hot product spread over many tasks."""
    return df.join(ids.select("product_id").distinct(), "product_id", "left_semi")


def without_products(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("product_id").distinct(), "product_id", "left_anti")


def one_to_many(one: DataFrame, many: DataFrame) -> DataFrame:
    """Left join of a product table to its reviews; a hot product is spread."""
    matched = many.join(one, "product_id")
    alone = one.join(many.select("product_id").distinct(), "product_id", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def delta_reviews(pending: DataFrame, order: list) -> DataFrame:
    """All pending rows, one per (product_id, content)."""
    return dedup_keep_first(pending, ["product_id", "content"], order)


def merge_labeled(main: DataFrame, pending: DataFrame) -> DataFrame:
    """Main table with the new reviews; ``is_new`` tells them apart."""
    new = new_reviews(pending, main)
    return main.withColumn("is_new", F.lit(False)).unionByName(
        new.withColumn("is_new", F.lit(True)), allowMissingColumns=True)


def merge_figures(main: DataFrame, pending: DataFrame) -> DataFrame:
    """added, total and affected counts of a merge, as one row."""
    merged = merge_labeled(main, pending).agg(
        F.count_if("is_new").alias("added"), F.count("*").alias("total"))
    return merged.withColumn("affected", affected_ids(pending).agg(F.count("*")).scalar())


def write_if_changed(merged: DataFrame, path: str) -> bool:
    """Writes the merged main table to ``path`` only when it gained rows.

    ``path`` is a fresh folder, so the table read so far is never overwritten
    while it is being read.
    """
    if merged.filter("is_new").isEmpty():
        return False
    merged.drop("is_new").write.mode("errorifexists").parquet(path)
    return True


def _text_key(c: str) -> Column:
    return F.coalesce(strip(F.col(c).cast("string")), F.lit("Unknown"))


def resume(df: DataFrame, checkpoint: DataFrame, keys: list[str], values: list[str], row_id: str) -> DataFrame:
    """Fills ``values`` from earlier results with the same key columns; rows
    that stay NULL are still to be done. NULL keys count as ``Unknown``."""
    key = F.sha2(F.to_json(F.array(*[_text_key(k) for k in keys])), 256)
    done = checkpoint.filter(F.col(values[0]).isNotNull()).select(
        key.alias("_key"), F.struct(*values).alias("_done"), F.col(row_id).alias("_at"))
    done = keep_first(done, ["_key"], ["_at"]).select("_key", "_done")
    joined = df.withColumn("_key", key).join(done, "_key", "left")
    kept = {v: F.coalesce(F.col(f"_done.{v}"), F.col(v)) if v in df.columns else F.col(f"_done.{v}") for v in values}
    return joined.withColumns(kept).drop("_key", "_done")


def error_stages(raw: DataFrame, processed: DataFrame, labeled: DataFrame, key: str = "review_id") -> DataFrame:
    """Rows lost while cleaning or while labelling, by a stable review key."""
    lost = lambda a, z, stage: a.join(z.select(key), key, "left_anti").withColumn("error_stage", F.lit(stage))
    return lost(raw, processed, "FAILED_PREPROCESS").unionByName(
        lost(processed, labeled, "FAILED_LABELING"), allowMissingColumns=True)


def review_count_changes(current: DataFrame, state: DataFrame) -> DataFrame:
    """Products whose review count differs from the stored one (missing: -1).

    A NULL current count is a failed look-up and is skipped.
    """
    joined = current.filter("review_count IS NOT NULL").join(
        state.select("product_id", F.col("review_count").alias("_before")), "product_id", "left")
    before = F.coalesce("_before", F.lit(-1))
    return joined.filter(before != F.col("review_count")).select(
        "product_id", before.alias("previous_count"), F.col("review_count").alias("current_count"),
        F.when(F.col("_before").isNotNull(), F.col("review_count") - F.col("_before")).alias("delta"))


def tiered_lookup(ids: DataFrame, cached: DataFrame, known: DataFrame, computed: DataFrame) -> DataFrame:
    """Report of each product from the first tier that has it.

    Every tier holds (product_id, report), one row per product.
    """
    out = ids.select("product_id").distinct()
    tiers = [("cache", cached), ("kb", known), ("crawl", computed)]
    for name, tier in tiers:
        out = out.join(tier.select("product_id", F.col("report").alias(name)), "product_id", "left")
    source = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n, _ in tiers])
    return out.select("product_id", source.alias("source"), F.coalesce(*[n for n, _ in tiers]).alias("report"))


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, z: a.unionByName(z, allowMissingColumns=True), parts)


def incremental_concat(base: DataFrame | None, new: DataFrame, order: list[str], dedup: bool = True) -> DataFrame:
    """Newest base (if any) followed by the new rows, optionally without
    repeated reviews; the base row wins."""
    parts = [(0, base), (1, new)] if base is not None else [(1, new)]
    both = concat_parts([df.withColumn("_part", F.lit(i)) for i, df in parts])
    if dedup:
        keys = [c for c in DEDUP_COLUMNS if c in both.columns]
        both = dedup_keep_first(both, keys, ["_part", *order])
    return both.drop("_part")


def kb_replace(kb: DataFrame, delta: DataFrame) -> DataFrame:
    """Every point of the products in ``delta`` gives way to the delta points;
    other products stay as they are."""
    return without_products(kb, delta).unionByName(delta, allowMissingColumns=True)


def kb_lookup(spark, path: str, ids: DataFrame, buckets: int = 64) -> DataFrame:
    """Documents of the given products from a stored knowledge base; buckets
    that hold none of them are not read."""
    wanted = ids.select("product_id", F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int").alias("bucket"))
    return spark.read.parquet(path).join(wanted, ["bucket", "product_id"], "left_semi").drop("bucket")


def kb_replace_stored(spark, path: str, delta: DataFrame, buckets: int = 64) -> None:
    """``kb_replace`` on a stored knowledge base, partitioned by ``bucket``.

    Only buckets of affected products are read and rewritten (dynamic
    partition overwrite), through a staged copy because a partition must not
    be overwritten while it is read.
    """
    from ..session import materialize

    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int")
    delta = delta.withColumn("bucket", bucket)
    kb = spark.read.parquet(path)
    touched = kb.join(delta.select("bucket").distinct(), "bucket", "left_semi")
    staged = materialize(kb_replace(touched, delta), "kb-replace")
    staged.write.mode("overwrite").options(**STORED, partitionOverwriteMode="dynamic").partitionBy("bucket").parquet(path)


def kb_replaced(spark, base: str, path: str, delta: DataFrame, buckets: int = 64) -> DataFrame:
    """``kb_replace`` beside a stored knowledge base: the buckets of affected products are written to ``path``, all
    others are read where they are. The base stays as it is for its readers."""
    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int")
    delta = delta.withColumn("bucket", bucket)
    touched = F.broadcast(delta.select("bucket").distinct())  # at most ``buckets`` rows
    kb = spark.read.parquet(base)
    kb_replace(kb.join(touched, "bucket", "left_semi"), delta).write.options(**STORED).partitionBy("bucket").parquet(path)
    return kb.join(touched, "bucket", "left_anti").unionByName(spark.read.schema(kb.schema).parquet(path))


def kb_rebuild(documents: DataFrame, path: str, buckets: int = 64) -> None:
    """Writes the whole knowledge base anew. The documents are made once, into a
    staged table; an empty one, repeated ids, or a copy that ends up with
    another number of rows fail before or after it becomes the base."""
    from ..session import materialize

    bucket = F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int")
    staged = materialize(documents.withColumn("bucket", bucket), "kb-rebuild")
    loaded = staged.count()
    if not loaded:
        raise ValueError("there are no documents")
    if not repeated_ids(staged).isEmpty():
        raise ValueError("document ids repeat")
    staged.write.mode("overwrite").options(**STORED).partitionBy("bucket").parquet(path)
    final = documents.sparkSession.read.parquet(path).count()
    if final != loaded:
        raise ValueError(f"{loaded} documents were loaded, {final} are there")


def repeated_ids(documents: DataFrame, key: str = "id") -> DataFrame:
    return documents.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def dataset_split(df: DataFrame, key: Column) -> DataFrame:
    """80 / 10 / 10 by a hash of the key: a row keeps its split for ever."""
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 10
    return df.withColumn(
        "split", F.when(bucket < 8, "train").when(bucket == 8, "dev").otherwise("test"))
