"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of the filter for each listed key (16 make one in about 400 others pass) and bits a key sets.
BITS_A_KEY, BITS_SET = 16, 4
#: A block is one 64-bit number, so a look-up reads one row. Filters with more blocks are joined by a shuffle.
BROADCAST_BLOCKS = 2_000_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """One name for the spellings of a page: without scheme, www. or m., query, fragment, port, .html and last slash."""
    host = F.regexp_replace(F.regexp_replace(host, r":\d+$", ""), r"^(?:www|m)\.", "")
    return F.concat(host, F.regexp_replace(F.regexp_replace(path, r"/$", ""), r"\.html?$", ""))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), blocks)


def _mask(key: Column) -> Column:
    """The ``BITS_SET`` bits of a key within its block."""
    hashed = F.xxhash64(F.lit("mask"), key)
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        mask = mask.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return mask


def bloom_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """(block, bits) of the blocks that hold any of ``listed`` (key), and the number of blocks. The size
    follows the list: ``BITS_A_KEY`` bits for each distinct key."""
    keys = listed.filter("key is not null").select("key").distinct()
    blocks = max(1, -(-keys.count() * BITS_A_KEY // 64))
    return keys.select(_block(F.col("key"), F.lit(blocks).cast("long")).alias("block"), _mask(F.col("key")).alias("mask")).groupBy(
        "block").agg(F.bit_or("mask").alias("bits")), blocks


def possible_hits(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of ``keys`` (key, ...) that the filter lets pass: all that are listed and a few others. A filter
    of proven small size goes to every task, so nothing of ``keys`` moves; a larger one is joined by block."""
    filled, blocks = bloom_filter(listed)
    filled = filled.withColumnRenamed("block", "_block")
    side = F.broadcast(filled) if blocks <= BROADCAST_BLOCKS else filled
    probed = keys.withColumn("_block", _block(F.col("key"), F.lit(blocks).cast("long"))).withColumn("_mask", _mask(F.col("key")))
    return probed.join(side, "_block").filter(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).drop(
        "_block", "_mask", "bits")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame) -> DataFrame:
    """page_id, url, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    ``rules`` are (verdict, host, path) and fit their host and its subdomains where the path begins with
    theirs; the longest wins, of two as long the one that blocks, then the first by name. ``listed`` (url)
    is a list of any length: a page with a listed canonical URL is blocked unless a rule fits. All other
    pages are allowed. Both kinds go through one filter, as keys that a page's URL may spell: its suffixes
    by label, as many labels as rules have, with its path cut to their lengths, and its canonical URL. What passes is joined
    to the list by hash, which takes out false positives.

    Defined cases: null urls and those without ``://`` have an empty host and path and are allowed; rows
    that repeat get the same verdict; an empty list blocks nothing; an empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url")).withColumn("host", host_of(F.col("url"))).withColumn(
        "path", path_of(F.col("url")))
    lengths, most = sorted({len(path) for _, _, path in rules}), max((h.count(".") + 1 for _, h, _ in rules), default=1)
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."))
    spelt = F.flatten(F.transform(suffix, lambda s: F.array_compact(F.array(*[
        F.when(F.char_length("path") >= n, F.concat(F.lit("rule "), s, F.substring("path", 1, n))) for n in lengths]))))
    own = F.concat(F.lit("page "), canonical(F.col("host"), F.col("path")))
    keys = rows.filter("host <> ''").select(
        "page_id", "url", F.explode(F.array_distinct(F.concat(spelt, F.array(own)))).alias("key"))

    spark = pages.sparkSession
    by_rule = spark.createDataFrame(
        [(f"rule {h}{p}", f"{h}{p}", v, len(h) + len(p)) for v, h, p in rules], "key string, rule string, verdict string, length int")
    listed_url = F.col("url").cast("string")
    by_page = listed.select(listed_url.alias("url")).filter("url is not null").select(
        F.concat(F.lit("page "), canonical(host_of(F.col("url")), path_of(F.col("url")))).alias("key")).distinct()
    entries = by_rule.unionByName(by_page.select(
        "key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(-1).alias("length")))
    hits = possible_hits(keys, entries).join(entries, "key").groupBy("page_id", "url").agg(F.min(F.struct(
        (-F.col("length")).alias("longest"), F.when(F.col("verdict") == "block", 0).otherwise(1).alias("order"),
        "rule", "verdict")).alias("best"))
    hits = hits.select(F.col("page_id").alias("_id"), F.col("url").alias("_url"), "best.rule", "best.verdict")
    return rows.join(hits, F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")), "left").select(
        "page_id", "url", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
