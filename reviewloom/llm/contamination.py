"""Passages of a benchmark in documents: winnowed fingerprints, joined and extended to whole windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.session import materialize

#: Words of a window; an item with fewer words is one window of its own length.
WINDOW = 10
#: Rows of a table that goes to every task; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: The lowest bits of a k-gram's hash hold its place, so that the smallest of a window tells where it stands;
#: the same number of bits holds a window's length beside its start.
PLACE_BITS = 4
ENDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased; none for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, ENDS), "")


def gram_and_span(length: int) -> tuple[int, int]:
    """(k, w): the smallest of every ``w`` neighbouring k-grams is kept, so that any shared span of
    ``k + w - 1 = length`` words shares a fingerprint."""
    k = max(1, length // 2)
    return k, length - k + 1


def _grams(hashes: str, length: int) -> Column:
    """The hash of every k-gram; its lowest bits are its place."""
    k, _ = gram_and_span(length)
    low = (1 << PLACE_BITS) - 1
    return F.transform(hashes, lambda h, i: F.xxhash64(
        F.lit(length), h, *[F.get(hashes, i + a) for a in range(1, k)]).bitwiseAND(F.lit(~low).cast("long")).bitwiseOR(
        i.bitwiseAND(F.lit(low)).cast("long")))


def fingerprints(rows: DataFrame, keys: list[str], length: int) -> DataFrame:
    """(keys, place, print) of the ``hashes`` (one 64-bit hash a word) in ``rows``: each k-gram that is the
    smallest of some window of ``length`` words, once. Rows with fewer words have none.

    The windows are walked by an exploded counter, in generated code and without a shuffle. Of equal k-grams
    in a window any one may stand for both, as their fingerprints are equal. A window whose smallest k-gram is
    the one of the window before adds nothing.
    """
    _, w = gram_and_span(length)
    low = F.lit((1 << PLACE_BITS) - 1)
    least = lambda at: F.least(*[F.get("grams", at + a) for a in range(w)]) if w > 1 else F.get("grams", at)
    n = F.size("grams")
    walked = rows.select(*keys, _grams("hashes", length).alias("grams")).select(*keys, "grams", F.explode_outer(
        F.when(n >= length, F.sequence(F.lit(0), n - length))).alias("at")).filter("at is not null")
    here = least(F.col("at"))
    new = walked.filter((F.col("at") == 0) | (here != least(F.col("at") - 1))).select(*keys, "at", here.alias("here"))
    ahead = (F.col("here").bitwiseAND(low.cast("long")).cast("int") - F.col("at")).bitwiseAND(low)
    return new.select(*keys, (F.col("at") + ahead).alias("place"),
                      F.col("here").bitwiseAND(F.bitwise_not(low.cast("long"))).alias("print"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for every task, if its ``rows`` stay below the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def windows(benchmark: DataFrame, longest: int = WINDOW) -> DataFrame:
    """(item_id, length, window, hashes of its words): every run of ``longest`` words of an item, or the item if
    it is shorter. Items without words have none."""
    split = benchmark.select(F.col("item_id").cast("string"), words(F.col("text")).alias("words"))
    n = F.size("words")
    length = F.least(n, F.lit(longest))
    cut = split.select("item_id", "words", length.alias("length"), F.explode_outer(
        F.when(n > 0, F.sequence(F.lit(1), n - length + 1))).alias("at")).filter("at is not null")
    return cut.select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("own")).select(
        "item_id", "length", F.array_join("own", " ").alias("window"), F.transform("own", lambda w: F.xxhash64(w)).alias("hashes"))


def hits(docs: DataFrame, listed: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, length, window) of every place where a window of ``listed`` occurs.

    ``found`` (doc_id, text_hash, place, length) are shared fingerprints. Each is extended to all windows of
    its length that may hold it, and their words are compared with those listed. Only documents with a shared
    fingerprint are split again; a document's places are at most its words.
    """
    k = F.greatest(F.lit(1), F.floor(F.col("length") / 2))
    places = found.groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).agg(F.collect_set(
        F.struct("place", "length", (F.col("length") - k).cast("int").alias("reach"))).alias("places"))
    places = materialize(places, "places")
    n_places = places.agg(F.sum(F.size("places"))).first()[0] or 0
    text = F.col("text").cast("string")
    held = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")).join(
        _small(places, n_places), F.col("doc_id").eqNullSafe(F.col("i")) & F.col("text_hash").eqNullSafe(F.col("t")))
    split = held.select("doc_id", "text_hash", words(F.col("text")).alias("words"), "places")
    starts = F.flatten(F.transform("places", lambda p: F.transform(
        F.sequence(F.greatest(p["place"] - p["reach"], F.lit(0)), F.least(p["place"], F.size("words") - p["length"])),
        lambda s: F.call_function("shiftleft", s, F.lit(PLACE_BITS)).bitwiseOR(p["length"]))))
    each = split.select("doc_id", "text_hash", "words", F.explode_outer(F.array_distinct(starts)).alias("x")).select(
        "doc_id", "text_hash", "words", F.shiftright("x", PLACE_BITS).alias("start"),
        F.col("x").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("length")).filter("start is not null")
    each = each.select("doc_id", "text_hash", "start", "length",
                       F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ").alias("window"))
    known = listed.select("window").distinct()
    return each.join(_small(known, known.count()), "window", "left_semi")


def contaminated(docs: DataFrame, benchmark: DataFrame, longest: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items (sorted ids) and contaminated for every row of ``docs`` (doc_id, text).

    A word is hit when it lies in an occurrence of a window of ``benchmark`` (item_id, text). Windows are
    found by winnowing: the smallest k-gram hash of every neighbourhood is kept on both sides, equal ones
    are joined, and what is shared is extended to whole windows and compared word by word. A window that
    occurs always shares a fingerprint (:func:`gram_and_span`), so nothing is missed; hashes only propose,
    equal words decide. Items shorter than ``longest`` get fingerprints of their own length, and the documents
    are walked once for each length that occurs (at most ``longest``).

    Fingerprints of documents are joined where they are as long as the benchmark has at most
    ``BROADCAST_ROWS``, beyond that by a shuffle. Hits are counted by document, never by passage.

    Defined cases: null and empty texts have no words and are clean; rows that repeat (same id and text) get
    the same verdict; a null doc_id is an id; an item without an id hits words but is not listed, items that
    share an id are one; an empty benchmark hits nothing, an empty table gives an empty result. Other columns
    are not read.
    """
    if not 1 <= longest < 1 << PLACE_BITS:
        raise ValueError(f"windows have 1 to {(1 << PLACE_BITS) - 1} words")
    text = F.col("text").cast("string")
    listed = materialize(windows(benchmark, longest), "windows")
    hashed = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("hashes"))
    lengths = sorted(r.length for r in listed.select("length").distinct().collect())
    found = []
    for length in lengths:
        theirs = materialize(fingerprints(listed.filter(F.col("length") == length), [], length).select("print").distinct(), "prints")
        found.append(fingerprints(hashed, ["doc_id", "text_hash"], length).join(
            _small(theirs, theirs.count()), "print", "left_semi").select("doc_id", "text_hash", "place", F.lit(length).alias("length")))
    base = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.size(words(text)).cast("long").alias("n_words"))
    if not found:
        return base.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
                           F.lit(False).alias("contaminated"))
    at = materialize(hits(docs, listed, reduce(DataFrame.unionByName, found)), "hits")
    key = [F.col("doc_id").alias("i"), F.col("text_hash").alias("t")]
    starts = F.sort_array(F.collect_set(F.struct("start", "length")))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = at.groupBy(*key).agg(starts.alias("starts")).select("i", "t", F.reduce("starts", none, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["start"] + s["length"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
        F.greatest(a["end"], s["start"] + s["length"]).alias("end")), lambda a: a["n"]).alias("n_hit"))
    ids = listed.filter("item_id is not null").select("window", "item_id").distinct()
    named = at.select(*key, "window").distinct().join(_small(ids, ids.count()), "window").groupBy("i", "t").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"))
    same = lambda other: F.col("i").eqNullSafe(other["j"]) & F.col("t").eqNullSafe(other["u"])
    named = named.select(F.col("i").alias("j"), F.col("t").alias("u"), "items")
    verdicts = materialize(covered.join(named, same(named), "left").select(
        "i", "t", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")), "verdicts")
    return base.join(
        verdicts, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("text_hash").eqNullSafe(F.col("t")), "left"
    ).select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
             F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


#: Every window of ten words against every place, by its words.
SQL = r"""
WITH i AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (
  SELECT item_id, least(len(w), 10) AS g, array_to_string(w[s + 1:s + least(len(w), 10)], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (
  SELECT doc_id, s, g, array_to_string(w[s + 1:s + g], ' ') AS win
  FROM (SELECT doc_id, w, g, unnest(range(0, len(w) - g + 1)) AS s FROM d, (SELECT DISTINCT g FROM v) WHERE len(w) >= g)),
h AS (SELECT * FROM p WHERE win IN (SELECT win FROM v)),
c AS (SELECT doc_id, count(DISTINCT word)::BIGINT AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + g)) AS word FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items,
             array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids
      FROM h JOIN v USING (win) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
