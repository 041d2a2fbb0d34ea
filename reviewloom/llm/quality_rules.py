"""Quality rules: repetition within a document, and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30
#: A line is common when it stands in at least so many documents of its host, however many the host has.
COMMON_DOCUMENTS = 20
#: An edited line begins or ends with the same words as a shared line: with 8 of them from 16 words on, with 3 below.
SHORT_END, LONG_END = 3, 8
ENDS = ["head", "tail", "long_head", "long_tail"]
#: A text whose own lines are edited ones, for this share of their words, is a copy.
EDITED_SHARE = 0.5
#: Texts of shared lines only are copies of each other when so many of their smallest line hashes are equal.
LEAST_LINES = 3
#: Rows of a table of lines that goes to every task; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: A document is depleted when common lines hold more than this share of its words.
DEPLETED_SHARE = 0.7


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def repeated_words(text: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a window of ``window`` words found twice or more in the text.

    Windows are 64-bit hashes; only where two are equal are they sorted, so that equal ones stand side by
    side, and the places of those are merged into stretches.
    """

    def windows(hashed: Column) -> Column:
        each = F.transform(hashed, lambda h, i: F.xxhash64(h, *[F.get(hashed, i + k) for k in range(1, window)]))
        return F.slice(each, 1, F.greatest(F.size(hashed) - (window - 1), F.lit(0)))

    def stretches(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.transform(s, lambda x, k: F.when(
            ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]))
        places = F.array_sort(F.filter(_let(ordered, twice), lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.reduce(
            places, start,
            lambda a, i: F.struct((a["n"] + i + window - F.greatest(i, a["end"])).alias("n"), (i + window).alias("end")),
            lambda a: a["n"])

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return _let(_let(hashed, windows), lambda found: F.when(
        F.size(F.array_distinct(found)) < F.size(found), stretches(found)).otherwise(F.lit(0).cast("long")))


def base_rules(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long); 0 for null and for texts without words."""
    whole = F.coalesce(text, F.lit(""))
    own = [
        F.size(words(whole)).alias("n_words"),
        F.char_length(F.regexp_replace(whole, SPACE, "")).alias("word_chars"),
        F.regexp_count(whole, F.lit(SYMBOLS)).alias("n_symbols"),
        _let(lines(whole), lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        repeated_words(whole).alias("n_repeat_words")]
    return [c.cast("long") for c in own]


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def line_hash(line: Column) -> Column:
    """60 bits of the md5 of a normalised line."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def _line(line: Column) -> Column:
    """A normalised line as hashes: itself, its first and its last words; and its number of words."""
    n = F.char_length(line) - F.char_length(F.replace(line, F.lit(" "))) + 1
    end = lambda count: F.xxhash64(F.lit(count), F.call_function("substring_index", line, F.lit(" "), F.lit(count)))
    return F.struct(line_hash(line).alias("line"), n.cast("long").alias("words"), end(SHORT_END).alias("head"), end(-SHORT_END).alias("tail"),
                    end(LONG_END).alias("long_head"), end(-LONG_END).alias("long_tail"))


def _small(df: DataFrame) -> DataFrame:
    """A stored table for every task, if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _copies(rows: DataFrame, shared: DataFrame, ends: DataFrame) -> DataFrame:
    """(host_key, text_hash, copy, keys): the texts that hold any of the ``shared`` lines, and which.

    ``copy`` is what a text counts as. What a text holds beside shared lines tells whether it is a document of
    its own or a near copy: the other lines of a near copy are edited, so that most of them still begin or
    end like a shared line (``ends``), those of a document that merely carries boilerplate do not. All edited
    copies count as one; texts of nothing but shared lines count once for each set of smallest line hashes.
    """
    of_line = rows.join(_small(shared), "key", "left")
    long = F.col("words") >= 2 * LONG_END
    of_line = of_line.withColumn("first", F.when(long, F.col("long_head")).otherwise(F.col("head"))).withColumn(
        "last", F.when(long, F.col("long_tail")).otherwise(F.col("tail")))
    begun = ends.select(F.col("end").alias("first"), F.lit(True).alias("begins"))
    ended = ends.select(F.col("end").alias("last"), F.lit(True).alias("ends"))
    seen = of_line.join(_small(begun), "first", "left").join(_small(ended), "last", "left")
    own = F.col("is_shared").isNull()
    edited = own & (F.col("begins").isNotNull() | F.col("ends").isNotNull())
    texts = seen.groupBy("host_key", "text_hash").agg(
        F.sum(F.when(own, F.col("words")).otherwise(0)).alias("own"), F.sum(F.when(edited, F.col("words")).otherwise(0)).alias("edited"),
        F.collect_set(F.when(~own, F.struct("key", "line"))).alias("keys"))
    least = F.slice(F.sort_array(F.transform("keys", lambda k: k["line"])), 1, LEAST_LINES)
    copy = F.when(F.col("own") == 0, F.xxhash64(F.lit("set"), least)).when(
        F.col("edited") >= EDITED_SHARE * F.col("own"), F.xxhash64(F.lit("edited"))).otherwise(F.col("text_hash"))
    return texts.filter(F.size("keys") > 0).select("host_key", "text_hash", copy.alias("copy"), F.transform("keys", lambda k: k["key"]).alias("keys"))


def judge(docs: DataFrame, host: str = "source", common_documents: int = COMMON_DOCUMENTS,
          depleted_share: float = DEPLETED_SHARE) -> DataFrame:
    """doc_id, text_hash, the base figures, base_failed, removed_words, removed (line hashes) and kept.

    Lines are lower-cased, with one space for white space, and hashed. For every host the documents that
    hold a line are counted; copies and near copies are one document there (see :func:`_copies`), as else
    a group of copies would turn into common lines and vanish as a whole. Common lines are removed, and a
    document that loses most of its words with them is rejected.

    The text is read once; after that only hashes and counts move: 16 bytes a line for the first count, which
    proposes lines that enough different texts of a host share; only texts that hold such lines are looked at
    again. Tables of shared lines go to every task while they are small. Groups are keys of host and line or of
    host and text, combined before each shuffle, so a line that a third of all documents hold is one row per
    task. Defined cases: null and empty texts have figures of 0 and fail the base rules; a null host is a
    host; rows that repeat (same id and text) get the same verdict; an empty table gives an empty result;
    other columns are not read.
    """
    text = F.col("text").cast("string")
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = materialize(docs.select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit("host"), F.col(host).cast("string")).alias("host_key"),
        *[c.alias(n) for n, c in zip(figures, base_rules(text))],
        F.transform(F.transform(lines(text), _normal), _line).alias("lines")), "quality")

    rows = base.select("doc_id", "text_hash", "host_key", F.posexplode("lines").alias("place", "x")).select(
        "doc_id", "text_hash", "host_key", "place", "x.line", "x.words", F.xxhash64("host_key", "x.line").alias("key"),
        *[F.xxhash64("host_key", f"x.{c}").alias(c) for c in ENDS])
    shared = materialize(rows.select("key", "text_hash").distinct().groupBy("key").agg(F.count("*").alias("n")).filter(
        F.col("n") >= common_documents).select("key", F.lit(True).alias("is_shared")), "shared")
    ends = materialize(rows.join(_small(shared), "key").select(F.explode(F.array(*ENDS)).alias("end")).distinct(), "ends")
    common = materialize(_copies(rows, shared, ends).select("copy", F.explode("keys").alias("key")).distinct().groupBy("key").agg(
        F.count("*").alias("n")).filter(F.col("n") >= common_documents).select("key"), "common")
    lost = rows.join(_small(common), "key").select(
        F.col("doc_id").alias("i"), F.col("text_hash").alias("t"), F.col("host_key").alias("h"), "place", "words", "line").distinct()
    lost = lost.groupBy("i", "t", "h").agg(F.sum("words").alias("removed_words"), F.sort_array(F.collect_set("line")).alias("removed"))
    same = lambda a, z: F.col(a).eqNullSafe(F.col(z))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    gone = F.coalesce("removed_words", F.lit(0).cast("long"))
    return base.join(lost, same("doc_id", "i") & same("text_hash", "t") & same("host_key", "h"), "left").select(
        "doc_id", "text_hash", "host_key", *figures, failed.alias("base_failed"), gone.alias("removed_words"), "removed",
        (~failed & (gone <= depleted_share * F.col("n_words"))).alias("kept"))


def clean(docs: DataFrame, host: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, without their common lines; n_chars, if there, follows."""
    text = F.col("text").cast("string")
    verdicts = judge(docs, host, **options).filter("kept").select(F.struct(
        "doc_id", "text_hash", "host_key").alias("_q_key"), F.col("removed").alias("_q_removed")).groupBy("_q_key").agg(
        F.first("_q_removed").alias("_q_removed"))
    key = F.struct(F.col("doc_id"), F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit("host"), F.col(host).cast("string")).alias("host_key"))
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("_q_removed", line_hash(_normal(x)))), "\n")
    out = docs.withColumn("_q_own", key).join(verdicts, F.col("_q_own").eqNullSafe(F.col("_q_key"))).withColumn(
        "text", F.when(F.col("_q_removed").isNull(), text).otherwise(left)).drop("_q_own", "_q_key", "_q_removed")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
