"""Spelling variants: words that differ by one edited character, found by sorted permuterm rotations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.session import materialize

#: What is no letter, as ranges: a negated class of several ranges takes Java's matcher 25 times as long.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x{BF}\x{100}-\x{10FFFF}]+"
#: Marks the end of a word in its rotations; no letter.
END = "$"
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form occurs at least so many times as often as the word.
RATIO = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(word: Column) -> Column:
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def vocabulary(docs: DataFrame, spelt: Callable[[Column, Column], Column] | None = None,
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the runs of letters in ``docs`` (doc_id, text), A-Z lower-cased, that have at least
    ``least_length`` code points and occur at least ``least_count`` times.

    ``spelt`` (doc_id, run) may rewrite each run before it is counted, without making it longer. Occurrences
    are counted on the map side first. Null and empty texts have no words, a null doc_id is passed on as an
    empty string, rows that repeat count each; other columns are not read.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode_outer(
        F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), BETWEEN)).alias("run"))
    runs = runs.filter(F.char_length("run") >= least_length).select("doc_id", _lower(F.col("run")).alias("run"))
    word = spelt(F.col("doc_id"), F.col("run")) if spelt else F.col("run")
    return runs.groupBy(word.alias("word")).agg(F.count("*").alias("n")).filter(
        (F.col("n") >= least_count) & (F.char_length("word") >= least_length))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, n): the rotations of every marked word of ``words`` (word, n), twice each: whole, and as
    what stands before its last character. Words that are one replacement apart have the same rotation up
    to the last character; a word with one character less has that prefix as a whole rotation."""
    word, at = F.col("word"), F.col("at")
    places = words.filter("word <> ''").select("word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("at"))
    whole = places.select(
        F.concat(F.substring(word, at + 1, F.char_length(word)), F.lit(END), F.substring(word, F.lit(1), at)).alias("prefix"),
        F.lit("").alias("edited"), "n")
    cut = places.filter(at < F.char_length(word)).select(
        F.concat(F.substring(word, at + 2, F.char_length(word)), F.lit(END), F.substring(word, F.lit(1), at)).alias("prefix"),
        F.substring(word, at + 1, F.lit(1)).alias("edited"), "n")
    return whole.unionByName(cut)


def _same_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of rows with one prefix, and where each begins; holds one batch and the run that may go on."""
    held = None

    def starts(rows: pa.Table) -> np.ndarray:
        prefix = rows["prefix"].combine_chunks()
        changed = pc.not_equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(changed) + 1])

    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None or not len(held) else pa.concat_tables([held, now])
        if len(held):
            at = starts(held)
            if len(at) > 1:
                yield held.slice(0, at[-1]), at[:-1]
                held = held.slice(at[-1])
    if held is not None and len(held):
        yield held, starts(held)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a prefix its near words there: how many, and the one that occurs most often.

    A prefix has at most one word for each letter and one without, so a run is short. An inserted character that
    repeats the one before it is left to the prefix where it comes first, so that each pair counts once.
    """
    for rows, starts in _same_prefix(batches):
        sizes = np.diff(np.append(starts, len(rows)))
        several = np.repeat(sizes > 1, sizes)
        if not several.any():
            continue
        rows, sizes = rows.filter(pa.array(several)), sizes[sizes > 1]
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        count = np.repeat(sizes, sizes)
        i = np.repeat(np.arange(len(rows)), count)
        j = np.repeat(first, count) + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        prefix, edited = rows["prefix"].combine_chunks(), rows["edited"].combine_chunks()
        parts = pc.split_pattern(prefix, END).flatten()
        after, before = parts.take(pa.array(np.arange(0, len(parts), 2))), parts.take(pa.array(np.arange(1, len(parts), 2)))
        words = pc.binary_join_element_wise(before, edited, after, "")
        whole = pc.equal(edited, "").to_numpy(zero_copy_only=False)
        again = pc.and_(pc.equal(pc.utf8_slice_codeunits(before, -1), edited), pc.not_equal(edited, "")).to_numpy(zero_copy_only=False)
        near = (i != j) & ~(whole[i] & again[j]) & ~(whole[j] & again[i])
        i, j = i[near], j[near]
        if not len(i):
            continue
        n, rank = rows["n"].to_numpy(), pc.rank(words, tiebreaker="dense").to_numpy()
        order = np.lexsort((rank[j], -n[j], i))
        own, at, times = np.unique(i[order], return_index=True, return_counts=True)
        best = j[order][at]
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(own)), pa.array(times), words.take(pa.array(best)), pa.array(n[best])],
            ["word", "n_near", "best", "best_n"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words in ``words`` (word, n; distinct) that have near words, those
    that differ by one inserted, deleted or replaced code point; ``best`` is the most frequent of them, of
    equal ones the smallest by code point.

    All rotations are sorted, and each run of one prefix is scanned once. Runs have at most as many rows as
    there are letters, so nothing about a common word is hot, and pairs are reduced where they are found.
    """
    found = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "edited").mapInArrow(
        _scan, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("most"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.most")).alias("best_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form; without circles) along the forms to the last one.

    Each round doubles the distance, so a chain of ``n`` forms takes log2(n) rounds; the rounds are stored."""
    held = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(held.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        held = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return held


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word, n).

    A word's form is its most frequent near word (:func:`near_words`), if that occurs at least ``ratio`` times as
    often; else form and form_n are null. ``root`` is where the forms lead, the word itself if it has none.
    Counts grow along the forms, so a chain ends after a few steps. Words must be distinct and not null; the
    mark ``$`` must not occur in them (others are no words of :func:`vocabulary`). An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("forms must occur more often than their words")
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "words")
    kept = F.col("best_n") >= ratio * F.col("n")
    formed = materialize(words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(kept, F.col("best")).alias("form"), F.when(kept, F.col("best_n")).alias("form_n")), "formed")
    roots = last_forms(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
