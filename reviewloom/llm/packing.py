"""Packing documents into token sequences: best-fit decreasing with a segment tree of capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tokens import encoded

CAPACITY = 2048
#: Pieces that one task packs at a time. A group leaves one sequence at most that is not half full.
GROUP_PIECES = 8192


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length and the ids (little-endian unsigned 32-bit) of every piece.

    A document is the ids of its whole text and ``end_id``; only one that is longer than ``capacity`` is
    cut, into pieces of that length and a rest. A null or empty text is ``end_id`` alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.columns
            rows, held = [], 0
            for name, ids in zip(names.to_pylist(), encoded(texts, tokenizer)):
                ids = np.append(ids.astype("<u4"), np.array([end_id], "<u4"))
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((name, k, start, len(part), part.tobytes()))
                    held += len(part)
                if held > 1 << 18:
                    yield table(rows)
                    rows, held = [], 0
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary")


class OpenBins:
    """Open sequences by the room they have left. The leaves of a segment tree count the sequences with
    each capacity, so the tightest one that still fits is found in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.counts[at] += by
            at >>= 1

    def put(self, room: int, name: int) -> None:
        self.bins[room].append(name)
        self._change(room, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """(room, name) of a sequence with the least room that is ``need`` or more, taken out."""
        counts, at = self.counts, need + self.leaves
        if not counts[at]:
            while at > 1 and (at & 1 or not counts[at + 1]):
                at >>= 1
            if at == 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not counts[at]:
                    at += 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the place in it of every length; each length is 1 to ``capacity``."""
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, n = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        found = opened.take_tightest(length)
        if found is None:
            found, n = (capacity, n), n + 1
        room, bins[i] = found
        places[i] = capacity - room
        opened.put(room - length, bins[i])
    return bins, places


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` (a stored table with a column ``length`` of 1 to ``capacity``) with sequence_id and offset.

    A full piece is a sequence of its own. The others are dealt by a hash of the row's place to groups of
    about ``group_pieces``, each packed by one task, so that no task grows with the table and rows that
    are alike do not meet in one. Rows that repeat are packed each; an empty table stays empty.
    """
    rows = parts.withColumn("_row", F.monotonically_increasing_id())
    full = rows.filter(F.col("length") >= capacity).select(
        *parts.columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))

    names = parts.columns

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_row")
        bins, places = best_fit_decreasing(group["length"].to_numpy(), capacity)
        bins += group["_group"].to_numpy() * (1 << 32)
        return group.select(names).append_column("sequence_id", pa.array(bins)).append_column(
            "offset", pa.array(places))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema.fields)
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups).cast("long")))
    return dealt.groupBy("_group").applyInArrow(run, schema).unionByName(full)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (an array) of packed pieces with their ids, each at its offset."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("_parts")).select(
        "sequence_id", F.reduce("_parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
