"""Jobs whose state belongs to one user, conversation or product: several variables a key, timers, a time to live.

State is kept in RocksDB by the engine; a batch reads and writes the keys it holds. ``state`` reads it back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..constants import MAX_HISTORY
from . import jobs


def _with_ttl(keyed, processor: StatefulProcessor, schema: str) -> DataFrame:
    """A job whose state lives as long as its processor says. With a time to live it goes by the clock, and such a
    query has no end: start it with a trigger that goes on, as ``availableNow`` would never be through."""
    start = keyed.transformWithState if isinstance(processor, CountRows) else keyed.transformWithStateInPandas
    return start(processor, schema, "append", "processingTime" if processor.ttl else "none")


def state(spark: SparkSession, folder: str, name: str, variable: str) -> DataFrame:
    """What a job keeps in one of its variables: (key, value, ...) as of its last batch."""
    return spark.read.format("statestore").option("stateVarName", variable).load(f"{folder}/checkpoint-{name}")


# --- sessions of a user ------------------------------------------------------------------
class Sessions(StatefulProcessor):
    """Open sessions of a user as a list; one timer, at the end of the first of them, closes what has ended by then.

    An event opens a session or joins the one it touches, whatever order events come in, and one that lies between
    two sessions makes them one. Events older than the watermark are dropped by the engine.
    """

    def __init__(self, gap: int):
        self.gap = gap  # microseconds, as all times here but those of timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start bigint, end bigint, events bigint")

    @staticmethod
    def _due(session: tuple) -> int:
        """The first millisecond at which a session has ended."""
        return -(-session[1] // 1000)

    def _next(self, sessions: list[tuple]) -> int | None:
        return min(map(self._due, sessions), default=None)

    def _keep(self, sessions: list[tuple]) -> None:
        if sessions:
            self.open.put(sessions)
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sessions = [tuple(x) for x in self.open.get()] if self.open.exists() else []
        before, passed = self._next(sessions), timerValues.getCurrentWatermarkInMs()
        for part in rows:
            new = [(int(t), int(t) + self.gap, 1) for t in part["at"]]
            merged: list[tuple] = []
            for start, end, n in sorted(sessions + new):
                if merged and start <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(end, merged[-1][1]), merged[-1][2] + n)
                else:
                    merged.append((start, end, n))
            sessions = merged
        sessions = [s for s in sessions if self._due(s) > passed]
        first = self._next(sessions)
        if first != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if first is not None:
                self.handle.registerTimer(first)
        self._keep(sessions)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sessions = [tuple(x) for x in self.open.get()] if self.open.exists() else []
        # The timer was set for the first end; by now the watermark may have passed others.
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        done, left = [s for s in sessions if self._due(s) <= passed], [s for s in sessions if self._due(s) > passed]
        self._keep(left)
        if left:
            self.handle.registerTimer(self._next(left))
        if done:
            yield pd.DataFrame([(key[0], *s) for s in done], columns=["user_id", "start", "end", "events"])

    def close(self) -> None:
        pass


def chat_sessions(stream: DataFrame, folder: str, gap_minutes: int = 30, late_minutes: int = 10) -> DataFrame:
    """Activity sessions of each user (ts, user_id) so far: user_id, session_start, session_end, events, open.

    A session ends ``gap_minutes`` after its last event and comes out when the watermark passes that; those that
    are still open are read from the state and flagged. Nothing has to mark the end of the input.
    """
    spark = stream.sparkSession
    timed = stream.filter("ts IS NOT NULL AND user_id IS NOT NULL").select("ts", "user_id", F.unix_micros("ts").alias("at")).withWatermark(
        "ts", f"{late_minutes} minutes")
    schema = "user_id bigint, start bigint, end bigint, events bigint"
    closed = timed.groupBy("user_id").transformWithStateInPandas(Sessions(gap_minutes * 60_000_000), schema, "append", "eventTime")
    with jobs.rocksdb(spark):
        done = jobs.run(closed, folder, name="sessions")
    kept = state(spark, folder, "sessions", "open").select(F.col("key.user_id").alias("user_id"), "list_element.*")
    both = done.withColumn("open", F.lit(False)).unionByName(kept.withColumn("open", F.lit(True)))
    return both.select("user_id", F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("end").alias("session_end"), "events", "open")


# --- messages of a conversation ------------------------------------------------------------
class History(StatefulProcessor):
    """The last messages of a conversation as a list that new ones are added to, and the product it spoke of last
    as a value. The list is cut only when it holds several times what is asked for."""

    def __init__(self, n: int, ttl_ms: int | None = None):
        self.n, self.ttl = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.told = handle.getListState("told", "turn bigint, role string, content string", self.ttl)
        self.product = handle.getValueState("product", "product_id bigint, turn bigint", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, spoken = [], tuple(self.product.get()) if self.product.exists() else None
        known = spoken
        for part in rows:
            new = sorted([*new, *zip(part["turn"].astype(int), part["role"], part["content"])], key=lambda m: m[0])[-self.n:]
            for turn, linked in zip(part["turn"].astype(int), part["product_id"]):
                if not pd.isna(linked) and (spoken is None or turn >= spoken[1]):
                    spoken = int(linked), int(turn)
        old = [tuple(m) for m in self.told.get()] if self.told.exists() else []
        told = sorted(old + new, key=lambda m: m[0])[-self.n:]
        if len(old) + len(new) > 4 * self.n:
            self.told.put(told)
        else:
            self.told.appendList([(int(t), r, c) for t, r, c in new])
        if spoken != known:
            self.product.update(spoken)
        last = told[-1][0]
        yield pd.DataFrame({
            "conv_id": key[0], "turn": [m[0] for m in told], "role": [m[1] for m in told], "content": [m[2] for m in told],
            "product_id": pd.array([spoken[0] if spoken and m[0] == last else None for m in told], dtype="Int64")})

    def close(self) -> None:
        pass


HISTORY = "conv_id bigint, turn bigint, role string, content string, product_id bigint"


def histories(stream: DataFrame, n: int = MAX_HISTORY, ttl_ms: int | None = None) -> DataFrame:
    """Last ``n`` messages and current product of each conversation (conv_id, turn, role, content, product_id) in a batch.

    A batch adds its messages to the state and puts out the whole history of the conversations in it; new
    messages are taken in a part at a time, so a busy conversation stays small. A conversation that gets no
    message for ``ttl_ms`` is forgotten, see :func:`_with_ttl`.
    """
    said = stream.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", "role", "content", F.col("product_id").cast("string").alias("product_id"))
    return _with_ttl(said.groupBy("conv_id"), History(n, ttl_ms), HISTORY)


def session_history(stream: DataFrame, folder: str, n: int = MAX_HISTORY) -> DataFrame:
    """Runs :func:`histories` over all available input; the newest history of each conversation."""
    path = f"{folder}/history"
    with jobs.rocksdb(stream.sparkSession):
        jobs.run_batches(histories(stream, n), folder, lambda batch, i: jobs.write_batch(batch, path, i), name="history")
    return jobs.newest(jobs.read_batches(stream.sparkSession, path, HISTORY), ["conv_id"]).drop("batch_id")


# --- counts of a product ---------------------------------------------------------------------
class Counts(StatefulProcessor):
    """The last review count of a product as a value; a scan that finds another one comes out."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "review_count bigint", self.ttl)

    def _changed(self, product: int, scans: list[tuple]) -> list[tuple]:
        """Changes in (scan, review_count); the last count is kept."""
        kept = tuple(self.known.get() or ())
        known = before = kept[0] if kept else -1
        changed = []
        for scan, count in sorted(scans, key=lambda x: x[0]):
            if count != known:
                changed.append((product, scan, known, count))
            known = count
        if not kept or known != before or self.ttl:
            self.known.update((int(known),))
        return changed

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Most products have a few scans: plain lists, as every pandas step costs more than that.
        changed = self._changed(key[0], [x for part in rows for x in zip(part["scan"].tolist(), part["review_count"].tolist())])
        if changed:
            yield pd.DataFrame(changed, columns=_CHANGE)

    def close(self) -> None:
        pass


class CountRows(Counts):
    """The same by plain rows: a frame in and a frame out for every product cost several times what its scans do."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for change in self._changed(key[0], [(r.scan, r.review_count) for r in rows]):
            yield Row(**dict(zip(_CHANGE, change)))


_CHANGE = ["product_id", "scan", "previous_count", "current_count"]


def changes(stream: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Products whose review count changed between scans.

    Takes (product_id, scan, review_count), one row per product and scan, NULL
    counts being failed look-ups; a product never seen, or not for ``ttl_ms``
    (:func:`_with_ttl`), counts -1. A batch touches the products it holds.
    """
    counted = stream.select("product_id", "scan", "review_count").filter("review_count IS NOT NULL AND product_id IS NOT NULL")
    return _with_ttl(counted.groupBy("product_id"), CountRows(ttl_ms), ", ".join(f"{c} bigint" for c in _CHANGE))


def count_changes(stream: DataFrame, folder: str) -> DataFrame:
    """Runs :func:`changes` over all available input; all changes so far."""
    with jobs.rocksdb(stream.sparkSession):
        return jobs.run(changes(stream), folder, name="changes")
