"""The stalled-ingestion rule in a stream: event-time timers fire when no row comes.

Time is cut into buckets as wide as the tolerated silence. The state of a key holds the first and
last row of each bucket that the watermark has not passed, and the last row before: a few numbers,
however many rows a key has. A timer at a bucket's end settles it. If by then nothing follows
the last row in time, a stall opens at once, or when its own timer fires; a later row closes it.

A key may hold all rows of the stream. Its rows are therefore cut by time into slices first: a processor
of their own, spread over the cluster, makes two times per bucket of a batch's rows that the watermark
lets through, and only these meet in the key's task.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from walletscope import params

CHANGE = "key string, starts_us bigint, ends_us bigint"
ENDS = "key string, first_us bigint, last_us bigint, at timestamp"
#: Slices of a key; neighbouring buckets lie in different ones.
SLICES = 64
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class Ends(StatefulProcessor):
    """First and last row per bucket of a batch's rows; keeps no state, and rows without a time count for nothing."""

    def __init__(self, quiet_seconds: int):
        self.quiet = quiet_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        quiet, ends = self.quiet, {}
        for r in rows:
            at = r.at_us
            if at is None:
                continue
            bucket = at // quiet
            held = ends.get(bucket)
            if held is None:
                ends[bucket] = [at, at]
            elif at < held[0]:
                held[0] = at
            elif at > held[1]:
                held[1] = at
        # What goes on to the next operator has to be ahead of the watermark that this batch may bring.
        ahead = _EPOCH + timedelta(milliseconds=max(timerValues.getCurrentWatermarkInMs(), 0) + 1)
        for first, last in ends.values():
            yield Row(key=key[0], first_us=first, last_us=last, at=max(_EPOCH + timedelta(microseconds=last), ahead))

    def close(self) -> None:
        pass


class Silence(StatefulProcessor):
    """Stalls of a key: opened without an end, and closed with one."""

    def __init__(self, quiet_seconds: int):
        self.quiet = quiet_seconds * 1_000_000
        self.quiet_ms = quiet_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "bucket bigint", "first_us bigint, last_us bigint")
        self.last = handle.getValueState("last", "at_us bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        ends: dict[int, tuple[int, int]] = {}
        for r in rows:
            first, last = ends.get(r.first_us // self.quiet, (r.first_us, r.last_us))
            ends[r.first_us // self.quiet] = (min(first, r.first_us), max(last, r.last_us))
        for bucket, (first, last) in ends.items():
            if self.pending.containsKey((bucket,)):
                old = self.pending.getValue((bucket,))
                first, last = min(first, old[0]), max(last, old[1])
            else:
                self.handle.registerTimer((bucket + 1) * self.quiet_ms)
            self.pending.updateValue((bucket,), (first, last))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        bucket = (now // self.quiet_ms - 1,)
        if now % self.quiet_ms == 0 and self.pending.containsKey(bucket):
            first, last = self.pending.getValue(bucket)
            self.pending.removeKey(bucket)
            if self.last.exists() and first > (silent := self.last.get()[0] + self.quiet):
                yield Row(key=key[0], starts_us=silent, ends_us=first)
            self.last.update((last,))
            due = -(-(last + self.quiet) // 1000)
            if due > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(due)
                return
        if self.last.exists():
            silent = self.last.get()[0] + self.quiet
            if silent <= timerValues.getCurrentWatermarkInMs() * 1000 and not self._followed(silent):
                yield Row(key=key[0], starts_us=silent, ends_us=None)

    def _followed(self, silent: int) -> bool:
        """Whether a row came by the time ``silent``: one that late after the last is in that time's bucket."""
        bucket = (silent // self.quiet,)
        return self.pending.containsKey(bucket) and self.pending.getValue(bucket)[0] <= silent

    def close(self) -> None:
        pass


def stalls(stream: DataFrame, key: str, ts: str, delay: str = "10 minutes",
           quiet_seconds: int = params.STALL_WINDOW_SECONDS + params.STALL_HOLD_SECONDS) -> DataFrame:
    """Openings and closings of stalls by key. Rows behind the watermark do not count.

    The watermark is that of all keys, so a key that falls silent is noticed as long as others, or
    clock rows under a NULL key, go on.
    """
    at_us = F.unix_micros(ts)
    slice_no = F.pmod(F.floor(at_us / (quiet_seconds * 1_000_000)), F.lit(SLICES)).cast("int")
    narrow = stream.select(F.col(key).cast("string").alias("key"), slice_no.alias("slice"), F.col(ts).alias("at"), at_us.alias("at_us"))
    ends = narrow.withWatermark("at", delay).groupBy("key", "slice").transformWithState(
        Ends(quiet_seconds), ENDS, "append", "EventTime", eventTimeColumnName="at")
    return ends.groupBy("key").transformWithState(Silence(quiet_seconds), CHANGE, "append", "EventTime")


def firing(changes: DataFrame, as_of: Column, alert: str = "ingestion_stalled", label: str = "chain") -> DataFrame:
    """Firing intervals up to ``as_of``, from all openings and closings; replays of a change are one."""
    start, end = F.timestamp_micros("starts_us"), F.timestamp_micros(F.max("ends_us"))
    return (changes.where("key IS NOT NULL").groupBy("key", "starts_us").agg(end.alias("_end")).where(start < as_of)
            .select(F.lit(alert).alias("alert"), F.lit("warning").alias("severity"),
                    F.concat(F.lit(f"{label}="), F.col("key")).alias("series"), start.alias("starts_at"),
                    F.least(F.coalesce("_end", as_of), as_of).alias("ends_at")))
