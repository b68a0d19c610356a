"""Per-title trending state for the stream (the only Python in a hot path).

Votes are counted per title and window map-side, before the shuffle, so a hot title sends one row per window
and Arrow batch; after it they are gathered into one row per title (each row and key costs far more in the
state operator than its votes).  A title's state is one value: the count of each open window and the outcome of its last closed one.  It is
read and written once per title and micro-batch (each access is a round trip to the JVM), and the rows of a title go back as
arrays, one row per kind.  Windows are closed by event-time timers, one per title at the end of its first open window, in order:

    reported = votes            if no state yet or votes > prev
               0                otherwise
    prev     = reported

Windows without votes do not touch the state.  Every change of an open window gives a row, and the windows
after it are judged again; a timer gives the window's last row.  A vote for a window that can't be counted in any
more, because the title's state has gone past it, is given back as a late row.

Spark's own watermark is set ``LATE_BOUND`` behind, so that Spark drops no vote before the state has seen it; the
processor adds the difference back, so timers fire by the wanted delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

LATE_BOUND_SECONDS = 3650 * 86400
# Rows of one task that are gathered by title at a time.
GATHER_ROWS = 500_000
STATE_SCHEMA = StructType([StructField("prev", LongType(), True), StructField("end", LongType(), True),
                           StructField("starts", ArrayType(LongType()), False), StructField("votes", ArrayType(LongType()), False)])


def window_partials(votes: DataFrame, title: str, ts: str, seconds: int) -> DataFrame:
    """``title, start, votes, seen``: votes per title and window of each Arrow batch (start in ms, seen: its last vote's time)."""
    kind = votes.schema[title].dataType.simpleString()
    length = seconds * 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            micros = batch.column(1).cast(pa.int64()).to_numpy()
            start = micros - micros % length
            t = pa.table({title: batch.column(0), "start": pa.array(start // 1000), "seen": pa.array(micros)})
            got = t.group_by([title, "start"]).aggregate([("seen", "count"), ("seen", "max")]).combine_chunks()
            if got.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [got.column(title).combine_chunks(), got.column("start").combine_chunks(), got.column("seen_count").combine_chunks().cast(pa.int64()),
                     got.column("seen_max").combine_chunks().cast(pa.timestamp("us", tz="UTC"))], names=[title, "start", "votes", "seen"])

    good = votes.where(F.col(title).isNotNull() & F.col(ts).isNotNull()).select(title, F.col(ts).cast("timestamp").alias(ts))
    return good.mapInArrow(run, f"{title} {kind}, start long, votes long, seen timestamp")


def gathered(partials: DataFrame, title: str, rows: int = GATHER_ROWS) -> DataFrame:
    """``title, starts, votes``: ``window_partials`` dealt by title, one row per title and ``rows`` rows of a task."""
    kind = partials.schema[title].dataType.simpleString()

    def one(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).group_by([title, "start"]).aggregate([("votes", "sum")])
        t = t.group_by(title).aggregate([("start", "list"), ("votes_sum", "list")])
        yield from t.select([title, "start_list", "votes_sum_list"]).rename_columns([title, "starts", "votes"]).to_batches(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from one(held)
                held, n = [], 0
        if held:
            yield from one(held)

    return partials.select(title, "start", "votes").repartition(title).mapInArrow(run, f"{title} {kind}, starts array<long>, votes array<long>")


class TrendingProcessor(StatefulProcessor):
    """``transformWithState`` processor over ``gathered`` rows; rows ``title, starts, votes, live, kind`` (``window_rows`` opens the arrays).

    ``kind``: ``open`` and ``closed`` rows hold the windows' votes so far; ``late`` rows only the votes that came too late.
    """

    def __init__(self, title: str, seconds: int, delay_seconds: int, mode: str = "reset", ttl_ms: int | None = None):
        self.title, self.ms, self.mode, self.ttl = title, seconds * 1000, mode, ttl_ms
        self.shift = (LATE_BOUND_SECONDS - delay_seconds) * 1000  # our watermark less Spark's

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE_SCHEMA)

    def _row(self, key, windows: list[tuple[int, int, bool]], kind: str) -> Row:
        starts, votes, live = (list(c) for c in zip(*windows, strict=True))
        return Row(**{self.title: key[0], "starts": starts, "votes": votes, "live": live, "kind": kind})

    def _judge(self, last: tuple[int | None, int | None], start: int, votes: int) -> tuple[bool, tuple[int, int]]:
        prev, end = last
        if self.ttl is not None and end is not None and start >= end + self.ttl:
            prev = end = None
        if self.mode == "growth":
            live = votes > (prev if end == start else 0)
            return live, (votes, start + self.ms)
        live = prev is None or votes > prev
        return live, (votes if live else 0, start + self.ms)

    def _read(self) -> tuple[tuple[int | None, int | None], dict[int, int]]:
        """(outcome of the last closed window, open windows)"""
        found = self.state.get()
        return ((found[0], found[1]), dict(zip(found[2], found[3], strict=True))) if found else ((None, None), {})

    def _write(self, last: tuple[int | None, int | None], windows: dict[int, int]) -> None:
        self.state.update((*last, list(windows), list(windows.values())))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added: dict[int, int] = {}
        for _, starts, votes in rows:
            for s, n in zip(starts, votes, strict=True):
                added[s] = added.get(s, 0) + n
        last, windows = self._read()
        gone = timerValues.getCurrentWatermarkInMs() + self.shift - self.ms - self.ttl if self.ttl is not None else None
        late = {s: n for s, n in added.items() if (last[1] is not None and s < last[1]) or (gone is not None and s <= gone)}
        out = [self._row(key, [(s, n, False) for s, n in late.items()], "late")] if late else []
        new = sorted(added.keys() - late.keys())
        if new:
            if not windows or new[0] < min(windows):
                self.handle.registerTimer(new[0] + self.ms - self.shift)
            for s in new:
                windows[s] = windows.get(s, 0) + added[s]
            self._write(last, windows)
            judged = []
            for s in sorted(windows):
                live, last = self._judge(last, s, windows[s])
                if s >= new[0]:
                    judged.append((s, windows[s], live))
            out.append(self._row(key, judged, "open"))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # every window that the watermark has passed; further timers of the title in this batch find nothing left to do
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) + self.shift
        last, windows = self._read()
        closed = []
        for s in sorted(s for s in windows if s + self.ms <= passed):
            live, last = self._judge(last, s, windows[s])
            closed.append((s, windows.pop(s), live))
        if closed:
            self._write(last, windows)
            if windows:
                self.handle.registerTimer(min(windows) + self.ms - self.shift)
            if self.ttl is not None:
                self.handle.registerTimer(last[1] + self.ttl - self.shift)
            return iter([self._row(key, closed, "closed")])
        if self.ttl is not None and not windows and last[1] is not None and last[1] + self.ttl <= passed:
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def window_rows(judged: DataFrame, title: str, seconds: int) -> DataFrame:
    """The processor's rows as ``title, window_start, window_end, votes, live, kind``, one per window."""
    one = judged.select(title, "kind", F.explode(F.arrays_zip("starts", "votes", "live")).alias("_w"))
    at = lambda ms: F.timestamp_millis(F.col("_w.starts") + F.lit(ms))
    return one.select(title, at(0).alias("window_start"), at(seconds * 1000).alias("window_end"),
                      F.col("_w.votes").alias("votes"), F.col("_w.live").alias("live"), "kind")
