"""Sessions of a stream, with state that ends when the watermark passes a session's gap: Spark's session windows, and keyed state with timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: The state store that timers and lists of state need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(sessions: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Sessions (begin, last, n) in order, put together where less than the gap lies between them."""
    out: list[list[int]] = []
    for begin, last, n in sorted(sessions):
        if out and begin < out[-1][1] + gap:
            out[-1][1], out[-1][2] = max(out[-1][1], last), out[-1][2] + n
        else:
            out.append([begin, last, n])
    return [tuple(s) for s in out]


class Sessions(StatefulProcessor):
    """Holds a key's open sessions, and hands each on when the watermark is past its last event by the gap.

    Rows may come in any order within the watermark's delay: one that falls between two open sessions joins them. A key
    without open sessions has no state. Times are whole microseconds.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "begun bigint, last bigint, n bigint")

    def _due(self, last: int) -> int:
        """The millisecond at which a session is over."""
        return -(-(last + self.gap) // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(map(int, s)) for s in self.open.get()]
        before = {self._due(last) for _, last, _ in held}
        for frame in rows:
            held += [(t, t, 1) for t in frame["at"].tolist()]
            held = merged(held, self.gap)
        self.open.put(held)
        after = {self._due(last) for _, last, _ in held}
        for due in before - after:
            self.handle.deleteTimer(due)
        for due in after - before:
            self.handle.registerTimer(due)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        held = [tuple(map(int, s)) for s in self.open.get()]
        over = [s for s in held if self._due(s[1]) <= due]
        left = [s for s in held if self._due(s[1]) > due]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        if over:
            yield pd.DataFrame({"user_id": [key[0]] * len(over), "begun": [b for b, _, _ in over], "n": [n for _, _, n in over]})

    def close(self) -> None:
        pass


def closed_sessions(events: DataFrame, delay: str = "1 hour", gap_seconds: int = 1800) -> DataFrame:
    """user_id, begun and n of each session that the watermark has passed, of a stream of events with user_id and ts.

    Rows of one session lie less than the gap apart. A row whose session alone would be over by the watermark is dropped, as
    are rows without a user or time. Spark holds a user's open sessions as state, and works on all users of a partition together.
    """
    # Spark puts together what is no more than its gap apart
    gap = f"{gap_seconds - 1} seconds 999 milliseconds 999 microseconds"
    given = events.where("user_id is not null and ts is not null").withWatermark("ts", delay)
    out = given.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("begun"), "n")


def timed_sessions(events: DataFrame, delay: str = "1 hour", gap_seconds: int = 1800) -> DataFrame:
    """The same by keyed state with timers, for what sessions must do beyond counting; each user costs several calls to the state.

    Rows later than the watermark are dropped. Needs ``STORE``.
    """
    given = events.where("user_id is not null and ts is not null").withWatermark("ts", delay).select("user_id", "ts", F.unix_micros("ts").alias("at"))
    out = given.groupBy("user_id").transformWithStateInPandas(Sessions(gap_seconds * 1_000_000), "user_id bigint, begun bigint, n bigint", "Append", "EventTime")
    return out.select("user_id", F.timestamp_micros("begun").cast("timestamp_ntz").alias("begun"), "n")
