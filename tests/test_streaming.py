"""Streams whose rows come late and out of order, in several batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import spark  # noqa: F401
from tidewell.streaming import closed_sessions, run_appended, windowed_counts
from tidewell.streaming.sessions import merged

START = datetime.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


@pytest.fixture
def stream(spark, tmp_path):  # noqa: F811
    """A stream with one batch for each list of (minutes, user, type)."""

    def make(batches):
        for i, rows in enumerate(batches):
            spark.createDataFrame([(100 * i + k, at(m) if m is not None else None, u, t, 1.5) for k, (m, u, t) in enumerate(rows)], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{i:03}")
        # by file time, so batches come in their order
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(str(tmp_path))

    return make


def windows(table):
    return {(int((r.begun - START).total_seconds() // 60), r.event_type): (r.n, r.total) for r in table.collect()}


def test_late_rows_count_while_their_window_is_open(spark, stream):  # noqa: F811
    batches = [[(5, 1, "a"), (70, 1, "a")], [(10, 2, "a"), (20, 2, "b"), (200, 1, "a")], [(190, 3, "b")], [(15, 3, "a"), (205, 1, "b")], [(600, 1, "a")]]
    table, counts = run_appended(windowed_counts(stream(batches), "1 hour", "1 hour"), spark)
    # the second batch moves the watermark to 140, which drops rows from the batch after the next on: the row at 15 comes too late
    assert windows(table) == {(0, "a"): (2, 3.0), (0, "b"): (1, 1.5), (60, "a"): (1, 1.5), (180, "a"): (1, 1.5), (180, "b"): (2, 3.0)}
    assert counts["dropped"] == 1 and counts["state"] == 1 and counts["most_state"] <= 6


def test_state_of_windows_does_not_grow_with_the_stream(spark, stream):  # noqa: F811
    batches = [[(60 * i + k, k, "a") for k in range(5)] for i in range(8)]
    table, counts = run_appended(windowed_counts(stream(batches), "1 hour", "1 hour"), spark)
    assert counts["dropped"] == 0 and counts["most_state"] <= 4 and len(windows(table)) == 6


def brute(rows, gap):
    users = {}
    for m, u, _ in rows:
        if m is not None and u is not None:
            users.setdefault(u, []).append((m, m, 1))
    return {(u, b, n, last) for u, own in users.items() for b, last, n in merged(own, gap)}


def test_sessions_join_over_batches_and_end_by_timers(spark, stream):  # noqa: F811
    rnd = random.Random(3)
    rows = [(rnd.randrange(900), rnd.randrange(4), "a") for _ in range(120)] + [(5, None, "a"), (None, 1, "a")]
    rows.sort(key=lambda r: (r[0] or 0) + rnd.randrange(50))  # out of order by less than the watermark's delay
    batches = [rows[i : i + 30] for i in range(0, len(rows), 30)] + [[(2000, 9, "a")]]
    table, counts = run_appended(closed_sessions(stream(batches), "1 hour", 1800), spark)
    got = {(r.user_id, int((r.begun - START).total_seconds() // 60), r.n) for r in table.collect()}
    # the last row's watermark closes all sessions but its own
    assert got == {(u, b, n) for u, b, n, _ in brute(rows, 30)} and table.count() == len(got)
    assert counts["dropped"] == 0 and counts["state"] <= 4


def test_sessions_drop_what_comes_after_the_watermark(spark, stream):  # noqa: F811
    table, counts = run_appended(closed_sessions(stream([[(0, 1, "a"), (500, 2, "a")], [(490, 2, "a")], [(1, 1, "a"), (505, 2, "a")], [(1000, 3, "a")]]), "1 hour", 1800), spark)
    got = {(r.user_id, int((r.begun - START).total_seconds() // 60), r.n) for r in table.collect()}
    assert got == {(1, 0, 1), (2, 490, 3)} and counts["dropped"] == 1


def test_sessions_that_a_row_between_joins():
    assert merged([(0, 0, 1), (50, 60, 2), (25, 25, 1), (200, 200, 1)], 30) == [(0, 60, 4), (200, 200, 1)]
    assert merged([(0, 0, 1), (30, 30, 1)], 30) == [(0, 0, 1), (30, 30, 1)] and merged([], 5) == []


def test_an_empty_stream_has_no_rows(spark, stream):  # noqa: F811
    table, counts = run_appended(closed_sessions(stream([[]])), spark)
    assert table.count() == 0 and counts["dropped"] == 0
    assert table.select(F.col("begun")).schema[0].dataType.simpleString() == "timestamp_ntz"
