"""The interval join against all pairs, on timestamps, dates and whole numbers, and as a join of two streams."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.test_plans import FOLDER, spark  # noqa: F401
from tests.test_streaming import stream  # noqa: F401
from tidewell.operators import interval_join
from tidewell.plans import views_before_purchases
from tidewell.streaming import event_pairs, run_appended


def brute(left, right, low, high):
    return sorted((a, b) for k, t, a in left for j, s, b in right if k is not None and k == j and t is not None and s is not None and low <= s - t <= high)


def numbers(seed, n, keys=4, span=200):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(keys), rnd.randrange(-span, span), i) for i in range(n)]
    return [*rows, (None, 5, n), (1, None, n + 1), (None, None, n + 2), (0, 7, n + 3), (0, 7, n + 4)]


@pytest.mark.parametrize(("low", "high"), [(-30, 0), (0, 0), (-1, 0), (5, 6), (-17, 40), (-1000, -150), (100, 1000)])
def test_pairs_equal_brute_force(spark, low, high):  # noqa: F811
    left, right = numbers(1, 90), numbers(2, 110)
    a, b = spark.createDataFrame(left, "k int, t int, a int"), spark.createDataFrame(right, "k int, t int, b int")
    want = brute(left, right, low, high)
    got = interval_join(a, b, ["k"], "t", low, high)
    assert got.columns == ["k", "t", "a", "right_t", "b"]
    assert sorted((r.a, r.b) for r in got.collect()) == want
    met = {x for x, _ in want}
    assert sorted(r.a for r in interval_join(a, b, ["k"], "t", low, high, "left_semi").collect()) == sorted(met)
    assert sorted(r.a for r in interval_join(a, b, ["k"], "t", low, high, "left_anti").collect()) == sorted({x for _, _, x in left} - met)
    outer = interval_join(a, b, ["k"], "t", low, high, "left").collect()
    assert sorted((r.a, -1 if r.b is None else r.b) for r in outer) == sorted([*want, *((x, -1) for _, _, x in left if x not in met)])


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_times_of_each_kind(spark, kind, zone):  # noqa: F811
    # the night in which this zone skips an hour: times without a zone must not notice
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        begin, unit = datetime.datetime(2024, 3, 9, 22), "day" if kind == "date" else "minute"
        rnd = random.Random(4)
        stamp = lambda n: F.expr(f"cast(timestamp_ntz'{begin}' + make_dt_interval(0, 0, n * {1440 if unit == 'day' else 1}, 0.000001) as {kind})").alias("t")
        sides = [[(0, rnd.randrange(600), i) for i in range(60)] for _ in range(2)]
        a, b = (spark.createDataFrame(rows, "k int, n int, v int").select("k", stamp("n"), "v", "n") for rows in sides)
        bound = datetime.timedelta(days=40) if unit == "day" else datetime.timedelta(minutes=25)
        got = interval_join(a, b, ["k"], "t", -bound, datetime.timedelta(0)).collect()
        if kind == "timestamp":
            want = [(r.v, r.w) for r in a.join(b.select("k", F.col("t").alias("s"), F.col("v").alias("w")), "k").where("s <= t and s >= t - interval 25 minutes").collect()]
        else:
            want = brute(*sides, -40 if unit == "day" else -25, 0)
        assert sorted((r.v, r.right_v) for r in got) == sorted(want) and want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clashing_names_repeated_rows_and_empty_sides(spark):  # noqa: F811
    a = spark.createDataFrame([(1, 5, 7), (1, 5, 7)], "K int, at int, right_V int")
    b = spark.createDataFrame([(1, 4, 9), (1, 4, 9), (2, 4, 9)], "K int, at int, right_v int")
    got = interval_join(a, b, ["K"], "at", -1, 0)
    assert got.columns == ["K", "at", "right_V", "right_at", "right_right_v"] and got.count() == 4
    assert interval_join(a.limit(0), b, ["K"], "at", -1, 0, "left").count() == 0
    assert interval_join(a, b.limit(0), ["K"], "at", -1, 0, "left").count() == 2
    assert interval_join(a, b.limit(0), ["K"], "at", -1, 0, "left_anti").count() == 2
    for wrong in ((3, 2, "inner"), (0, 1, "full")):
        with pytest.raises(ValueError):
            interval_join(a, b, ["K"], "at", *wrong)


def test_plan_has_no_nested_loop(spark):  # noqa: F811
    plan = views_before_purchases(spark, FOLDER)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan.replace("`", "")


def test_a_hot_key_is_spread_over_its_bins(spark):  # noqa: F811
    a = spark.range(30_000).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("t"), "id")
    b = a.select("k", (F.col("t") - 3).alias("t"), F.col("id").alias("other"))
    got = interval_join(a, b, ["k"], "t", -5, 0)
    assert got.count() == 30_000 and got.where("id <> other").count() == 0


def pairs(table):
    return sorted((r.event_id, r.earlier_id) for r in table.collect())


def test_streams_meet_over_batches_and_drop_their_state(spark, stream):  # noqa: F811
    rnd = random.Random(8)
    rows = sorted(((rnd.randrange(1500), rnd.randrange(3), rnd.choice("vp")) for _ in range(160)), key=lambda r: r[0] + rnd.randrange(40))
    batches = [rows[i : i + 20] for i in range(0, len(rows), 20)] + [[(5000, 9, "v")], [(None, 1, "p"), (5001, None, "p")]]
    given = [(100 * i + k, *r) for i, rows in enumerate(batches) for k, r in enumerate(rows)]
    want = sorted((p, v) for p, pt, pu, kind in given for v, vt, vu, other in given if (kind, other) == ("p", "v") and pt is not None and pu is not None and pu == vu and vt is not None and 0 <= pt - vt <= 60)
    events = stream(batches)
    table, counts = run_appended(event_pairs(events.where("event_type = 'v'"), events.where("event_type = 'p'")), spark)
    assert pairs(table) == want and len(want) > 20 and counts["dropped"] == 0
    # never more than a part of the 163 rows is held
    assert counts["most_state"] < 60 and counts["state"] < 30


def test_a_later_event_alone_comes_when_the_watermark_has_passed(spark, stream):  # noqa: F811
    # the watermark is the lesser of both sides', so either needs an event later on
    events = stream([[(0, 1, "v"), (30, 1, "p"), (200, 1, "p")], [(900, 2, "v"), (900, 3, "p")], [(901, 2, "v"), (901, 3, "p")]])
    table, _ = run_appended(event_pairs(events.where("event_type = 'v'"), events.where("event_type = 'p'"), how="left_outer"), spark)
    assert sorted((r.event_id, -1 if r.earlier_id is None else r.earlier_id) for r in table.collect()) == [(1, 0), (2, -1)]
