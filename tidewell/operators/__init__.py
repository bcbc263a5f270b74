"""Operators that Spark's DataFrame has no public method for."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import micros


def greeting(spark, name: str = "tidewell") -> DataFrame:
    """A constant projection: one row with one line of greeting."""
    return spark.range(1).select(F.concat(F.lit("Hello from "), F.lit(name), F.lit("!")).alias("greeting"))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, columns: list[str], tie: Column | None = None) -> DataFrame:
    """Each left row with ``columns`` of the latest right row of the same ``by`` at or before ``at``; null if there is none.

    One shuffle and one sort: both sides go through one window that carries the last right row forward. Rows of left with a null
    key or time get nulls. Of right rows at the same time the one with the greatest ``tie`` counts. A key with very many rows is sorted with spilling and
    streamed, not held in memory.
    """
    taken = list(left.columns)
    order = F.lit(0) if tie is None else tie
    known = F.lit(True)
    for c in [*by, at]:
        known = known & F.col(c).isNotNull()
    names = {c: c if c not in taken else f"right_{c}" for c in columns}
    kind = right.select(F.struct(*columns).alias("s")).schema["s"].dataType
    # rows that match nothing go past the shuffle, so that they don't meet in one window
    lone = left.where(~known).select(*taken, *[F.lit(None).cast(kind[c].dataType).alias(names[c]) for c in columns])
    rows = left.where(known).select(*by, F.col(at), F.struct(*taken).alias("_left"), F.lit(None).cast(kind).alias("_right"), F.lit(None).cast("bigint").alias("_tie"))
    other = right.where(known).select(*by, F.col(at), F.lit(None).cast(left.select(F.struct(*taken)).schema[0].dataType).alias("_left"), F.struct(*columns).alias("_right"), order.cast("bigint").alias("_tie"))
    window = Window.partitionBy(*by).orderBy(F.col(at).asc_nulls_first(), F.col("_left").isNotNull().asc(), F.col("_tie").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(other).withColumn("_found", F.last("_right", ignorenulls=True).over(window))
    return found.where(F.col("_left").isNotNull()).select("_left.*", *[F.col(f"_found.{c}").alias(names[c]) for c in columns]).union(lone)


#: Kinds of join that ``interval_join`` knows.
KINDS = ("inner", "left", "left_semi", "left_anti")


def interval_join(left: DataFrame, right: DataFrame, by: list[str], at: str, low: int | timedelta, high: int | timedelta, how: str = "inner") -> DataFrame:
    """Rows of left with those of right of the same ``by`` whose ``at``, less left's, lies from ``low`` to ``high``, both included.

    Time is cut into bins as wide as the interval. A left row stands in the bin of its time, a right row in the two bins at most
    that it can reach, so an equal-key join on ``by`` and bin meets each pair once, and about twice as many candidates as there are
    pairs; no side is compared as a whole. A key with very many rows is spread over its bins, and a bin that is still hot is
    left to the skew handling of adaptive execution, which splits it. ``right`` is the side that is doubled.

    ``at`` is a timestamp of either kind or a date, with timedeltas as bounds, or a whole number, with whole numbers. Null keys and times match
    nothing; left rows with them go past the shuffle where the kind of join keeps them. Equal rows each match. Columns of right whose
    names left has get ``right_`` before them; ``by`` comes once.
    """
    if how not in KINDS:
        raise ValueError(f"no kind of join {how}; there are {', '.join(KINDS)}")
    low, high = ((x // timedelta(microseconds=1) if isinstance(x, timedelta) else x) for x in (low, high))
    if low > high:
        raise ValueError("low is above high")
    width = max(1, high - low)
    kind = left.schema[at].dataType
    places = {side: {c: f"{side}{i}" for i, c in enumerate(df.columns)} for side, df in (("l", left), ("r", right))}
    near, far = (df.toDF(*places[side].values()) for side, df in (("l", left), ("r", right)))
    kept = [c for c in right.columns if c not in by]
    names = list(left.columns)
    for c in kept:
        held = {n.lower() for n in names}
        while c.lower() in held:
            c = f"right_{c}"
        names.append(c)

    def known(side: str) -> Column:
        out = F.lit(True)
        for c in [*by, at]:
            out = out & F.col(places[side][c]).isNotNull()
        return out

    # a bin is named by its first moment; whole numbers throughout, as doubles would round
    bin_of = lambda t: t - F.pmod(t, F.lit(width).cast("bigint"))
    a = near.where(known("l")).withColumn("lt", micros(places["l"][at], kind)).withColumn("lb", bin_of(F.col("lt")))
    b = far.where(known("r")).withColumn("rt", micros(places["r"][at], right.schema[at].dataType))
    b = b.withColumn("rb", F.explode(F.sequence(bin_of(F.col("rt") - high), bin_of(F.col("rt") - low), F.lit(width).cast("bigint"))))
    match = (F.col("lb") == F.col("rb")) & (F.col("rt") - F.col("lt")).between(low, high)
    for c in by:
        match = match & (F.col(places["l"][c]) == F.col(places["r"][c]))
    joined = a.join(b, match, how)
    own = list(places["l"].values())
    if how in ("left_semi", "left_anti"):
        out = joined.select(*own).toDF(*left.columns)
    else:
        out = joined.select(*own, *[places["r"][c] for c in kept]).toDF(*names)
    if how in ("left", "left_anti"):
        lone = near.where(~known("l"))
        nothing = [] if how == "left_anti" else [F.lit(None).cast(right.schema[c].dataType) for c in kept]
        out = out.union(lone.select(*own, *nothing))
    return out
