"""Connected groups of similar things, from buckets that candidates share, without all pairs of a bucket.

In every bucket one member, the least, is compared with all the rest, and what is linked by then is put in groups. Buckets
that are one group are done, nearly all of them. In the others members of different groups are compared inside the buckets' tasks, which give
only what is alike. A bucket too large for a task is dealt out in blocks, exactly: its members outside its largest group are cut into
chunks, and every chunk meets every chunk of them, and every chunk of the largest group, in a block of its own; buckets with one largest group are put together first. So no link depends
on how full a bucket is, and there is one round, whatever the sizes; a bucket of n members, k of them outside its largest group, takes
about k * n / large**2 blocks. All tables stay distributed; the driver sees counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, sized_join

#: Rows of buckets around one group that are compared in one task, so that pairs that meet in several are told apart once.
HOME = 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of edges (a, b); the label is the least node that is connected.

    Every node points to its least neighbour, if that is less; pointers are followed to their ends, the edges are put
    between the ends, and those within one end are done. What is left shrinks from round to round.
    """
    edges = durable(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
        ends = durable(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "pointers")
        while True:
            further = durable(ends.join(ends.toDF("label", "next"), "label").select("node", "label", "next"), "pointers")
            ends = further.select("node", F.col("next").alias("label"))
            if not further.where("label <> next").limit(1).count():
                break
        if labels is None:
            labels = ends
        else:
            labels = durable(labels.join(ends.toDF("label", "end"), "label", "left").select("node", F.coalesce("end", "label").alias("label")), "labels")
        edges = edges.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = durable(edges, "edges")
        if not edges.limit(1).count():
            return labels


def starred(members: DataFrame) -> DataFrame:
    """(bucket, a, b) of distinct rows (bucket, node): a is the bucket's least node, b every other one."""
    least = durable(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("a")).where("n > 1").select("bucket", "a"), "leaders")
    return sized_join(members, least, "bucket").where("node <> a").select("bucket", "a", F.col("node").alias("b"))


def link(stars: DataFrame, verify: Callable, mates: Callable, large: int, prune: Callable | None = None, merge: bool = False, members: Callable | None = None) -> DataFrame:
    """(node, label) of the nodes that links between bucket mates connect with others; the label is the least node of the group.

    stars has rows (bucket, a, b) as ``starred`` gives them. verify takes pairs (a, b) and returns those that are links.
    mates takes rows (bucket, node, group, side) of buckets of up to ``large`` members and returns links, among them some
    between all groups of a bucket that any links join; members of one side, if it is not -1, need not be compared. prune takes rows
    (bucket, node) and may leave out those whose node has no link in the bucket. With ``merge`` the open buckets whose least
    nodes are of one group are one bucket, which holds a node once, in however many of them it is; all that meet still do.
    With ``members`` stars need have no bucket: it takes pairs (pair: struct of a, b) and returns the rows (bucket, node) of all buckets
    that hold one of them, a bucket's least node aside.
    """
    pairs = durable(stars.select("a", "b").distinct(), "pairs")
    links = durable(verify(pairs).select("a", "b"), "links")
    labels = components(links)
    sides = pairs
    for c in ("a", "b"):
        sides = sized_join(sides, labels.toDF(c, f"label_{c}"), c, "left").withColumn(f"label_{c}", F.coalesce(f"label_{c}", c))
    if merge:
        sides = durable(sides.select("a", "b", "label_a", "label_b"), "sides")
    # a bucket whose members are all of its least one's group is done
    apart = durable(sides.where("label_a <> label_b").select(F.struct("a", "b").alias("pair")), "apart")
    if not apart.limit(1).count():
        return labels
    if merge:
        mains = durable(sides.where("label_a <> label_b").select("label_a").distinct(), "open-groups")
        own = durable(sides.select("label_a", F.col("a").alias("node")).union(sides.select("label_a", "b")).distinct(), "of-groups")
        rows = _still_open(sized_join(own, mains, "label_a", "left_semi").select(F.xxhash64("label_a").alias("bucket"), "node").distinct(), labels)
    elif members is not None:
        rows = _still_open(members(apart), labels)
    else:
        buckets = durable(sized_join(stars.select("bucket", F.struct("a", "b").alias("pair")), apart, "pair", "left_semi").select("bucket").distinct(), "open-buckets")
        rows = _still_open(sized_join(stars, buckets, "bucket", "left_semi").select("bucket", F.col("b").alias("node")), labels)
    if prune is not None:
        rows = _still_open(prune(rows).drop("group"), labels)
    sizes = durable(rows.groupBy("bucket").agg(F.count("*").alias("n")), "sizes")
    counts = sizes.agg(F.count("*").alias("all"), F.count(F.when(F.col("n") > large, 1)).alias("large")).first()
    if not counts["all"]:
        return labels
    few = rows if not counts["large"] else sized_join(rows, sizes.where(F.col("n") <= large).select("bucket"), "bucket", "left_semi")
    more = durable(mates(few.withColumn("side", F.lit(-1))).select("a", "b"), "links")
    if counts["large"]:
        # what is linked by now need not meet in the blocks
        labels = components(labels.toDF("a", "b").union(more))
        many = _still_open(sized_join(rows, sizes.where(F.col("n") > large).select("bucket"), "bucket", "left_semi").drop("group"), labels)
        more = durable(mates(durable(blocks(many, large), "blocks")).select("a", "b"), "links")
    return components(labels.toDF("a", "b").union(more)) if more.limit(1).count() else labels


def blocks(rows: DataFrame, large: int) -> DataFrame:
    """Of rows (bucket, node, group), rows (bucket, node, group, side) of blocks of about ``large`` members, in which all pairs of different groups meet."""
    half = max(1, large // 2)
    groups = rows.groupBy("bucket", "group").agg(F.count("*").alias("n"))
    most = groups.groupBy("bucket").agg(F.max(F.struct("n", "group")).alias("m"))
    chunks = lambda n: F.ceil(n / F.lit(half)).cast("int")
    # buckets round one main group mostly hold the same members, so they are put together; what that brings together beside can only be links too
    joined = sized_join(rows, durable(most.select("bucket", F.col("m.group").alias("main")), "mains"), "bucket").select(F.col("main").alias("bucket"), "node", "group")
    joined = durable(joined.distinct(), "joined-buckets")
    in_main = F.col("group") == F.col("bucket")
    most = joined.groupBy("bucket").agg(chunks(F.count(F.when(in_main, 1))).alias("ways"), chunks(F.count(F.when(~in_main, 1))).alias("others"))
    known = sized_join(joined, durable(most, "chunks"), "bucket").withColumn("in_main", in_main)
    known = known.withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("in_main"), F.col("ways")).otherwise(F.col("others"))).cast("int"))
    # a block is (chunk of the others, chunk of the others from it on) or (chunk of the others, -1 - chunk of the main group)
    place = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(side).alias("side"))
    count = lambda n: F.transform(F.sequence(F.lit(0), n), lambda i: i)
    of_main = F.transform(count(F.col("others") - 1), lambda x: place(x, -1 - F.col("chunk"), 1))
    with_main = F.transform(count(F.col("ways") - 1), lambda y: place(F.col("chunk"), -1 - y, 0))
    own = F.array(place(F.col("chunk"), F.col("chunk"), -1))
    below = F.transform(F.filter(count(F.col("others") - 1), lambda x: x < F.col("chunk")), lambda x: place(x, F.col("chunk"), 1))
    above = F.transform(F.filter(count(F.col("others") - 1), lambda y: y > F.col("chunk")), lambda y: place(F.col("chunk"), y, 0))
    dealt = known.withColumn("at", F.explode(F.when(F.col("in_main"), of_main).otherwise(F.concat(with_main, own, below, above))))
    return dealt.select(F.xxhash64("bucket", "at.x", "at.y").alias("bucket"), "node", "group", "at.side")


def with_homes(rows: DataFrame, size: int = HOME) -> DataFrame:
    """rows (bucket, node, group) with ``home``: buckets with the same least group have the same, up to about ``size`` rows."""
    buckets = rows.groupBy("bucket").agg(F.min("group").alias("least"), F.count("*").alias("n"))
    totals = buckets.groupBy("least").agg(F.sum("n").alias("total"))
    homes = buckets.join(totals, "least").select("bucket", F.xxhash64("least", F.pmod("bucket", F.ceil(F.col("total") / size))).alias("home"))
    return sized_join(rows, durable(homes, "homes"), "bucket")


def _still_open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (bucket, node), with their groups, of buckets that hold more than one group."""
    now = durable(sized_join(rows, labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("group")), "groups")
    mixed = now.groupBy("bucket").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("bucket")
    return durable(sized_join(now, durable(mixed, "open"), "bucket", "left_semi"), "members")
