"""Buckets around one group: each node is compared once, whatever the number of buckets that it is in."""

import random

from pyspark.sql import functions as F

from tests.llm.conftest import documents
from tests.llm.test_neardup import brute_groups, grouped
from tidewell.llm.linking import link, starred
from tidewell.llm.neardup import group_documents

BANDS = 20


def test_a_node_is_once_in_the_rows_of_a_group(spark):
    # nodes 0 to 39 are alike to the least one; 40 to 44 are alike to 39 alone, which only a comparison of mates finds; 50 is to none
    nodes = [*range(45), 50]
    rows = spark.createDataFrame([(b, f"{n:02}") for b in range(BANDS) for n in nodes], "bucket bigint, node string")
    seen = []

    def verify(pairs):
        return pairs.where("int(a) < 40 and int(b) < 40")

    def prune(rows):
        seen.append((rows.count(), rows.distinct().count()))
        return rows

    def mates(rows):
        x, y = rows.select("bucket", F.col("node").alias("a")), rows.select("bucket", F.col("node").alias("b"))
        return x.join(y, "bucket").where("a = '39' and int(b) between 40 and 44").select("a", "b")

    for merge in (True, False):
        got = {r.node: r.label for r in link(starred(rows), verify, mates, 1000, prune, merge=merge).collect()}
        assert got == {f"{n:02}": "00" for n in range(45)}
    assert seen[0] == (len(nodes), len(nodes)) and seen[1][0] >= BANDS * (len(nodes) - 1)


def test_one_large_group_of_near_copies_equals_brute_force(spark):
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(900)}" for _ in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(60)] = f"v{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(base[:30] + [f"u{rnd.randrange(900)}" for _ in range(30)])) for i in range(20)] + [(300, None), (301, "")]
    for large in (1000, 20):
        out = group_documents(documents(spark, rows), large=large).select("doc_id", F.col("group_id").alias("class_id"))
        assert grouped(out.collect()) == brute_groups(rows)
