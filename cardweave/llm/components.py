"""Connected components of a distributed graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardweave.llm.store import stored


#: Rows of one node's links that one task takes, at the least; parts into which more are dealt.
HOT_LINKS, PARTS = 256, 64


def _with_least(edges: DataFrame, links: int) -> DataFrame:
    """(high, low, least): every edge with the least ``low`` of its ``high``.

    A node with more than ``HOT_LINKS`` and a thousandth of all links is dealt over
    ``PARTS`` tasks, to each of which its least neighbour goes; at most two thousand
    nodes have so many, so their list is small enough to be broadcast.
    """
    limit = max(HOT_LINKS, links // 1_000)
    found = edges.groupBy("high").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(found.where(F.col("n") > limit).select("high", F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("low"), F.lit(PARTS))).otherwise(0).cast("int")
    last = F.when(F.col("n") > limit, PARTS - 1).otherwise(0)
    copies = found.select("high", "least", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    return (edges.join(hot, "high", "left").withColumn("part", part).join(copies, ["high", "part"])
            .select("high", "low", "least"))


def _large_star(edges: DataFrame, links: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    return (_with_least(both, 2 * links).where("low > high")
            .select(F.col("low").alias("high"), F.least("high", "least").alias("low")))


def _small_star(edges: DataFrame, links: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    rows = _with_least(edges, links)
    own = edges.groupBy("high").agg(F.min("low").alias("low"))
    return (rows.select(F.col("low").alias("high"), F.col("least").alias("low"))
            .where("high <> low").unionByName(own).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge, from edges (a, b) of longs.

    A component's root is its least node. Each round is stored in the shared folder; the number of
    rounds grows with the logarithm of the number of nodes. Loops and repeated edges are allowed;
    null ends are not. Without edges the result is empty.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
                 .distinct())
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))")).first()
        if state == seen:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
        seen = state
        now = stored(_small_star(_large_star(now, state[0]), state[0]))
