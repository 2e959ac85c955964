"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, stored


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; linked nodes share a root.

    Contraction in rounds: every node picks the neighbour (or itself) that
    comes first in an order drawn anew each round, the picks are followed once
    more, and the links between the picks are the next round's graph. A round
    removes a constant share of the nodes on average, so there are about
    log(nodes) rounds. Picks are a minimum, which is partially aggregated
    ahead of the shuffle; the most popular picks are looked up by broadcast.
    """
    graph = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    graph = stored(graph.distinct(), "links")
    maps, turn = [], 0
    while not graph.isEmpty():
        turn += 1

        def rank(column: str, turn: int = turn):
            # Nodes with equal hashes are ordered by their number.
            return F.struct(F.xxhash64(F.lit(turn), F.col(column)).alias("luck"), F.col(column).alias("id"))

        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick = (
            both.groupBy("a")
            .agg(F.min(rank("b")).alias("best"))
            .select(F.col("a").alias("node"), F.least(rank("a"), F.col("best"))["id"].alias("pick"))
        )
        pick = stored(pick, "picks")
        followers = pick.groupBy("pick").agg(F.count("*").alias("followers"))
        onward = pick.select(F.col("node").alias("pick"), F.col("pick").alias("root"))
        onward = stored(onward.join(followers, "pick"), "onward")
        step = attach(pick, onward, ["pick"], "followers").select("node", "root")
        step = stored(step, "step")
        maps.append(step)

        def renamed(node: str, step: DataFrame = step) -> DataFrame:
            return step.select(F.col("node").alias(node), F.col("root").alias(f"{node}_root"))

        graph = (
            graph.join(renamed("a"), "a")
            .join(renamed("b"), "b")
            .select(
                F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")
            )
            .where("a <> b")
            .distinct()
        )
        graph = stored(graph, "links")
    if not maps:
        return graph.select(F.col("a").alias("node"), F.col("a").alias("root"))
    found = maps[-1]
    for step in reversed(maps[:-1]):
        # A node that has no links left is not in the later maps: it is a root.
        later = found.select(F.col("node").alias("root"), F.col("root").alias("later"))
        sizes = step.groupBy("root").agg(F.count("*").alias("followers"))
        target = stored(
            sizes.join(later, "root", "left").withColumn("later", F.coalesce("later", "root")),
            "targets",
        )
        found = attach(step, target, ["root"], "followers").select(
            "node", F.col("later").alias("root")
        )
        found = stored(found, "roots")
    return found
