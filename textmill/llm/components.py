"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import discard, written

#: More rounds than any graph of 2**60 nodes takes.
ROUNDS = 120


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node that can be reached, itself included) for every node of links (a, b).

    In each round a node's hop is the least of its neighbours and itself, and from there once more; links are then drawn
    between hops, and what has become a loop or a repetition goes, so a dense group shrinks to a few links at once and rounds
    grow with the logarithm of a component's width. Hops and links of every round are written to the shared folder; a node's root
    is where its hops lead. Minima are made before the shuffle, so a hub is one row of each task, and the table that
    links are joined with has one row for each node, so that Spark can split a hub's links.
    """
    kind = links.schema["a"].dataType
    edges = written(_drawn(links.select("a", "b")), "links")
    hops: list[DataFrame] = []
    for _ in range(ROUNDS):
        if not edges.limit(1).count():
            break
        least = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.least(F.min("b"), "a").alias("p"))
        hop = least.select(F.col("a").alias("node"), "p").join(least.select(F.col("a").alias("p"), F.col("p").alias("hop")), "p").select("node", "hop")
        hops.append(written(hop, "hops"))
        of = lambda name, to: hops[-1].select(F.col("node").alias(name), F.col("hop").alias(to))
        before, edges = edges, written(_drawn(edges.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))), "links")
        discard(before)
    else:
        raise RuntimeError("components didn't settle")
    if not hops:
        return links.sparkSession.createDataFrame([], "a int").select(F.lit(None).cast(kind).alias("node"), F.lit(None).cast(kind).alias("root"))
    # what isn't a node any more in a later round has its root already
    roots = written(reduce(_further, hops[1:], hops[0].withColumnRenamed("hop", "root")), "roots")
    discard(edges, *hops)
    return roots


def _drawn(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct()


def _further(roots: DataFrame, hop: DataFrame) -> DataFrame:
    nxt = hop.select(F.col("node").alias("root"), F.col("hop").alias("_hop"))
    return roots.join(nxt, "root", "left").select("node", F.coalesce("_hop", "root").alias("root"))
