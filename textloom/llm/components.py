"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialised


def _placed(node: str) -> Column:
    """A node with its place in a random order; in it, chains of falling places are short."""
    return F.struct(F.xxhash64(node).alias("place"), F.col(node).alias("id"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`id` and `root` of every node of a link: nodes have the same root if and only if links connect them.

    In each round every node joins the first node, in a random order, among itself, its neighbours and theirs;
    the links between different joined nodes are the next round's. Stars and dense groups take one round, and
    the number of rounds grows with the logarithm of the longest chain. Nothing of the links reaches the
    driver, each round is a stored table, and a node with very many links is only ever a sum of partial minima
    or a side of a join that Spark can split. Nulls and links of a node with itself are left out.
    """
    live = materialised(
        links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b").distinct(), "links"
    )
    roots = None
    while True:
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = materialised(both.groupBy("a").agg(F.least(F.min(_placed("b")), F.first(_placed("a"))).alias("p")), "near")
        seen = near.select(F.col("a").alias("b"), F.col("p").alias("q"))
        pick = both.join(seen, "b").groupBy("a").agg(F.min("q").alias("q"))
        pick = materialised(pick.join(near, "a").select(F.col("a").alias("id"), F.least("p", "q")["id"].alias("to")), "pick")
        # the first round's picks hold every node
        roots = pick.select("id", F.col("to").alias("root")) if roots is None else roots.join(
            pick.select(F.col("id").alias("root"), "to"), "root", "left"
        ).select("id", F.coalesce("to", "root").alias("root"))
        of_a, of_b = (pick.select(F.col("id").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b"))
        live = materialised(
            live.join(of_a, "a").join(of_b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .filter("a <> b").distinct(),
            "links",
        )
        if live.isEmpty():
            return materialised(roots, "roots")
