"""Connected components of a graph of links, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from veilframe.session import written, written_and_counted


def components(links: DataFrame) -> DataFrame:
    """`node`, `root`: the smallest node that can be reached, for each node of `links` (a, b: longs).

    Each round links every node's root to the smallest root next to it, then follows roots until
    they stand still. A node with a third of all links is folded within tasks before it travels,
    as roots are minima, and its links are dealt out by adaptive skew joins where they meet its
    root. Every round is written to the shared folder, so a lost executor costs one round.
    """
    links, count = written_and_counted(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not count:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    roots = written(
        links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(F.max("a").alias("root")), "roots")
    live = links
    while True:
        by_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        by_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        between = live.join(by_a, "a").join(by_b, "b").where("root_a <> root_b")
        live, left = written_and_counted(
            between.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
        if not left:
            return roots
        # Only links between roots go on: each greater root takes the smallest root next to it,
        hooks = live.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        hooks = written(hooks, "hooks")
        # then chains of such steps are halved until every step ends at a root that took none.
        while True:
            further = hooks.select(F.col("root").alias("to"), F.col("to").alias("beyond"))
            stepped = hooks.join(further, "to", "left").select("root", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved"))
            seen = Observation()
            hooks = written(stepped.observe(seen, F.max("moved").alias("any")).select("root", "to"), "hooks")
            if not seen.get["any"]:
                break
        roots = written(roots.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
