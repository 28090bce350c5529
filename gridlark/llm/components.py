"""Connected components of a table of links, by contraction.

Each node hooks to its least neighbour if that is less than itself; chains of hooks are followed to their ends by
doubling; links between the ends go on to the next round, without repeats.  A round at least halves the nodes that still
have links.  Rounds are cut off from their past by tables in the shared folder.  A node with very many links is salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import common


def _flat(hooks: DataFrame) -> DataFrame:
    """(node, root) from (node, root) whose roots may be nodes with other roots."""
    while True:
        then = hooks.select(F.col("node").alias("root"), F.col("root").alias("_further"))
        moved = common.lookup(hooks, then, "root", how="left")
        further = F.coalesce("_further", "root")
        hooks = stored(moved.select("node", further.alias("root"), (further != F.col("root")).alias("_moved")))
        if hooks.where("_moved").isEmpty():
            return hooks.drop("_moved")
        hooks = hooks.drop("_moved")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): equal roots just where a path of links joins two nodes."""
    links = stored(links.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct())
    roots = None
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        hooks = _flat(stored(hooks.select("node", F.least("node", "root").alias("root"))))
        if roots is None:
            roots = hooks
        else:
            then = hooks.select(F.col("node").alias("root"), F.col("root").alias("_further"))
            moved = common.lookup(roots, then, "root", how="left")
            roots = stored(moved.select("node", F.coalesce("_further", "root").alias("root")))
        for end in ("a", "b"):
            own = hooks.select(F.col("node").alias(end), F.col("root").alias("_root"))
            other = "b" if end == "a" else "a"
            links = stored(common.lookup(links, own, end).select(F.col("_root").alias(end), other))
        links = stored(links.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct())
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
