"""Connected components of a table of links, by contraction to least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that links ``a``, ``b`` reach; nodes without links don't appear.

    Each round points every node to its least neighbour (or itself), follows the pointers to
    their roots, and goes on with the links between roots. Aggregates see a hub's links as partial minima.
    """
    links = stage(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b"), "links")
    found: DataFrame | None = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), "parents")
        while True:
            above = up.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
            nxt = stage(up.join(above, up["up"] == above["_n"], "left").select("node", F.coalesce("_up", "up").alias("up"), (F.coalesce("_up", "up") != F.col("up")).alias("moved")), "parents")
            up = nxt.drop("moved")
            if nxt.where("moved").isEmpty():
                break
        of = lambda side: up.select(F.col("node").alias(side), F.col("up").alias(f"{side}_up"))
        links = stage(links.join(of("a"), "a").join(of("b"), "b").where("a_up <> b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).distinct(), "links")
        if found is None:
            found = up.select("node", F.col("up").alias("component"))
        else:
            found = stage(found.join(up.select(F.col("node").alias("component"), "up"), "component", "left").select("node", F.coalesce("up", "component").alias("component")), "components")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
