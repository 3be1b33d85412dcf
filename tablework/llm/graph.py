"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm import common


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id that occurs in a link; component is the smallest id it reaches.

    Each turn every node hooks to the best of itself and its neighbours (a minimum, combined before
    the shuffle) and the links are carried over to the new nodes, without loops and repeats. The
    first turn ranks by id, which ends stars at once; later turns rank by a hash, under which any graph
    shrinks by a constant factor. Only counts reach the driver. A link with a null end is left out;
    no links give no rows.
    """
    edges = common.materialize(
        links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND x <> y").distinct(), "links")
    found = common.materialize(
        edges.select("x").union(edges.select("y")).distinct().select(F.col("x").alias("id"), F.col("x").alias("c")), "nodes")
    turn = 0
    while not edges.isEmpty():
        rank = F.struct("n") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "n").alias("r"), "n")
        both = edges.select(F.col("x").alias("v"), F.col("y").alias("n")).union(edges.select("y", "x"))
        both = both.union(edges.select("x", "x")).union(edges.select("y", "y"))
        hooks = common.materialize(both.groupBy("v").agg(F.min(rank)["n"].alias("p")), "hooks")
        found = common.materialize(
            found.join(hooks, found["c"] == hooks["v"], "left").select("id", F.coalesce("p", "c").alias("c")), "nodes")
        left = edges.join(hooks, edges["x"] == hooks["v"]).select(F.col("p").alias("x"), "y")
        right = hooks.select(F.col("v").alias("w"), F.col("p").alias("q"))
        edges = common.materialize(
            left.join(right, left["y"] == right["w"]).select(F.least("x", "q").alias("x"), F.greatest("x", "q").alias("y"))
            .filter("x <> y").distinct(), "links")
        turn += 1
    smallest = found.groupBy("c").agg(F.min("id").alias("component"))
    return common.materialize(found.join(smallest, "c").select("id", "component"), "components")
