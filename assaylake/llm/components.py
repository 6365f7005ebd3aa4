"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b); equal roots mean one component.

    In each round a node points to the least of itself and its neighbours in an order drawn anew, then
    to what that one points to; edges are renamed to these targets, and those within one target go.
    A drawn order shrinks chains as fast as stars. Edges and pointers are written between rounds.
    """
    left = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    roots, turn = None, 0
    while left.take(1):
        both = left.union(left.select("b", "a"))
        drawn = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        near = both.groupBy("a").agg(F.least(F.min(drawn("b")), F.first(drawn("a")))["n"].alias("to"))
        near = materialize(near.select(F.col("a").alias("node"), "to"), "near")
        jump = near.alias("x").join(near.alias("y"), F.col("x.to") == F.col("y.node")).select("x.node", F.col("y.to").alias("to"))
        jump = materialize(jump, "jump")
        renamed = (
            left.join(jump, F.col("a") == F.col("node")).select(F.col("to").alias("a"), "b")
            .join(jump, F.col("b") == F.col("node")).select("a", F.col("to").alias("b")))
        left = materialize(renamed.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if roots is None:
            roots = jump.select("node", F.col("to").alias("root"))
        else:
            step = jump.select(F.col("node").alias("root"), "to")
            roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots, turn = materialize(roots, "roots"), turn + 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if roots is None else roots
