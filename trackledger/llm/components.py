"""Connected components of links, by contracting every vertex to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackledger.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) of every id in ``links`` (a, b).

    Each round maps a vertex to the smallest of itself and its neighbours,
    follows that map once more, and draws the links between what remains: the
    number of vertices shrinks by half or more. All tables are written to the
    shared folder; only counts reach the driver. Loops and repeated links are
    allowed, nulls are ignored.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    edges = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = materialize(ids.select("id", F.col("id").alias("component")))
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        parent = materialize(both.groupBy("e.a").agg(F.min("e.b").alias("p")).select("a", F.least("a", "p").alias("p")))
        above = parent.select(F.col("a").alias("p"), F.col("p").alias("root"))
        parent = materialize(parent.join(above, "p").select(F.col("a").alias("v"), "root"))
        found = materialize(
            found.join(parent, F.col("component") == F.col("v"), "left").select(
                "id", F.coalesce("root", "component").alias("component")
            )
        )
        moved = edges.join(parent, F.col("a") == F.col("v")).select(F.col("root").alias("x"), "b")
        moved = moved.join(parent, F.col("b") == F.col("v")).select("x", F.col("root").alias("y")).where("x <> y")
        edges = materialize(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return found
