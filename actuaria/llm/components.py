"""Connected components by repeated contraction, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """``edges`` (a, b) → (id, root): one row per node of an edge, equal roots where connected.

    Each round maps every node to the lowest of itself and its neighbours in a
    fixed pseudo-random order, then replaces edges by edges between the images.
    Loops and repeated edges go, so the graph shrinks by a constant factor a
    round and the rounds grow with the logarithm of the longest path.  Minima
    are partial aggregates and joins have one row per node on one side, so a
    node with very many edges is split by Spark.  Self-loops yield no row; null
    ends are dropped; an empty table gives an empty one.  ``root`` is a node of
    the component, not necessarily its smallest.
    """
    spark = work.spark

    def order(c):
        return F.struct(F.xxhash64(c).alias("h"), c.alias("v"))

    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    level = work.write(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-e0")
    maps: list[DataFrame] = []
    while not level.isEmpty():
        i = len(maps)
        lowest = level.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        image = work.write(
            lowest.select(F.col("a").alias("id"), F.least(order(F.col("a")), F.col("m"))["v"].alias("to")), f"{name}-m{i}"
        )
        maps.append(image)
        left = image.select(F.col("id").alias("a"), F.col("to").alias("ta"))
        right = image.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        level = work.write(
            level.join(left, "a").join(right, "b").filter("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(),
            f"{name}-e{i + 1}",
        )
    if not maps:
        return spark.createDataFrame([], "id long, root long")
    total = maps[-1].select("id", F.col("to").alias("root"))
    for image in reversed(maps[:-1]):
        further = total.select(F.col("id").alias("to"), "root")
        total = image.join(further, "to", "left").select("id", F.coalesce("root", "to").alias("root"))
    return work.write(total, f"{name}-roots")
