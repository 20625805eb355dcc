"""Connected components of a graph given as edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.tables import Workspace


def _canonical(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.filter("a < b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): every end of an edge (a, b of type long) with the smallest id of its component.

    A distributed union-find: each round hangs every vertex below its smallest neighbour, shortens
    the paths twice, and draws the edges anew between what the ends hang below; vertices that are
    no local minimum vanish, so rounds grow with the logarithm of a component. Each round's tables
    land in the shared folder; those of the steps stay for the result. Null ends and loops are ignored; ids without an edge are not returned.
    """
    spark = edges.sparkSession
    work = Workspace(spark, "components")
    pairs = work.land(_canonical(edges), "edges")
    steps = []
    while not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("v"), F.col("b").alias("w")).unionAll(pairs.select("b", "a"))
        up = ends.groupBy("v").agg(F.min("w").alias("p")).select("v", F.least("v", "p").alias("p"))
        up = work.land(up, "parents")
        step = up
        for _ in range(2):
            above = up.select(F.col("v").alias("p"), F.col("p").alias("q"))
            step = step.join(above, "p").select("v", F.col("q").alias("p"))
        step = work.land(step, "steps")
        steps.append(step)
        a, b = (step.select(F.col("v").alias(c), F.col("p").alias(f"{c}p")) for c in "ab")
        moved = pairs.join(a, "a").join(b, "b").select(F.col("ap").alias("a"), F.col("bp").alias("b"))
        pairs = work.land(_canonical(moved), f"edges after {len(steps)}")
        work.drop("edges", "parents", f"edges after {len(steps) - 1}")
    if not steps:
        return spark.createDataFrame([], "id long, component long")
    labels = steps[0].select(F.col("v").alias("id"), F.col("p").alias("component"))
    for step in steps[1:]:
        later = step.select(F.col("v").alias("component"), "p")
        labels = labels.join(later, "component", "left").select("id", F.coalesce("p", "component").alias("component"))
    return labels
