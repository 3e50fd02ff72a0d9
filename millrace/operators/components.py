"""Connected components over long node numbers, all tables distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.storage import written


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, label: the smallest node that is reachable, for every node that has an edge.

    Each round hooks nodes to their smallest neighbour, flattens chains of hooks, and moves edges to the
    remaining roots; at least half of the nodes that have edges go in a round.
    """
    spark = edges.sparkSession
    result = spark.createDataFrame([], "node long, label long")
    edges = written(edges.select("a", "b").distinct(), "edges")
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "hooks")
        moving = True
        while moving:
            up = hooks.toDF("_up", "_to")
            hooks = written(hooks.join(up, F.col("label") == F.col("_up"), "left").select("node", F.coalesce("_to", "label").alias("label"), (F.col("_to") < F.col("label")).alias("moved")), "hooks")
            moving = not hooks.where("moved").isEmpty()
            hooks = hooks.select("node", "label")
        up = hooks.toDF("_up", "_to")
        known = result.join(up, F.col("label") == F.col("_up"), "left").select("node", F.coalesce("_to", "label").alias("label"))
        result = written(known.unionByName(hooks.join(result.select("node"), "node", "left_anti")), "components")
        left, right = hooks.toDF("_l", "_la"), hooks.toDF("_r", "_lb")
        moved = edges.join(left, F.col("a") == F.col("_l")).join(right, F.col("b") == F.col("_r")).where("_la <> _lb")
        edges = written(moved.select(F.least("_la", "_lb").alias("a"), F.greatest("_la", "_lb").alias("b")).distinct(), "edges")
    return result
