"""Connected components by contraction: every table stays distributed, lineage is cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b; long, any direction, repeats allowed) -> node, label: the smallest node that is reachable. Nodes without edges don't appear.

    In each round every node hooks to its smallest neighbour, chains of hooks are halved until they are flat, and
    edges move to what their ends hang on. A node that is smaller than all its neighbours stays, so at least half of the
    nodes that still have edges vanish in a round.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    result = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("_up"), F.col("label").alias("_to"))
            flat = written(hooks.join(up, F.col("label") == F.col("_up"), "left").select("node", F.coalesce("_to", "label").alias("label"), (F.col("_to") < F.col("label")).alias("_moved")), "hooks")
            drop(hooks)
            hooks = flat
            if hooks.where("_moved").isEmpty():
                break
        hooks = hooks.select("node", "label")
        if result is None:
            result = hooks
        else:
            up = hooks.select(F.col("node").alias("_up"), F.col("label").alias("_to"))
            # what hung on a node that vanished now hangs where that node does
            result = written(result.join(up, F.col("label") == F.col("_up"), "left").select("node", F.coalesce("_to", "label").alias("label")), "components")
        left = hooks.select(F.col("node").alias("_l"), F.col("label").alias("_la"))
        right = hooks.select(F.col("node").alias("_r"), F.col("label").alias("_lb"))
        moved = edges.join(left, F.col("a") == F.col("_l")).join(right, F.col("b") == F.col("_r")).where("_la <> _lb")
        further = written(moved.select(F.least("_la", "_lb").alias("a"), F.greatest("_la", "_lb").alias("b")).distinct(), "edges")
        drop(edges)
        edges = further
    drop(edges)
    if result is None:
        return edges.sparkSession.createDataFrame([], "node long, label long")
    return result
