"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrun.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges(a, b)``; comp is the smallest node reachable.

    Each round gives a component the smallest label among its members' neighbours
    and then follows labels one step, so whole components merge at a time. Every
    round is a table in the shared folder. All sums are minima, taken partly before
    the shuffle, so a hub costs one row a task.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    state = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                  .select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        seen = (both.join(state, both["b"] == state["node"]).groupBy("a").agg(F.min("comp").alias("low")))
        near = state.join(seen, state["node"] == seen["a"]).select("node", "comp", F.least("comp", "low").alias("low"))
        hook = near.groupBy("comp").agg(F.min("low").alias("best"))
        moved = stage(near.join(hook, "comp").select("node", F.col("comp").alias("old"),
                                                     F.least("low", "best").alias("label")), "moved")
        if moved.where("label <> old").isEmpty():
            return state
        roots = moved.select(F.col("node").alias("root"), F.col("label").alias("next"))
        state = stage(moved.join(roots, moved["label"] == roots["root"], "left")
                      .select("node", F.least("label", "next").alias("comp")), "labels")
