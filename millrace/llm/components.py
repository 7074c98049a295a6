"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def connected(edges: DataFrame, step: Callable[[DataFrame, str], DataFrame], rounds: int = 200) -> DataFrame:
    """x, label: every node of the edges (x, y; both directions) with the least node that it is connected to.

    Each round takes the least label next to a node and then that label's own label, so long chains shorten by
    doubling. step writes a table of that name and gives it back; a round is one job, and as its table is written no
    round computes an earlier one again.
    """
    least = edges.groupBy("x").agg(F.min("y").alias("near")).select("x", F.least("x", "near").alias("label"))
    label = None
    for n in range(rounds):
        last = least if label is None else label
        around = edges.join(last.select(F.col("x").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        near = last.join(around, "x").select("x", F.col("label").alias("was"), F.least("label", "near").alias("near"))
        if label is None:  # most graphs are stars around their least node, and settled by now
            moved = near.select("x", F.col("near").alias("label"), (F.col("near") < F.col("was")).alias("moved"))
        else:
            jump = label.select(F.col("x").alias("near"), F.col("label").alias("beyond"))
            new = F.least("near", F.coalesce("beyond", "near"))
            moved = near.join(jump, "near", "left").select("x", new.alias("label"), (new < F.col("was")).alias("moved"))
        seen = Observation()
        label = step(moved.observe(seen, F.count_if("moved").alias("moved")), f"labels{n}").select("x", "label")
        if not seen.get["moved"]:
            return label
    raise RuntimeError("the components didn't settle")
