"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import Scratch


def merge_components(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Labels (node, label) after joining the components that ``links`` (x, y) connect.

    A label is the smallest node of its component.  The links are contracted
    to links between labels first, so each step handles only components that
    still change; a step takes the smallest label among the neighbours and then the label of that
    label.  All state is in written tables; only the number of changes comes to the driver.
    """
    ends = (links.join(labels.select(F.col("node").alias("x"), F.col("label").alias("a")), "x")
            .join(labels.select(F.col("node").alias("y"), F.col("label").alias("b")), "y")
            .where("a <> b").select("a", "b"))
    edges = scratch.save(ends.union(ends.select("b", "a")).distinct(), f"{name}-edges")
    now = scratch.save(edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), f"{name}-0")
    step = 0
    while True:
        step += 1
        heard = (edges.join(now.select(F.col("node").alias("b"), "label"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard")))
        least = now.join(heard, "node").select("node", F.col("label").alias("old"),
                                               F.least("label", "heard").alias("label"))
        jump = least.alias("l").join(
            least.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
        new = scratch.save(jump.select("node", "old", F.coalesce("next", "label").alias("label")), f"{name}-{step}")
        changed = new.where("old <> label").limit(1).count()
        scratch.drop(f"{name}-{step - 1}")
        now = new.select("node", "label")
        if not changed:
            break
    out = (labels.join(now.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
           .select("node", F.coalesce("to", "label").alias("label")))
    out = scratch.save(out, f"{name}-labels")
    scratch.drop(f"{name}-edges", f"{name}-{step}")
    return out
