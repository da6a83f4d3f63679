"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newstide.workspace import stage


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the least node.

    Nodes take the least label among themselves and their neighbours, then the label of
    their label, until nothing changes: paths shorten by more than half per round. Rounds
    are written out, so that lineage stays short and lost executors cost one round. A hub's
    edges meet in partial minima and in a join that may be split.
    """
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = stage(pairs.union(edges.select("b", "a")).filter("u <> v").distinct(), f"{label}-edges")
    labels = stage(
        both.groupBy("u").agg(F.least("u", F.min("v")).alias("c")).select(F.col("u").alias("n"), "c"),
        f"{label}-0",
    )
    while True:
        around = (
            both.join(labels.select(F.col("n").alias("v"), "c"), "v").groupBy("u").agg(F.min("c").alias("m"))
        )
        lower = labels.join(around, F.col("n") == F.col("u")).select("n", "c", F.least("c", "m").alias("l"))
        roots = labels.select(F.col("n").alias("r"), F.col("c").alias("rc"))
        jumped = lower.join(roots, F.col("l") == F.col("r"), "left").select(
            "n", F.least("l", F.coalesce("rc", "l")).alias("d"), "c"
        )
        jumped = stage(jumped, f"{label}-round")
        changed = jumped.filter("d < c").limit(1).count()
        labels = jumped.select("n", F.col("d").alias("c"))
        if not changed:
            return labels.select(F.col("n").alias("node"), F.col("c").alias("component"))
