"""Connected components of a link table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import NARROW, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in ``links`` (a, b); label is the smallest node reachable.

    Each turn takes the smallest label among neighbours (a map-side combined
    minimum, so a hub costs one row per task) and then the label's own label,
    which halves distances.  Tables are written after each turn, which cuts
    lineage.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "links", NARROW)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels", NARROW)
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        stepped = materialize(labels.join(near, "node").select("node", F.least("label", "near").alias("label"),
                                                               F.col("label").alias("before")), "labels", NARROW)
        up = stepped.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = materialize(stepped.join(up, "label", "left").select(
            "node", F.least("label", F.coalesce("up", "label")).alias("label"), "before"), "labels", NARROW)
        changed = new.where("label <> before").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
