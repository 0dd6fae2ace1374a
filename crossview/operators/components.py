"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_folder, release, remove_folder, written


def connected_components(edges: DataFrame, rounds: int = 100, kept: list[str] | None = None) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the smallest node of its component.

    In each round a node takes the smallest label among its own, its neighbours' and the label of that label, so long
    chains shrink to half their length or less; labels are written to the shared folder after each round. Ends when no
    label changes. The folder that the result reads is added to ``kept``, for the caller to remove; all others are
    removed here. An edge from a node to itself makes it a component of its own.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both_path, path = fresh_folder(spark, "edges"), fresh_folder(spark, "labels")
    both = written(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), both_path)
    labels = written(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("label")), path)
    for _ in range(rounds):
        near = both.where("src <> dst").join(labels, both.dst == labels.node).select(F.col("src").alias("node"), "label")
        near = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        step = near.join(up, "label", "left").select("node", F.least("label", F.coalesce("above", "label")).alias("label"))
        new_path = fresh_folder(spark, "labels")
        new = written(step, new_path)
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        remove_folder(spark, path)
        labels, path = new, new_path
        release(spark)
        if not changed:
            break
    else:
        raise RuntimeError(f"labels still change after {rounds} rounds")
    remove_folder(spark, both_path)
    if kept is not None:
        kept.append(path)
    return labels
