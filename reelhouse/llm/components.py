"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.session import scratch_dir
from reelhouse.sources.store import delete


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Written to the shared folder and read again, which also cuts the lineage."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of `links` (a, b) reaches.

    Labels move along links and then jump to their own label, so the rounds grow with the
    logarithm of the longest path. A node with very many links or members is a hot join key only,
    which adaptive execution splits. The driver sees one count per round.
    """
    folder = scratch_dir(links.sparkSession)
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), f"{folder}/links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("component")
        ),
        f"{folder}/labels-0",
    )
    step = 0
    while True:
        step += 1
        offered = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(both["a"].alias("node"))
            .agg(F.min("component").alias("offered"))
        )
        lowered = labels.join(offered, "node").select(
            "node", F.least("component", "offered").alias("lower"), "component"
        )
        lowered = stored(lowered, f"{folder}/lower-{step}")
        target = lowered.select(F.col("node").alias("lower"), F.col("lower").alias("lowest"))
        moved = lowered.join(target, "lower").select(
            "node", F.col("lowest").alias("component"), (F.col("lowest") != F.col("component")).alias("moved")
        )
        moved = stored(moved, f"{folder}/labels-{step}")
        labels = moved.select("node", "component")
        for old in (f"{folder}/labels-{step - 1}", f"{folder}/lower-{step}"):
            delete(links.sparkSession, old)  # nothing reads them any more
        if moved.filter("moved").isEmpty():
            return labels
