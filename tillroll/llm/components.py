"""Connected components of a table of links, by rounds of smallest neighbouring label."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import stored


def components(links: DataFrame) -> DataFrame:
    """`node` and `label`, the smallest node of its component, for every node of links (a, b).

    A round takes the smallest label among a node's neighbours and then that label's own label, so
    the distance a label travels doubles with every round. Every round is a written table; the
    driver sees one count of changes. No links give an empty result.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("node", "other").distinct()
    )
    labels = stored(
        both.groupBy("node")
        .agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("label"))
    )
    while True:
        near = (
            both.join(labels.toDF("other", "other_label"), "other")
            .groupBy("node")
            .agg(F.min("other_label").alias("near"))
        )
        stepped = stored(
            labels.join(near, "node").select(
                "node", "label", F.least("label", "near").alias("stepped")
            )
        )
        ahead = stepped.select(F.col("node").alias("stepped"), F.col("stepped").alias("ahead"))
        moved = stored(
            stepped.join(ahead, "stepped").select(
                "node", F.col("ahead").alias("label"), (F.col("ahead") != F.col("label")).alias("new")
            )
        )
        if not moved.where("new").limit(1).count():
            return moved.select("node", "label")
        labels = moved.select("node", "label")
