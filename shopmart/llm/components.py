"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopmart.llm.storage import discard, store


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each node of ``links`` (a, b) can reach: columns node, component.

    A round gives each node the smallest label among its neighbours and then the label of its
    label, so long chains shrink by more than half. Each round is a written table; nothing is gathered.
    """
    both = store(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = store(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
            "node", F.least("node", "b").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("parent")
        )
        parents = labels.select(F.col("node").alias("parent"), F.col("component").alias("jump"))
        moved = store(
            hooked.join(parents, "parent", "left").select(
                "node", "old", F.least("parent", F.coalesce("jump", "parent")).alias("component")
            ),
            "labels",
        )
        done = moved.filter("old <> component").isEmpty()
        discard(labels)
        labels = moved
        if done:
            discard(both)
            return labels.select("node", "component")
