"""Connected components on tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every node that has a link; ``component`` is the smallest id reachable.

    ``links`` holds ``a, b``. Each round every node hooks to the smallest label around it, then takes
    its label's label, so long chains shorten by half or more per round. Labels only fall, and the rounds end when
    none does. Each round reads and writes tables in the shared folder; sums over neighbours are
    pre-aggregated, so a node with very many links is no single task's work.
    """
    both = materialize(
        links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            links.select(F.col("b").alias("x"), F.col("a").alias("y"))).where("x <> y").distinct(),
        "component-links")
    labels = materialize(
        both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label"))
        .select(F.col("x").alias("id"), "label"), "component-labels")
    while True:
        around = both.join(labels.withColumnsRenamed({"id": "y", "label": "other"}), "y") \
            .groupBy("x").agg(F.min("other").alias("other"))
        hooked = labels.join(around, labels["id"] == around["x"]).select(
            "id", F.col("label").alias("before"), F.least("label", "other").alias("label"))
        # what a node learns also holds for the node that was its label
        told = hooked.groupBy(F.col("before").alias("root")).agg(F.min("label").alias("told"))
        jumped = hooked.join(told.alias("t1"), F.col("label") == F.col("t1.root"), "left").select(
            "id", "before", F.least(F.col("label"), F.coalesce("t1.told", "label")).alias("label"))
        stored = materialize(jumped, "component-labels")
        labels = stored.select("id", "label")
        if stored.where("label < before").isEmpty():
            return labels.withColumnRenamed("label", "component")
