"""Connected components of a link table, without the links or the components ever leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, *, max_rounds: int = 64) -> DataFrame:
    """id and component_id (smallest id reachable) of every id in links (columns a, b).

    Labels sink along links and then jump to their label's label, so that chains shorten by half a round. Both sides
    of every join are written tables, which lets adaptive execution split a hub with very many links.
    """
    edges = cut(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct().select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v").distinct())
    labels = cut(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "id"))
    for _ in range(max_rounds):
        near = edges.join(labels.withColumnsRenamed({"id": "v", "label": "near"}), "v").groupBy("u").agg(F.min("near").alias("near")).withColumnRenamed("u", "id")
        sunk = cut(labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("was")))
        jumped = cut(sunk.join(sunk.select(F.col("id").alias("label"), F.col("label").alias("next")), "label").select("id", F.col("next").alias("label"), "was"))
        changed = jumped.filter("label <> was").count()
        labels = jumped.select("id", "label")
        if not changed:
            return labels.select("id", F.col("label").alias("component_id"))
    raise RuntimeError(f"components are not complete after {max_rounds} rounds")
