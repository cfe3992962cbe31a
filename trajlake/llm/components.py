"""Connected components of an edge table, by smallest labels and pointer jumping, without collecting any edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.llm.common import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: each node that has an edge, and the smallest node of its component.

    A round looks at the smallest root next to each node, hooks the node and its present root to it, and replaces roots by their
    roots. Hooking roots, not nodes alone, merges whole trees, so rounds grow with the logarithm of the number of nodes at most. The
    label tables go to the shared folder; whether anything has changed is all that reaches the driver. A node with very many edges
    is pre-aggregated where it is grouped, and its join is one that AQE can split.
    """
    both = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).where("u <> v").distinct(), "edges")
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("m"))
        seen = stage(labels.join(near, labels["node"] == near["u"]).select("node", F.col("root").alias("old"), F.least("root", "m").alias("low")), "near")
        hooks = seen.where("low < old").groupBy(F.col("old").alias("tree")).agg(F.min("low").alias("hook"))
        step = seen.join(hooks, seen["node"] == hooks["tree"], "left").select("node", "old", F.least("low", "hook").alias("root"))
        hop = step.select(F.col("node").alias("at"), F.col("root").alias("next"))
        after = stage(step.join(hop, step["root"] == hop["at"], "left").select("node", "old", F.least("root", "next").alias("root")), "labels")
        labels = after.select("node", "root")
        if not after.where("root <> old").limit(1).count():
            return labels
