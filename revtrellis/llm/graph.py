"""Connected components by label spreading and pointer jumping, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrellis.llm.common import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in edges (a, b): component is the smallest id that can be reached.

    A round gives each id the smallest label among its neighbours, then the label of its label. Labels only fall, and
    stay in their component, so the fixed point is the smallest id. Rounds grow with the logarithm of the diameter.
    """
    edges = edges.filter("a <> b").select("a", "b")
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("component")), "labels")
    for _ in range(max_rounds):
        spread = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(spread, labels.id == spread.a).select("id", F.least("component", "near").alias("component"), F.col("component").alias("before"))
        lower = written(lower, "labels")
        jump = lower.select(F.col("id").alias("at"), F.col("component").alias("jumped"))
        after = written(
            lower.join(jump, lower.component == jump["at"]).select("id", F.least("component", "jumped").alias("component"), "before"),
            "labels",
        )
        changed = after.filter(F.col("component") != F.col("before")).limit(1).count()
        labels = after.select("id", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
