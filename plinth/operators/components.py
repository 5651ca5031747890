"""Connected components by hooking and pointer jumping: labels shrink in a few rounds, whatever the length of the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plinth.runtime import cut, discard, large

GROUND = -1  # label of components that hold a seed


def grounded_labels(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, label``: the smallest id of each node's component, ``GROUND`` where it holds a seed.

    ``nodes(keys, id, seed boolean)`` with ids of 0 and more, ``edges(keys, a, b)`` in either direction or both, between
    nodes of the same keys. In a round every node takes the smallest label of its neighbours' parents, hands it to its own
    parent and then points at its parent's parent; rounds end when no label moves. All steps are joins and minima on
    (keys, id), so no component meets in one task; grounded nodes leave the joins, however many there are.
    """
    both = cut(edges.select(*keys, "a", "b").unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))))
    label = F.when(F.col("seed"), F.lit(GROUND).cast("long")).otherwise(F.col("id"))
    state = cut(nodes.select(*keys, "id", label.alias("label")))
    before = None
    while True:
        parent = state.where(F.col("label") >= 0).select(*keys, F.col("id").alias("child"), F.col("label").alias("id"))
        above = parent.join(large(state), [*keys, "id"]).select(*keys, F.col("child").alias("id"), "label").unionByName(
            state.where(F.col("label") < 0))
        heard = both.join(large(above.withColumnRenamed("id", "a")), [*keys, "a"]).groupBy(*keys, F.col("b").alias("id")).agg(
            F.min("label").alias("heard"))
        # What a node hears also goes to its parent, so that whole trees hook at once.
        told = heard.join(large(state), [*keys, "id"]).where("label >= 0").select(*keys, F.col("label").alias("id"), F.col("heard").alias("label"))
        seen = Observation()
        moved = cut(
            above.unionByName(heard.withColumnRenamed("heard", "label")).unionByName(told).groupBy(*keys, "id").agg(F.min("label").alias("label"))
            .observe(seen, F.sum(F.col("label").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("label") < 0, 1)).alias("n"))
        )
        discard(state)
        state, changed = moved, seen.get
        if changed == before:
            discard(both)
            return state
        before = changed
