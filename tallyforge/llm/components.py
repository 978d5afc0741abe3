"""Connected components of an edge table, by repeated least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut, release


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. Returns node, label: the least node of its component, for nodes with an edge.

    Each round takes the least label among a node and its neighbours and then the label of that
    label; rounds are written to the shared folder, and the last changes nothing. Stars settle in
    two rounds and chains in about the logarithm of their length. No edges give no rows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.where("a != b").distinct(), "edges", tidy=False)
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "label", tidy=False)
    while True:
        near = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("label").alias("near"))
        low = label.join(near, label["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("low"))
        jump = label.select(F.col("node").alias("at"), F.col("label").alias("on"))
        after = low.join(jump, low["low"] == jump["at"]).select("node", F.col("label").alias("old"), F.least("low", "on").alias("label"))
        seen = Observation()
        after = cut(after.observe(seen, F.count_if(F.col("old") != F.col("label")).alias("changed")), "label", tidy=False)
        release(label)
        label = after
        if not seen.get["changed"]:
            release(both)
            return _kept(label)


def extended(label: DataFrame, links: DataFrame) -> DataFrame:
    """components() of the links of `label` and new ones (a, b) together. label: as components() gives
    it; released. Each component so far is one node here, named by its label, which is its least
    node, so only what the new links connect is gone through."""
    if links.isEmpty():
        return label
    on = label.select(F.col("node").alias("at"), F.col("label").alias("on"))
    ends = links.select("a", "b")
    for side in "ab":
        ends = ends.join(on, F.col(side) == F.col("at"), "left").withColumn(side, F.coalesce("on", side)).select("a", "b")
    met = components(ends)
    new = met.join(label.select("node"), "node", "left_anti")
    old = label.join(met.select(F.col("node").alias("at"), F.col("label").alias("on")), F.col("label") == F.col("at"), "left")
    out = cut(old.select("node", F.coalesce("on", "label").alias("label")).unionByName(new), "label", tidy=False)
    release(label, met)
    return _kept(out)


def _kept(label: DataFrame) -> DataFrame:
    out = label.select("node", "label")
    out._cut_at = label._cut_at
    return out
