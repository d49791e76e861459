"""Connected components: of arrays inside a task, and of an edge table across the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import stage


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as edges (a, b), as edges from each component's smallest node to its others."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[one], label[two])
        fresh = label.copy()
        np.minimum.at(fresh, label[one], low)
        np.minimum.at(fresh, label[two], low)
        fresh = fresh[fresh]
        fresh = np.minimum(fresh, fresh[label])
        if (fresh == label).all():
            break
        label = fresh
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b longs): component is the smallest id it reaches.

    Each round takes the smallest label among neighbours and then the label's own label, so long
    chains shrink fast. Rounds end when nothing changes; every round is a table in shared storage.
    """
    both = stage(edges.where("a <> b").unionByName(edges.where("a <> b").selectExpr("b AS a", "a AS b")).distinct(), "cc-edges")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "id"), "cc-labels")
    while True:
        far = labels.select(F.col("id").alias("b"), F.col("label").alias("far"))
        low = both.join(far, "b").groupBy("a").agg(F.min("far").alias("low"))
        met = labels.join(low, labels.id == low.a, "left").select("id", "label", F.least("label", "low").alias("new"))
        up = labels.select(F.col("id").alias("new"), F.col("label").alias("up"))
        jumped = met.join(up, "new", "left").select(
            "id", F.least("new", "up").alias("label"), (F.least("new", "up") != F.col("label")).alias("changed")
        )
        state = stage(jumped, "cc-labels")
        labels = state.select("id", "label")
        if state.where("changed").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
