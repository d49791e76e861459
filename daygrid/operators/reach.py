"""Bounded reachability over an edge table (lineage)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.session import scratch_dir

MAX_DEPTH = 5


def reachable(edges: DataFrame, start: str, direction: str = "downstream", depth: int = 1) -> DataFrame:
    """Nodes within ``depth`` edges of ``start`` and their shortest distance.

    ``edges`` has ``parent`` and ``child``. Each step is one join of the edges with the nodes found by
    the step before, less those known already, so cycles end by themselves and a node is extended once.
    The nodes of every step but the last are stored: no step is computed twice, and their size tells
    Spark whether to broadcast them, so that the edges stay where they are, or to shuffle both sides
    (whose hot node adaptive execution can split, on either side). Copies are dropped in the map tasks.
    """
    if direction not in ("upstream", "downstream"):
        raise ValueError("direction must be 'upstream' or 'downstream'")
    if isinstance(depth, bool) or not isinstance(depth, int) or not 1 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be 1 to {MAX_DEPTH}")
    near, far = ("parent", "child") if direction == "downstream" else ("child", "parent")
    links = edges.select(F.col(near).alias("node"), F.col(far).alias("_next"))
    last = known = edges.sparkSession.range(1).select(F.lit(start).alias("node"), F.lit(0).alias("distance"))
    for distance in range(1, depth + 1):
        reached = last.join(links, "node").select(F.col("_next").alias("node")).distinct()
        fresh = reached.join(known.select("node"), "node", "left_anti").select("node", F.lit(distance).alias("distance"))
        last = fresh if distance == depth else _kept(fresh, "frontier")
        known = known.unionByName(last)
    return known.where("distance > 0 AND node IS NOT NULL")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closure(edges: DataFrame, start: str, direction: str = "downstream", depth: int | None = None) -> tuple[DataFrame, bool]:
    """All nodes that ``start`` reaches with their shortest distance, and whether there are nodes beyond ``depth``.

    Each round extends the nodes found last by one edge and drops those already known, so cycles end it and a chain may
    be of any length. Every round is stored, which cuts the lineage; only whether it found anything reaches the driver.
    ``start`` itself is left out; a node without edges reaches nothing. The links are stored once, narrow and distinct.
    """
    if direction not in ("upstream", "downstream"):
        raise ValueError("direction must be 'upstream' or 'downstream'")
    if depth is not None and depth < 1:
        raise ValueError("depth must be at least 1")
    near, far = ("parent", "child") if direction == "downstream" else ("child", "parent")
    links = _kept(edges.select(F.col(near).alias("node"), F.col(far).alias("_next")).where("node <> _next").distinct(), "links")
    spark = edges.sparkSession
    last = known = spark.range(1).select(F.lit(start).alias("node"), F.lit(0).alias("distance"))
    distance = 0
    while True:
        distance += 1
        reached = last.join(links, "node").select(F.col("_next").alias("node")).distinct()
        fresh = reached.join(known.select("node"), "node", "left_anti").select("node", F.lit(distance).alias("distance"))
        last = _kept(fresh, "frontier")
        found = not last.isEmpty()
        if not found or (depth is not None and distance > depth):
            return known.where("distance > 0"), found
        known = _kept(known.unionByName(last), "reached")
