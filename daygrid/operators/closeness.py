"""Differences between two frames whose doubles may differ by a tolerance.

Rounding cannot do this: 0.4999999 and 0.5000001 round apart. Here a row of one side is paired with a row of the other
when all other columns are equal and every double differs by at most the tolerance; pairs are one to one.

1. Equal rows are counted by side in one aggregation with map-side combine, and the counts are summed up per key
   (the columns that are not doubles). A key with at most one row a side is compared as it is. Nearly everything ends
   here; keys that are not near are stored, and where no key has more rows the difference is read from there.
2. Of the other keys rows are counted again. Where no more than one side has rows beyond those equal on both, these are
   the difference. All rows of what remains fall into buckets of the first double as wide as the tolerance; partners lie in the same or a
   neighbouring bucket. Runs of neighbouring buckets are matched apart from each other, by augmenting paths. Equal rows
   take part: pairing them first can cost a pair (0, 0.2 against 0.2, 0.4 within 0.25).
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrid.operators.compare import frames_diff
from daygrid.session import scratch_dir


def _near(a: Column, b: Column, tolerance: float) -> Column:
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= F.lit(tolerance), F.lit(False))


def near(a: float | None, b: float | None, tolerance: float) -> bool:
    """Both missing, both NaN, equal, or within the tolerance."""
    if a is None or b is None:
        return a is b
    return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= tolerance


def matched(left: list[tuple], right: list[tuple], tolerance: float) -> list[int]:
    """For each right row the left row it is paired with or -1; as many pairs as there can be."""
    options = [
        [j for j, b in enumerate(right) if all(near(x, y, tolerance) for x, y in zip(a, b, strict=True))] for a in left
    ]
    partner = [-1] * len(right)
    for start in range(len(left)):
        # Breadth first over alternating paths: back[j] is the left row that reached right row j.
        back: dict[int, int] = {}
        queue, free = [start], None
        while queue and free is None:
            at = queue.pop(0)
            for j in options[at]:
                if j not in back:
                    back[j] = at
                    if partner[j] < 0:
                        free = j
                        break
                    queue.append(partner[j])
        while free is not None:
            at = back[free]
            before = next((j for j, i in enumerate(partner) if i == at), None)
            partner[free] = at
            free = before if at != start else None
    return partner


def frames_apart(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """Rows without a partner on the other side: the columns, ``side`` and ``copies``.

    Columns are matched by position, row order does not matter, copies are counted. NULL pairs with NULL and NaN with
    NaN. Where rows of one key can be paired in several ways, as many as possible are; which of them is left over is
    not determined. Frames without doubles are compared exactly.
    """
    doubles = [f.name for f in left.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not doubles:
        return frames_diff(left, right)
    if len(left.columns) != len(right.columns):
        raise ValueError("the frames have different numbers of columns")
    names = left.columns
    keys = [c for c in names if c not in doubles]

    def prepared(df: DataFrame, ours: int) -> DataFrame:
        df = df.toDF(*names).select(*keys, *(F.col(c).cast("double").alias(c) for c in doubles))
        return df.select("*", F.lit(ours).alias("_l"), F.lit(1 - ours).alias("_r"))

    counts = prepared(left, 1).unionByName(prepared(right, 0)).groupBy(*keys, *doubles).agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r")
    )
    values = F.struct(*doubles)
    l, r = F.col("_l"), F.col("_r")
    sides = counts.groupBy(*keys).agg(
        F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"),
        F.sum(F.greatest(l - r, F.lit(0))).alias("_el"), F.sum(F.greatest(r - l, F.lit(0))).alias("_er"),
        F.max(F.when(l > 0, values)).alias("_a"), F.max(F.when(r > 0, values)).alias("_b"),
    ).where("_el > 0 OR _er > 0")
    single = (F.col("_nl") == 1) & (F.col("_nr") == 1)
    close = reduce(lambda a, b: a & b, (_near(F.col(f"_a.{c}"), F.col(f"_b.{c}"), tolerance) for c in doubles))
    path = scratch_dir(left.sparkSession, "apart")
    sides.where(~(single & close)).write.parquet(path)
    sides = left.sparkSession.read.schema(sides.schema).parquet(path)
    few = (F.col("_nl") <= 1) & (F.col("_nr") <= 1)
    pair = F.explode(F.array(
        F.struct(F.lit("left").alias("side"), F.col("_a").alias("v"), F.col("_nl").alias("n")),
        F.struct(F.lit("right").alias("side"), F.col("_b").alias("v"), F.col("_nr").alias("n")),
    )).alias("_p")
    alone = sides.where(few).select(*keys, pair).where("_p.n = 1").select(
        *keys, *(F.col(f"_p.v.{c}").alias(c) for c in doubles), F.col("_p.side").alias("side"), F.lit(1).cast("long").alias("copies")
    )
    others = sides.where(~few).select(
        *(F.col(c).alias(f"_k_{c}") for c in keys), ((F.col("_el") > 0) & (F.col("_er") > 0)).alias("_both")
    )
    if others.isEmpty():
        return alone.select(*names, "side", "copies")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys), F.lit(True))
    rows = counts.join(others, same)
    columns = [*keys, *doubles]
    one_sided = rows.where("NOT _both AND _l <> _r").select(
        *columns, F.when(l > r, "left").otherwise("right").alias("side"), F.abs(l - r).alias("copies")
    )
    open_rows = rows.where("_both AND _l > 0").select(*columns, F.lit("left").alias("side"), l.alias("copies")).unionByName(
        rows.where("_both AND _r > 0").select(*columns, F.lit("right").alias("side"), r.alias("copies"))
    )
    return one_sided.unionByName(alone).unionByName(_matched_runs(open_rows, keys, doubles, tolerance)).select(
        *names, "side", "copies"
    )


def _matched_runs(rows: DataFrame, keys: list[str], doubles: list[str], tolerance: float) -> DataFrame:
    """Match the rows of each run of neighbouring buckets of a key; returns what stays without a partner."""
    first = F.col(doubles[0])
    usual = first.isNotNull() & ~F.isnan(first) & (F.abs(first) < F.lit(math.inf))
    # Values that no number is near to have runs of their own.
    bucket = F.when(usual, F.floor(first / F.lit(tolerance)) if tolerance else first)
    placed = rows.withColumns({"_bucket": bucket.cast("double"), "_odd": F.when(~usual, first.cast("string")).otherwise(F.lit("number"))})
    order = Window.partitionBy(*keys, "_odd").orderBy("_bucket")
    gap = F.col("_bucket") - F.lag("_bucket").over(order) > F.lit(1.0 if tolerance else 0.0)
    runs = placed.withColumn("_new", F.coalesce(gap, F.lit(False)).cast("int")).withColumn("_run", F.sum("_new").over(order))

    def match(group: pd.DataFrame) -> pd.DataFrame:
        spread = group.loc[group.index.repeat(group["copies"])]
        sides = {side: spread[spread["side"] == side] for side in ("left", "right")}
        as_rows = {
            side: [tuple(None if missing else v for v, missing in zip(row, gone, strict=True))
                   for row, gone in zip(df[doubles].itertuples(index=False), df[[f"_null_{c}" for c in doubles]].to_numpy(), strict=True)]
            for side, df in sides.items()
        }
        partner = matched(as_rows["left"], as_rows["right"], tolerance)
        used = set(partner)
        left = sides["left"][[i not in used for i in range(len(sides["left"]))]]
        right = sides["right"][[i < 0 for i in partner]]
        return pd.concat([left, right]).assign(copies=1)[[f.name for f in schema.fields]]

    wanted = runs.select(*keys, *doubles, *(F.col(c).isNull().alias(f"_null_{c}") for c in doubles), "side", "copies", "_odd", "_run")
    schema = wanted.drop("_odd", "_run").schema
    left_over = wanted.groupBy(*keys, "_odd", "_run").applyInPandas(match, schema)
    # pandas has one value for NULL and NaN.
    whole = left_over.select(
        *keys, *(F.when(F.col(f"_null_{c}"), F.lit(None)).otherwise(F.coalesce(c, F.lit(math.nan))).alias(c) for c in doubles),
        "side", "copies",
    )
    return whole.groupBy(*keys, *doubles, "side").agg(F.sum("copies").alias("copies"))
