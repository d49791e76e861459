"""Exact top-k search as a Voronoi join.

Vectors go to the cell of their nearest pivot and stay there, in parts of bounded size. Each query is first solved in the part
it lies in; its k-th score there is its floor. From the summaries of the cells (radius, greatest length) each query has an
upper bound of any product with a cell, and it is sent to the other parts of those cells only whose bound reaches its floor.
Queries are what is replicated; a part of vectors is copied only where more queries reach it than one local solution holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import stage

PIVOTS = 48
#: Vectors and queries that one local solution holds.
PART_ROWS, PART_QUERIES = 16_384, 16_384
#: Queries multiplied at once.
BLOCK = 256
SCALE = 256
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _integers(vector) -> np.ndarray | None:
    """floor(256 x) of a vector as float64 whole numbers; None if it can take no part."""
    if vector is None:
        return None
    try:
        values = np.asarray(vector, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    return np.floor(SCALE * values) if np.isfinite(values).all() else None


def _dot(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer products; those beyond 64 bits count as the nearest 64-bit integer.

    Floating point serves while no sum can pass 2**53. Else pairs are told apart by the sums they can reach: floating point,
    64-bit integers, and Python's integers for the few that need them.
    """
    if not queries.size or not data.size:
        return np.zeros((len(queries), len(data)), np.int64)
    query_most, data_most = np.abs(queries).max(1), np.abs(data).max(1)
    width = data.shape[1]
    if query_most.max() * data_most.max() * width < 2**53:
        return (queries @ data.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = np.empty((len(queries), len(data)), np.int64)
    for line, query, most in zip(out, queries, query_most, strict=True):
        sums = most * data_most * width
        small, large = sums < 2**53, ~(sums < 2**62)
        middle = ~small & ~large
        line[small] = (data[small] @ query).astype(np.int64)
        line[middle] = data[middle].astype(np.int64) @ query.astype(np.int64)
        line[large] = [min(max(int(v), LEAST), MOST) for v in whole(data[large]) @ whole(query)]
    return out


def _matrix(blobs, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to a product."""
    out = np.zeros((len(blobs), width))
    for i, blob in enumerate(blobs):
        row = np.frombuffer(blob, np.float64)
        out[i, : len(row)] = row
    return out


def _best(query_ids, queries: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int):
    """Of each query the ids and scores of its k highest products with rows other than its own; ``ids`` ascend."""
    for at in range(0, len(query_ids), BLOCK):
        score = _dot(queries[at : at + BLOCK], data)
        for query_id, line in zip(query_ids[at : at + BLOCK], score, strict=True):
            others = np.flatnonzero(ids != query_id)
            if not len(others):
                yield query_id, ids[:0], line[:0]
                continue
            line = line[others]
            # The k-th highest, then all that reach it in the order of score and id.
            kth = min(k, len(line))
            best = np.flatnonzero(line >= np.partition(line, -kth)[-kth])
            best = best[np.lexsort((best, ~line[best]))][:k]
            yield query_id, ids[others[best]], line[best]


class Search(NamedTuple):
    """The result, and what it took: rows (vec_id, cell) of the queries sent beyond their own part."""

    result: DataFrame
    sent: DataFrame
    cells: int


def top_k(vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` highest integer products of each query with all other vectors.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on them. Vectors that are null or
    hold null or non-finite components take no part, neither do rows without vec_id. Empty vectors score
    0; of vectors of different lengths the missing components count as 0. Ties go to the smaller vec_id.
    A vec_id is one vector: rows that repeat it count once (the first in the order of the components).
    Products beyond 64 bits count as the nearest 64-bit integer.
    Columns: query_id, rank, vec_id, score. No query or no candidate gives no rows.
    """
    return search(vectors, is_query, k, pivots).result


def search(
    vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS, part_rows: int | None = None, part_queries: int | None = None
) -> Search:
    """``top_k`` with the queries it replicated; ``part_rows`` and ``part_queries`` stand in for the bounds of a local solution."""
    part_rows, part_queries = part_rows or PART_ROWS, part_queries or PART_QUERIES

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [_integers(v) for v in batch["embedding"]]
            blobs = [None if w is None else w.tobytes() for w in whole]
            out = pd.DataFrame({"vec_id": batch["vec_id"], "is_query": batch["is_query"], "vector": blobs})
            yield out[out["vector"].notna()]

    flagged = vectors.where("vec_id IS NOT NULL").select("vec_id", "embedding", is_query.alias("is_query"))
    whole = flagged.mapInPandas(clean, "vec_id long, is_query boolean, vector binary")
    once = whole.groupBy("vec_id").agg(F.max("is_query").alias("is_query"), F.min("vector").alias("vector"))
    rows = stage(once, "knn-vectors")
    width = (rows.agg(F.max(F.length("vector"))).first()[0] or 0) // 8
    # A bounded number of pivots, spread by a hash of the id.
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").collect()
    if not chosen:
        return _nothing(vectors)
    pivot = np.unique(_matrix([r[0] for r in chosen], width), axis=0) if width else np.zeros((1, 0))
    pivot_norm = (pivot**2).sum(1)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["vector"], width)
            squared = (x**2).sum(1)[:, None] + pivot_norm - 2 * (x @ pivot.T)
            cell = squared.argmin(1) if len(x) else np.zeros(0, int)
            batch["cell"] = cell.astype(np.int32)
            batch["distance"] = np.sqrt(((x - pivot[cell]) ** 2).sum(1))
            batch["norm"] = np.sqrt((x**2).sum(1))
            yield batch

    placed = "vec_id long, is_query boolean, vector binary, cell int, distance double, norm double"
    cells = stage(rows.mapInPandas(assign, placed), "knn-cells")
    # Summaries, a row per cell.
    size = {r.cell: r for r in cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("queries"),
        F.max("distance").alias("radius"), F.max("norm").alias("longest"),
    ).collect()}
    if not any(s.queries for s in size.values()):
        return _nothing(vectors)
    # A cell of any size is cut into parts by a hash of the id.
    parts_of = {cell: max(1, -(-s.n // part_rows)) for cell, s in size.items()}
    parts = F.create_map(*[F.lit(v) for kv in parts_of.items() for v in kv])[F.col("cell")]
    data = cells.select("vec_id", "is_query", "vector", "cell", F.pmod(F.xxhash64("vec_id"), parts).cast("int").alias("part"))

    def own(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id")
        matrix, ids, asks = _matrix(group["vector"], width), group["vec_id"].to_numpy(), group["is_query"].to_numpy(bool)
        found = list(_best(ids[asks], matrix[asks], ids, matrix, k))
        out = group.loc[asks, ["vec_id", "vector", "cell", "part"]].reset_index(drop=True)
        out["ids"] = pd.Series([best for _, best, _ in found], dtype=object)
        out["scores"] = pd.Series([scores for _, _, scores in found], dtype=object)
        return out

    # Parts without a query have nothing to solve yet: their rows are not shuffled for it.
    with_queries = F.col("cell").isin([cell for cell, s in size.items() if s.queries])
    at_home = "vec_id long, vector binary, cell int, part int, ids array<long>, scores array<long>"
    solved = stage(data.where(with_queries).groupBy("cell", "part").applyInPandas(own, at_home), "knn-own")

    order = np.array(sorted(size), np.int32)
    radius = np.array([size[cell].radius for cell in order])
    longest = np.array([size[cell].longest for cell in order])

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = _matrix(batch["vector"], width)
            norm = np.sqrt((q**2).sum(1))[:, None]
            floor = np.array([s[-1] if len(s) == k and s[-1] > LEAST else -np.inf for s in batch["scores"]], float)
            # x = p + d with |d| <= radius: q.x <= q.p + |q| radius, and q.x <= |q| |x|.
            most = np.minimum(q @ pivot[order].T + norm * radius, norm * longest)
            slack = 1e-6 + 1e-9 * (norm * (longest + radius))
            # Bounds that overflowed are not numbers and exclude nothing.
            row, cell = np.nonzero(~(most + slack < floor[:, None]))
            yield pd.DataFrame({
                "vec_id": batch["vec_id"].to_numpy()[row], "vector": batch["vector"].to_numpy()[row], "floor": floor[row],
                "cell": order[cell], "home": batch["cell"].to_numpy()[row], "own_part": batch["part"].to_numpy()[row],
            })

    reached = "vec_id long, vector binary, floor double, cell int, home int, own_part int"
    alone = [cell for cell, number in parts_of.items() if number == 1]
    elsewhere = (F.col("cell") != F.col("home")) | ~F.col("cell").isin(alone)
    sent = stage(solved.select("vec_id", "vector", "cell", "part", "scores").mapInPandas(reach, reached).where(elsewhere), "knn-sent")
    asking = {r.cell: r.n for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    result = solved.select(F.col("vec_id").alias("query_id"), F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    if asking:
        blocks_of = {cell: -(-n // part_queries) for cell, n in asking.items()}
        blocks = F.create_map(*[F.lit(v) for kv in blocks_of.items() for v in kv])[F.col("cell")]
        queries = sent.select(
            "*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
            F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks).cast("int").alias("block"),
        ).where((F.col("cell") != F.col("home")) | (F.col("part") != F.col("own_part")))
        asked = data.where(F.col("cell").isin(list(asking))).select(
            "vec_id", "vector", "cell", "part", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("block")
        )

        def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(q) and len(x):
                x = x.sort_values("vec_id")
                matrix, floors = _matrix(x["vector"], width), q["floor"].to_numpy()
                best = _best(q["vec_id"].to_numpy(), _matrix(q["vector"], width), x["vec_id"].to_numpy(), matrix, k)
                for floor, (query_id, ids, scores) in zip(floors, best, strict=True):
                    found += [(query_id, i, s) for i, s in zip(ids, scores, strict=True) if s >= floor]
            return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

        keys = ["cell", "part", "block"]
        cut = queries.select("vec_id", "vector", "floor", *keys)
        there = cut.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
        result = result.unionByName(there)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = result.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    return Search(ranked, sent.select("vec_id", "cell"), len(size))


def _nothing(vectors: DataFrame) -> Search:
    spark = vectors.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return Search(none, spark.createDataFrame([], "vec_id long, cell int"), 0)
