import numpy as np
from pyspark.sql import functions as F

from daygrid.llm import knn

KINDS = "vec_id long, embedding array<double>, rank int"


def plain(rows, is_query, k=5):
    """Every product of whole numbers; beyond 64 bits the nearest of them."""
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    out = set()
    for q in filter(is_query, whole):
        score = {i: max(min(sum(a * b for a, b in zip(whole[q], v)), knn.MOST), knn.LEAST) for i, v in whole.items() if i != q}  # noqa: B905
        best = sorted((-s, i) for i, s in score.items())[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def clustered(clusters, each, width=16):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((clusters, width)) * 4
    return [(int(c * each + n), [float(x) for x in centres[c] + 0.05 * rng.standard_normal(width)]) for c in range(clusters) for n in range(each)]


def test_clustered_vectors_are_pruned_and_results_whole(session):
    rows = clustered(20, 60)
    data = session.createDataFrame([(*r, 0) for r in rows], KINDS)
    asks = F.col("vec_id") % 7 == 0
    found = knn.search(data, asks, pivots=40, part_rows=50, part_queries=10)
    assert {tuple(r) for r in found.result.collect()} == plain(rows, lambda i: i % 7 == 0)
    queries = sum(i % 7 == 0 for i, _ in rows)
    # Each query meets a few cells of some 40; without bounds it would meet all.
    assert found.cells >= 15 and found.sent.count() < queries * found.cells / 4


def test_hot_cell_with_equal_vectors_keeps_the_smallest_ids(session):
    rows = [(i, [1.0, 0.5]) for i in range(400)] + [(1000 + i, [-1.0, float(i)]) for i in range(6)]
    data = session.createDataFrame([(*r, 0) for r in rows], KINDS)
    found = knn.search(data, F.col("vec_id") % 50 == 0, part_rows=30, part_queries=2).result
    assert {tuple(r) for r in found.collect()} == plain(rows, lambda i: i % 50 == 0)


def test_sums_beyond_64_bits_and_lengths_that_overflow(session):
    rows = [(0, [1e12, 3.0]), (1, [1e12, -2.0]), (2, [-1e12, 1.0]), (3, [1e200, 1.0]), (4, [-1e300, 0.0]), (5, [0.5, 0.25]), (6, [0.0, 0.0]), (10, [])]
    rows += [(20 + i, [i / 8, 1 - i / 8]) for i in range(20)]
    data = session.createDataFrame([(*r, 0) for r in rows], KINDS)
    for part_rows in (3, 1000):
        found = knn.search(data, F.col("vec_id") >= 0, pivots=6, part_rows=part_rows).result
        assert {tuple(r) for r in found.collect()} == plain(rows, lambda i: True)


def test_fewer_vectors_than_asked_for_and_none(session):
    rows = [(1, [1.0]), (2, [2.0]), (3, [])]
    data = session.createDataFrame([(*r, 0) for r in rows], KINDS)
    assert {tuple(r) for r in knn.top_k(data, F.col("vec_id") == 1, pivots=1).collect()} == plain(rows, lambda i: i == 1)
    lone = knn.search(data.where("vec_id = 3"), F.col("vec_id") == 3)
    assert lone.result.collect() == [] and knn.search(data.limit(0), F.col("vec_id") == 3).cells == 0
