"""Tolerant comparison against a plain matching."""

import math
import random

import pytest

from daygrid.operators.closeness import frames_apart, matched, near
from daygrid.operators.compare import frames_diff

SCHEMA = "k string, x double, y double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain_pairs(left, right, tolerance):
    """Size of a largest matching, by depth-first augmenting paths."""
    partner = {}

    def grow(i, seen):
        for j, b in enumerate(right):
            if j not in seen and left[i][0] == b[0] and all(near(p, q, tolerance) for p, q in zip(left[i][1:], b[1:], strict=True)):
                seen.add(j)
                if j not in partner or grow(partner[j], seen):
                    partner[j] = i
                    return True
        return False

    return sum(grow(i, set()) for i in range(len(left)))


def test_values_astride_a_rounding_bound(spark):
    left, right = frame(spark, [("a", 0.4999999, 1.0)]), frame(spark, [("a", 0.5000001, 1.0)])
    assert frames_diff(left, right, 0).count() == 2
    assert frames_apart(left, right, 1e-6).collect() == []
    assert {r.side for r in frames_apart(left, right, 1e-8).collect()} == {"left", "right"}


@pytest.mark.parametrize("tolerance", [0.0, 0.1, 0.25])
def test_as_many_pairs_as_there_can_be(spark, tolerance):
    rng = random.Random(3)
    value = lambda: rng.choice([None, math.nan, math.inf, -math.inf] + [0.1 * rng.randrange(12) for _ in range(9)])
    rows = lambda n: [(rng.choice(["a", "b", None, "c"]), value(), rng.choice([1.0, 1.1, None])) for _ in range(n)]
    left, right = rows(70) + [("one", 5.0, 1.0)], rows(60) + [("one", 5.05, 1.0), ("new", 1.0, 1.0)]
    found = frames_apart(frame(spark, left), frame(spark, right), tolerance).collect()
    pairs = plain_pairs(left, right, tolerance)
    assert sum(r.copies for r in found if r.side == "left") == len(left) - pairs
    assert sum(r.copies for r in found if r.side == "right") == len(right) - pairs


def test_order_is_not_a_matching(spark):
    """The i-th smallest values are apart; one pair is left all the same."""
    assert matched([(0.0,), (1.0,)], [(1.1,)], 0.5) == [1]
    assert matched([(1.0,), (1.5,)], [(1.4,), (0.6,)], 0.45) == [1, 0]


def test_frames_of_doubles_only_and_empty_frames(spark):
    left = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "x double")
    right = spark.createDataFrame([(1.05,), (2.05,)], "x double")
    assert [tuple(r) for r in frames_apart(left, right, 0.1).collect()] == [(2.0, "left", 1)]
    assert frames_apart(left.limit(0), right.limit(0), 0.1).collect() == []
    assert frames_apart(left.limit(0), right, 0.1).count() == 2


def test_keys_with_one_row_need_no_second_pass(spark):
    """Keys on one side only, or once on both, end in the first pass: no matching is planned."""
    left = frame(spark, [("a", 1.0, None), ("b", 2.0, 1.0), ("only", None, 1.0), ("c", None, None)])
    right = frame(spark, [("a", 1.05, None), ("b", 2.5, 1.0), ("new", 3.0, math.nan), ("c", None, None), ("gone", None, None)])
    found = frames_apart(left, right, 0.1)
    rows = {(r.k, r.x, r.side, r.copies) for r in found.collect()}
    assert rows == {("b", 2.0, "left", 1), ("b", 2.5, "right", 1), ("only", None, "left", 1), ("new", 3.0, "right", 1), ("gone", None, "right", 1)}
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()
