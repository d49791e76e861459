"""Lineage without a depth ceiling."""

import pytest

from daygrid.operators.reach import closure, reachable


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "parent string, child string")


def distances(found):
    return {r.node: r.distance for r in found[0].collect()}


def test_a_long_chain_and_its_flag(spark):
    chain = edges(spark, [(f"n{i}", f"n{i + 1}") for i in range(12)])
    assert distances(closure(chain, "n0")) == {f"n{i}": i for i in range(1, 13)}
    assert distances(closure(chain, "n12", "upstream")) == {f"n{12 - i}": i for i in range(1, 13)}
    short, beyond = closure(chain, "n0", depth=4)
    assert {r.node for r in short.collect()} == {"n1", "n2", "n3", "n4"} and beyond
    assert closure(chain, "n8", depth=4)[1] is False and closure(chain, "n0")[1] is False


def test_cycles_and_shortest_ways(spark):
    graph = edges(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "d"), ("x", "y"), ("a", "b")])
    assert distances(closure(graph, "a")) == {"b": 1, "c": 1, "d": 2}
    assert distances(closure(graph, "d")) == {} and distances(closure(graph, "unknown")) == {}
    with pytest.raises(ValueError):
        closure(graph, "a", "sideways")
    with pytest.raises(ValueError):
        closure(graph, "a", depth=0)


def test_bounded_steps_leave_the_edges_where_they_are(spark):
    """Few nodes found: no step shuffles the edges, and odd edges change nothing."""
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "d"), ("d", None), (None, "a"), ("a", "b"), ("d", "e")]
    graph = edges(spark, pairs + [(f"x{i}", f"y{i}") for i in range(50)])
    found = reachable(graph, "a", "downstream", 3)
    assert {r.node: r.distance for r in found.collect()} == {"b": 1, "c": 1, "d": 2, "e": 3} and found.count() == 4
    assert {r.node: r.distance for r in reachable(graph, "e", "upstream", 2).collect()} == {"d": 1, "c": 2}
    assert {(r.node, r.distance) for r in reachable(graph, "a", "downstream", 1).collect()} == {("b", 1), ("c", 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower() and plan.count("LogicalRDD") == 1
