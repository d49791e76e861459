"""Every registered query against its SQL counterpart."""

import builtins
import re

import pytest

import __spark_entry__ as spark_entry
from tests.compare import connect, differences
from workload import load_queries

QUERIES, ORACLES = load_queries()


@pytest.fixture(scope="module")
def con(data_root):
    return connect(data_root)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, data_root, name):
    df = QUERIES[name](spark, data_root)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|InPandas|InArrow|PythonUDF|CartesianProduct|NestedLoopJoin", plan)
    assert differences(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, data_root, name):
    assert QUERIES[name](spark, data_root).count() > 0


def test_table_stats_against_the_file(spark, con, data_root):
    row = QUERIES["table_stats"](spark, data_root).first()
    assert row.row_count == con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    assert row.file_count == 1 and row.size_bytes > 0


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:2] == ["snapshot_date", "coin_id"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("absent", ["corpus_pipeline", "daygrid.llm"])
def test_entry_without_the_training_data_package(monkeypatch, absent):
    """The other queries stay where that package or the pipeline is not there."""
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == absent or (absent == "daygrid.llm" and name == "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {absent!r}", name=absent)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", without)
    assert set(spark_entry.queries()) == set(QUERIES) and set(spark_entry.oracle_sql()) == set(ORACLES)
