"""Registered training-data queries against their SQL."""

import pytest

from daygrid.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(session, data_root, name):
    assert differences(QUERIES[name](session, data_root), connect(data_root), ORACLES[name]) is None


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
