"""Every registered query against its SQL on the small tables, and the shape of its plan."""

from __future__ import annotations

import contextlib
import io

import pytest

from tests.oracle import connect, differences
from tidewright.plans.registry import load_all, runner

QUERIES = load_all()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folder, con, name):
    q = QUERIES[name]
    df = runner(q)(spark, folder)
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert shape not in plan.getvalue(), f"{name} has {shape}"
    if q.sql:
        assert differences(df, q.sql, con) == []
    else:
        assert df.columns


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if not q.sql] == []
