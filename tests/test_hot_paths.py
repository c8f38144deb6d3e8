"""Registered queries with windows, run with every key hot, against the same SQL."""

from __future__ import annotations

import pytest

from tests.oracle import connect, differences
from tidewright.operators import windows
from tidewright.plans.registry import load_all, runner

NAMES = [
    "w2_partitioned_row_number",
    "w3_running_sum",
    "w4_first_value",
    "w5_lead_last_record",
    "j8_running_self_join",
    "c8_mutually_exclusive_ranges",
    "n3_impact",
    "n4_duration_above_baseline",
    "m4_legacy_customer_orders",
]


@pytest.fixture
def all_hot(monkeypatch):
    monkeypatch.setitem(windows.with_window.__kwdefaults__, "hot_rows", 4)
    monkeypatch.setitem(windows.with_window.__kwdefaults__, "slices", 8)
    monkeypatch.setattr(windows.hot_keys, "__defaults__", (4,))


@pytest.mark.parametrize("name", NAMES)
def test_hot_query(spark, folder, all_hot, name):
    q = load_all()[name]
    df = runner(q)(spark, folder)
    assert "__slice" in df._jdf.queryExecution().toString()
    assert differences(df, q.sql, connect(folder)) == []


def test_customer_orders_with_hot_customers(spark, folder, all_hot):
    from tidewright.plans import models
    from tidewright.plans.registry import tables

    t = tables(spark, folder)
    orders = models.stg_orders(models.raw_orders(t))
    customers = models.stg_customers(models.raw_customers(t))
    paid = models.int_orders(orders, models.stg_payments(models.raw_payments(t)))
    made = models.fct_customer_orders(paid, customers, orders, hot_rows=4)
    assert differences(made, load_all()["m3_fct_customer_orders"].sql, connect(folder)) == []


def scans(df, folder):
    """Files of the given tables that the plan reads."""
    return sum(folder in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)


def test_hot_customers_read_no_more_files(spark, folder, all_hot):
    from tidewright.plans import models
    from tidewright.plans.registry import tables

    t = tables(spark, folder)
    orders = models.stg_orders(models.raw_orders(t))
    customers = models.stg_customers(models.raw_customers(t))
    paid = models.int_orders(orders, models.stg_payments(models.raw_payments(t)))
    plain, hot = (models.fct_customer_orders(paid, customers, orders, **o) for o in ({"hot_rows": 10**6}, {"hot_rows": 4}))
    assert scans(hot, folder) <= scans(plain, folder) <= 4
