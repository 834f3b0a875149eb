"""Marts from bucketed tables equal the others and join without an exchange."""

from collections import Counter

import pytest

import golden
from lanewise.operators import pricing
from lanewise.plans import derived, layout, marts


@pytest.fixture
def laid(spark):
    def make(tables, buckets=8):
        return layout.lay_out(tables, "laid_out", buckets)

    yield make
    layout.drop_layout(spark, "laid_out")


def test_marts_are_the_same(spark, laid):
    tables = golden.staging(spark)
    for build in (marts.prices_ds, marts.prices):
        expected = Counter(map(tuple, build(tables).collect()))
        assert Counter(map(tuple, build(laid(tables)).collect())) == expected


def test_costs_need_no_exchange_by_datapoint(spark, laid):
    tables = laid(derived.staging(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        costs = pricing.datapoint_costs(tables.datapoints, tables.charges, tables.exchange_rates)
        plan = costs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not shuffles, shuffles
    assert "Bucketed: true" in plan and "BroadcastExchange" in plan
    assert costs.count() > 0
