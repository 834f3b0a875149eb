"""Medians and averages against plain ones, on groups of very unequal size."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lanewise.functions.numeric import round_half_up, value_bucket
from lanewise.operators import medians


def make_rows():
    random.seed(7)
    rows = [("hot", i % 2, random.lognormvariate(6, 1.5)) for i in range(6000)]
    rows += [("narrow", 0, 1000 + random.random() / 1000) for _ in range(2001)]
    rows += [("ties", 0, random.choice([1.0, 2.0, 3.0, 3.5])) for _ in range(3000)]
    rows += [("signs", 0, random.uniform(-5, 5)) for _ in range(1000)] + [("signs", 0, 0.0)]
    rows += [("huge", 0, 1e300 * random.random()) for _ in range(501)]
    rows += [("tiny", 0, 1e-300 * random.random()) for _ in range(500)]
    rows += [("one", 0, 4.25), ("two", 0, 1.0), ("two", 0, 2.0), (None, None, 7.0), (None, None, 8.0)]
    rows += [("hot", 0, None), ("nothing", 0, None)]
    return rows


@pytest.mark.parametrize("ordered_values", [10_000, 500, 2])
def test_statistics_equal_plain(spark, ordered_values):
    rows = make_rows()
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(7)
    found = medians.statistics(df, ["a", "b"], "v", ordered_values).collect()
    got = {(r.a, r.b): (r.median, r.average) for r in found}
    assert len(got) == len(found)
    expected = {}
    for a, b, v in rows:
        if v is not None:
            expected.setdefault((a, b), []).append(v)
    assert set(got) == set(expected)
    for key, values in expected.items():
        assert got[key][0] == pytest.approx(statistics.median(values), rel=1e-15), key
        assert got[key][1] == pytest.approx(math.fsum(values) / len(values), rel=1e-9, abs=1e-9), key


def test_close_values_are_narrowed_until_few_are_left(spark, monkeypatch):
    """200,000 distinct prices within a cent: no task puts more than a few in order."""
    prices = spark.range(200_000).selectExpr("'lane' as a", "1000 + id / 2e7 as v")
    read, honest = [], medians._read_middle

    def watching(rows, keys):
        read.append(rows.count())
        return honest(rows, keys)

    monkeypatch.setattr(medians, "_read_middle", watching)
    row = medians.statistics(prices, ["a"], "v", 10_000).first()
    assert row.median == pytest.approx(1000 + 99_999.5 / 2e7, rel=1e-15)
    assert 0 < read[0] <= 10_000


def test_only_large_groups_are_counted_by_value(spark, monkeypatch):
    """Groups that a task may gather take one shuffle and are written nowhere."""
    written, honest = [], medians.materialize

    def watching(rows, name):
        table = honest(rows, name)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(medians, "materialize", watching)
    df = spark.createDataFrame(make_rows(), "a string, b int, v double")
    medians.statistics(df, ["a", "b"], "v").collect()
    assert written == []
    medians.statistics(df.filter("a = 'hot' or a = 'one'"), ["a", "b"], "v", 1000).collect()
    assert dict(written)["counted-values"] == 6000


def test_sizes_may_be_given_for_more_than_a_group(spark):
    """A bound per month, say, for groups that are days."""
    rows = [("a", i % 2, float(i)) for i in range(11)] + [("b", 0, 1.0), (None, 0, 2.0), (None, 1, 4.0)]
    df = spark.createDataFrame(rows, "a string, b int, v double")
    for limit in (1, 5, 100):
        sizes = medians.group_sizes(df, ["a"])
        got = medians.statistics(
            df, ["a", "b"], "v", limit, lambda: medians.large_groups(sizes, limit)
        ).collect()
        assert {(r.a, r.b): r.median for r in got} == {
            ("a", 0): 5.0, ("a", 1): 5.0, ("b", 0): 1.0, (None, 0): 2.0, (None, 1): 4.0
        }


def test_semi_join_keeps_null_keys(spark):
    rows = [("x", None, 1), ("x", None, 2), (None, 1, 3), ("y", 1, 4)]
    df = spark.createDataFrame(rows, "a string, b int, v int")
    marked = spark.createDataFrame([("x", None), (None, 1)], "a string, b int")
    inside = medians.semi_join(df, marked, ["a", "b"], "left_semi")
    outside = medians.semi_join(df, marked, ["a", "b"], "left_anti")
    assert sorted(r.v for r in inside.collect()) == [1, 2, 3]
    assert [r.v for r in outside.collect()] == [4]


def test_buckets_keep_the_order(spark):
    random.seed(3)
    values = [random.choice([-1, 1]) * 10 ** random.uniform(-300, 307) for _ in range(3000)]
    values += [0.0, 1.0, float("inf"), -float("inf"), 1e290, 9.99e289]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    pairs = sorted(tuple(r) for r in df.select("v", value_bucket(F.col("v"))).collect())
    buckets = [b for _, b in pairs]
    assert buckets == sorted(buckets)
    assert all(math.isinf(v) or b == pytest.approx(v, rel=2**-12) for v, b in pairs)
    for bits in medians.BUCKET_BITS:
        finer = df.select("v", value_bucket(F.col("v"), bits)).collect()
        buckets = [b for _, b in sorted(map(tuple, finer))]
        assert buckets == sorted(buckets)


def test_rounding(spark):
    cases = {1.005: 1.0, 0.145: 0.14, 2.5: 2.5, 0.125: 0.13, -0.125: -0.13}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    assert dict(df.select("v", round_half_up(F.col("v"))).collect()) == cases


def test_only_the_middle_of_many_rows_is_counted_by_value(spark, monkeypatch):
    """Of 20,000 distinct values only those in the middle buckets are shuffled and written."""
    written, honest = [], medians.materialize

    def watching(rows, name):
        table = honest(rows, name)
        written.append((name, table.count()))
        return table

    monkeypatch.setattr(medians, "materialize", watching)
    monkeypatch.setattr(medians, "COUNTED_ROWS", 5000, raising=False)
    df = spark.range(1, 20_001).selectExpr("cast(null as string) as a", "cast(id as double) as v")
    df = df.union(spark.sql("select 'few', 3.0D"))
    got = {r.a: (r.median, r.average) for r in medians.statistics(df, ["a"], "v", 1000).collect()}
    assert got == {None: (10000.5, pytest.approx(10000.5)), "few": (3.0, 3.0)}
    assert 0 < dict(written)["counted-values"] < 2000
