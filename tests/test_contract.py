"""Every query against its oracle, and the plans they run as."""

import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry
import golden
from compare import compare, oracle_connection
from lanewise.operators import hierarchy, intervals, pricing
from lanewise.plans import derived, marts
from lanewise.plans.oracle import ORACLE
from lanewise.plans.queries import QUERIES
from lanewise.session import broadcast_if_small, materialize, shared_folder

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    rows, problem = compare(spark, oracle, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert problem is None, problem
    assert rows > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def segments(monkeypatch):
    """Plans of everything that is written while a query is built."""
    plans, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        plans.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


@pytest.mark.parametrize(
    "name",
    ["prices", "prices_clipped", "lane_prices_regions_wide", "unrelated_regions", "datapoint_cost",
     "stage_datapoints", "join_rates", "crowded_median", "active_datapoints"],
)
def test_plans_hash_and_stay_in_the_jvm(spark, segments, name):
    """Every written segment, not only the last one."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for one in [*segments, plan]:
        for banned in ("NestedLoop", "Cartesian", "Python", "Pandas", "Arrow", "SortAggregate"):
            assert banned not in one
        assert "SinglePartition" not in one


@pytest.mark.parametrize("limit", ["8000", "4000"])
def test_expanded_days_are_not_shuffled(spark, segments, limit):
    """Rates below and above the broadcast limit: days are made after the last exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        tables = derived.staging(spark, SF_DIR)
        costs = pricing.datapoint_costs(
            tables.datapoints, tables.charges, tables.exchange_rates, keep_unpriced=False
        )
        plan = plan_of(costs)
        rows = costs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows > 1000
    assert ("SortMergeJoin [currency" in plan) == (limit == "4000")
    above, days = plan.split("Generate explode(terms")
    assert "Exchange" not in above
    for segment in segments:
        assert "Generate explode(terms" not in segment


def test_rate_join_gives_the_same_costs_either_way(spark):
    results = []
    for limit in ("10MB", "1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            tables = derived.with_edges(derived.staging(spark, SF_DIR))
            costs = pricing.datapoint_costs(
                tables.datapoints, tables.charges, tables.exchange_rates
            )
            rows = costs.select("d_id", "date", F.round("cost", 4)).collect()
            results.append(sorted(map(str, map(tuple, rows))))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert results[0] == results[1]


def test_date_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "datapoints")
    golden.staging(spark).datapoints.write.parquet(path)
    clipped = intervals.clip(
        intervals.active(spark.read.parquet(path)), dt.date(2021, 1, 2), dt.date(2021, 1, 3)
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(intervals.expand_days(clipped).select("d_id", "date"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "LessThanOrEqual(valid_from,2021-01-03)" in pushed
    assert "GreaterThanOrEqual(valid_to,2021-01-02)" in pushed
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "company_id" not in schema


def test_broadcast_is_behind_measured_bytes(spark):
    """Equal long texts pack into a small file and are large in memory all the same."""
    rows = spark.range(100).withColumnRenamed("id", "k")
    small = materialize(rows, "small")
    long = materialize(rows.withColumn("text", F.expr("repeat('x', 4000)")), "long-texts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        assert "Broadcast" in plan_of(rows.join(broadcast_if_small(small), "k"))
        assert "SortMergeJoin" in plan_of(rows.join(broadcast_if_small(long), "k"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan_of(rows.join(broadcast_if_small(small), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_lane_map_gives_the_same_marts(spark, monkeypatch):
    """With nothing broadcast by hint, the sorted joins publish the same prices."""
    monkeypatch.setattr("lanewise.operators.lanes.broadcast_if_small", lambda t: t.hint("merge"))
    mart = marts.prices_ds(golden.staging(spark)).collect()
    assert sorted(map(str, map(tuple, mart))) == sorted(
        map(str, golden.PORT_MART + golden.REGION_MART)
    )


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_written_tables_carry_their_size(spark):
    small = materialize(hierarchy.ancestor_set(golden.staging(spark).regions), "size-check")
    assert int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 10_000
