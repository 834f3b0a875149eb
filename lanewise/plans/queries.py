"""One runnable query per operator, over tables derived from the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.functions import parsing
from lanewise.functions.numeric import convert, quality_flag, round_half_up
from lanewise.operators import hierarchy, lanes, pricing, staging, validate
from lanewise.operators.coverage import lane_coverage
from lanewise.operators.intervals import active, clip, expand_days
from lanewise.operators.keys import dense_keys
from lanewise.operators.medians import statistics
from lanewise.plans import derived, marts
from lanewise.schemas import TABLES, columns
from lanewise.session import broadcast_if_small, materialize
from lanewise.sources.csv_files import project, with_audit
from lanewise.sources.routing import route

LANE = [*lanes.LANE_LABELS, "equipment_id", "date"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FILE_NAME = (
    "concat(case o_orderkey % 12 when 0 then 'regions_' when 1 then 'ports_regions_'"
    " when 2 then 'airports_' when 3 then 'reports_' when 4 then 'exchange_rates_'"
    " when 5 then 'charges_datapoints_' when 6 then 'datapoints_' when 7 then 'Ports_'"
    " when 8 then 'notes_' when 9 then 'charges_' when 10 then 'datapoints_ports_'"
    " else 'ports_' end, cast(o_orderkey as string),"
    " case o_orderkey % 5 when 0 then '.CSV' when 1 then '.csv.gz' else '.csv' end)"
)
INTEGER_TEXT = (
    "case l_orderkey % 13 when 0 then cast(l_partkey as string)"
    " when 1 then concat('+', cast(l_partkey as string))"
    " when 2 then concat(' ', cast(l_partkey as string), ' ')"
    " when 3 then concat(cast(l_partkey as string), '.0')"
    " when 4 then concat(cast(l_partkey as string), 'e3') when 5 then '' when 6 then 'abc'"
    " when 7 then '99999999999' when 8 then concat('0x', cast(l_partkey as string))"
    " when 9 then concat('00', cast(l_partkey as string))"
    " when 10 then concat('-', cast(l_partkey as string))"
    " when 11 then '99999999999999999999' else null end"
)
DOUBLE_TEXT = (
    "case l_orderkey % 17 when 0 then cast(l_partkey as string)"
    " when 1 then concat(cast(l_partkey as string), '.') when 2 then concat('.', cast(l_partkey as string))"
    " when 3 then 'nan' when 4 then '-Infinity' when 5 then 'inf' when 6 then '+NaN'"
    " when 7 then concat(cast(l_partkey as string), 'd') when 8 then concat(cast(l_partkey as string), 'f')"
    " when 9 then '1e3' when 10 then '1,5' when 11 then concat(' ', cast(l_partkey as string), '.25 ')"
    " when 12 then '0x10' when 13 then '' when 14 then 'Infinity'"
    " when 15 then concat('-', cast(l_quantity as string)) else null end"
)
DATE_TEXT = (
    "case l_orderkey % 13 when 0 then substr(cast(l_shipdate as string), 1, 10)"
    " when 1 then substr(cast(l_shipdate as string), 1, 7) when 2 then cast(l_shipdate as string)"
    " when 3 then concat(' ', substr(cast(l_shipdate as string), 1, 10))"
    " when 4 then concat('2024-', cast(l_partkey % 14 as string), '-', cast(l_partkey % 33 as string))"
    " when 5 then '05/01/2024' when 6 then '2024' when 7 then '2024-01-05T00' when 8 then '0000-01-01'"
    " when 9 then '0001-01-01' when 10 then concat('2023-2-', cast(l_partkey % 31 as string))"
    " when 11 then '20240105' else null end"
)
TIMESTAMP_TEXT = (
    "case l_orderkey % 13 when 0 then cast(l_shipdate as string)"
    " when 1 then substr(cast(l_shipdate as string), 1, 10) when 2 then '2024-01-05T01:02:03'"
    " when 3 then concat(cast(l_shipdate as string), '+02')"
    " when 4 then concat(cast(l_shipdate as string), '.', cast(l_partkey as string))"
    " when 5 then concat(cast(l_shipdate as string), '.1234567')"
    " when 6 then concat('2024-1-5 ', cast(l_partkey % 26 as string), ':2:3')"
    " when 7 then concat('2024-01-05 01:02:', cast(l_partkey % 62 as string))"
    " when 8 then '2024-01-05 01:02' when 9 then '2024-02-30 01:02:03' when 10 then 'abc'"
    " when 11 then concat(cast(l_shipdate as string), ' ') else null end"
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Deliveries and raw tables


@query
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = derived.table(spark, sf_dir, "orders").selectExpr(f"{FILE_NAME} as file_name")
    return names.select("file_name", route(F.col("file_name")).alias("table_name"))


@query
def raw_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by name from a file with another order, other case and extras."""
    delivered = derived.raw(spark, sf_dir, "regions").selectExpr(
        "raw_pid as Extra", "parent as PARENT", "slug as Slug", "name as name"
    )
    return project(delivered, "regions")


@query
def raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = derived.table(spark, sf_dir, "lineitem").select(
        "_metadata.file_name", *[F.expr(e) for e in derived.RAW["charges"][1]]
    )
    rows = with_audit(delivered, "charges", F.col("file_name"), F.col("raw_pid"))
    return rows.drop("raw_load_time")


@query
def raw_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = derived.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dense_keys(orders, "o_orderkey", first=1)


# Validation and staging


@query
def pending_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.pending(derived.raw(spark, sf_dir, "datapoints"), "datapoints")


def _texts(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return derived.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{text} as text"
    )


@query
def valid_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, INTEGER_TEXT).withColumns(
        {
            "as_bigint": parsing.parse_integer(F.col("text"), "bigint"),
            "as_int": parsing.parse_integer(F.col("text"), "int"),
        }
    )


@query
def valid_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = parsing.parse_double(F.col("text"))
    finite = F.abs(value) < float("inf")
    return _texts(spark, sf_dir, DOUBLE_TEXT).withColumns(
        {"ok": value.isNotNull(), "finite_value": F.when(finite & ~F.isnan(value), value)}
    )


@query
def valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, DATE_TEXT).withColumn("value", parsing.parse_date(F.col("text")))


@query
def valid_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir, TIMESTAMP_TEXT).withColumn(
        "value", parsing.parse_timestamp(F.col("text"))
    )


def _register_table_queries(table: str) -> None:
    def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = validate.validate(derived.raw(spark, sf_dir, table), table)
        return rows.select("raw_pid", "ok", "failed_columns")

    def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validate.accepted(validate.outcomes(derived.raw(spark, sf_dir, table), table), table)

    QUERIES[f"validate_{table}"] = validated
    QUERIES[f"stage_{table}"] = staged


for _table in TABLES:
    _register_table_queries(_table)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows of two files of one batch."""
    raw = derived.raw_deliveries(spark, sf_dir).withColumns(
        {
            "batch_id": F.lit(0).cast("bigint"),
            "file_rank": F.regexp_extract("src_file", "_(\\d+)", 1).cast("int"),
        }
    )
    outcome = validate.outcomes(raw, "datapoints").withColumn("batch_id", F.lit(0).cast("bigint"))
    return validate.accepted(outcome, "datapoints", "file_rank", "batch_id")


@query
def datapoint_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.versions(_accepted(spark, sf_dir)).select(
        "raw_pid", "d_id", "created", "supplier_id", "is_active"
    )


@query
def load_order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of orders as if delivered in several files of several batches, whose keys do
    not follow the order of the files."""
    rows = derived.table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as d_id",
        "cast(o_orderkey % 3 as bigint) as batch_id",
        "cast(floor(o_orderkey / 3.0) % 5 as int) as file_rank",
        "cast(o_orderkey * 7919 % 1000003 * 100000000 + o_orderkey as bigint) as raw_pid",
    )
    return staging.versions(rows).select("d_id", "batch_id", "file_rank", "raw_pid", "is_active")


@query
def active_datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active(staging.current(_accepted(spark, sf_dir))).select(
        *columns("datapoints"), "raw_pid"
    )


@query
def row_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per raw row: the second delivery is not staged yet."""
    raw = derived.raw_deliveries(spark, sf_dir).withColumns(
        {
            "batch_id": F.when(F.col("src_file") == "datapoints_0.csv", 0).otherwise(1),
            "stg_status": F.lit("NEW"),
            "stg_load_time": F.lit(None).cast("timestamp_ntz"),
        }
    )
    outcome = validate.outcomes(raw.filter("batch_id = 0"), "datapoints")
    untried = raw.filter("batch_id = 1")
    state = staging.current_state(untried, outcome.withColumn("batch_id", F.lit(0)), "datapoints")
    return state.select(
        "raw_pid", "d_id", "stg_status", F.col("stg_load_time").isNotNull().alias("tried")
    )


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_deliveries(spark, sf_dir)
    return validate.rejected(validate.outcomes(raw, "datapoints"))


# Scalar steps of the marts


@query
def lane_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.staging(spark, sf_dir)
    return pricing.join_ports(active(tables.datapoints), tables.ports, "code").select(
        "d_id",
        F.col("origin_code").alias("origin"),
        F.col("destination_code").alias("destination"),
        "equipment_id",
        F.col("valid_from").alias("date"),
    )


@query
def region_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = derived.districts(spark, sf_dir)
    return tree.select("slug", F.col("parent").isNull().alias("is_root"))


@query
def dq_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.staging(spark, sf_dir)
    datapoints = active(tables.datapoints)
    lane_map = marts.lane_map(tables, datapoints, regions=False)
    counted = lane_map.label(lane_coverage(datapoints, lane_map.members))
    flag = quality_flag(F.col("supplier_cnt"), F.col("company_cnt"))
    return counted.drop("grain").withColumn("dq_ok", flag)


@query
def convert_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every charge on a day of its own; some days have no rate, one rate is zero."""
    rates = derived.exchange_rates(spark, sf_dir).withColumn(
        "rate", F.expr("case when currency = 'CNY' and day = date '2021-01-03' then 0 else rate end")
    )
    dated = derived.charges(spark, sf_dir).withColumn(
        "date", F.expr("date_add(date '2021-01-01', cast(d_id % 30 as int))")
    )
    return pricing.join_rates(dated, rates).select(
        "d_id", "currency", "date", "charge_value",
        round_half_up(convert(F.col("charge_value"), F.col("rate")), 4).alias("converted"),
    )


@query
def round_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived.table(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        round_half_up(F.col("l_extendedprice") / F.lit(8.0)).alias("eighth"),
        round_half_up(F.col("l_orderkey") / F.lit(1000.0)).alias("thousandth"),
        round_half_up(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
    )


@query
def daily_datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    return expand_days(active(tables.datapoints)).select("d_id", "date")


@query
def daily_datapoints_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    clipped = clip(active(tables.datapoints), dt.date(2021, 1, 4), dt.date(2021, 1, 8))
    return expand_days(clipped).select("d_id", "date")


# Hierarchy


@query
def region_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.closure(derived.districts(spark, sf_dir))


@query
def region_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.ancestor_set(derived.districts(spark, sf_dir))


def _trade_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Supplier district, customer nation) pairs that traded."""
    return (
        derived.table(spark, sf_dir, "lineitem")
        .join(derived.table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(derived.table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .selectExpr("concat('s', l_suppkey) as slug", "concat('n', c_nationkey) as other")
        .distinct()
    )


@query
def unrelated_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ancestors = hierarchy.ancestor_set(derived.districts(spark, sf_dir))
    ends = ancestors.select(F.col("slug").alias("other"), F.col("ancestor").alias("other_ancestor"))
    pairs = _trade_pairs(spark, sf_dir).join(ancestors, "slug").join(ends, "other")
    kept = hierarchy.drop_related(pairs, ancestors, "ancestor", "other_ancestor")
    return kept.select("slug", "other", "ancestor", "other_ancestor")


# Joins and costs


@query
def join_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.staging(spark, sf_dir)
    days = expand_days(active(tables.datapoints)).select("d_id", "date")
    return pricing.join_charges(days, tables.charges)


@query
def join_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    days = expand_days(active(tables.datapoints)).select("d_id", "date")
    charged = pricing.join_charges(days, tables.charges)
    return pricing.join_rates(charged, tables.exchange_rates).select(
        "d_id", "date", "currency", "charge_value", round_half_up(F.col("rate"), 6).alias("rate")
    )


@query
def join_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    return pricing.join_ports(tables.datapoints, tables.ports, "code", "slug").select(
        "d_id", "origin_pid", "destination_pid",
        "origin_code", "origin_slug", "destination_code", "destination_slug",
    )


@query
def region_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lane map with the datapoints behind each line."""
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    lane_map = marts.lane_map(tables, active(tables.datapoints))
    used = active(tables.datapoints).groupBy("origin_pid", "destination_pid").agg(
        F.count("*").alias("datapoints")
    )
    return lane_map.label(lanes.attach_lanes(used, lane_map.members))


def _costs(tables: marts.Staging) -> DataFrame:
    return pricing.datapoint_costs(
        active(tables.datapoints), tables.charges, tables.exchange_rates
    )


def _cost() -> Column:
    return round_half_up(F.col("cost") * F.col("copies"), 4).alias("cost")


@query
def datapoint_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per datapoint, day and unrelated region combination."""
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    pairs = lanes.port_pairs(active(tables.datapoints))
    combos = lanes.region_pairs(pairs, tables.ports, hierarchy.ancestor_set(tables.regions))
    ends = ["origin_region", "origin_ancestor", "destination_region", "destination_ancestor"]
    combos = broadcast_if_small(materialize(combos, "region-pairs"))
    return lanes.attach_lanes(_costs(tables), combos).select(
        *pricing.DATAPOINT_KEYS, "date", *ends, _cost()
    )


@query
def datapoint_cost_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.with_edges(derived.staging(spark, sf_dir))
    codes = lanes.port_lanes(lanes.port_pairs(active(tables.datapoints)), tables.ports)
    codes = broadcast_if_small(materialize(codes, "port-lanes"))
    return lanes.attach_lanes(_costs(tables), codes).select(
        "d_id", "origin", "destination", "company_id", "supplier_id", "equipment_id", "date", _cost()
    )


# Lane statistics and marts


def _statistics(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    tables = marts.within(derived.staging(spark, sf_dir))
    return marts.lane_statistics(tables, marts.lane_map(tables, tables.datapoints), **options)


@query
def lane_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistics(spark, sf_dir).select(*LANE, "med_cost")


@query
def lane_median_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lane with more than 40 different costs a day is narrowed first."""
    narrowed = _statistics(spark, sf_dir, ordered_values=40)
    return narrowed.select(*LANE, "med_cost", "avg_cost")


@query
def crowded_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net prices of all line items; one group has most of them, too many to order at once."""
    items = derived.table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_orderkey % 10 < 8 then 'crowded' else l_returnflag end as lane",
        "l_extendedprice * (1 - l_discount) as price",
    )
    return statistics(items, ["lane"], "price").select(
        "lane",
        round_half_up(F.col("median")).alias("med_cost"),
        round_half_up(F.col("average")).alias("avg_cost"),
    )


@query
def lane_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistics(spark, sf_dir).select(*LANE, "avg_cost")


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = derived.staging(spark, sf_dir)
    datapoints = active(tables.datapoints)
    lane_map = marts.lane_map(tables, datapoints)
    return lane_map.label(lane_coverage(datapoints, lane_map.members))


QUERIES["lane_coverage"] = _coverage


@query
def lane_prices_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prices_regions(derived.staging(spark, sf_dir))


@query
def lane_prices_regions_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.in_order(marts.prices_regions(derived.staging(spark, sf_dir)))


@query
def lane_prices_regions_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prices_regions(derived.with_edges(derived.staging(spark, sf_dir)))


@query
def lane_prices_regions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of ports, a tree six deep, and as many port pairs as there are orders."""
    return marts.prices_regions(derived.wide(spark, sf_dir))


@query
def lane_prices_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prices_ports(derived.staging(spark, sf_dir))


@query
def prices_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prices_ds(derived.staging(spark, sf_dir))


@query
def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.prices(derived.staging(spark, sf_dir))


@query
def prices_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' prices of four days only."""
    days = {"date_from": dt.date(2021, 1, 4), "date_to": dt.date(2021, 1, 7)}
    return marts.prices(derived.staging(spark, sf_dir), **days)
