"""The published price marts.

All four marts are one plan: costs and coverage are computed once, a single lane
map holds the port grain and the three region grains, and one aggregation prices
every lane.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.functions.numeric import (
    MIN_COMPANIES,
    MIN_SUPPLIERS,
    quality_flag,
    round_half_up,
)
from lanewise.operators.coverage import lane_coverage, lane_days, lane_sizes, unit_sizes
from lanewise.operators.hierarchy import ancestor_set
from lanewise.operators.intervals import Stretches, active, clip, clip_to
from lanewise.operators.lanes import (
    CLASSES,
    LANE_KEYS,
    PORT_TO_PORT,
    LaneMap,
    Located,
    attach_lanes,
    locate,
    port_pairs,
    write_lane_map,
)
from lanewise.operators.medians import ORDERED_VALUES, large_groups, semi_join, statistics
from lanewise.operators.pricing import datapoint_costs
from lanewise.schemas import MART_COLUMNS
from lanewise.session import intermediates, materialize

# Rows that a task makes of costs by joining their lanes, at most on average: what it has to
# put in order of them stays within a few hundred megabytes.
LANE_ROWS = 2_000_000


@dataclass(frozen=True)
class Staging:
    """The five staging tables."""

    datapoints: DataFrame
    charges: DataFrame
    exchange_rates: DataFrame
    ports: DataFrame
    regions: DataFrame


def lane_map(
    tables: Staging, datapoints: DataFrame, ports: bool = True, regions: bool = True
) -> LaneMap:
    """Lanes of every port pair of the datapoints; written once for its readers."""
    ancestors = materialize(ancestor_set(tables.regions), "ancestors") if regions else None
    return write_lane_map(port_pairs(datapoints), tables.ports, ancestors, with_ports=ports)


def within(
    tables: Staging,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    days: Stretches | None = None,
) -> Staging:
    """Active datapoints clipped to a date range, or to some stretches of days, and the
    charges that belong to them.

    Everything a mart reads follows from these, so days outside the range cost nothing
    anywhere: not their port pairs, lanes, coverage or charges.
    """
    datapoints = clip(active(tables.datapoints), date_from, date_to)
    charges = tables.charges
    if days is not None:
        datapoints = clip_to(datapoints, days)
    if date_from is not None or date_to is not None or days is not None:
        charges = charges.join(datapoints.select("d_id"), "d_id", "left_semi")
    return replace(tables, datapoints=datapoints, charges=charges)


def _tasks(spark: SparkSession, lane_rows: int) -> int | None:
    """Tasks for costs that become so many lane rows; None if Spark's own choice will do."""
    if lane_rows <= LANE_ROWS:
        return None
    return max(-(-lane_rows // LANE_ROWS), spark.sparkContext.defaultParallelism)


def lane_prices(
    costs: DataFrame,
    located: Located,
    covered: Callable[[DataFrame], DataFrame],
    ordered_values: int,
    large: DataFrame | None,
) -> DataFrame:
    """(lane keys, median, average) of costs with ends. Where there are few units, the costs of a
    unit and day travel to its lanes as one array."""
    lane_map = located.lane_map

    def find_large() -> DataFrame | None:
        return large

    rows = covered(lane_map.lanes_of(costs, located.scattered))
    if not located.units:
        return statistics(rows, LANE_KEYS, "cost", ordered_values, find_large)
    packs, parts = [], []
    for unit in located.units:
        of_unit = unit.of(costs)
        parts.append(unit.lanes(of_unit, lane_map))
        if large is not None:
            # A unit as large as a large group is in large groups only.
            sizes = unit_sizes(located, unit)
            crowded = large_groups(sizes, ordered_values)
            if crowded is not None:
                of_unit = semi_join(of_unit, crowded, crowded.columns, "left_anti")
        by_day = of_unit.groupBy(*unit.keys, "equipment_id", "date", "month").agg(
            F.collect_list("cost").alias("cost")
        )
        packs.append(unit.lanes(by_day, lane_map))
    packs, parts = [covered(reduce(DataFrame.unionByName, some)) for some in (packs, parts)]
    return statistics(rows, LANE_KEYS, "cost", ordered_values, find_large, (packs, parts))


def lane_statistics(
    tables: Staging,
    lane_map: LaneMap,
    min_suppliers: int = 0,
    min_companies: int = 0,
    ordered_values: int = ORDERED_VALUES,
) -> DataFrame:
    """(grain, origin, destination, equipment_id, date, med_cost, avg_cost,
    supplier_cnt, company_cnt), prices rounded to cents.

    Coverage is known before any price. Lanes below the minimum counts are dropped from
    it, and costs meet what is left before their medians are taken. How many datapoints a lane
    has in a month tells, before any price, which groups are too large to be gathered, and the
    days of all lanes tell how many tasks the costs are dealt to before lanes multiply them.
    Coverage rows and statistics meet in one aggregation, which keeps lanes that have
    datapoints but no cost.
    """
    datapoints = tables.datapoints
    located = locate(datapoints, lane_map)
    # Two small jobs that do not wait for each other.
    with ThreadPoolExecutor(max_workers=2) as pool:
        sizes = lane_sizes(located, above=ordered_values).drop("days")
        found = pool.submit(large_groups, sizes, ordered_values)
        days = pool.submit(lane_days, located)
    large, days = found.result(), days.result()
    coverage = lane_coverage(located, crowded=large)
    limited = min_suppliers > 0 or min_companies > 0
    if limited:
        # Read by the costs of rows and of units, and by the merge.
        coverage = materialize(
            coverage.filter(
                (F.col("supplier_cnt") >= min_suppliers) & (F.col("company_cnt") >= min_companies)
            ),
            "lane-coverage",
        )
    tasks = _tasks(datapoints.sparkSession, days)
    costs = datapoint_costs(
        datapoints, tables.charges, tables.exchange_rates, keep_unpriced=False, tasks=tasks
    ).select("d_id", "origin_pid", "destination_pid", "equipment_id", "date", "cost")
    costs = attach_lanes(costs, lane_map.ends).select(
        "d_id",
        "origin",
        "destination",
        *CLASSES,
        "equipment_id",
        "date",
        F.trunc("date", "month").alias("month"),
        (F.col("cost") * F.col("copies")).alias("cost"),
    )
    if large is not None or (located.units and located.scattered):
        # Read by the gathered groups, the units and the large groups.
        costs = materialize(costs, "lane-costs")
        if large is not None and tasks is not None:
            costs = costs.repartition(tasks, "d_id")
    costs = costs.drop("d_id")

    def covered(priced: DataFrame) -> DataFrame:
        return semi_join(priced, coverage, LANE_KEYS, "left_semi") if limited else priced

    prices = lane_prices(costs, located, covered, ordered_values, large)
    merged = coverage.unionByName(prices, allowMissingColumns=True)
    found = merged.groupBy(*LANE_KEYS).agg(
        round_half_up(F.max("median")).alias("med_cost"),
        round_half_up(F.max("average")).alias("avg_cost"),
        F.max("supplier_cnt").alias("supplier_cnt"),
        F.max("company_cnt").alias("company_cnt"),
    )
    return lane_map.label(found)


def publish(
    statistics: DataFrame,
    min_suppliers: int = MIN_SUPPLIERS,
    min_companies: int = MIN_COMPANIES,
    regions: bool = True,
) -> DataFrame:
    """Merge the grains and set the quality flag.

    Region grains form a set: equal rows collapse while the counts are still
    visible, equal keys with other values stay. Port lanes have unique keys, so one
    distinct serves both without mixing them, and port lanes alone need none; nor do
    ``regions`` that are never both a port's own and an ancestor, as no two grains share a lane.
    """
    flagged = statistics.withColumn("between_ports", F.col("grain") == PORT_TO_PORT).drop("grain")
    if regions:
        flagged = flagged.distinct()
    flag = quality_flag(F.col("supplier_cnt"), F.col("company_cnt"), min_suppliers, min_companies)
    return flagged.withColumn("dq_ok", flag).select(*MART_COLUMNS)


def _mart(
    tables: Staging,
    ports: bool,
    regions: bool,
    covered_only: bool = False,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    days: Stretches | None = None,
) -> DataFrame:
    tables = within(tables, date_from, date_to, days)
    mapped = lane_map(tables, tables.datapoints, ports=ports, regions=regions)
    least = (MIN_SUPPLIERS, MIN_COMPANIES) if covered_only else (0, 0)
    return publish(lane_statistics(tables, mapped, *least), regions=regions and mapped.shared())


def prices_regions(tables: Staging, **options) -> DataFrame:
    """Prices between regions."""
    return _mart(tables, ports=False, regions=True, **options)


def prices_ports(tables: Staging, **options) -> DataFrame:
    """Prices between ports."""
    return _mart(tables, ports=True, regions=False, **options)


def prices_ds(tables: Staging, **options) -> DataFrame:
    """All prices, for analysts."""
    return _mart(tables, ports=True, regions=True, **options)


def prices(tables: Staging, **options) -> DataFrame:
    """Prices with enough coverage, for customers; other lanes are never priced."""
    return _mart(tables, ports=True, regions=True, covered_only=True, **options)


def in_order(mart: DataFrame) -> DataFrame:
    """Reading order; NULL lanes last. Only for the outermost call."""
    return mart.orderBy(*[F.asc_nulls_last(c) for c in MART_COLUMNS[:4]])


def write_mart(spark: SparkSession, build: Callable[[], DataFrame], path: str) -> None:
    """Write the mart that ``build`` returns, by date, and delete what it was built from."""
    with intermediates(spark):
        build().write.mode("overwrite").partitionBy("date").parquet(path)
