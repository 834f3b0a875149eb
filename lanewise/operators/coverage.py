"""How many suppliers and companies stand behind a lane price."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.operators.intervals import (
    disjoint_intervals,
    expand_days,
    first_new_day,
    last_day,
    longest_intervals,
)
from lanewise.operators.lanes import (
    ANCESTOR_TO_REGION,
    CLASSES,
    LANE_KEYS,
    PAIR,
    PORT_TO_PORT,
    REGION_TO_ANCESTOR,
    Located,
    Units,
    attach_lanes,
)
from lanewise.operators.medians import semi_join

SUPPLIER, COMPANY = 1, 2
PARTY = ["equipment_id", "kind", "party"]


def _party_days(on_lanes: DataFrame) -> DataFrame:
    """(lane keys, supplier, company): which kind of party is there on a day, each once."""
    by_lane = disjoint_intervals(on_lanes, ["lane_id", *PARTY])

    def of(kind: int) -> Column:
        return (F.col("kind") == kind) & F.col("party").isNotNull()

    return expand_days(by_lane).select(
        *LANE_KEYS, of(SUPPLIER).alias("supplier"), of(COMPANY).alias("company")
    )


def _with_parties(datapoints: DataFrame, *columns: str) -> DataFrame:
    """A row per supplier and one per company, so that both counts are one pass."""
    parties = F.inline(
        F.array(
            F.struct(F.lit(SUPPLIER).alias("kind"), F.col("supplier_id").alias("party")),
            F.struct(F.lit(COMPANY).alias("kind"), F.col("company_id").alias("party")),
        )
    )
    return datapoints.select(*columns, "equipment_id", "valid_from", "valid_to", parties)


def _datapoint_days(on_lanes: DataFrame) -> DataFrame:
    """(lane keys, supplier, company): the days of datapoints, and whether their supplier and company
    are there for the first time. Half the rows of ``_party_days`` where parties hardly repeat; a
    task orders all datapoints that a party has on a lane, so only for lanes of a checked size.
    """
    firsts = {}
    for party in ("supplier", "company"):
        keys = ["lane_id", "equipment_id", f"{party}_id"]
        earlier = F.row_number().over(Window.partitionBy(*keys).orderBy("valid_from"))
        on_lanes = on_lanes.withColumns(
            {f"{party}_from": first_new_day(keys), f"{party}_opens": earlier == 1}
        )
        new = F.coalesce(F.col("date") >= F.col(f"{party}_from"), F.col(f"{party}_opens"))
        firsts[party] = F.col(f"{party}_id").isNotNull() & new
    return expand_days(on_lanes).select(*LANE_KEYS, *[new.alias(party) for party, new in firsts.items()])


def lane_coverage(
    datapoints: DataFrame | Located,
    members: DataFrame | None = None,
    crowded: DataFrame | None = None,
) -> DataFrame:
    """Per lane, equipment and day: distinct suppliers and companies.

    A datapoint counts whether or not it could be priced, so charges are not read.
    Suppliers and companies become (kind, party) rows. Their intervals are reduced per
    port pair, or per unit of located datapoints, multiplied by the lane map, and cut apart
    per lane: a party then has each of its days in one interval, so days are made last
    and only counted. The shuffles include the party, which spreads a crowded lane. The
    lanes of located datapoints that no unit reduces keep their datapoints whole, unless they
    are among the ``crowded``, by lane and equipment.
    """
    if not isinstance(datapoints, Located):
        present = _with_parties(datapoints, "origin_pid", "destination_pid")
        by_pair = longest_intervals(present, [*PAIR, "kind", "party"])
        return _count_parties(_party_days(attach_lanes(by_pair, members)))
    lane_map, parts, parties = datapoints.lane_map, [], []
    present = datapoints.rows.withColumn("valid_to", last_day())
    if datapoints.scattered:
        whole = present.select(
            "origin", "destination", *CLASSES, "equipment_id", "supplier_id", "company_id",
            "valid_from", "valid_to",
        )
        whole = lane_map.lanes_of(whole, datapoints.scattered)
        if crowded is not None:
            named = ["lane_id", "equipment_id"]
            lanes = crowded.select(*named).distinct()
            parties.append(
                _with_parties(semi_join(whole, lanes, named, "left_semi"), "lane_id")
            )
            whole = semi_join(whole, lanes, named, "left_anti")
        parts.append(_datapoint_days(whole))
    for unit in datapoints.units:
        of_unit = unit.of(_with_parties(present, "origin", "destination", *CLASSES))
        parties.append(unit.lanes(longest_intervals(of_unit, [*unit.keys, *PARTY]), lane_map))
    if parties:
        parts.append(_party_days(reduce(DataFrame.unionByName, parties)))
    return _count_parties(reduce(DataFrame.unionByName, parts))


def _count_parties(days: DataFrame) -> DataFrame:
    return days.groupBy(*LANE_KEYS).agg(
        F.count_if("supplier").alias("supplier_cnt"), F.count_if("company").alias("company_cnt")
    )


def _monthly(datapoints: DataFrame, *columns: str) -> DataFrame:
    """Rows per month that an interval touches, with its ``days`` in it."""
    months = F.sequence(
        F.trunc("valid_from", "month"), F.trunc(last_day(), "month"), F.expr("interval 1 month")
    )
    first = F.greatest("valid_from", "month")
    last = F.least(last_day(), F.last_day("month"))
    made = datapoints.select(
        *columns, "equipment_id", "valid_from", "valid_to", F.explode_outer(months).alias("month")
    )
    return made.withColumn("days", F.coalesce(F.datediff(last, first) + 1, F.lit(1))).drop(
        "valid_from", "valid_to"
    )


def _counted(monthly: DataFrame, keys: list[str]) -> DataFrame:
    return monthly.groupBy(*keys, "equipment_id", "month").agg(
        F.count("*").alias("datapoints"), F.sum("days").alias("days")
    )


def lane_sizes(
    datapoints: DataFrame | Located, members: DataFrame | None = None, above: int = 0
) -> DataFrame:
    """(lane_id, equipment_id, month, rows, days): no day of the month has more datapoints on
    the lane than ``rows``, and all its days together have ``days``. Months, not days, are
    made, and they are added up per port pair, or per unit of located datapoints, before the
    lane map multiplies them. Lanes with no more than ``above`` rows may be left out: one that
    has more has an end of its own with more.
    """
    if isinstance(datapoints, Located):
        lane_map = datapoints.lane_map
        monthly = _monthly(datapoints.rows, "origin", "destination", *CLASSES)
        parts = [
            unit.lanes(_counted(unit.of(monthly), unit.keys), lane_map) for unit in datapoints.units
        ]
        own = {REGION_TO_ANCESTOR: "origin", ANCESTOR_TO_REGION: "destination", PORT_TO_PORT: "origin"}
        for end in ("origin", "destination", None):
            grains = tuple(g for g in datapoints.scattered if own.get(g) == end)
            if not grains:
                continue
            rows = monthly
            if above and end:
                named = [end, "equipment_id", "month"]
                crowded = monthly.groupBy(*named).agg(F.count("*").alias("rows"))
                rows = semi_join(rows, crowded.filter(F.col("rows") > above), named, "left_semi")
            by_ends = _counted(rows, ["origin", "destination", *CLASSES])
            parts.append(lane_map.lanes_of(by_ends, grains))
        on_lanes = reduce(DataFrame.unionByName, parts)
    else:
        by_pair = _counted(_monthly(datapoints, "origin_pid", "destination_pid"), PAIR[:2])
        on_lanes = attach_lanes(by_pair, members)
    return on_lanes.groupBy("lane_id", "equipment_id", "month").agg(
        F.sum("datapoints").alias("rows"), F.sum("days").alias("days")
    )


def unit_sizes(located: Located, unit: Units) -> DataFrame:
    """(unit's keys, equipment_id, month, rows) as ``lane_sizes`` has for lanes."""
    counted = _counted(unit.of(_monthly(located.rows, "origin", "destination", *CLASSES)), unit.keys)
    return counted.select(*unit.keys, "equipment_id", "month", F.col("datapoints").alias("rows"))


def lane_days(located: Located) -> int:
    """How many days datapoints have on all lanes together."""
    by_classes = _monthly(located.rows, *CLASSES).groupBy(*CLASSES).agg(F.sum("days").alias("days"))
    lanes = located.lane_map.fans.groupBy(*CLASSES).agg(F.count("*").alias("lanes"))
    total = by_classes.join(lanes, CLASSES).agg(F.sum(F.col("days") * F.col("lanes")))
    return total.first()[0] or 0
