"""Lane map: which published lanes a pair of ports contributes to.

Regions, ancestors and the exclusion of related regions depend only on the two
ports, so they are resolved once per port pair that occurs in the data, not once
per datapoint, day and charge. Regions with the same ancestors are a class: which lanes
two regions have besides their own names depends on their classes only, and is resolved
once per pair of classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.operators.hierarchy import drop_related
from lanewise.session import broadcast_if_small, materialize, materialize_with

# A lane row belongs to one grain; region grains are published together.
PORT_TO_PORT, REGION_TO_ANCESTOR, ANCESTOR_TO_REGION, ANCESTOR_TO_ANCESTOR = 0, 1, 2, 3

LANE_LABELS = ["grain", "origin", "destination"]
LANE_KEYS = ["lane_id", "equipment_id", "date"]
PAIR = ["origin_pid", "destination_pid", "equipment_id"]


ALL_GRAINS = (PORT_TO_PORT, REGION_TO_ANCESTOR, ANCESTOR_TO_REGION, ANCESTOR_TO_ANCESTOR)
# Classes that are no set of ancestors: of port codes, and of regions without any ancestor.
PORT_CLASS, NO_ANCESTORS = -1, -2
CLASSES = ["origin_class", "destination_class"]
# Rows are reduced per unit of ends before their lanes multiply them, if there are so many
# times more rows than units.
ROWS_PER_UNIT = 4


def lane_key(grain: Column, origin: Column, destination: Column) -> Column:
    """A lane as one text, NULL ends included: the grain's digit, the ends, the length of the first
    and a mark for a second that is NULL. Without its first digit it names the two ends."""
    length = F.coalesce(F.length(origin).cast("string"), F.lit("-"))
    missing = F.when(destination.isNull(), "-").otherwise("")
    texts = [F.coalesce(end, F.lit("")) for end in (origin, destination)]
    return F.concat(grain.cast("string"), *texts, F.lit(":"), length, F.lit(":"), missing)


def lane_ends(ends: Column) -> tuple[Column, Column]:
    """Origin and destination of a ``lane_key`` without its first digit."""
    tail = F.substring_index(ends, ":", -2)
    length = F.substring_index(tail, ":", 1)
    names = F.substring(ends, F.lit(1), F.length(ends) - F.length(tail) - 1)
    first = F.when(length == "-", 0).otherwise(length.try_cast("int"))
    origin = F.when(length != "-", F.substring(names, F.lit(1), first))
    rest = F.substring(names, first + 1, F.length(names))
    return origin, F.when(~tail.endswith("-"), rest)


@dataclass(frozen=True)
class LaneMap:
    """What the ends of each port pair are, and the lanes that two classes of ends have.

    A lane goes by its ``lane_key``, which holds its labels, so nothing is joined to name it.
    """

    # origin_pid, destination_pid, origin, origin_class, destination, destination_class, copies
    ends: DataFrame
    # grain, origin_class, destination_class, origin_above, destination_above
    fans: DataFrame
    grains: tuple[int, ...]

    @cached_property
    def members(self) -> DataFrame:
        """origin_pid, destination_pid, lane_id, copies: every lane of every pair, written."""
        members = self.lanes_of(self.ends, self.grains)
        return broadcast_if_small(materialize(members, "lane-members"))

    def shared(self) -> bool:
        """Whether two region grains may have a lane with the same ends, NULL being an end: only where
        a port's own region is an ancestor that lanes have on the same side."""
        own = self.ends.filter(F.col("origin_class") != PORT_CLASS)
        for end in ("origin", "destination"):
            side = ANCESTOR_TO_REGION if end == "origin" else REGION_TO_ANCESTOR
            above = self.fans.filter(F.col("grain").isin(side, ANCESTOR_TO_ANCESTOR))
            above = above.select(F.col(f"{end}_above").alias("above")).distinct()
            if own.join(above, F.col(end).eqNullSafe(F.col("above")), "left_semi").head(1):
                return True
        return False

    def lanes_of(self, rows: DataFrame, grains: tuple[int, ...]) -> DataFrame:
        """Replace the ends and classes of ``rows`` by the ``lane_id`` of each of their lanes."""
        chosen = self.fans.filter(F.col("grain").isin(*grains))
        own_origin = F.col("grain").isin(PORT_TO_PORT, REGION_TO_ANCESTOR)
        own_destination = F.col("grain").isin(PORT_TO_PORT, ANCESTOR_TO_REGION)
        rest = [c for c in rows.columns if c not in ("origin", "destination", *CLASSES)]
        return rows.join(chosen, CLASSES).select(
            *rest,
            lane_key(
                F.col("grain"),
                F.when(own_origin, F.col("origin")).otherwise(F.col("origin_above")),
                F.when(own_destination, F.col("destination")).otherwise(F.col("destination_above")),
            ).alias("lane_id"),
        )

    def label(self, df: DataFrame) -> DataFrame:
        """Replace ``lane_id`` by its grain, origin and destination."""
        rest = [c for c in df.columns if c != "lane_id"]
        origin, destination = lane_ends(F.expr("substring(lane_id, 2)"))
        grain = F.substring("lane_id", 1, 1).cast("int")
        return df.select(
            grain.alias("grain"), origin.alias("origin"), destination.alias("destination"), *rest
        )


@dataclass(frozen=True)
class Units:
    """Units of ends that rows are reduced by before their lanes multiply them."""

    columns: tuple[str, ...]  # besides the classes: the ends that the grains tell apart
    grains: tuple[int, ...]

    @property
    def keys(self) -> list[str]:
        return [*self.columns, *CLASSES]

    def of(self, rows: DataFrame) -> DataFrame:
        """``rows`` without the ends that do not count."""
        return rows.drop(*[end for end in ("origin", "destination") if end not in self.columns])

    def lanes(self, rows: DataFrame, lane_map: LaneMap) -> DataFrame:
        missing = {e: F.lit(None).cast("string") for e in ("origin", "destination") if e not in self.columns}
        return lane_map.lanes_of(rows.withColumns(missing) if missing else rows, self.grains)


@dataclass(frozen=True)
class Located:
    """Datapoints with the ends of their ports, written, and how their lanes are made."""

    rows: DataFrame
    lane_map: LaneMap
    units: tuple[Units, ...]  # of the grains that are reduced first
    scattered: tuple[int, ...]  # the other grains


def choose_units(
    grains: tuple[int, ...], rows: int, units: dict[tuple[str, ...], int]
) -> tuple[tuple[Units, ...], tuple[int, ...]]:
    """Units of the ``grains`` for so many rows, where ``units`` says how many there are by the ends
    that count; and the grains left over. Results do not depend on the choice."""

    def few(*columns: str) -> bool:
        return ROWS_PER_UNIT * units[columns] <= rows

    wanted = []
    if few("origin", "destination"):
        wanted.append((("origin", "destination"), ALL_GRAINS))
    if few("destination"):
        wanted.append((("destination",), (ANCESTOR_TO_REGION, ANCESTOR_TO_ANCESTOR)))
    if few("origin"):
        wanted.append((("origin",), (REGION_TO_ANCESTOR, ANCESTOR_TO_ANCESTOR)))
    if few():
        wanted.append(((), (ANCESTOR_TO_ANCESTOR,)))
    found, left = [], list(grains)
    for columns, fit in wanted:
        reduced = tuple(grain for grain in left if grain in fit)
        if reduced:
            found.append(Units(columns, reduced))
            left = [grain for grain in left if grain not in reduced]
    return tuple(found), tuple(left)


def locate(datapoints: DataFrame, lane_map: LaneMap) -> Located:
    """Datapoints with their ends; units are counted, roughly, while they are written."""
    ends = [("origin", "destination"), ("origin",), ("destination",), ()]
    counts = {
        "_".join(("n", *columns)): F.approx_count_distinct(F.xxhash64(*columns, *CLASSES))
        for columns in ends
    }
    needed = datapoints.select(*PAIR, "supplier_id", "company_id", "valid_from", "valid_to")
    rows, seen = materialize_with(
        attach_lanes(needed, lane_map.ends), "located", rows=F.count("*"), **counts
    )
    found = {columns: seen.get("_".join(("n", *columns))) or 0 for columns in ends}
    return Located(rows, lane_map, *choose_units(lane_map.grains, seen.get("rows") or 0, found))


def port_pairs(datapoints: DataFrame) -> DataFrame:
    """Port pairs that occur; bounds the map by the data instead of ports squared."""
    return datapoints.select("origin_pid", "destination_pid").distinct()


def port_regions(ports: DataFrame, ancestors: DataFrame) -> DataFrame:
    """(pid, region, ancestor, copies): a port's region, if known, with its ancestors.

    ``copies`` counts the port rows behind the line; they multiply the cost.
    """
    located = ports.groupBy("pid", "slug").agg(F.count("*").alias("copies"))
    lookup = ancestors.select(F.col("slug").alias("region"), "ancestor")
    return (
        located.join(lookup, located["slug"] == lookup["region"], "left")
        .groupBy("pid", "region", "ancestor")
        .agg(F.sum("copies").alias("copies"))
    )


def _both_ends(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """Left join ``side`` to both ports; a port without a match counts once."""
    out = pairs
    for end in ("origin", "destination"):
        columns = [F.col(c).alias(f"{end}_{c}") for c in side.columns]
        out = out.join(side.select(*columns), f"{end}_pid", "left")
    copies = [F.coalesce(F.col(f"{end}_copies"), F.lit(1)) for end in ("origin", "destination")]
    return out.withColumn("copies", copies[0] * copies[1]).drop(
        "origin_copies", "destination_copies"
    )


def region_pairs(pairs: DataFrame, ports: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Port pairs with every unrelated (ancestor, ancestor) combination.

    The fan-out per pair is tree depth squared.
    """
    fanned = _both_ends(pairs, port_regions(ports, ancestors))
    return drop_related(fanned, ancestors, "origin_ancestor", "destination_ancestor")


def region_classes(ancestors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(region, class), and (above, class) with a class's ancestors: regions with the same ancestors
    have the same class; written."""
    above = ancestors.groupBy(F.col("slug").alias("region")).agg(
        F.array_sort(F.collect_set("ancestor")).alias("above")
    )
    above = materialize(above, "ancestor-sets")
    classes = materialize(
        above.select("above").distinct().withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    regions = above.join(classes, "above").select("region", "class")
    return materialize(regions, "region-classes"), classes


def region_ends(pairs: DataFrame, ports: DataFrame, regions: DataFrame) -> DataFrame:
    """Port pairs with the regions of both ports, their classes and ``copies``.

    A port without a region that has ancestors counts once, with a region NULL. ``copies`` counts
    the port rows behind the line; they multiply the cost.
    """
    located = ports.groupBy("pid", "slug").agg(F.count("*").alias("copies"))
    sides = (
        located.join(regions, located["slug"] == regions["region"], "left")
        .groupBy("pid", F.col("region").alias("name"), "class")
        .agg(F.sum("copies").alias("copies"))
    )
    return _named_ends(_both_ends(pairs, sides), NO_ANCESTORS)


def port_ends(pairs: DataFrame, ports: DataFrame) -> DataFrame:
    """Port pairs with the codes of both ports; an unknown port gives NULL."""
    codes = ports.groupBy("pid", F.col("code").alias("name")).agg(F.count("*").alias("copies"))
    codes = codes.withColumn("class", F.lit(PORT_CLASS).cast("bigint"))
    return _named_ends(_both_ends(pairs, codes), PORT_CLASS)


def _named_ends(fanned: DataFrame, no_class: int) -> DataFrame:
    ends = [
        column
        for end in ("origin", "destination")
        for column in (
            F.col(f"{end}_name").alias(end),
            F.coalesce(f"{end}_class", F.lit(no_class).cast("bigint")).alias(f"{end}_class"),
        )
    ]
    return fanned.select("origin_pid", "destination_pid", *ends, "copies")


def region_fans(ends: DataFrame, classes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """The lanes of the three region grains per pair of classes, without the regions' own names.
    There is no (region, region) grain.

    A datapoint meets a (region, ancestor) lane once per surviving ancestor on the other side. That
    count is the same for all rows of the lane, so it moves neither median nor average and is
    removed here. The fan-out per pair of classes is tree depth squared.
    """
    above = classes.select("class", F.explode("above").alias("above"))
    unknown = ends.sparkSession.range(1).select(
        F.lit(NO_ANCESTORS).cast("bigint").alias("class"), F.lit(None).cast("string").alias("above")
    )
    above = above.unionByName(unknown)
    combos = ends.select(*CLASSES).distinct()
    for end in ("origin", "destination"):
        side = above.select(F.col("class").alias(f"{end}_class"), F.col("above").alias(f"{end}_above"))
        combos = combos.join(side, f"{end}_class")
    # Only ancestors are compared, so regions below which there are none need not be listed.
    tops = ancestors.select(F.col("ancestor").alias("slug")).distinct()
    upper = ancestors.join(tops, "slug", "left_semi")
    kept = drop_related(combos, upper, "origin_above", "destination_above")

    def lane(grain: int, *named: str):
        names = [
            (F.col(end) if end in named else F.lit(None).cast("string")).alias(end)
            for end in ("origin_above", "destination_above")
        ]
        return F.struct(F.lit(grain).alias("grain"), *names)

    grains = F.array(
        lane(REGION_TO_ANCESTOR, "destination_above"),
        lane(ANCESTOR_TO_REGION, "origin_above"),
        lane(ANCESTOR_TO_ANCESTOR, "origin_above", "destination_above"),
    )
    return kept.select(*CLASSES, F.explode(grains).alias("lane")).select(*CLASSES, "lane.*").distinct()


def port_fans(ends: DataFrame) -> DataFrame:
    """The port grain: the lane between two codes."""
    none = F.lit(None).cast("string")
    return ends.sparkSession.range(1).select(
        *[F.lit(PORT_CLASS).cast("bigint").alias(c) for c in CLASSES],
        F.lit(PORT_TO_PORT).alias("grain"),
        none.alias("origin_above"),
        none.alias("destination_above"),
    )


def port_lanes(pairs: DataFrame, ports: DataFrame) -> DataFrame:
    """The port grain: lanes between port codes; an unknown port gives NULL."""
    codes = ports.groupBy("pid", "code").agg(F.count("*").alias("copies"))
    return _both_ends(pairs, codes).select(
        "origin_pid",
        "destination_pid",
        F.lit(PORT_TO_PORT).alias("grain"),
        F.col("origin_code").alias("origin"),
        F.col("destination_code").alias("destination"),
        "copies",
    )


def write_lane_map(
    pairs: DataFrame, ports: DataFrame, ancestors: DataFrame | None, with_ports: bool
) -> LaneMap:
    """Write both tables of a lane map: of regions if their ``ancestors`` are given, of port codes
    ``with_ports``."""
    parts = []
    if ancestors is not None:
        regions, classes = region_classes(ancestors)
        parts.append(region_ends(pairs, ports, regions))
    if with_ports:
        parts.append(port_ends(pairs, ports))
    ends = materialize(reduce(DataFrame.unionByName, parts), "lane-ends")
    fans = [port_fans(ends)] if with_ports else []
    if ancestors is not None:
        between = ends.filter(F.col("origin_class") != PORT_CLASS)
        fans.append(region_fans(between, classes, ancestors))
    fans = materialize(reduce(DataFrame.unionByName, fans), "lane-fans")
    grains = ALL_GRAINS[0 if with_ports else 1 : len(ALL_GRAINS) if ancestors is not None else 1]
    return LaneMap(broadcast_if_small(ends), broadcast_if_small(fans), grains)


def attach_lanes(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Join rows to their lanes on both ports, NULL ports included.

    ``members`` comes with its own hint: broadcast behind a count of its rows, and
    beyond that sorted, where AQE splits a crowded port pair.
    """
    members = members.withColumnsRenamed({"origin_pid": "lane_from", "destination_pid": "lane_to"})
    on = rows["origin_pid"].eqNullSafe(members["lane_from"]) & rows["destination_pid"].eqNullSafe(
        members["lane_to"]
    )
    return rows.join(members, on).drop("lane_from", "lane_to")
