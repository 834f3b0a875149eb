"""Exact medians and averages of groups of any size: gathered in one shuffle, and narrowed
to the middle first where a group is too large for that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions.numeric import value_bucket
from lanewise.session import materialize, materialize_with

# Values of a group that one task gathers and puts in order, two megabytes; more are narrowed
# first.
ORDERED_VALUES = 250_000
# Significant bits of the buckets, round by round. At 52 bits no more than three
# neighbouring values share a bucket.
BUCKET_BITS = (13, 26, 39, 52)
# Significant bits of the first buckets, 32 between a value and its double: so few that a task
# counts all its rows by them in little memory.
FIRST_BITS = 6
# With more rows than this in all large groups, only rows in the middle buckets are counted by value.
COUNTED_ROWS = 1_000_000


def _midpoint(low: Column, high: Column) -> Column:
    return F.when(low == high, low).otherwise(low + (high - low) * 0.5)


def gathered_statistics(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, median, average) of values that are not NULL, put in order per group.

    One sort behind one shuffle and no aggregate: rows are hardly fewer than groups on most lanes,
    where gathering a group's values in an array costs more than its sort.
    """
    in_order = Window.partitionBy(*keys).orderBy(value)
    group = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rows.select(
        *keys,
        F.col(value).alias("_low"),
        F.lead(value).over(in_order).alias("_next"),
        F.row_number().over(in_order).alias("_place"),
        F.count(value).over(group).alias("_n"),
        F.sum(value).over(group).alias("_sum"),
    )
    high = F.when(F.col("_n") % 2 == 0, F.col("_next")).otherwise(F.col("_low"))
    return ranked.filter(F.col("_place") == F.expr("(_n + 1) div 2")).select(
        *keys,
        _midpoint(F.col("_low"), high).alias("median"),
        (F.col("_sum") / F.col("_n")).alias("average"),
    )


def packed_statistics(packs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, median, average) of groups whose values come in arrays, none of them NULL.

    Only for groups of a checked size. On such groups sorting a plain array is several
    times faster than the counting map behind ``F.median``.
    """
    gathered = packs.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list(value))).alias("values"))
    n = F.size("values")
    total = F.aggregate("values", F.lit(0.0), lambda a, b: a + b)
    return gathered.select(
        *keys,
        _midpoint(
            F.get("values", F.floor((n - 1) / 2)), F.get("values", F.floor(n / 2))
        ).alias("median"),
        (total / n).alias("average"),
    )


def _group_side(rows: DataFrame, groups: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """``groups`` with renamed keys, and the condition to join it; NULL is a value."""
    side = groups.withColumnsRenamed({key: f"r_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & rows[key].eqNullSafe(side[f"r_{key}"])
    return side, condition


def semi_join(rows: DataFrame, groups: DataFrame, keys: list[str], how: str) -> DataFrame:
    side, condition = _group_side(rows, groups.select(*keys), keys)
    return rows.join(side, condition, how)


def _middle(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """The buckets that hold their group's middle ranks, with the ranks ``below`` them."""
    upto = (
        Window.partitionBy(*keys)
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = buckets.withColumn("last", F.col("before") + F.sum("inside").over(upto))
    ranked = ranked.withColumn("below", F.col("last") - F.col("inside"))
    return ranked.filter(
        (F.col("below") < F.expr("total div 2 + 1")) & (F.col("last") >= F.expr("(total + 1) div 2"))
    )


def _in_range() -> Column:
    return (F.col("value") >= F.col("lowest")) & (F.col("value") <= F.col("highest"))


def _narrow(rows: DataFrame, keys: list[str], bits: int) -> tuple[DataFrame, int]:
    """Rows in the buckets that hold their group's middle ranks, and how many distinct
    values a group still has.

    Only counts per bucket are put in order, never values.
    """
    buckets = (
        rows.groupBy(*keys, value_bucket(F.col("value"), bits).alias("bucket"))
        .agg(
            F.sum("n").alias("inside"),
            F.count("*").alias("values"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
            F.max("before").alias("before"),
            F.max("total").alias("total"),
        )
    )
    ranges, seen = materialize_with(
        _middle(buckets, keys).groupBy(*keys).agg(
            F.min("lowest").alias("lowest"),
            F.max("highest").alias("highest"),
            F.min("below").alias("below"),
            F.sum("values").alias("values"),
        ),
        "middle-ranges",
        most=F.max("values"),
    )
    side, condition = _group_side(rows, ranges, keys)
    left = rows.join(side, condition & _in_range())
    kept = left.select(*keys, "value", "n", "total", F.col("below").alias("before"))
    return kept, seen.get("most") or 0


def _first_ranges(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """(keys, lowest, highest, before, total, average): the range around each group's middle, and
    the number of rows of all groups.

    Rows are counted and added up by coarse buckets, map-side first, so what is shuffled
    depends on the groups and not on their rows.
    """
    buckets = rows.groupBy(*keys, value_bucket(F.col("value"), FIRST_BITS).alias("bucket")).agg(
        F.count("*").alias("inside"),
        F.sum("value").alias("amount"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )
    group = Window.partitionBy(*keys)
    totals = buckets.withColumns(
        {
            "before": F.lit(0).cast("bigint"),
            "total": F.sum("inside").over(group),
            "average": F.sum("amount").over(group) / F.sum("inside").over(group),
        }
    )
    ranges, seen = materialize_with(
        _middle(totals, keys).groupBy(*keys).agg(
            F.min("lowest").alias("lowest"),
            F.max("highest").alias("highest"),
            F.min("below").alias("before"),
            F.max("total").alias("total"),
            F.max("average").alias("average"),
        ),
        "first-ranges",
        rows=F.sum("total"),
    )
    return ranges, seen.get("rows") or 0


def _read_middle(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Median of each group from its values in order, counted on from ``before``."""
    upto = (
        Window.partitionBy(*keys)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = rows.withColumn("last", F.col("before") + F.sum("n").over(upto))

    def value_at(rank: str) -> Column:
        holds = (F.col("last") - F.col("n") < F.expr(rank)) & (F.expr(rank) <= F.col("last"))
        return F.max(F.when(holds, F.col("value")))

    picked = ranked.groupBy(*keys).agg(
        value_at("(total + 1) div 2").alias("low"),
        value_at("total div 2 + 1").alias("high"),
    )
    return picked.select(*keys, _midpoint(F.col("low"), F.col("high")).alias("median"))


def narrowed_statistics(
    rows: DataFrame, keys: list[str], value: str, ordered_values: int = ORDERED_VALUES
) -> DataFrame:
    """(keys, median, average) of groups of any size, whose values are not NULL.

    1. Rows are counted by coarse buckets, where each group has few. Of many rows, only those
       in the buckets with the middle ranks go on; the others are never shuffled.
    2. Equal values are counted, map-side first; the shuffle is on (group, value), so a
       crowded group spreads over all tasks.
    3. Where a group has many values left, they are counted by bucket, the buckets with the
       middle ranks are kept, and finer buckets follow until what is left is small.
    4. What is left is put in order and read at the middle ranks.
    """
    rows = rows.select(*keys, F.col(value).alias("value"))
    ranges, found = _first_ranges(rows, keys)
    side, condition = _group_side(rows, ranges, keys)
    before = F.lit(0).cast("bigint")
    if found > COUNTED_ROWS:
        condition, before = condition & _in_range(), F.col("before")
    counted = materialize(
        rows.join(side, condition)
        .groupBy(*keys, "value")
        .agg(
            F.count("*").alias("n"), F.max("total").alias("total"), F.max(before).alias("before")
        ),
        "counted-values",
    )
    _, seen = materialize_with(
        counted.groupBy(*keys).agg(F.count("*").alias("values")),
        "group-values",
        most=F.max("values"),
    )
    left, most = counted, seen.get("most") or 0
    for bits in BUCKET_BITS:
        if most <= ordered_values:
            break
        left, most = _narrow(left, keys, bits)
    medians = _read_middle(left, keys)
    side, condition = _group_side(medians, ranges.select(*keys, "average"), keys)
    return medians.join(side, condition).select(*keys, "median", "average")


def group_sizes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows) of every group; nothing but the keys is shuffled, map-side first."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"))


def large_groups(sizes: DataFrame, ordered_values: int = ORDERED_VALUES) -> DataFrame | None:
    """The groups of ``sizes`` (columns that groups agree in, and ``rows``) with more rows than a
    task gathers, written; None if there are none."""
    crowded, seen = materialize_with(
        sizes.filter(F.col("rows") > ordered_values).drop("rows"),
        "crowded-groups",
        any=F.max(F.lit(1)),
    )
    return crowded if seen.get("any") else None


def statistics(
    rows: DataFrame,
    keys: list[str],
    value: str,
    ordered_values: int = ORDERED_VALUES,
    find_large: Callable[[], DataFrame | None] | None = None,
    packed: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """(keys, median, average) of the values that are not NULL, per group.

    Groups of at most ``ordered_values`` rows are gathered, one shuffle for all of them. Larger
    groups take no part in it; they are narrowed in tables of their own. The average is
    the sum over the number of rows, for every group.

    ``find_large`` gives the ``large_groups``, by columns of ``rows`` that groups agree in, from
    sizes that are no smaller than the groups; without it, rows are counted.

    ``packed`` has further groups, none of ``rows``: their values in arrays of ``value``, without
    what is in large groups only, and the rows those arrays are made of.
    """
    usable = rows.filter(F.col(value).isNotNull())
    if find_large is None:
        crowded = large_groups(group_sizes(usable, keys), ordered_values)
    else:
        crowded = find_large()
    small = usable if crowded is None else semi_join(usable, crowded, crowded.columns, "left_anti")
    found = gathered_statistics(small, keys, value)
    if packed is not None:
        packs, parts = packed
        if crowded is not None:
            packs = semi_join(packs, crowded, crowded.columns, "left_anti")
            usable = usable.unionByName(parts.select(*usable.columns).filter(F.col(value).isNotNull()))
        found = found.unionByName(packed_statistics(packs, keys, value))
    if crowded is None:
        return found
    large = semi_join(usable, crowded, crowded.columns, "left_semi")
    narrowed = materialize(narrowed_statistics(large, keys, value, ordered_values), "large-medians")
    return found.unionByName(narrowed)
