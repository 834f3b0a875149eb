"""Validity intervals to one row per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active(datapoints: DataFrame) -> DataFrame:
    return datapoints.filter(F.col("is_active"))


def clip(
    datapoints: DataFrame, date_from: dt.date | None = None, date_to: dt.date | None = None
) -> DataFrame:
    """Bound the interval before it is expanded.

    ``date`` comes out of a generator, so Catalyst cannot move a filter on it
    below the expansion. Clipping keeps days outside the range from ever being
    made, and its comparisons reach the parquet scan.
    """
    first_day = F.col("valid_from")
    last_day = F.greatest("valid_from", F.coalesce("valid_to", "valid_from"))
    clipped = datapoints
    if date_from is not None:
        start = F.lit(date_from)
        clipped = clipped.filter(
            F.col("valid_from").isNotNull()
            & ((F.col("valid_from") >= start) | (F.col("valid_to") >= start))
        )
        first_day = F.greatest(first_day, start)
    if date_to is not None:
        end = F.lit(date_to)
        clipped = clipped.filter(F.col("valid_from") <= end)
        last_day = F.least(last_day, end)
    return clipped.withColumns({"valid_from": first_day, "valid_to": last_day})


# Days as stretches (first, last), both included; (None, None) stands for rows without a day.
Stretches = list[tuple[dt.date | None, dt.date | None]]


def clip_to(datapoints: DataFrame, days: Stretches) -> DataFrame:
    """Only the days in ``days``: a datapoint becomes one row per stretch that it touches.

    Stretches are few, at most one for two days of the calendar, and do not overlap.
    """
    dated = [(first, last) for first, last in days if first is not None]
    if dated:
        spans = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in dated])
        met = F.filter(
            spans, lambda s: (s["first"] <= last_day()) & (s["last"] >= F.col("valid_from"))
        )
        bounds = (min(a for a, _ in dated), max(b for _, b in dated))
        pieces = (
            clip(datapoints, *bounds)
            .withColumn("_span", F.explode(met))
            .withColumns(
                {
                    "valid_from": F.greatest("valid_from", F.col("_span.first")),
                    "valid_to": F.least("valid_to", F.col("_span.last")),
                }
            )
            .drop("_span")
        )
    else:
        pieces = datapoints.filter(F.lit(False))
    if len(dated) < len(days):
        pieces = pieces.unionByName(datapoints.filter(F.col("valid_from").isNull()))
    return pieces


def last_day() -> Column:
    """Last day that ``expand_days`` makes of an interval; NULL if it has no start."""
    end = F.greatest("valid_from", F.coalesce("valid_to", "valid_from"))
    return F.when(F.col("valid_from").isNotNull(), end)


def longest_intervals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, valid_from, valid_to): the longest interval per key and first day, map-side first.

    Has the same days as ``rows``, in no more rows per key than there are days.
    """
    return rows.groupBy(*keys, "valid_from").agg(F.max(last_day()).alias("valid_to"))


def first_new_day(keys: list[str]) -> Column:
    """The first day of an interval that no earlier interval of its key has; behind ``valid_to`` if
    it has none, NULL without a start."""
    earlier = Window.partitionBy(*keys).orderBy("valid_from")
    before = F.max("valid_to").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    return F.greatest("valid_from", F.date_add(before, 1))


def disjoint_intervals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, valid_from, valid_to): the days of all intervals of a key, each in one interval, as
    ``merge_intervals`` has them; but neighbouring intervals stay apart, which spares a pass.

    An interval begins behind the days of those that began before it, or is left out.
    """
    cut = longest_intervals(rows, keys).withColumn("valid_from", first_new_day(keys))
    return cut.filter(F.col("valid_from").isNull() | (F.col("valid_from") <= F.col("valid_to")))


def merge_intervals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, valid_from, valid_to): the days of all intervals of a key, each in one interval.

    Gives the days that ``expand_days`` gives, once each; intervals without a start become
    one such interval. What is put in order per key is bounded by the days there are,
    whatever the rows.
    """
    longest = longest_intervals(rows, keys)
    in_order = Window.partitionBy(*keys).orderBy("valid_from")
    before = F.max("valid_to").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("valid_from") > F.date_add(before, 1))
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = longest.withColumn("_opens", opens.cast("int")).withColumn(
        "_island", F.sum("_opens").over(upto)
    )
    return (
        islands.groupBy(*keys, "_island")
        .agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
        .drop("_island")
    )


def expand_days(datapoints: DataFrame) -> DataFrame:
    """Replace (valid_from, valid_to) by ``date``, both ends included.

    A reversed interval or a missing end still gives its first day; a missing
    start gives one row without a date. Each row expands on its own, with no
    shuffle and no recursion limit.
    """
    end = F.greatest("valid_from", F.coalesce("valid_to", "valid_from"))
    days = F.explode_outer(F.sequence("valid_from", end, F.expr("interval 1 day")))
    return datapoints.select(
        *[c for c in datapoints.columns if c not in ("valid_from", "valid_to")],
        days.alias("date"),
    )
