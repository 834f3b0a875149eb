"""Daily cost of each datapoint in the base currency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.numeric import convert
from lanewise.session import broadcast_limit, materialize

DATAPOINT_KEYS = ["d_id", "origin_pid", "destination_pid", "company_id", "supplier_id", "equipment_id"]


def charge_totals(charges: DataFrame) -> DataFrame:
    """One amount per (d_id, currency).

    The rate depends only on currency and day, so charges may be added up before
    conversion. This runs map-side first: a datapoint holding a large part of all
    charges reaches the join as one row per currency.
    """
    return charges.groupBy("d_id", "currency").agg(F.sum("charge_value").alias("amount"))


def rate_lookup(rates: DataFrame) -> DataFrame:
    """One row per (currency, date), so that the rate join never multiplies rows.

    Copies of a rate count once each: amount / r1 + amount / r2 = amount * (1/r1 + 1/r2).
    A day with a single rate keeps it for a plain division.
    """
    usable = rates.filter(F.col("rate").isNotNull() & (F.col("rate") != 0))
    return usable.groupBy("currency", F.col("day").alias("date")).agg(
        F.when(F.count("*") == 1, F.max("rate")).alias("rate"),
        F.sum(F.lit(1.0) / F.col("rate")).alias("inverse"),
    )


def join_charges(days: DataFrame, charges: DataFrame) -> DataFrame:
    """Every charge of every datapoint-day; days without a charge are kept."""
    return days.join(charges, "d_id", "left")


def join_rates(charged: DataFrame, rates: DataFrame) -> DataFrame:
    """Exact-day rate lookup; a charge without a rate is kept with NULL.

    No hint: Catalyst broadcasts the rates while their files are under the
    broadcast limit and sorts otherwise, where AQE splits a crowded currency.
    """
    rates = rates.withColumnRenamed("day", "date") if "day" in rates.columns else rates
    return charged.join(rates, ["currency", "date"], "left")


def join_ports(datapoints: DataFrame, ports: DataFrame, *columns: str) -> DataFrame:
    """Attach ``origin_<column>`` and ``destination_<column>`` from the two ports."""
    out = datapoints
    for end in ("origin", "destination"):
        side = ports.select(
            F.col("pid").alias(f"{end}_pid"), *[F.col(c).alias(f"{end}_{c}") for c in columns]
        )
        out = out.join(side, f"{end}_pid", "left")
    return out


# Bytes of one row of ``rate_months`` in memory, 31 days being the most it holds.
RATE_MONTH_BYTES = 31 * 64 + 256


def rate_months(rates: DataFrame) -> DataFrame:
    """(currency, month, rates): a month's rates by day of the month."""
    day = F.struct(
        F.dayofmonth("date").alias("day"), F.struct("rate", "inverse").alias("found")
    )
    return (
        rate_lookup(rates)
        .filter(F.col("currency").isNotNull() & F.col("date").isNotNull())
        .groupBy("currency", F.trunc("date", "month").alias("month"))
        .agg(F.map_from_entries(F.collect_list(day)).alias("rates"))
    )


def _terms() -> Column:
    """(date, term) of the days that a row's interval has in its month."""
    first = F.greatest("valid_from", "month")
    last = F.least("last_day", F.last_day("month"))

    def term(day: Column) -> Column:
        found = F.try_element_at("rates", F.dayofmonth(day))
        return F.coalesce(
            convert(F.col("amount"), found["rate"]), F.col("amount") * found["inverse"]
        )

    return F.transform(
        F.sequence(first, last, F.expr("interval 1 day")),
        lambda day: F.struct(day.alias("date"), term(day).alias("term")),
    )


def datapoint_costs(
    datapoints: DataFrame,
    charges: DataFrame,
    rates: DataFrame,
    keep_unpriced: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """(datapoint keys, date, cost), one row per active datapoint and day.

    Charges meet the datapoints before anything is expanded. Intervals become months, months
    meet the rates of their currency, and days are made last, behind every shuffle: rates
    small enough are broadcast, so rows stay in their d_id partition; others are joined
    by (currency, month), and the months, not the days, go back to their d_id.

    Expects one active version per d_id. ``keep_unpriced=False`` drops days that end
    up without any cost, since medians and averages skip those. ``tasks`` deals the datapoints
    to that many tasks, where partitions by bytes would make too many days in one.
    """
    how = "left" if keep_unpriced else "inner"
    last_day = F.greatest("valid_from", F.coalesce("valid_to", "valid_from"))
    keyed = datapoints.select(*DATAPOINT_KEYS, "valid_from", last_day.alias("last_day"))
    totals = charge_totals(charges)
    if not keep_unpriced:
        totals = totals.filter(F.col("amount").isNotNull())
    if tasks is not None:
        keyed, totals = keyed.repartition(tasks, "d_id"), totals.repartition(tasks, "d_id")
    months = F.sequence(
        F.trunc("valid_from", "month"), F.trunc("last_day", "month"), F.expr("interval 1 month")
    )
    monthly = keyed.join(totals, "d_id", how).withColumn("month", F.explode_outer(months))
    by_month = materialize(rate_months(rates), "rate-months")
    small = by_month.count() * RATE_MONTH_BYTES <= broadcast_limit(by_month.sparkSession)
    side = F.broadcast(by_month) if small else by_month.hint("merge")
    rated = monthly.join(side, ["currency", "month"], "left").select(
        *DATAPOINT_KEYS, _terms().alias("terms")
    )
    if not small:
        rated = rated.repartition("d_id") if tasks is None else rated.repartition(tasks, "d_id")
    days = rated.select(*DATAPOINT_KEYS, F.explode_outer("terms").alias("day"))
    costs = days.groupBy(*DATAPOINT_KEYS, F.col("day.date").alias("date")).agg(
        F.sum("day.term").alias("cost")
    )
    return costs if keep_unpriced else costs.filter(F.col("cost").isNotNull())
