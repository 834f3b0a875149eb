"""Money expressions: conversion, rounding, the quality flag, value buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coverage a price needs before customers see it.
MIN_SUPPLIERS = 2
MIN_COMPANIES = 5


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round the scaled double.

    ``F.round(x, 2)`` rounds the decimal text of x, so 1.005 gives 1.01 although
    the double lies below the edge; scaling first gives 1.0.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def convert(amount: Column, rate: Column) -> Column:
    """Amount in the base currency; NULL for a missing or a zero rate."""
    return F.try_divide(amount, rate)


def quality_flag(
    suppliers: Column,
    companies: Column,
    min_suppliers: int = MIN_SUPPLIERS,
    min_companies: int = MIN_COMPANIES,
) -> Column:
    enough = (suppliers >= min_suppliers) & (companies >= min_companies)
    return F.when(enough, 1).otherwise(0).cast("int")


def value_bucket(value: Column, bits: int = 13) -> Column:
    """``value`` rounded to ``bits`` significant bits, 52 at most.

    Splitting with a factor 2^(53 - bits) + 1 is plain IEEE arithmetic, so the bucket is
    monotone in the value and the same on every machine. Values too large to scale,
    infinities and nan are their own bucket.
    """
    scaled = value * F.lit(float(2 ** (53 - bits) + 1))
    return F.when(F.abs(value) < F.lit(1e290), scaled - (scaled - value)).otherwise(value)
