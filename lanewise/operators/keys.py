"""Surrogate keys that increase in load order, given out in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.session import materialize


def part_starts(parts: DataFrame, *order: str, first: int = 0) -> DataFrame:
    """Add ``start`` to a table of parts with their number of ``rows``: the key of each part's
    first row, parts following each other in the given order.

    One row per part, such as a file block or a partition, is all that is ever in one place.
    """
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    return parts.withColumn("start", (before + first).cast("bigint"))


def with_keys(rows: DataFrame) -> DataFrame:
    """Rows with ``raw_pid``, the key of their part's ``start`` and their place in the part.

    ``_row`` counts the ``rows`` of a part without gaps from the part's ``base`` on. A row
    of a part that is not known, or beyond the part's rows, is an error: it was not
    there when the parts were counted.
    """
    place = F.col("_row") - F.col("base")
    known = (place >= 0) & (place < F.col("rows"))
    key = F.when(known, F.col("start") + place).otherwise(
        F.raise_error(F.lit("rows changed since they were counted"))
    )
    return rows.withColumn("raw_pid", key.cast("bigint")).drop("_row", "base", "rows", "start")


def dense_keys(df: DataFrame, *order: str, first: int = 1) -> DataFrame:
    """Add ``raw_pid`` = first, first + 1, ... in the given order, without gaps.

    Rows are range-partitioned and numbered within their partition; a running count
    over the partitions gives each its start. Rows with equal order values may be cut apart
    too, in any order among themselves, so a frequent value does not fill one
    partition. The numbered rows are written before they are read twice, since a
    repeated range partitioning may cut elsewhere.
    """
    position = F.monotonically_increasing_id()
    local = materialize(
        df.withColumn("_tie", position)
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .withColumns({"_part": F.spark_partition_id(), "_row": position})
        .drop("_tie"),
        "ordered-rows",
    )
    parts = local.groupBy("_part").agg(F.count("*").alias("rows"), F.min("_row").alias("base"))
    return with_keys(local.join(part_starts(parts, "_part", first=first), "_part")).drop("_part")
