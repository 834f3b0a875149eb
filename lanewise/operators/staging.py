"""Row state and versions on top of immutable raw and staging rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.schemas import NEW, columns


def pending(raw: DataFrame, table: str) -> DataFrame:
    """Rows not yet tried, with their business columns and key."""
    return raw.filter(F.col("stg_status") == NEW).select(*columns(table), "raw_pid")


def load_position(
    raw_pid: str = "raw_pid", file_rank: str = "file_rank", batch_id: str = "batch_id"
) -> Column:
    """Place of a row in load order, by batch, then file, then row, as one number.

    A decimal, because its maximum is kept in a hash aggregate's buffer, unlike that of
    a struct: 43 bits of batches, 20 bits of files, 63 bits of keys.
    """
    file = F.col(batch_id) * (1 << 20) + F.coalesce(F.col(file_rank), F.lit(0))
    return (
        file.cast("decimal(19,0)") * F.lit(Decimal(10**19))
        + F.col(raw_pid).cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def current_state(untried: DataFrame, outcome: DataFrame, table: str) -> DataFrame:
    """Raw rows in their current state: those of batches not yet tried as they were loaded,
    those of tried batches as staging has written them. No row is joined to its status.
    """
    audit = [c for c in untried.columns if c not in columns(table)]
    tried = outcome.select("delivered.*", *audit)
    return untried.select(*columns(table), *audit).unionByName(tried)


def versions(accepted: DataFrame) -> DataFrame:
    """Accepted datapoints with ``is_active``: the last row loaded per d_id.

    Load order decides, not ``created``. Ranking in a window would sort all versions
    of a d_id in one task; the last one is found map-side instead and joined back on its
    raw_pid, which is unique.
    """
    latest = accepted.groupBy("d_id").agg(F.max_by("raw_pid", load_position()).alias("raw_pid"))
    active = latest.select("raw_pid", F.lit(True).alias("is_active"))
    return accepted.join(active, "raw_pid", "left").withColumn(
        "is_active", F.coalesce("is_active", F.lit(False))
    )


def current(accepted: DataFrame) -> DataFrame:
    """Only the active version of each d_id, as the marts need it.

    Every column is kept next to its row's load position while reducing, so there is no join,
    and as all have a fixed width the reduction hashes, map-side first, and never sorts.
    """
    rest = [c for c in accepted.columns if c != "d_id"]
    return (
        accepted.withColumn("_position", load_position())
        .groupBy("d_id")
        .agg(*[F.max_by(c, "_position").alias(c) for c in rest])
        .withColumn("is_active", F.lit(True))
    )


def bucket_of(buckets: int) -> Column:
    """The bucket of a datapoint's active version."""
    return F.pmod(F.xxhash64("d_id"), F.lit(buckets)).cast("int")


def advance(active: DataFrame, batch: DataFrame, columns: list[str]) -> DataFrame:
    """Active versions after one more batch of accepted rows.

    The batch was loaded after everything before it, so its own last rows are active and
    other d_ids keep theirs; no earlier version is ranked again.
    """
    latest = current(batch).select(*columns)
    return active.select(*columns).join(latest, "d_id", "left_anti").unionByName(latest)
