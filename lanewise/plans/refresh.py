"""Marts that follow the staged batches: only the days that batches touch are priced again.

A day of a mart depends on the datapoints that are valid on it, on their charges, on the
rates of that day, on their ports, and on all regions. So a batch touches

* the days of its datapoints and of the versions that they replace,
* the days of datapoints that it brings charges or ports for,
* the days of its rates, and
* with any region, every day.

The touched days, a few stretches, are all that comes to the driver. The mart is built for them
alone and replaces their partitions; the others are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.operators.intervals import Stretches, merge_intervals
from lanewise.session import delete_folder, intermediates, materialize
from lanewise.sources.storage import names
from lanewise.sources.tables import LOG, MARTS, Warehouse

NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def touched_days(warehouse: Warehouse, after: int, to: int) -> Stretches | None:
    """Days that the batches after one, up to another, touch; None for every day."""

    def since(table: str) -> DataFrame:
        return warehouse.staged_since(table, after, to)

    before, now = warehouse.datapoints_as_of(after), warehouse.datapoints_as_of(to)
    if before is None or now is None or not since("regions").isEmpty():
        return None
    ids = since("datapoints").select("d_id")
    charged = since("charges").select("d_id")
    ports = since("ports").select("pid")
    ends = F.array_distinct(F.array("origin_pid", "destination_pid"))
    moved = (
        now.select("d_id", F.explode(ends).alias("pid")).join(ports, "pid", "left_semi").select("d_id")
    )
    rows = [
        before.join(ids, "d_id", "left_semi"),
        now.join(ids.unionByName(charged).unionByName(moved), "d_id", "left_semi"),
    ]
    day = F.col("day")
    spans = since("exchange_rates").select(day.alias("valid_from"), day.alias("valid_to"))
    for more in rows:
        spans = spans.unionByName(more.select("valid_from", "valid_to"))
    return [(r.valid_from, r.valid_to) for r in merge_intervals(spans, []).collect()]


def _as_of(warehouse: Warehouse, path: str) -> int | None:
    """The batch that a mart was last written for."""
    for batch in reversed(warehouse._logged(MARTS)):
        if any(r.path == path for r in warehouse.entries(MARTS, batch)):
            return batch
    return None


def _note(warehouse: Warehouse, path: str, batch: int) -> None:
    """Move a mart to a batch; entries of batches without a mart go."""
    others = {b: {r.path for r in warehouse.entries(MARTS, b)} for b in warehouse._logged(MARTS)}
    warehouse.log(MARTS, [(p,) for p in sorted(others.get(batch, set()) | {path})], batch)
    for old, paths in others.items():
        if old == batch or path not in paths:
            continue
        if paths - {path}:
            warehouse.log(MARTS, [(p,) for p in sorted(paths - {path})], old)
        else:
            delete_folder(warehouse.spark, f"{warehouse.path(LOG, MARTS)}/batch_id={old}")


def refresh(warehouse: Warehouse, build: Callable[..., DataFrame], path: str) -> Stretches | None:
    """Bring the mart at ``path`` up to the last finished batch.

    ``build`` is a function of ``marts``: it takes the staging tables and ``days``. Returns the
    days written, None for all. A refresh that died half way is repeated by the next one.
    """
    spark = warehouse.spark
    to, after = warehouse.done(), _as_of(warehouse, path)
    if after == to:
        return []
    days = None if after is None else touched_days(warehouse, after, to)
    with intermediates(spark):
        if days is None:
            build(warehouse.tables()).write.mode("overwrite").partitionBy("date").parquet(path)
        elif days:
            mart = materialize(build(warehouse.tables(), days=days), "touched-days")
            (
                mart.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("date")
                .parquet(path)
            )
            # Days that no longer have a row; no more of them than days of the calendar.
            left = {NO_DATE if r.date is None else r.date.isoformat()
                    for r in mart.select("date").distinct().collect()}
            for name in names(spark, path):
                day = name.removeprefix("date=")
                if name != day and day not in left and _within(day, days):
                    delete_folder(spark, f"{path}/{name}")
    _note(warehouse, path, to)
    return days


def _within(day: str, days: Stretches) -> bool:
    if day == NO_DATE:
        return any(first is None for first, _ in days)
    return any(a is not None and a.isoformat() <= day <= b.isoformat() for a, b in days)
