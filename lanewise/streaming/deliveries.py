"""File stream: deliveries in a folder -> raw tables -> staging tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lanewise.operators.validate import outcomes
from lanewise.schemas import TABLES
from lanewise.sources import routing
from lanewise.sources.csv_files import (
    Delivery,
    file_blocks,
    look_into,
    missing_columns,
    read_deliveries,
)
from lanewise.sources.storage import exists, move_into
from lanewise.sources.tables import LOADS, RAW, STAGED, STAGING, UNROUTED, Warehouse

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
NO_TABLE = "no table"


def load_batch(
    warehouse: Warehouse,
    files: DataFrame,
    batch_id: int,
    archive: str | None = None,
    rejected: str | None = None,
    **csv: object,
) -> None:
    """Append one batch of files to the raw tables, in the order of their arrival.

    Only paths and header lines come to the driver; their number is bounded by the stream's
    ``maxFilesPerTrigger``. Files that belong nowhere, cannot be
    read or lack a column are reported in the log and the rest of the batch loads. The
    log entry of the load comes last; a batch that has one is not loaded again. After
    that, loaded files move to ``archive`` and files that a table should have had move to
    ``rejected``; files of no table stay where they are.
    """
    spark = files.sparkSession
    table_of = routing.route(routing.base_name(F.col("path")))
    arrival = [F.col(c) for c in ("modificationTime", "path") if c in files.columns]
    in_order = files.orderBy(*arrival).select("path", table_of.alias("table")).collect()
    # A file stream names a file more than once if other names read as patterns match it.
    routed = list(dict.fromkeys(in_order))
    if not warehouse.has_loaded(batch_id):
        _load(warehouse, [(r.path, r.table) for r in routed], batch_id, **csv)
    refused = {r.path for r in warehouse.entries(UNROUTED, batch_id)}

    def move(row) -> None:
        folder = rejected if row.path in refused else archive
        if folder and row.table != routing.UNROUTED:
            move_into(spark, row.path, f"{folder.rstrip('/')}/batch_id={batch_id}")

    _for_each(move, routed)


def _for_each(act, items: list) -> list:
    """Small requests to the store, several at a time."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(act, items))


def _load(warehouse: Warehouse, routed: list[tuple[str, str]], batch_id: int, **csv: object) -> None:
    """The files of each table are looked into and read together, whatever their number."""
    spark = warehouse.spark
    report = [(path, NO_TABLE) for path, table in routed if table == routing.UNROUTED]
    known = [(rank, path, table) for rank, (path, table) in enumerate(routed) if table != routing.UNROUTED]
    there = dict(_for_each(lambda f: (f[1], exists(spark, f[1])), known))
    key, loads = warehouse.next_key(batch_id), []
    for table in TABLES:
        files = [(rank, path) for rank, path, routed_to in known if routed_to == table]
        report += [(path, "not readable") for _, path in files if not there[path]]
        files = [(rank, path) for rank, path in files if there[path]]
        if not files:
            continue
        paths = [path for _, path in files]
        blocks = file_blocks(spark, paths, csv.get("encoding"))
        looks = look_into(spark, paths, blocks, **csv)
        deliveries = []
        for rank, path in files:
            header, broken = looks.get(path, ((), False))
            missing = missing_columns(header, table)
            if missing:
                report.append((path, "missing " + ",".join(missing) if header else "not readable"))
            else:
                deliveries.append(Delivery(path, header, rank, broken))
        if deliveries:
            rows, after = read_deliveries(spark, table, deliveries, blocks, paths, key, **csv)
            _write_raw(warehouse, rows, table, batch_id, after)
            key = after
            loads.append((table, key))
    warehouse.log(UNROUTED, report, batch_id)
    warehouse.log(LOADS, loads, batch_id)


def _write_raw(
    warehouse: Warehouse, rows: DataFrame, table: str, batch_id: int, next_key: int
) -> None:
    """Write the rows; the last one counted must be among them."""
    seen = Observation()
    last = F.max("raw_pid").alias("last")
    warehouse.write(rows.observe(seen, last), RAW, table, batch_id)
    last_key = seen.get.get("last")
    if last_key is not None and last_key != next_key - 1:
        raise RuntimeError(f"{table}: files of batch {batch_id} changed while they were read")


def start_loading(
    spark: SparkSession,
    inbox: str,
    warehouse: Warehouse,
    checkpoint: str,
    archive: str | None = None,
    rejected: str | None = None,
    max_files: int = 1000,
    **csv: object,
) -> StreamingQuery:
    """Load what has arrived in ``inbox`` and stop; each path is loaded once.

    The stream carries paths only. ``checkpoint`` remembers paths, so a second delivery,
    or a rejected file after its repair, needs a new name. ``archive`` and ``rejected``
    lie outside the inbox.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
    )
    paths = reader.load(inbox).select("path", "modificationTime")
    return (
        paths.writeStream.foreachBatch(
            lambda files, batch_id: load_batch(
                warehouse, files, batch_id, archive, rejected, **csv
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stage_batch(warehouse: Warehouse, table: str, batch_id: int) -> None:
    """Validate and type one raw batch; one scan, no shuffle. Datapoints then bring the
    active versions up to this batch."""
    raw = warehouse.read(RAW, table).filter(F.col("batch_id") == batch_id)
    warehouse.write(outcomes(raw, table), STAGING, table, batch_id)
    if table == "datapoints":
        warehouse.advance_active(batch_id)


def stage_pending(warehouse: Warehouse) -> None:
    """Stage every batch that has been loaded but not staged.

    The log entry comes last, so an interrupted batch is staged again into the same
    folders. Then one row stands for all batches up to this one, and what they no longer need
    is deleted.
    """
    for batch_id, members in groupby(warehouse.pending_batches(), key=lambda pair: pair[0]):
        tables = [table for _, table in members]
        for table in tables:
            stage_batch(warehouse, table, batch_id)
        warehouse.log(STAGED, [(table,) for table in tables], batch_id)
        warehouse.set_done(batch_id)
        warehouse.drop_old_active()
