"""Parquet tables of the warehouse: raw rows, staging rows, active versions and the load log.

Every load writes one ``batch_id=<n>`` folder and replaces it when the load is
repeated, so a batch that died half way leaves nothing behind after its retry.
Staging keeps accepted and rejected rows, with their own text, in ``stg_status=`` folders of
one table; typed rows, quarantine and the state of raw rows are selections of it. Readers
see the batches that the log names and no others, so an unfinished batch is invisible.

The log is bounded: once all batches up to some batch are staged, one row says so and the
entries of those batches go. Batches are loaded and staged in their order.

The active versions of the datapoints lie in buckets by ``d_id``. A batch writes the buckets that
it touches, and a list that says for every bucket which batch wrote it last; buckets it does not
touch are neither read nor written. The lists of the last two staged batches are kept, so
that a reader may still be using the one before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.operators.staging import advance, bucket_of, current_state, versions
from lanewise.operators.validate import accepted, rejected
from lanewise.plans.marts import Staging
from lanewise.schemas import FILE_RANK, TABLES, outcome_schema, raw_schema, staging_schema
from lanewise.session import delete_folder
from lanewise.sources.storage import exists, names

RAW, STAGING, LOG, ACTIVE = "raw", "staging", "log", "active"

# The log has one small row per batch and table, so that finding pending batches
# or the next key never touches the data.
LOADS, STAGED, UNROUTED, DONE, BUCKETS = "loads", "staged", "unrouted", "done", "buckets"
MARTS = "marts"
LOG_SCHEMAS = {
    LOADS: T.StructType(
        [T.StructField("table_name", T.StringType()), T.StructField("next_key", T.LongType())]
    ),
    STAGED: T.StructType([T.StructField("table_name", T.StringType())]),
    UNROUTED: T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("reason", T.StringType())]
    ),
    # Everything up to this batch is loaded and staged, with keys below ``next_key``.
    DONE: T.StructType([T.StructField("next_key", T.LongType())]),
    # The batch that wrote each bucket of active versions last, -1 for none.
    BUCKETS: T.StructType(
        [T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())]
    ),
    # Marts written as of this batch.
    MARTS: T.StructType([T.StructField("path", T.StringType())]),
}
NO_BATCH = -1


class Warehouse:
    """Tables below one base path, read and written through a session."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def schema(self, layer: str, table: str) -> T.StructType:
        if layer == RAW:
            return raw_schema(table)
        if layer == STAGING:
            return outcome_schema(table)
        if layer == ACTIVE:
            return T.StructType(
                [
                    *staging_schema(table).fields,
                    FILE_RANK,
                    T.StructField("is_active", T.BooleanType()),
                ]
            )
        return LOG_SCHEMAS[table]

    def path(self, layer: str, table: str) -> str:
        return f"{self.base}/{layer}/{table}"

    def create(self, buckets: int = 64) -> Warehouse:
        """Declare every table by writing an empty batch. ``buckets`` of active versions should
        be so many that a batch of usual size rewrites few, and so few that each fills files."""
        tables = [(layer, t) for layer in (RAW, STAGING) for t in TABLES]
        for layer, table in [*tables, (LOG, LOADS), (LOG, STAGED), (LOG, UNROUTED)]:
            empty = self.spark.createDataFrame([], self.schema(layer, table))
            self.write(empty, layer, table, NO_BATCH)
        self.log(DONE, [(0,)], NO_BATCH)
        self.log(BUCKETS, [(bucket, NO_BATCH) for bucket in range(buckets)], NO_BATCH)
        return self

    def write(self, df: DataFrame, layer: str, table: str, batch_id: int) -> None:
        declared = self.schema(layer, table).fieldNames()
        writer = df.select(*declared).write.mode("overwrite")
        if layer == STAGING:
            writer = writer.partitionBy("stg_status")
        writer.parquet(f"{self.path(layer, table)}/batch_id={batch_id}")

    def _all(self, layer: str, table: str) -> DataFrame:
        """All batches, finished or not, with their ``batch_id``."""
        batch = T.StructField("batch_id", T.LongType())
        declared = T.StructType([*self.schema(layer, table).fields, batch])
        return self.spark.read.schema(declared).parquet(self.path(layer, table))

    # The log

    def log(self, name: str, entries: list[tuple], batch_id: int) -> None:
        entry_frame = self.spark.createDataFrame(entries, self.schema(LOG, name)).coalesce(1)
        self.write(entry_frame, LOG, name, batch_id)

    def has_log(self, name: str, batch_id: int) -> bool:
        return exists(self.spark, f"{self.path(LOG, name)}/batch_id={batch_id}/_SUCCESS")

    def entries(self, name: str, batch_id: int) -> list:
        if not self.has_log(name, batch_id):
            return []
        folder = f"{self.path(LOG, name)}/batch_id={batch_id}"
        return self.spark.read.schema(self.schema(LOG, name)).parquet(folder).collect()

    def _logged(self, name: str) -> list[int]:
        """Batches with an entry, oldest first; of loads and stagings, those not done yet."""
        folders = names(self.spark, self.path(LOG, name))
        found = [int(f.removeprefix("batch_id=")) for f in folders if f.startswith("batch_id=")]
        return sorted(b for b in found if self.has_log(name, b))

    def done(self) -> int:
        """All batches up to this one are loaded and staged."""
        return self._logged(DONE)[-1]

    def has_loaded(self, batch_id: int) -> bool:
        return batch_id <= self.done() or self.has_log(LOADS, batch_id)

    def _open_entries(self, name: str) -> list[tuple[int, T.Row]]:
        done = self.done()
        return [(b, r) for b in self._logged(name) if b > done for r in self.entries(name, b)]

    def pending_batches(self) -> list[tuple[int, str]]:
        """(batch, table) loaded but not yet staged, oldest first."""
        loaded = {(b, r.table_name) for b, r in self._open_entries(LOADS)}
        staged = {(b, r.table_name) for b, r in self._open_entries(STAGED)}
        return sorted(loaded - staged)

    def next_key(self, before_batch: int) -> int:
        """First free raw_pid for a batch, from the batches before it."""
        first = self.entries(DONE, self.done())[0].next_key
        open_keys = [r.next_key for b, r in self._open_entries(LOADS) if b < before_batch]
        return max([first, *open_keys])

    def set_done(self, batch_id: int) -> None:
        """Let one row stand for all entries up to a batch that is staged, as all before it.

        The row comes first, so a reader finds either; entries that a broken run left behind
        go with a later batch.
        """
        before = self.done()
        if batch_id <= before:
            return
        self.log(DONE, [(self.next_key(batch_id + 1),)], batch_id)
        for name in (LOADS, STAGED):
            for old in self._logged(name):
                if NO_BATCH < old <= batch_id:
                    delete_folder(self.spark, f"{self.path(LOG, name)}/batch_id={old}")
        for old in self._logged(DONE):
            if old < before:
                delete_folder(self.spark, f"{self.path(LOG, DONE)}/batch_id={old}")

    # Readers

    def _finished(self, layer: str, table: str) -> Column:
        """Which batches are finished; a range and the few that are not in it yet."""
        entries = self._open_entries(LOADS if layer == RAW else STAGED)
        later = sorted({b for b, r in entries if r.table_name == table})
        done = F.col("batch_id") <= self.done()
        return done | F.col("batch_id").isin(later) if later else done

    def read(self, layer: str, table: str) -> DataFrame:
        """The finished batches, with their ``batch_id``; the filter prunes folders."""
        rows = self._all(layer, table)
        return rows if layer == LOG else rows.filter(self._finished(layer, table))

    def raw(self, table: str) -> DataFrame:
        """Raw rows in their current state, with their ``batch_id``."""
        pending = sorted({b for b, t in self.pending_batches() if t == table})
        untried = self._all(RAW, table).filter(F.col("batch_id").isin(pending))
        return current_state(untried, self.read(STAGING, table), table)

    def staged(self, table: str) -> DataFrame:
        """Accepted rows with their staging types."""
        return accepted(self.read(STAGING, table), table)

    def quarantine(self, table: str) -> DataFrame:
        """Rejected rows with their own text, source file and failed columns."""
        return rejected(self.read(STAGING, table))

    def datapoint_versions(self) -> DataFrame:
        rows = self.read(STAGING, "datapoints")
        return versions(accepted(rows, "datapoints", "file_rank", "batch_id"))

    def tables(self) -> Staging:
        """The staging tables as the marts read them."""
        rest = {t: self.staged(t).drop("raw_pid") for t in TABLES if t != "datapoints"}
        active = self.active_in(self._buckets(self._bucket_lists()[-1])).drop("file_rank")
        return Staging(datapoints=active, **rest)

    # Active versions of the datapoints

    def _bucket_lists(self, before: int | None = None) -> list[int]:
        """Batches whose staging is finished and has a list of buckets, oldest first."""
        done = self.done()
        staged = {b for b, r in self._open_entries(STAGED) if r.table_name == "datapoints"}
        return [
            b for b in self._logged(BUCKETS)
            if (b <= done or b in staged) and (before is None or b < before)
        ]

    def _buckets(self, batch_id: int) -> dict[int, int]:
        """Which batch wrote each bucket, as of a batch."""
        return {r.bucket: r.version for r in self.entries(BUCKETS, batch_id)}

    def _bucket_path(self, bucket: int, version: int) -> str:
        return f"{self.path(ACTIVE, 'datapoints')}/version={version}/bucket={bucket}"

    def active_in(self, buckets: dict[int, int]) -> DataFrame:
        """Active versions of some buckets; never more paths than there are buckets."""
        schema = self.schema(ACTIVE, "datapoints")
        paths = [self._bucket_path(b, v) for b, v in buckets.items() if v != NO_BATCH]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def advance_active(self, batch_id: int) -> None:
        """Write the active versions as of a batch whose rows have just been staged."""
        rows = self._all(STAGING, "datapoints").filter(F.col("batch_id") == batch_id)
        batch = accepted(rows, "datapoints", "file_rank", "batch_id")
        names_ = self.schema(ACTIVE, "datapoints").fieldNames()
        batch = batch.select(*names_[:-1], "batch_id")
        before = self._buckets(self._bucket_lists(before=batch_id)[-1])
        bucket = bucket_of(len(before))
        # At most one number per bucket.
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]
        after = advance(self.active_in({b: before[b] for b in touched}), batch, names_)
        (
            after.withColumn("bucket", bucket)
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path(ACTIVE, 'datapoints')}/version={batch_id}")
        )
        listed = {**before, **dict.fromkeys(touched, batch_id)}
        self.log(BUCKETS, sorted(listed.items()), batch_id)

    def datapoints_as_of(self, batch_id: int) -> DataFrame | None:
        """Active versions as of a finished batch; None if they are no longer kept."""
        lists = self._bucket_lists(before=batch_id + 1)
        kept = self._bucket_lists()[-2:]
        if not lists or lists[-1] not in kept:
            return None
        return self.active_in(self._buckets(lists[-1]))

    def staged_since(self, table: str, after: int, to: int) -> DataFrame:
        """Accepted rows of the finished batches after one, up to another."""
        batches = (F.col("batch_id") > after) & (F.col("batch_id") <= to)
        return accepted(self.read(STAGING, table).filter(batches), table)

    def drop_old_active(self) -> None:
        """Delete the buckets that the last two lists of staged batches do not name."""
        *older, before, last = [None, *self._bucket_lists()]
        kept = reduce(
            set.union, [set(self._buckets(b).items()) for b in (before, last) if b is not None], set()
        )
        for old in older:
            if old is None:
                continue
            for bucket, version in set(self._buckets(old).items()) - kept:
                delete_folder(self.spark, self._bucket_path(bucket, version))
            delete_folder(self.spark, f"{self.path(LOG, BUCKETS)}/batch_id={old}")
