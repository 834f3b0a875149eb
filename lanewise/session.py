"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "lanewise", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster
    a machine-local folder would be lost with the machine, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lanewise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Folders written by ``materialize`` inside the open ``intermediates`` blocks.
_scopes: list[list[str]] = []


def materialize(
    df: DataFrame, name: str, lasting: bool = False, by: str | None = None
) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    A ``lasting`` table stays at the end of an ``intermediates`` block. ``by`` is a column whose
    values get a folder each.

    Cuts the lineage in a way that survives lost executors. Unlike a cached or
    RDD-checkpointed frame the result keeps column pruning, and its size is known
    exactly, so Catalyst decides on broadcasting it from measured bytes.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/lanewise/{application}/{name}-{uuid.uuid4().hex}"
    if _scopes and not lasting:
        _scopes[-1].append(path)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the tables materialized inside the block at its end.

    Everything read from them must be written or collected by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_folder(spark, path)


def materialize_with(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns aggregates, taken while writing.

    A repeated task is observed again, so only aggregates that do not count rows,
    such as maxima, are reliable here.
    """
    seen = Observation()
    written = materialize(
        df.observe(seen, *[metric.alias(label) for label, metric in metrics.items()]), name
    )
    return written, seen.get


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: eight per column and the contents of texts."""
    contents = [
        F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0))
        for field in df.schema.fields
        if isinstance(field.dataType, (T.StringType, T.BinaryType))
    ]
    return sum(contents, F.lit(8 * (len(df.columns) + 1)))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative if switched off."""
    jvm = spark.sparkContext._jvm
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return int(jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def broadcast_if_small(written: DataFrame) -> DataFrame:
    """Hint for joining a written table: broadcast if its bytes allow, else sort.

    For joins whose other side comes out of an expansion. Catalyst does not count
    expanded rows, so left alone it may take that side for the small one. The bytes are
    those of the rows in memory, not of the packed files, added up over all tasks.
    """
    size = written.agg(F.sum(row_bytes(written).cast("bigint"))).first()[0] or 0
    if size <= broadcast_limit(written.sparkSession):
        return F.broadcast(written)
    return written.hint("merge")
