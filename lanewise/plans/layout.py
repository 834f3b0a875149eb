"""Staging tables laid out for the marts: datapoints and charges in the same buckets of ``d_id``.

Several marts from one state join datapoints with charges each time. As bucketed tables of
the session catalog, both are shuffled once, when they are laid out; the marts' joins and
the sums per datapoint then need no exchange.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.operators.intervals import active
from lanewise.plans.marts import Staging


def _bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """A table with one sorted file per bucket; one task writes a bucket whole."""
    spark = df.sparkSession
    (
        df.repartition(buckets, "d_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "d_id")
        .sortBy("d_id")
        .saveAsTable(name)
    )
    return spark.table(name)


def lay_out(tables: Staging, database: str, buckets: int = 200) -> Staging:
    """The same tables with active datapoints and charges bucketed by ``d_id``.

    Charges are added up per datapoint and currency first, map-side, so that a datapoint with
    a large share of all charges does not fill a bucket; that is what marts read of them.
    Sums keep NULL where a datapoint has charges without a value only. The catalog must
    be one that the readers share; ``buckets`` should give files of some hundred megabytes.
    """
    spark = tables.datapoints.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    totals = tables.charges.groupBy("d_id", "currency").agg(F.sum("charge_value").alias("charge_value"))
    return replace(
        tables,
        datapoints=_bucketed(active(tables.datapoints), f"`{database}`.`datapoints`", buckets),
        charges=_bucketed(totals, f"`{database}`.`charges`", buckets),
    )


def drop_layout(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
