"""Row rules: which columns of a raw row fail, and why a row is accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.parsing import parse_field
from lanewise.schemas import ERROR, LOADED, TABLES, columns


def failed_columns(table: str) -> Column:
    """Names of the checked columns without an acceptable value, comma separated."""
    checked = [field for field in TABLES[table] if field.rule]
    if not checked:
        return F.lit("")
    failures = [F.when(parse_field(f).isNull(), F.lit(f.name)) for f in checked]
    return F.concat_ws(",", *failures)


def validate(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows with ``failed_columns`` and ``ok``; a row is ok if no check fails."""
    checked = raw.withColumn("failed_columns", failed_columns(table))
    return checked.withColumn("ok", F.col("failed_columns") == "")


def outcomes(raw: DataFrame, table: str) -> DataFrame:
    """Everything staging writes for a raw batch, from one scan of it.

    Accepted and rejected rows, their status and their text are columns of the same row,
    so raw is read and parsed once, and neither the quarantine nor the state of a raw row
    needs a join. Readers of typed columns never touch the text.
    """
    checked = validate(raw, table)
    rank = F.col("file_rank") if "file_rank" in raw.columns else F.lit(0)
    known = "raw_load_time" in raw.columns
    loaded = F.col("raw_load_time") if known else F.lit(None).cast("timestamp_ntz")
    text = F.struct(*[F.col(name) for name in columns(table)])
    return checked.select(
        *[parse_field(f).alias(f.name) for f in TABLES[table]],
        "raw_pid",
        rank.alias("file_rank"),
        "src_file",
        loaded.alias("raw_load_time"),
        F.current_timestamp().cast("timestamp_ntz").alias("stg_load_time"),
        "failed_columns",
        text.alias("delivered"),
        F.when(F.col("ok"), LOADED).otherwise(ERROR).alias("stg_status"),
    )


def accepted(outcome: DataFrame, table: str, *extra: str) -> DataFrame:
    """Accepted rows with their staging types."""
    return outcome.filter(F.col("stg_status") == LOADED).select(*columns(table), "raw_pid", *extra)


def rejected(outcome: DataFrame) -> DataFrame:
    """Rejected rows with their own text, source file and failed columns."""
    bad = outcome.filter(F.col("stg_status") == ERROR)
    return bad.select("delivered.*", "src_file", "raw_pid", "failed_columns")
