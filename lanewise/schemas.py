"""Table declarations: columns, staging types, row rules and delivery routes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INTEGER, DOUBLE, DATE, TIMESTAMP = "integer", "double", "date", "timestamp"


@dataclass(frozen=True)
class Field:
    """One business column: its staging type and the check its text must pass."""

    name: str
    type: T.DataType
    rule: str | None = None


# The delivery tokens in the order they are tried (first match
# wins) and, per table, the columns taken from a delivery. A column with a rule
# is checked before staging; text columns are never checked.
TABLES: dict[str, tuple[Field, ...]] = {
    "regions": (
        Field("slug", T.StringType()),
        Field("name", T.StringType()),
        Field("parent", T.StringType()),
    ),
    "ports": (
        Field("pid", T.IntegerType(), INTEGER),
        Field("code", T.StringType()),
        Field("slug", T.StringType()),
        Field("name", T.StringType()),
        Field("country", T.StringType()),
        Field("country_code", T.StringType()),
    ),
    "exchange_rates": (
        Field("day", T.DateType(), DATE),
        Field("currency", T.StringType()),
        Field("rate", T.DoubleType(), DOUBLE),
    ),
    "charges": (
        Field("d_id", T.LongType(), INTEGER),
        Field("currency", T.StringType()),
        Field("charge_value", T.DoubleType(), DOUBLE),
    ),
    "datapoints": (
        Field("d_id", T.LongType(), INTEGER),
        Field("created", T.TimestampNTZType(), TIMESTAMP),
        Field("origin_pid", T.IntegerType(), INTEGER),
        Field("destination_pid", T.IntegerType(), INTEGER),
        Field("valid_from", T.DateType(), DATE),
        Field("valid_to", T.DateType(), DATE),
        Field("company_id", T.IntegerType(), INTEGER),
        Field("supplier_id", T.IntegerType(), INTEGER),
        Field("equipment_id", T.IntegerType(), INTEGER),
    ),
}

# Row states.
NEW, LOADED, ERROR = "NEW", "LOADED", "ERROR"

AUDIT_FIELDS = (
    T.StructField("src_file", T.StringType()),
    T.StructField("raw_load_time", T.TimestampNTZType()),
    T.StructField("stg_status", T.StringType()),
    T.StructField("stg_load_time", T.TimestampNTZType()),
    T.StructField("raw_pid", T.LongType()),
)

# Rows of a batch were loaded in the order (file_rank, raw_pid).
FILE_RANK = T.StructField("file_rank", T.IntegerType())


def columns(table: str) -> list[str]:
    return [field.name for field in TABLES[table]]


def raw_schema(table: str) -> T.StructType:
    """Raw tables hold every delivered column as text, the audit columns, and the place of
    the row's file in its batch."""
    text = [T.StructField(name, T.StringType()) for name in columns(table)]
    return T.StructType([*text, *AUDIT_FIELDS, FILE_RANK])


def staging_schema(table: str) -> T.StructType:
    """Typed columns; ``raw_pid`` carries the lineage."""
    typed = [T.StructField(field.name, field.type) for field in TABLES[table]]
    return T.StructType([*typed, T.StructField("raw_pid", T.LongType())])


def outcome_schema(table: str) -> T.StructType:
    """A staged row: typed values, the outcome, and the row's own text."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in columns(table)])
    return staging_schema(table).add(FILE_RANK).add("src_file", T.StringType()).add(
        "raw_load_time", T.TimestampNTZType()
    ).add("stg_load_time", T.TimestampNTZType()).add("failed_columns", T.StringType()).add("delivered", text).add(
        "stg_status", T.StringType()
    )


# The published marts.
MART_COLUMNS = ["origin", "destination", "equipment_id", "date", "med_cost", "avg_cost", "dq_ok"]
