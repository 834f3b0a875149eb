"""CSV deliveries: columns by header name, every value as text.

The files of a table are read as lines, twice, by scans that cut them alike. The first scan
counts the lines of every file block, takes the first line of every file for its header, and
finds files with a line break inside quotes. The second one parses the lines by the header
of their file. The number of jobs does not grow with the files.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.operators.keys import part_starts, with_keys
from lanewise.schemas import NEW, columns
from lanewise.session import materialize
from lanewise.sources.storage import uri


NOT_BLANK = r"[^\x00-\x20]"


@dataclass(frozen=True)
class Delivery:
    """A file to load: its header, its place in load order, and whether it must be read
    whole because a quoted value holds a line break."""

    path: str
    header: tuple[str, ...]
    rank: int = 0
    whole: bool = False


def literal_path(path: str) -> str:
    """A path that is not taken for a pattern, whatever characters it has."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _line_options(extra: dict[str, object]) -> dict[str, object]:
    """How one line is parsed: quotes are doubled inside quoted text."""
    rest = {k: v for k, v in extra.items() if k != "encoding"}
    return {"escape": '"', **rest}


def scan_lines(spark: SparkSession, paths: list[str], encoding: str | None = None) -> DataFrame:
    """(value, uri, block, src_file, _row): lines that are not blank. ``_row`` counts on within
    a block without gaps, as a block is read by one task from its start."""
    lines = spark.read.text([literal_path(path) for path in paths])
    value = F.col("value")
    if encoding is not None:
        value = F.decode(value.cast("binary"), encoding)
    return (
        lines.select(
            value.alias("value"),
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_name").alias("src_file"),
        )
        .filter(F.col("value").rlike(NOT_BLANK))
        .withColumn("_row", F.monotonically_increasing_id())
    )


def file_blocks(spark: SparkSession, paths: list[str], encoding: str | None = None) -> DataFrame:
    """A written row per file block: (uri, block, lines, base, header, broken).

    ``base`` is the block's first ``_row``, ``header`` the first line of the file, in its
    first block. Quotes are doubled inside quoted text, so a line with an odd number of them
    begins or ends in the middle of a value; a block with such a line is ``broken``.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    odd = F.when(quotes % 2 == 1, True)
    first = F.min_by(F.when(F.col("block") == 0, value), F.col("_row"))
    # The set has Spark hash the few blocks of a task; with texts alone it would sort the lines.
    blocks = scan_lines(spark, paths, encoding).groupBy("uri", "block").agg(
        F.count("*").alias("lines"),
        F.min("_row").alias("base"),
        first.alias("header"),
        (F.size(F.collect_set(odd)) > 0).alias("broken"),
    )
    return materialize(blocks, "file-blocks")


def parse_header(line: str, **extra: object) -> tuple[str, ...]:
    separator = str(extra.get("sep", extra.get("delimiter", ",")))
    rows = csv.reader([line], delimiter=separator, quotechar=str(extra.get("quote", '"')))
    return tuple(next(rows, []))


def look_into(
    spark: SparkSession, paths: list[str], blocks: DataFrame, **extra: object
) -> dict[str, tuple[tuple[str, ...], bool]]:
    """Header of each file that has one, and whether the file is broken; a row per file."""
    by_uri = {uri(spark, path): path for path in paths}
    found = blocks.groupBy("uri").agg(F.max("header").alias("header"), F.max("broken").alias("broken"))
    return {
        by_uri[r.uri]: (parse_header(r.header, **extra), r.broken)
        for r in found.filter(F.col("header").isNotNull()).collect()
    }


def _places(header: tuple[str, ...], table: str) -> dict[str, int]:
    """Where the table's columns are; not those that the header has twice."""
    lowered = [name.lower() for name in header]
    return {name: lowered.index(name) for name in columns(table) if lowered.count(name) == 1}


def missing_columns(header: tuple[str, ...], table: str) -> list[str]:
    present = _places(header, table)
    return [name for name in columns(table) if name not in present]


def project(df: DataFrame, table: str, *extra: Column) -> DataFrame:
    """The table's columns by name, as text, in declared order; others are dropped."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in columns(table)], *extra)


def with_audit(
    df: DataFrame, table: str, src_file: Column, raw_pid: Column, *extra: Column
) -> DataFrame:
    """Lineage, load time, first state and key next to the business columns."""
    return df.select(
        *columns(table),
        src_file.alias("src_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("raw_load_time"),
        F.lit(NEW).alias("stg_status"),
        F.lit(None).cast("timestamp_ntz").alias("stg_load_time"),
        raw_pid.alias("raw_pid"),
        *extra,
    )


def _text_columns(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def _named(values: Column, table: str) -> list[Column]:
    """The table's columns out of a line's values, by the places of the file's header."""
    return [F.get(values, F.col("places")[i]).alias(c) for i, c in enumerate(columns(table))]


_FILES = "uri string, file_rank int, width int, places array<int>"


def _files(spark: SparkSession, table: str, deliveries: list[Delivery]) -> DataFrame:
    """One short row per file of the batch."""
    rows = []
    for d in deliveries:
        places = _places(d.header, table)
        rows.append((uri(spark, d.path), d.rank, len(d.header), [places[c] for c in columns(table)]))
    return spark.createDataFrame(rows, _FILES)


WHOLE = -1  # stands for the place of a block that is a whole file
_SOURCE = ["uri", "block", "file_rank", "src_file", "_row"]


def _plain_rows(
    spark: SparkSession, table: str, paths: list[str], blocks: DataFrame, widths: list[int], extra: dict
) -> DataFrame:
    """Rows of files that are read line by line, with what ``blocks`` says of their block.

    The lines of all files of the scan are read, so that their blocks are those counted.
    """
    lines = scan_lines(spark, paths, extra.get("encoding"))
    joined = lines.join(blocks, ["uri", "block"], "left")
    header = (F.col("block") == 0) & (F.col("_row") < F.col("base"))
    # A line of an unknown block goes on, to be refused where keys are given.
    taken = joined.filter(F.col("base").isNull() | (F.col("file_rank").isNotNull() & ~header))
    values = F.lit(None).cast("array<string>")
    for width in widths:
        # A line is parsed once, for as many columns as its file has.
        schema = ", ".join(f"{field.name} string" for field in _text_columns(width))
        parsed = F.from_csv("value", schema, _line_options(extra))
        taken = taken.withColumn(f"_of_{width}", F.when(F.col("width") == width, parsed))
        fields = F.array(*[F.col(f"_of_{width}.c{i}") for i in range(width)])
        values = F.when(F.col("width") == width, fields).otherwise(values)
    named = taken.withColumn("values", values)
    return named.select(*_named(F.col("values"), table), *_SOURCE, "base", "rows", "start")


def _whole_rows(
    spark: SparkSession, table: str, deliveries: list[Delivery], files: DataFrame, extra: dict
) -> DataFrame:
    """Rows of files that are not split, each a block.

    Spark takes the number of columns of a read from one schema, so files are read
    together by the width of their header.
    """
    by_width: dict[int, list[str]] = defaultdict(list)
    for d in deliveries:
        by_width[len(d.header)].append(literal_path(d.path))

    def read(width: int, paths: list[str]) -> DataFrame:
        reader = spark.read.schema(_text_columns(width)).options(
            header=True, multiLine=True, escape='"', **extra
        )
        # A blank line is no row here either; the reader makes one value of it.
        blank = ~F.col("c0").rlike(NOT_BLANK)
        for i in range(1, width):
            blank = blank & F.col(f"c{i}").isNull()
        rows = reader.csv(paths).filter(~F.coalesce(blank, F.lit(False)))
        return rows.select(
            F.array(*[f"c{i}" for i in range(width)]).alias("values"),
            F.col("_metadata.file_path").alias("uri"),
            F.lit(WHOLE).cast("bigint").alias("block"),
            F.col("_metadata.file_name").alias("src_file"),
            F.monotonically_increasing_id().alias("_row"),
        )

    parts = [read(width, paths) for width, paths in by_width.items()]
    rows = reduce(DataFrame.unionByName, parts).join(F.broadcast(files), "uri")
    return rows.select(*_named(F.col("values"), table), *_SOURCE)


def read_deliveries(
    spark: SparkSession,
    table: str,
    deliveries: list[Delivery],
    blocks: DataFrame,
    paths: list[str],
    first_key: int = 0,
    **extra: object,
) -> tuple[DataFrame, int]:
    """Raw rows of the files of one table, and the first key after them.

    Keys follow the rank of the file, then the place in the file, without gaps. ``blocks``
    are those of ``paths``, all files of the table that were looked into; the lines of a file
    that is not delivered are read and dropped.
    """
    plain, whole = [[d for d in deliveries if d.whole == w] for w in (False, True)]
    less = F.when((F.col("block") == 0) & F.col("file_rank").isNotNull(), 1).otherwise(0)
    parts = blocks.join(F.broadcast(_files(spark, table, plain)), "uri", "left").select(
        "uri", "block", (F.col("base") + less).alias("base"), (F.col("lines") - less).alias("rows"),
        "file_rank", "width", "places",
    )
    whole_rows = None
    if whole:
        whole_rows = _whole_rows(spark, table, whole, _files(spark, table, whole), extra)
        counted = whole_rows.groupBy("uri", "block", "file_rank").agg(
            F.min("_row").alias("base"), F.count("*").alias("rows")
        )
        parts = parts.unionByName(counted, allowMissingColumns=True)
    delivered = F.col("file_rank").isNotNull()
    starts = part_starts(parts.filter(delivered), "file_rank", "block", first=first_key)
    others = parts.filter(~delivered).withColumn("start", F.lit(None).cast("bigint"))
    starts = materialize(starts.unionByName(others), "block-starts")
    rows = []
    if plain:
        widths = sorted({len(d.header) for d in plain})
        rows.append(_plain_rows(spark, table, paths, starts, widths, extra))
    if whole:
        known = starts.select("uri", "block", "base", "rows", "start")
        rows.append(whole_rows.join(known, ["uri", "block"], "left"))
    keyed = with_keys(reduce(DataFrame.unionByName, rows))
    after = starts.filter(delivered).agg(F.max(F.col("start") + F.col("rows"))).first()[0]
    raw = with_audit(keyed, table, F.col("src_file"), F.col("raw_pid"), F.col("file_rank"))
    return raw, first_key if after is None else after
