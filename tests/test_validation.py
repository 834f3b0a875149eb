"""Texts and the types that accept them; versions and row state."""

import pytest
from pyspark.sql import functions as F

from lanewise.functions import parsing
from lanewise.operators import staging, validate
from lanewise.operators.keys import dense_keys
from lanewise.schemas import TABLES, columns

# Accepted as i(nteger), f(loat), d(ate), t(imestamp).
ACCEPTED = {
    "1": "if", "-7": "if", "+7": "if", " 12 ": "if", "007": "if", "99999999999": "if",
    "\t9\n": "if", "2024": "if", "20240105": "if", "1.0": "f", "1e3": "f", "nan": "f", "inf": "f",
    "-Infinity": "f", ".5": "f", "5.": "f", "+nan": "f", "2024-01-05": "d", "2024-1-5": "d",
    "0001-01-01": "d", "2024-01-05 01:02:03": "t", "2024-1-5 1:2:3": "t",
    "2024-01-05 01:02:03.1": "t", "2024-01-05 01:02:03.123456": "t",
}
REFUSED = [
    "", "abc", "1.5d", "1.5f", "1.5D", "3L", "0x10", "1,5", "2024-13-01", "2024-02-30", "2024-01",
    "05/01/2024", " 2024-01-05", "2024-01-05 ", "2024-01-05\n", "2024-01-05 01:02:03.1234567",
    "2024-01-05T01:02:03", "2024-01-05 01:02:03+02", "2024-01-05 25:00:00", "2024-01-05 01:02",
    "2024-01-05 01:02:60", "2024-02-30 01:02:03", "1_000", "٣", "2024-01-05  01:02:03",
    "0000-01-01", "0000-01-01 00:00:00", None,
]


def test_matrix(spark):
    texts = [*ACCEPTED, *REFUSED]
    x = F.col("x")
    flags = spark.createDataFrame([(t,) for t in texts], "x string").select(
        x,
        F.concat(
            F.when(parsing.parse_integer(x).isNotNull(), "i").otherwise(""),
            F.when(parsing.parse_double(x).isNotNull(), "f").otherwise(""),
            F.when(parsing.parse_date(x).isNotNull(), "d").otherwise(""),
            F.when(parsing.parse_timestamp(x).isNotNull(), "t").otherwise(""),
        ),
    )
    expected = {**ACCEPTED, **{t: "" for t in REFUSED}}
    assert dict(flags.collect()) == expected


def datapoint(key, d_id, **changes):
    row = dict(zip(columns("datapoints"), [d_id, "2021-01-01 00:00:00", "1", "2", "2021-01-01",
                                           "2021-01-02", "3", "4", "5"]))
    row.update(changes)
    return (*row.values(), "f.csv", key)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        datapoint(1, "7"),
        datapoint(2, "8", supplier_id="abc", valid_to="x"),
        datapoint(3, " 7 ", created="2000-01-01 00:00:00"),
        datapoint(4, "7", equipment_id="99999999999"),
        datapoint(5, "9", origin_pid=None),
        datapoint(6, "10"),
    ]
    names = [*columns("datapoints"), "src_file"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", raw_pid bigint")


def test_every_row_is_accepted_or_quarantined(raw):
    outcome = validate.outcomes(raw, "datapoints")
    accepted = {r.raw_pid for r in validate.accepted(outcome, "datapoints").collect()}
    rejected = {r.raw_pid: r.failed_columns for r in validate.rejected(outcome).collect()}
    assert accepted == {1, 3, 6}
    assert rejected == {2: "valid_to,supplier_id", 4: "equipment_id", 5: "origin_pid"}
    outcome = {r.raw_pid: r for r in outcome.collect()}
    assert {k for k, r in outcome.items() if r.stg_status == "LOADED"} == accepted
    assert {k: r.failed_columns for k, r in outcome.items() if r.stg_status == "ERROR"} == rejected
    assert outcome[2].delivered.supplier_id == "abc" and outcome[1].delivered.supplier_id == "4"
    assert outcome[3].d_id == 7


def test_last_accepted_version_is_active(raw):
    outcome = validate.outcomes(raw, "datapoints").withColumn("batch_id", F.lit(0))
    accepted = validate.accepted(outcome, "datapoints", "file_rank", "batch_id")
    flags = {r.raw_pid: r.is_active for r in staging.versions(accepted).collect()}
    assert flags == {1: False, 3: True, 6: True}
    current = staging.current(accepted)
    assert {(r.d_id, r.raw_pid) for r in current.collect()} == {(7, 3), (10, 6)}
    assert {*columns("datapoints"), "raw_pid", "is_active"} < set(current.columns)
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_batches_come_before_files_and_files_before_keys(spark):
    rows = [(1, 0, 0, 900), (1, 0, 1, 5), (2, 0, 3, 7), (2, 1, 0, 2), (3, 2**40, 1, 1), (3, 2**40, 1, 2)]
    df = spark.createDataFrame(rows, "d_id bigint, batch_id bigint, file_rank int, raw_pid bigint")
    active = {r.raw_pid for r in staging.versions(df).collect() if r.is_active}
    assert active == {2, 5}
    assert {(r.d_id, r.raw_pid) for r in staging.current(df).collect()} == {(1, 5), (2, 2), (3, 2)}


def test_a_batch_replaces_only_its_own_ids(spark):
    kind = "d_id bigint, batch_id bigint, file_rank int, raw_pid bigint"
    before = staging.current(spark.createDataFrame([(1, 0, 0, 1), (2, 0, 0, 2)], kind))
    batch = spark.createDataFrame([(2, 1, 0, 3), (2, 1, 1, 4), (5, 1, 0, 9)], kind)
    names = ["d_id", "raw_pid", "file_rank", "is_active"]
    after = staging.advance(before, batch, names)
    assert sorted(map(tuple, after.collect())) == [(1, 1, 0, True), (2, 4, 1, True), (5, 9, 0, True)]


def test_tables_without_rules_accept_all(spark):
    row = spark.createDataFrame(
        [(None, "x", None, "f", 1)],
        "slug string, name string, parent string, src_file string, raw_pid int",
    )
    assert validate.accepted(validate.outcomes(row, "regions"), "regions").count() == 1
    assert not [f for f in TABLES["regions"] if f.rule]


def test_dense_keys(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(5)
    rows = dense_keys(df, "v", first=100).collect()
    assert sorted(r.raw_pid for r in rows) == list(range(100, 5100))
    assert all(r.raw_pid == r.v + 100 for r in rows)
    assert dense_keys(df.filter("false"), "v").count() == 0
    tied = df.select(F.least("v", F.lit(1000)).alias("v"))
    keys = dense_keys(tied, "v").collect()
    assert sorted(r.raw_pid for r in keys) == list(range(1, 5001))
    assert all(r.v == min(r.raw_pid - 1, 1000) for r in keys)
