"""Deliveries as a file stream: routing, headers, keys, retries, staging."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lanewise.plans import marts
from lanewise.sources.routing import route
from lanewise.sources.csv_files import parse_header
from lanewise.sources.tables import BUCKETS, DONE, LOADS, LOG, RAW, STAGED, UNROUTED, Warehouse
from lanewise.streaming.deliveries import load_batch, stage_batch, stage_pending, start_loading

ROUTES = {
    "regions_1.csv": "regions",
    "ports_regions.csv": "regions",
    "airports.csv": "ports",
    "reports_1.csv": "ports",
    "exchange_rates_2021.csv": "exchange_rates",
    "charges_datapoints.csv": "charges",
    "datapoints_1.csv": "datapoints",
    "Ports.csv": "unrouted",
    "ports.CSV": "unrouted",
    "ports.csv.gz": "unrouted",
    "notes.txt": "unrouted",
    "loaded": "unrouted",
}


class Inbox:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.inbox = root / "in"
        self.inbox.mkdir()
        self.warehouse = Warehouse(spark, str(root / "wh")).create()

    def put(self, name, text):
        (self.inbox / name).write_text(text)

    def load(self, **options):
        query = start_loading(
            self.spark,
            str(self.inbox),
            self.warehouse,
            str(self.root / "cp"),
            archive=str(self.root / "archive"),
            rejected=str(self.root / "rejected"),
            **options,
        )
        query.awaitTermination(120)

    def names(self, folder):
        return sorted(p.name for p in (self.root / folder).rglob("*.csv"))


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def test_routes(spark):
    names = spark.createDataFrame([(n,) for n in ROUTES], "name string")
    assert dict(names.select("name", route(F.col("name"))).collect()) == ROUTES


def test_headers_decide_columns(inbox):
    inbox.put("regions_1.csv", "slug,name,parent\na,A,r\nb,,\"\"\n")
    inbox.put("regions_2.csv", "extra,Parent,slug,name\ne,P,S,N\n")
    inbox.put("regions_3.csv", "slug,name\nm,M\n")
    inbox.put("notes.txt", "nothing")
    inbox.put("other.csv", "nothing")
    inbox.put("regions_4.csv", "slug,name,parent\nq,\"two\nlines, \"\"quoted\"\"\",r\n")
    inbox.load()
    raw = inbox.warehouse.read(RAW, "regions")
    rows = {tuple(r) for r in raw.select("slug", "name", "parent", "src_file").collect()}
    assert rows == {
        ("a", "A", "r", "regions_1.csv"),
        ("b", None, None, "regions_1.csv"),
        ("S", "N", "P", "regions_2.csv"),
        ("q", 'two\nlines, "quoted"', "r", "regions_4.csv"),
    }
    assert {r.stg_status for r in raw.collect()} == {"NEW"}
    report = inbox.warehouse.read(LOG, UNROUTED).collect()
    assert {(r.path.rsplit("/", 1)[1], r.reason) for r in report} == {
        ("regions_3.csv", "missing parent"), ("notes.txt", "no table"), ("other.csv", "no table")
    }
    assert {p.name for p in inbox.inbox.iterdir()} == {"notes.txt", "other.csv"}
    assert inbox.names("rejected") == ["regions_3.csv"]
    assert inbox.names("archive") == ["regions_1.csv", "regions_2.csv", "regions_4.csv"]


@pytest.mark.parametrize("large_first", [True, False])
@pytest.mark.parametrize("extra", ["", ",more"])
def test_later_file_of_a_batch_is_active(inbox, large_first, extra):
    """Whatever the sizes, whether or not the headers are alike."""
    head = "d_id,created,origin_pid,destination_pid,valid_from,valid_to,company_id,supplier_id,equipment_id"
    line = "{},2021-01-01 00:00:00,1,2,2021-01-01,2021-01-01,1,{},1"
    for name, supplier, large in (("datapoints_1.csv", 1, large_first), ("datapoints_2.csv", 2, not large_first)):
        lines = [line.format(7, supplier)] + [line.format(100 + i, supplier) for i in range(400 * large)]
        more = extra if name == "datapoints_2.csv" else ""
        inbox.put(name, "\n".join([head + more, *[x + ",0" * bool(more) for x in lines]]) + "\n")
        time = 1_700_000_000 + supplier
        os.utime(inbox.inbox / name, (time, time))
    inbox.load()
    stage_pending(inbox.warehouse)
    seven = inbox.warehouse.datapoint_versions().filter("d_id = 7")
    assert {(r.supplier_id, r.is_active) for r in seven.collect()} == {(1, False), (2, True)}
    active = inbox.warehouse.tables().datapoints.filter("d_id = 7").collect()
    assert [r.supplier_id for r in active] == [2]


def test_line_breaks_in_quotes_stay_in_their_value(inbox):
    inbox.put("charges_1.csv", 'd_id,currency,charge_value,note\n1,USD,5,"two\nlines"\n2,EUR,6,"a ""b"" c"\n')
    inbox.put("charges_2.csv", 'note,d_id,currency,charge_value\n"x\ny, ""z""\n",3,USD,7\n')
    inbox.put("charges_3.csv", "d_id,currency,charge_value\n4,USD,8\n")
    inbox.load()
    raw = inbox.warehouse.read(RAW, "charges").select("d_id", "currency", "charge_value").collect()
    assert {tuple(r) for r in raw} == {
        ("1", "USD", "5"), ("2", "EUR", "6"), ("3", "USD", "7"), ("4", "USD", "8")
    }
    assert len(raw) == 4


def test_no_file_name_stops_a_batch(inbox):
    names = ["regions_[1].csv", "regions_{a,b}.csv", "re gions_regions%20*?.csv", "regions_\\x.csv"]
    for i, name in enumerate(names):
        inbox.put(name, f"slug,name,parent\ns{i},n,p\n")
    inbox.put("regions_good.csv", "slug,name,parent\ngood,n,p\n")
    inbox.load()
    slugs = sorted(r.slug for r in inbox.warehouse.read(RAW, "regions").collect())
    assert slugs == ["good", "s0", "s1", "s2", "s3"]
    assert len(inbox.names("archive")) == 5 and not list(inbox.inbox.iterdir())


def test_unreadable_file_is_reported(spark, inbox):
    inbox.put("regions_1.csv", "slug,name,parent\na,n,p\n")
    inbox.put("regions_2.csv", "slug,name,parent\nb,n,p\n")
    files = spark.read.format("binaryFile").load(str(inbox.inbox)).select("path").cache()
    files.count()
    (inbox.inbox / "regions_2.csv").unlink()
    load_batch(inbox.warehouse, files, 0, rejected=str(inbox.root / "rejected"))
    assert [r.slug for r in inbox.warehouse.read(RAW, "regions").collect()] == ["a"]
    assert [r.reason for r in inbox.warehouse.entries(UNROUTED, 0)] == ["not readable"]


def test_repaired_file_loads_under_a_new_name(inbox):
    inbox.put("regions_bad.csv", "slug,name\na,n\n")
    inbox.load()
    assert inbox.names("rejected") == ["regions_bad.csv"] and not inbox.names("archive")
    inbox.put("regions_bad_repaired.csv", "slug,name,parent\na,n,p\n")
    inbox.load()
    assert [r.slug for r in inbox.warehouse.read(RAW, "regions").collect()] == ["a"]


def test_unfinished_batches_are_invisible(spark, inbox):
    """Rows whose log entry is missing are in no reader's answer."""
    inbox.put("regions_1.csv", "slug,name,parent\na,n,p\n")
    inbox.load()
    wh = inbox.warehouse
    stage_batch(wh, "regions", 0)
    assert wh.staged("regions").count() == 0 and wh.pending_batches() == [(0, "regions")]
    assert wh.tables().regions.count() == 0
    assert [r.stg_status for r in wh.raw("regions").collect()] == ["NEW"]
    wh.write(wh.read(RAW, "regions").drop("batch_id"), RAW, "regions", 5)
    assert wh.raw("regions").count() == 1
    stage_pending(wh)
    assert wh.staged("regions").count() == 1 and wh.raw("regions").first().stg_status == "LOADED"


def test_loads_once_and_archives(inbox):
    inbox.put("ports_1.csv", "pid,code,slug,name,country,country_code\n1,A,a,n,c,cc\n")
    inbox.load()
    inbox.load()
    assert inbox.warehouse.read(RAW, "ports").count() == 1
    inbox.put("ports_2.csv", "pid,code,slug,name,country,country_code\n2,B,b,n,c,cc\n")
    inbox.load()
    inbox.put("ports_3.csv", "pid,code,slug,name,country,country_code\n3,C,c,n,c,cc\n")
    inbox.load()
    assert sorted(r.pid for r in inbox.warehouse.read(RAW, "ports").collect()) == ["1", "2", "3"]
    assert list((inbox.root / "archive").rglob("ports_1.csv"))
    assert not (inbox.inbox / "ports_1.csv").exists()


def test_keys_follow_load_order_without_gaps(spark, inbox):
    """Over tables, then files by arrival, then lines, whatever blocks the files are cut into."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for second, name in enumerate(["charges_b.csv", "charges_a.csv", "charges_c.csv"]):
            quoted = '"x\ny"' if name == "charges_c.csv" else "USD"
            lines = "".join(f"{i},{quoted},{i}.5\n" + "\n \t\n" * (i % 7 == 0) for i in range(1000))
            head = "\nd_id,currency,charge_value\n" if second else "currency,d_id,charge_value,more\n"
            lines = lines if second else "".join(f"USD,{i},{i}.5,\n" for i in range(1000))
            inbox.put(name, head + lines)
            os.utime(inbox.inbox / name, (1_700_000_000 + second,) * 2)
        inbox.put("regions_a.csv", "slug,name,parent\nx,X,\n")
        inbox.load()
        inbox.put("charges_d.csv", "d_id,currency,charge_value\n7,USD,1\n")
        inbox.load()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    region = inbox.warehouse.read(RAW, "regions").first().raw_pid
    rows = inbox.warehouse.read(RAW, "charges").orderBy("raw_pid").select("raw_pid", "src_file", "d_id").collect()
    assert sorted([region, *[r.raw_pid for r in rows]]) == list(range(3002))
    names = ["charges_b.csv"] * 1000 + ["charges_a.csv"] * 1000 + ["charges_c.csv"] * 1000 + ["charges_d.csv"]
    assert [r.src_file for r in rows] == names
    assert [int(r.d_id) for r in rows] == [*range(1000)] * 3 + [7]


def test_headers_are_parsed_like_lines():
    assert parse_header('a,"b ""x"", c",,d') == ("a", 'b "x", c', "", "d")
    assert parse_header("a;b,c", sep=";") == ("a", "b,c")


def test_lines_are_parsed_as_by_the_csv_reader(spark, inbox):
    head = "slug,name,parent"
    lines = ['a,b,c', 'a,"b, ""x""",c', 'a', 'a,b,c,d', ',,', '"",b,""', ' a , "b" ,c', 'a,b"x"c,d', 'é,"漢",',
             'a,b\\,c', '\ta,b,c']
    inbox.put("regions_1.csv", "\n".join([head, *lines]) + "\n")
    plain = spark.read.option("header", True).option("escape", '"').csv(str(inbox.inbox / "regions_1.csv"))
    expected = sorted(map(str, map(tuple, plain.collect())))
    inbox.load()
    got = inbox.warehouse.read(RAW, "regions").select("slug", "name", "parent").collect()
    assert sorted(map(str, map(tuple, got))) == expected and len(got) == len(lines)


def test_text_in_another_encoding(spark, inbox):
    (inbox.inbox / "regions_1.csv").write_bytes("slug,name,parent\né,Ü,ß\n".encode("latin-1"))
    inbox.load(encoding="ISO-8859-1")
    assert [tuple(r)[:3] for r in inbox.warehouse.read(RAW, "regions").collect()] == [("é", "Ü", "ß")]


def test_a_name_that_a_header_has_twice_is_missing(inbox):
    inbox.put("regions_1.csv", "slug,SLUG,name,parent\na,b,c,d\n")
    inbox.load()
    assert [r.reason for r in inbox.warehouse.read(LOG, UNROUTED).collect()] == ["missing slug"]


def jobs_of(spark, group, act):
    spark.sparkContext.setJobGroup(group, group)
    act()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_of_a_batch_do_not_grow_with_its_files(spark, inbox):
    """A thousand small files in as many jobs as forty."""
    from lanewise.streaming.deliveries import load_batch

    def batch(number, files):
        folder = inbox.root / f"files{number}"
        folder.mkdir()
        for i in range(files):
            extra = ",x" * (i % 3)
            (folder / f"regions_{i:04}.csv").write_text(f"slug,name,parent{extra}\ns{i},n,p{extra}\n")
        rows = [(str(folder / f"regions_{i:04}.csv"),) for i in range(files)]
        paths = spark.createDataFrame([(f"file:{r[0]}",) for r in rows], "path string").coalesce(1)
        return jobs_of(spark, f"batch-{number}", lambda: load_batch(inbox.warehouse, paths, number))

    few, many = batch(0, 40), batch(1, 1000)
    assert many <= few + 1  # which reads the log entry of the batch before
    rows = inbox.warehouse.read(RAW, "regions").filter("batch_id = 1").orderBy("raw_pid").collect()
    assert [r.slug for r in rows] == [f"s{i}" for i in range(1000)]
    assert [r.raw_pid for r in rows] == list(range(40, 1040))


HEAD = "d_id,created,origin_pid,destination_pid,valid_from,valid_to,company_id,supplier_id,equipment_id"


def datapoint_lines(ids, supplier):
    return "\n".join([HEAD, *[f"{i},2021-01-01 00:00:00,1,2,2021-01-01,2021-01-01,1,{supplier},1" for i in ids]]) + "\n"


def active_files(inbox):
    root = inbox.root / "wh" / "active" / "datapoints"
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_a_batch_reads_and_writes_touched_buckets_only(spark, inbox, monkeypatch):
    wh = inbox.warehouse
    inbox.put("datapoints_1.csv", datapoint_lines(range(500), 1))
    inbox.load()
    stage_pending(wh)
    first = active_files(inbox)
    assert len({f.split("/")[1] for f in first}) == 64
    inbox.put("datapoints_2.csv", datapoint_lines([7, 8, 7], 2))
    inbox.load()
    asked, honest = [], Warehouse.active_in
    monkeypatch.setattr(Warehouse, "active_in", lambda self, b: asked.append(set(b)) or honest(self, b))
    stage_batch(wh, "datapoints", 1)
    second = active_files(inbox)
    touched = {f.split("/")[1] for f in set(second) - set(first)}
    assert 1 <= len(touched) <= 2 and asked == [{int(t.removeprefix("bucket=")) for t in touched}]
    # The batch is not finished: readers see the state before. Its retry replaces its own files.
    assert {r.supplier_id for r in wh.tables().datapoints.collect()} == {1}
    stage_pending(wh)
    third = active_files(inbox)
    assert {f: t for f, t in third.items() if f in first} == first
    state = {r.d_id: r.supplier_id for r in wh.tables().datapoints.collect()}
    assert state == {i: 2 if i in (7, 8) else 1 for i in range(500)}
    # What neither of the last two batches names is deleted.
    inbox.put("datapoints_3.csv", datapoint_lines([7, 8], 3))
    inbox.load()
    stage_pending(wh)
    inbox.put("datapoints_4.csv", datapoint_lines([7], 4))
    inbox.load()
    stage_pending(wh)
    kept = {tuple(f.split("/")[:2]) for f in active_files(inbox)}
    assert {b for v, b in kept if v == "version=0"} == {f"bucket={i}" for i in range(64)} - touched
    assert {b for v, b in kept if v == "version=1"} == set()
    state = {r.d_id: r.supplier_id for r in wh.tables().datapoints.filter("d_id in (6, 7, 8)").collect()}
    assert state == {6: 1, 7: 4, 8: 3}


def test_state_of_raw_rows_needs_no_exchange(spark, inbox):
    inbox.put("charges_1.csv", "d_id,currency,charge_value\n1,USD,5\nx,USD,6\n")
    inbox.load()
    stage_pending(inbox.warehouse)
    inbox.put("charges_2.csv", "d_id,currency,charge_value\n2,USD,7\n")
    inbox.load()
    raw = inbox.warehouse.raw("charges")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    rows = {(r.d_id, r.stg_status, r.stg_load_time is None, r.raw_load_time is None, r.src_file) for r in raw.collect()}
    assert rows == {
        ("1", "LOADED", False, False, "charges_1.csv"), ("x", "ERROR", False, False, "charges_1.csv"),
        ("2", "NEW", True, False, "charges_2.csv"),
    }


def test_the_log_stays_small(inbox):
    """One row stands for all finished batches; keys and pending batches follow from it."""
    wh = inbox.warehouse
    for i in range(4):
        inbox.put(f"charges_{i}.csv", f"d_id,currency,charge_value\n{i},USD,5\n")
        inbox.load()
        if i != 2:
            stage_pending(wh)
    assert wh.done() == 3 and wh.pending_batches() == [] and wh.next_key(4) == 4
    assert [wh._logged(name) for name in (LOADS, STAGED, DONE)] == [[-1], [-1], [2, 3]]
    assert len(wh._logged(BUCKETS)) == 1
    plan = wh.read(RAW, "charges")._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" not in plan and " IN (" not in plan
    assert sorted(r.d_id for r in wh.staged("charges").collect()) == [0, 1, 2, 3]
    assert all(wh.has_loaded(b) for b in range(4)) and not wh.has_loaded(4)


def test_repeated_batch_changes_nothing(spark, inbox):
    inbox.put("charges_a.csv", "d_id,currency,charge_value\n1,USD,2\n")
    files = spark.read.format("binaryFile").load(str(inbox.inbox)).select("path")
    load_batch(inbox.warehouse, files, 0)
    before = inbox.warehouse.read(RAW, "charges").select("d_id", "raw_pid").collect()
    assert len(before) == 1
    load_batch(inbox.warehouse, files, 0)
    assert inbox.warehouse.read(RAW, "charges").select("d_id", "raw_pid").collect() == before


def test_files_to_prices(inbox):
    """Two deliveries through to a mart: versions, quarantine, row status."""
    inbox.put("regions.csv", "slug,name,parent\nw,W,\neu,,w\nas,,w\ne,E,eu\nf,F,as\n")
    inbox.put("ports.csv", "pid,code,slug,name,country,country_code\n1,A,e,,,\n2,B,f,,,\nx,C,f,,,\n")
    inbox.put("exchange_rates.csv", "day,currency,rate\n2021-01-01,USD,1\n2021-02-30,USD,1\n")
    inbox.put("charges.csv", "d_id,currency,charge_value\n7,USD,100\n7,USD,50\n8,USD,n/a\n")
    head = "d_id,created,origin_pid,destination_pid,valid_from,valid_to,company_id,supplier_id,equipment_id\n"
    inbox.put("datapoints_1.csv", head + "7,2021-01-01 00:00:00,1,2,2021-01-01,2021-01-01,1,1,1\n")
    inbox.load()
    stage_pending(inbox.warehouse)
    inbox.put(
        "datapoints_2.csv",
        head
        + "7,2020-01-01 00:00:00,1,2,2021-01-01,2021-01-01,2,2,1\n"
        + "7,2022-01-01,1,2,2021-01-01,2021-01-01,3,3,1\n",
    )
    inbox.load()
    stage_pending(inbox.warehouse)
    stage_pending(inbox.warehouse)
    wh = inbox.warehouse

    versions = wh.datapoint_versions().select("supplier_id", "is_active").collect()
    assert {tuple(r) for r in versions} == {(1, False), (2, True)}
    status = wh.raw("datapoints").select("supplier_id", "stg_status").collect()
    assert {tuple(r) for r in status} == {("1", "LOADED"), ("2", "LOADED"), ("3", "ERROR")}
    assert wh.raw("datapoints").filter("stg_load_time is null").count() == 0
    bad = [r for t in ("ports", "exchange_rates", "charges", "datapoints") for r in
           wh.quarantine(t).select("failed_columns").collect()]
    assert [r.failed_columns for r in bad] == ["pid", "day", "charge_value", "created"]
    day = dt.date(2021, 1, 1)
    mart = {tuple(r) for r in marts.prices_ds(wh.tables()).collect()}
    assert mart == {
        (origin, destination, 1, day, 150.0, 150.0, 0)
        for origin, destination in [("A", "B"), ("e", "as"), ("eu", "f"), ("eu", "as")]
    }
