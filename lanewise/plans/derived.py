"""Staging and raw tables derived from the star schema, for queries and tests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.plans.marts import Staging


# Raw text rows as (source table, expressions). The expressions are plain enough to
# run unchanged on the oracle.
_DAY = "cast(floor(o_orderkey / 14.0) as bigint) % 11 + 1"
_LAST = f"({_DAY} + cast(floor(o_orderkey / 154.0) as bigint) % 5 - 1)"


def _text_day(day: str) -> str:
    return (
        f"case when {day} = 0 then '2020-12-31'"
        f" else concat('2021-01-', lpad(cast({day} as string), 2, '0')) end"
    )


def _datapoints(first_key: int, supplier_step: int, created: str, company_damage: int) -> list[str]:
    return [
        "case when o_orderkey % 73 = 0 then concat(' +', cast(o_orderkey as string))"
        " else cast(o_orderkey as string) end as d_id",
        f"case when o_orderkey % 59 = 0 then substr({created}, 1, 10) else {created} end as created",
        "case when o_orderkey % 71 = 0 then null else cast(o_orderkey % 7 as string) end as origin_pid",
        "cast(o_custkey % 5 + 3 as string) as destination_pid",
        f"case when o_orderkey % 61 = 0 then '2021/01/01' else {_text_day(_DAY)} end as valid_from",
        f"{_text_day(_LAST)} as valid_to",
        f"case when o_orderkey % {company_damage} = 0 then '1.5'"
        " else cast(o_custkey % 9 as string) end as company_id",
        "case when o_orderkey % 53 = 0 then 'abc'"
        f" else cast(o_orderkey % 3 + {supplier_step} as string) end as supplier_id",
        "cast(o_orderkey % 2 + 1 as string) as equipment_id",
        f"'datapoints_{supplier_step}.csv' as src_file",
        "case o_orderkey % 3 when 0 then 'NEW' when 1 then 'LOADED' else 'ERROR' end as stg_status",
        f"cast(o_orderkey + {first_key} as bigint) as raw_pid",
    ]


RAW: dict[str, tuple[str, list[str]]] = {
    "datapoints": ("orders", _datapoints(0, 0, "cast(o_orderdate as string)", 67)),
    "charges": (
        "lineitem",
        [
            "case when l_orderkey % 43 = 0 then 'x1' else cast(l_orderkey as string) end as d_id",
            "case l_returnflag when 'A' then 'EUR' when 'R' then 'CNY' else 'USD' end as currency",
            "case when l_orderkey % 47 = 0 then 'n/a' else cast(l_extendedprice as string) end"
            " as charge_value",
            "'charges_1.csv' as src_file",
            "cast(l_orderkey * 100 + l_linenumber as bigint) as raw_pid",
        ],
    ),
    "exchange_rates": (
        "lineitem",
        [
            "case when l_orderkey % 31 = 0 then '2021-02-30'"
            " when l_orderkey % 37 = 0 then replace(substr(cast(l_shipdate as string), 1, 10), '-', '/')"
            " when l_orderkey % 41 = 0 then cast(l_shipdate as string)"
            " else substr(cast(l_shipdate as string), 1, 10) end as day",
            "l_returnflag as currency",
            "case when l_orderkey % 43 = 0 then '1,05' when l_orderkey % 53 = 0 then '1.5d'"
            " when l_orderkey % 59 = 0 then '1e3' when l_orderkey % 61 = 0 then null"
            " else cast(l_quantity as string) end as rate",
            "'exchange_rates_1.csv' as src_file",
            "cast(l_orderkey * 100 + l_linenumber as bigint) as raw_pid",
        ],
    ),
    "ports": (
        "customer",
        [
            "case when c_custkey % 13 = 0 then concat('p', cast(c_custkey as string))"
            " when c_custkey % 17 = 0 then concat(cast(c_custkey as string), '.5')"
            " when c_custkey % 19 = 0 then concat(' ', cast(c_custkey as string), ' ')"
            " when c_custkey % 23 = 0 then '99999999999' when c_custkey % 29 = 0 then null"
            " else cast(c_custkey as string) end as pid",
            "concat('P', lpad(cast(c_custkey as string), 9, '0')) as code",
            "concat('c', cast(c_custkey as string)) as slug",
            "c_name as name",
            "c_mktsegment as country",
            "concat('C', cast(c_nationkey as string)) as country_code",
            "'ports_1.csv' as src_file",
            "cast(c_custkey as bigint) as raw_pid",
        ],
    ),
    "regions": (
        "customer",
        [
            "concat('c', cast(c_custkey as string)) as slug",
            "c_name as name",
            "case when c_nationkey = 0 then null else concat('n', cast(c_nationkey as string)) end as parent",
            "'regions_1.csv' as src_file",
            "cast(c_custkey as bigint) as raw_pid",
        ],
    ),
}
# The second delivery repeats every order with an earlier ``created`` and other damage.
AGAIN = _datapoints(10**12, 1, "'1990-01-01 00:00:00'", 7)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = RAW[name]
    return table(spark, sf_dir, source).selectExpr(*expressions)


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datapoints of both deliveries."""
    again = table(spark, sf_dir, "orders").selectExpr(*AGAIN)
    return raw(spark, sf_dir, "datapoints").unionByName(again)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(column: str, size: int) -> str:
    return f"cast(floor({column} / {size}.0) as bigint)"


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two roots, the regions, and the nations in two tiers."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    tops = region.filter("r_regionkey = 0").selectExpr(
        "inline(array(struct('world' as slug, 'world' as name, cast(null as string) as parent),"
        " struct('atlantis' as slug, 'atlantis' as name, cast(null as string) as parent)))"
    )
    middle = region.selectExpr("concat('r', r_regionkey) as slug", "r_name as name", "'world' as parent")
    low = nation.selectExpr(
        "concat('n', n_nationkey) as slug",
        "n_name as name",
        "case when n_nationkey < 10 then concat('r', n_regionkey)"
        " else concat('n', n_nationkey % 10) end as parent",
    )
    return tops.unionByName(middle).unionByName(low)


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``regions`` plus one district per supplier and customer below its nation."""
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "concat('s', s_suppkey) as slug", "s_name as name", "concat('n', s_nationkey) as parent"
    )
    customer = table(spark, sf_dir, "customer").selectExpr(
        "concat('c', c_custkey) as slug", "c_name as name", "concat('n', c_nationkey) as parent"
    )
    return regions(spark, sf_dir).unionByName(supplier).unionByName(customer)


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as pid",
        "concat('P', lpad(cast(n_nationkey as string), 3, '0')) as code",
        "case when n_nationkey <= 3 then concat('n', n_nationkey + 10)"
        " when n_nationkey = 4 then 'atlantis' when n_nationkey = 5 then 'r0'"
        " when n_nationkey = 6 then null else concat('n', n_nationkey) end as slug",
        "n_name as name",
        "concat('country ', n_nationkey) as country",
        "concat('C', n_nationkey) as country_code",
    )


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as k",
        "inline(array(struct('USD' as currency, cast(1.0 as double) as base),"
        " struct('EUR' as currency, cast(0.9 as double) as base),"
        " struct('CNY' as currency, cast(6.5 as double) as base)))",
    )
    return nation.filter("not (currency = 'EUR' and k % 6 = 5)").selectExpr(
        "date_add(date '2021-01-01', k) as day", "currency",
        "base * (cast(1 as double) + cast(0.001 as double) * k) as rate",
    )


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as d_id",
        "case l_returnflag when 'A' then 'EUR' when 'R' then 'CNY' else 'USD' end as currency",
        "l_extendedprice as charge_value",
    )


def datapoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One active datapoint per order; one in five has a reversed interval."""
    start = f"date_add(date '2021-01-01', cast({_part('o_orderkey', 14)} % 11 as int))"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as d_id",
        "o_orderdate as created",
        "cast(case when o_orderkey % 101 = 0 then 999 else o_orderkey % 7 end as int) as origin_pid",
        "cast(o_custkey % 5 + 3 as int) as destination_pid",
        f"{start} as valid_from",
        f"date_add({start}, cast({_part('o_orderkey', 154)} % 5 as int) - 1) as valid_to",
        "cast(o_custkey % 9 as int) as company_id",
        f"cast({_part('o_orderkey', 154)} % 3 as int) as supplier_id",
        f"cast({_part('o_orderkey', 7)} % 2 + 1 as int) as equipment_id",
        "true as is_active",
    )


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(
        datapoints=datapoints(spark, sf_dir),
        charges=charges(spark, sf_dir),
        exchange_rates=exchange_rates(spark, sf_dir),
        ports=ports(spark, sf_dir),
        regions=regions(spark, sf_dir),
    )


def wide(spark: SparkSession, sf_dir: str) -> Staging:
    """Lanes that grow with the data: every customer and supplier is a port and a region
    below its nation, and every order goes from its customer to some supplier."""
    tables = staging(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as int) as pid", "concat('P', c_custkey) as code",
        "concat('c', c_custkey) as slug", "c_name as name", "c_mktsegment as country",
        "cast(c_nationkey as string) as country_code",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey + 100000000 as int) as pid", "concat('S', s_suppkey) as code",
        "concat('s', s_suppkey) as slug", "s_name as name", "'supplier' as country",
        "cast(s_nationkey as string) as country_code",
    )
    ends = {
        "origin_pid": "cast(o_custkey as int)",
        "destination_pid": "cast(o_orderkey % 10 + 100000001 as int)",
    }
    ports_of = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as d_id", *[f"{e} as {name}" for name, e in ends.items()]
    )
    datapoints = tables.datapoints.drop(*ends).join(ports_of, "d_id")
    return replace(
        tables,
        datapoints=datapoints,
        ports=customers.unionByName(suppliers),
        regions=districts(spark, sf_dir),
    )


def with_edges(tables: Staging) -> Staging:
    """The same tables with copies, unknown regions and missing keys added."""
    edge_ports = tables.ports.filter("pid = 0").selectExpr(
        "inline(array("
        "struct(1 as pid, 'P001' as code, 'n11' as slug, 'a' as name, 'b' as country, 'c' as country_code),"
        "struct(3 as pid, 'P003' as code, 'n7' as slug, 'a' as name, 'b' as country, 'c' as country_code),"
        "struct(6 as pid, 'P006' as code, 'zzz' as slug, 'a' as name, 'b' as country, 'c' as country_code),"
        "struct(7 as pid, 'P007b' as code, 'n7' as slug, 'a' as name, 'b' as country, 'c' as country_code)))"
    )
    again = tables.exchange_rates.filter("currency = 'CNY' and day = date '2021-01-03'")
    return Staging(
        datapoints=tables.datapoints.withColumns(
            {
                "origin_pid": F.expr("case when d_id % 37 = 0 then null else origin_pid end"),
                "valid_to": F.expr("case when d_id % 41 = 0 then null else valid_to end"),
            }
        ),
        charges=tables.charges,
        exchange_rates=tables.exchange_rates.unionByName(again),
        ports=tables.ports.unionByName(edge_ports),
        regions=tables.regions,
    )
