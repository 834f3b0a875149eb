"""The same questions as ``queries``, asked directly in DuckDB SQL.

The statements take the plain route (expand, join, fan out, aggregate) and share no
operator with the Spark side; only the raw text rows use the same expressions.
"""

from __future__ import annotations

from lanewise.plans import derived
from lanewise.plans.queries import (
    DATE_TEXT,
    DOUBLE_TEXT,
    FILE_NAME,
    INTEGER_TEXT,
    TIMESTAMP_TEXT,
)
from lanewise.schemas import DATE, DOUBLE, INTEGER, TABLES, TIMESTAMP, Field, columns

TREE = """
regions(slug, name, parent) AS (
  SELECT * FROM (VALUES ('world', 'world', CAST(NULL AS VARCHAR)), ('atlantis', 'atlantis', NULL))
  UNION ALL SELECT 'r' || r_regionkey, r_name, 'world' FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name,
    CASE WHEN n_nationkey < 10 THEN 'r' || n_regionkey ELSE 'n' || (n_nationkey % 10) END FROM nation
)"""

DISTRICTS = """
tree AS (
  SELECT * FROM regions
  UNION ALL SELECT 's' || s_suppkey, s_name, 'n' || s_nationkey FROM supplier
  UNION ALL SELECT 'c' || c_custkey, c_name, 'n' || c_nationkey FROM customer
)"""


def up(tree: str) -> str:
    """Every proper ancestor with its level, and the set with the roots themselves."""
    return f"""
up AS (
  SELECT slug, parent AS ancestor, 1 AS level FROM {tree} WHERE parent IS NOT NULL
  UNION ALL
  SELECT up.slug, t.parent, up.level + 1 FROM up JOIN {tree} t ON t.slug = up.ancestor
  WHERE t.parent IS NOT NULL
),
ancestors AS (
  SELECT DISTINCT slug, ancestor FROM
    (SELECT slug, ancestor FROM up UNION ALL SELECT slug, slug FROM {tree} WHERE parent IS NULL)
)"""


START = "DATE '2021-01-01' + CAST(CAST(floor(o_orderkey / 14.0) AS BIGINT) % 11 AS INTEGER)"
LENGTH = "CAST(CAST(floor(o_orderkey / 154.0) AS BIGINT) % 5 AS INTEGER) - 1"


def fixture(edges: bool = False, wide: bool = False) -> str:
    origin = "CASE WHEN o_orderkey % 101 = 0 THEN 999 ELSE o_orderkey % 7 END"
    end = f"{START} + ({LENGTH})"
    more_ports = more_rates = ""
    destination = "o_custkey % 5 + 3"
    ports = f"""SELECT n_nationkey, 'P' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0'),
    CASE WHEN n_nationkey <= 3 THEN 'n' || (n_nationkey + 10) WHEN n_nationkey = 4 THEN 'atlantis'
         WHEN n_nationkey = 5 THEN 'r0' WHEN n_nationkey = 6 THEN NULL ELSE 'n' || n_nationkey END
  FROM nation"""
    if wide:
        origin, destination = "o_custkey", "o_orderkey % 10 + 100000001"
        ports = (
            "SELECT c_custkey, 'P' || c_custkey, 'c' || c_custkey FROM customer UNION ALL"
            " SELECT s_suppkey + 100000000, 'S' || s_suppkey, 's' || s_suppkey FROM supplier"
        )
    if edges:
        origin = f"CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE {origin} END"
        end = f"CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE {end} END"
        more_ports = (
            "UNION ALL SELECT * FROM (VALUES (1, 'P001', 'n11'), (3, 'P003', 'n7'),"
            " (6, 'P006', 'zzz'), (7, 'P007b', 'n7'))"
        )
        more_rates = "UNION ALL SELECT DATE '2021-01-03', 'CNY', 6.5 * (1.0::DOUBLE + 0.001::DOUBLE * 2)"
    return f"""
{TREE},
ports(pid, code, slug) AS (
  {ports} {more_ports}
),
exchange_rates(day, currency, rate) AS (
  SELECT DATE '2021-01-01' + n_nationkey, currency, base * (1.0::DOUBLE + 0.001::DOUBLE * n_nationkey)
  FROM nation, (VALUES ('USD', 1.0::DOUBLE), ('EUR', 0.9::DOUBLE), ('CNY', 6.5::DOUBLE)) b(currency, base)
  WHERE NOT (currency = 'EUR' AND n_nationkey % 6 = 5) {more_rates}
),
charges(d_id, currency, charge_value) AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'EUR' WHEN 'R' THEN 'CNY' ELSE 'USD' END,
    l_extendedprice FROM lineitem
),
datapoints AS (
  SELECT o_orderkey AS d_id, CAST({origin} AS INTEGER) AS origin_pid,
    CAST({destination} AS INTEGER) AS destination_pid, CAST(o_custkey % 9 AS INTEGER) AS company_id,
    CAST(CAST(floor(o_orderkey / 154.0) AS BIGINT) % 3 AS INTEGER) AS supplier_id,
    CAST(CAST(floor(o_orderkey / 7.0) AS BIGINT) % 2 + 1 AS INTEGER) AS equipment_id,
    CAST({START} AS DATE) AS valid_from, CAST({end} AS DATE) AS valid_to
  FROM orders
),
days AS (
  SELECT d_id, origin_pid, destination_pid, company_id, supplier_id, equipment_id,
    CAST(unnest(generate_series(valid_from,
      greatest(valid_from, coalesce(valid_to, valid_from)), INTERVAL 1 DAY)) AS DATE) AS date
  FROM datapoints
)"""


# The long way: charges, rates, ports and ancestors per datapoint-day, then sums.
FAN = """
related AS (SELECT slug AS a, ancestor AS b FROM ancestors UNION SELECT ancestor, slug FROM ancestors),
fan AS (
  SELECT d.*, c.charge_value / nullif(r.rate, 0) AS term,
    ao.slug AS origin_region, ao.ancestor AS origin_ancestor,
    ad.slug AS destination_region, ad.ancestor AS destination_ancestor
  FROM days d
  LEFT JOIN charges c USING (d_id)
  LEFT JOIN exchange_rates r ON (r.day, r.currency) = (d.date, c.currency)
  LEFT JOIN ports po ON po.pid = d.origin_pid LEFT JOIN ancestors ao ON ao.slug = po.slug
  LEFT JOIN ports pd ON pd.pid = d.destination_pid LEFT JOIN ancestors ad ON ad.slug = pd.slug
),
region_cost AS (
  SELECT d_id, origin_pid, destination_pid, company_id, supplier_id, equipment_id, date,
    origin_region, origin_ancestor, destination_region, destination_ancestor, sum(term) AS cost
  FROM fan ANTI JOIN related ON fan.origin_ancestor = related.a AND fan.destination_ancestor = related.b
  GROUP BY ALL
)"""

PORT_COST = """
port_cost AS (
  SELECT d.d_id, po.code AS origin, pd.code AS destination, d.company_id, d.supplier_id,
    d.equipment_id, d.date, sum(c.charge_value / nullif(r.rate, 0)) AS cost
  FROM days d LEFT JOIN charges c USING (d_id)
  LEFT JOIN exchange_rates r ON (r.day, r.currency) = (d.date, c.currency)
  LEFT JOIN ports po ON po.pid = d.origin_pid LEFT JOIN ports pd ON pd.pid = d.destination_pid
  GROUP BY ALL
)"""

LANE_ROWS = """
lane_rows AS (
  SELECT grain, CASE grain WHEN 1 THEN origin_region ELSE origin_ancestor END AS origin,
    CASE grain WHEN 2 THEN destination_region ELSE destination_ancestor END AS destination,
    equipment_id, date, supplier_id, company_id, cost
  FROM region_cost, (VALUES (1), (2), (3)) g(grain)
  UNION ALL
  SELECT 0, origin, destination, equipment_id, date, supplier_id, company_id, cost FROM port_cost
)"""

LANE_STATS = """
lane_stats AS (
  SELECT grain, origin, destination, equipment_id, date,
    round(median(cost), 2) AS med_cost, round(avg(cost), 2) AS avg_cost,
    count(DISTINCT supplier_id) AS supplier_cnt, count(DISTINCT company_id) AS company_cnt
  FROM lane_rows GROUP BY ALL
),
published AS (
  SELECT grain = 0 AS between_ports, origin, destination, equipment_id, date, med_cost, avg_cost,
    CAST(supplier_cnt >= 2 AND company_cnt >= 5 AS INTEGER) AS dq_ok
  FROM (SELECT DISTINCT least(grain, 1) AS grain, * EXCLUDE (grain) FROM lane_stats)
)"""


def staged_sql(select: str, *parts: str, edges: bool = False) -> str:
    return "WITH RECURSIVE " + ",\n".join([fixture(edges), *parts]) + "\n" + select


def lanes_sql(select: str, edges: bool = False) -> str:
    parts = [up("regions"), FAN, PORT_COST, LANE_ROWS, LANE_STATS]
    return staged_sql(select, *parts, edges=edges)


def tree_sql(select: str, *parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([TREE, DISTRICTS, up("tree"), *parts]) + "\n" + select


# Text checks


def parsed(field: Field, to: str | None = None) -> str:
    """The typed value of a text column, NULL where the text is not acceptable."""
    x = field.name
    if field.rule == INTEGER:
        kind = to or ("BIGINT" if field.type.typeName() == "long" else "INTEGER")
        return (
            f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?[0-9]+\\s*')"
            f" THEN TRY_CAST(ltrim(trim({x}), '+') AS {kind}) END"
        )
    if field.rule == DOUBLE:
        return (
            f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*')"
            f" THEN TRY_CAST(trim({x}) AS DOUBLE)"
            f" WHEN regexp_full_match(lower(trim({x})), '[+-]?(nan|inf|infinity)') THEN 'nan'::DOUBLE END"
        )
    if field.rule == DATE:
        return (
            f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')"
            f" AND {x} NOT LIKE '0000%' THEN TRY_CAST({x} AS DATE) END"
        )
    if field.rule == TIMESTAMP:
        return (
            f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}} "
            f"[0-9]{{1,2}}:[0-9]{{1,2}}:[0-5]?[0-9]([.][0-9]{{1,6}})?')"
            f" AND {x} NOT LIKE '0000%' THEN TRY_CAST({x} AS TIMESTAMP) END"
        )
    return x


def raw_sql(table: str) -> str:
    source, expressions = derived.RAW[table]
    return f"SELECT {', '.join(expressions)} FROM {source}"


BOTH_DELIVERIES = (
    f"{raw_sql('datapoints')} UNION ALL SELECT {', '.join(derived.AGAIN)} FROM orders"
)


def failed(table: str) -> str:
    checks = [
        f"CASE WHEN {parsed(f)} IS NULL THEN '{f.name}' END" for f in TABLES[table] if f.rule
    ]
    return f"concat_ws(',', {', '.join(checks)})" if checks else "''"


def validate_sql(table: str) -> str:
    why = failed(table)
    return f"WITH raw AS ({raw_sql(table)}) SELECT raw_pid, {why} = '' AS ok, {why} AS failed_columns FROM raw"


def typed_sql(table: str, rows: str) -> str:
    values = ", ".join(f"{parsed(f)} AS {f.name}" for f in TABLES[table])
    return f"SELECT {values}, raw_pid FROM ({rows}) raw WHERE {failed(table)} = ''"


def texts_sql(text: str, values: str) -> str:
    return (
        f"WITH t AS (SELECT l_orderkey, l_linenumber, {text} AS text FROM lineitem)"
        f" SELECT l_orderkey, l_linenumber, text, {values} FROM t"
    )


def as_field(rule: str) -> Field:
    return Field("text", TABLES["datapoints"][0].type, rule)


ACCEPTED = f"WITH accepted AS ({typed_sql('datapoints', BOTH_DELIVERIES)})"
MART = "origin, destination, equipment_id, date, med_cost, avg_cost, dq_ok"
LANE = "grain, origin, destination, equipment_id, date"

ORACLE: dict[str, str] = {
    "route_files": f"""
WITH f AS (SELECT {FILE_NAME} AS file_name FROM orders)
SELECT file_name, CASE WHEN NOT suffix(file_name, '.csv') THEN 'unrouted'
  WHEN instr(file_name, 'regions') > 0 THEN 'regions' WHEN instr(file_name, 'ports') > 0 THEN 'ports'
  WHEN instr(file_name, 'exchange_rates') > 0 THEN 'exchange_rates'
  WHEN instr(file_name, 'charges') > 0 THEN 'charges'
  WHEN instr(file_name, 'datapoints') > 0 THEN 'datapoints' ELSE 'unrouted' END AS table_name FROM f""",
    "raw_project": f"SELECT slug, name, parent FROM ({raw_sql('regions')})",
    "raw_audit": f"""
SELECT d_id, currency, charge_value, 'lineitem.parquet' AS src_file, 'NEW' AS stg_status,
  CAST(NULL AS TIMESTAMP) AS stg_load_time, raw_pid FROM ({raw_sql('charges')})""",
    "raw_key": "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS raw_pid FROM orders",
    "pending_scan": f"""
SELECT {', '.join(columns('datapoints'))}, raw_pid FROM ({raw_sql('datapoints')}) WHERE stg_status = 'NEW'""",
    "valid_int": texts_sql(
        INTEGER_TEXT,
        f"{parsed(as_field(INTEGER), 'BIGINT')} AS as_bigint, {parsed(as_field(INTEGER), 'INTEGER')} AS as_int",
    ),
    "valid_double": texts_sql(
        DOUBLE_TEXT,
        f"({parsed(as_field(DOUBLE))}) IS NOT NULL AS ok,"
        f" CASE WHEN isfinite({parsed(as_field(DOUBLE))}) THEN {parsed(as_field(DOUBLE))} END AS finite_value",
    ),
    "valid_date": texts_sql(DATE_TEXT, f"{parsed(as_field(DATE))} AS value"),
    "valid_timestamp": texts_sql(TIMESTAMP_TEXT, f"{parsed(as_field(TIMESTAMP))} AS value"),
    **{f"validate_{t}": validate_sql(t) for t in TABLES},
    **{f"stage_{t}": typed_sql(t, raw_sql(t)) for t in TABLES},
    "load_order_versions": (
        "WITH rows AS (SELECT o_custkey AS d_id, CAST(o_orderkey % 3 AS BIGINT) AS batch_id,"
        " CAST(floor(o_orderkey / 3.0) % 5 AS INTEGER) AS file_rank,"
        " CAST(o_orderkey * 7919 % 1000003 * 100000000 + o_orderkey AS BIGINT) AS raw_pid"
        " FROM orders)"
        " SELECT *, row_number() OVER (PARTITION BY d_id"
        " ORDER BY batch_id DESC, file_rank DESC, raw_pid DESC) = 1 AS is_active FROM rows"
    ),
    "datapoint_versions": f"""{ACCEPTED}
SELECT raw_pid, d_id, created, supplier_id,
  row_number() OVER (PARTITION BY d_id ORDER BY raw_pid DESC) = 1 AS is_active FROM accepted""",
    "active_datapoints": f"""{ACCEPTED}
SELECT * FROM accepted QUALIFY row_number() OVER (PARTITION BY d_id ORDER BY raw_pid DESC) = 1""",
    "row_status": f"""
SELECT raw_pid, d_id, src_file = 'datapoints_0.csv' AS tried,
  CASE WHEN src_file <> 'datapoints_0.csv' THEN 'NEW' WHEN {failed('datapoints')} = '' THEN 'LOADED'
       ELSE 'ERROR' END AS stg_status
FROM ({BOTH_DELIVERIES})""",
    "quarantine": f"""
SELECT {', '.join(columns('datapoints'))}, src_file, raw_pid, {failed('datapoints')} AS failed_columns
FROM ({BOTH_DELIVERIES}) WHERE {failed('datapoints')} <> ''""",
    "lane_project": staged_sql("""
SELECT d.d_id, po.code AS origin, pd.code AS destination, d.equipment_id, d.valid_from AS date
FROM datapoints d LEFT JOIN ports po ON po.pid = d.origin_pid LEFT JOIN ports pd ON pd.pid = d.destination_pid"""),
    "region_roots": tree_sql("SELECT slug, parent IS NULL AS is_root FROM tree"),
    "dq_flag": staged_sql("""
SELECT po.code AS origin, pd.code AS destination, equipment_id, date,
  count(DISTINCT supplier_id) AS supplier_cnt, count(DISTINCT company_id) AS company_cnt,
  CAST(count(DISTINCT supplier_id) >= 2 AND count(DISTINCT company_id) >= 5 AS INTEGER) AS dq_ok
FROM days d LEFT JOIN ports po ON po.pid = d.origin_pid LEFT JOIN ports pd ON pd.pid = d.destination_pid
GROUP BY ALL"""),
    "convert_charges": staged_sql("""
SELECT c.d_id, c.currency, c.date, c.charge_value,
  round(c.charge_value / nullif(CASE WHEN r.currency = 'CNY' AND r.day = DATE '2021-01-03' THEN 0
    ELSE r.rate END, 0), 4) AS converted
FROM (SELECT *, DATE '2021-01-01' + CAST(d_id % 30 AS INTEGER) AS date FROM charges) c
LEFT JOIN exchange_rates r ON r.currency = c.currency AND r.day = c.date"""),
    "round_parity": """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 8.0, 2) AS eighth,
  round(CAST(l_orderkey AS DOUBLE) / 1000.0::DOUBLE, 2) AS thousandth,
  round(l_extendedprice * l_discount, 2) AS discount FROM lineitem""",
    "daily_datapoints": staged_sql("SELECT d_id, date FROM days", edges=True),
    "daily_datapoints_clipped": staged_sql(
        "SELECT d_id, date FROM days WHERE date BETWEEN DATE '2021-01-04' AND DATE '2021-01-08'",
        edges=True,
    ),
    "region_closure": tree_sql("SELECT slug, ancestor AS parent_slug, ancestor, level FROM up"),
    "region_ancestors": tree_sql("SELECT slug, ancestor FROM ancestors"),
    "unrelated_regions": tree_sql(
        """
SELECT slug, other, ancestor, other_ancestor FROM
  (SELECT p.slug, p.other, a.ancestor, b.ancestor AS other_ancestor FROM pairs p
   JOIN ancestors a ON a.slug = p.slug JOIN ancestors b ON b.slug = p.other) x
WHERE NOT EXISTS (SELECT 1 FROM ancestors r WHERE r.slug = x.ancestor AND r.ancestor = x.other_ancestor)
  AND NOT EXISTS (SELECT 1 FROM ancestors r WHERE r.slug = x.other_ancestor AND r.ancestor = x.ancestor)""",
        """
pairs AS (
  SELECT DISTINCT 's' || l_suppkey AS slug, 'n' || c_nationkey AS other
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
)""",
    ),
    "join_charges": staged_sql(
        "SELECT d_id, date, currency, charge_value FROM (SELECT d_id, date FROM days) LEFT JOIN charges USING (d_id)"
    ),
    "join_rates": staged_sql(
        """
SELECT d.d_id, d.date, c.currency, c.charge_value, round(r.rate, 6) AS rate
FROM days d LEFT JOIN charges c USING (d_id)
LEFT JOIN exchange_rates r ON r.currency = c.currency AND r.day = d.date""",
        edges=True,
    ),
    "join_ports": staged_sql(
        """
SELECT d_id, origin_pid, destination_pid, po.code AS origin_code, po.slug AS origin_slug,
  pd.code AS destination_code, pd.slug AS destination_slug
FROM datapoints d LEFT JOIN ports po ON po.pid = d.origin_pid LEFT JOIN ports pd ON pd.pid = d.destination_pid""",
        edges=True,
    ),
    "region_lanes": staged_sql(
        """
SELECT origin_pid, destination_pid, grain, origin, destination, copies,
  (SELECT count(*) FROM datapoints d WHERE d.origin_pid IS NOT DISTINCT FROM x.origin_pid
     AND d.destination_pid IS NOT DISTINCT FROM x.destination_pid) AS datapoints
FROM (
  SELECT DISTINCT origin_pid, destination_pid, grain, s, t, copies,
    CASE grain WHEN 1 THEN s ELSE a END AS origin, CASE grain WHEN 2 THEN t ELSE b END AS destination
  FROM kept, (VALUES (1), (2), (3)) g(grain)
  UNION ALL
  SELECT origin_pid, destination_pid, 0, NULL, NULL, count(*), po.code, pd.code
  FROM used LEFT JOIN ports po ON po.pid = origin_pid LEFT JOIN ports pd ON pd.pid = destination_pid
  GROUP BY ALL
) x""",
        up("regions"),
        """
related AS (SELECT slug AS a, ancestor AS b FROM ancestors UNION SELECT ancestor, slug FROM ancestors),
used AS (SELECT DISTINCT origin_pid, destination_pid FROM datapoints),
combos AS (
  SELECT origin_pid, destination_pid, ao.slug AS s, ao.ancestor AS a, ad.slug AS t, ad.ancestor AS b,
    count(*) AS copies
  FROM used LEFT JOIN ports po ON po.pid = origin_pid LEFT JOIN ancestors ao ON ao.slug = po.slug
  LEFT JOIN ports pd ON pd.pid = destination_pid LEFT JOIN ancestors ad ON ad.slug = pd.slug
  GROUP BY ALL
),
kept AS (SELECT * FROM combos ANTI JOIN related ON combos.a = related.a AND combos.b = related.b)""",
        edges=True,
    ),
    "datapoint_cost": staged_sql(
        "SELECT * EXCLUDE (cost), round(cost, 4) AS cost FROM region_cost", up("regions"), FAN, edges=True
    ),
    "datapoint_cost_ports": staged_sql(
        "SELECT * EXCLUDE (cost), round(cost, 4) AS cost FROM port_cost", PORT_COST, edges=True
    ),
    "lane_median": lanes_sql(f"SELECT {LANE}, med_cost FROM lane_stats"),
    "lane_median_large_groups": lanes_sql(f"SELECT {LANE}, med_cost, avg_cost FROM lane_stats"),
    "crowded_median": (
        "SELECT lane, round(median(price), 2) AS med_cost, round(avg(price), 2) AS avg_cost FROM ("
        "SELECT CASE WHEN l_orderkey % 10 < 8 THEN 'crowded' ELSE l_returnflag END AS lane,"
        " l_extendedprice * (1 - l_discount) AS price FROM lineitem) GROUP BY lane"
    ),
    "lane_avg": lanes_sql(f"SELECT {LANE}, avg_cost FROM lane_stats"),
    "lane_coverage": lanes_sql(f"SELECT {LANE}, supplier_cnt, company_cnt FROM lane_stats"),
    "lane_prices_regions": lanes_sql(f"SELECT {MART} FROM published WHERE NOT between_ports"),
    "lane_prices_regions_sorted": lanes_sql(
        f"SELECT {MART} FROM published WHERE NOT between_ports"
        " ORDER BY origin NULLS LAST, destination NULLS LAST, equipment_id NULLS LAST, date NULLS LAST"
    ),
    "lane_prices_regions_edges": lanes_sql(
        f"SELECT {MART} FROM published WHERE NOT between_ports", edges=True
    ),
    "lane_prices_regions_wide": (
        "WITH RECURSIVE "
        + ",\n".join(
            [fixture(wide=True), DISTRICTS, up("tree"), FAN, PORT_COST, LANE_ROWS, LANE_STATS]
        )
        + f"\nSELECT {MART} FROM published WHERE NOT between_ports"
    ),
    "lane_prices_ports": lanes_sql(f"SELECT {MART} FROM published WHERE between_ports"),
    "prices_ds": lanes_sql(f"SELECT {MART} FROM published"),
    "prices": lanes_sql(f"SELECT {MART} FROM published WHERE dq_ok = 1"),
    "prices_clipped": lanes_sql(
        f"SELECT {MART} FROM published WHERE dq_ok = 1"
        " AND date BETWEEN DATE '2021-01-04' AND DATE '2021-01-07'"
    ),
}
