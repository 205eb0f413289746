"""The same answers as plain SQL over the test tables, for another engine to compute."""

from __future__ import annotations

from saleslake.plans.trial_queries import CUT, IDS_OF_OBJECT, NEXT_RUN_TS, NOTE, NOW, RUN_TS

_RAW = """
raw_sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS customer_id, l_suppkey AS employee_id,
         l_partkey AS product_id,
         CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS amount_paid,
         o_orderdate AS transaction_date, l_shipdate AS loaded_at
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
)"""

_FACT = f"""{_RAW},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY loaded_at DESC, product_id DESC, employee_id DESC, amount_paid DESC) AS rn
  FROM raw_sales
),
fact_sales AS (
  SELECT id, customer_id, employee_id, product_id, amount_paid, transaction_date
  FROM ranked WHERE rn = 1
)"""

# Load runs have one load time each, so versions of a sale within a run are ranked by value.
_LAKE_FACT = f"""{_RAW},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY loaded_at >= TIMESTAMP '{CUT}' DESC, transaction_date DESC, product_id DESC,
      employee_id DESC, customer_id DESC, amount_paid DESC) AS rn
  FROM raw_sales
),
fact_sales AS (
  SELECT id, customer_id, employee_id, product_id, amount_paid, transaction_date
  FROM ranked WHERE rn = 1
)"""

_FACT_OUT = """id, customer_id, employee_id, product_id, CAST(amount_paid AS DOUBLE) AS amount_paid,
  transaction_date"""

_DIMS = """
dim_customer AS (SELECT c_custkey AS id, c_name AS first_name FROM customer),
dim_employee AS (SELECT s_suppkey AS id, substr(s_name, 1, 8) AS first_name, substr(s_name, 10) AS last_name
  FROM supplier),
dim_product AS (SELECT p_partkey AS id, p_name AS name FROM part)"""

_DAILY = """
SELECT CAST(transaction_date AS DATE) AS sales_date,
       count(*) AS n_transactions,
       CAST(sum(amount_paid) AS DOUBLE) AS total_amount,
       CAST(sum(amount_paid) AS DOUBLE) / count(*) AS avg_amount,
       CAST(min(amount_paid) AS DOUBLE) AS min_amount,
       CAST(max(amount_paid) AS DOUBLE) AS max_amount,
       count(DISTINCT customer_id) AS n_customers,
       count(DISTINCT employee_id) AS n_employees,
       count(DISTINCT product_id) AS n_products
FROM fact_sales WHERE transaction_date IS NOT NULL GROUP BY 1"""

# table, column of every declared null check
_NOT_NULL = [
    ("raw_sales", "id"),
    ("raw_sales", "amount_paid"),
    ("raw_sales", "product_id"),
    ("dim_customer", "id"),
    ("dim_employee", "id"),
    ("dim_employee", "first_name"),
    ("dim_employee", "last_name"),
    ("dim_product", "id"),
    ("dim_product", "name"),
    ("fact_sales", "id"),
    ("fact_sales", "customer_id"),
    ("fact_sales", "employee_id"),
    ("fact_sales", "product_id"),
    ("fact_sales", "amount_paid"),
]
_KEYED = ("dim_customer", "dim_employee", "dim_product", "fact_sales")


def _not_null_lines() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM {t} WHERE {c} IS NULL"
        for t, c in _NOT_NULL
    )


def _report_lines() -> str:
    lines = [
        f"SELECT 'not_null' AS check_name, '{t}' AS table_name, '{c}' AS column_name, count(*) AS failures "
        f"FROM {t} WHERE {c} IS NULL"
        for t, c in _NOT_NULL
    ]
    lines += [
        f"SELECT 'unique', '{t}', 'id', count(*) FROM "
        f"(SELECT id FROM {t} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"
        for t in _KEYED
    ]
    lines.append("SELECT 'positive', 'raw_sales', 'amount_paid', count(*) FROM raw_sales WHERE amount_paid <= 0")
    lines.append(
        "SELECT 'dated', 'fact_sales', 'transaction_date', count(*) FROM fact_sales WHERE transaction_date IS NULL"
    )
    return " UNION ALL ".join(lines)


def _freshness(warn_seconds: int, error_seconds: int) -> str:
    return f"""
SELECT last_loaded_at, age_seconds,
       CASE WHEN age_seconds <= {warn_seconds} THEN 'pass'
            WHEN age_seconds <= {error_seconds} THEN 'warn' ELSE 'error' END AS status
FROM (SELECT max(ts) AS last_loaded_at,
             CAST(floor(epoch(TIMESTAMP '{NOW}') - epoch(max(ts))) AS BIGINT) AS age_seconds
      FROM events)"""


_LINE_TEXT = "strftime(transaction_date, '%Y-%m-%dT%H:%M:%S') AS transaction_date"
_LANDED = f"""id, customer_id, employee_id, product_id, CAST(amount_paid AS DOUBLE) AS amount_paid,
  {_LINE_TEXT}"""
_FIRST, _SECOND = (f"TIMESTAMP '{ts:%Y-%m-%d %H:%M:%S}'" for ts in (RUN_TS, NEXT_RUN_TS))
_YEAR_DAY = "strftime(date_trunc('year', l_shipdate), '%Y-%m-%d')"

ORACLE_SQL: dict[str, str] = {
    "daily_sales_summary": f"WITH {_FACT} {_DAILY}",
    "fact_sales": f"WITH {_FACT} SELECT {_FACT_OUT} FROM fact_sales",
    "fact_sales_incremental": f"WITH {_FACT} SELECT {_FACT_OUT} FROM fact_sales",
    "dim_customer": f"WITH {_DIMS} SELECT * FROM dim_customer",
    "dim_employee": f"WITH {_DIMS} SELECT * FROM dim_employee",
    "dim_product": f"WITH {_DIMS} SELECT * FROM dim_product",
    "sales_enriched": f"""WITH {_FACT}, {_DIMS}
SELECT f.id, f.customer_id, f.employee_id, f.product_id, CAST(f.amount_paid AS DOUBLE) AS amount_paid,
       f.transaction_date, c.first_name AS customer_name, e.first_name AS employee_first_name,
       e.last_name AS employee_last_name, p.name AS product_name
FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_id = c.id
  LEFT JOIN dim_employee e ON f.employee_id = e.id LEFT JOIN dim_product p ON f.product_id = p.id""",
    "latest_batch": f"""WITH {_RAW} SELECT {_FACT_OUT}, loaded_at FROM raw_sales
WHERE loaded_at = (SELECT max(loaded_at) FROM raw_sales)""",
    "undo_last_batch": f"""WITH {_RAW} SELECT {_FACT_OUT}, loaded_at FROM raw_sales
WHERE loaded_at < (SELECT max(loaded_at) FROM raw_sales)""",
    "head_150": f"""WITH {_RAW} SELECT {_FACT_OUT}, loaded_at FROM (
  SELECT * FROM raw_sales ORDER BY id, loaded_at, product_id, employee_id, amount_paid LIMIT 150)""",
    "dq_not_null": f"WITH {_FACT}, {_DIMS} {_not_null_lines()}",
    "dq_unique": f"""WITH {_RAW} SELECT id, count(*) AS n_rows FROM raw_sales
WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""",
    "dq_non_positive_amount": "SELECT c_custkey AS id FROM customer WHERE c_acctbal <= 0",
    "dq_report": f"""WITH {_FACT}, {_DIMS}
SELECT check_name, table_name, column_name, failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_report_lines()})""",
    "freshness": _freshness(3600, 2 * 86400),
    "freshness_default": _freshness(2 * 86400, 3 * 86400),
    "tz_shift": "SELECT o_orderkey, o_orderdate + INTERVAL 1 HOUR AS shifted FROM orders",
    "parse_transaction_date": """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%-m/%-d/%Y')
                          WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                          WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END
         || CASE WHEN o_orderpriority = '1-URGENT' THEN '?' ELSE '' END AS date_text,
       CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderstatus IN ('F', 'O', 'P')
            THEN CAST(o_orderdate AS DATE) END AS sales_date
FROM orders""",
    "landing_manifest": f"SELECT DISTINCT {_YEAR_DAY} AS batch_day, true AS has_data FROM lineitem",
    "landing_day_replace": f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS product_id, {_YEAR_DAY} AS ingest_date
FROM lineitem
WHERE l_returnflag = 'R' OR {_YEAR_DAY} <> (SELECT max({_YEAR_DAY}) FROM lineitem)""",
    "bronze_sales": f"WITH {_RAW} SELECT {_LANDED}, {_FIRST} AS loaded_at FROM raw_sales",
    "csv_landing": f"WITH {_RAW} SELECT {_LANDED} FROM raw_sales",
    "named_ingest": f"WITH {_RAW} SELECT {_LANDED} FROM raw_sales",
    "bronze_undo": f"""WITH {_RAW} SELECT {_LANDED}, {_FIRST} AS loaded_at FROM raw_sales
WHERE loaded_at < TIMESTAMP '{CUT}'""",
    "seed_customer": f"WITH {_DIMS} SELECT * FROM dim_customer",
    "stream_pickup": f"""WITH {_RAW} SELECT {_LANDED},
  CASE WHEN loaded_at < TIMESTAMP '{CUT}' THEN {_FIRST} ELSE {_SECOND} END AS loaded_at FROM raw_sales""",
    "lake_fact_sales": f"""WITH {_LAKE_FACT}
SELECT id, customer_id, employee_id, product_id, CAST(amount_paid AS DOUBLE) AS amount_paid,
       CAST(transaction_date AS DATE) AS sales_date FROM fact_sales""",
    "lake_daily_sales": f"WITH {_LAKE_FACT} {_DAILY}",
    "lake_dim_customer": """
SELECT c_custkey AS id, CASE WHEN c_acctbal > 5000 THEN c_name ELSE c_name || ' of old' END AS first_name
FROM customer""",
    "lake_dim_employee": f"""WITH {_DIMS}
SELECT id, first_name, CASE WHEN id % 3 = 0 THEN last_name ELSE last_name || ' of old' END AS last_name FROM dim_employee""",
    "lake_dim_product": f"""WITH {_DIMS}
SELECT id, CASE WHEN name LIKE '%a%' THEN name ELSE name || ' of old' END AS name FROM dim_product""",
    "silver_without_gold": f"""WITH {_RAW},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY transaction_date DESC, product_id DESC, employee_id DESC, customer_id DESC,
      amount_paid DESC) AS rn
  FROM raw_sales WHERE loaded_at < TIMESTAMP '{CUT}'
),
fact_sales AS (SELECT * FROM ranked WHERE rn = 1) {_DAILY}""",
    "purged_and_loaded_again": f"""WITH {_RAW} SELECT {_LANDED}, {_SECOND} AS loaded_at FROM raw_sales
WHERE NOT loaded_at < TIMESTAMP '{CUT}'""",
    "lake_checks": f"""WITH {_LAKE_FACT}, {_DIMS}
SELECT check_name, table_name, column_name, failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_report_lines()})""",
    "latest_object_ingest": f"""WITH {_RAW} SELECT {_LANDED},
  '{{"decade":"' || substr(CAST(transaction_date AS VARCHAR), 1, 3) || '"}}' AS other_attributes, TRUE AS stamped
FROM raw_sales WHERE id // {IDS_OF_OBJECT} = (SELECT max(id // {IDS_OF_OBJECT}) FROM raw_sales)""",
    "same_run_two_sources": f"WITH {_RAW} SELECT {_LANDED} FROM raw_sales",
    "csv_ingest": f"WITH {_RAW} SELECT {_LANDED} FROM raw_sales",
    "undo_in_pieces": f"""WITH {_RAW} SELECT {_LANDED}, {_FIRST} AS loaded_at FROM raw_sales
WHERE loaded_at < TIMESTAMP '{CUT}'""",
    "reingest_after_undo": f"WITH {_RAW} SELECT {_LANDED}, {_FIRST} AS loaded_at FROM raw_sales",
    "checks_with_a_missing_table": f"""WITH {_LAKE_FACT}, {_DIMS}
SELECT check_name, table_name, column_name,
       CASE WHEN table_name NOT LIKE 'dim%' THEN failures END AS failures,
       CASE WHEN table_name NOT LIKE 'dim%' AND failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({_report_lines()})""",
    "empty_object_once": f"""WITH {_RAW}
SELECT count(DISTINCT id // {IDS_OF_OBJECT}) + 1 AS n_files, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM raw_sales""",
    "arrays_in_blocks": f"WITH {_RAW} SELECT {_LANDED}, '{NOTE}' AS note, TRUE AS fits FROM raw_sales",
    "pick_up_after_undo": f"""WITH {_RAW} SELECT {_LANDED},
  CASE WHEN loaded_at < TIMESTAMP '{CUT}' THEN {_FIRST} ELSE {_SECOND} END AS loaded_at FROM raw_sales""",
    "lake_freshness": f"""WITH {_RAW}
SELECT max({_FIRST}) AS last_loaded_at, CAST(10800 AS BIGINT) AS age_seconds, 'warn' AS status
FROM raw_sales WHERE loaded_at < TIMESTAMP '{CUT}'""",
}
# The second run of these is undone, or left out of gold; or comes first, but still counts as the later one.
ORACLE_SQL["undo_reaches_gold"] = ORACLE_SQL["silver_without_gold"]
ORACLE_SQL["gold_counted_on"] = ORACLE_SQL["lake_daily_sales"]
ORACLE_SQL["late_run"] = ORACLE_SQL["lake_fact_sales"]
