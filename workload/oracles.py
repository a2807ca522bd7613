"""SQL counterparts of the registered queries, over the same tables."""

from __future__ import annotations

from workload import bindings as b

ORACLES: dict[str, str] = {}


def ratio(num: str, den: str, digits: int = 2, times: int = 1) -> str:
    """Half away from zero, on whole numbers."""
    factor = times * 10**digits
    den = f"nullif(abs(CAST({den} AS HUGEINT)), 0)"
    whole = f"(2 * {factor} * abs(CAST({num} AS HUGEINT)) + {den}) // (2 * {den})"
    return f"(CASE WHEN ({num}) < 0 THEN -1.0 ELSE 1.0 END * CAST({whole} AS DOUBLE) / CAST({10**digits} AS DOUBLE) + 0.0)"


def percent(num: str, den: str, digits: int = 2) -> str:
    return ratio(num, den, digits, 100)


def half_even_percent(num: str, den: str) -> str:
    top, den = f"(CAST({num} AS HUGEINT) * 1000000)", f"nullif(CAST({den} AS HUGEINT), 0)"
    below, rest = f"({top} // {den})", f"(2 * ({top} % {den}))"
    up = f"CASE WHEN {rest} > {den} OR ({rest} = {den} AND {below} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CAST({below} + {up} AS DOUBLE) / 10000.0)"


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100.0)"


# Datasets, as the bindings derive them. Amounts are whole cents.
SALES = """
so AS (
  SELECT o_orderkey, o_custkey AS customer_key, 'SO' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         o_orderstatus AS currency, replace(replace(upper(o_orderpriority), '-', '_'), ' ', '_') AS category
  FROM orders)"""
CUSTOMERS = f"""
cu AS (
  SELECT c_custkey AS customer_key, 'C' || c_custkey AS customer_id, c_name AS customer_name,
         c_mktsegment AS segment, CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
         coalesce(first_day, DATE '{b.FIRST_DAY}') AS created_date
  FROM customer LEFT JOIN (
    SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY o_custkey) f
  ON o_custkey = c_custkey)"""
CONTROLS = f"""
gl AS (
  SELECT order_date AS control_date, category AS source_system, currency, count(*) AS order_count,
         CAST(sum(cents) AS BIGINT) AS cents
  FROM so WHERE cents < {b.SOURCE_CEILING} * 100 GROUP BY ALL)"""
ALL_CONTROLS = """
gl AS (
  SELECT order_date AS control_date, category AS source_system, currency, count(*) AS order_count,
         CAST(sum(cents) AS BIGINT) AS cents
  FROM so GROUP BY ALL)"""
KEYS = """
dc AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * EXCLUDE (customer_key) FROM cu),
dg AS (SELECT row_number() OVER (ORDER BY category) AS category_key, category AS category_code
       FROM (SELECT DISTINCT category FROM so))"""


def day_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


# --- cleaning -------------------------------------------------------------------------------------

ORACLES["clean_orders"] = f"""WITH {SALES}
SELECT order_id, customer_id, order_date, {money('cents')} AS order_amount, currency, category FROM so"""

ORACLES["clean_customers"] = f"""WITH {CUSTOMERS}
SELECT customer_id, customer_name, segment, status, created_date FROM cu"""

ORACLES["clean_controls"] = f"""WITH {SALES}, {ALL_CONTROLS}
SELECT control_date, source_system, order_count, {money('cents')} AS order_amount, currency FROM gl"""

ORACLES["accepted_orders"] = f"""WITH {SALES}
SELECT order_id, customer_id, order_date, {money('cents')} AS order_amount, currency, category FROM so
WHERE cents >= {b.CURATED_FLOOR} * 100 AND cents < {b.SOURCE_CEILING} * 100"""

ORACLES["rejects"] = f"""
SELECT ' so-' || o_orderkey || ' ' AS order_id, 'c-' || o_custkey AS customer_id,
       CASE WHEN o_totalprice >= {b.SOURCE_CEILING} THEN '2026-02-30'
            WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y/%-m/%-d')
            ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
       CASE WHEN o_totalprice < {b.CURATED_FLOOR} THEN 'n/a' ELSE format('{{:,.2f}}', o_totalprice) END AS order_amount,
       ' ' || lower(o_orderstatus) AS currency, lower(o_orderpriority) || chr(9) AS category,
       CASE WHEN o_totalprice >= {b.SOURCE_CEILING} THEN 'order_date' ELSE 'order_amount' END AS reject_reason
FROM orders WHERE o_totalprice >= {b.SOURCE_CEILING} OR o_totalprice < {b.CURATED_FLOOR}"""

# --- star -----------------------------------------------------------------------------------------

ORACLES["dim_date"] = f"""
SELECT DISTINCT {day_key('o_orderdate')} AS date_key, CAST(o_orderdate AS DATE) AS calendar_date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders"""

ORACLES["dim_customer"] = f"""WITH {SALES}, {CUSTOMERS}, {KEYS}
SELECT customer_key, customer_id, customer_name, segment, status, created_date FROM dc"""

ORACLES["dim_category"] = f"""WITH {SALES}, {CUSTOMERS}, {KEYS}
SELECT category_key, category_code FROM dg"""

ORACLES["fact_sales_order"] = f"""WITH {SALES}, {CUSTOMERS}, {KEYS}
SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id, dc.customer_key,
       {day_key('order_date')} AS order_date_key, category_key, {money('cents')} AS order_amount,
       currency AS currency_code
FROM so JOIN dc USING (customer_id) JOIN dg ON category = category_code"""

ORACLES["fact_control"] = f"""WITH {SALES}, {ALL_CONTROLS}
SELECT row_number() OVER (ORDER BY control_date, source_system, currency) AS control_key,
       {day_key('control_date')} AS control_date_key, source_system, order_count,
       {money('cents')} AS order_amount, currency AS currency_code
FROM gl"""

ORACLES["star_orders"] = f"""WITH {SALES}, {CUSTOMERS}
SELECT order_id, order_date, segment, category, {money('cents')} AS order_amount, currency AS currency_code
FROM so JOIN cu USING (customer_id)"""

# --- reporting layer ------------------------------------------------------------------------------

DAILY = """
daily AS (
  SELECT order_date, count(*) AS n, CAST(sum(cents) AS HUGEINT) AS cents, count(DISTINCT customer_key) AS customers
  FROM so GROUP BY order_date)"""

ORACLES["daily_sales_kpi"] = f"""WITH {SALES}, {DAILY}
SELECT order_date AS calendar_date, n AS order_count, {money('cents')} AS revenue_usd,
       {ratio('cents', 'n * 100')} AS average_order_value, customers AS active_customers
FROM daily"""

ORACLES["monthly_sales_trend"] = f"""WITH {SALES}, {DAILY}, m AS (
  SELECT {month('order_date')} AS month_start, CAST(sum(cents) AS HUGEINT) AS cents,
         CAST(sum(n) AS BIGINT) AS n, CAST(sum(customers) AS BIGINT) AS days
  FROM daily GROUP BY 1), l AS (
  SELECT *, lag(cents) OVER (ORDER BY month_start) AS before, lag(n) OVER (ORDER BY month_start) AS n_before FROM m)
SELECT month_start, {money('cents')} AS revenue_usd, n AS order_count, days AS active_customer_days,
       {money('before')} AS prior_period_revenue_usd,
       {percent('cents - before', 'before')} AS revenue_period_over_period_pct,
       {percent('n - n_before', 'n_before')} AS order_period_over_period_pct
FROM l"""

ORACLES["segment_kpi"] = f"""WITH {SALES}, {CUSTOMERS}, s AS (
  SELECT segment, count(DISTINCT customer_key) AS customers, count(*) AS n, CAST(sum(cents) AS HUGEINT) AS cents
  FROM so JOIN cu USING (customer_key) GROUP BY segment), t AS (
  SELECT *, CAST(sum(cents) OVER () AS HUGEINT) AS total FROM s)
SELECT segment, customers AS customers_with_orders, n AS order_count, {money('cents')} AS revenue_usd,
       {ratio('cents', 'n * 100')} AS average_order_value, {percent('cents', 'total')} AS revenue_share_pct
FROM t"""

ORACLES["cohort_month"] = f"""WITH {SALES}, {CUSTOMERS}
SELECT {month('created_date')} AS cohort_month, {month('order_date')} AS order_month,
       count(DISTINCT customer_key) AS active_customers, count(*) AS order_count,
       {money('sum(cents)')} AS revenue_usd
FROM so JOIN cu USING (customer_key) GROUP BY 1, 2"""

RECON = f"""{SALES}, {CONTROLS}, r AS (
  SELECT coalesce(s.d, c.d) AS calendar_date, coalesce(s.currency, c.currency) AS currency_code,
         CAST(coalesce(s.n, 0) AS BIGINT) AS s_n, CAST(coalesce(c.n, 0) AS BIGINT) AS c_n,
         CAST(coalesce(s.cents, 0) AS BIGINT) AS s_c, CAST(coalesce(c.cents, 0) AS BIGINT) AS c_c
  FROM (SELECT control_date AS d, currency, sum(order_count) AS n, sum(cents) AS cents FROM gl GROUP BY ALL) s
  FULL OUTER JOIN (SELECT order_date AS d, currency, count(*) AS n, sum(cents) AS cents FROM so
                   WHERE cents >= {b.CURATED_FLOOR} * 100 GROUP BY ALL) c
  ON s.d = c.d AND s.currency = c.currency)"""
RECON_COLUMNS = f"""calendar_date, currency_code, s_n AS source_order_count, c_n AS curated_order_count,
       s_n - c_n AS order_count_variance, {money('s_c')} AS source_order_amount,
       {money('c_c')} AS curated_order_amount, {money('s_c - c_c')} AS amount_variance_usd,
       CAST(0 AS DOUBLE) AS documented_amount_tolerance_usd,
       CASE WHEN s_n = c_n AND s_c = c_c THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status"""

ORACLES["recon_daily"] = f"WITH {RECON} SELECT {RECON_COLUMNS} FROM r ORDER BY calendar_date, currency_code"

ORACLES["recon_exceptions"] = f"WITH {RECON} SELECT {RECON_COLUMNS} FROM r WHERE s_n <> c_n OR s_c <> c_c"

ORACLES["recon_close"] = f"""WITH {RECON}, t AS (
  SELECT CAST(sum(s_n) AS BIGINT) AS s_n, CAST(sum(c_n) AS BIGINT) AS c_n, CAST(sum(s_c) AS BIGINT) AS s_c,
         CAST(sum(c_c) AS BIGINT) AS c_c FROM r)
SELECT s_n AS source_order_count, c_n AS curated_order_count, s_n - c_n AS count_variance,
       {money('s_c')} AS source_order_amount, {money('c_c')} AS curated_order_amount,
       {money('s_c - c_c')} AS amount_variance_usd,
       CASE WHEN s_n = c_n AND s_c = c_c THEN 'PASS' ELSE 'FAIL' END AS close_status
FROM t"""

# --- control suite --------------------------------------------------------------------------------


def _in(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _blanks(*columns: str) -> str:
    cells = " + ".join(f"(CASE WHEN coalesce(trim(CAST({c} AS VARCHAR)), '') = '' THEN 1 ELSE 0 END)" for c in columns)
    return f"CAST(coalesce(sum({cells}), 0) AS BIGINT)"


_POLICY = b.POLICY


def _checks(datasets: str, missing: str = "", warned: str = "") -> str:
    """The suite over so, cu and gl; `missing` is a column that the controls lack, `warned` a check that only warns."""
    return f"""{datasets}, ok AS (
  SELECT * FROM so WHERE cents >= {b.CURATED_FLOOR} * 100 AND cents < {b.SOURCE_CEILING} * 100), f AS (
  SELECT
    (SELECT count(*) FROM so) AS raw_rows,
    (SELECT count(*) FROM ok) AS rows,
    (SELECT count(*) - count(DISTINCT order_id) FROM ok) AS dup_orders,
    (SELECT count(*) - count(DISTINCT customer_id) FROM cu) AS dup_customers,
    (SELECT count(*) FROM ok WHERE NOT (cents > 0 AND cents <= {_POLICY.max_amount} * 100)) AS bad_range,
    (SELECT count(*) FROM ok WHERE category NOT IN ({_in(_POLICY.categories)})
                                OR coalesce(currency, '') NOT IN ({_in(_POLICY.currencies)})) AS bad_orders,
    (SELECT count(*) FROM cu WHERE coalesce(segment, '') NOT IN ({_in(_POLICY.segments)})
                                OR status NOT IN ({_in(_POLICY.statuses)})) AS bad_customers,
    (SELECT count(*) FROM ok WHERE customer_id NOT IN (SELECT customer_id FROM cu)) AS orphans,
    (SELECT CAST(sum(cents) AS BIGINT) FROM ok) AS cents,
    (SELECT CAST(sum(order_count) AS BIGINT) FROM gl) AS gl_rows,
    (SELECT CAST(sum(cents) AS BIGINT) FROM gl) AS gl_cents,
    (SELECT {_blanks('customer_id', 'customer_name', 'segment', 'status', 'created_date')} FROM cu) AS null_customers,
    (SELECT {_blanks('order_id', 'customer_id', 'order_date', 'cents', 'currency', 'category')} FROM ok) AS null_orders,
    (SELECT {_blanks('control_date', 'source_system', 'order_count', 'cents', 'currency')} FROM gl) AS null_controls), checks AS (
  SELECT 'REQ_CUSTOMERS' AS check_id, true AS passed,
         'customer_id, customer_name, segment, status, created_date' AS observed,
         'all required columns present' AS expected, 'Validated at ingestion' AS detail
  UNION ALL SELECT 'REQ_SALES_ORDERS', true,
         'order_id, customer_id, order_date, order_amount, currency, category',
         'all required columns present', 'Validated at ingestion'
  UNION ALL SELECT 'REQ_GL_CONTROLS', '{missing}' = '',
         {f"'missing: {missing}'" if missing else "'control_date, source_system, order_count, order_amount, currency'"},
         'all required columns present', 'Validated at ingestion'
  UNION ALL SELECT 'NULL_CUSTOMERS', null_customers = 0, CAST(null_customers AS VARCHAR), '<= 0',
         'Required-field null values' FROM f
  UNION ALL SELECT 'NULL_SALES_ORDERS', null_orders = 0, CAST(null_orders AS VARCHAR), '<= 0',
         'Required-field null values' FROM f
  UNION ALL SELECT 'NULL_GL_CONTROLS', null_controls = 0, CAST(null_controls AS VARCHAR), '<= 0',
         'Required-field null values' FROM f
  UNION ALL SELECT 'DUP_CUSTOMERS', dup_customers = 0, CAST(dup_customers AS VARCHAR), '0',
         'Duplicate customer_id values' FROM f
  UNION ALL SELECT 'DUP_SALES_ORDERS', dup_orders = 0, CAST(dup_orders AS VARCHAR), '0',
         'Duplicate order_id values' FROM f
  UNION ALL SELECT 'RANGE_ORDER_AMOUNT', bad_range = 0, CAST(bad_range AS VARCHAR), '0',
         'Amount must be > 0 and <= {_POLICY.max_amount:,}' FROM f
  UNION ALL SELECT 'VALID_ENUMS', bad_orders + bad_customers = 0, CAST(bad_orders + bad_customers AS VARCHAR), '0',
         'Approved segment, status, category, and currency values' FROM f
  UNION ALL SELECT 'FK_ORDER_CUSTOMER', orphans = 0, CAST(orphans AS VARCHAR), '0',
         'Every order customer exists in customer master' FROM f
  UNION ALL SELECT 'RECON_ROW_COUNT', rows = raw_rows, CAST(rows AS VARCHAR), CAST(raw_rows AS VARCHAR),
         'Raw-to-clean sales order count' FROM f
  UNION ALL SELECT 'RECON_ORDER_COUNT', rows = gl_rows, CAST(rows AS VARCHAR), CAST(gl_rows AS VARCHAR),
         'Sales orders versus GL control count' FROM f
  UNION ALL SELECT 'RECON_ORDER_VALUE', cents = gl_cents, CAST(CAST(cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))::VARCHAR,
         CAST(CAST(gl_cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))::VARCHAR,
         'Sales orders versus GL control amount' FROM f), results AS (
  SELECT check_id, CASE WHEN passed THEN 'PASS' WHEN check_id = '{warned}' THEN 'WARN' ELSE 'FAIL' END AS status, observed, expected, detail FROM checks)"""


CHECKS = _checks(f"{SALES}, {CUSTOMERS}, {CONTROLS}")
#: The datasets of `bindings.failing_extracts`.
_FAILING = f"""{SALES.replace('so AS (', 'so0 AS (')}, {CUSTOMERS.replace('cu AS (', 'cu0 AS (')}, {CONTROLS.replace('gl AS (', 'gl0 AS (').replace('FROM so', 'FROM so0')},
so1 AS (SELECT * REPLACE (CASE WHEN o_orderkey % 70 = 4 THEN NULL ELSE currency END AS currency) FROM so0),
so AS (SELECT * FROM so1 UNION ALL SELECT * FROM so1 WHERE o_orderkey % 100 = 3),
cu1 AS (SELECT * REPLACE (CASE WHEN customer_key % 30 = 2 THEN NULL ELSE segment END AS segment) FROM cu0 WHERE customer_key % 50 <> 0),
cu AS (SELECT * FROM cu1 UNION ALL SELECT * FROM cu1 WHERE customer_key % 40 = 1),
gl AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS source_system) FROM gl0)"""

ORACLES["check_suite_failing"] = f"WITH {_checks(_FAILING, 'source_system', 'DUP_CUSTOMERS')} SELECT * FROM results"

ORACLES["check_suite"] = f"WITH {CHECKS} SELECT * FROM results"

ORACLES["quality_exceptions"] = f"""WITH {CHECKS}
SELECT *, '{b.EVALUATED_AT:%Y-%m-%d %H:%M:%S}' AS evaluated_at_utc FROM results WHERE status IN ('FAIL', 'WARN')"""

ORACLES["recon_check_exceptions"] = f"""WITH {CHECKS}
SELECT check_id, observed, expected, detail FROM results WHERE check_id LIKE 'RECON_%' AND status = 'FAIL'"""

ORACLES["enterprise_summary"] = f"""WITH {CHECKS}, r AS (
  SELECT coalesce(s.n, 0) AS s_n, coalesce(c.n, 0) AS c_n, coalesce(s.cents, 0) AS s_c, coalesce(c.cents, 0) AS c_c
  FROM (SELECT control_date AS d, currency, sum(order_count) AS n, sum(cents) AS cents FROM gl GROUP BY ALL) s
  FULL OUTER JOIN (SELECT order_date AS d, currency, count(*) AS n, sum(cents) AS cents FROM so
                   WHERE cents >= {b.CURATED_FLOOR} * 100 GROUP BY ALL) c
  ON s.d = c.d AND s.currency = c.currency)
SELECT count(*) AS sales_order_count, {money('sum(cents)')} AS sales_revenue_usd,
       (SELECT {percent("count(*) FILTER (status = 'PASS')", 'count(*)')} FROM results) AS data_quality_pass_rate_pct,
       (SELECT count(*) FROM results WHERE status IN ('FAIL', 'WARN')) AS open_quality_exceptions,
       (SELECT count(*) FROM r WHERE s_n <> c_n OR s_c <> c_c) AS reconciliation_exceptions
FROM so"""

ORACLES["duplicate_rows"] = """
SELECT 'lineitem' AS dataset, sum(n - 1)::BIGINT AS excess_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'orders', sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)"""

ORACLES["foreign_key_orphans"] = """
SELECT count(*) AS orphans FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""

ORACLES["range_and_domains"] = f"""WITH {SALES}
SELECT count(*) FILTER (NOT (cents > 0 AND cents <= {_POLICY.max_amount} * 100)) AS out_of_range,
       count(*) FILTER (category NOT IN ({_in(_POLICY.categories)}) OR currency NOT IN ({_in(_POLICY.currencies)}))
         AS outside_domains
FROM so"""

# --- profiles, rules, incidents -------------------------------------------------------------------


def _profile(source: str, dataset: str, columns: dict[str, str]) -> str:
    """`columns` gives each column's text form."""
    each = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {text} AS v FROM {source}" for name, text in columns.items()
    )
    return f"""cells AS ({each}), p AS (
  SELECT column_name, count(*) AS row_count, count(*) FILTER (v IS NULL OR trim(v) = '') AS null_count,
         count(DISTINCT v) AS distinct_count, coalesce(min(v), '') AS min_value, coalesce(max(v), '') AS max_value
  FROM cells GROUP BY column_name)
SELECT '{dataset}' AS dataset, column_name, row_count, null_count,
       {half_even_percent('null_count', 'row_count')} AS null_rate_pct, distinct_count, min_value, max_value
FROM p"""


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_MONEY_TEXT = "CAST(CAST(CAST(cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS VARCHAR)"

ORACLES["column_profile_orders"] = f"WITH {SALES}, " + _profile(
    "so",
    "sales_orders",
    {
        "order_id": "order_id", "customer_id": "customer_id", "order_date": _text("order_date"),
        "order_amount": _MONEY_TEXT, "currency": "currency", "category": "category",
    },
)

ORACLES["column_profile_approximate"] = ORACLES["column_profile_orders"].replace("max_value\nFROM p", "max_value,\n       true AS estimate_within_bound\nFROM p")

ORACLES["column_profile_customers"] = f"WITH {CUSTOMERS}, " + _profile(
    "cu",
    "customers",
    {
        "customer_id": "customer_id", "customer_name": "customer_name", "segment": "segment", "status": "status",
        "created_date": _text("created_date"),
    },
)

ORACLES["column_profile_events"] = "WITH " + _profile(
    "events",
    "events",
    {
        "event_id": _text("event_id"), "ts": _text("ts"), "user_id": _text("user_id"), "event_type": "event_type",
        "value": "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)", "props": "props",
    },
)

LABELLED = "ld AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"

ORACLES["column_profile_documents"] = f"WITH {LABELLED}, " + _profile(
    "ld",
    "documents",
    {
        "doc_id": _text("doc_id"), "text": "text", "lang": "lang", "source": "source", "n_chars": _text("n_chars"),
        "quality": _text("quality"), "toxic": _text("toxic"),
    },
)

_STALE = "SELECT count(*) AS n, CASE WHEN date_diff('day', max(CAST({c} AS DATE)), DATE '{day}') > 7 THEN count(*) ELSE 0 END AS failed FROM {t}"
_FAILED = "SELECT count(*) AS n, count(*) FILTER ({c}) AS failed FROM {t}"
_COUNTS = {
    "ORDER_BIG_TICKET": _FAILED.format(t="so", c="cents >= 30000000 AND category = '5_LOW'"),
    "ORDER_SETTLED": _FAILED.format(t="so", c="currency = 'P'"),
    "ORDER_BUYER": _FAILED.format(t="so", c="customer_key NOT IN (SELECT c_custkey FROM customer)"),
    "ORDER_LINES": _FAILED.format(t="so", c="o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"),
    "LINE_DISCOUNT": _FAILED.format(t="lineitem", c="round(l_quantity * 100) < 500 AND round(l_discount * 100) > 8"),
    "LINE_ORDER": _FAILED.format(t="lineitem", c="l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    "LINE_SHIPPED": _STALE.format(c="l_shipdate", t="lineitem", day=b.DAY).replace("> 7", "> 30"),
    "EVENT_PURCHASE_VALUE": _FAILED.format(t="events", c="event_type = 'purchase' AND value < 1"),
    "EVENT_RECENT": _STALE.format(c="ts", t="events", day=b.DAY),
}
RESULTS = f"{SALES}, results AS (" + " UNION ALL ".join(
    f"""SELECT '{r['rule_id']}' AS rule_id, '{r['dataset']}' AS dataset, '{r['severity']}' AS severity,
 '{r['owner']}' AS owner, '{r['description']}' AS description, CASE WHEN failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
 n AS evaluated_rows, failed AS failed_rows, {half_even_percent('failed', 'n')} AS failed_rate_pct
FROM ({_COUNTS[r['rule_id']]})"""
    for r in b.RULES["rules"]
) + ")"

ORACLES["rule_results"] = f"WITH {RESULTS} SELECT * FROM results"

ORACLES["rule_status"] = f"""WITH {RESULTS}
SELECT severity, owner, status, count(*) AS rule_count, CAST(sum(failed_rows) AS BIGINT) AS failed_rows
FROM results GROUP BY ALL"""

_INCIDENT = f"""'INC-' || rule_id || '-{b.DAY:%Y%m%d}' AS incident_id, rule_id, dataset, severity, owner,
       'OPEN' AS status, failed_rows, rule_id || '|' || dataset || '|{b.DAY}' AS deduplication_key"""

ORACLES["incidents"] = f"WITH {RESULTS} SELECT {_INCIDENT} FROM results WHERE status = 'FAIL'"

ORACLES["new_incidents"] = f"""WITH {RESULTS}
SELECT {_INCIDENT} FROM results WHERE status = 'FAIL' AND severity <> 'HIGH'"""

# --- statistics -----------------------------------------------------------------------------------

ORACLES["revenue_by_category"] = f"""WITH {SALES}
SELECT category, {money('sum(cents)')} AS revenue_usd, count(*) AS orders FROM so
WHERE category IS NOT NULL GROUP BY category ORDER BY revenue_usd DESC, category"""

ORACLES["revenue_by_segment"] = f"""WITH {SALES}
SELECT c_mktsegment AS segment, {money('sum(cents)')} AS revenue_usd, count(*) AS orders
FROM so JOIN customer ON c_custkey = customer_key
WHERE c_mktsegment IS NOT NULL GROUP BY segment ORDER BY revenue_usd DESC, segment"""

_DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
ORACLES["missing_values"] = f"WITH {LABELLED}, m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing FROM ld" for c in _DOCUMENT_COLUMNS
) + ") SELECT * FROM m UNION ALL SELECT '(total)', CAST(sum(missing) AS BIGINT) FROM m"


def _fences(source: str, cents: str) -> str:
    """Quartiles in ten-thousandths of the unit, interpolated on whole numbers."""
    at = lambda p: f"""(SELECT sum(CASE WHEN i = ({p} * (n - 1)) // 4 THEN v * (4 - ({p} * (n - 1)) % 4)
        WHEN i = ({p} * (n - 1)) // 4 + 1 THEN v * (({p} * (n - 1)) % 4) ELSE 0 END) * 25 FROM o)"""  # noqa: E731
    return f"""o AS (SELECT {cents} AS v, row_number() OVER (ORDER BY {cents}) - 1 AS i, count(*) OVER () AS n FROM {source}),
q AS (SELECT {at(1)} AS q1, {at(2)} AS q2, {at(3)} AS q3),
fences AS (SELECT q1, q2, q3, 2 * q1 - 3 * (q3 - q1) AS low2, 2 * q3 + 3 * (q3 - q1) AS high2 FROM q)"""


ORACLES["order_distribution"] = f"""WITH {SALES}, {_fences('so', 'cents')}
SELECT count(*) AS orders, {money('sum(cents)')} AS total, any_value(q1) / 10000.0::DOUBLE AS q1,
       any_value(q2) / 10000.0::DOUBLE AS median, any_value(q3) / 10000.0::DOUBLE AS q3,
       any_value(q3 - q1) / 10000.0::DOUBLE AS iqr, any_value(low2) / 20000.0::DOUBLE AS lower_fence,
       any_value(high2) / 20000.0::DOUBLE AS upper_fence,
       count(*) FILTER (cents * 200 < low2 OR cents * 200 > high2) AS outliers
FROM so, fences"""

ORACLES["event_value_outliers"] = f"""WITH ev AS (
  SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
{_fences('ev', 'cents')}
SELECT event_id, event_type, {money('cents')} AS value FROM ev, fences
WHERE cents * 200 < low2 OR cents * 200 > high2"""

ORACLES["document_length_outliers"] = f"""WITH {_fences('documents', 'n_chars')}
SELECT doc_id, source, n_chars FROM documents, fences WHERE n_chars * 200 < low2 OR n_chars * 200 > high2"""

ORACLES["histogram"] = f"""WITH {SALES}, s AS (
  SELECT min(cents) AS low, max(cents) AS high, least(6, count(*)) AS bins FROM so), c AS (
  SELECT least(((cents - low) * bins) // (high - low), bins - 1) AS bin, count(*) AS n FROM so, s GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, {ratio('low * (bins - g.bin) + high * g.bin', 'bins * 100', 4)} AS lower_edge,
       {ratio('low * (bins - g.bin - 1) + high * (g.bin + 1)', 'bins * 100', 4)} AS upper_edge,
       coalesce(n, 0) AS orders
FROM (SELECT low, high, bins, unnest(range(bins)) AS bin FROM s) g LEFT JOIN c ON c.bin = g.bin"""

_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORACLES["correlation"] = " UNION ALL ".join(
    f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr({x}, {y}), 3) + 0.0 AS correlation FROM lineitem"
    for x in _MEASURES
    for y in _MEASURES
)

_FINE = "ev AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"
ORACLES["outliers_fine_scale"] = f"""WITH {_FINE}, {_fences('ev', 'cents')}
SELECT event_id FROM ev, fences WHERE cents * 200 < low2 OR cents * 200 > high2"""

ORACLES["histogram_fine_scale"] = f"""WITH {_FINE}, s AS (
  SELECT min(cents) AS low, max(cents) AS high, least(6, count(*)) AS bins FROM ev), c AS (
  SELECT least(((cents - low) * bins) // (high - low), bins - 1) AS bin, count(*) AS n FROM ev, s GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, coalesce(n, 0) AS orders
FROM (SELECT unnest(range(bins)) AS bin FROM s) g LEFT JOIN c ON c.bin = g.bin"""

_LINES = """lm AS (
  SELECT l_quantity AS quantity, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS price,
         CASE WHEN l_quantity >= 5 THEN l_tax END AS tax FROM lineitem)"""
_LINE_MEASURES = ("quantity", "price", "tax")
ORACLES["float_missing_values"] = f"WITH {_LINES}, m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM lm" for c in _LINE_MEASURES
) + ") SELECT * FROM m UNION ALL SELECT '(total)', CAST(sum(missing) AS BIGINT) FROM m"

ORACLES["float_correlation"] = f"WITH {_LINES} " + " UNION ALL ".join(
    f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr({x}, {y}), 3) + 0.0 AS correlation FROM lm"
    for x in _LINE_MEASURES
    for y in _LINE_MEASURES
)

ORACLES["float_distribution"] = f"""WITH {_LINES}, q AS (
  SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM lm)
SELECT count(*) AS orders, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
       round(any_value(q3), 4) AS q3, round(any_value(q3 - q1), 4) AS iqr,
       round(any_value(q1 - 1.5 * (q3 - q1)), 4) AS lower_fence, round(any_value(q3 + 1.5 * (q3 - q1)), 4) AS upper_fence,
       count(*) FILTER (price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS outliers
FROM lm, q"""

# --- runs -----------------------------------------------------------------------------------------

ORACLES["publication_run"] = ORACLES["daily_sales_kpi"]
ORACLES["publication_stopped"] = ORACLES["check_suite"]
ORACLES["governance_run"] = ORACLES["rule_results"]
ORACLES["staged_round_trip"] = "SELECT doc_id, nullif(text, '') AS text FROM documents"

ORACLES["headline"] = f"""WITH {CHECKS}
SELECT count(*) AS orders, {money('sum(cents)')} AS total_usd,
       (SELECT count(*) FROM results WHERE status = 'PASS') AS checks_passed,
       (SELECT count(*) FROM results) AS checks_total
FROM so"""

ORACLES["dataset_volumes"] = f"""
SELECT 'sales_orders' AS dataset, count(*) AS raw_rows,
       count(*) FILTER (o_totalprice >= {b.CURATED_FLOOR} AND o_totalprice < {b.SOURCE_CEILING}) AS clean_rows FROM orders
UNION ALL SELECT 'customers', count(*), count(*) FROM customer"""

# --- governance metrics ---------------------------------------------------------------------------

_PASSED = [
    ("documents", "completeness", "text", "ld", "count(*) FILTER (text IS NOT NULL AND trim(text) <> '')"),
    ("documents", "completeness", "lang", "ld", "count(*) FILTER (lang IS NOT NULL AND trim(lang) <> '')"),
    ("documents", "completeness", "quality", "ld", "count(quality)"),
    ("documents", "completeness", "toxic", "ld", "count(toxic)"),
    ("documents", "validity", "n_chars", "ld", "count(*) FILTER (n_chars BETWEEN 1 AND 5000)"),
    ("documents", "validity", "lang", "ld", "count(*) FILTER (lang IN ('en', 'fr'))"),
    ("documents", "uniqueness", "text", "ld", "count(DISTINCT text)"),
    ("sales_orders", "completeness", "customer_id", "so", "count(customer_id)"),
    ("sales_orders", "completeness", "order_amount", "so", "count(cents)"),
    ("sales_orders", "validity", "order_amount", "so", f"count(*) FILTER (cents <= {_POLICY.max_amount} * 100)"),
    ("sales_orders", "uniqueness", "order_id", "so", "count(DISTINCT order_id)"),
    ("order_lines", "uniqueness", "l_orderkey, l_linenumber", "lineitem", "count(DISTINCT (l_orderkey, l_linenumber))"),
]
SCORES = f"{SALES}, {LABELLED}, scores AS (" + " UNION ALL ".join(
    f"SELECT '{p}' AS product, '{d}' AS dimension, '{e}' AS element, {passed} AS passed, count(*) AS assessed FROM {source}"
    for p, d, e, source, passed in _PASSED
) + ")"

ORACLES["score_dimensions"] = f"WITH {SCORES} SELECT *, {percent('passed', 'assessed')} AS rate_pct FROM scores"

ORACLES["score_overall"] = f"""WITH {SCORES}, d AS (
  SELECT product, dimension, CAST(round(100 * {percent('sum(passed)', 'sum(assessed)')}) AS HUGEINT) AS score,
         CASE dimension WHEN 'completeness' THEN 5 WHEN 'validity' THEN 3 ELSE 2 END AS w
  FROM scores GROUP BY ALL)
SELECT product, {ratio('sum(score * w)', 'sum(w) * 100')} AS overall_score_pct FROM d GROUP BY product"""

ORACLES["score_overall_fine_weights"] = f"""WITH {SCORES}, d AS (
  SELECT product, dimension, CAST(round(100 * {percent('sum(passed)', 'sum(assessed)')}) AS HUGEINT) AS score,
         CASE dimension WHEN 'completeness' THEN 6674 WHEN 'validity' THEN 2757 ELSE 3494 END AS w
  FROM scores GROUP BY ALL)
SELECT product, {ratio('sum(score * w)', 'sum(w) * 100')} AS overall_score_pct FROM d GROUP BY product"""

ORACLES["score_card"] = f"""WITH {SCORES}
SELECT product, dimension, CAST(sum(passed) AS BIGINT) AS passed, CAST(sum(assessed) AS BIGINT) AS assessed,
       {percent('sum(passed)', 'sum(assessed)')} AS rate_pct
FROM scores GROUP BY ROLLUP (product, dimension)"""

REFRESHES = """
loads AS (
  SELECT 'P' || user_id AS product, CAST(ts AS DATE) AS due_date, min(ts) AS received_at FROM events GROUP BY ALL),
schedule AS (
  SELECT product, CAST(unnest(generate_series(min(due_date), max(due_date), INTERVAL 1 DAY)) AS DATE) AS due_date
  FROM loads GROUP BY product),
refreshes AS (
  SELECT product, due_date, due_date + INTERVAL 12 HOUR AS due_at, received_at,
         CASE WHEN received_at IS NULL THEN 'MISSING' WHEN received_at > due_date + INTERVAL 12 HOUR THEN 'LATE'
              ELSE 'ON_TIME' END AS refresh_status
  FROM schedule LEFT JOIN loads USING (product, due_date))"""

ORACLES["score_refresh_status"] = f"""WITH {REFRESHES}
SELECT product, due_date, strftime(due_at, '%Y-%m-%d %H:%M:%S') AS due_at,
       strftime(received_at, '%Y-%m-%d %H:%M:%S') AS received_at, refresh_status
FROM refreshes"""

ORACLES["score_timeliness"] = f"""WITH {REFRESHES}, t AS (
  SELECT product, {month('due_date')} AS month_start, count(*) FILTER (refresh_status = 'ON_TIME') AS on_time,
         count(*) AS scheduled
  FROM refreshes GROUP BY 1, 2)
SELECT *, {percent('on_time', 'scheduled')} AS timeliness_pct FROM t"""

REFRESH_RUNS = f"""{REFRESHES},
off AS (SELECT CAST(ts AS DATE) AS day FROM events WHERE date_diff('day', DATE '2024-01-02', CAST(ts AS DATE)) % 9 = 0),
open_days AS (
  SELECT day, row_number() OVER (ORDER BY day) AS number
  FROM (SELECT CAST(unnest(generate_series(min(due_date), max(due_date), INTERVAL 1 DAY)) AS DATE) AS day FROM refreshes)
  WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM off)),
judged AS (
  SELECT product, day, number, refresh_status = 'ON_TIME' AS on_time FROM refreshes JOIN open_days ON due_date = day),
islands AS (
  SELECT *, number - row_number() OVER (PARTITION BY product, on_time ORDER BY number) AS island FROM judged),
runs AS (
  SELECT product, on_time, min(day) AS first_day, max(day) AS last_day, count(*) AS business_days
  FROM islands GROUP BY product, on_time, island)"""

ORACLES["score_refresh_runs"] = f"WITH {REFRESH_RUNS} SELECT * FROM runs"

ORACLES["score_refresh_streaks"] = f"""WITH {REFRESH_RUNS}, best AS (
  SELECT * FROM runs WHERE on_time QUALIFY row_number() OVER (PARTITION BY product ORDER BY business_days DESC, first_day) = 1),
gap AS (
  SELECT product, count(*) FILTER (NOT on_time) AS gaps, coalesce(max(business_days) FILTER (NOT on_time), 0) AS longest_gap
  FROM runs GROUP BY product)
SELECT product, coalesce(business_days, 0) AS longest_on_time, first_day AS streak_from, last_day AS streak_to, gaps,
       longest_gap, coalesce(business_days, 0) >= 3 AS reached
FROM gap LEFT JOIN best USING (product)"""

ORACLES["score_variance"] = f"""WITH {RECON}, v AS (
  SELECT calendar_date, currency_code, {percent('abs(s_c - c_c)', 'greatest(s_c, 100)', 4)} AS variance_pct FROM r)
SELECT *, CASE WHEN variance_pct <= 20 THEN 'GREEN' WHEN variance_pct <= 25 THEN 'AMBER' ELSE 'RED' END AS rag FROM v"""

ORACLES["score_coverage"] = f"""WITH t AS (
  SELECT count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS matched_keys, count(*) AS source_keys
  FROM (SELECT DISTINCT o_orderkey FROM orders))
SELECT *, {percent('matched_keys', 'source_keys')} AS coverage_pct FROM t"""

EXCEPTIONS = """
ex AS (
  SELECT event_id, upper(event_type) AS rule_id, event_type AS domain, user_id, k, ts AS opened_at,
         'CAUSE_' || (k // 10) AS root_cause,
         CASE WHEN k < 25 THEN 'CRITICAL' WHEN k < 50 THEN 'HIGH' WHEN k < 75 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
         CASE WHEN k < 95 THEN ts + to_seconds(s) END AS assigned_at,
         CASE WHEN k >= 10 THEN ts + to_seconds(s * k) END AS resolved_at,
         k BETWEEN 5 AND 9 OR k < 5 AND event_type = 'click' AS decided
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(round(value * 100) AS BIGINT) * 36 AS s FROM events))"""

ORACLES["score_assignment_sla"] = f"""WITH {EXCEPTIONS}, t AS (
  SELECT domain, {month('opened_at')} AS month_start,
         count(*) FILTER (assigned_at <= opened_at + CASE isodow(opened_at) WHEN 5 THEN INTERVAL 3 DAY
                          WHEN 6 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END) AS assigned_in_time,
         count(*) AS raised
  FROM ex WHERE severity = 'CRITICAL' GROUP BY 1, 2)
SELECT *, {percent('assigned_in_time', 'raised')} AS sla_pct FROM t"""

ORACLES["score_card_by_owner"] = f"""WITH {EXCEPTIONS}, t AS (
  SELECT 'STEWARD_' || user_id AS owner, {month('opened_at')} AS month_start,
         count(assigned_at) + count(resolved_at) AS passed, 2 * count(*) AS assessed
  FROM ex WHERE severity IN ('CRITICAL', 'HIGH') GROUP BY 1, 2)
SELECT *, {percent('passed', 'assessed')} AS rate_pct FROM t"""

ORACLES["score_assignment_sla_holidays"] = f"""WITH {EXCEPTIONS}, h AS (
  SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE date_diff('day', DATE '2024-01-02', CAST(ts AS DATE)) % 9 = 0),
w AS (SELECT CAST(unnest(range(DATE '2023-01-01', DATE '2027-01-01', INTERVAL 1 DAY)) AS DATE) AS day), o AS (
  SELECT day FROM w WHERE isodow(day) < 6 AND day NOT IN (SELECT day FROM h)), n AS (
  SELECT d.day, min(o.day) AS next_day FROM (SELECT DISTINCT CAST(opened_at AS DATE) AS day FROM ex) d
  JOIN o ON o.day > d.day GROUP BY 1), t AS (
  SELECT domain, {month('opened_at')} AS month_start,
         count(*) FILTER (assigned_at <= opened_at + to_days(CAST(date_diff('day', n.day, next_day) AS INTEGER))) AS assigned_in_time,
         count(*) AS raised
  FROM ex JOIN n ON n.day = CAST(opened_at AS DATE) WHERE severity = 'CRITICAL' GROUP BY 1, 2)
SELECT *, {percent('assigned_in_time', 'raised')} AS sla_pct FROM t"""

ORACLES["score_time_to_resolve"] = f"""WITH {EXCEPTIONS}, t AS (
  SELECT severity, {month('resolved_at')} AS month_start, count(*) AS resolved,
         sum(date_diff('second', opened_at, resolved_at)) AS seconds
  FROM ex WHERE resolved_at IS NOT NULL GROUP BY 1, 2)
SELECT severity, month_start, resolved, {ratio('seconds', 'resolved * 3600')} AS mean_hours_to_resolve FROM t"""

ORACLES["score_recurrence"] = f"""WITH {EXCEPTIONS}, o AS (
  SELECT rule_id, CAST(opened_at AS DATE) AS day,
         lag(CAST(opened_at AS DATE)) OVER (PARTITION BY rule_id, root_cause ORDER BY opened_at, event_id) AS before
  FROM ex), p AS (
  SELECT rule_id, {month('day')} AS month_start, count(*) FILTER (date_diff('day', before, day) <= 30) AS repeats
  FROM o GROUP BY 1, 2), s AS (
  SELECT rule_id, {month('resolved_at')} AS month_start, count(*) AS resolved
  FROM ex WHERE resolved_at IS NOT NULL GROUP BY 1, 2), t AS (
  SELECT rule_id, month_start, coalesce(repeats, 0) AS repeats, coalesce(resolved, 0) AS resolved
  FROM p FULL OUTER JOIN s USING (rule_id, month_start))
SELECT *, {percent('repeats', 'resolved')} AS recurrence_pct FROM t"""

ORACLES["score_product_status"] = f"""WITH {EXCEPTIONS}, t AS (
  SELECT domain AS product, count(resolved_at) AS resolved, count(*) AS raised,
         bool_or(severity = 'CRITICAL' AND resolved_at IS NULL AND NOT decided) AS critical
  FROM ex GROUP BY domain), p AS (SELECT *, {percent('resolved', 'raised')} AS resolved_pct FROM t)
SELECT product, resolved, raised, resolved_pct,
       CASE WHEN resolved_pct >= 89 THEN CASE WHEN critical THEN 'AMBER' ELSE 'GREEN' END
            WHEN resolved_pct >= 87 THEN 'AMBER' ELSE 'RED' END AS rag
FROM p"""

REGISTER = f"""
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS day FROM events),
i AS (SELECT event_type, day, min(ts) AS opened_at, arg_max(k, ts) AS k, max(ts) AS updated_at FROM e GROUP BY ALL),
register AS (
  SELECT 'INC-' || upper(event_type) || '-' || strftime(day, '%Y%m%d') AS incident_id, upper(event_type) AS rule_id,
         'events' AS dataset, 'HIGH' AS severity, 'Data Engineering' AS owner,
         CASE WHEN k >= 50 THEN 'RESOLVED' ELSE 'IN_PROGRESS' END AS status,
         CASE WHEN k >= 50 THEN 'FIXED' ELSE 'PENDING' END AS disposition, 'CAUSE_' || (k // 10) AS root_cause,
         CASE WHEN k >= 50 THEN strftime(updated_at, '%Y-%m-%d %H:%M:%S') END AS resolved_at,
         CAST(date_diff('day', day, CASE WHEN k >= 50 THEN CAST(updated_at AS DATE) ELSE DATE '{b.DAY}' END) AS INTEGER)
           AS age_days
  FROM i)"""

ORACLES["score_exception_register"] = f"WITH {REGISTER} SELECT * FROM register"

ORACLES["open_incidents"] = f"""WITH {REGISTER}
SELECT * REPLACE ('OPEN' AS status, CAST(NULL AS TIMESTAMP) AS resolved_at) FROM register WHERE status = 'IN_PROGRESS'"""

INCIDENT_STATES = """
e AS (SELECT *, upper(event_type) AS rule_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             upper(event_type) || '|events|' || CAST(CAST(ts AS DATE) AS VARCHAR) AS key FROM events),
opened AS (SELECT key, rule_id, min(ts) AS moment FROM e GROUP BY ALL),
passed AS (
  SELECT key, min(p.moment) AS moment
  FROM opened JOIN (SELECT DISTINCT rule_id, ts + INTERVAL 1 HOUR AS moment FROM e WHERE k % 10 = 7) p
    ON p.rule_id = opened.rule_id AND p.moment > opened.moment GROUP BY key),
said AS (
  SELECT key, moment, 0 AS rank, 'OPEN' AS status, NULL AS disposition FROM opened
  UNION ALL SELECT key, ts, 1, CASE WHEN k >= 50 THEN 'RESOLVED' ELSE 'IN_PROGRESS' END,
                   CASE WHEN k >= 50 THEN 'FIXED' ELSE 'PENDING' END FROM e
  UNION ALL SELECT key, moment, 2, 'RESOLVED', 'PASSED' FROM passed),
moments AS (
  SELECT * FROM said
  QUALIFY row_number() OVER (PARTITION BY key, moment ORDER BY rank DESC, status DESC, disposition DESC NULLS LAST) = 1),
changed AS (
  SELECT * FROM moments
  WINDOW w AS (PARTITION BY key ORDER BY moment)
  QUALIFY lag(status) OVER w IS DISTINCT FROM status OR lag(disposition) OVER w IS DISTINCT FROM disposition),
states AS (
  SELECT key AS deduplication_key, moment AS valid_from, lead(moment) OVER (PARTITION BY key ORDER BY moment) AS valid_to, status,
         disposition FROM changed)"""

ORACLES["incident_history"] = f"""WITH {INCIDENT_STATES}
SELECT deduplication_key, strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
       strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to, status, disposition FROM states"""

ORACLES["incident_states_at"] = f"""WITH {INCIDENT_STATES}
SELECT deduplication_key, status, disposition, as_at
FROM states, (SELECT unnest([{", ".join(f"DATE '{day}'" for day in b.STATE_DAYS)}]) AS as_at)
WHERE valid_from <= as_at AND (valid_to IS NULL OR valid_to > as_at)"""

ORACLES["score_rule_versions"] = """WITH d AS (
  SELECT upper(event_type) AS rule_id, CAST(ts AS DATE) AS evaluation_day, count(*) AS failed_rows FROM events GROUP BY ALL)
SELECT rule_id, evaluation_day, failed_rows,
       CAST(CASE WHEN evaluation_day < min(evaluation_day) OVER (PARTITION BY rule_id) + 14 THEN 1 ELSE 2 END AS INTEGER)
         AS version
FROM d"""

ORACLES["score_schema_contract"] = f"""WITH {LABELLED}, n AS (
  SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(text) AS text, count(*) - count(lang) AS lang,
         count(*) - count(source) AS source, count(*) - count(n_chars) AS n_chars, count(*) - count(quality) AS quality,
         count(*) - count(toxic) AS toxic FROM ld)
SELECT 'doc_id' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, doc_id AS null_count,
       CASE WHEN doc_id > 0 THEN 'NULLS_FOUND' ELSE 'OK' END AS finding FROM n
UNION ALL SELECT 'text', 'string', 'string', text, CASE WHEN text > 0 THEN 'NULLS_FOUND' ELSE 'OK' END FROM n
UNION ALL SELECT 'lang', 'string', 'string', lang, 'OK' FROM n
UNION ALL SELECT 'n_chars', 'int', 'bigint', n_chars, 'TYPE_CHANGED' FROM n
UNION ALL SELECT 'quality', 'int', 'int', quality, CASE WHEN quality > 0 THEN 'NULLS_FOUND' ELSE 'OK' END FROM n
UNION ALL SELECT 'licence', 'string', NULL, 0, 'MISSING'
UNION ALL SELECT 'source', NULL, 'string', source, 'EXTRA' FROM n
UNION ALL SELECT 'toxic', NULL, 'int', toxic, 'EXTRA' FROM n"""

_REFERENCE = f"sha256('{b.SAMPLE_SECRET}' || sha256('{b.SAMPLE_SECRET}' || CAST(o_orderkey AS VARCHAR)))"
ORACLES["score_masked_samples"] = f"""WITH f AS (
  SELECT 'AMOUNT' AS rule_id, {_REFERENCE} AS record_reference FROM orders WHERE NOT o_totalprice <= 450000
  UNION ALL
  SELECT 'STATUS', {_REFERENCE} FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
SELECT rule_id, record_reference, CAST(row_number() OVER (PARTITION BY rule_id ORDER BY record_reference) AS INTEGER) AS sample_no
FROM f QUALIFY sample_no <= 5"""

ORACLES["recon_keys"] = f"""
SELECT 'SO' || o_orderkey AS order_id,
       CASE WHEN o_totalprice < {b.CURATED_FLOOR} THEN 'MISSING' ELSE 'CHANGED' END AS status,
       1 AS source_rows, CASE WHEN o_totalprice < {b.CURATED_FLOOR} THEN 0 ELSE 1 END AS target_rows
FROM orders WHERE o_totalprice < {b.CURATED_FLOOR} OR o_totalprice >= {b.SOURCE_CEILING}
UNION ALL
SELECT 'XSO' || o_orderkey, 'EXTRA', 0, 1 FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"""

ORACLES["recon_keys_equal"] = f"""WITH {SALES},
a AS (SELECT substr(customer_id, 2) AS customer, sum(cents) AS cents FROM so GROUP BY ALL),
f AS (SELECT CAST(o_custkey AS VARCHAR) AS customer, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY ALL)
SELECT coalesce(a.customer, f.customer) AS customer, '' AS status, 0 AS source_rows, 0 AS target_rows
FROM a FULL JOIN f ON a.customer = f.customer WHERE a.cents IS DISTINCT FROM f.cents"""

ORACLES["kept_customer_keys"] = f"""WITH {SALES}, {CUSTOMERS}
SELECT row_number() OVER (ORDER BY status, customer_id) AS customer_key, customer_id, customer_name, segment, status, created_date
FROM cu"""

ORACLES["column_profile_merged"] = f"""WITH {SALES}, w AS (
  SELECT * FROM so WHERE order_date BETWEEN DATE '{b.RANGE[0]}' AND DATE '{b.RANGE[1]}'),
""" + _profile(
    "w",
    "sales_orders",
    {"order_id": "order_id", "customer_id": "customer_id", "order_amount": _MONEY_TEXT, "currency": "currency", "category": "category"},
).replace("distinct_count, min_value, max_value\nFROM p", "min_value, max_value, true AS estimate_within_bound,\n       CASE WHEN column_name = 'order_amount' THEN true END AS quartiles_within_bound\nFROM p")

_LIMITS = {
    "ORDER_LIMIT": {1: "cents >= 30000000", 2: "cents >= 40000000", 3: "cents >= 25000000 AND category <> '1_URGENT'"},
    "ORDER_SETTLED": {1: "currency = 'P'"},
}
ORACLES["rule_results_by_version"] = f"WITH {SALES}, c AS (" + " UNION ALL ".join(
    f"""SELECT '{r['rule_id']}' AS rule_id, {r['version']} AS version, '{r['dataset']}' AS dataset, '{r['severity']}' AS severity,
 '{r['owner']}' AS owner, '{r['description']}' AS description, count(*) AS n, count(*) FILTER ({_LIMITS[r['rule_id']][r['version']]}) AS failed
FROM so WHERE order_date >= DATE '{since}'""" + (f" AND order_date < DATE '{until}'" if until else "")
    for r in b.VERSIONED
    for since in [next(d for name, v, d in b.IN_EFFECT if (name, v) == (r["rule_id"], r["version"]))]
    for until in [min((d for name, v, d in b.IN_EFFECT if name == r["rule_id"] and d > since), default=None)]
) + f""") SELECT rule_id, version, dataset, severity, owner, description, CASE WHEN failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
 n AS evaluated_rows, failed AS failed_rows, {half_even_percent('failed', 'n')} AS failed_rate_pct FROM c"""
