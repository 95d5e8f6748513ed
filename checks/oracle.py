"""DuckDB statements that give the rows of the registered queries, written independently of them."""

from __future__ import annotations


def _total(value: str) -> str:
    return f"CAST(round(coalesce(sum(CAST({value} AS DECIMAL(20,6))), 0), 2) AS DOUBLE)"


def _mean(value: str) -> str:
    return f"CAST(round(CAST(CAST(sum(CAST({value} AS DECIMAL(20,6))) AS DOUBLE) / count({value}) AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _round(value: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} = 0 THEN 0.0 ELSE {_round(f'CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100')} END"


DIRTY = """
dirty AS (
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN -1 ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 66 = 0 THEN -10.0::DOUBLE ELSE o_totalprice END AS amount,
         CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
         CASE WHEN o_orderkey % 79 = 0 THEN 'zz' ELSE o_orderstatus END AS status
  FROM orders)"""

REASONED = f"""{DIRTY},
reasoned AS (
  SELECT *, CASE WHEN order_id IS NULL THEN 'NULL_ORDER_ID' WHEN customer_id IS NULL THEN 'NULL_CUSTOMER_ID'
                 WHEN amount IS NULL THEN 'NULL_AMOUNT' WHEN amount < 0 THEN 'NEGATIVE_AMOUNT'
                 WHEN order_date IS NULL THEN 'NULL_ORDER_DATE' END AS reject_reason
  FROM dirty),
valid AS (SELECT * EXCLUDE (reject_reason) FROM reasoned WHERE reject_reason IS NULL)"""

DQ = """
dq AS (
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN -1 ELSE o_custkey END AS customer_id,
         o_orderdate AS order_ts,
         CASE WHEN o_orderkey % 83 = 0 THEN 'ZZ' ELSE r_name END AS country,
         CASE WHEN o_orderkey % 59 = 0 THEN 'XXX' ELSE CASE r_name WHEN 'AFRICA' THEN 'ZAR' WHEN 'AMERICA' THEN 'USD'
              WHEN 'ASIA' THEN 'CNY' WHEN 'EUROPE' THEN 'EUR' WHEN 'MIDDLE EAST' THEN 'SAR' END END AS currency,
         CASE WHEN o_orderkey % 67 = 0 THEN -3 ELSE CAST(o_orderkey % 5 + 1 AS INTEGER) END AS quantity,
         CASE WHEN o_orderkey % 103 = 0 THEN 0.0::DOUBLE ELSE CAST(o_custkey % 500 + 1 AS DOUBLE) END AS unit_price,
         CAST((o_orderkey % 5 + 1) * (o_custkey % 500 + 1) + CASE WHEN o_orderkey % 73 = 0 THEN 10 ELSE 0 END AS DOUBLE) AS order_total,
         CASE WHEN o_orderkey % 107 = 0 THEN 'BARTER'
              ELSE list_extract(['CARD', 'TRANSFER', 'CASH', 'PAYPAL'], CAST(o_custkey % 4 + 1 AS INTEGER)) END AS payment_method,
         CASE WHEN o_orderkey % 79 = 0 THEN 'zz' ELSE o_orderstatus END AS order_status,
         CASE WHEN o_orderkey % 79 = 0 THEN 'bad-email' ELSE 'c' || o_custkey || '@demo.com' END AS email
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

STRICT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
SIMPLE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
LAST_TS = "TIMESTAMP '2001-06-01 00:00:00'"
PAIRS = [("AFRICA", "ZAR"), ("AMERICA", "USD"), ("ASIA", "CNY"), ("EUROPE", "EUR"), ("MIDDLE EAST", "SAR")]
COUNTRY_LIST = ", ".join(f"'{country}'" for country, _ in PAIRS)
CURRENCY_LIST = ", ".join(f"'{currency}'" for _, currency in PAIRS)

FLAG_SQL = {
    "rule_order_id_not_null": "order_id IS NOT NULL",
    "rule_order_id_unique": "dup_count = 1",
    "rule_customer_id_not_null": "customer_id IS NOT NULL",
    "rule_customer_exists": "customer_exists",
    "rule_country_valid": f"country IN ({COUNTRY_LIST})",
    "rule_currency_valid": f"currency IN ({CURRENCY_LIST})",
    "rule_currency_matches_country": "(country, currency) IN (" + ", ".join(f"('{a}', '{b}')" for a, b in PAIRS) + ")",
    "rule_quantity_range": "quantity BETWEEN 1 AND 100",
    "rule_unit_price_range": "unit_price BETWEEN 0.01 AND 10000",
    "rule_total_matches": "abs(order_total - quantity * unit_price) < 0.01",
    "rule_payment_method_valid": "payment_method IN ('CARD', 'TRANSFER', 'CASH', 'PAYPAL')",
    "rule_order_status_valid": "order_status IN ('P', 'O', 'F')",
    "rule_email_valid": f"regexp_matches(email, '{STRICT}')",
    "rule_order_ts_not_future": f"order_ts <= {LAST_TS}",
}

FLAGGED = f"""{DQ},
known AS (
  SELECT dq.*, count(*) OVER (PARTITION BY order_id) AS dup_count, coalesce(customer_id IN (SELECT c_custkey FROM customer), false) AS customer_exists
  FROM dq),
ruled AS (SELECT *, {", ".join(f"{check} AS {name}" for name, check in FLAG_SQL.items())} FROM known),
flagged AS (
  SELECT *, list_filter([{", ".join(f"CASE WHEN NOT {name} THEN '{name}' END" for name in FLAG_SQL)}], lambda x: x IS NOT NULL) AS failed
  FROM ruled)"""

SALES = f"""
sales AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
         l_partkey AS product_id, n_name AS country, p_type AS category, l_quantity AS quantity, p_retailprice AS unit_price,
         {_round("l_quantity * p_retailprice")} AS gross_amount, o_orderstatus AS status
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey
  WHERE l_quantity > 0)"""

REPORT_RULES = {
    # name: (condition, NULL counts as broken in the raw report)
    "quantity_1_to_100": ("quantity BETWEEN 1 AND 100", True),
    "price_positive": ("unit_price > 0", True),
    "total_not_negative": ("order_total >= 0", False),
    "customer_present": ("customer_id >= 0", True),
    "date_not_future": (f"order_ts <= {LAST_TS}", True),
    "email_simple": (f"regexp_matches(email, '{SIMPLE}')", True),
}

CLEAN = f"""{DQ},
tidied AS (
  SELECT DISTINCT order_key, order_id, CASE WHEN customer_id >= 0 THEN customer_id END AS customer_id,
         CASE WHEN order_ts <= {LAST_TS} THEN order_ts END AS order_ts,
         CASE lower(trim(country)) WHEN 'middle east' THEN 'middle_east' WHEN 'zz' THEN 'unknown' ELSE lower(trim(country)) END AS country,
         lower(trim(currency)) AS currency,
         CASE WHEN quantity BETWEEN 1 AND 100 THEN quantity END AS quantity,
         CASE WHEN unit_price > 0 THEN unit_price END AS unit_price,
         lower(trim(payment_method)) AS payment_method, lower(trim(order_status)) AS order_status,
         CASE WHEN regexp_matches(email, '{SIMPLE}') THEN email END AS email
  FROM dq),
clean AS (SELECT *, {_round("quantity * unit_price")} AS order_total FROM tidied)"""


def _report(source: str, raw: bool) -> str:
    parts = []
    for name, (check, strict) in REPORT_RULES.items():
        missing = "false" if raw and strict else "true"
        broken = f"count(*) FILTER (WHERE NOT coalesce({check}, {missing}))"
        parts.append(f"SELECT '{name}' AS rule, {broken} AS invalid_rows, {_pct(broken, 'count(*)')} AS pct_invalid FROM {source}")
    return " UNION ALL ".join(parts)


def _expectation(suite: str, position: int, kind: str, column: str, source: str, met: str = "", mostly: float = 1.0) -> str:
    nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
    if kind == "not_null":
        base, unexpected = "count(*)", nulls
    elif kind == "unique":
        base, unexpected = f"count({column})", "count(*) FILTER (WHERE copies > 1)"
        source = f"(SELECT {column}, CASE WHEN {column} IS NOT NULL THEN count(*) OVER (PARTITION BY {column}) END AS copies FROM {source})"
    else:
        base, unexpected = f"count({column})", f"count(*) FILTER (WHERE NOT ({met}))"
    return (
        f"SELECT '{suite}' AS suite, {position} AS position, '{kind}' AS expectation, '{column}' AS column, count(*) AS element_count, "
        f"{nulls} AS null_count, {unexpected} AS unexpected, {_pct(unexpected, base)} AS unexpected_pct, "
        f"1000 * ({base} - {unexpected}) >= {round(1000 * mostly)} * {base} AS success FROM {source}"
    )


_ORDERS_SUITE = [
    ("not_null", "order_id", "", 1.0),
    ("unique", "order_id", "", 1.0),
    ("not_null", "customer_id", "", 1.0),
    ("in_set", "country", f"country IN ({COUNTRY_LIST})", 1.0),
    ("in_set", "currency", f"currency IN ({CURRENCY_LIST})", 1.0),
    ("between", "quantity", "quantity BETWEEN 1 AND 100", 1.0),
    ("between", "unit_price", "unit_price BETWEEN 0.01 AND 10000", 1.0),
    ("between", "order_total", "order_total BETWEEN 0.01 AND 1000000", 1.0),
    ("in_set", "payment_method", "payment_method IN ('CARD', 'TRANSFER', 'CASH', 'PAYPAL')", 1.0),
    ("in_set", "order_status", "order_status IN ('P', 'O', 'F')", 1.0),
    ("regex", "email", f"regexp_matches(email, '{STRICT}')", 0.99),
    ("between", "order_ts", f"order_ts BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND {LAST_TS}", 1.0),
]
_CUSTOMERS_SUITE = [
    ("not_null", "c_custkey", "", 1.0),
    ("unique", "c_custkey", "", 1.0),
    ("in_set", "c_mktsegment", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')", 1.0),
    ("regex", "c_name", "regexp_matches(c_name, '^Customer#[0-9]{9}$')", 0.90),
    ("between", "c_acctbal", "c_acctbal BETWEEN 0 AND 9000", 0.80),
]
SUITE_ORDERS = " UNION ALL ".join(_expectation("orders_suite", i, k, c, "dq", m, t) for i, (k, c, m, t) in enumerate(_ORDERS_SUITE))
SUITE_CUSTOMERS = (
    "SELECT 'customers_suite' AS suite, 0 AS position, 'columns' AS expectation, '' AS column, count(*) AS element_count, "
    "0::BIGINT AS null_count, 0::BIGINT AS unexpected, 0.0::DOUBLE AS unexpected_pct, true AS success FROM customer UNION ALL "
    + " UNION ALL ".join(_expectation("customers_suite", i + 1, k, c, "customer", m, t) for i, (k, c, m, t) in enumerate(_CUSTOMERS_SUITE))
)
FK_CHECKED = """
fk_checked AS (SELECT coalesce(customer_id IN (SELECT c_custkey FROM customer), false) AS customer_exists FROM dirty)"""
SUITE_FK = _expectation("orders_fk_suite", 0, "in_set", "customer_exists", "fk_checked", "customer_exists")
ALL_SUITES = f"WITH {DQ}, {DIRTY}, {FK_CHECKED}, results AS ({SUITE_CUSTOMERS} UNION ALL {SUITE_ORDERS} UNION ALL {SUITE_FK})"


def _missing(column: str, source: str) -> str:
    return f"SELECT '{column}' AS column, {_pct(f'count(*) FILTER (WHERE {column} IS NULL)', 'count(*)')} AS pct_missing FROM {source}"


DIRTY_TYPES = {
    "order_key": "bigint", "order_id": "bigint", "customer_id": "bigint", "amount": "double", "order_date": "date", "status": "string",
}


def _outliers(column: str) -> str:
    return f"""SELECT '{column}' AS column, {_round('q1', 3)} AS q1, {_round('q3', 3)} AS q3, {_round('q3 - q1', 3)} AS iqr,
      {_round('q1 - 1.5 * (q3 - q1)', 3)} AS lower_limit, {_round('q3 + 1.5 * (q3 - q1)', 3)} AS upper_limit, outliers,
      {_pct('outliers', 'n')} AS pct_outliers
      FROM (SELECT q1, q3, count({column}) AS n, count(*) FILTER (WHERE {column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM lineitem, (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM lineitem) GROUP BY q1, q3)"""


def _describe(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column, count({column}) AS n, {_round(f'avg({value})', 4)} AS mean, {_round(f'stddev_samp({value})', 4)} AS std,
      min({value}) AS min, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3,
      max({value}) AS max FROM part"""


def _describe_text(column: str) -> str:
    return f"""SELECT '{column}' AS column, CAST(sum(n) AS BIGINT) AS n, count(*) AS distinct_values, first(value ORDER BY n DESC, value) AS top, max(n) AS freq
      FROM (SELECT {column} AS value, count(*) AS n FROM part WHERE {column} IS NOT NULL GROUP BY 1)"""


def _dictionary(column: str, kind: str, description: str) -> str:
    nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
    return f"""SELECT '{column}' AS column, '{description}' AS description, '{kind}' AS type, {nulls} AS nulls, {_pct(nulls, 'count(*)')} AS pct_nulls,
      count(DISTINCT {column}) AS distinct_values,
      (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM dirty WHERE {column} IS NOT NULL ORDER BY v LIMIT 3)) AS examples
      FROM dirty"""


SUMMARY_RULES = {
    "amount_not_negative": "coalesce(amount >= 0, false)",
    "customer_known": "coalesce(customer_id >= 0, false)",
    "date_present": "order_date IS NOT NULL",
    "status_valid": "status IN ('P', 'O', 'F')",
}


def _contract_failure(broken: str, column: str, check: str, value: str) -> str:
    shown = f"CAST({value} AS VARCHAR)" if value else "CAST(NULL AS VARCHAR)"
    return f"SELECT order_key, '{column}' AS column, '{check}' AS check, {shown} AS value FROM dq WHERE {broken}"


def _broken_fields() -> str:
    checks = {
        "order_id": "order_id IS NULL", "customer_id": "customer_id IS NULL", "quantity": "quantity <= 0",
        "order_status": "order_status NOT IN ('P', 'O', 'F')",
    }
    return ", ".join(f"CASE WHEN {check} THEN '{name}' END" for name, check in checks.items())


def _drift(column: str, expected: str | None, actual: str | None, state: str, source: str, by: str = "") -> str:
    def text(value: str | None) -> str:
        return f"'{value}'" if value else "CAST(NULL AS VARCHAR)"

    filled = _pct(f"count({column})", "count(*)") if actual else "0.0"
    return (
        f"SELECT {by + ', ' if by else ''}'{column}' AS column, {text(expected)} AS expected_type, {text(actual)} AS actual_type, "
        f"'{state}' AS state, {filled} AS pct_filled FROM {source}{' GROUP BY ' + by if by else ''}"
    )


UNESCAPED = (
    "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
)
ACCENTED, PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc"

LOOSE_FIELDS = """
        SELECT event_id, '$.k' AS path, CASE WHEN event_id % 5 = 0 THEN 'STRING' ELSE 'BIGINT' END AS kind,
               CASE WHEN event_id % 5 = 0 THEN '"' || k || '"' ELSE k END AS value FROM loose
        UNION ALL SELECT event_id, '$.tags[0]', 'STRING', '"' || event_type || '"' FROM loose WHERE event_id % 3 = 0
        UNION ALL SELECT event_id, '$.tags[1].deep', 'BIGINT', CAST(event_id AS VARCHAR) FROM loose WHERE event_id % 3 = 0
        UNION ALL SELECT event_id, '$.seen.by', 'VOID', 'null' FROM loose WHERE event_id % 3 = 1
        UNION ALL SELECT event_id, '$.seen.ok', 'BOOLEAN', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END FROM loose WHERE event_id % 3 = 1
        UNION ALL SELECT event_id, '$.tags', 'ARRAY', '[]' FROM loose WHERE event_id % 3 = 2"""
LOOSE = "WITH loose AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events WHERE event_id % 11 <> 0)"

ORACLE: dict[str, str] = {
    "gold_daily_sales": f"""WITH {REASONED}
        SELECT order_date, count(order_id) AS total_orders, {_total('amount')} AS total_revenue, {_mean('amount')} AS avg_ticket
        FROM valid GROUP BY order_date""",
    "sales_by_country": f"""WITH {REASONED}
        SELECT order_date, n_name AS country, count(order_id) AS total_orders, {_total('amount')} AS total_revenue
        FROM valid JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "silver_orders": f"WITH {SALES} SELECT * FROM sales",
    "agg_daily_sales": f"""WITH {SALES}
        SELECT order_date, country, category, count(*) AS total_orders, coalesce(sum(quantity), 0) AS total_units,
               {_total('gross_amount')} AS total_revenue, CASE WHEN count(gross_amount) > 0 THEN {_mean('gross_amount')} END AS avg_ticket
        FROM sales WHERE status = 'F' GROUP BY order_date, country, category""",
    "customer_ltv": f"""WITH {SALES}
        SELECT customer_id, country, count(*) AS paid_orders, {_total('gross_amount')} AS lifetime_value, max(order_date) AS last_order_date
        FROM sales WHERE status = 'F' GROUP BY customer_id, country""",
    "customer_ltv_merged": f"""WITH {SALES}
        SELECT customer_id, country, count(*) AS paid_orders, {_total('gross_amount')} AS lifetime_value, max(order_date) AS last_order_date
        FROM sales WHERE status = 'F' GROUP BY customer_id, country""",
    "customer_segment": """
        SELECT o_orderkey, CASE WHEN o_custkey % 50 <> 0
                 AND date_diff('day', DATE '1998-01-01' + CAST(o_custkey % 400 AS INTEGER), CAST(o_orderdate AS DATE)) <= 30
               THEN 'new' ELSE 'existing' END AS segment
        FROM orders""",
    "net_revenue": f"""
        SELECT l_orderkey, l_linenumber, {_round('l_extendedprice * (1 - l_discount)', 4)} AS net,
               {_round('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 4)} AS taxed FROM lineitem""",
    "approved_by_group": f"SELECT o_orderpriority, {_total('o_totalprice')} AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "partial_final_sum": f"SELECT o_orderpriority, {_total('o_totalprice')} AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "table_stats": f"""
        SELECT count(*) AS n_rows, min(o_totalprice) AS lowest, max(o_totalprice) AS highest, {_total('o_totalprice')} AS total,
               {_mean('o_totalprice')} AS mean FROM orders""",
    "product_agg": "SELECT l_orderkey, product(l_linenumber) AS product FROM lineitem GROUP BY 1",
    "top_values": f"""WITH {REASONED}
        SELECT reject_reason AS value, count(*) AS n FROM reasoned GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 5""",
    "revenue_drop": f"""
        WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, {_total('o_totalprice')} AS r FROM orders GROUP BY 1),
        seen AS (SELECT d, r, avg(r) OVER w AS m, count(r) OVER w AS h FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
        SELECT d AS run_date, r AS revenue, {_round('m')} AS trailing_mean, {_round('r / m', 4)} AS ratio
        FROM seen WHERE h >= 3 AND m > 0 AND r / m < 0.60""",
    "drop_alerts": f"""
        WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, {_total('o_totalprice')} AS r FROM orders GROUP BY 1),
        seen AS (SELECT d, r, avg(r) OVER w AS m, count(r) OVER w AS h FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
        SELECT 'run-1' AS run_id, 'REVENUE_DROP' AS alert_type, 'MEDIUM' AS severity,
               printf('revenue drop on %s: revenue %.2f, trailing mean %.2f, ratio %.4f', CAST(d AS VARCHAR), r, {_round('m')}, {_round('r / m', 4)}) AS message
        FROM seen WHERE h >= 3 AND m > 0 AND r / m < 0.60""",
    "run_summary": """
        WITH log AS (
          SELECT ts, CAST(user_id AS VARCHAR) AS run_id, event_type AS stage, CAST(floor(value) AS BIGINT) AS rows_ok,
                 CASE WHEN event_type = 'error' THEN 'FAILED' WHEN value > 30 THEN 'STARTED' ELSE 'OK' END AS status,
                 event_type = 'error' AS failed
          FROM events)
        SELECT run_id, stage, min(ts) AS first_ts, max(ts) AS last_ts, last(status ORDER BY ts, status) AS last_status, count(*) AS n_events,
               CAST(coalesce(sum(rows_ok), 0) AS BIGINT) AS rows_ok, count(*) FILTER (WHERE failed) AS rows_reject, count(*) FILTER (WHERE failed) AS errors
        FROM log GROUP BY run_id, stage""",
    "failure_alerts": """
        SELECT ts AS alert_ts, CAST(user_id AS VARCHAR) AS run_id, 'PIPELINE_FAILURE' AS alert_type, 'HIGH' AS severity,
               '[' || event_type || '/events] ' || props AS message
        FROM events WHERE event_type = 'error'""",
    "reject_reason": f"WITH {REASONED} SELECT reject_reason, count(*) AS n FROM reasoned WHERE reject_reason IS NOT NULL GROUP BY 1",
    "valid_orders": f"WITH {REASONED} SELECT * FROM valid",
    "reject_rate": f"""WITH {REASONED}
        SELECT count(*) AS total, count(reject_reason) AS rejected, round(count(reject_reason) / count(*), 6) AS rate FROM reasoned""",
    "contract_failures": f"WITH {DQ} " + " UNION ALL ".join([
        _contract_failure("order_id IS NULL", "order_id", "not_null", ""),
        "SELECT order_key, 'order_id' AS column, 'unique' AS check, CAST(order_id AS VARCHAR) AS value "
        "FROM (SELECT *, count(*) OVER (PARTITION BY order_id) AS copies FROM dq WHERE order_id IS NOT NULL) WHERE copies > 1",
        _contract_failure("customer_id IS NULL", "customer_id", "not_null", ""),
        _contract_failure(f"currency NOT IN ({CURRENCY_LIST})", "currency", "allowed value", "currency"),
        _contract_failure("quantity <= 0", "quantity", "above 0", "quantity"),
        _contract_failure("order_status NOT IN ('P', 'O', 'F')", "order_status", "allowed value", "order_status"),
        _contract_failure("abs(order_total - quantity * unit_price) >= 0.01", "", "total is quantity * price", ""),
    ]),
    "contract_orders": f"""WITH {DQ}
        SELECT order_key, concat_ws(',', {_broken_fields()}) AS broken_fields FROM dq WHERE concat_ws(',', {_broken_fields()}) <> ''""",
    "schema_drift": f"WITH {DIRTY} " + " UNION ALL ".join([
        _drift("order_id", "bigint", "bigint", "same", "dirty"),
        _drift("customer_id", "int", "bigint", "retyped", "dirty"),
        _drift("amount", "double", "double", "same", "dirty"),
        _drift("order_date", "date", "date", "same", "dirty"),
        "SELECT 'channel' AS column, 'string' AS expected_type, CAST(NULL AS VARCHAR) AS actual_type, 'missing' AS state, 0.0 AS pct_filled",
        _drift("status", None, "string", "added", "dirty"),
    ]),
    "nested_drift": """
        WITH filled AS (SELECT count(*) AS n, count(event_id) AS event_id, count(*) FILTER (event_id % 4 > 0 AND json_extract_string(props, '$.k') IS NOT NULL) AS k,
                        count(event_type) AS kind, count(user_id) AS person, count(*) FILTER (event_id % 3 > 0) AS items,
                        count(*) FILTER (event_id % 3 > 0 AND event_type IS NOT NULL) AS name, count(*) FILTER (event_id % 3 = 1 AND value IS NOT NULL) AS weight FROM events)
        SELECT path, expected_type, actual_type, state, round(CAST(100 * found AS DECIMAL(38, 6)) / n, 2)::DOUBLE AS pct_filled FROM filled, LATERAL (VALUES
          ('event_id', 'int', 'bigint', 'widened', event_id), ('note', 'string', NULL, 'missing', 0), ('props', 'struct', 'struct', 'same', n),
          ('props.k', 'bigint', 'int', 'narrowed', k), ('props.kind', 'string', 'string', 'same', kind), ('props.source', 'string', NULL, 'missing', 0),
          ('props.user', NULL, 'bigint', 'added', person), ('items', 'array', 'array', 'same', items), ('items[]', 'struct', 'struct', 'same', items),
          ('items[].name', 'string', 'string', 'same', name), ('items[].weight', 'float', 'double', 'widened', weight))
          AS v(path, expected_type, actual_type, state, found)""",
    "schema_drift_by_status": f"WITH {DIRTY} " + " UNION ALL ".join([
        _drift("order_id", "bigint", "bigint", "same", "dirty", "status"),
        _drift("customer_id", "bigint", "bigint", "same", "dirty", "status"),
        _drift("amount", "double", "double", "same", "dirty", "status"),
    ]),
    "dq_flags": f"WITH {FLAGGED} SELECT order_key, {', '.join(FLAG_SQL)}, CAST(len(failed) AS INTEGER) AS n_failed FROM flagged",
    "dq_silver": f"""WITH {FLAGGED}
        SELECT order_key, order_id, customer_id, order_ts, country, currency, quantity, unit_price, order_total, payment_method, order_status, email
        FROM flagged WHERE len(failed) = 0""",
    "dq_quarantine": f"""WITH {FLAGGED}
        SELECT order_key, order_id, customer_id, dup_count, array_to_string(failed, ',') AS failed_rules FROM flagged WHERE len(failed) > 0""",
    "rule_frequency": f"""WITH {FLAGGED}
        SELECT failed_rule, count(*) AS n FROM (SELECT unnest(failed) AS failed_rule FROM flagged) GROUP BY 1""",
    "dq_reconcile": f"""WITH {FLAGGED}
        SELECT count(*) AS raw_count, count(*) FILTER (WHERE len(failed) = 0) AS silver_count,
               count(*) FILTER (WHERE len(failed) > 0) AS quarantine_count, true AS balanced FROM flagged""",
    "suite_orders": f"WITH {DQ} {SUITE_ORDERS}",
    "suite_customers": SUITE_CUSTOMERS,
    "suite_fk": f"WITH {DIRTY}, {FK_CHECKED} {SUITE_FK}",
    "dq_gate": f"""{ALL_SUITES}
        SELECT suite, bool_and(success) AS success FROM results GROUP BY suite
        UNION ALL SELECT 'overall' AS suite, bool_and(success) AS success FROM results""",
    "dq_audit": f"""{ALL_SUITES}
        SELECT suite, bool_and(success) AS success, count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful,
               count(*) FILTER (WHERE NOT success) AS unsuccessful FROM results GROUP BY suite""",
    "fk_flag": f"""WITH {DIRTY}
        SELECT order_key, customer_id, coalesce(customer_id IN (SELECT c_custkey FROM customer), false) AS customer_exists FROM dirty""",
    "fk_orphans": f"""WITH {DIRTY}
        SELECT order_key, customer_id, amount FROM dirty WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)""",
    "clean_orders": f"WITH {CLEAN} SELECT * REPLACE (CAST(order_ts AS DATE) AS order_ts) FROM clean",
    "rule_report": f"WITH {DQ} {_report('dq', True)}",
    "rule_report_clean": f"WITH {CLEAN} {_report('clean', False)}",
    "rule_improvement": f"""WITH {CLEAN}, before AS ({_report('dq', True)}), after AS ({_report('clean', False)})
        SELECT rule, before.pct_invalid AS pct_invalid_raw, after.pct_invalid AS pct_invalid_clean,
               {_round('before.pct_invalid - after.pct_invalid')} AS improvement_points
        FROM before JOIN after USING (rule)""",
    "raw_vs_clean": f"WITH {CLEAN} " + " UNION ALL ".join(
        f"""SELECT '{label}' AS dataset, count(*) AS n_rows, 12 AS n_columns,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicates,
              {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in ('order_id', 'customer_id', 'order_ts', 'country', 'currency', 'quantity', 'unit_price', 'order_total', 'email'))} AS null_cells
              FROM {source}"""
        for label, source in (("raw", "dq"), ("clean", "clean"))
    ),
    "email_valid": f"WITH {DQ} SELECT regexp_matches(email, '{SIMPLE}') AS valid, count(*) AS n FROM dq GROUP BY 1",
    "profile_missing": f"WITH {DIRTY} " + " UNION ALL ".join(_missing(c, "dirty") for c in DIRTY_TYPES),
    "profile_cardinality": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{t}' AS type, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, "
        f"{_pct(f'count(DISTINCT {c})', 'count(*)')} AS pct_distinct FROM dirty"
        for c, t in DIRTY_TYPES.items()
    ),
    "profile_duplicates": f"""
        WITH sums AS (SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates FROM lineitem)
        SELECT n_rows, duplicates, {_pct('duplicates', 'n_rows')} AS pct_duplicates FROM sums""",
    "profile_iqr": " UNION ALL ".join(_outliers(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "profile_describe": " UNION ALL ".join(_describe(c) for c in ("p_partkey", "p_size", "p_retailprice")),
    "profile_describe_text": " UNION ALL ".join(_describe_text(c) for c in ("p_name", "p_brand", "p_type")),
    "data_dictionary": f"WITH {DIRTY} " + " UNION ALL ".join(
        _dictionary(c, t, {"amount": "Order value.", "order_date": "Day of the order."}.get(c, "")) for c, t in DIRTY_TYPES.items()
    ),
    "dataset_summary": f"WITH {DIRTY}, gaps AS (" + " UNION ALL ".join(_missing(c, "dirty") for c in DIRTY_TYPES) + "), broken AS ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS rule, {_pct(f'count(*) FILTER (WHERE NOT ({check}))', 'count(*)')} AS pct FROM dirty"
            for name, check in SUMMARY_RULES.items()
        ) + f""")
        SELECT 'size' AS section, 'rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM dirty
        UNION ALL SELECT 'size', 'columns', {float(len(DIRTY_TYPES))}
        UNION ALL SELECT 'size', 'exact_duplicates', CAST((SELECT count(*) FROM dirty) - count(*) AS DOUBLE) FROM (SELECT DISTINCT * FROM dirty)
        UNION ALL SELECT 'missing', * FROM (SELECT "column", pct_missing FROM gaps ORDER BY pct_missing DESC, "column" LIMIT 5)
        UNION ALL SELECT 'rules', * FROM (SELECT rule, pct FROM broken ORDER BY pct DESC, rule LIMIT 5)""",
    "dup_count": f"WITH {DIRTY} SELECT order_key, order_id, count(*) OVER (PARTITION BY order_id) AS copies FROM dirty",
    "duplicated_keys": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "latest_per_key": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "dedupe_rows": "SELECT DISTINCT * FROM lineitem",
    "dim_networks": """
        SELECT s_suppkey AS network_id, s_name AS network_name, s_nationkey AS country_key, 'broadcast' AS network_type FROM supplier
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, 'web' FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "dim_shows": """
        WITH shows AS (
          SELECT CASE WHEN p_partkey % 40 = 0 THEN NULL WHEN p_partkey % 30 = 1 THEN p_partkey + 1 ELSE p_partkey END AS show_id,
                 p_name AS show_name, p_type AS show_type, CAST(NULL AS VARCHAR) AS show_language, p_brand AS show_network_name FROM part)
        SELECT * FROM shows WHERE show_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY show_id ORDER BY show_name, show_type, show_network_name) = 1""",
    "dim_time": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayname(d) IN ('Saturday', 'Sunday') AS is_weekend
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "fact_orders": f"""WITH {DIRTY},
        lines AS (
          SELECT *, CAST(l_shipdate AS DATE) AS shipped FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY CAST(l_shipdate AS DATE), l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1)
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(strftime(coalesce(order_date, shipped), '%Y%m%d') AS INTEGER) AS date_key,
               coalesce(customer_id, l_suppkey) AS partner_id, l_quantity, l_extendedprice
        FROM lines LEFT JOIN dirty ON l_orderkey = order_key""",
    "flatten_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k FROM events",
    "bronze_events": """
        SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k,
               'events' AS dataset_name, 'events.parquet' AS source_file, 'batch-1' AS batch_id,
               '2024-02-01T00:00:00' AS ingestion_ts, '2024-02-01' AS run_date FROM events""",
    "silver_events": """
        SELECT DISTINCT user_id, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS weight,
               event_type || ',k' || json_extract_string(props, '$.k') AS labels FROM events""",
    "with_lineage": """
        SELECT o_orderkey, o_totalprice, 'orders' AS dataset_name, 'orders.parquet' AS source_file, 'batch-1' AS batch_id,
               '2024-02-01 00:00:00' AS ingestion_ts, '2024-02-01' AS run_date FROM orders""",
    "typed_projection": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               o_totalprice AS amount, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS source FROM orders""",
    "coerced_projection": """
        SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day FROM events""",
    "rename_columns": "SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderpriority AS order_priority FROM orders",
    "select_or_null": "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment, o_totalprice FROM orders",
    "array_to_text": "SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ',') AS words FROM part",
    "amount_band": "SELECT o_orderkey, CASE WHEN o_totalprice >= 150000 THEN 'ALTO' ELSE 'BAJO' END AS band FROM orders",
    "safe_cast_sum": f"""
        WITH raw AS (SELECT TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'error' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS v FROM events)
        SELECT count(v) AS valid, {_total('v')} AS total FROM raw""",
    "hof_pipeline": """
        SELECT doc_id, CAST(coalesce(list_sum(list_filter(list_transform(string_split(text, ' '), lambda w: length(w) * 2), lambda n: n > 10)), 0) AS INTEGER) AS total
        FROM documents""",
    "map_sum": f"""
        SELECT l_orderkey, l_linenumber, {_round('0.0::DOUBLE + l_quantity + l_discount + l_tax', 4)} AS total,
               {_round('(0.0::DOUBLE + l_quantity + l_discount + l_tax) / 3', 4)} AS mean FROM lineitem""",
    "clean_text": rf"""
        WITH folded AS (SELECT *, translate(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '{ACCENTED}', '{PLAIN}') AS f FROM documents)
        SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE lang END AS language,
               replace(lower(source), 'src', 'source ') AS source, CAST(length(f) AS INTEGER) AS n_chars, md5(f) AS text_md5 FROM folded""",
    "extract_number": r"""
        SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '([\d.]+)', 1) AS DOUBLE) AS number, contains(lower(p_name), 'ring') AS is_ring FROM part""",
    "stream_sales_lines": """
        SELECT event_id AS id, value * 20 AS amount, CASE WHEN value * 20 >= 500 THEN 'ALTO' ELSE 'BAJO' END AS band
        FROM events WHERE event_id % 10 <> 0""",
    "mult3_squares": """
        SELECT DISTINCT o_orderkey AS number, o_orderkey * o_orderkey AS square FROM orders
        WHERE o_orderkey > 0 AND o_orderkey % 3 = 0 ORDER BY number LIMIT 10""",
    "page_titles": f"SELECT page_id, {UNESCAPED.format('''regexp_extract(html, '(?s)<title>(.*?)</title>', 1)''')} AS title FROM pages",
    "page_links": """
        WITH found AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS links FROM pages)
        SELECT page_id, CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS position, unnest(links) AS link FROM found""",
    "page_items": f"""
        WITH blocks AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li>.*?</li>')) AS block FROM pages)
        SELECT page_id,
               CASE WHEN regexp_matches(block, 'href="([^"]*)"') THEN {UNESCAPED.format('''trim(regexp_extract(block, 'href="([^"]*)"', 1))''')} END AS target,
               CASE WHEN regexp_matches(block, '<a [^>]*>([^<]*)</a>') THEN {UNESCAPED.format('''trim(regexp_extract(block, '<a [^>]*>([^<]*)</a>', 1))''')} END AS label
        FROM blocks""",
    "messages_flat": """
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT conv_id, turn, 'answer', substr(text, 1, 40) FROM conversations""",
    "product_listing": """
        SELECT p_partkey, p_name AS product_name, round(CAST(p_retailprice AS DECIMAL(20, 6)), 2)::DOUBLE AS price, 'GBP' AS currency,
               p_partkey % 5 <> 0 AS in_stock, 'books_to_scrape' AS source FROM part""",
    "merged_columns": """
        SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey ELSE o_custkey END AS ref_no, o_orderpriority AS priority FROM orders""",
    "distinct_maps": "SELECT DISTINCT 'kind=' || event_type || ',weight=' || json_extract_string(props, '$.k') AS facts FROM events",
    "parsed_days": "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(ts AS DATE) END AS day FROM events",
    "retail_silver": f"""
        SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderdate AS order_ts, o_custkey AS customer_id, o_custkey AS product_id,
               n_name AS country, p_type AS category,
               CASE WHEN CAST(o_orderdate AS DATE) - (DATE '1995-01-01' + CAST(o_custkey % 2000 AS INTEGER)) <= 30 THEN 'new' ELSE 'existing' END AS customer_segment,
               o_orderkey % 6 AS quantity, p_retailprice AS unit_price, {_round('(o_orderkey % 6) * p_retailprice')} AS gross_amount, o_orderstatus AS status,
               CASE WHEN paid THEN o_orderkey * 10 END AS payment_id, CASE WHEN paid THEN o_totalprice END AS amount, CASE WHEN paid THEN 'EUR' END AS currency,
               CASE WHEN paid THEN o_orderpriority END AS payment_method, CASE WHEN paid THEN o_orderdate END AS paid_at
        FROM (SELECT *, o_orderstatus = 'F' AS paid FROM orders) LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN part ON o_custkey = p_partkey AND p_size > 5 WHERE o_orderkey % 6 > 0""",
    "document_fields": f"{LOOSE} {LOOSE_FIELDS}",
    "document_field_kinds": f"""
        {LOOSE}, fields AS ({LOOSE_FIELDS})
        SELECT regexp_replace(path, '\\[[0-9]+\\]', '[]', 'g') AS path, kind, count(*) AS n FROM fields GROUP BY 1, 2""",
    "document_rejects": """
        WITH cut AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events WHERE event_id % 11 = 0)
        SELECT event_id, '{"k": ' || CASE WHEN event_id % 5 = 0 THEN '"' || k || '"' ELSE k END ||
               CASE event_id % 3 WHEN 0 THEN ', "tags": ["' || event_type || '", {"deep": ' || event_id || '}]'
                                 WHEN 1 THEN ', "seen": {"by": null, "ok": ' || (event_id % 2 = 0) || '}' ELSE ', "tags": []' END AS text FROM cut""",
    "messages_any_shape": """
        SELECT conv_id, 0 AS place, CASE WHEN conv_id % 3 <> 1 THEN turn END AS turn, role, text, CASE WHEN conv_id % 3 = 2 THEN CAST(length(text) AS INTEGER) END AS size,
               'OBJECT<role: STRING, ' || CASE WHEN conv_id % 3 = 2 THEN 'size: BIGINT, ' ELSE '' END || 'text: STRING, turn: ' ||
               CASE WHEN conv_id % 3 = 1 THEN 'STRING>' ELSE 'BIGINT>' END AS shape FROM conversations""",
    "missing_days": """
        WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
        span AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM days), (SELECT max(day) FROM days), INTERVAL 1 DAY)) AS DATE) AS day),
        gone AS (SELECT user_id, day FROM (SELECT DISTINCT user_id FROM events), span WHERE (user_id, day) NOT IN (SELECT user_id, day FROM days)),
        islands AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS island FROM gone)
        SELECT user_id, min(day) AS first_day, max(day) AS last_day, CAST(count(*) AS INTEGER) AS n_days FROM islands GROUP BY user_id, island""",
    "incremental_window": """
        SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders
        WHERE o_orderdate > TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-06-29 00:00:00'""",
    "replace_range": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN CAST(o_orderdate AS DATE) > DATE '1997-01-01' AND CAST(o_orderdate AS DATE) <= DATE '1997-12-31'
                    THEN {_round('o_totalprice * 1.1::DOUBLE')} ELSE o_totalprice END AS o_totalprice FROM orders""",
    "upsert_control": """
        WITH old AS (SELECT o_custkey AS customer_id, CAST(max(o_orderdate) AS DATE) AS last_load FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1),
        new AS (SELECT o_custkey AS customer_id, CAST(max(o_orderdate) AS DATE) AS last_load FROM orders WHERE o_orderdate >= DATE '1998-01-01' GROUP BY 1)
        SELECT coalesce(new.customer_id, old.customer_id) AS customer_id, coalesce(new.last_load, old.last_load) AS last_load,
               CASE WHEN new.customer_id IS NULL THEN 'F' ELSE 'I' END AS load_mode,
               CASE WHEN old.customer_id IS NOT NULL THEN 'o_orderdate' END AS date_column
        FROM old FULL JOIN new ON old.customer_id = new.customer_id""",
}
