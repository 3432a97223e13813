"""The same queries in SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from tidebook.functions.dates import WEEKDAY_NAMES
from tidebook.plans import registry as r
from tidebook.plans.weekdays import OTHER, WORST

MONEY = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"
NAMES = "[" + ", ".join(f"'{name}'" for name in WEEKDAY_NAMES) + "]"

DAILY = f"""
bounds AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
sold AS (
  SELECT CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n_orders,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM orders WHERE o_orderpriority = '{r.PHYSICAL}' GROUP BY 1),
daily AS (
  SELECT days.date, CAST(isodow(days.date) AS INTEGER) AS weekday,
         {NAMES}[isodow(days.date)] AS weekday_name,
         COALESCE(n_orders, 0) AS n_orders, COALESCE(amount, 0) AS amount
  FROM days LEFT JOIN sold ON days.date = sold.date)"""

WEEKDAY_ROWS = f"""
totals AS (
  SELECT weekday, weekday_name, COUNT(*) AS calendar_days,
         COUNT(*) FILTER (WHERE n_orders = 0) AS days_without_sales,
         CAST(SUM(amount) AS DOUBLE) AS total_value
  FROM daily GROUP BY ALL),
averages AS (
  SELECT weekday, weekday_name, round_even(total_value / calendar_days, 2) AS average_sales,
         calendar_days, days_without_sales, total_value FROM totals),
weekdays AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY total_value / calendar_days, weekday) = 1
    THEN '{WORST}' ELSE '{OTHER}' END AS label
  FROM averages)"""

BOUNDED = DAILY.replace(
    "SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders",
    f"SELECT DATE '{r.CALENDAR_FROM}' AS lo, DATE '{r.CALENDAR_TO}' AS hi",
)

PROFILE = f"""
spent AS (
  SELECT o_custkey AS customer_id, {MONEY} AS revenue, COUNT(*) AS frequency
  FROM orders GROUP BY 1),
bought AS (
  SELECT o_custkey AS customer_id, COUNT(DISTINCT p_brand) AS n_categories
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1),
profile AS (
  SELECT customer_id, revenue, frequency, round_even(revenue / frequency, 2) AS average_ticket,
         COALESCE(n_categories, 0) AS category_diversity
  FROM spent LEFT JOIN bought USING (customer_id))"""


def _ranking(min_categories: int) -> str:
    return f"""{PROFILE},
ranking AS (
  SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY average_ticket DESC, customer_id) AS INTEGER) AS position
  FROM profile WHERE category_diversity >= {min_categories}
  QUALIFY position <= {r.TOP_CUSTOMERS})"""


def _loyal(min_categories: int) -> str:
    return f"""WITH {_ranking(min_categories)}
SELECT customer_id, c_name AS customer, revenue, frequency, average_ticket, category_diversity, position
FROM ranking JOIN customer ON customer_id = c_custkey"""


def _categories(min_categories: int) -> str:
    return f"""WITH {_ranking(min_categories)},
units AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS category_id, p_brand AS category,
         CAST(SUM(l_quantity) AS BIGINT) AS n_items
  FROM ranking JOIN orders ON customer_id = o_custkey
  JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY n_items DESC, category_id) AS INTEGER) AS position FROM units"""


UNITS = """
units AS (
  SELECT l_partkey AS product_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(SUM(l_quantity) AS BIGINT) AS units
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

DENSE = f"""{UNITS},
bounds AS (
  SELECT date_trunc('month', MIN(o_orderdate)) AS lo, date_trunc('month', MAX(o_orderdate)) AS hi FROM orders),
months AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds),
dense AS (
  SELECT p_partkey AS product_id, months.month, COALESCE(units, 0) AS units
  FROM part CROSS JOIN months
  LEFT JOIN units ON units.product_id = p_partkey AND units.month = months.month)"""

def _forecast(first, last) -> str:
    return f"""{DENSE},
framed AS (
  SELECT product_id, month, units AS actual,
         CASE WHEN COUNT(*) OVER w = 3 THEN CAST(SUM(units) OVER w AS BIGINT) END AS history
  FROM dense WINDOW w AS (PARTITION BY product_id ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
forecast AS (
  SELECT product_id, month, actual, history, CAST(history AS DOUBLE) / 3 AS predicted,
         ABS(actual - CAST(history AS DOUBLE) / 3) AS abs_error
  FROM framed WHERE month BETWEEN DATE '{first}' AND DATE '{last}')"""


FORECAST = _forecast(r.TEST_FROM, r.TEST_TO)

ERRORS = """COUNT(*) AS n_forecasts,
  CAST(SUM(ABS(3 * actual - history)) AS DOUBLE) / (3 * COUNT(*)) AS mae,
  CAST(SUM(history) AS DOUBLE) / 3 AS predicted_sum,
  CAST(round_even(CAST(SUM(history) AS DOUBLE) / 3, 0) AS BIGINT) AS predicted_sum_rounded"""

PAIRS = """
pairs AS (
  SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
counts AS (SELECT product_id, COUNT(*) AS buyers FROM pairs GROUP BY 1)"""


def _similar(references: str) -> str:
    return f"""WITH {PAIRS},
refs AS ({references}),
together AS (
  SELECT mine.product_id AS reference_id, other.product_id, COUNT(*) AS co_buyers
  FROM refs JOIN pairs mine ON mine.product_id = refs.product_id
  JOIN pairs other ON other.customer_id = mine.customer_id AND other.product_id <> mine.product_id
  GROUP BY 1, 2),
ranked AS (
  SELECT t.reference_id, t.product_id, t.co_buyers, c.buyers,
         CAST(t.co_buyers AS DOUBLE) / sqrt(CAST(rc.buyers AS DOUBLE) * c.buyers) AS similarity,
         CAST(ROW_NUMBER() OVER (PARTITION BY t.reference_id
           ORDER BY CAST(t.co_buyers AS DOUBLE) * t.co_buyers / c.buyers DESC, t.product_id) AS INTEGER) AS position
  FROM together t JOIN counts c ON c.product_id = t.product_id
  JOIN counts rc ON rc.product_id = t.reference_id)
SELECT reference_id, position, product_id, p_name AS product, co_buyers, buyers, similarity
FROM ranked JOIN part ON product_id = p_partkey WHERE position <= {r.NEIGHBOURS}"""


BEST_SELLER = "SELECT product_id FROM counts ORDER BY buyers DESC, product_id LIMIT 1"
LEADERS = """SELECT product_id FROM counts JOIN part ON product_id = p_partkey
  QUALIFY ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY buyers DESC, product_id) = 1"""

# Columns of the star tables with the SQL that prints each the way an export does.
TEXT_TABLES = {
    "region": {"r_regionkey": "int", "r_name": "text"},
    "nation": {"n_nationkey": "int", "n_name": "text", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "int",
        "c_name": "text",
        "c_nationkey": "int",
        "c_acctbal": "amount",
        "c_mktsegment": "text",
    },
    "supplier": {"s_suppkey": "int", "s_name": "text", "s_nationkey": "int", "s_acctbal": "amount"},
    "part": {
        "p_partkey": "int",
        "p_name": "text",
        "p_brand": "text",
        "p_type": "text",
        "p_size": "int",
        "p_retailprice": "amount",
    },
    "orders": {
        "o_orderkey": "int",
        "o_custkey": "int",
        "o_orderstatus": "text",
        "o_totalprice": "amount",
        "o_orderdate": "time",
        "o_orderpriority": "text",
    },
    "lineitem": {
        "l_orderkey": "int",
        "l_partkey": "int",
        "l_suppkey": "int",
        "l_linenumber": "int",
        "l_quantity": "amount",
        "l_extendedprice": "amount",
        "l_discount": "amount",
        "l_tax": "amount",
        "l_returnflag": "text",
        "l_linestatus": "text",
        "l_shipdate": "time",
    },
}


def _values() -> str:
    parts = []
    for table, columns in TEXT_TABLES.items():
        for column in columns:
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name,"
                f" CAST({column} AS VARCHAR) AS v FROM {table}"
            )
    return "\nUNION ALL ".join(parts)


COLUMN_PROFILE = f"""
cells AS ({_values()}),
tested AS (
  SELECT *, regexp_matches(v, '^-?[0-9]+$') AS is_int, regexp_matches(v, '^-?[0-9]+[.][0-9]+$') AS is_dec,
         v IN ('true', 'false', 'TRUE', 'FALSE', 'True', 'False') AS is_bool,
         regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND TRY_CAST(v AS DATE) IS NOT NULL AS is_date,
         regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?$') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL AS is_ts
  FROM cells),
column_profile AS (
  SELECT table_name, column_name, COUNT(*) AS n, COUNT(*) - COUNT(v) AS n_null,
    COUNT(*) FILTER (WHERE is_bool) AS n_bool, COUNT(*) FILTER (WHERE is_int) AS n_int,
    COUNT(*) FILTER (WHERE is_dec) AS n_dec, COUNT(*) FILTER (WHERE is_date) AS n_date,
    COUNT(*) FILTER (WHERE is_ts) AS n_ts,
    COUNT(*) FILTER (WHERE (is_int OR is_dec) AND regexp_matches(v, '^-?0[0-9]')) AS n_lead0,
    CAST(MAX(length(v)) AS INTEGER) AS max_len,
    CAST(MAX(length(ltrim(split_part(v, '.', 1), '-'))) FILTER (WHERE is_int OR is_dec) AS INTEGER) AS max_whole,
    CAST(MAX(length(split_part(v, '.', 2))) FILTER (WHERE is_int OR is_dec) AS INTEGER) AS max_scale
  FROM tested GROUP BY 1, 2)"""

POSITIONS = ", ".join(
    f"('{table}', '{column}', {i})"
    for table, columns in TEXT_TABLES.items()
    for i, column in enumerate(columns)
)

_identifiers = ", ".join(f"'{c}'" for c in r.TEXT_COLUMNS)
INFERRED = f"""WITH {COLUMN_PROFILE}
SELECT table_name, column_name, CASE
  WHEN column_name IN ({_identifiers}) OR n_lead0 > 0 OR n = n_null THEN 'string'
  WHEN n_bool = n - n_null THEN 'boolean'
  WHEN n_int = n - n_null AND max_whole <= 18 THEN 'bigint'
  WHEN n_dec > 0 AND n_int + n_dec = n - n_null AND max_whole + max_scale <= 38
    THEN 'decimal(' || (max_whole + max_scale) || ',' || max_scale || ')'
  WHEN n_date = n - n_null THEN 'date'
  WHEN n_ts + n_date = n - n_null THEN 'timestamp_ntz'
  ELSE 'string' END AS spark_type
FROM column_profile"""

RECONCILE = (
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in TEXT_TABLES)
    + """), s AS (SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(SUM(n) AS BIGINT) FROM c)
SELECT table_name, n AS n_source, n AS n_loaded, CAST(0 AS BIGINT) AS diff FROM s"""
)

SIMILAR_TO_REFERENCE = _similar(BEST_SELLER)

EVENT_VALUES = """
WITH pairs AS (
  SELECT user_id AS entity, event_id, unnest([
    {'a': 'k', 'v': json_extract_string(props, '$.k')}, {'a': 'value', 'v': CAST(value AS VARCHAR)},
    {'a': 'event_type', 'v': event_type}, {'a': 'is_purchase', 'v': CAST(event_type = 'purchase' AS VARCHAR)},
    {'a': 'ts', 'v': strftime(ts, '%Y-%m-%d')}, {'a': 'shade', 'v': json_extract_string(props, '$.shade')}]) AS p
  FROM events),
typed AS (
  SELECT entity, event_id, p.a AS attribute,
    CASE p.a WHEN 'event_type' THEN 'text' WHEN 'is_purchase' THEN 'boolean' WHEN 'shade' THEN NULL ELSE 'number' END AS data_type,
    CASE WHEN p.a = 'event_type' THEN trim(p.v) END AS value_text,
    CASE WHEN p.a IN ('k', 'value') THEN TRY_CAST(p.v AS DOUBLE) END AS value_number,
    CASE WHEN p.a = 'is_purchase' THEN p.v = 'true' END AS value_boolean,
    CASE WHEN p.a = 'shade' THEN 'unknown attribute' WHEN trim(p.v) IS NULL OR trim(p.v) = '' THEN 'missing'
      WHEN p.a = 'ts' THEN 'not a number' END AS problem
  FROM pairs)"""

ORACLES: dict[str, str] = {
    "order_eda": """SELECT COUNT(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns,
  round_even(FSUM(o_totalprice) / COUNT(o_totalprice), 2) AS mean_value
FROM orders""",
    "sales_kpis": f"""SELECT {MONEY} AS total_value, COUNT(*) AS n_orders,
  COUNT(DISTINCT o_custkey) AS n_customers, round_even({MONEY} / COUNT(*), 2) AS average_ticket
FROM orders""",
    "monthly_sales": f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders,
  {MONEY} AS total_value, round_even({MONEY} / COUNT(*), 2) AS average_ticket FROM orders GROUP BY 1""",
    "sales_by_channel": f"""SELECT o_orderpriority AS channel, COUNT(*) AS n_orders,
  {MONEY} AS total_value, round_even({MONEY} / COUNT(*), 2) AS average_ticket FROM orders GROUP BY 1""",
    "status_distribution": f"""SELECT o_orderstatus AS status, COUNT(*) AS n_orders, {MONEY} AS total_value,
  CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share FROM orders GROUP BY 1""",
    "calendar_dim": f"""WITH {DAILY}
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day, weekday, weekday_name FROM daily""",
    "daily_sales_filled": f"""WITH {DAILY}
SELECT date, weekday, weekday_name, n_orders, CAST(amount AS DOUBLE) AS total_value FROM daily""",
    "weekday_avg_sales": f"WITH {DAILY}, {WEEKDAY_ROWS} SELECT * FROM weekdays",
    "weekday_avg_sales_bounded": f"WITH {BOUNDED}, {WEEKDAY_ROWS} SELECT * FROM weekdays",
    "worst_weekday": f"""WITH {DAILY}, {WEEKDAY_ROWS}
SELECT weekday, weekday_name, average_sales FROM weekdays WHERE label = '{WORST}'""",
    "weekday_avg_sales_tied": f"WITH {DAILY.replace(r.PHYSICAL, 'no such channel')}, {WEEKDAY_ROWS} SELECT * FROM weekdays",
    "customer_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "loyal_customers_top10": _loyal(0),
    "loyal_customers_diverse": _loyal(r.MIN_CATEGORIES),
    "loyal_categories": _categories(0),
    "loyal_categories_diverse": _categories(r.MIN_CATEGORIES),
    "monthly_demand": f"WITH {UNITS} SELECT * FROM units",
    "monthly_demand_dense": f"WITH {DENSE} SELECT * FROM dense",
    "demand_forecast": f"WITH {FORECAST} SELECT * FROM forecast",
    "demand_forecast_early": f"WITH {_forecast(r.EARLY_FROM, r.EARLY_TO)} SELECT * FROM forecast",
    "demand_forecast_late": f"WITH {_forecast(r.TEST_TO, r.LATE_TO)} SELECT * FROM forecast",
    "forecast_mae": f"WITH {FORECAST} SELECT {ERRORS} FROM forecast",
    "forecast_mae_by_product": f"WITH {FORECAST} SELECT product_id, {ERRORS} FROM forecast GROUP BY product_id",
    "customer_product_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "product_buyers": f"WITH {PAIRS} SELECT * FROM counts",
    "similar_to_reference": SIMILAR_TO_REFERENCE,
    "similar_to_category_leaders": _similar(LEADERS),
    "column_profile": f"WITH {COLUMN_PROFILE} SELECT * FROM column_profile",
    "column_ranges": f"""WITH cells AS ({_values()})
SELECT table_name, column_name, COUNT(DISTINCT v) AS n_distinct, MIN(v) AS min_value, MAX(v) AS max_value
FROM cells GROUP BY 1, 2""",
    "inferred_schema": INFERRED,
    "schema_ddl": f"""WITH types AS ({INFERRED}), places(table_name, column_name, place) AS (VALUES {POSITIONS})
SELECT table_name, 'CREATE TABLE `' || table_name || '` (' || chr(10)
  || string_agg('  `' || column_name || '` ' || spark_type, ',' || chr(10) ORDER BY place)
  || chr(10) || ')' AS ddl
FROM types JOIN places USING (table_name, column_name) GROUP BY table_name""",
    "load_reconcile": RECONCILE,
    "loaded_orders_sql": f"""SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n_orders, {MONEY} AS total_value,
  CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day
FROM orders GROUP BY 1, 2""",
    "loaded_weekday_avg_sales": f"WITH {DAILY}, {WEEKDAY_ROWS} SELECT * FROM weekdays",
    "mart_loyal_customers": f"""SELECT customer_id, customer AS cliente, revenue AS faturamento_total,
  frequency AS frequencia, average_ticket AS ticket_medio, category_diversity AS diversidade_categorias,
  position AS posicao FROM ({_loyal(0)})""",
    "mart_loyal_categories": f"""SELECT category_id, category AS categoria, n_items AS quantidade_itens,
  position AS posicao FROM ({_categories(0)})""",
    "mart_weekdays": f"""WITH {DAILY}, {WEEKDAY_ROWS}
SELECT weekday AS ordem_dia, weekday_name AS dia_semana, average_sales AS media_vendas,
  calendar_days AS dias_calendario, days_without_sales AS dias_sem_venda, total_value AS valor_total,
  label AS destaque FROM weekdays""",
    "mart_forecast": f"""WITH {FORECAST},
best AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY SUM(l_quantity) DESC, l_partkey LIMIT 1)
SELECT month AS mes, actual AS real, predicted AS previsto, abs_error AS erro_absoluto
FROM forecast JOIN best ON product_id = l_partkey""",
    "mart_recommendations": f"""SELECT position AS posicao, product_id, product AS produto,
  similarity AS similaridade FROM ({SIMILAR_TO_REFERENCE})""",
    "mart_overview": f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, o_orderpriority AS canal,
  o_orderstatus AS status, COUNT(*) AS pedidos, {MONEY} AS valor_total,
  round_even({MONEY} / COUNT(*), 2) AS ticket_medio FROM orders GROUP BY 1, 2, 3""",
    "mart_kpis": f"""SELECT {MONEY} AS valor_total, COUNT(*) AS pedidos, COUNT(DISTINCT o_custkey) AS clientes,
  round_even({MONEY} / COUNT(*), 2) AS ticket_medio FROM orders""",
    "rejected_mart": """SELECT 'mart: 1 approved rows missing, 1 rows not approved' AS message,
  CAST(0 AS INTEGER) AS n_marts, COUNT(*) AS n_orders FROM orders""",
    "published_marts": f"""WITH {FORECAST}
SELECT 'kpis' AS table_name, CAST(1 AS BIGINT) AS n_rows UNION ALL
SELECT 'overview' AS table_name, COUNT(*) AS n_rows FROM (
  SELECT DISTINCT date_trunc('month', o_orderdate), o_orderpriority, o_orderstatus FROM orders)
UNION ALL SELECT 'loyal_customers', COUNT(*) FROM ({_loyal(0)})
UNION ALL SELECT 'loyal_categories', COUNT(*) FROM ({_categories(0)})
UNION ALL SELECT 'weekdays', COUNT(DISTINCT isodow(o_orderdate)) FROM orders
UNION ALL SELECT 'forecast', COUNT(DISTINCT month) FROM forecast
UNION ALL SELECT 'recommendations', COUNT(*) FROM ({SIMILAR_TO_REFERENCE})""",
}

ORACLES["typed_event_values"] = f"{EVENT_VALUES} SELECT * FROM typed"
ORACLES["event_value_problems"] = f"""{EVENT_VALUES}
SELECT attribute, problem, COUNT(*) AS n_rows FROM typed GROUP BY ALL"""
ORACLES["event_value_spellings"] = f"""{EVENT_VALUES},
spelled AS (SELECT attribute, value_text, COUNT(*) AS n_rows FROM typed WHERE value_text IS NOT NULL GROUP BY ALL)
SELECT attribute, value_text, n_rows, FIRST_VALUE(value_text) OVER (
  PARTITION BY attribute, lower(value_text) ORDER BY n_rows DESC, value_text) AS usual FROM spelled"""
ORACLES["users_wide"] = f"""{EVENT_VALUES}
SELECT entity, ARG_MIN(value_number, event_id) FILTER (attribute = 'k') AS k,
  ARG_MIN(value_number, event_id) FILTER (attribute = 'value') AS value, MIN_BY(value_text, event_id) AS event_type,
  MIN_BY(value_boolean, event_id) AS is_purchase, CAST(NULL AS DOUBLE) AS ts FROM typed GROUP BY entity"""
ORACLES["approved_mart"] = ORACLES["mart_weekdays"]
