"""ANSI SQL for the queries of the registry, over the same parquet tables.

Written for DuckDB. The statements follow the definitions, not the Spark plans: self joins,
calendars and windows where the operators use grids, stretched rows or partial aggregates.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

MODEL = """
WITH orders_m AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS total, o_orderdate AS placed_at,
         o_orderdate AS created_at, o_orderstatus AS status, o_orderpriority AS channel
  FROM orders),
valid AS (SELECT * FROM orders_m WHERE status IN ('F', 'O')),
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_variant_id, l_quantity AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_total
  FROM lineitem),
products AS (
  SELECT min(p_partkey) AS id, p_name AS name, p_brand AS category_id FROM part GROUP BY p_name, p_brand),
variants AS (
  SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS product_id FROM part),
customers AS (SELECT c_custkey AS id, c_name AS legal_name, c_custkey AS tax_id FROM customer),
suppliers AS (SELECT s_suppkey AS id, s_name AS legal_name, s_name AS tax_id FROM supplier),
order_lines AS (
  SELECT o.id AS order_id, o.customer_id, o.placed_at, i.product_variant_id, i.quantity
  FROM valid o JOIN items i ON o.id = i.order_id),
variant_lines AS (
  SELECT l.*, v.product_id FROM order_lines l JOIN variants v ON l.product_variant_id = v.id),
base AS (
  SELECT l.*, p.category_id FROM variant_lines l JOIN products p ON l.product_id = p.id),
revenue AS (
  SELECT customer_id, round(sum(total), 4) AS faturamento_total,
         count(DISTINCT id) AS frequencia
  FROM valid GROUP BY customer_id),
diversity AS (
  SELECT customer_id, count(DISTINCT category_id) AS diversidade_categorias FROM base GROUP BY customer_id),
diverse AS (
  SELECT r.customer_id, r.faturamento_total, r.frequencia, d.diversidade_categorias,
         r.faturamento_total / r.frequencia AS ticket_medio
  FROM revenue r JOIN diversity d ON r.customer_id = d.customer_id
  WHERE d.diversidade_categorias >= 13),
loyal AS (
  SELECT c.id, c.legal_name, d.ticket_medio, d.diversidade_categorias, d.faturamento_total, d.frequencia
  FROM diverse d JOIN customers c ON d.customer_id = c.id
  ORDER BY d.ticket_medio DESC, c.id LIMIT 10),
daily AS (
  SELECT CAST(placed_at AS DATE) AS data_completa, CAST(round(sum(total), 4) AS DECIMAL(28,6)) AS venda
  FROM valid WHERE channel = '1-URGENT' GROUP BY 1),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(min(data_completa) AS TIMESTAMP),
                                     CAST(max(data_completa) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
         AS data_completa FROM daily),
filled AS (
  SELECT s.data_completa, coalesce(d.venda, 0) AS venda FROM spine s LEFT JOIN daily d USING (data_completa)),
labelled AS (
  SELECT data_completa, venda, CAST(dayofweek(data_completa) + 1 AS INTEGER) AS num_dia,
         CASE dayofweek(data_completa)
           WHEN 0 THEN '1. Domingo' WHEN 1 THEN '2. Segunda-feira' WHEN 2 THEN '3. Terça-feira'
           WHEN 3 THEN '4. Quarta-feira' WHEN 4 THEN '5. Quinta-feira' WHEN 5 THEN '6. Sexta-feira'
           WHEN 6 THEN '7. Sábado' END AS dia_semana_pt
  FROM filled),
target AS (
  SELECT id, name FROM products WHERE contains(lower(name), 'small widget') ORDER BY id LIMIT 1),
monthly AS (
  SELECT product_id, CAST(date_trunc('month', placed_at) AS DATE) AS month, sum(quantity) AS quantity
  FROM variant_lines GROUP BY 1, 2),
grid AS (
  SELECT product_id, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP),
                                                 INTERVAL 1 MONTH)) AS DATE) AS month
  FROM monthly GROUP BY product_id),
demand AS (
  SELECT g.product_id, g.month, coalesce(m.quantity, 0.0) AS quantity
  FROM grid g LEFT JOIN monthly m ON g.product_id = m.product_id AND g.month = m.month),
parted AS (
  SELECT * FROM (
    SELECT *, CASE WHEN month <= DATE '2000-12-31' THEN 'train'
                   WHEN month BETWEEN DATE '2001-01-01' AND DATE '2001-03-31' THEN 'test' END AS part
    FROM demand) WHERE part IS NOT NULL),
baseline AS (
  SELECT product_id, month, quantity AS actual, forecast FROM (
    SELECT *, avg(quantity) OVER (PARTITION BY product_id ORDER BY month
                                  ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS forecast
    FROM parted) WHERE part = 'test'),
changes AS (
  SELECT product_id, month, quantity,
         quantity - lag(quantity, 1) OVER h - lag(quantity, 12) OVER h + lag(quantity, 13) OVER h AS w
  FROM demand WINDOW h AS (PARTITION BY product_id ORDER BY month)),
train AS (
  SELECT *, lag(w) OVER h AS w_before, row_number() OVER (PARTITION BY product_id ORDER BY month DESC) AS age
  FROM changes WHERE month <= DATE '2000-12-31' WINDOW h AS (PARTITION BY product_id ORDER BY month)),
fit AS (
  SELECT product_id, sum(w * w_before) / nullif(sum(w_before * w_before), 0) AS phi
  FROM train WHERE w IS NOT NULL AND w_before IS NOT NULL GROUP BY product_id),
steps AS (SELECT unnest([1, 2, 3]) AS step),
added AS (
  SELECT t.product_id, s.step, t.month AS last_month, t.quantity AS last_quantity,
         a.quantity - b.quantity + power(f.phi, s.step) * t.w AS gain
  FROM train t JOIN fit f ON t.product_id = f.product_id CROSS JOIN steps s
  JOIN train a ON a.product_id = t.product_id AND a.age = 13 - s.step
  JOIN train b ON b.product_id = t.product_id AND b.age = 14 - s.step
  WHERE t.age = 1),
seasonal AS (
  SELECT product_id, step, CAST(last_month + to_months(step) AS DATE) AS month,
         last_quantity + sum(gain) OVER (PARTITION BY product_id ORDER BY step) AS forecast
  FROM added),
lines AS (
  SELECT customer_id, product_id FROM variant_lines WHERE customer_id IS NOT NULL AND product_id IS NOT NULL),
basket AS (SELECT DISTINCT customer_id, product_id FROM lines),
buyers AS (SELECT product_id, count(*) AS n_buyers FROM basket GROUP BY product_id),
pairs AS (
  SELECT x.product_id AS product_a, y.product_id AS product_b, count(*) AS n_both
  FROM basket x JOIN basket y ON x.customer_id = y.customer_id AND x.product_id < y.product_id
  GROUP BY 1, 2),
half AS (
  SELECT p.product_a, p.product_b,
         CAST(p.n_both AS DOUBLE) / sqrt(CAST(a.n_buyers AS DOUBLE) * CAST(b.n_buyers AS DOUBLE)) AS score
  FROM pairs p JOIN buyers a ON p.product_a = a.product_id JOIN buyers b ON p.product_b = b.product_id),
similarity AS (
  SELECT product_a AS product_id, product_b AS similar_id, score FROM half
  UNION ALL SELECT product_b, product_a, score FROM half)
"""


def oracle(name: str, body: str, model: bool = True) -> None:
    ORACLES[name] = (MODEL if model else "") + body


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


VALIDATED = ("customer", "lineitem", "orders", "part")
SOURCE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ),
}

# Sources and sinks: what was written and read back must equal the tables themselves.
oracle("csv_scan_inferred", "SELECT * FROM lineitem", model=False)
oracle(
    "csv_scan_raw_text",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
              CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
    model=False,
)
oracle(
    "sample_first_rows",
    _union(
        f"""SELECT * FROM (SELECT '{table}' AS table_name, CAST(row_number() OVER () AS INTEGER) AS place,
                   CAST({columns.split()[0]} AS VARCHAR) AS first_field, CAST({columns.split()[1]} AS VARCHAR) AS second_field
            FROM {table}) WHERE place <= 200"""
        for table, columns in SOURCE_COLUMNS.items()
    ),
    model=False,
)
oracle("overwrite_itself", "SELECT *, o_totalprice / 2 AS half FROM orders WHERE o_orderkey % 2 = 0", model=False)
oracle(
    "discover_csv_tables",
    _union(
        f"SELECT '{t}.csv' AS file_name, '{t}' AS table_name, count(*) AS n_lines FROM {t}" for t in SOURCE_COLUMNS
    ),
    model=False,
)
oracle("sample_first_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 200", model=False)
oracle("overwrite_roundtrip", "SELECT * FROM orders", model=False)
_counts = _union(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in SOURCE_COLUMNS)
_validated = _union(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in VALIDATED)
oracle("raw_landing_counts", _counts, model=False)
oracle("ingest_row_counts", _counts, model=False)
oracle(
    "load_validation",
    f"""SELECT coalesce(table_name, 'TOTAL') AS table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows
        FROM ({_validated}) GROUP BY ROLLUP (table_name)""",
    model=False,
)
oracle(
    "ingest_stamp",
    "SELECT count(*) AS n_rows, count(*) AS n_stamped, CAST(least(count(*), 1) AS BIGINT) AS n_stamps FROM orders",
    model=False,
)
oracle(
    "bronze_ingest",
    _union(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) AS n_stamped, "
        f"CAST(least(count(*), 1) AS BIGINT) AS n_stamps FROM {t}"
        for t in SOURCE_COLUMNS
    ),
    model=False,
)

# Cleaned layer
oracle("silver_orders", "SELECT * FROM valid")
oracle("silver_order_items", "SELECT * FROM items")
oracle(
    "silver_returns",
    """SELECT l_orderkey AS order_id, l_partkey AS product_variant_id, l_quantity AS quantity,
              l_returnflag AS status FROM lineitem WHERE l_returnflag = 'R'""",
    model=False,
)

# Sales and loyalty
oracle(
    "orders_overview",
    """SELECT count(*) AS total_linhas, min(created_at) AS data_minima, max(created_at) AS data_maxima,
              min(total) AS valor_minimo, max(total) AS valor_maximo,
              round(sum(total), 4) / count(total) AS valor_medio FROM orders_m""",
)
oracle("join_orders_items", "SELECT * FROM order_lines")
oracle("join_variants", "SELECT * FROM variant_lines")
oracle("sales_base", "SELECT * FROM base")
oracle("customer_revenue_freq", "SELECT * FROM revenue")
oracle("category_diversity", "SELECT * FROM diversity")
oracle("avg_ticket", "SELECT *, faturamento_total / frequencia AS ticket_medio FROM revenue")
oracle("diverse_customers", "SELECT * FROM diverse")
oracle("loyal_customers", "SELECT * FROM loyal")
oracle(
    "loyal_top_category",
    """SELECT category_id, sum(quantity) AS total_itens FROM base
       WHERE customer_id IN (SELECT id FROM loyal)
       GROUP BY category_id ORDER BY total_itens DESC, category_id LIMIT 5""",
)
oracle("distinct_channels", "SELECT DISTINCT channel FROM orders_m")

# Calendar
oracle("date_bounds", "SELECT min(data_completa) AS data_min, max(data_completa) AS data_max FROM daily")
oracle("date_spine", "SELECT data_completa FROM spine")
oracle("pos_daily_sales", "SELECT data_completa, CAST(venda AS DOUBLE) AS venda_do_dia FROM daily")
oracle("daily_sales_filled", "SELECT data_completa, CAST(venda AS DOUBLE) AS venda_do_dia FROM filled")
oracle(
    "weekday_labels",
    "SELECT data_completa, CAST(venda AS DOUBLE) AS venda_do_dia, num_dia, dia_semana_pt FROM labelled",
)
oracle(
    "weekday_avg_sales",
    """SELECT num_dia, dia_semana_pt, CAST(sum(venda) AS DOUBLE) / count(*) AS media_venda_diaria
       FROM labelled GROUP BY num_dia, dia_semana_pt""",
)

# Profiles
_GAPPY = {
    "customers": (
        "SELECT c_custkey AS id, c_name AS legal_name, nullif(c_mktsegment, 'BUILDING') AS trade_name FROM customer",
        "id legal_name trade_name",
    ),
    "orders": (
        "SELECT id, customer_id, total, placed_at, created_at, nullif(status, 'P') AS status, "
        "nullif(channel, '4-NOT SPECIFIED') AS channel FROM orders_m",
        "id customer_id total placed_at created_at status channel",
    ),
    "order_items": (
        "SELECT order_id, product_variant_id, nullif(quantity, 1.0) AS quantity, unit_price, line_total FROM items",
        "order_id product_variant_id quantity unit_price line_total",
    ),
    "products": ("SELECT id, name, category_id FROM products", "id name category_id"),
    "product_variants": ("SELECT id, product_id FROM variants", "id product_id"),
}
oracle(
    "null_profile",
    _union(
        f"""SELECT '{table}' AS table_name, CAST({pos} AS INTEGER) AS pos, '{column}' AS column_name,
                   count(*) AS n_rows, count(*) - count({column}) AS n_nulls,
                   CAST(count(*) - count({column}) AS DOUBLE) / count(*) AS null_ratio FROM ({source})"""
        for table, (source, columns) in _GAPPY.items()
        for pos, column in enumerate(columns.split(), 1)
    ),
)
oracle(
    "table_volumetrics",
    _union(
        f"SELECT '{t}' AS tabela, count(*) AS n_linhas, CAST({len(columns.split()) + 1} AS BIGINT) AS n_colunas FROM {t}"
        for t, columns in SOURCE_COLUMNS.items()
    ),
    model=False,
)
oracle(
    "schema_catalog",
    _union(
        f"""SELECT '{t}' AS table_name, CAST({pos} AS INTEGER) AS pos, '{c}' AS column_name,
                   CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                        WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                        WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS column_type,
                   count({c}) AS n_values FROM {t}"""
        for t, columns in SOURCE_COLUMNS.items()
        for pos, c in enumerate(columns.split(), 1)
    ),
    model=False,
)
# The exported tables as text, with a table of hand-made forms beside them.
FORMS = {
    "blank": "nullif(CAST(o_orderkey AS VARCHAR), CAST(o_orderkey // 2 * 2 AS VARCHAR))",
    "grouped": "CAST(o_orderkey // 1000 AS VARCHAR) || '_' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')",
    "moment": (
        "CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
        "WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"
    ),
    "flag": "CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'False' ELSE '' END",
    "wide": "CASE o_orderkey % 2 WHEN 0 THEN '123456789012345678901234567890' ELSE '7' END",
    "mixed": "CASE o_orderkey % 500 WHEN 3 THEN 'n/a' ELSE '1.5' END",
    "nothing": "''",
    "o_orderkey": "'k' || CAST(o_orderkey AS VARCHAR)",
}
_TEXT_COLUMNS = [(t, pos, c, f"CAST({c} AS VARCHAR)", t) for t, cs in SOURCE_COLUMNS.items() for pos, c in enumerate(cs.split(), 1)]
_TEXT_COLUMNS += [("forms", pos, c, made, "orders") for pos, (c, made) in enumerate(FORMS.items(), 1)]
_TYPES = _union(
    f"""SELECT '{table}' AS table_name, CAST({pos} AS INTEGER) AS pos, '{c}' AS column_name,
               CASE WHEN count(v) = 0 THEN 'TEXT'
                    WHEN bool_and(regexp_full_match(v, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*')) THEN 'BIGINT'
                    WHEN bool_and(try_cast(v AS DOUBLE) IS NOT NULL) THEN 'DOUBLE PRECISION'
                    WHEN bool_and(try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d'])
                                  IS NOT NULL) THEN 'TIMESTAMP'
                    WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'BOOLEAN'
                    ELSE 'TEXT' END AS inferred_type,
               coalesce(bool_and(regexp_full_match(v, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*'))
                        AND NOT bool_and(try_cast(replace(v, '_', '') AS BIGINT) IS NOT NULL), false) AS overflow
        FROM (SELECT nullif({made}, '') AS v FROM {source}) WHERE v IS NOT NULL"""
    for table, pos, c, made, source in _TEXT_COLUMNS
)
oracle("infer_column_types", _TYPES, model=False)
_DDL = f"""SELECT table_name, 'CREATE TABLE IF NOT EXISTS "' || table_name || '" (' || chr(10) ||
               string_agg('    "' || replace(lower(trim(column_name)), ' ', '_') || '" ' || inferred_type,
                          ',' || chr(10) ORDER BY pos) || chr(10) || ');' AS ddl
        FROM ({_TYPES}) GROUP BY table_name"""
oracle("generate_ddl", _DDL, model=False)
oracle(
    "ddl_script",
    f"""SELECT 0 AS part, '-- Tables as inferred from the text of the CSV files.' || chr(10) ||
               '-- Dialect: PostgreSQL.' || chr(10) || chr(10) AS text
        UNION ALL SELECT CAST(row_number() OVER (ORDER BY table_name) AS INTEGER), ddl || chr(10) || chr(10)
        FROM ({_DDL})""",
    model=False,
)
oracle(
    "type_conflicts",
    f"""SELECT column_name, count(DISTINCT inferred_type) AS n_types,
               string_agg(table_name || ':' || inferred_type, ', ' ORDER BY table_name || ':' || inferred_type) AS found
        FROM ({_TYPES}) GROUP BY column_name HAVING count(DISTINCT inferred_type) > 1""",
    model=False,
)
oracle("sanitize_columns", "SELECT * FROM orders", model=False)

# Demand
oracle("find_product", "SELECT id, name FROM target")
oracle(
    "product_sales_lines",
    """SELECT * FROM order_lines WHERE product_variant_id IN
         (SELECT v.id FROM variants v JOIN target t ON v.product_id = t.id)""",
)
oracle("monthly_demand", "SELECT product_id, month, quantity FROM demand")
oracle("demand_train_test_split", "SELECT product_id, month, quantity, part FROM parted")
oracle(
    "moving_avg_forecast",
    "SELECT product_id, month, actual, round(forecast, 6) AS forecast FROM baseline",
)
oracle(
    "baseline_mae",
    "SELECT product_id, round(avg(abs(actual - forecast)), 6) AS mae FROM baseline GROUP BY product_id",
)
oracle(
    "baseline_forecast_total",
    """SELECT product_id, CAST(round_even(coalesce(sum(forecast), 0), 0) AS BIGINT) AS total_forecast
       FROM baseline GROUP BY product_id""",
)
oracle("seasonal_difference", "SELECT product_id, month, quantity, w FROM changes")
oracle(
    "seasonal_ar_forecast",
    "SELECT product_id, step, month, round(forecast, 6) AS forecast FROM seasonal",
)
oracle(
    "forecast_comparison",
    """SELECT b.product_id, count(*) AS n_months,
              CAST(round_even(coalesce(sum(b.forecast), 0), 0) AS BIGINT) AS baseline_total,
              round(avg(abs(b.actual - b.forecast)), 6) AS baseline_mae,
              CAST(round_even(sum(s.forecast), 0) AS BIGINT) AS seasonal_total,
              round(avg(abs(b.actual - s.forecast)), 6) AS seasonal_mae
       FROM baseline b LEFT JOIN seasonal s ON b.product_id = s.product_id AND b.month = s.month
       GROUP BY b.product_id""",
)


def _eliminated(source: str, size: int) -> str:
    """Gauss-Jordan on columns m_i_j (the last j is the right side), d_i the diagonal at the start."""
    for k in range(size):
        pivot = f"(CASE WHEN m_{k}_{k} > 1e-9 * d_{k} THEN m_{k}_{k} END)"
        cells = [
            (f"m_{k}_{j} / {pivot}" if i == k else f"m_{i}_{j} - m_{k}_{j} * m_{i}_{k} / {pivot}") + f" AS m_{i}_{j}"
            for i in range(size) for j in range(size + 1)
        ]
        source = f"SELECT product_id, n, {', '.join(cells)}, {', '.join(f'd_{i}' for i in range(size))} FROM ({source})"
    return source


def _normal(columns: list[str], rows: str) -> str:
    """Normal equations of the regressors ``columns[:-1]`` and the target ``columns[-1]``."""
    size = len(columns) - 1
    cells = [f"sum({columns[i]} * {columns[j]}) AS m_{i}_{j}" for i in range(size) for j in range(size + 1)]
    cells += [f"sum({c} * {c}) AS d_{i}" for i, c in enumerate(columns[:-1])]
    return f"SELECT product_id, count(*) AS n, {', '.join(cells)} FROM {rows} GROUP BY product_id"


_LONG = [1, 2, 3, 12, 13, 14]
_HELD = "CASE WHEN {0} IS NOT NULL THEN greatest(-0.99, least(0.99, {0})) END"
ARMA = MODEL.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
numbered AS (
  SELECT product_id, month, quantity AS y, w, row_number() OVER h - 1 AS t,
         count(*) FILTER (month <= DATE '2000-12-31') OVER (PARTITION BY product_id) AS n_train
  FROM changes WHERE month <= DATE '2001-03-31' WINDOW h AS (PARTITION BY product_id ORDER BY month)),
lagged AS MATERIALIZED (
  SELECT *, {', '.join(f'lag(w, {k}) OVER h AS w{k}' for k in (1, 2, 3, 9, 10, 11, 12, 13, 14))},
         {', '.join(f'lag(y, {k}) OVER h AS y{k}' for k in range(1, 14))}
  FROM numbered WINDOW h AS (PARTITION BY product_id ORDER BY t)),
rows1 AS MATERIALIZED (SELECT * FROM lagged WHERE t >= 27 AND t < n_train),
long AS MATERIALIZED ({_eliminated(_normal([*(f"w{k}" for k in _LONG), "w"], "rows1"), 6)}),
left_over AS MATERIALIZED (
  SELECT r.*, CASE WHEN n > 6 THEN w - {' - '.join(f'm_{i}_6 * w{k}' for i, k in enumerate(_LONG))} END AS u
  FROM rows1 r JOIN long USING (product_id)),
rows2 AS MATERIALIZED (
  SELECT * FROM (SELECT *, lag(u) OVER (PARTITION BY product_id ORDER BY t) AS u1 FROM left_over) WHERE t >= 28),
short AS MATERIALIZED ({_eliminated(_normal(["w1", "w12", "w13", "u1", "w"], "rows2"), 4)}),
coefficients AS MATERIALIZED (
  SELECT p.product_id, CAST(p.n_train AS INTEGER) AS n_train, {_HELD.format("CASE WHEN n > 4 THEN m_0_4 END")} AS phi,
         {_HELD.format("CASE WHEN n > 4 THEN m_3_4 END")} AS theta, {_HELD.format("CASE WHEN n > 4 THEN m_1_4 END")} AS seasonal_phi
  FROM (SELECT DISTINCT product_id, n_train FROM numbered) p LEFT JOIN short USING (product_id)),
shocks AS (
  SELECT product_id, CAST(25 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS e, CAST(NULL AS DOUBLE) AS expected FROM coefficients WHERE phi IS NOT NULL
  UNION ALL
  SELECT product_id, l.t, w - (phi * w1 + seasonal_phi * w12 - phi * seasonal_phi * w13 + theta * s.e),
         phi * w1 + seasonal_phi * w12 - phi * seasonal_phi * w13 + theta * s.e
  FROM shocks s JOIN lagged l USING (product_id) JOIN coefficients USING (product_id) WHERE l.t = s.t + 1),
origin AS (
  SELECT product_id, month AS last_month, y, w, y9, y10, y11, y12, w9, w10, w11, w12, phi, theta, seasonal_phi, e
  FROM lagged JOIN coefficients USING (product_id) JOIN shocks USING (product_id, t) WHERE t = coefficients.n_train - 1),
step1 AS (
  SELECT *, phi * w + seasonal_phi * w11 - phi * seasonal_phi * w12 + theta * e AS f1 FROM origin),
step2 AS (SELECT *, phi * f1 + seasonal_phi * w10 - phi * seasonal_phi * w11 AS f2, f1 + y + y11 - y12 AS a1 FROM step1),
step3 AS (SELECT *, phi * f2 + seasonal_phi * w9 - phi * seasonal_phi * w10 AS f3, f2 + a1 + y10 - y11 AS a2 FROM step2),
arma AS (
  SELECT product_id, last_month, unnest([1, 2, 3]) AS step, unnest([a1, a2, f3 + a2 + y9 - y10]) AS forecast FROM step3),
averaged AS (
  SELECT product_id, n_train, [x FOR x IN [y, y1, y2] IF x IS NOT NULL] AS k FROM lagged WHERE t = n_train - 1),
average1 AS (SELECT *, list_prepend(list_avg(k), k)[:3] AS k1 FROM averaged),
average2 AS (SELECT *, list_prepend(list_avg(k1), k1)[:3] AS k2 FROM average1),
average AS (SELECT product_id, unnest([0, 1, 2]) AS at, unnest([list_avg(k), list_avg(k1), list_avg(k2)]) AS forecast FROM average2),
tested AS (
  SELECT n.product_id, n.month, n.y AS actual, n.t - n.n_train AS at, b.forecast AS average_rolling, v.forecast AS average_ahead,
         expected + y1 + y12 - y13 AS seasonal_rolling, a.forecast AS seasonal_ahead
  FROM lagged n JOIN baseline b USING (product_id, month)
  LEFT JOIN average v ON v.product_id = n.product_id AND v.at = n.t - n.n_train
  LEFT JOIN arma a ON a.product_id = n.product_id AND a.step = n.t - n.n_train + 1
  LEFT JOIN shocks s ON s.product_id = n.product_id AND s.t = n.t
  WHERE n.month >= DATE '2001-01-01')
"""
ORACLES["seasonal_arma_coefficients"] = (
    ARMA + "SELECT product_id, n_train, round(phi, 6) AS phi, round(theta, 6) AS theta, round(seasonal_phi, 6) AS seasonal_phi FROM coefficients"
)
ORACLES["seasonal_arma_forecast"] = (
    ARMA + "SELECT product_id, step, CAST(last_month + to_months(step) AS DATE) AS month, round(forecast, 6) AS forecast FROM arma WHERE forecast IS NOT NULL"
)
ORACLES["forecast_protocols"] = ARMA + _union(
    f"""SELECT product_id, '{method}' AS method, '{protocol}' AS protocol, count(*) AS n_months,
               CAST(round_even(sum({column}), 0) AS BIGINT) AS total_forecast, round(avg(abs(actual - {column})), 6) AS mae
        FROM tested GROUP BY product_id"""
    for method, protocol, column in (
        ("moving_average", "rolling", "average_rolling"), ("moving_average", "ahead", "average_ahead"),
        ("seasonal", "rolling", "seasonal_rolling"), ("seasonal", "ahead", "seasonal_ahead"),
    )
)

# Recommendations
oracle(
    "purchase_crosstab",
    "SELECT customer_id, product_id, count(*) AS n_lines FROM lines GROUP BY customer_id, product_id",
)
oracle("purchase_matrix", "SELECT customer_id, product_id, CAST(1 AS INTEGER) AS bought FROM basket")
oracle("product_buyer_counts", "SELECT product_id, n_buyers FROM buyers")
oracle("co_purchase_counts", "SELECT product_a, product_b, n_both FROM pairs")
oracle("product_similarity", "SELECT product_id, similar_id, round(score, 6) AS score FROM similarity")
oracle(
    "similar_products",
    """SELECT r.similar_id, p.name AS similar_name, round(r.score, 4) AS score FROM (
         SELECT b.product_id AS similar_id, coalesce(s.score, 0.0) AS score
         FROM buyers b LEFT JOIN similarity s
           ON s.similar_id = b.product_id AND s.product_id = (SELECT id FROM target)
         WHERE b.product_id <> (SELECT id FROM target)
           AND EXISTS (SELECT 1 FROM buyers WHERE product_id = (SELECT id FROM target))
         ORDER BY score DESC, similar_id LIMIT 5) r
       LEFT JOIN products p ON p.id = r.similar_id""",
)
oracle(
    "similar_without_junk",
    """SELECT r.similar_id, p.name AS similar_name, round(r.score, 4) AS score FROM (
         SELECT b.product_id AS similar_id, coalesce(s.score, 0.0) AS score
         FROM buyers b LEFT JOIN similarity s
           ON s.similar_id = b.product_id AND s.product_id = (SELECT id FROM target)
         WHERE b.product_id <> (SELECT id FROM target)
           AND b.product_id NOT IN (SELECT id FROM products WHERE contains(lower(name), 'gear'))
           AND EXISTS (SELECT 1 FROM buyers WHERE product_id = (SELECT id FROM target))
         ORDER BY score DESC, similar_id LIMIT 5) r
       LEFT JOIN products p ON p.id = r.similar_id""",
)
oracle(
    "top5_similar_all_products",
    """SELECT r.product_id, CAST(r.rank AS INTEGER) AS rank, r.similar_id, round(r.score, 6) AS score,
              p.name AS similar_name
       FROM (
         SELECT x.product_id, y.product_id AS similar_id, coalesce(s.score, 0.0) AS score,
                row_number() OVER (PARTITION BY x.product_id
                                   ORDER BY coalesce(s.score, 0.0) DESC, y.product_id) AS rank
         FROM buyers x JOIN buyers y ON x.product_id <> y.product_id
         LEFT JOIN similarity s ON s.product_id = x.product_id AND s.similar_id = y.product_id) r
       LEFT JOIN products p ON p.id = r.similar_id
       WHERE r.rank <= 5""",
)
