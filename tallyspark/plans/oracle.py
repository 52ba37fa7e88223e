"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query's SQL re-derives the whole pipeline from the given tables with
its own CTEs, written as a SQL user would write the reference's logic, and
is compared with the Spark result on the same Parquet files.  Expression
helpers below generate the DuckDB spelling of the shared cleaning rules.
"""

from __future__ import annotations

# The rules below are spelled here on their own and share nothing with the engine.

# Tokens that a pandas CSV reader takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
NUMBER = r"[ \t\r\n]*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?[ \t\r\n]*"
BLANK = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def nt(x: str) -> str:
    return f"CASE WHEN {x} IN ({', '.join(q(t) for t in NULL_TOKENS)}) THEN NULL ELSE {x} END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{BLANK}+|{BLANK}+$', '', 'g')"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|\\P{{L}}+'), "
            f"lambda w: upper(w[1]) || w[2:]), '')")


def to_number(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, {q(NUMBER)}) THEN TRY_CAST({x} AS DECIMAL(18,4)) END)"


def to_date(x: str) -> str:
    d = f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"
    return (f"(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
            f"AND {d} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {d} END)")


def product(a: str, b: str) -> str:
    """The exact product; the inputs have at most four decimals together."""
    return f"CAST({a} * {b} AS DECIMAL(38,4))"


def rha(x: str, n: int) -> str:
    s = f"{float(10 ** n)}"
    return (f"((CASE WHEN CAST({x} AS DOUBLE) < 0 THEN -floor(-CAST({x} AS DOUBLE) * {s} + 0.5) "
            f"ELSE floor(CAST({x} AS DOUBLE) * {s} + 0.5) END) / {s})")


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, n: int = 1) -> str:
    return rha(f"({ratio(a, b)} * 100.0)", n)


def pad(x: str, w: int = 7) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {w}, '0')"


def date_id(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


# ---------------------------------------------------------------------------
# CTE catalogue: name -> (dependencies, body)
# ---------------------------------------------------------------------------

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("raw_orders_src", [], f"""
SELECT
  'O' || lpad(CAST(l.l_orderkey AS VARCHAR), 8, '0') || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
  CASE WHEN l.l_orderkey % 997 = 3 THEN NULL ELSE 'C' || {pad('o.o_custkey')} END AS customer_id,
  CASE WHEN l.l_partkey % 501 = 7 THEN 'SKU9999999' ELSE 'SKU' || {pad('l.l_partkey')} END AS sku,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 7 THEN CAST(-CAST(l.l_quantity AS INTEGER) AS VARCHAR)
       WHEN l.l_orderkey % 701 = 5 THEN 'n/d'
       WHEN l.l_orderkey % 601 = 5 THEN '0'
       WHEN l.l_orderkey % 409 = 5 THEN '2.5'
       ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
  CASE WHEN l.l_orderkey % 151 = 0 THEN NULL
       WHEN l.l_orderkey % 313 = 7 THEN '1.005'
       ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
  CASE WHEN l.l_orderkey % 251 = 0 THEN '2025-13-40'
       ELSE substr(CAST(o.o_orderdate AS VARCHAR), 1, 10) END AS order_date,
  '  ' || CASE WHEN l.l_suppkey % 2 = 0 THEN upper(o.o_orderpriority) ELSE o.o_orderpriority END || ' ' AS channel,
  0 AS s0, l.l_shipdate AS s1, l.l_partkey AS s2, l.l_suppkey AS s3, l.l_quantity AS s4, l.l_extendedprice AS s5
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

_ORD_COLS = ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel"]
_CUST_COLS = ["customer_id", "name", "country", "segment", "created_at"]
_PROD_COLS = ["sku", "category", "cost", "active"]


def _hash(cols: list[str]) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({c}, 'nan')" for c in cols) + "))"


cte("raw_orders", ["raw_orders_src"], f"""
SELECT {', '.join(nt(c) + ' AS ' + c for c in _ORD_COLS)}, s0, s1, s2, s3, s4, s5
FROM raw_orders_src""")

cte("raw_customers_src", [], f"""
SELECT 'C' || {pad('c_custkey')} AS customer_id,
  CASE WHEN cp = 2 THEN c_name || ' (dup)' ELSE ' ' || c_name || ' ' END AS name,
  CASE WHEN cp = 2 THEN 'Late' WHEN c_custkey % 40 = 3 THEN NULL WHEN c_custkey % 3 = 0 THEN lower(n_name)
       ELSE ' ' || n_name END AS country,
  CASE WHEN cp = 2 THEN 'Late' WHEN c_custkey % 41 = 5 THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN 'e-commerce'
       ELSE c_mktsegment END AS segment,
  CASE WHEN cp = 2 THEN '2001-01-01' WHEN c_custkey % 97 = 11 THEN 'not-a-date'
       ELSE CAST(DATE '1994-06-01' + CAST(c_custkey % 1200 AS INTEGER) AS VARCHAR) END AS created_at,
  cp AS s1, c_custkey AS s2
FROM (SELECT *, unnest(CASE WHEN c_custkey % 50 = 0 THEN [1, 2] ELSE [1] END) AS cp
      FROM customer JOIN nation ON c_nationkey = n_nationkey)""")

cte("raw_customers", ["raw_customers_src"], f"""
SELECT {', '.join(nt(c) + ' AS ' + c for c in _CUST_COLS)}, s1, s2 FROM raw_customers_src""")

cte("raw_products_src", [], f"""
SELECT 'SKU' || {pad('p_partkey')} AS sku,
  CASE WHEN cp = 2 THEN 'Late' WHEN p_partkey % 30 = 7 THEN NULL ELSE p_type END AS category,
  CASE WHEN cp = 2 THEN '1.00'
       WHEN p_partkey % 67 = 9 THEN 'n/a'
       WHEN p_partkey % 20 = 1 THEN CAST(-CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS VARCHAR)
       ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 12 AS DECIMAL(18,2)) AS VARCHAR) END AS cost,
  CASE WHEN cp = 2 THEN 'True' WHEN p_partkey % 333 = 5 THEN 'yes' WHEN p_partkey % 10 = 0 THEN 'False'
       ELSE 'True' END AS active,
  cp AS s1, p_partkey AS s2
FROM (SELECT *, unnest(CASE WHEN p_partkey % 50 = 0 THEN [1, 2] ELSE [1] END) AS cp FROM part)""")

cte("raw_products", ["raw_products_src"], f"""
SELECT {', '.join(nt(c) + ' AS ' + c for c in _PROD_COLS)}, s1, s2 FROM raw_products_src""")

# -- staging ---------------------------------------------------------------

cte("cust_first", ["raw_customers"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s1, s2) AS rn FROM raw_customers) WHERE rn = 1""")

cte("stg_customers", ["cust_first"], f"""
SELECT customer_id, {strip('name')} AS name,
  {title(strip("coalesce(country, 'Unknown')"))} AS country,
  {title(strip("coalesce(segment, 'Unknown')"))} AS segment,
  {to_date('created_at')} AS created_at
FROM cust_first""")

cte("prod_first", ["raw_products"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY s1, s2) AS rn FROM raw_products) WHERE rn = 1""")

cte("prod_typed", ["prod_first"], f"""
SELECT sku, coalesce(category, 'Uncategorized') AS category, abs({to_number('cost')}) AS cost,
  CASE WHEN active = 'True' THEN true WHEN active = 'False' THEN false END AS active
FROM prod_first""")

cte("prod_median", ["prod_typed"], """
SELECT CAST((max(cost) FILTER (WHERE rn = (n - 1) // 2) + max(cost) FILTER (WHERE rn = n // 2)) * 0.5
            AS DECIMAL(18,4)) AS med
FROM (SELECT cost, row_number() OVER (ORDER BY cost) - 1 AS rn, count(*) OVER () AS n
      FROM prod_typed WHERE cost IS NOT NULL)""")

cte("stg_products", ["prod_typed", "prod_median"], """
SELECT sku, category, CAST(coalesce(cost, med) AS DECIMAL(18,4)) AS cost, active
FROM prod_typed CROSS JOIN prod_median""")

cte("ord_first", ["raw_orders"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY s0, s1, s2, s3, s4, s5) AS rn FROM raw_orders)
WHERE rn = 1""")

cte("ord_typed", ["ord_first"], f"""
SELECT order_id, customer_id, sku, {to_number('quantity')} AS quantity, {to_number('unit_price')} AS unit_price,
  {to_date('order_date')} AS order_date, channel
FROM ord_first""")

cte("stg_orders0", ["ord_typed"], f"""
SELECT order_id, customer_id, sku, quantity, unit_price, order_date,
  lower({strip('channel')}) AS channel,
  coalesce(quantity < 0, false) AS is_return,
  {product('quantity', 'unit_price')} AS revenue
FROM ord_typed WHERE order_date IS NOT NULL AND unit_price IS NOT NULL""")

cte("flagged", ["stg_orders0", "stg_customers", "stg_products"], """
SELECT s.*, c.created_at, p.active, p.cost,
  coalesce(s.order_date < c.created_at, false) AS is_pre_signup,
  (p.active IS NOT DISTINCT FROM false) AS is_inactive_sale,
  coalesce(s.unit_price < p.cost, false) AS is_below_cost
FROM stg_orders0 s
LEFT JOIN stg_customers c ON s.customer_id IS NOT DISTINCT FROM c.customer_id
LEFT JOIN stg_products p ON s.sku IS NOT DISTINCT FROM p.sku""")

cte("stg_orders", ["flagged"], """
SELECT order_id, customer_id, sku, quantity, unit_price, order_date, channel, is_return, revenue,
  is_pre_signup, is_inactive_sale, is_below_cost
FROM flagged""")

cte("fact", ["flagged"], f"""
SELECT order_id, customer_id, sku, channel, {date_id('order_date')} AS date_id, order_date,
  quantity, unit_price, revenue, {product('quantity', 'cost')} AS cost_total, revenue - {product('quantity', 'cost')} AS gross_margin,
  {rha(ratio('revenue - ' + product('quantity', 'cost'), 'revenue'), 4)} AS margin_pct,
  is_pre_signup, is_inactive_sale, is_below_cost
FROM flagged WHERE NOT is_return""")

cte("dim_date", ["stg_orders0"], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(weekofyear(d) AS INTEGER) AS week, strftime(d, '%A') AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(make_date(year(lo), 1, 1), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM stg_orders0) WHERE lo IS NOT NULL)""")

cte("dim_customer", ["stg_customers"], "SELECT customer_id, name, country, segment, created_at FROM stg_customers")
cte("dim_product", ["stg_products"], "SELECT sku, category, cost, active FROM stg_products")


def with_ctes(body: str, *needed: str, **other: tuple[list[str], str]) -> str:
    """``body`` after the expressions it needs; ``other`` replaces or adds some."""
    ctes = CTES | other
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in ctes[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({ctes[n][1].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


cte("orders_quarantine", ["flagged"], "SELECT * FROM flagged WHERE is_pre_signup")

cte("mart_daily", ["fact"], """
SELECT date_id, channel, count(DISTINCT order_id) AS orders, coalesce(sum(revenue), 0) AS revenue,
  coalesce(sum(gross_margin), 0) AS margin, coalesce(sum(quantity), 0) AS units
FROM fact WHERE date_id IS NOT NULL AND channel IS NOT NULL GROUP BY date_id, channel""")

cte("mart_month", ["fact"], """
SELECT DISTINCT date_trunc('month', order_date) AS m, channel FROM fact
WHERE order_date IS NOT NULL AND channel IS NOT NULL""")

cte("mart_clv", ["fact", "dim_customer"], """
SELECT a.*, d.name, d.country, d.segment FROM (
  SELECT customer_id, count(DISTINCT order_id) AS total_orders, coalesce(sum(revenue), 0) AS total_revenue
  FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id) a
LEFT JOIN dim_customer d ON a.customer_id = d.customer_id""")

cte("mart_prod", ["fact", "dim_product"], """
SELECT a.*, d.category FROM (
  SELECT sku, count(DISTINCT order_id) AS total_orders FROM fact WHERE sku IS NOT NULL GROUP BY sku) a
LEFT JOIN dim_product d ON a.sku = d.sku""")


def dup_count_sql(key: str, table: str) -> str:
    """Rows beyond the first per key, NULL keys forming one group."""
    return (f"CAST(count(*) - count(DISTINCT {key}) - "
            f"(CASE WHEN count(*) FILTER (WHERE {key} IS NULL) > 0 THEN 1 ELSE 0 END) AS BIGINT)")


def measures_sql(prefix: str = "") -> str:
    p = prefix
    return (f"CAST(sum({p}revenue) AS DOUBLE) AS total_revenue, CAST(sum({p}gross_margin) AS DOUBLE) AS total_margin, "
            f"{ratio(f'sum({p}gross_margin)', f'sum({p}revenue)')} AS margin_pct, "
            f"{ratio(f'sum({p}revenue)', f'count(DISTINCT {p}order_id)')} AS avg_ticket, "
            f"count(DISTINCT {p}order_id) AS total_orders")


def in_list(values) -> str:
    return "(" + ", ".join(q(v) if isinstance(v, str) else str(v).lower() for v in values) + ")"


# -- order intake ------------------------------------------------------------

INTAKE_CUSTOMER_RE = r"^C[0-9]{7}$"
INTAKE_SKU_RE = r"^SKU[0-9]{7}$"
INTAKE_AS_OF = "2026-01-01"

cte("cand", [], f"""
SELECT
  CASE WHEN cp = 2 THEN 'W' || CAST(o_orderkey AS VARCHAR)
       WHEN o_orderkey % 53 = 0 THEN '   '
       WHEN o_orderkey % 59 = 0 THEN 'web-order-too-long-' || CAST(o_orderkey AS VARCHAR)
       ELSE ' w' || CAST(o_orderkey AS VARCHAR) || ' ' END AS order_id,
  CASE WHEN cp = 2 THEN 'C0000001' WHEN o_orderkey % 37 = 0 THEN 'X1' ELSE 'c' || {pad('o_custkey')} END AS customer_id,
  CASE WHEN cp = 2 THEN 'SKU0000001' WHEN o_orderkey % 41 = 0 THEN '' ELSE 'sku' || {pad('o_orderkey % 2000')} END AS sku,
  CASE WHEN cp = 2 THEN '1' WHEN o_orderkey % 13 = 0 THEN '0' WHEN o_orderkey % 17 = 0 THEN 'abc'
       WHEN o_orderkey % 43 = 0 THEN '9999' ELSE CAST(o_orderkey % 50 + 1 AS VARCHAR) END AS quantity,
  CASE WHEN cp = 2 THEN '1.00' WHEN o_orderkey % 19 = 0 THEN '100001' WHEN o_orderkey % 43 = 0 THEN '999.99'
       ELSE CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) END AS unit_price,
  CASE WHEN cp = 2 THEN '1999-01-01' WHEN o_orderkey % 23 = 0 THEN '2999-01-01'
       WHEN o_orderkey % 29 = 0 THEN '1999/01/01' ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) END AS order_date,
  CASE WHEN cp = 2 THEN 'export' WHEN o_orderkey % 31 = 0 THEN 'fax' WHEN o_orderkey % 2 = 0 THEN ' Retail'
       ELSE 'ECOMMERCE' END AS channel,
  cp AS s1, o_orderkey AS s2
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 47 = 0 THEN [1, 2] ELSE [1] END) AS cp FROM orders)""")

_QD = f"TRY_CAST({strip('quantity')} AS DECIMAL(38,0))"
_PD = f"TRY_CAST({strip('unit_price')} AS DECIMAL(28,10))"
_DD = "CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE)"

cte("cand_codes", ["cand"], f"""
SELECT *,
  CASE WHEN order_id IS NULL THEN 'missing'
       WHEN length(order_id) < 1 OR {strip('order_id')} = '' THEN 'string_too_short'
       WHEN length(order_id) > 20 THEN 'string_too_long' END AS e_order_id,
  CASE WHEN customer_id IS NULL THEN 'missing'
       WHEN NOT regexp_matches(upper({strip('customer_id')}), {q(INTAKE_CUSTOMER_RE)}) THEN 'pattern' END AS e_customer_id,
  CASE WHEN sku IS NULL THEN 'missing'
       WHEN NOT regexp_matches(upper({strip('sku')}), {q(INTAKE_SKU_RE)}) THEN 'pattern' END AS e_sku,
  CASE WHEN quantity IS NULL THEN 'missing'
       WHEN NOT regexp_matches({strip('quantity')}, '^[-+]?[0-9]+$') OR {_QD} IS NULL THEN 'int_parsing'
       WHEN {_QD} <= 0 THEN 'greater_than' WHEN {_QD} > 10000 THEN 'less_than_equal' END AS e_quantity,
  CASE WHEN unit_price IS NULL THEN 'missing'
       WHEN NOT regexp_full_match(unit_price, {q(NUMBER)}) OR {_PD} IS NULL THEN 'float_parsing'
       WHEN {_PD} <= 0 THEN 'greater_than' WHEN {_PD} > 100000 THEN 'less_than_equal' END AS e_unit_price,
  CASE WHEN order_date IS NULL OR {strip('order_date')} = '' THEN 'missing'
       WHEN NOT regexp_matches(order_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') OR {_DD} IS NULL THEN 'date_parsing'
       WHEN {_DD} > DATE '{INTAKE_AS_OF}' THEN 'date_future' END AS e_order_date,
  CASE WHEN channel IS NULL THEN 'missing'
       WHEN lower({strip('channel')}) NOT IN ('ecommerce', 'wholesale', 'retail', 'export') THEN 'invalid_choice'
       END AS e_channel,
  {_QD} AS q, {_PD} AS p, {_DD} AS d
FROM cand""")

_FIELD_OK = " AND ".join(f"e_{f} IS NULL" for f in
                         ["order_id", "customer_id", "sku", "quantity", "unit_price", "order_date", "channel"])

cte("cand_valid", ["cand_codes"], f"""
SELECT *, (e_revenue IS NULL AND {_FIELD_OK}) AS is_valid,
  (CASE WHEN e_revenue IS NULL THEN 0 ELSE 1 END
   + {' + '.join(f'(CASE WHEN e_{f} IS NULL THEN 0 ELSE 1 END)' for f in
                 ['order_id', 'customer_id', 'sku', 'quantity', 'unit_price', 'order_date', 'channel'])}) AS n_errors
FROM (SELECT *, CASE WHEN (CASE WHEN {_FIELD_OK} THEN q * p END) > 1000000 THEN 'revenue_anomaly' END AS e_revenue
      FROM cand_codes)""")

cte("intake_norm", ["cand_valid"], f"""
SELECT upper({strip('order_id')}) AS order_id, upper({strip('customer_id')}) AS customer_id,
  upper({strip('sku')}) AS sku,
  CASE WHEN is_valid THEN CAST(q AS INTEGER) END AS quantity,
  CASE WHEN is_valid THEN CAST(p AS DECIMAL(18,2)) END AS unit_price,
  CASE WHEN is_valid THEN d END AS order_date,
  lower({strip('channel')}) AS channel, n_errors, is_valid, s1, s2
FROM cand_valid""")

cte("intake_accepted", ["intake_norm"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY s1, s2) AS rn FROM intake_norm WHERE is_valid)
WHERE rn = 1""")

cte("intake_store", ["intake_accepted"], """
SELECT row_number() OVER (ORDER BY s1, s2) AS id, order_id, customer_id, sku, quantity, unit_price, order_date,
  channel FROM intake_accepted""")

STORE_OUT = ("id, order_id, customer_id, sku, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
             "CAST(quantity * unit_price AS DOUBLE) AS revenue, order_date, channel")
