"""DuckDB-side definitions used by the correctness oracle.

Only the base test tables are registered in the oracle's DuckDB, so
each oracle statement carries the adapter views (FIXTURES.md) and the
cleaning rules as CTEs in front of its own query.  ``R``/``HE`` render
the two rounding rules so that both engines round identically.
"""

from __future__ import annotations


def R(expr: str, d: int = 2) -> str:
    """SQL ROUND half-up, via decimal, as double (= functions.round_half_up)."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,{max(10, d + 4)})), {d}) AS DOUBLE)"


def M(expr: str, d: int = 2) -> str:
    """ROUND of an exact decimal amount, as double (= functions.money)."""
    return f"CAST(ROUND({expr}, {d}) AS DOUBLE)"


def RATIO(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def PCT(num: str, den: str, d: int = 2) -> str:
    return R(f"{RATIO(num, den)} * 100.0", d)


def AVGM(total: str, n: str) -> str:
    """Exact ROUND(total/n, 2) for a non-negative money total (= functions.avg_money)."""
    c = f"CAST({total} * 100 AS BIGINT)"
    num = f"({c} * 2 + CAST({n} AS BIGINT))"
    den = f"(CAST({n} AS BIGINT) * 2)"
    return f"(CASE WHEN {n} > 0 THEN CAST(({num} - ({num} % {den})) // {den} AS DOUBLE) / 100.0 END)"


def SD(x: str) -> str:
    """Sample std of an integer column from exact moment sums (= functions.exact_std)."""
    d = f"CAST({x} AS HUGEINT)"
    num = f"(COUNT({d}) * SUM({d} * {d}) - SUM({d}) * SUM({d}))"
    return f"sqrt(CAST({num} AS DOUBLE) / NULLIF(CAST(COUNT({d}) * (COUNT({d}) - 1) AS DOUBLE), 0))"


def HE(expr: str, d: int = 0) -> str:
    """IEEE round-half-even of a double (= numpy round = Spark rint)."""
    y = f"(CAST({expr} AS DOUBLE) * {float(10 ** d)})" if d else f"CAST({expr} AS DOUBLE)"
    r = (f"(CASE WHEN {y} - floor({y}) > 0.5 THEN floor({y}) + 1 "
         f"WHEN {y} - floor({y}) < 0.5 THEN floor({y}) "
         f"WHEN floor({y}) % 2 = 0 THEN floor({y}) ELSE floor({y}) + 1 END)")
    return f"({r} / {float(10 ** d)})" if d else r


ADAPTERS = """
suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
    round(1.0 + 4.0 * least(greatest((s_acctbal + 1000.0) / 11000.0, 0.0), 1.0), 1) AS rating,
    CAST(0.75 + (s_suppkey * 11 % 24) * 0.01 AS DOUBLE) AS reliability_score FROM supplier),
warehouses AS (
  SELECT concat('WH0', CAST(r_regionkey + 1 AS VARCHAR)) AS warehouse_id, r_name AS warehouse_name, r_name AS location,
    CAST(150000 + 50000 * r_regionkey AS BIGINT) AS capacity_sqft,
    CAST(45000 + 12500 * r_regionkey AS DOUBLE) AS operational_cost_monthly FROM region),
raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    CASE WHEN p_type = 'ECONOMY' AND p_partkey % 10 < 2 THEN 'economy' WHEN p_type = 'ECONOMY' AND p_partkey % 10 = 2 THEN 'ECON'
         WHEN p_type = 'PROMO' AND p_partkey % 10 = 3 THEN 'promo' ELSE p_type END AS category,
    CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.400 + (p_partkey % 25) * 0.015 AS DECIMAL(5,3)) AS DECIMAL(12,2)) AS unit_cost,
    p_partkey % (SELECT count(*) FROM supplier) AS supplier_id,
    CAST(CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 3 + p_size % 19 END AS DOUBLE) AS lead_time_days,
    CASE p_partkey % 5 WHEN 0 THEN 10 WHEN 1 THEN 50 WHEN 2 THEN 100 WHEN 3 THEN 200 ELSE 500 END AS min_order_qty FROM part),
raw_sales AS (
  WITH b AS (SELECT l.*, o.o_orderpriority, n.n_regionkey, p.p_retailprice FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
     JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey JOIN part p ON l_partkey = p_partkey),
   s AS (SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-', CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR)) AS sale_id,
    CAST(l_shipdate AS DATE) AS sale_date, l_partkey AS product_id, concat('WH0', CAST(n_regionkey + 1 AS VARCHAR)) AS warehouse_id,
    CAST(l_quantity AS INT) * (CASE WHEN l_orderkey % 997 = 0 THEN -1 ELSE 1 END) AS quantity_sold,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2)) * (CASE WHEN l_orderkey % 499 = 1 THEN 10 ELSE 1 END) AS DECIMAL(12,2)) AS selling_price_per_unit,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' WHEN o_orderpriority = '5-LOW' THEN 'Wholesale' ELSE 'Retail' END AS channel, l_orderkey FROM b)
  SELECT sale_id, sale_date, product_id, warehouse_id, quantity_sold, selling_price_per_unit, channel FROM s
  UNION ALL SELECT sale_id, sale_date, product_id, warehouse_id, quantity_sold, selling_price_per_unit, channel FROM s WHERE l_orderkey % 101 = 0),
raw_inventory AS (
  WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS snap FROM lineitem WHERE CAST(l_shipdate AS DATE) > (SELECT max(CAST(l_shipdate AS DATE)) - INTERVAL '60' DAY FROM lineitem)),
   sold AS (SELECT CAST(l_shipdate AS DATE) AS snap, l_partkey AS pk, n_regionkey AS rk, sum(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY CAST(l_shipdate AS DATE), l_partkey, n_regionkey),
   g AS (SELECT d.snap, p_partkey AS pk, r_regionkey AS rk, (p_partkey * 37 + r_regionkey * 101) % 200 AS opening, p_size, p_partkey FROM d CROSS JOIN part CROSS JOIN region),
   b AS (SELECT g.*, CAST(greatest(0, g.opening - sum(coalesce(sold.q, 0)) OVER (PARTITION BY g.pk, g.rk ORDER BY g.snap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS BIGINT) AS oh
     FROM g LEFT JOIN sold ON g.snap = sold.snap AND g.pk = sold.pk AND g.rk = sold.rk)
  SELECT snap AS date, pk AS product_id, concat('WH0', CAST(rk + 1 AS VARCHAR)) AS warehouse_id,
    CASE WHEN (pk * 5 + rk) % 401 = 0 THEN -5 ELSE oh END AS stock_on_hand,
    CAST(floor(oh * ((pk + rk) % 16) / 100.0) AS BIGINT) AS stock_allocated,
    CASE WHEN oh < 2.5 * (3 + p_size % 19) AND (pk + rk) % 3 = 0 THEN 50 ELSE 0 END AS stock_on_order FROM b)"""

CLEAN = """
std_products AS (
  SELECT product_id, product_name,
    CASE category WHEN 'economy' THEN 'ECONOMY' WHEN 'ECON' THEN 'ECONOMY' WHEN 'promo' THEN 'PROMO' ELSE category END AS category,
    unit_price, unit_cost, supplier_id, lead_time_days, min_order_qty FROM raw_products),
products AS (
  SELECT sp.product_id, sp.product_name, sp.category, sp.unit_price, sp.unit_cost, sp.supplier_id,
    CAST(trunc(coalesce(sp.lead_time_days, m.med_lead, 7.0)) AS INTEGER) AS lead_time_days, sp.min_order_qty
  FROM std_products sp LEFT JOIN (SELECT category, median(lead_time_days) AS med_lead FROM std_products GROUP BY category) m
    ON sp.category = m.category),
dedup_sales AS (SELECT DISTINCT * FROM raw_sales),
sales AS (
  SELECT d.sale_id, d.sale_date, d.product_id, d.warehouse_id, abs(d.quantity_sold) AS quantity_sold,
    CASE WHEN d.selling_price_per_unit > p.unit_price * 5 THEN p.unit_price ELSE d.selling_price_per_unit END AS selling_price_per_unit,
    d.channel,
    CAST(abs(d.quantity_sold) * (CASE WHEN d.selling_price_per_unit > p.unit_price * 5 THEN p.unit_price ELSE d.selling_price_per_unit END) AS DECIMAL(18,2)) AS revenue
  FROM dedup_sales d LEFT JOIN products p ON d.product_id = p.product_id),
inventory AS (
  SELECT date, product_id, warehouse_id, CAST(greatest(stock_on_hand, 0) AS BIGINT) AS stock_on_hand,
    CAST(coalesce(stock_allocated, 0) AS BIGINT) AS stock_allocated, CAST(coalesce(stock_on_order, 0) AS BIGINT) AS stock_on_order
  FROM raw_inventory),
ci AS (
  SELECT i.date, i.product_id, p.product_name, p.category, i.warehouse_id, w.warehouse_name,
    i.stock_on_hand, i.stock_allocated, i.stock_on_order, i.stock_on_hand - i.stock_allocated AS net_available_stock
  FROM inventory i JOIN products p ON i.product_id = p.product_id JOIN warehouses w ON i.warehouse_id = w.warehouse_id
  WHERE i.date = (SELECT max(date) FROM inventory))"""


def with_base(body: str, recursive: bool = False) -> str:
    """Prefix ``body`` (which may start with its own CTE list after a comma
    or be a bare SELECT) with the adapter and cleaning CTEs."""
    body = body.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    if body.upper().startswith("WITH "):
        return head + ADAPTERS + "," + CLEAN + ",\n" + body[5:]
    return head + ADAPTERS + "," + CLEAN + "\n" + body
