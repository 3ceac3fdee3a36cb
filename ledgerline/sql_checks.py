"""DuckDB SQL equal in meaning to each report in ``reports``.

Tables ``orders lineitem part customer nation region`` are views over the
same Parquet files.  Type alignment rules (see SURVEY 7.3): money is
DECIMAL(18,4) per line and DECIMAL(28,4) per sum; dates are DATE; counts are
BIGINT; ratios are one double division of exact inputs.
"""

from __future__ import annotations

# The sales fact.
SALES = """
sales AS (
  SELECT o.o_orderkey AS order_id,
         o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         p.p_type AS category,
         p.p_brand AS subcategory,
         r.r_name AS region,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
              * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS revenue
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

# All orders, as the cohort operators see them.
ORDERS = """
ords AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
)"""


def _month(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def _ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


def _month_index(start: str, end: str) -> str:
    return (f"CAST((year({end}) - year({start})) * 12 + (month({end}) - month({start})) "
            f"AS INTEGER)")


def _trend(period_expr: str, by: str = "", where: str = "") -> str:
    """CTEs ``per_order`` and ``trend``: revenue and orders per period (and group)."""
    by_sel = f"{by}, " if by else ""
    return f"""
per_order AS (
  SELECT {period_expr} AS period, {by_sel}order_id, sum(revenue) AS amount
  FROM sales {where} GROUP BY ALL
),
trend AS (
  SELECT period, {by_sel}CAST(sum(amount) AS DECIMAL(28,4)) AS revenue,
         count(order_id) AS orders
  FROM per_order GROUP BY ALL
)"""


def _filled(by: str = "", step: str = "DAY") -> str:
    """CTE ``filled``: the ``trend`` CTE with missing periods as zero rows."""
    if by:
        grid = f"""
grid AS (
  SELECT gr.{by}, CAST(g.ts AS DATE) AS period
  FROM (SELECT DISTINCT {by} FROM trend) gr,
       (SELECT min(period) AS lo, max(period) AS hi FROM trend) b,
       generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 {step}) g(ts)
)"""
        on = f"t.{by} IS NOT DISTINCT FROM grid.{by} AND t.period = grid.period"
        sel = f"grid.{by}, "
    else:
        grid = f"""
grid AS (
  SELECT CAST(g.ts AS DATE) AS period
  FROM (SELECT min(period) AS lo, max(period) AS hi FROM trend) b,
       generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 {step}) g(ts)
)"""
        on = "t.period = grid.period"
        sel = ""
    return f"""{grid},
filled AS (
  SELECT grid.period, {sel}COALESCE(t.revenue, CAST(0 AS DECIMAL(28,4))) AS revenue,
         COALESCE(t.orders, 0) AS orders
  FROM grid LEFT JOIN trend t ON {on}
)"""


def _breakdown(by: str, where: str = "") -> str:
    """CTE ``bd``: revenue, orders per group."""
    return f"""
bd_order AS (SELECT {by}, order_id, sum(revenue) AS amount FROM sales {where} GROUP BY ALL),
bd AS (
  SELECT {by}, CAST(sum(amount) AS DECIMAL(28,4)) AS revenue, count(order_id) AS orders
  FROM bd_order GROUP BY ALL
)"""


_COHORT_CELLS = f"""
act AS (SELECT DISTINCT customer_id, {_month('order_date')} AS m FROM ords),
coh AS (SELECT customer_id, min(m) AS cohort FROM act GROUP BY customer_id),
cells AS (
  SELECT cohort, {_month_index('cohort', 'm')} AS month_index, count(*) AS customers
  FROM act JOIN coh USING (customer_id) GROUP BY ALL
),
sized AS (
  SELECT cohort, month_index, customers,
         max(CASE WHEN month_index = 0 THEN customers END) OVER (PARTITION BY cohort) AS cohort_size
  FROM cells
),
dense AS (
  SELECT s.cohort, CAST(g.i AS INTEGER) AS month_index,
         COALESCE(c.customers, 0) AS customers, s.cohort_size
  FROM (SELECT cohort, cohort_size FROM sized WHERE month_index = 0) s,
       (SELECT max(m) AS last FROM act) lm,
       generate_series(0, {_month_index('s.cohort', 'lm.last')}) g(i)
  LEFT JOIN cells c ON c.cohort = s.cohort AND c.month_index = g.i
)"""

SQL: dict[str, str] = {}

SQL["sales_fact"] = f"WITH {SALES} SELECT * FROM sales"

SQL["sql_monthly_orders"] = f"""
SELECT {_month('o.o_orderdate')} AS period, count(*) AS orders,
       count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS fulfilled_orders,
       count(CASE WHEN NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
                  THEN 1 END) AS orders_without_lines
FROM orders o GROUP BY 1
"""

SQL["kpi_totals"] = f"""
WITH {SALES},
per_order AS (SELECT order_id, sum(revenue) AS amount FROM sales GROUP BY order_id),
k AS (
  SELECT CAST(sum(amount) AS DECIMAL(28,4)) AS revenue, count(order_id) AS orders
  FROM per_order
)
SELECT revenue, orders, {_ratio('revenue', 'orders')} AS aov FROM k
"""

SQL["kpi_sliced"] = f"""
WITH {SALES},
per_order AS (
  SELECT order_id, sum(revenue) AS amount FROM sales
  WHERE order_date >= DATE '1998-01-01' AND order_date < DATE '1999-01-01'
    AND category IN ('PROMO') AND region IN ('ASIA')
  GROUP BY order_id
),
k AS (
  SELECT CAST(sum(amount) AS DECIMAL(28,4)) AS revenue, count(order_id) AS orders
  FROM per_order
)
SELECT revenue, orders, {_ratio('revenue', 'orders')} AS aov FROM k
"""

SQL["trend_daily"] = f"WITH {SALES}, {_trend('order_date')} SELECT * FROM trend"
SQL["trend_monthly"] = f"WITH {SALES}, {_trend(_month('order_date'))} SELECT * FROM trend"
SQL["trend_category_monthly"] = (
    f"WITH {SALES}, {_trend(_month('order_date'), 'category')} SELECT * FROM trend")
SQL["trend_daily_filled"] = (
    f"WITH {SALES}, {_trend('order_date')}, {_filled()} SELECT * FROM filled")
SQL["trend_category_filled"] = (
    f"WITH {SALES}, {_trend(_month('order_date'), 'category')}, {_filled('category', 'MONTH')} "
    f"SELECT * FROM filled")

SQL["trend_growth"] = f"""
WITH {SALES}, {_trend(_month('order_date'))}, {_filled(step='MONTH')},
g AS (SELECT *, lag(revenue) OVER (ORDER BY period) AS prev_revenue FROM filled)
SELECT period, revenue, orders, prev_revenue,
       {_ratio('revenue - prev_revenue', 'prev_revenue')} AS growth
FROM g
"""

SQL["trend_monthly_complete"] = f"""
WITH {SALES},
per_order0 AS (
  SELECT {_month('order_date')} AS period, order_id, sum(revenue) AS amount
  FROM sales GROUP BY ALL
),
trend0 AS (
  SELECT period, CAST(sum(amount) AS DECIMAL(28,4)) AS revenue, count(order_id) AS orders
  FROM per_order0 GROUP BY ALL
),
trend AS (
  SELECT * FROM trend0
  WHERE CAST(period + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)
        <= (SELECT max(order_date) FROM sales)
), {_filled(step='MONTH')},
g AS (SELECT *, lag(revenue) OVER (ORDER BY period) AS prev_revenue FROM filled)
SELECT period, revenue, orders, prev_revenue,
       {_ratio('revenue - prev_revenue', 'prev_revenue')} AS growth
FROM g
"""

SQL["trend_ytd"] = f"""
WITH {SALES}, {_trend(_month('order_date'))}
SELECT period, revenue, orders,
       CAST(sum(revenue) OVER (PARTITION BY year(period) ORDER BY period
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,4)) AS ytd_revenue
FROM trend
"""

SQL["trend_moving_avg"] = f"""
WITH {SALES}, {_trend(_month('order_date'))}, {_filled(step='MONTH')}
SELECT period, revenue, orders,
       {_ratio('sum(revenue) OVER w', 'count(revenue) OVER w')} AS moving_avg
FROM filled
WINDOW w AS (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
"""

SQL["breakdown_category"] = f"""
WITH {SALES}, {_breakdown('category')}
SELECT category, revenue, orders, {_ratio('revenue', 'orders')} AS aov FROM bd
"""

SQL["breakdown_region"] = f"""
WITH {SALES}, {_breakdown('region')}
SELECT region, revenue, orders, {_ratio('revenue', 'orders')} AS aov FROM bd
"""

SQL["published_region_sales"] = SQL["breakdown_region"]

SQL["breakdown_rollup"] = f"""
WITH {SALES},
po AS (SELECT category, region, order_id, sum(revenue) AS amount FROM sales GROUP BY ALL),
r AS (
  SELECT category, region, CAST(sum(amount) AS DECIMAL(28,4)) AS revenue,
         count(DISTINCT order_id) AS orders,
         CAST(GROUPING(category, region) AS INTEGER) AS level
  FROM po GROUP BY ROLLUP (category, region)
)
SELECT category, region, revenue, orders, level, {_ratio('revenue', 'orders')} AS aov FROM r
"""

SQL["breakdown_top_categories"] = f"""
WITH {SALES}, {_breakdown('region, category')},
r AS (
  SELECT region, category, revenue,
         CAST(row_number() OVER (PARTITION BY region ORDER BY revenue DESC, category ASC)
              AS INTEGER) AS rank
  FROM bd
)
SELECT * FROM r WHERE rank <= 3
"""

SQL["customer_cohorts"] = f"""
WITH {ORDERS}
SELECT customer_id, {_month('min(order_date)')} AS cohort FROM ords GROUP BY customer_id
"""

SQL["cohort_sizes"] = f"""
WITH {ORDERS},
fo AS (SELECT customer_id, {_month('min(order_date)')} AS cohort FROM ords GROUP BY customer_id)
SELECT cohort, count(*) AS customers FROM fo GROUP BY cohort
"""

SQL["cohort_long"] = f"""
WITH {ORDERS}, {_COHORT_CELLS}
SELECT cohort, month_index, customers, cohort_size,
       {_ratio('customers', 'cohort_size')} AS retention
FROM sized
"""

SQL["cohort_dense"] = f"""
WITH {ORDERS}, {_COHORT_CELLS}
SELECT cohort, month_index, customers, cohort_size,
       {_ratio('customers', 'cohort_size')} AS retention
FROM dense
"""

# The fixtures' orders span 80 months (1995-01 to 2001-08), the last one partial.
MATRIX_MONTHS = 80

#: Cells up to the last month whose last day has passed in the data.
_COMPLETE = f"""
complete AS (
  SELECT dense.* FROM dense, (SELECT max(order_date) AS d FROM ords) x
  WHERE CAST(cohort + to_months(month_index) AS DATE) <=
        CASE WHEN last_day(d) = d THEN {_month('d')}
             ELSE CAST({_month('d')} - INTERVAL 1 MONTH AS DATE) END
)"""


def _matrix(cells: str, months: int) -> str:
    cols = "".join(
        f",\n       max(CASE WHEN month_index = {i} THEN {_ratio('customers', 'cohort_size')} END)"
        f" AS m{i}" for i in range(months))
    return f"""
SELECT cohort, cohort_size{cols}
FROM {cells} GROUP BY cohort, cohort_size
"""


def _curve(cells: str) -> str:
    return f"""
c AS (
  SELECT month_index, CAST(sum(customers) AS BIGINT) AS retained,
         CAST(sum(cohort_size) AS BIGINT) AS eligible, count(*) AS cohorts
  FROM {cells} GROUP BY month_index
)
SELECT month_index, retained, eligible, cohorts, {_ratio('retained', 'eligible')} AS retention
FROM c
"""


def matrix_sql(months: int, complete_only: bool = False) -> str:
    """The retention matrix with columns m0 to m<months - 1>."""
    if complete_only:
        return f"WITH {ORDERS}, {_COHORT_CELLS}, {_COMPLETE} {_matrix('complete', months)}"
    return f"WITH {ORDERS}, {_COHORT_CELLS} {_matrix('dense', months)}"


def sql_for(name: str, columns) -> str:
    """A report's SQL; a matrix is as wide as the ``columns`` of the result,
    since its width follows the data."""
    if name.startswith("cohort_matrix"):
        return matrix_sql(len(columns) - 2, name.endswith("complete"))
    return SQL[name]


SQL["cohort_matrix"] = matrix_sql(MATRIX_MONTHS)
SQL["retention_curve"] = f"WITH {ORDERS}, {_COHORT_CELLS}, {_curve('dense')}"
SQL["cohort_dense_complete"] = f"""
WITH {ORDERS}, {_COHORT_CELLS}, {_COMPLETE}
SELECT cohort, month_index, customers, cohort_size,
       {_ratio('customers', 'cohort_size')} AS retention
FROM complete
"""
SQL["cohort_matrix_complete"] = matrix_sql(MATRIX_MONTHS - 1, complete_only=True)
SQL["retention_curve_complete"] = (
    f"WITH {ORDERS}, {_COHORT_CELLS}, {_COMPLETE}, {_curve('complete')}")

SQL["repeat_rate"] = f"""
WITH {ORDERS},
pc AS (SELECT customer_id, count(DISTINCT order_id) AS n FROM ords GROUP BY customer_id),
r AS (SELECT count(*) AS customers, count(CASE WHEN n >= 2 THEN 1 END) AS repeat_customers FROM pc)
SELECT customers, repeat_customers, {_ratio('repeat_customers', 'customers')} AS repeat_rate FROM r
"""

SQL["order_seq"] = f"""
WITH {ORDERS}
SELECT order_id, customer_id, order_date,
       CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS BIGINT)
         AS order_seq
FROM ords
"""

SQL["order_seq_wide"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
               AS BIGINT) AS order_seq
FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
"""

SQL["new_vs_returning"] = f"""
WITH {ORDERS},
pm AS (SELECT {_month('order_date')} AS period, count(*) AS orders FROM ords GROUP BY 1),
fo AS (SELECT customer_id, {_month('min(order_date)')} AS cohort FROM ords GROUP BY customer_id),
nw AS (SELECT cohort AS period, count(*) AS new_orders FROM fo GROUP BY cohort)
SELECT pm.period, pm.orders, COALESCE(nw.new_orders, 0) AS new_orders,
       pm.orders - COALESCE(nw.new_orders, 0) AS returning_orders
FROM pm LEFT JOIN nw USING (period)
"""

SQL["order_gaps"] = f"""
WITH {ORDERS},
pd AS (SELECT customer_id, order_date, count(*) AS n FROM ords GROUP BY ALL),
g AS (
  SELECT n, date_diff('day', lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date),
                      order_date) AS gap
  FROM pd
),
ev AS (
  SELECT gap AS gap_days, 1 AS w FROM g WHERE gap IS NOT NULL
  UNION ALL
  SELECT 0 AS gap_days, n - 1 AS w FROM g WHERE n > 1
)
SELECT CAST(gap_days AS INTEGER) AS gap_days, CAST(sum(w) AS BIGINT) AS occurrences
FROM ev GROUP BY 1
"""

SQL["category_rank"] = f"""
WITH {SALES}, {_breakdown('category')}
SELECT category, revenue, CAST(rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS rank FROM bd
"""

SQL["customer_revenue_rank"] = f"""
WITH {SALES}, {_breakdown('customer_id')}
SELECT customer_id, revenue, CAST(rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS rank FROM bd
"""


def _pareto(by: str) -> str:
    return f"""
WITH {SALES}, {_breakdown(by)},
w AS (
  SELECT {by}, revenue, sum(revenue) OVER () AS tot,
         sum(revenue) OVER (ORDER BY revenue DESC, {by} ASC
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM bd
)
SELECT {by}, revenue, {_ratio('revenue', 'tot')} AS share, {_ratio('run', 'tot')} AS cum_share,
       (run - revenue) < tot * 0.8 AS is_core
FROM w
"""


SQL["pareto_category"] = _pareto("category")
SQL["pareto_brand"] = _pareto("subcategory")
SQL["customer_pareto"] = _pareto("customer_id")

SQL["seasonality"] = f"""
WITH {SALES}, {_trend(_month('order_date'))}, {_filled(step='MONTH')},
m AS (SELECT year(period) AS y, month(period) AS moy, revenue FROM filled),
full_years AS (SELECT y FROM m GROUP BY y HAVING count(DISTINCT moy) = 12),
per AS (
  SELECT CAST(moy AS INTEGER) AS month_of_year, CAST(sum(revenue) AS DECIMAL(28,4)) AS revenue,
         count(*) AS years
  FROM m WHERE y IN (SELECT y FROM full_years) GROUP BY 1
)
SELECT month_of_year, revenue, years,
       {_ratio('revenue * 12', 'sum(revenue) OVER ()')} AS seasonality_index
FROM per
"""

SQL["sales_spikes"] = f"""
WITH {SALES}, {_trend(_month('order_date'))}, {_filled(step='MONTH')},
w AS (
  SELECT period, revenue, sum(revenue) OVER t AS s, count(revenue) OVER t AS n
  FROM filled
  WINDOW t AS (ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
)
SELECT period, revenue, {_ratio('s', 'n')} AS trailing_avg,
       (n = 12 AND revenue * n > s * 1.1) AS is_spike
FROM w
"""


# -- cleaning ---------------------------------------------------------------------

RAW = """
raw AS (
  SELECT o_orderkey AS oid,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS cid,
         CASE WHEN o_orderkey % 89 = 0 THEN '  ' || lower(o_orderpriority) || ' '
              WHEN o_orderkey % 83 = 0 THEN ''
              ELSE o_orderpriority END AS prio,
         CASE WHEN o_orderkey % 79 = 0 THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amt,
         CASE WHEN o_orderkey % 73 = 0 THEN '2001-13-40'
              ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS dt
  FROM orders, generate_series(1, CASE WHEN o_orderkey % 50 = 0 THEN 2 ELSE 1 END) g(copy)
)"""

STD = """
std AS (
  SELECT DISTINCT oid, cid, NULLIF(upper(trim(prio)), '') AS prio,
         TRY_CAST(trim(amt) AS DECIMAL(12,2)) AS amt, TRY_CAST(trim(dt) AS DATE) AS dt
  FROM raw
),
labelled AS (
  SELECT *, CASE WHEN cid IS NULL THEN 'missing_customer'
                 WHEN dt IS NULL THEN 'bad_date'
                 WHEN amt IS NULL THEN 'bad_amount'
                 WHEN prio IS NULL THEN 'blank_priority' END AS reject_reason
  FROM std
)"""

SQL["raw_orders"] = f"WITH {RAW} SELECT * FROM raw"
SQL["clean_accepted"] = (f"WITH {RAW}, {STD} SELECT oid, cid, prio, amt, dt FROM labelled "
                         f"WHERE reject_reason IS NULL")
SQL["clean_rejected"] = f"WITH {RAW}, {STD} SELECT * FROM labelled WHERE reject_reason IS NOT NULL"
SQL["clean_reject_reasons"] = (f"WITH {RAW}, {STD} "
                               f"SELECT reject_reason AS reason, count(*) AS rows "
                               f"FROM labelled WHERE reject_reason IS NOT NULL GROUP BY 1")
SQL["dedup_exact"] = f"WITH {RAW} SELECT DISTINCT * FROM raw"

SQL["dedup_lines"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                    l_linestatus DESC) AS rn
  FROM lineitem
) WHERE rn = 1
"""

SQL["dedup_lines_mixed"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate DESC, l_quantity ASC, l_partkey ASC, l_suppkey ASC,
                    l_extendedprice ASC, l_discount ASC, l_tax ASC, l_returnflag ASC,
                    l_linestatus ASC) AS rn
  FROM lineitem
) WHERE rn = 1
"""

SQL["split_first_reason"] = f"""
WITH {RAW}, {STD}
SELECT oid, cid, prio, amt, dt, COALESCE(reject_reason, 'accepted') AS reject_reason FROM labelled
"""

SQL["standardise_text"] = f"""
WITH {RAW} SELECT oid, cid, NULLIF(upper(trim(prio)), '') AS prio, amt, dt FROM raw
"""

SQL["cast_safe"] = f"""
WITH {RAW}
SELECT oid, cid, prio, TRY_CAST(trim(amt) AS DECIMAL(12,2)) AS amt,
       TRY_CAST(trim(dt) AS DATE) AS dt
FROM raw
"""

SQL["fill_nulls"] = f"""
WITH {RAW}, {STD} SELECT oid, cid, COALESCE(prio, 'UNSPECIFIED') AS prio, amt, dt FROM std
"""

SQL["require_customer"] = f"WITH {RAW}, {STD} SELECT * FROM std WHERE cid IS NOT NULL"

SQL["domain_violations"] = """
SELECT *, CASE WHEN NOT (o_totalprice IS NOT NULL AND o_totalprice >= 5000) THEN 'min_total'
               WHEN NOT (o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O')) THEN 'status'
          END AS violation
FROM orders
WHERE NOT (o_totalprice IS NOT NULL AND o_totalprice >= 5000)
   OR NOT (o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O'))
"""

SQL["orders_without_lines"] = """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

SQL["ship_before_order"] = """
SELECT count(*) AS rows_checked,
       count(CASE WHEN l.l_shipdate < o.o_orderdate THEN 1 END) AS rows_failed
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""


def _profile(cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls,
       count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value,
       CAST(max({c}) AS VARCHAR) AS max_value
FROM orders""")
    return "\nUNION ALL".join(parts)


SQL["profile_orders"] = _profile(("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"))


SQL["csv_raw_orders"] = f"""
WITH {RAW}
SELECT oid, cid, prio, TRY_CAST(amt AS DECIMAL(12,2)) AS amt,
       TRY_CAST(dt AS DATE) AS dt,
       (amt IS NOT NULL AND TRY_CAST(amt AS DECIMAL(12,2)) IS NULL)
         OR (dt IS NOT NULL AND TRY_CAST(dt AS DATE) IS NULL) AS malformed
FROM raw
"""

SQL["fact_month_slice"] = f"""
WITH {SALES}
SELECT *, {_month('order_date')} AS order_month FROM sales
WHERE order_date >= DATE '1998-01-01' AND order_date < DATE '1999-01-01'
"""


SQL["fact_written_full"] = f"""
WITH {SALES} SELECT *, {_month('order_date')} AS order_month FROM sales
"""


def _seasonality(by: str) -> str:
    return f"""
WITH {SALES}, {_trend(_month('order_date'), by)}, {_filled(by, 'MONTH')},
m AS (SELECT {by}, year(period) AS y, month(period) AS moy, revenue FROM filled),
full_years AS (SELECT y FROM m GROUP BY y HAVING count(DISTINCT moy) = 12),
per AS (
  SELECT {by}, CAST(moy AS INTEGER) AS month_of_year,
         CAST(sum(revenue) AS DECIMAL(28,4)) AS revenue, count(*) AS years
  FROM m WHERE y IN (SELECT y FROM full_years) GROUP BY 1, 2
)
SELECT {by}, month_of_year, revenue, years,
       {_ratio('revenue * 12', f'sum(revenue) OVER (PARTITION BY {by})')} AS seasonality_index
FROM per
"""


SQL["seasonality_by_category"] = _seasonality("category")
SQL["seasonality_by_brand"] = _seasonality("subcategory")

_SLICE = ("order_date >= DATE '1998-01-01' AND order_date < DATE '1999-01-01'")
SQL["dashboard_sliced_trend"] = f"""
WITH {SALES},
{_trend(_month('order_date'),
        where=f"WHERE {_SLICE} AND category IN ('PROMO') AND region IN ('ASIA')")},
{_filled(step='MONTH')},
g AS (SELECT *, lag(revenue) OVER (ORDER BY period) AS prev_revenue FROM filled)
SELECT period, revenue, orders, prev_revenue,
       {_ratio('revenue - prev_revenue', 'prev_revenue')} AS growth
FROM g
"""

SQL["dashboard_sliced_breakdown"] = f"""
WITH {SALES},
po AS (SELECT category, region, order_id, sum(revenue) AS amount FROM sales
       WHERE {_SLICE} GROUP BY ALL),
r AS (
  SELECT category, region, CAST(sum(amount) AS DECIMAL(28,4)) AS revenue,
         count(DISTINCT order_id) AS orders,
         CAST(GROUPING(category, region) AS INTEGER) AS level
  FROM po GROUP BY ROLLUP (category, region)
)
SELECT category, region, revenue, orders, level, {_ratio('revenue', 'orders')} AS aov FROM r
"""

SQL["spikes_by_category"] = f"""
WITH {SALES}, {_trend(_month('order_date'), 'category')}, {_filled('category', 'MONTH')},
w AS (
  SELECT category, period, revenue, sum(revenue) OVER t AS s, count(revenue) OVER t AS n
  FROM filled
  WINDOW t AS (PARTITION BY category ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)
)
SELECT category, period, revenue, {_ratio('s', 'n')} AS trailing_avg,
       (n = 12 AND revenue * n > s * 1.1) AS is_spike
FROM w
"""

# Joins in time: events are read 24 years earlier (reports.EVENT_SHIFT_DAYS).
_EVENTS = """
ev AS (SELECT event_id, user_id AS customer_id, event_type,
              ts - INTERVAL 8766 DAY AS event_at FROM events),
o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at FROM orders)
"""

SQL["orders_after_event"] = f"""
WITH {_EVENTS}
SELECT o.customer_id, order_id, ordered_at, event_id, event_type, event_at
FROM o JOIN ev ON o.customer_id = ev.customer_id
  AND ordered_at > event_at AND ordered_at <= event_at + INTERVAL 7 DAY
"""

SQL["repeat_orders_30d"] = f"""
WITH {_EVENTS}
SELECT o.customer_id, o.order_id, o.ordered_at, f.order_id AS first_order_id,
       f.ordered_at AS first_at
FROM o JOIN o f ON o.customer_id = f.customer_id
  AND o.ordered_at > f.ordered_at AND o.ordered_at <= f.ordered_at + INTERVAL 30 DAY
"""


def _asof(left: str, right: str, on: str, order: str, cols: str, key: str) -> str:
    return f"""
WITH {_EVENTS},
n AS (SELECT {left}.*, row_number() OVER () AS rn FROM {left}),
j AS (SELECT n.*, {cols}, row_number() OVER (PARTITION BY rn ORDER BY {order}) AS pick
      FROM n LEFT JOIN {right} r ON n.customer_id = r.customer_id AND {on})
SELECT * EXCLUDE (rn, pick) FROM j WHERE pick = 1
"""


SQL["orders_last_event"] = _asof(
    "o", "ev", "r.event_at <= n.ordered_at", "r.event_at DESC, r.event_id DESC",
    "r.event_id, r.event_type, r.event_at", "order_id")
SQL["events_last_order"] = _asof(
    "ev", "o", "r.ordered_at < n.event_at", "r.ordered_at DESC, r.order_id DESC",
    "r.order_id, r.ordered_at", "event_id")

# Streams: an event is late if its window (its minute) ended at or before the
# largest time (end of a minute) of the arrivals before its own, less two hours.
_ARRIVALS = """
a AS (
  SELECT *, CAST(coalesce(least(2, greatest(0, floor(
           date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 10.0))), 0)
           + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS INTEGER) AS arrival
  FROM events WHERE ts IS NOT NULL {where}
),
k AS (SELECT unnest(range(0, 4)) AS arrival),
marks AS (
  SELECT k.arrival, (SELECT max({seen}) FROM a WHERE a.arrival < k.arrival) - INTERVAL 2 HOUR AS mark,
         (SELECT max({seen}) FROM a) - INTERVAL 2 HOUR AS final
  FROM k
),
seen AS (
  SELECT a.*, final, date_trunc('{unit}', ts) AS period,
         coalesce(date_trunc('{unit}', ts) + INTERVAL 1 {unit} <= date_trunc('milliseconds', mark),
                  FALSE) AS late
  FROM a JOIN marks USING (arrival)
)"""

SQL["stream_event_trend"] = f"""
WITH {_ARRIVALS.format(where='', unit='hour', seen='ts')}
SELECT period, event_type,
       count(*) FILTER (WHERE NOT late) AS events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE NOT late) AS DECIMAL(22,2)) AS value,
       count(*) FILTER (WHERE late) AS late_events
FROM seen GROUP BY period, event_type
HAVING count(*) FILTER (WHERE NOT late) > 0 AND period + INTERVAL 1 HOUR <= max(final)
"""

SQL["stream_sessions"] = f"""
WITH {_ARRIVALS.format(
    where='AND user_id IS NOT NULL', unit='minute',
    seen="date_trunc('minute', ts) + INTERVAL 1 MINUTE")},
kept AS (SELECT * FROM seen WHERE NOT late),
marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new
  FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY ts)
),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts
                                      ROWS UNBOUNDED PRECEDING) AS no FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
       CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))), 0) AS DECIMAL(18,2)) AS value
FROM numbered GROUP BY user_id, no
HAVING max(ts) + INTERVAL 6 HOUR < max(final)
"""

SQL["customers_by_month_sketched"] = f"""
WITH {ORDERS}
SELECT {_month('order_date')} AS period, count(DISTINCT customer_id) AS customers,
       TRUE AS within_bound
FROM ords GROUP BY 1
"""

SQL["order_value_quantiles_sketched"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
       TRUE AS median_within_bound, TRUE AS p95_within_bound
FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1
"""

_BAGS = f"""
WITH {RAW}, {STD},
l AS (SELECT oid, cid, NULLIF(upper(trim(prio)), '') AS prio,
             TRY_CAST(trim(amt) AS DECIMAL(12,2)) AS amt, TRY_CAST(trim(dt) AS DATE) AS dt FROM raw),
r AS (SELECT oid, cid, prio, amt, dt FROM labelled WHERE reject_reason IS NULL)"""
SQL["raw_minus_clean"] = f"{_BAGS} SELECT * FROM l EXCEPT ALL SELECT * FROM r"
SQL["raw_and_clean"] = f"{_BAGS} SELECT * FROM l INTERSECT ALL SELECT * FROM r"
SQL["raw_clean_reconciled"] = f"""{_BAGS}
SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
       (SELECT count(*) FROM (SELECT * FROM l INTERSECT ALL SELECT * FROM r)) AS common_rows,
       (SELECT count(*) FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)) AS only_left,
       (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) AS only_right
"""

_PROPS = """
e AS (
  SELECT event_id,
         CASE WHEN event_id % 61 = 0 THEN left(props, length(props) - 1)
              WHEN event_id % 53 = 0 THEN '{"k": "many"}'
              WHEN event_id % 47 = 0
                THEN '{"source": "app", "deep": {"a": 1}, ' || substr(props, 2, length(props) - 2) || '}'
              WHEN event_id % 43 = 0 THEN '{"k": null}'
              WHEN event_id % 41 = 0 THEN '[1, 2]'
              ELSE props END AS props
  FROM events
),
ok AS (SELECT event_id, CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT'
                             THEN props END AS obj, props FROM e)"""
SQL["event_props_typed"] = f"""
WITH {_PROPS}
SELECT event_id, TRY_CAST(json_extract_string(obj, '$.k') AS BIGINT) AS k,
       json_extract_string(obj, '$.source') AS source,
       CASE WHEN obj IS NULL THEN props END AS props,
       CASE WHEN obj IS NULL AND props IS NOT NULL THEN 'broken_json' END AS reject_reason
FROM ok
"""
SQL["event_props_keys"] = f"""
WITH {_PROPS},
p AS (SELECT unnest(json_keys(obj)) AS key, obj FROM ok WHERE obj IS NOT NULL),
v AS (SELECT key, json_extract_string(obj, '$.' || key) AS value FROM p)
SELECT key, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS nulls,
       count(*) FILTER (WHERE TRY_CAST(value AS DECIMAL(38,9)) IS NOT NULL) AS numbers,
       count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(38,9)) IS NULL) AS texts,
       count(DISTINCT value) AS distinct_values
FROM v GROUP BY key
"""

SQL["fact_two_batches"] = f"WITH {SALES} SELECT * FROM sales WHERE order_date IS NOT NULL"
SQL["fact_batch_history"] = f"""
WITH {SALES},
b AS (SELECT {_month('order_date')} AS m,
             CASE WHEN year(order_date) = 1998 AND order_id % 7 = 0 THEN 2 ELSE 1 END AS version
      FROM sales WHERE order_date IS NOT NULL)
SELECT CAST(v AS BIGINT) AS version, CASE v WHEN 1 THEN 'first' ELSE 'late' END AS batch,
       (SELECT count(DISTINCT m) FROM b WHERE version = v) AS months_written
FROM (SELECT unnest([1, 2]) AS v)
"""

SQL["fact_bucketed"] = f"WITH {SALES} SELECT * FROM sales"

# Orders of the customers of a region whose first order brought most in a category.
_SLICED_ORDERS = f"""
{SALES},
first_order AS (
  SELECT customer_id, category,
         row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id,
                            -amount ASC NULLS FIRST, category ASC NULLS FIRST) AS place
  FROM (SELECT customer_id, order_date, order_id, category, sum(revenue) AS amount
        FROM sales WHERE order_date IS NOT NULL GROUP BY ALL)
),
ords AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date
  FROM orders
  WHERE o_orderdate IS NOT NULL
    AND o_custkey IN (SELECT customer_id FROM first_order
                      WHERE place = 1 AND category IN ('PROMO', 'ECONOMY'))
    AND o_custkey IN (SELECT c_custkey FROM customer
                      JOIN nation ON n_nationkey = c_nationkey
                      JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')
)"""

SQL["cohort_dense_sliced"] = f"""
WITH {_SLICED_ORDERS}, {_COHORT_CELLS}
SELECT cohort, month_index, customers, cohort_size,
       {_ratio('customers', 'cohort_size')} AS retention
FROM dense
"""

SQL["dashboard_sliced_retention"] = f"WITH {_SLICED_ORDERS}, {_COHORT_CELLS}, {_curve('dense')}"
