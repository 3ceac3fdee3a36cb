"""Named reports over the fixture tables.

Each report is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables;
``__spark_entry__.queries()`` exposes them all.  ``sql_checks.SQL`` holds the
equivalent DuckDB SQL for each name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dashboard import dashboard
from .operators import clean as cln
from .operators import cohort as coh
from .operators import insight as ins
from .operators import kpi
from .operators import reconcile as rec
from .operators import semistruct as semi
from .operators import sketch as sk
from .operators import temporal as tmp
from .operators import trend as trd
from .operators._util import join_null_safe
from .plans import arrivals as arr
from .plans import dirty
from .plans import sales as model
from .session import scratch_path, set_defaults
from .sources import (
    BucketedFact,
    FactStore,
    export_csv,
    history,
    load,
    load_csv,
    publish,
    read_clean,
    register,
    write_clean,
)
from .streaming import Replay, late_windows, sessions, windowed_trend

Report = Callable[[SparkSession, str], DataFrame]
REPORTS: dict[str, Report] = {}

# Fixed report parameters (the SQL in sql_checks uses the same values).
KPI_SLICE = {"start": "1998-01-01", "end": "1999-01-01",
             "categories": ["PROMO"], "regions": ["ASIA"]}
COHORT_SLICE = {"regions": ["ASIA"], "categories": ["PROMO", "ECONOMY"]}
VIEW_PREFIX = "ledgerline_"
FACT_SLICE = ("1998-01-01", "1999-01-01")
TOP_K = 3
PARETO_CUTOFF = 0.8
SPIKE_RATIO = 1.1
MOVING_WINDOW = 3
RAW_ORDER_RULES = cln.CleanRules(
    text=("prio",),
    casts={"amt": "decimal(12,2)", "dt": "date"},
    checks=(("missing_customer", "cid IS NULL"), ("bad_date", "dt IS NULL"),
            ("bad_amount", "amt IS NULL"), ("blank_priority", "prio IS NULL")),
)
LINE_KEYS = ("l_orderkey", "l_linenumber")
ORDER_DOMAIN = (cln.DomainRule("min_total", "o_totalprice", lo=5000),
                cln.DomainRule("status", "o_orderstatus", allowed=("F", "O")))
#: ``events`` lie in 2024, ``orders`` end in 2001: events are read 24 years
#: earlier (8,766 days) where both meet.
EVENT_SHIFT_DAYS = 8766
AFTER_EVENT_DAYS = 7
REPEAT_DAYS = 30
PROFILE_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def report(name: str):
    """Register ``fn`` under ``name`` in ``REPORTS``.

    A report sets what it relies on (``session.set_defaults``) in a session that
    has no value of its own, as reports also run in sessions nobody tuned.
    """
    def deco(fn: Report) -> Report:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            set_defaults(spark)
            return fn(spark, sf_dir)

        REPORTS[name] = run
        return run
    return deco


def _sales(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return model.sales(load(spark, sf_dir), **kw)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.orders(load(spark, sf_dir))


# -- fact ----------------------------------------------------------------------

@report("sales_fact")
def sales_fact(spark, sf_dir):
    return _sales(spark, sf_dir)


@report("sql_monthly_orders")
def sql_monthly_orders(spark, sf_dir):
    """SRC-2: the tables as named views, queried with Spark SQL text."""
    t = load(spark, sf_dir)
    orders, lines = register({"orders": t["orders"], "lineitem": t["lineitem"]}, VIEW_PREFIX)
    # Distinct keys first: a hot order is one row per map task before the
    # shuffle (an existence join on the raw lines could not be split).
    return spark.sql(f"""
        SELECT trunc(CAST(o.o_orderdate AS DATE), 'month') AS period,
               count(*) AS orders,
               count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS fulfilled_orders,
               count(CASE WHEN l.l_orderkey IS NULL THEN 1 END) AS orders_without_lines
        FROM {orders} o
        LEFT JOIN (SELECT DISTINCT l_orderkey FROM {lines}) l ON l.l_orderkey = o.o_orderkey
        GROUP BY 1
    """)


@report("csv_raw_orders")
def csv_raw_orders(spark, sf_dir):
    """SRC-3: the raw orders exported as CSV, read back with a fixed schema.

    Values that do not parse become null and their line is kept in the
    corrupt-record column; ``malformed`` flags those lines.
    """
    path = export_csv(_raw(spark, sf_dir), scratch_path(spark, "raw_orders_csv"))
    df = load_csv(spark, path, "oid BIGINT, cid BIGINT, prio STRING, amt DECIMAL(12,2), dt DATE")
    return df.select("oid", "cid", "prio", "amt", "dt",
                     F.col("_corrupt_record").isNotNull().alias("malformed"))


@report("fact_month_slice")
def fact_month_slice(spark, sf_dir):
    """SNK-1: the fact written partitioned by month, read back for one year.

    ``read_clean`` filters the partition column as well as the date, so only
    12 month folders are read (``PartitionFilters`` in the plan).
    """
    path = scratch_path(spark, "sales_fact")
    written = write_clean(_sales(spark, sf_dir), path)
    return read_clean(spark, path, *FACT_SLICE, keep_partition_col=True, schema=written)


@report("fact_written_full")
def fact_written_full(spark, sf_dir):
    """SNK-1: the whole fact, written partitioned by month and read back."""
    path = scratch_path(spark, "sales_fact")
    written = write_clean(_sales(spark, sf_dir), path)
    return read_clean(spark, path, keep_partition_col=True, schema=written)


@report("published_region_sales")
def published_region_sales(spark, sf_dir):
    """SNK-2: a dashboard visual published as its own table, read back."""
    path = scratch_path(spark, "visuals")
    visual = kpi.breakdown(_sales(spark, sf_dir), ["region"])
    target, = publish({"sales_by_region": visual}, path)
    return spark.read.parquet(target)


# -- KPIs ----------------------------------------------------------------------

@report("kpi_totals")
def kpi_totals(spark, sf_dir):
    return kpi.kpis(_sales(spark, sf_dir))


@report("kpi_sliced")
def kpi_sliced(spark, sf_dir):
    s = KPI_SLICE
    # The date bound goes into the fact too, so it reaches the orders scan.
    fact = _sales(spark, sf_dir, start=s["start"], end=s["end"])
    return kpi.kpis(fact, **s)


# -- trends --------------------------------------------------------------------

@report("trend_daily")
def trend_daily(spark, sf_dir):
    return trd.trend(_sales(spark, sf_dir), "day")


@report("trend_monthly")
def trend_monthly(spark, sf_dir):
    return trd.trend(_sales(spark, sf_dir), "month")


@report("trend_monthly_complete")
def trend_monthly_complete(spark, sf_dir):
    t = trd.trend(_sales(spark, sf_dir), "month", complete_only=True)
    return trd.growth(trd.fill_calendar(t, "month"))


@report("trend_category_monthly")
def trend_category_monthly(spark, sf_dir):
    return trd.trend(_sales(spark, sf_dir), "month", by="category")


@report("trend_daily_filled")
def trend_daily_filled(spark, sf_dir):
    return trd.fill_calendar(trd.trend(_sales(spark, sf_dir), "day"), "day")


@report("trend_category_filled")
def trend_category_filled(spark, sf_dir):
    t = trd.trend(_sales(spark, sf_dir), "month", by="category")
    return trd.fill_calendar(t, "month", by="category")


@report("trend_growth")
def trend_growth(spark, sf_dir):
    t = trd.fill_calendar(trd.trend(_sales(spark, sf_dir), "month"), "month")
    return trd.growth(t)


@report("trend_ytd")
def trend_ytd(spark, sf_dir):
    return trd.ytd(trd.trend(_sales(spark, sf_dir), "month"))


@report("trend_moving_avg")
def trend_moving_avg(spark, sf_dir):
    t = trd.fill_calendar(trd.trend(_sales(spark, sf_dir), "month"), "month")
    return trd.moving_avg(t, MOVING_WINDOW)


# -- dashboard with slicers ------------------------------------------------------

@report("dashboard_sliced_trend")
def dashboard_sliced_trend(spark, sf_dir):
    return dashboard(spark, load(spark, sf_dir), materialize=False, **KPI_SLICE)["trend_monthly"]


@report("dashboard_sliced_breakdown")
def dashboard_sliced_breakdown(spark, sf_dir):
    return dashboard(spark, load(spark, sf_dir), materialize=False, start=KPI_SLICE["start"],
                     end=KPI_SLICE["end"])["category_region"]


# -- breakdowns ------------------------------------------------------------------

@report("breakdown_category")
def breakdown_category(spark, sf_dir):
    return kpi.breakdown(_sales(spark, sf_dir), ["category"])


@report("breakdown_region")
def breakdown_region(spark, sf_dir):
    return kpi.breakdown(_sales(spark, sf_dir), ["region"])


@report("breakdown_rollup")
def breakdown_rollup(spark, sf_dir):
    return kpi.breakdown(_sales(spark, sf_dir), ["category", "region"], totals=True)


@report("breakdown_top_categories")
def breakdown_top_categories(spark, sf_dir):
    cells = kpi.breakdown(_sales(spark, sf_dir), ["region", "category"])
    return kpi.top_k(cells.select("region", "category", "revenue"), TOP_K, within="region",
                     tie_cols=["category"])


# -- cohorts -------------------------------------------------------------------

@report("customer_cohorts")
def customer_cohorts(spark, sf_dir):
    return coh.assign_cohort(_orders(spark, sf_dir))


@report("cohort_sizes")
def cohort_sizes(spark, sf_dir):
    return coh.cohort_size(_orders(spark, sf_dir))


@report("cohort_long")
def cohort_long(spark, sf_dir):
    return coh.cohort_long(_orders(spark, sf_dir))


@report("cohort_dense")
def cohort_dense(spark, sf_dir):
    return coh.cohort_long(_orders(spark, sf_dir), dense=True)


@report("cohort_matrix")
def cohort_matrix(spark, sf_dir):
    return coh.cohort_matrix(_orders(spark, sf_dir))


@report("retention_curve")
def retention_curve(spark, sf_dir):
    return coh.retention_curve(_orders(spark, sf_dir))


@report("cohort_dense_complete")
def cohort_dense_complete(spark, sf_dir):
    return coh.cohort_long(_orders(spark, sf_dir), dense=True, complete_only=True)


@report("cohort_matrix_complete")
def cohort_matrix_complete(spark, sf_dir):
    return coh.cohort_matrix(_orders(spark, sf_dir), complete_only=True)


@report("retention_curve_complete")
def retention_curve_complete(spark, sf_dir):
    return coh.retention_curve(_orders(spark, sf_dir), complete_only=True)


@report("cohort_dense_sliced")
def cohort_dense_sliced(spark, sf_dir):
    """Cohorts of the customers of one region with one first category."""
    return coh.cohort_long(model.cohort_orders(load(spark, sf_dir), **COHORT_SLICE), dense=True)


@report("dashboard_sliced_retention")
def dashboard_sliced_retention(spark, sf_dir):
    return dashboard(spark, load(spark, sf_dir), materialize=False, max_cohort_index=0,
                     **COHORT_SLICE)["retention_curve"]


@report("repeat_rate")
def repeat_rate(spark, sf_dir):
    return coh.repeat_rate(_orders(spark, sf_dir))


@report("order_seq")
def order_seq(spark, sf_dir):
    return coh.order_seq(_orders(spark, sf_dir))


@report("order_seq_wide")
def order_seq_wide(spark, sf_dir):
    """COH-8 on all six columns of ``orders``."""
    return coh.order_seq(load(spark, sf_dir)["orders"], customer_col="o_custkey",
                         date_col="o_orderdate", order_col="o_orderkey")


@report("new_vs_returning")
def new_vs_returning(spark, sf_dir):
    return coh.new_vs_returning(_orders(spark, sf_dir))


@report("order_gaps")
def order_gaps(spark, sf_dir):
    return coh.order_gaps(_orders(spark, sf_dir))


# -- insights --------------------------------------------------------------------

@report("category_rank")
def category_rank(spark, sf_dir):
    return ins.rank_categories(_sales(spark, sf_dir), "category")


@report("customer_revenue_rank")
def customer_revenue_rank(spark, sf_dir):
    return ins.rank_categories(_sales(spark, sf_dir), "customer_id")


@report("customer_pareto")
def customer_pareto(spark, sf_dir):
    return ins.pareto(_sales(spark, sf_dir), "customer_id", PARETO_CUTOFF)


@report("pareto_category")
def pareto_category(spark, sf_dir):
    return ins.pareto(_sales(spark, sf_dir), "category", PARETO_CUTOFF)


@report("pareto_brand")
def pareto_brand(spark, sf_dir):
    return ins.pareto(_sales(spark, sf_dir), "subcategory", PARETO_CUTOFF)


@report("seasonality")
def seasonality(spark, sf_dir):
    return ins.seasonality(trd.trend(_sales(spark, sf_dir), "month"))


@report("sales_spikes")
def sales_spikes(spark, sf_dir):
    t = trd.fill_calendar(trd.trend(_sales(spark, sf_dir), "month"), "month")
    return ins.spikes(t, SPIKE_RATIO)


@report("seasonality_by_category")
def seasonality_by_category(spark, sf_dir):
    monthly = trd.trend(_sales(spark, sf_dir), "month", by="category")
    return ins.seasonality(monthly, by="category")


@report("seasonality_by_brand")
def seasonality_by_brand(spark, sf_dir):
    monthly = trd.trend(_sales(spark, sf_dir), "month", by="subcategory")
    return ins.seasonality(monthly, by="subcategory")


@report("spikes_by_category")
def spikes_by_category(spark, sf_dir):
    t = (trd.trend(_sales(spark, sf_dir), "month", by="category")
         .select("period", "category", "revenue"))
    filled = trd.fill_calendar(t, "month", by="category", zero_cols=("revenue",))
    return ins.spikes(filled, SPIKE_RATIO, by="category")


# -- cleaning and validation ------------------------------------------------------

def _raw(spark, sf_dir):
    return dirty.raw_orders(load(spark, sf_dir)["orders"])


@report("raw_orders")
def raw_orders(spark, sf_dir):
    return _raw(spark, sf_dir)


@report("clean_accepted")
def clean_accepted(spark, sf_dir):
    return cln.clean(_raw(spark, sf_dir), RAW_ORDER_RULES)[0]


@report("clean_rejected")
def clean_rejected(spark, sf_dir):
    return cln.clean(_raw(spark, sf_dir), RAW_ORDER_RULES)[1]


@report("clean_reject_reasons")
def clean_reject_reasons(spark, sf_dir):
    return cln.reject_counts(cln.clean(_raw(spark, sf_dir), RAW_ORDER_RULES)[1])


@report("dedup_exact")
def dedup_exact(spark, sf_dir):
    return cln.drop_exact_dups(_raw(spark, sf_dir))


@report("dedup_lines")
def dedup_lines(spark, sf_dir):
    li = load(spark, sf_dir)["lineitem"]
    return cln.dedup_by_key(li, list(LINE_KEYS), [("l_shipdate", "desc")])


@report("dedup_lines_mixed")
def dedup_lines_mixed(spark, sf_dir):
    li = load(spark, sf_dir)["lineitem"]
    return cln.dedup_by_key(li, list(LINE_KEYS), [("l_shipdate", "desc"), ("l_quantity", "asc")])


@report("split_first_reason")
def split_first_reason(spark, sf_dir):
    """CLN-9: both sides of the split, each row with the reason it was split by."""
    std = cln.standardised(_raw(spark, sf_dir), RAW_ORDER_RULES)
    accepted, rejected = cln.split(std, list(RAW_ORDER_RULES.checks))
    return accepted.withColumn(cln.REASON, F.lit("accepted")).unionByName(rejected)


@report("standardise_text")
def standardise_text(spark, sf_dir):
    return cln.standardise_text(_raw(spark, sf_dir), ["prio"])


@report("cast_safe")
def cast_safe(spark, sf_dir):
    return cln.cast_safe(_raw(spark, sf_dir), RAW_ORDER_RULES.casts)


@report("fill_nulls")
def fill_nulls(spark, sf_dir):
    std = cln.standardised(_raw(spark, sf_dir), RAW_ORDER_RULES)
    return cln.handle_nulls(std, fill={"prio": "UNSPECIFIED"})


@report("require_customer")
def require_customer(spark, sf_dir):
    std = cln.standardised(_raw(spark, sf_dir), RAW_ORDER_RULES)
    return cln.handle_nulls(std, require=["cid"])


@report("domain_violations")
def domain_violations(spark, sf_dir):
    return cln.check_domain(load(spark, sf_dir)["orders"], ORDER_DOMAIN)


@report("orders_without_lines")
def orders_without_lines(spark, sf_dir):
    t = load(spark, sf_dir)
    return cln.orphans(t["orders"], t["lineitem"], [("o_orderkey", "l_orderkey")])


@report("ship_before_order")
def ship_before_order(spark, sf_dir):
    t = load(spark, sf_dir)
    return cln.check_dates(t["lineitem"], t["orders"], [("l_orderkey", "o_orderkey")],
                           "l_shipdate", "o_orderdate")


@report("profile_orders")
def profile_orders(spark, sf_dir):
    return cln.profile(load(spark, sf_dir)["orders"], list(PROFILE_COLUMNS))


# -- joins in time -------------------------------------------------------------

def _timed_orders(spark, sf_dir):
    return load(spark, sf_dir)["orders"].select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"))


def _timed_events(spark, sf_dir):
    return load(spark, sf_dir)["events"].select(
        "event_id", F.col("user_id").alias("customer_id"), "event_type",
        (F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("event_at"))


@report("orders_after_event")
def orders_after_event(spark, sf_dir):
    """Interval join: orders within 7 days after an event of the customer."""
    days = F.expr(f"INTERVAL {AFTER_EVENT_DAYS} DAYS")
    spans = _timed_events(spark, sf_dir).withColumn("until", F.col("event_at") + days)
    return tmp.interval_join(_timed_orders(spark, sf_dir), spans, "customer_id", "ordered_at",
                             "event_at", "until", width_days=AFTER_EVENT_DAYS).drop("until")


@report("repeat_orders_30d")
def repeat_orders_30d(spark, sf_dir):
    """Interval join of orders with themselves: each order and the customer's
    orders in the 30 days after it."""
    orders = _timed_orders(spark, sf_dir)
    spans = orders.select("customer_id", F.col("order_id").alias("first_order_id"),
                          F.col("ordered_at").alias("first_at"),
                          (F.col("ordered_at") + F.expr(f"INTERVAL {REPEAT_DAYS} DAYS")).alias("until"))
    return tmp.interval_join(orders, spans, "customer_id", "ordered_at", "first_at", "until",
                             width_days=REPEAT_DAYS).drop("until")


@report("orders_last_event")
def orders_last_event(spark, sf_dir):
    """As-of join: every order with the customer's last event before it."""
    events = _timed_events(spark, sf_dir)
    return tmp.asof_join(_timed_orders(spark, sf_dir), events, "customer_id", "ordered_at",
                         "event_at", ["event_id", "event_type", "event_at"], order=["event_id"],
                         grain="hour")


@report("events_last_order")
def events_last_order(spark, sf_dir):
    """As-of join the other way: every event with the customer's last order,
    strictly before it."""
    events = _timed_events(spark, sf_dir)
    return tmp.asof_join(events, _timed_orders(spark, sf_dir), "customer_id", "event_at",
                         "ordered_at", ["order_id", "ordered_at"], order=["order_id"],
                         inclusive=False)


# -- streams -------------------------------------------------------------------

@report("stream_event_trend")
def stream_event_trend(spark, sf_dir):
    """Events arrive file by file, some late: closed hours by type, with the
    number of rows that came too late for them."""
    events = load(spark, sf_dir)["events"]
    replay = Replay(spark, events.schema, windowed_trend, "stream-trend")
    late = []
    for rows in arr.arrivals(spark, events):
        late.append(late_windows(rows, replay.watermark))
        replay.arrive(rows)
    counted = late[0]
    for more in late[1:]:
        counted = counted.unionByName(more)
    counted = counted.groupBy("period", "event_type").agg(F.sum("late_events").alias("late_events"))
    return (join_null_safe(replay.table(), counted, ["period", "event_type"], "left")
            .withColumn("late_events", F.coalesce("late_events", F.lit(0))))


@report("stream_sessions")
def stream_sessions(spark, sf_dir):
    """Sessions of users from the same arrivals: state with timers."""
    events = load(spark, sf_dir)["events"]
    replay = Replay(spark, events.schema, sessions, "stream-sessions")
    for rows in arr.arrivals(spark, events):
        replay.arrive(rows)
    return replay.table()


# -- mergeable sketches --------------------------------------------------------

@report("customers_by_month_sketched")
def customers_by_month_sketched(spark, sf_dir):
    """Distinct customers from daily states, merged to months: the exact count and
    whether the estimate is within 5 % of it (three standard errors), or one."""
    orders = _orders(spark, sf_dir).where("customer_id IS NOT NULL AND order_date IS NOT NULL")
    path = scratch_path(spark, "customer_states")
    month = F.trunc("order_date", "month").alias("period")
    sk.distinct_states(orders, "order_date", "customer_id").write.parquet(path)
    merged = sk.merge_distinct(spark.read.parquet(path).select(month, "state"), "period")
    exact = orders.groupBy(month).agg(F.count_distinct("customer_id").alias("customers"))
    return (sk.distinct_estimate(merged, "estimate").join(exact, "period")
            .select("period", "customers",
                    (F.abs(F.col("estimate") - F.col("customers"))
                     <= F.greatest(F.lit(1), 0.05 * F.col("customers"))).alias("within_bound")))


@report("order_value_quantiles_sketched")
def order_value_quantiles_sketched(spark, sf_dir):
    """Median and 95 % order value from monthly states, merged to years: whether
    the ranks of both are within 2 % of what they should be."""
    orders = (load(spark, sf_dir)["orders"].where("o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL")
              .select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period"),
                      F.col("o_totalprice").alias("amount")))
    path = scratch_path(spark, "value_states")
    sk.quantile_states(orders, "period", "amount").write.parquet(path)
    year = F.year("period").alias("year")
    merged = sk.merge_quantiles(spark.read.parquet(path).select(year, "state"), "year")
    values = sk.quantiles(merged, {"q50": 0.5, "q95": 0.95})

    def near(col, share):
        # The rank is a range where values repeat.
        low = F.count(F.when(F.col("amount") < F.col(col), 1)) / F.count(F.lit(1))
        high = F.count(F.when(F.col("amount") <= F.col(col), 1)) / F.count(F.lit(1))
        return (low - 0.02 <= share) & (high + 0.02 >= share)

    return (orders.select(year, "amount").join(values, "year").groupBy("year")
            .agg(F.count(F.lit(1)).alias("orders"), near("q50", 0.5).alias("median_within_bound"),
                 near("q95", 0.95).alias("p95_within_bound")))


# -- bag operations ------------------------------------------------------------

def _typed_raw(spark, sf_dir):
    text = cln.standardise_text(_raw(spark, sf_dir), list(RAW_ORDER_RULES.text))
    return cln.cast_safe(text, RAW_ORDER_RULES.casts)


def _accepted(spark, sf_dir):
    return cln.clean(_raw(spark, sf_dir), RAW_ORDER_RULES)[0]


@report("raw_minus_clean")
def raw_minus_clean(spark, sf_dir):
    """The raw rows that cleaning took away, copies counted."""
    return rec.bag_except(_typed_raw(spark, sf_dir), _accepted(spark, sf_dir))


@report("raw_and_clean")
def raw_and_clean(spark, sf_dir):
    """The rows that are in both, copies counted."""
    return rec.bag_intersect(_typed_raw(spark, sf_dir), _accepted(spark, sf_dir))


@report("raw_clean_reconciled")
def raw_clean_reconciled(spark, sf_dir):
    return rec.reconcile(_typed_raw(spark, sf_dir), _accepted(spark, sf_dir))


# -- semi-structured values ----------------------------------------------------

def _raw_events(spark, sf_dir):
    return dirty.raw_events(load(spark, sf_dir)["events"])


@report("event_props_typed")
def event_props_typed(spark, sf_dir):
    """The properties of events as typed columns; broken documents are quarantined."""
    good, bad = semi.parse_json(_raw_events(spark, sf_dir), "props",
                                {"k": "bigint", "source": "string"})
    return (good.withColumn("props", F.lit(None).cast("string"))
            .withColumn("reject_reason", F.lit(None).cast("string"))
            .unionByName(bad, allowMissingColumns=True))


@report("event_props_keys")
def event_props_keys(spark, sf_dir):
    return semi.key_profile(_raw_events(spark, sf_dir), "props")


# -- incremental fact ----------------------------------------------------------

def _two_batches(spark, sf_dir):
    """The fact loaded in two batches, of which the second holds every seventh order
    of 1998, and the first batch once more."""
    fact = _sales(spark, sf_dir)
    late = (F.year("order_date") == 1998) & (F.col("order_id") % 7 == 0)
    store = FactStore(spark, scratch_path(spark, "fact_store"), fact.schema)
    first = fact.where(~late)
    store.add(first, "first")
    store.add(fact.where(late), "late")
    store.add(first, "first")
    return store


@report("fact_two_batches")
def fact_two_batches(spark, sf_dir):
    """The whole fact, read back after an incremental load."""
    return _two_batches(spark, sf_dir).read()


@report("fact_batch_history")
def fact_batch_history(spark, sf_dir):
    """Which batch wrote how many months."""
    return history(_two_batches(spark, sf_dir))


# -- bucketed fact -------------------------------------------------------------

@report("fact_bucketed")
def fact_bucketed(spark, sf_dir):
    """The whole fact from lines and orders that are stored bucketed on the order:
    the join has no shuffle."""
    t = load(spark, sf_dir)
    spread = ["l_linenumber", "l_suppkey", "l_shipdate"]
    stored = ["order_id", "revenue", "category", "subcategory"]
    store = BucketedFact(spark, model.product_lines(t, *spread), model.region_orders(t),
                         spread, stored=stored)
    return store.joined().select(*model.SALES_COLUMNS)
