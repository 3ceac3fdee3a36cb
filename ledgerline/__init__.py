"""ledgerline: retail sales analytics (cleaning, KPIs, trends, breakdowns,
cohorts, insights) as plain Spark DataFrame functions.

    import ledgerline as ll
    t = ll.load(spark, "/path/to/tables")
    ll.kpis(ll.sales(t))
"""

from .dashboard import dashboard, materialized_sales
from .operators.clean import (CleanRules, DomainRule, cast_safe, check_dates, check_domain,
                              clean, dedup_by_key, drop_exact_dups, handle_nulls, orphans,
                              profile, reject_counts, split, standardise_text)
from .operators.cohort import (assign_cohort, cohort_long, cohort_matrix, cohort_size,
                               new_vs_returning, order_gaps, order_seq, repeat_rate,
                               retention_curve)
from .operators.insight import pareto, rank_categories, seasonality, spikes
from .operators.kpi import breakdown, kpis, slice_sales, top_k
from .operators.trend import fill_calendar, growth, moving_avg, trend, ytd
from .plans.sales import order_grain, orders, sales
from .session import local_session, tune
from .sources import (export_csv, load, load_csv, publish, read_clean, register,
                      write_clean)

__version__ = "0.1.0"
