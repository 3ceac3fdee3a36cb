"""Every report on tables with nulls in keys, dates and attributes, and on
empty tables.

The sf0.001 tables are copied with every n-th value of selected columns set
to null; Spark and DuckDB must still agree row for row.
"""

import os

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL

from ledgerline import reports, sql_checks
from tools.oracle_check import compare, duck

NULLED = {
    "orders": {"o_custkey": 41, "o_orderdate": 37, "o_orderpriority": 29, "o_totalprice": 31},
    "lineitem": {"l_partkey": 43, "l_discount": 47, "l_shipdate": 53, "l_extendedprice": 59},
    "customer": {"c_nationkey": 23},
    "part": {"p_type": 19, "p_brand": 17},
    "events": {"ts": 41, "user_id": 37, "event_type": 29, "value": 31},
}


@pytest.fixture(scope="module")
def null_dir(tmp_path_factory):
    out = str(tmp_path_factory.mktemp("nulls"))
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        t = pq.read_table(os.path.join(SF_SMALL, f"{name}.parquet"))
        for col, every in NULLED.get(name, {}).items():
            idx = pa.array(range(t.num_rows))
            keep = pc.not_equal(pc.subtract(idx, pc.multiply(pc.divide(idx, every), every)), 0)
            t = t.set_column(t.schema.get_field_index(col), col,
                             pc.if_else(keep, t[col], pa.nulls(t.num_rows, t[col].type)))
            assert t[col].null_count == (t.num_rows + every - 1) // every
        pq.write_table(t, os.path.join(out, f"{name}.parquet"))
    return out


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_report_with_nulls(spark, null_dir, name):
    con = duck(null_dir)
    df = reports.REPORTS[name](spark, null_dir)
    res = con.execute(sql_checks.sql_for(name, df.columns))
    status, msg = compare([tuple(r) for r in df.collect()], df.columns,
                          res.fetchall(), [c[0] for c in res.description])
    assert status == "exact", msg


@pytest.fixture(scope="module")
def empty_dir(tmp_path_factory):
    out = str(tmp_path_factory.mktemp("empty"))
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        t = pq.read_table(os.path.join(SF_SMALL, f"{name}.parquet"))
        pq.write_table(t.slice(0, 0), os.path.join(out, f"{name}.parquet"))
    return out


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_report_on_empty_tables(spark, empty_dir, name):
    con = duck(empty_dir)
    df = reports.REPORTS[name](spark, empty_dir)
    res = con.execute(sql_checks.sql_for(name, df.columns))
    status, msg = compare([tuple(r) for r in df.collect()], df.columns,
                          res.fetchall(), [c[0] for c in res.description])
    assert status == "exact", msg
