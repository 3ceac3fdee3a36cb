"""Hot keys: one part and one order each hold a third of all lines, one
customer a third of all orders.  Skew thresholds are lowered so AQE really
splits join partitions; results must still equal DuckDB on the same files.
"""

import datetime as dt
import os
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerline import reports, sql_checks
from tools.oracle_check import compare, duck

NAMES = sorted(reports.REPORTS)


def _write(tmp, name, cols):
    # Small row groups: each becomes its own input split, so the shuffles
    # have many map tasks and AQE can split a skewed partition between them.
    pq.write_table(pa.table(cols), os.path.join(tmp, f"{name}.parquet"), row_group_size=200)


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    tmp = str(tmp_path_factory.mktemp("skewed"))
    rnd = random.Random(11)
    _write(tmp, "region", {"r_regionkey": pa.array(range(5), pa.int32()),
                           "r_name": [f"R{i}" for i in range(5)]})
    _write(tmp, "nation", {"n_nationkey": pa.array(range(25), pa.int32()),
                           "n_name": [f"N{i}" for i in range(25)],
                           "n_regionkey": pa.array([i % 5 for i in range(25)], pa.int32())})
    _write(tmp, "customer", {"c_custkey": pa.array(range(60), pa.int64()),
                             "c_name": [f"C{i}" for i in range(60)],
                             "c_nationkey": pa.array([i % 25 for i in range(60)], pa.int32()),
                             "c_acctbal": [1.0] * 60, "c_mktsegment": ["S"] * 60})
    _write(tmp, "part", {"p_partkey": pa.array(range(40), pa.int64()),
                         "p_name": [f"P{i}" for i in range(40)],
                         "p_brand": [f"B{i % 9}" for i in range(40)],
                         "p_type": [f"T{i % 4}" for i in range(40)],
                         "p_size": pa.array([1] * 40, pa.int32()), "p_retailprice": [1.0] * 40})
    n_orders = 600
    cust = [7 if i % 3 == 0 else rnd.randrange(60) for i in range(n_orders)]
    odate = [dt.datetime(2019, 1, 1) + dt.timedelta(days=rnd.randrange(700)) for _ in range(n_orders)]
    _write(tmp, "orders", {"o_orderkey": pa.array(range(n_orders), pa.int64()),
                           "o_custkey": pa.array(cust, pa.int64()),
                           "o_orderstatus": ["F"] * n_orders, "o_totalprice": [10.0] * n_orders,
                           "o_orderdate": pa.array(odate, pa.timestamp("us")),
                           "o_orderpriority": ["1-URGENT"] * n_orders})
    n_events = 900
    seen = [dt.datetime(2043, 1, 1) + dt.timedelta(minutes=rnd.randrange(700 * 1440))
            for _ in range(n_events)]
    _write(tmp, "events", {
        "event_id": pa.array(range(n_events), pa.int64()), "ts": pa.array(seen, pa.timestamp("us")),
        "user_id": pa.array([7 if i % 3 == 0 else rnd.randrange(60) for i in range(n_events)],
                            pa.int64()),
        "event_type": [f"E{i % 4}" for i in range(n_events)], "value": [0.25 * i for i in range(n_events)],
        "props": ['{"k": %d}' % (i % 5) for i in range(n_events)]})
    n_lines = 4500
    okey = [11 if i % 3 == 0 else rnd.randrange(n_orders) for i in range(n_lines)]
    pkey = [5 if i % 3 == 1 else rnd.randrange(40) for i in range(n_lines)]
    lnum = [rnd.randrange(1, 8) for _ in range(n_lines)]
    _write(tmp, "lineitem", {
        "l_orderkey": pa.array(okey, pa.int64()), "l_partkey": pa.array(pkey, pa.int64()),
        "l_suppkey": pa.array([1] * n_lines, pa.int64()), "l_linenumber": pa.array(lnum, pa.int32()),
        "l_quantity": [1.0] * n_lines,
        "l_extendedprice": [round(rnd.uniform(1, 9999), 2) for _ in range(n_lines)],
        "l_discount": [rnd.choice([0.0, 0.05, 0.1]) for _ in range(n_lines)],
        "l_tax": [0.0] * n_lines, "l_returnflag": ["N"] * n_lines, "l_linestatus": ["O"] * n_lines,
        "l_shipdate": pa.array([odate[k] + dt.timedelta(days=rnd.randrange(-5, 30)) for k in okey],
                               pa.timestamp("us"))})
    return tmp


@pytest.fixture
def skewy(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.files.maxPartitionBytes": "2k",
            "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_exact_with_hot_keys(skewy, skewed_dir, name):
    con = duck(skewed_dir)
    df = reports.REPORTS[name](skewy, skewed_dir)
    res = con.execute(sql_checks.sql_for(name, df.columns))
    status, msg = compare([tuple(r) for r in df.collect()], df.columns,
                          res.fetchall(), [c[0] for c in res.description])
    assert status == "exact", msg


def test_aqe_really_splits_the_hot_keys(skewy, skewed_dir):
    df = reports.REPORTS["kpi_totals"](skewy, skewed_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"AQEShuffleRead[^\n]*skewed", plan), "no skew join split in the final plan"
