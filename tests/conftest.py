import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="ledgerline-tests")
    yield s
    s.stop()


def D(s):
    return dt.date.fromisoformat(s)


def M(x):
    return Decimal(str(x))


def rows(df, *cols):
    """Collect ``cols`` (default all) as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


SALES_DDL = ("order_id BIGINT, customer_id BIGINT, order_date DATE, category STRING, "
             "subcategory STRING, region STRING, revenue DECIMAL(18,4)")
ORDERS_DDL = "order_id BIGINT, customer_id BIGINT, order_date DATE"


@pytest.fixture
def make_sales(spark):
    def make(data):
        return spark.createDataFrame(
            [(o, c, D(d), cat, sub, reg, M(r)) for o, c, d, cat, sub, reg, r in data], SALES_DDL)
    return make


@pytest.fixture
def make_orders(spark):
    def make(data):
        return spark.createDataFrame([(o, c, D(d) if d else None) for o, c, d in data], ORDERS_DDL)
    return make
