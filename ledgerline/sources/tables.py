"""SRC-1 / SRC-2: read the retail tables and expose them to SQL by name."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed schemas of the retail tables this library reads (DDL strings).
SCHEMAS: dict[str, str] = {
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
               "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                 "c_mktsegment STRING"),
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
}


@functools.lru_cache(maxsize=None)
def schema(name: str) -> StructType:
    """The fixed schema of ``name`` (parsed once; ``StructType`` is immutable)."""
    return StructType.fromDDL(SCHEMAS[name])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table (``<sf_dir>/<name>.parquet``) with its fixed schema."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(schema(name))
    return reader.parquet(path)


class Tables(Mapping[str, DataFrame]):
    """Lazily read tables of one data folder; each is read at most once."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._names = tuple(names) if names else tuple(SCHEMAS)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def load(spark: SparkSession, sf_dir: str, names=None) -> Tables:
    """SRC-1: the retail tables of ``sf_dir``, read on first use."""
    return Tables(spark, sf_dir, names)


def register(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """SRC-2: expose each DataFrame to ``spark.sql`` as a temp view.

    The view's name is ``prefix`` and the table's key; a view of that name is
    replaced, so give a prefix where the session has views of its own.
    Returns the names.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in tables]
