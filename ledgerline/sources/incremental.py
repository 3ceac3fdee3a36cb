"""An incremental fact: late rows rewrite only the months they touch.

A store is a folder with ``data`` (one folder per month and version) and
``manifest`` (a small table of commits).  A commit writes the new versions of
the touched months first and then adds one file of the manifest; readers see the
months of the last manifest version, so a write that is killed before leaves the
old state, and files of untouched months are not written again.  A batch has a
name: repeating a batch that is committed does nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version LONG, batch STRING, month DATE, folder STRING"


class FactStore:
    """A fact partitioned by the month of ``date_col``, of rows with ``schema``;
    a commit replaces the rows of the ``key`` values that it brings."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "order_id",
                 date_col: str = "order_date"):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.date_col = key, date_col
        if not self._exists():
            self._commit(0, [("", None, "")])

    def _exists(self) -> bool:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        return folder.getFileSystem(sc._jsc.hadoopConfiguration()).exists(folder)

    def _commit(self, version: int, rows) -> None:
        table = self.spark.createDataFrame([(version, *r) for r in rows], MANIFEST)
        table.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def _state(self):
        """(version, batches, {month: folder}): a row per month and batch."""
        rows = self.manifest().collect()
        version = max(r.version for r in rows)
        return (version, {r.batch for r in rows},
                {r.month: r.folder for r in rows if r.version == version and r.month})

    def _read(self, folders) -> DataFrame:
        folders = sorted(folders)
        reader = self.spark.read.schema(self.schema)
        return (reader.parquet(*folders) if folders
                else self.spark.createDataFrame([], self.schema))

    def read(self, start=None, end=None) -> DataFrame:
        """The rows of ``start <= date < end``; only the folders of months in that
        range are read."""
        months = self._state()[2]
        kept = [f for m, f in months.items()
                if (start is None or m >= start.replace(day=1)) and (end is None or m < end)]
        df = self._read(kept)
        if start is not None:
            df = df.where(F.col(self.date_col) >= F.lit(start))
        if end is not None:
            df = df.where(F.col(self.date_col) < F.lit(end))
        return df

    def add(self, rows: DataFrame, batch: str) -> list:
        """Commit ``rows`` as ``batch``; returns the months written.

        Rows of the touched months whose ``key`` the batch brings are replaced, all
        others of these months are written again beside the new ones.  Rows
        without a date have no month and are left out.
        """
        version, batches, months = self._state()
        if not batch or batch in batches:
            return []
        new = rows.select(*self.schema.names).where(F.col(self.date_col).isNotNull())
        month = F.trunc(F.col(self.date_col), "month")
        # As many rows as the calendar has months.
        touched = sorted(r.m for r in new.select(month.alias("m")).distinct().collect())
        old = self._read(months[m] for m in touched if m in months)
        brought = new.select(self.key).distinct()
        merged = old.join(brought, self.key, "left_anti").select(*self.schema.names).union(new)
        place = f"{self.path}/data/{version + 1}-{uuid.uuid4().hex}"
        (merged.withColumn("_month", month).hint("rebalance", "_month")
         .write.mode("overwrite").partitionBy("_month").parquet(place))
        months |= {m: f"{place}/_month={m.isoformat()}" for m in touched}
        self._commit(version + 1, [(batch, m, f) for m, f in months.items()] or [(batch, None, "")])
        return touched


def history(store: FactStore) -> DataFrame:
    """version, batch, months_written of every commit."""
    before = Window.partitionBy("month").orderBy("version")
    changed = F.col("folder") != F.coalesce(F.lag("folder").over(before), F.lit(""))
    return (store.manifest().where("version > 0").withColumn("new", changed & F.col("month").isNotNull())
            .groupBy("version", "batch").agg(F.sum(F.col("new").cast("long")).alias("months_written")))
