"""Lines and orders stored bucketed on their order, so that joining them needs
no shuffle.

The shuffle that a join makes is paid once, when the tables are written.  As a
join without a shuffle leaves nothing for AQE to split, a hot order is split in
the layout: an order with more than ``most`` lines gets a share for every
``most`` of them, its lines are dealt to the shares by a hash, the order itself
is stored once a share, and both tables are bucketed on (order, share).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path

SHARE = "_share"
#: Lines of one share of an order.
MOST = 1_000_000


class BucketedFact:
    """``lines`` and ``orders`` in tables of their own, bucketed on ``key``.

    ``spread`` names columns of ``lines`` by which the lines of a hot order are
    dealt; they are stored only if ``stored`` (default: all others) names them.
    Lines and orders without a key join nothing and are left out.  About
    256 MB a bucket is a good size: the default number is the session's number
    of shuffle partitions.  The tables are external ones in the scratch folder,
    known to the catalog until ``close`` removes both.
    """

    def __init__(self, spark: SparkSession, lines: DataFrame, orders: DataFrame,
                 spread: list[str], key: str = "order_id", buckets: int | None = None,
                 most: int = MOST, stored: list[str] | None = None):
        self.spark, self.key = spark, key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = scratch_path(spark, "bucketed")
        name = f"ledgerline_{uuid.uuid4().hex}"
        self.names = {"lines": f"{name}_lines", "orders": f"{name}_orders"}
        stored = stored or [c for c in lines.columns if c not in spread or c == key]
        lines, orders = (df.where(F.col(key).isNotNull()) for df in (lines, orders))

        # At most one row for ``most`` lines.  Written, so that Spark knows its size
        # when it chooses how to join it.
        shares = F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_shares")
        hot = lines.groupBy(key).agg(shares).where("_shares > 1")
        hot.write.parquet(f"{self.path}/hot")
        hot = spark.read.schema(hot.schema).parquet(f"{self.path}/hot")

        n = F.coalesce("_shares", F.lit(1))
        own = F.pmod(F.xxhash64(*spread), n).cast("int").alias(SHARE)
        self._write("lines", lines.join(hot, key, "left").select(*stored, own))
        each = F.explode(F.sequence(F.lit(0), n - 1)).alias(SHARE)
        self._write("orders", orders.join(hot, key, "left").select(*orders.columns, each))

    def _write(self, which: str, df: DataFrame) -> None:
        # Tasks and buckets are cut by the same hash: one file a bucket.
        (df.repartition(self.buckets, self.key, SHARE).write.format("parquet")
         .option("path", f"{self.path}/{which}")
         .bucketBy(self.buckets, self.key, SHARE).sortBy(self.key, SHARE)
         .saveAsTable(self.names[which]))

    def table(self, which: str) -> DataFrame:
        return self.spark.table(self.names[which])

    def joined(self) -> DataFrame:
        """Every line with its order; the plan has no shuffle."""
        return self.table("lines").join(self.table("orders"), [self.key, SHARE]).drop(SHARE)

    def close(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_scratch(self.spark, self.path)
