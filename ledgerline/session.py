"""Spark session helpers.

On a cluster the session is created by the platform and already carries the
shuffle, memory and checkpoint settings; ``tune`` only fills in what is
missing.  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (so a
# broadcast only happens below a measured threshold), splits skewed shuffle
# partitions of sort-merge joins, and coalesces small shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle:
    # the fact's last join is on order_id and the per-order aggregates after
    # it rely on that partitioning, so without this AQE would leave a hot
    # order in one task.  The extra shuffle comes after map-side partial
    # aggregation and is small.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # AQE merges shuffle partitions up to this size (64 MB by default) as long
    # as every core still has one.  A task that joins the fact on its order and
    # counts orders by group holds 20 to 35 times the compressed bytes it reads
    # (sort buffers and a hash entry per order and group), so 64 MB are over 2 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
# No time zone is set: every operator works on dates and TIMESTAMP_NTZ
# values, which do not depend on the session time zone.


def set_defaults(spark: SparkSession) -> None:
    """Apply the defaults above where the session has no value of its own."""
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def tune(spark: SparkSession) -> SparkSession:
    """``set_defaults``, and a checkpoint folder."""
    set_defaults(spark)
    try:
        ensure_checkpoint_dir(spark)
    except RuntimeError:
        pass        # only needed by checkpointing and scratch tables, which will say so
    return spark


def _spark_context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect client (which has none)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _is_local(master: str) -> bool:
    """True for one-JVM masters; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only an unconfigured ``local`` session (tests) gets a fresh
    machine-local folder; any other session without the setting gets an
    error, since its executors do not share the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _spark_context(spark)
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench (UI off, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for an intermediate table, under the reliable checkpoint
    folder (a shared location on a cluster).  It belongs to the caller, who
    removes it with ``drop_scratch`` when the table is no longer read."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` returned (no other folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/ledgerline/"
    if not path.startswith(base) or len(path) <= len(base) or ".." in path:
        raise ValueError(f"not a scratch folder: {path}")
    sc = _spark_context(spark)
    if sc is None:
        raise RuntimeError("scratch folders are removed by a classic session")
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
