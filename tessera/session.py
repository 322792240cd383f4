"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session gets.  AQE stays on so that join strategy, partition
# coalescing and skew splitting are decided on runtime sizes.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system).
    Only a local-mode session without the setting gets a private folder, as
    in tests.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: what is read several times is
    worked out once, outlives executors and keeps nothing in their memory."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def for_fit(df: DataFrame, name: str) -> DataFrame:
    """``saved``, in at most as many partitions as the session has cores.  An iterative fit runs hundreds
    of jobs over its rows, and each partition shuffles its sums and sends a task's result in every
    one of them: these follow the cores then, not the rows.  More partitions are not put together, some
    two and some alone, but dealt out evenly, as every job waits for the largest."""
    cores, rows = max(1, df.sparkSession.sparkContext.defaultParallelism), saved(df, name)
    if rows.rdd.getNumPartitions() > cores:
        rows = saved(rows.repartition(cores), name)
    return rows.coalesce(cores)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
