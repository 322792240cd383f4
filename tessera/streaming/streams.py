"""Structured Streaming: keyed upserts into a versioned snapshot, sliding-window
velocities, incremental materialisation with a checkpoint (``state`` holds the
operators with keyed state).

Sinks write one delta per micro-batch under a shared folder (``v=<batch id>``):
the newest row of each key the batch touched, so a batch costs what it brings and
not the size of the snapshot.  A batch re-run after a failure overwrites its own
delta, so the sink is idempotent; readers merge the complete ones, last write wins.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.online import latest_per_key


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def data_files(spark: SparkSession, path: str) -> set[str]:
    """The part files below ``path``; their names sort by the task that wrote them."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return set()
    names = (str(x.getPath()) for x in fs.listStatus(p))
    return {x for x in names if x.rsplit("/", 1)[-1].startswith("part-")}


def set_arrival_order(spark: SparkSession, files: Sequence[str]) -> None:
    """Give ``files`` rising modification times, a second apart: a file source reads
    the oldest first.  Needs a file system that keeps such times (local, HDFS)."""
    now = int(time.time() * 1000)
    for i, f in enumerate(files):
        fs, p = _fs(spark, f)
        fs.setTimes(p, now + 1000 * (i - len(files)), -1)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions under ``root`` (directories ``v=<n>`` holding _SUCCESS)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def read_snapshot(spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str],
                  schema: T.StructType) -> DataFrame:
    """The newest row per key over all complete deltas (a combinable aggregate)."""
    vs = versions(spark, root)
    if not vs:
        return spark.createDataFrame([], schema)
    deltas = spark.read.schema(schema).parquet(*[f"{root}/v={v}" for v in vs])
    return latest_per_key(deltas, keys, order, schema.fieldNames()).select(*schema.fieldNames())


def upsert_sink(root: str, keys: Sequence[str], order: Sequence[str], schema: T.StructType):
    """foreachBatch function: the batch's newest row per key, as the delta of its id."""
    cols = schema.fieldNames()

    def run(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch.select(*cols), keys, order, cols).select(*cols) \
            .write.mode("overwrite").parquet(f"{root}/v={batch_id}")

    return run


def run_available_now(stream: DataFrame, sink, checkpoint: str, output_mode: str = "append") -> None:
    """Process everything available, in as many micro-batches as the source
    allows, then stop (restartable from ``checkpoint``)."""
    q = (stream.writeStream.foreachBatch(sink).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def sliding_counts(stream: DataFrame, key: str, ts: str, width: str, slide: str, watermark: str) -> DataFrame:
    """Events per key per sliding event-time window; late rows beyond the
    watermark are dropped and their windows' state is released.  The events are dealt by key
    before each becomes a row a window: a task holds its own keys' windows, not a file's."""
    return (stream.select(key, ts).repartition(key).withWatermark(ts, watermark)
            .groupBy(key, F.window(ts, width, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events"))


def append_sink(root: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")
    return run
