"""Point-in-time (as-of) joins with a time-to-live.

Spark has no as-of join operator.  A per-key window over the union of both
sides would put a hot key in one task, so the time axis is cut into buckets:

1. inside each (key, bucket) a running ``last(feature, ignorenulls)`` over the
   union (feature rows sort before entity rows at equal time) gives the local
   answer;
2. the latest feature row of every earlier bucket is carried forward over the
   small (key, bucket) table (one row per key and bucket, not per event);
3. local answer, else carried answer; then the TTL bound
   ``feature_ts >= entity_ts - ttl`` (inclusive) is applied.

Exact for every bucket width; the width only sets how a hot key is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.windows import epoch_us


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              features: Sequence[str], ttl_seconds: float | None = None, created_col: str | None = None,
              strict: bool = False, bucket_seconds: int = 86_400, prefix: str = "",
              ts_alias: str | None = None) -> DataFrame:
    """Left rows with the latest right row (per key) at or before their time.

    ``strict=True`` uses only strictly earlier right rows (training sets that
    must not see the current event).  Ties on right time go to the larger
    ``created_col``, then to the larger feature row, for every bucket width.  Feature columns are named ``prefix + name``; the matched
    right time is ``ts_alias`` (default ``prefix + 'feature_ts'``).
    """
    keys = list(keys)
    b_us = bucket_seconds * 1_000_000
    ts_alias = ts_alias or f"{prefix}feature_ts"
    lcols = left.columns
    created = F.col(created_col) if created_col else F.lit(None).cast("timestamp_ntz")
    feat = F.struct(F.col(right_ts).alias("_fts"), created.alias("_fct"),
                    *[F.col(f).alias(f) for f in features])
    r = right.select(*[F.col(k) for k in keys], epoch_us(right_ts).alias("_us"),
                     F.coalesce(epoch_us(created), F.lit(0)).alias("_c"), feat.alias("_r")) \
        .where(F.col("_us").isNotNull())
    for k in keys:  # a null key matches nothing
        r = r.where(F.col(k).isNotNull())
    r = r.withColumn("_bk", F.floor(F.col("_us") / b_us)).withColumn("_side", F.lit(0 if not strict else 1))
    l_ = left.select(*[F.col(k) for k in keys], epoch_us(left_ts).alias("_us"), F.lit(0).cast("long").alias("_c"),
                     F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    l_ = l_.withColumn("_bk", F.floor(F.col("_us") / b_us)).withColumn("_side", F.lit(1 if not strict else 0))

    both = (r.withColumn("_l", F.lit(None).cast(l_.schema["_l"].dataType))
            .unionByName(l_.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))))
    w = (Window.partitionBy(*keys, "_bk").orderBy("_us", "_side", "_c", "_r")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = both.withColumn("_loc", F.last("_r", ignorenulls=True).over(w)).where(F.col("_l").isNotNull())

    # latest right row per (key, bucket), carried to later buckets
    last_in_bucket = r.groupBy(*keys, "_bk").agg(F.max(F.struct("_us", "_c", "_r")).alias("_m"))
    left_buckets = l_.select(*keys, "_bk").distinct().withColumn(
        "_m", F.lit(None).cast(last_in_bucket.schema["_m"].dataType))
    grid = last_in_bucket.unionByName(left_buckets).groupBy(*keys, "_bk").agg(F.max("_m").alias("_m"))
    cw = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.withColumn("_prev", F.last("_m", ignorenulls=True).over(cw)) \
        .select(*keys, "_bk", F.col("_prev._r").alias("_prev"))

    j = local.join(carried, [*keys, "_bk"], "left")
    hit = F.coalesce(F.col("_loc"), F.col("_prev"))
    j = j.withColumn("_hit", hit)
    if ttl_seconds is not None:
        fresh = epoch_us(F.col("_hit._fts")) >= F.col("_us") - F.lit(int(ttl_seconds * 1_000_000))
        j = j.withColumn("_hit", F.when(fresh, F.col("_hit")))
    return j.select(*[F.col(f"_l.{c}").alias(c) for c in lcols],
                    F.col("_hit._fts").alias(ts_alias),
                    *[F.col(f"_hit.{f}").alias(prefix + f) for f in features])
