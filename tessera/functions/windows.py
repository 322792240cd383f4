"""Trailing event-time sums that survive hot keys, in linear work.

``Window.partitionBy(user).orderBy(ts).rangeBetween(-w, -1)`` sends every event
of one user to one task, and Spark evaluates a sliding frame from scratch for
each row.  Here an event adds its value at its time and takes it off when it
leaves the window, so that a trailing sum is a running sum; each key is cut into
time buckets, and the sum of earlier buckets enters a bucket as one more row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000


def epoch_us(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def trailing_sums(df: DataFrame, keys: Sequence[str], ts_col: str,
                  sums: dict[str, tuple[int, Column]], include_current: bool = False,
                  bucket_seconds: int = 86_400) -> DataFrame:
    """``df`` with one column per ``sums`` entry (name: window in seconds, value):
    the sum of the value over events of the same key with ``ts - w <= t < ts``
    (``include_current``: ``t <= ts``), 0 for none; null values count as 0.

    Values are longs or decimals: they are added and taken off again, which in
    floating point would leave a rest.  A null key is a key like any other; a row
    without a time has sums 0.  The bucket width only sets how a hot key is split.
    """
    keys, b_us = list(keys), int(bucket_seconds * US_PER_SECOND)
    widths = sorted({s for s, _ in sums.values()})
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     epoch_us(ts_col).alias("_us"), F.struct(*df.columns).alias("_row"),
                     *[F.coalesce(v, F.lit(0)).alias(f"_v{j}")
                       for j, (_, v) in enumerate(sums.values())])
    # copy 0 adds at the event's time, copy i takes off at the end of window i
    ends = [F.lit(0).cast("long")] + [
        F.lit(int(w * US_PER_SECOND) + int(include_current)) for w in widths]
    moved = rows.withColumn("_m", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), e.alias("by")) for i, e in enumerate(ends)])))
    ks = [f"_k{i}" for i in range(len(keys))]
    vs = [f"_v{j}" for j in range(len(sums))]
    change = [F.when(F.col("_m.i") == 0, F.col(v))
              .when(F.col("_m.i") == 1 + widths.index(s), -F.col(v)).otherwise(F.col(v) * 0).alias(v)
              for v, (s, _) in zip(vs, sums.values(), strict=True)]
    at = F.col("_us") + F.col("_m.by")
    moved = moved.select(*ks, at.alias("_at"), F.floor(at / b_us).alias("_bk"),
                         F.when(F.col("_m.i") == 0, F.col("_row")).alias("_row"), *change)
    totals = moved.groupBy(*ks, "_bk").agg(*[F.sum(v).alias(v) for v in vs])
    earlier = Window.partitionBy(*ks).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*ks, (F.col("_bk") * b_us - 1).alias("_at"), "_bk",
                            F.lit(None).cast(moved.schema["_row"].dataType).alias("_row"),
                            *[F.sum(v).over(earlier).alias(v) for v in vs]).filter("_bk IS NOT NULL")
    frame = (Window.partitionBy(*ks, "_bk").orderBy("_at")
             .rangeBetween(Window.unboundedPreceding, 0 if include_current else -1))
    out = moved.unionByName(carried).select("_row", F.col("_at"), *[
        F.sum(v).over(frame).alias(v) for v in vs]).filter("_row IS NOT NULL")
    zero = [F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.coalesce(v, F.lit(0))) for v in vs]
    return out.select("_row.*", *[z.alias(name) for z, name in zip(zero, sums, strict=True)])
