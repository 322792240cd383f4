"""Mergeable sketches: quantiles (KLL) and distinct counts (HLL) kept as binary columns per
group and hour, merged for any longer period without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400  # of a KLL sketch: a rank error of about 0.7 %


def hourly(log: DataFrame, ts: str, groups: Sequence[str], value: str, who: str, k: int = K) -> DataFrame:
    """(hour, groups, n, kll, hll) of a log: one row per group and hour; null values count in n
    alone.  Sketches are combined inside each task before the shuffle."""
    return log.groupBy(F.window(ts, "1 hour").start.alias("hour"), *groups).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("kll"),
        F.hll_sketch_agg(F.col(who).cast("string")).alias("hll"))


def merged(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """The sketches of all rows with the same ``by`` as one: any period, any coarser group."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("kll").alias("kll"),
                                     F.hll_union_agg("hll").alias("hll"))


def quantile(q: float) -> Column:
    """The value at rank q of ``kll``; null without values."""
    return F.when(F.kll_sketch_get_n_double("kll") > 0, F.kll_sketch_get_quantile_double("kll", F.lit(q)))


def distinct() -> Column:
    return F.hll_sketch_estimate("hll")
