"""Table profiling and data checks: balance, value counts, describe, nulls,
domains, finiteness, required columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import attach_totals, interpolated_quantiles


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "column",
            value: str = "value", cast: str = "double") -> DataFrame:
    return df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in cols]) \
        .unpivot(list(ids), list(cols), name, value)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).cast("long").alias("n_positive"),
                  F.round(F.avg(y), 6).alias("positive_rate"),
                  F.round(1 - F.avg(y), 6).alias("negative_rate"))


def value_counts(df: DataFrame, col: str, pct_digits: int = 2) -> DataFrame:
    """Counts per value with percent of total (total from the aggregated rows)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return attach_totals(counts, total, []) \
        .withColumn("pct", F.round(F.col("n") * 100.0 / F.col("_total"), pct_digits)).drop("_total")


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(col).asc()).limit(k))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per column (pandas semantics)."""
    long = unpivot(df, [], cols, "feature", "value")
    stats = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = interpolated_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["feature"])
    return stats.join(qs, "feature")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls").withColumn("offender", F.col("nulls") > 0)


def domain_check(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    vals = df.select(F.col(col).alias("value")).where("value IS NOT NULL").distinct()
    return vals.withColumn("in_domain", F.col("value").isin(list(allowed)))


def finite_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    def bad(c):
        x = F.col(c).cast("double")
        return (x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))).cast("long")
    one = df.agg(*[F.sum(bad(c)).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "non_finite").withColumn("finite", F.col("non_finite") == 0)


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: present in the schema, and its non-null count."""
    present = set(df.columns)
    one = df.agg(*[(F.count(F.col(c)) if c in present else F.lit(None).cast("long")).alias(c)
                   for c in required])
    return one.unpivot([], list(required), "column", "non_null") \
        .withColumn("present", F.col("column").isin([c for c in required if c in present]))
