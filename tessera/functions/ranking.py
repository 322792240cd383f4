"""Distributed ordered statistics: prefix sums, ranks and positional quantiles.

A naive ``Window.orderBy`` without ``partitionBy`` (or a window over one hot
group) puts every row in one task.  Here the input is first reduced to one
row per (group, value); the value axis is then cut into ranges by bounds taken
from a small sample, per-range totals (groups x ranges rows) are prefix-summed,
and the running sum inside each (group, range) adds its offset.  A hot group is
split across ranges, so no task holds a whole group.

Nothing runs and nothing is kept while a plan is built: the bounds are a scalar
subquery of the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SAMPLE_PER_RANGE = 32


def _range_bounds(df: DataFrame, col: str, n_ranges: int) -> Column:
    """Sorted array of ``n_ranges - 1`` cut points for ``col`` (nulls if ``df`` is empty):
    quantiles of the rows with the smallest hashes, a sample of fixed size that each
    task cuts before the merge.

    Bounds only steer balance, never correctness: any bounds give exact results.
    The hash covers all columns, so that the aggregation below is the one the
    ranking reads and its shuffle can be reused.
    """
    sample = (df.where(F.col(col).isNotNull())
              .select(F.col(col).alias("_v"), F.xxhash64(*df.columns).alias("_h"))
              .orderBy("_h").limit(n_ranges * _SAMPLE_PER_RANGE))
    ordered = sample.agg(F.array_sort(F.collect_list("_v")).alias("_v"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(n_ranges - 1)),
                       lambda i: F.get("_v", (i * F.size("_v") / n_ranges).cast("int")))
    return ordered.select(cuts).scalar()


def with_range(df: DataFrame, col: str, bounds: Column, n_ranges: int, name: str) -> DataFrame:
    """Add ``name``: the number of ``bounds`` <= ``col`` (0 .. n_ranges - 1; nulls 0), by a
    binary search of one step per projection."""
    out = df.withColumn("_bounds", bounds).withColumn(name, F.lit(0))
    step = 1
    while step * 2 <= n_ranges - 1:
        step *= 2
    while step:
        out = out.withColumn(name, F.when(
            F.get("_bounds", F.col(name) + (step - 1)) <= F.col(col), F.col(name) + step)
            .otherwise(F.col(name)))
        step //= 2
    return out.drop("_bounds")


def prefix_sums(df: DataFrame, order_col: str, weights: Sequence[str],
                group_cols: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """For each row add ``<w>_before`` (sum of w over rows of the same group with a
    smaller ``order_col``) and ``<w>_upto`` (smaller or equal).

    ``df`` must hold one row per (group, order value); ties must be collapsed first.
    """
    spark = df.sparkSession
    if n_ranges is None:
        n_ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    groups = list(group_cols)
    staged = with_range(df, order_col, _range_bounds(df, order_col, n_ranges), n_ranges, "_rng")

    totals = staged.groupBy(*groups, "_rng").agg(*[F.sum(w).alias(f"_t_{w}") for w in weights])
    tw = Window.partitionBy(*groups).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1) \
        if groups else Window.orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    # groups x ranges rows: small next to the data.
    offsets = totals.select(*groups, "_rng", *[
        F.coalesce(F.sum(f"_t_{w}").over(tw), F.lit(0)).alias(f"_o_{w}") for w in weights])

    if not groups:
        offsets = F.broadcast(offsets)  # at most n_ranges rows
    joined = join_groups(staged, offsets, [*groups, "_rng"])
    iw = Window.partitionBy(*groups, "_rng").orderBy(order_col)
    run = iw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined
    for w in weights:
        upto = F.sum(w).over(run) + F.col(f"_o_{w}")
        out = out.withColumn(f"{w}_upto", upto).withColumn(f"{w}_before", F.col(f"{w}_upto") - F.col(w))
    return out.drop("_rng", *[f"_o_{w}" for w in weights])


def positional_quantiles(df: DataFrame, value_col: str, qs: dict[str, float],
                         group_cols: Sequence[str] = ()) -> DataFrame:
    """``sorted(values)[floor(n*q)]`` per group, exact, as the reference's
    list-index formula (not ``percentile_disc``, which is one position lower
    when n*q is an integer).  Index is clamped to n-1.
    """
    groups = list(group_cols)
    counts = df.where(F.col(value_col).isNotNull()) \
        .groupBy(*groups, value_col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(counts, value_col, ["_c"], groups)
    totals = counts.groupBy(*groups).agg(F.sum("_c").alias("_n"))
    ranked = attach_totals(ranked, totals, groups)
    aggs = []
    for name, q in qs.items():
        k = F.least(F.floor(F.col("_n") * F.lit(q)), F.col("_n") - 1)
        hit = (F.col("_c_before") <= k) & (F.col("_c_upto") > k)
        aggs.append(F.min(F.when(hit, F.col(value_col))).alias(name))
    return ranked.groupBy(*groups).agg(*aggs)


def join_groups(df: DataFrame, per_group: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Join (inner or left) on ``groups`` in which null equals null."""
    other = per_group.withColumnsRenamed({g: f"__{g}" for g in groups})
    cond = F.lit(True)
    for g in groups:
        cond = cond & df[g].eqNullSafe(other[f"__{g}"])
    return df.join(other, cond, how).drop(*[f"__{g}" for g in groups])


def attach_totals(df: DataFrame, totals: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Join per-group totals back, null groups included.  With no groups the one-row total becomes a
    scalar subquery (computed once, shipped as a value — no join at all)."""
    if groups:
        return join_groups(df, totals, groups)
    cols = totals.columns
    packed = totals.select(F.struct(*cols).alias("__totals")).scalar()
    return (df.withColumn("__totals", packed)
            .select(*df.columns, *[F.col(f"__totals.{c}").alias(c) for c in cols]))


def dense_codes(df: DataFrame, col: str, code_col: str = "code", start: int = 0) -> DataFrame:
    """Distinct values of ``col`` with their alphabetical dense rank (``start``-based),
    ranked by ``prefix_sums``, however many there are."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    ranked = prefix_sums(distinct.withColumn("_one", F.lit(1)), col, ["_one"])
    return ranked.select(col, (F.col("_one_before") + F.lit(start)).cast("int").alias(code_col))


def interpolated_quantiles(df: DataFrame, value_col: str, qs: dict[str, float],
                           group_cols: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (pandas ``quantile`` / ``percentile_cont``),
    exact, without holding a group's values in one buffer: position h = (n-1)q,
    values at floor(h) and floor(h)+1 are found through ``prefix_sums``."""
    groups = list(group_cols)
    counts = df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col).cast("double"))) \
        .groupBy(*groups, value_col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = prefix_sums(counts, value_col, ["_c"], groups)
    totals = counts.groupBy(*groups).agg(F.sum("_c").alias("_n"))
    ranked = attach_totals(ranked, totals, groups)
    aggs = []
    for name, q in qs.items():
        h = (F.col("_n") - 1) * F.lit(q)
        lo = F.floor(h)
        hi = F.least(lo + 1, F.col("_n") - 1)
        at = lambda k: (F.col("_c_before") <= k) & (F.col("_c_upto") > k)
        aggs += [F.min(F.when(at(lo), F.col(value_col))).alias(f"_{name}_lo"),
                 F.min(F.when(at(hi), F.col(value_col))).alias(f"_{name}_hi"),
                 F.first(h - lo).alias(f"_{name}_f")]
    res = ranked.groupBy(*groups).agg(*aggs)
    return res.select(*groups, *[
        (F.col(f"_{n}_lo") + F.col(f"_{n}_f") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n)
        for n in qs])
