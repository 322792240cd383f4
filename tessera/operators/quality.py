"""Data quality, drift and governance checks as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ranking import (
    attach_totals, interpolated_quantiles, join_groups, positional_quantiles, prefix_sums,
)

EPS = 1e-4


def expectations(df: DataFrame, checks: Sequence[tuple]) -> DataFrame:
    """checks: (name, column, kind, arg) with kind in exists / not_null / between / in_set.
    One aggregation pass; one result row per check."""
    aggs, rows = [], []
    for i, (name, col, kind, arg) in enumerate(checks):
        if kind == "exists":
            rows.append((name, col, F.lit(0 if col in df.columns else 1).cast("long")))
            continue
        c = F.col(col)
        bad = {"not_null": c.isNull(),
               "between": c.isNull() | ~c.between(arg[0], arg[1]) if kind == "between" else None,
               "in_set": c.isNull() | ~c.isin(list(arg)) if kind == "in_set" else None}[kind]
        aggs.append(F.sum(bad.cast("long")).alias(f"_f{i}"))
        rows.append((name, col, F.col(f"_f{i}")))
    one = df.agg(*aggs) if aggs else df.limit(1).select()
    recs = F.array(*[F.struct(F.lit(n).alias("expectation"), F.lit(c).alias("column"),
                              F.coalesce(v, F.lit(0)).cast("long").alias("n_failed")) for n, c, v in rows])
    return one.select(F.explode(recs).alias("r")).select("r.*").withColumn("success", F.col("n_failed") == 0)


def bin_bounds(ref: DataFrame, feature_col: str, value_col: str, bins: int = 10) -> DataFrame:
    """Reference-quantile cut points per feature (positional, exact)."""
    qs = {f"q{i}": i / bins for i in range(1, bins)}
    q = positional_quantiles(ref, value_col, qs, [feature_col])
    return q.select(feature_col, F.array(*[F.col(f"q{i}") for i in range(1, bins)]).alias("bounds"))


def _value_counts(ref: DataFrame, cur: DataFrame, feature_col: str, value_col: str) -> DataFrame:
    """(feature, value, n_r, n_c): both sides in one reduction, so that raw rows are
    shuffled once and combined before it."""
    u = (ref.select(feature_col, value_col, F.lit(1).alias("_r"), F.lit(0).alias("_c"))
         .unionByName(cur.select(feature_col, value_col, F.lit(0).alias("_r"), F.lit(1).alias("_c"))))
    return u.groupBy(feature_col, value_col).agg(F.sum("_r").alias("n_r"), F.sum("_c").alias("n_c"))


def psi(ref: DataFrame, cur: DataFrame, feature_col: str, value_col: str, bins: int = 10) -> DataFrame:
    """Population stability index per feature (a null feature is one) over reference-decile
    bins; an empty bin's share is floored at 1e-4."""
    bounds = bin_bounds(ref, feature_col, value_col, bins)
    binned = join_groups(_value_counts(ref, cur, feature_col, value_col), bounds, [feature_col]) \
        .withColumn("bin", F.size(F.filter("bounds", lambda x: x < F.col(value_col))))
    in_bin = lambda side: [F.sum(F.when(F.col("bin") == i, F.col(side)).otherwise(0)) for i in range(bins)]
    per = binned.groupBy(feature_col).agg(F.array(*in_bin("n_r")).alias("r"), F.array(*in_bin("n_c")).alias("c"))
    total = lambda side: F.aggregate(side, F.lit(0).cast("long"), lambda a, x: a + x)
    share = lambda x, n: F.greatest(F.try_divide(x, n), F.lit(EPS))
    term = F.zip_with("r", "c", lambda r, c: (share(c, F.col("_tc")) - share(r, F.col("_tr")))
                      * F.log(share(c, F.col("_tc")) / share(r, F.col("_tr"))))
    return per.withColumn("_tr", total("r")).withColumn("_tc", total("c")) \
        .select(feature_col, F.aggregate(term, F.lit(0.0), lambda a, x: a + x).alias("psi"))


def ks_statistic(ref: DataFrame, cur: DataFrame, feature_col: str, value_col: str) -> DataFrame:
    """Two-sample KS: max |F_ref - F_cur| over the union of values (exact,
    cumulative counts through distributed prefix sums); a null feature is one."""
    per = _value_counts(ref, cur, feature_col, value_col)
    ranked = prefix_sums(per, value_col, ["n_r", "n_c"], [feature_col])
    tot = per.groupBy(feature_col).agg(F.sum("n_r").alias("_na"), F.sum("n_c").alias("_nb"))
    j = join_groups(ranked, tot, [feature_col])
    d = F.abs(F.try_divide(F.col("n_r_upto"), F.col("_na")) - F.try_divide(F.col("n_c_upto"), F.col("_nb")))
    return j.groupBy(feature_col).agg(F.max(d).alias("ks"))


def mean_shift(ref: DataFrame, cur: DataFrame, feature_col: str, value_col: str, k: float = 3.0) -> DataFrame:
    """Shift of the mean in standard deviations of the reference, per feature of both sides
    (a null feature is one)."""
    r = ref.groupBy(feature_col).agg(F.avg(value_col).alias("ref_mean"), F.stddev_samp(value_col).alias("ref_std"))
    c = cur.groupBy(feature_col).agg(F.avg(value_col).alias("cur_mean"))
    shift = F.try_divide(F.abs(F.col("cur_mean") - F.col("ref_mean")), F.col("ref_std"))
    return join_groups(r, c, [feature_col]).select(
        feature_col, "ref_mean", "ref_std", "cur_mean", shift.alias("shift_sd"), (shift > k).alias("alert"))


def outliers(df: DataFrame, group: str, value: str, id_col: str, z: float = 3.0) -> DataFrame:
    """z-score and IQR-fence flags per row against its group's statistics: a flag for every
    row, those of a null group included; a null value is no outlier of its z-score and has
    no answer to the fence."""
    st = df.groupBy(group).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    q = interpolated_quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, [group])
    j = join_groups(df, join_groups(st, q, [group], "left"), [group])
    iqr = F.col("_q3") - F.col("_q1")
    zf = F.when(F.col("_s") > 0, F.coalesce(F.abs(F.col(value) - F.col("_m")) / F.col("_s") > z, F.lit(False))) \
        .otherwise(F.lit(False))
    fence = (F.col(value) < F.col("_q1") - 1.5 * iqr) | (F.col(value) > F.col("_q3") + 1.5 * iqr)
    return j.select(id_col, group, value, zf.alias("z_outlier"), fence.alias("iqr_outlier"))


def two_proportion_test(df: DataFrame, arm_col: str, success_col: str, control: str, treatment: str,
                        min_lift: float = 0.02, z_crit: float = 1.96) -> DataFrame:
    g = df.groupBy().agg(*[x for a, tag in ((control, "c"), (treatment, "t")) for x in (
        F.sum((F.col(arm_col) == a).cast("long")).alias(f"n_{tag}"),
        F.sum(((F.col(arm_col) == a) & F.col(success_col)).cast("long")).alias(f"s_{tag}"))])
    pc, pt = F.col("s_c") / F.col("n_c"), F.col("s_t") / F.col("n_t")
    pool = (F.col("s_c") + F.col("s_t")) / (F.col("n_c") + F.col("n_t"))
    zval = (pt - pc) / F.sqrt(pool * (1 - pool) * (1 / F.col("n_c") + 1 / F.col("n_t")))
    lift = (pt - pc) / pc
    return g.select("n_c", "n_t", pc.alias("rate_control"), pt.alias("rate_treatment"), lift.alias("lift"),
                    zval.alias("z"), ((lift > min_lift) & (F.abs(zval) > z_crit)).alias("promote"))


def freshness(df: DataFrame, key: str, ts: str, as_of: str, stale_hours: float = 24) -> DataFrame:
    last = df.groupBy(key).agg(F.max(ts).alias("last_update"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("last_update").cast("timestamp"))) / 3.6e9
    return last.select(key, "last_update", age.alias("age_hours"), (age > stale_hours).alias("stale"))


def period_change(df: DataFrame, period_col: str, value_col: str, threshold: float = 0.2) -> DataFrame:
    """Totals per period, change against the previous period (a window over the
    few period rows), alert when |change| exceeds the threshold."""
    per = df.groupBy(period_col).agg(F.sum(value_col).alias("total"))
    prev = F.lag("total").over(Window.orderBy(period_col))
    ch = (F.col("total") - F.col("prev_total")) / F.col("prev_total")
    return per.withColumn("prev_total", prev).withColumn("change", ch) \
        .withColumn("alert", F.coalesce(F.abs(F.col("change")) > threshold, F.lit(False)))


def share(df: DataFrame, flag_col: str) -> DataFrame:
    tot = df.agg(F.avg(F.col(flag_col).cast("double")).alias(f"share_{flag_col}"))
    return attach_totals(df, tot, [])
