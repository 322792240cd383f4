"""History features per entity: trailing velocities and spend, previous
context, familiarity, unusual hour, smoothed merchant risk, account age."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranking import join_groups, prefix_sums
from tessera.functions.windows import epoch_us, trailing_sums

HOUR, DAY = 3_600, 86_400


def velocity_windows(tx: DataFrame, key: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """Counts of the key's events in [ts-1h, ts), [ts-24h, ts), [ts-7d, ts),
    computed in one pass of running sums."""
    one = F.lit(1).cast("long")
    return trailing_sums(tx, [key], ts, {
        "velocity_1h": (HOUR, one), "velocity_24h": (DAY, one), "velocity_7d": (7 * DAY, one)})


def trailing_spend(tx: DataFrame, key: str = "user_id", ts: str = "timestamp", amount: str = "amount",
                   days: int = 30) -> DataFrame:
    """Count, sum, mean and sample deviation of ``amount`` over the key's last
    ``days`` days; sums are exact decimals (six places, squares twelve)."""
    w, exact = days * DAY, F.col(amount).cast("decimal(18,6)")
    out = trailing_sums(tx, [key], ts, {
        "_n": (w, F.lit(1).cast("long")), "_v": (w, F.col(amount).isNotNull().cast("long")),
        "_s": (w, exact), "_q": (w, (exact * exact).cast("decimal(28,12)"))})
    n, s, q = F.col("_v"), F.col("_s").cast("double"), F.col("_q").cast("double")
    return out.select(
        *tx.columns, F.col("_n").alias(f"txn_count_{days}d"),
        F.when(n > 0, s).alias(f"total_amount_{days}d"),
        F.when(n > 0, s / n).alias(f"avg_amount_{days}d"),
        F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (q - s * s / n) / (n - 1))))
        .alias(f"std_amount_{days}d"))


def prior_stats(df: DataFrame, groups: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """For each row, the count and the sums of ``values`` over the rows of its
    group with a strictly earlier time (rows at the same time see each other as
    neither earlier nor later).  Exact: rows are reduced to one per (group,
    time), prefix-summed by ``prefix_sums`` (a hot group is split across value
    ranges), and the prior totals are joined back."""
    staged = df.withColumn("_t", epoch_us(ts))
    per = staged.groupBy(*groups, "_t").agg(F.count(F.lit(1)).alias("_one"),
                                            *[F.sum(v).alias(v) for v in values])
    ranked = prefix_sums(per, "_t", ["_one", *values], groups)
    prior = ranked.select(*groups, "_t", F.col("_one_before").alias("prior_count"),
                          *[F.col(f"{v}_before").alias(f"prior_sum_{v}") for v in values])
    return join_groups(staged, prior, [*groups, "_t"]).drop("_t")


def account_age(tx: DataFrame, key: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """Days since the key's first event (first event via an aggregate + join;
    events without a key are one group)."""
    first = tx.groupBy(key).agg(F.min(ts).alias("_first"))
    return join_groups(tx, first, [key]).withColumn(
        "account_age_days", F.datediff(F.to_date(ts), F.to_date("_first"))).drop("_first")
