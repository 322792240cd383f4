"""Request-log monitoring: latency summaries, positional quantiles, SLA shares,
verdicts, histograms, windowed rates and sustained alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ranking import join_groups, positional_quantiles
from tessera.functions.windows import epoch_us

# Default client-library histogram buckets (seconds).
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

PCTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_summary(log: DataFrame, groups: Sequence[str], lat: str = "latency_ms") -> DataFrame:
    return log.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("samples"), F.round(F.avg(lat), 6).alias("avg_ms"),
        F.min(lat).alias("min_ms"), F.max(lat).alias("max_ms"))


def latency_quantiles(log: DataFrame, groups: Sequence[str], lat: str = "latency_ms",
                      qs: dict | None = None) -> DataFrame:
    """``sorted(latencies)[floor(n*q)]`` per group (exact, distributed)."""
    return positional_quantiles(log, lat, qs or PCTS, groups)


def latency_quantiles_approx(log: DataFrame, groups: Sequence[str], lat: str = "latency_ms",
                             accuracy: int = 10000) -> DataFrame:
    """Scale form: one pass, bounded memory sketch per group."""
    return log.groupBy(*groups).agg(*[
        F.percentile_approx(lat, q, accuracy).alias(n) for n, q in PCTS.items()])


def sla_share(log: DataFrame, groups: Sequence[str], sla_ms: float, lat: str = "latency_ms") -> DataFrame:
    under = F.sum((F.col(lat) < sla_ms).cast("long"))
    n = F.count(F.lit(1))
    return log.groupBy(*groups).agg(under.alias("under_sla"), n.alias("n"),
                                    F.floor(under * 100 / n).cast("long").alias("under_sla_pct"))


def success_rate(log: DataFrame, groups: Sequence[str], ok: str = "success") -> DataFrame:
    s = F.sum(F.col(ok).cast("long"))
    n = F.count(F.lit(1))
    return log.groupBy(*groups).agg(n.alias("total"), s.alias("succeeded"), (n - s).alias("failed"),
                                    F.round(s * 100.0 / n, 6).alias("success_rate"))


def throughput(log: DataFrame, groups: Sequence[str], ts: str = "ts") -> DataFrame:
    secs = (F.max(epoch_us(ts)) - F.min(epoch_us(ts))) / 1e6
    return log.groupBy(*groups).agg(F.count(F.lit(1)).alias("requests"), F.round(secs, 6).alias("elapsed_s"),
                                    F.round(F.count(F.lit(1)) / secs, 6).alias("rps"))


def error_counts(log: DataFrame, ok: str = "success", err: str = "error") -> DataFrame:
    return log.where(~F.col(ok)).groupBy(err).agg(F.count(F.lit(1)).alias("n"))


def outcome_share(df: DataFrame, outcome: str, groups: Sequence[str] = ()) -> DataFrame:
    """Count per outcome and its integer-floor percent of all rows."""
    counts = df.groupBy(*groups, outcome).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy(*groups).agg(F.sum("n").alias("_tot"))
    from tessera.functions.ranking import attach_totals
    j = attach_totals(counts, tot, list(groups))
    return j.withColumn("pct", F.floor(F.col("n") * 100 / F.col("_tot")).cast("long")).drop("_tot")


def load_verdict(log: DataFrame, groups: Sequence[str], sla_ms: float, ok: str = "success",
                 lat: str = "latency_ms", min_success: float = 99.0) -> DataFrame:
    """PASS when success >= 99 % and P99 (of successful calls) < SLA; PARTIAL when
    only the success rate holds; FAIL otherwise.  A null group is a group; one without a
    successful call has no P99."""
    sr = success_rate(log, groups, ok)
    p = latency_quantiles(log.where(F.col(ok)), groups, lat, {"p99": 0.99})
    j = join_groups(sr, p, list(groups), "left")
    verdict = (F.when((F.col("success_rate") >= min_success) & (F.col("p99") < sla_ms), "PASS")
               .when(F.col("success_rate") >= min_success, "PARTIAL").otherwise("FAIL"))
    return j.select(*groups, "success_rate", "p99", verdict.alias("verdict"))


def method_comparison(log: DataFrame, method: str, lat: str = "latency_ms") -> DataFrame:
    s = latency_summary(log, [method], lat)
    q = latency_quantiles(log, [method], lat, {"p95": 0.95, "p99": 0.99})
    return join_groups(s, q, [method], "left")


def method_delta(log: DataFrame, method: str, a: str, b: str, target_ms: float,
                 lat: str = "latency_ms") -> DataFrame:
    """Two methods side by side: which is faster on average, by how much, targets met."""
    piv = (log.where(F.col(method).isin(a, b)).groupBy()
           .pivot(method, [a, b]).agg(F.avg(lat)))
    diff = F.col(b) - F.col(a)
    return piv.select(F.round(F.col(a), 6).alias("avg_a"), F.round(F.col(b), 6).alias("avg_b"),
                      F.round(F.abs(diff), 6).alias("abs_diff_ms"),
                      F.when(diff > 0, F.lit(a)).otherwise(F.lit(b)).alias("faster"),
                      (F.col(a) < target_ms).alias("a_meets_target"),
                      (F.col(b) < target_ms).alias("b_meets_target"))


def bucket_index(value_col: str, bounds: Sequence[float]):
    """Index of the first bound >= value (len(bounds) for +Inf)."""
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    return F.size(F.filter(arr, lambda b: b < F.col(value_col)))


def histogram(log: DataFrame, groups: Sequence[str], value_col: str,
              bounds: Sequence[float] = DEFAULT_BUCKETS) -> DataFrame:
    """Cumulative bucket counts ``le`` per group (a null group is one): one scan, one counter
    per bucket and group."""
    les = [float(b) for b in bounds] + [float("inf")]
    at = bucket_index(value_col, bounds)
    upto = [F.count(F.when(at <= i, 1)) for i in range(len(les))]
    per = log.groupBy(*groups).agg(F.array(*[
        F.struct(F.lit(x).alias("le"), c.alias("cumulative_count")) for x, c in zip(les, upto, strict=True)]).alias("_h"))
    return per.select(*groups, F.inline("_h"))


def histogram_quantile(hist: DataFrame, groups: Sequence[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets with linear interpolation inside the bucket
    (lower edge 0 for the first bucket; the +Inf bucket answers its lower edge)."""
    w = Window.partitionBy(*groups).orderBy("le")  # at most len(bounds) + 1 rows a group
    h = (hist.withColumn("_prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
         .withColumn("_prev_c", F.coalesce(F.lag("cumulative_count").over(w), F.lit(0)))
         .withColumn("_total", F.max("cumulative_count").over(Window.partitionBy(*groups))))
    rank = F.lit(q) * F.col("_total")
    h = h.where((F.col("cumulative_count") >= rank) & (F.col("_total") > 0))
    first = Window.partitionBy(*groups).orderBy("le")
    h = h.withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1)
    inb = F.col("cumulative_count") - F.col("_prev_c")
    val = F.when(F.col("le") == float("inf"), F.col("_prev_le")).otherwise(
        F.col("_prev_le") + (F.col("le") - F.col("_prev_le")) * (rank - F.col("_prev_c")) / inb)
    return h.select(*groups, val.alias("quantile"))


def bucket_quantile(counts: Sequence, bounds: Sequence[float], q: float):
    """``histogram_quantile`` of one row that holds its buckets' counts as columns; null
    where they are all 0."""
    total = sum(counts[1:], counts[0])
    rank, below, out = F.lit(q) * total, F.lit(0).cast("long"), None
    edges = [0.0, *[float(b) for b in bounds]]
    for i, c in enumerate(counts):
        lo = F.lit(edges[i])
        value = lo if i == len(bounds) else lo + (F.lit(edges[i + 1]) - lo) * (rank - below) / c
        hit = (below + c >= rank) & (total > 0)
        out = F.when(hit, value) if out is None else out.when(hit, value)
        below = below + c
    return out


def windowed_rates(log: DataFrame, ts: str, width: str, groups: Sequence[str] = (),
                   ok: str = "success", flag: str | None = None) -> DataFrame:
    """Per event-time window: requests per second, error ratio (and a flag ratio)."""
    secs = {"1 minute": 60, "5 minutes": 300, "1 hour": 3600, "1 day": 86400, "7 days": 604800}[width]
    aggs = [F.count(F.lit(1)).alias("requests"),
            F.round(F.count(F.lit(1)) / F.lit(secs), 6).alias("rps"),
            F.round(F.avg((~F.col(ok)).cast("double")), 6).alias("error_ratio")]
    if flag:
        aggs.append(F.round(F.avg(F.col(flag).cast("double")), 6).alias(f"{flag}_ratio"))
    g = log.groupBy(F.window(ts, width).alias("w"), *groups).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), *groups, *[a for a in g.columns if a not in ("w", *groups)])


# Alert rules as (name, minutes it must hold, limit of the 99th
# percentile in ms or None, limit of the error ratio or None).
ALERT_RULES = (("p99_over_10ms_for_5m", 5, 10, None), ("p99_over_7ms_for_15m", 15, 7, None),
               ("errors_over_5pct_for_1m", 1, None, 0.05),
               ("availability_under_99_9pct_for_5m", 5, None, 0.001),
               ("inference_failures_over_1pct_for_5m", 5, None, 0.01))


def rule_holds(latency_ms: str, ok: str, rules) -> list:
    """One aggregate column per rule, of its name: whether it holds for the group."""
    n = F.count(F.lit(1))
    holds = []
    for name, _, p99, errors in rules:
        if p99 is not None:
            within = F.count(F.when(F.col(latency_ms) <= p99, 1))
            holds.append((within <= F.floor(n * 0.99)).alias(name))
        else:
            holds.append((F.count(F.when(~F.col(ok), 1)) / n > errors).alias(name))
    return holds


def alert_rules(log: DataFrame, ts: str, latency_ms: str, ok: str = "success", rules=ALERT_RULES) -> DataFrame:
    """(rule, window_start, requests, holds, firing) per rule and minute with
    requests: ``holds`` in this minute, ``firing`` if in each of the rule's last
    minutes (a minute without requests breaks the run).

    The positional 99th percentile, sorted[floor(0.99 n)], exceeds a limit exactly
    if no more than floor(0.99 n) requests are within it: a count, so no minute's
    latencies are gathered.  The runs are over minutes, not requests.
    """
    minutes = log.groupBy(F.window(ts, "1 minute").alias("_w")) \
        .agg(F.count(F.lit(1)).alias("requests"), *rule_holds(latency_ms, ok, rules))
    out = None
    for name, periods, _, _ in rules:
        one = minutes.select(F.lit(name).alias("rule"), F.col("_w.start").alias("window_start"), "requests",
                             F.col(name).alias("holds"))
        one = sustained(one, ["rule"], "window_start", "holds", periods).withColumnRenamed("sustained", "firing")
        out = one if out is None else out.unionByName(one)
    return out


def sustained(series: DataFrame, keys: Sequence[str], start_col: str, cond_col: str,
              periods: int, unit_seconds: int = 60) -> DataFrame:
    """Rows where ``cond_col`` held in each of the last ``periods`` windows (a
    missing window breaks the run): count of true windows in a range frame."""
    m = F.floor(epoch_us(start_col) / (unit_seconds * 1_000_000))
    w = Window.partitionBy(*keys).orderBy("_m").rangeBetween(-(periods - 1), 0)
    s = series.withColumn("_m", m)
    return (s.withColumn("_run", F.sum(F.col(cond_col).cast("int")).over(w))
            .withColumn("sustained", F.col("_run") == periods).drop("_m", "_run"))
