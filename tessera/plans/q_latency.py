"""Queries: request-log monitoring (AG11-AG24, SR6-SR8 in batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.ranking import join_groups
from tessera.operators import latency as lt
from tessera.operators import sketches as sk
from tessera.plans import sql as S
from tessera.plans.registry import query
from tessera.session import saved
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

SLA_MS = 50.0
LOG = S.with_(S.REQUEST_LOG)


def log(spark, sf_dir):
    return ad.request_log(Tables(spark, sf_dir))


def pos_sql(src: str, group: str, qs: dict, where: str = "TRUE") -> str:
    sel = ", ".join(
        f"min(CASE WHEN pos = least(floor(n * {q}), n - 1) THEN latency_ms END) AS {name}"
        for name, q in qs.items())
    return f"""(SELECT {group}, {sel} FROM (
      SELECT {group}, latency_ms,
             row_number() OVER (PARTITION BY {group} ORDER BY latency_ms) - 1 AS pos,
             count(*) OVER (PARTITION BY {group}) AS n
      FROM {src} WHERE {where}) GROUP BY {group})"""


@query("latency_summary", sql=LOG + """
SELECT endpoint, count(*) AS samples, round(avg(latency_ms), 6) AS avg_ms,
       min(latency_ms) AS min_ms, max(latency_ms) AS max_ms FROM request_log GROUP BY endpoint""")
def latency_summary(spark, sf_dir):
    return lt.latency_summary(log(spark, sf_dir), ["endpoint"])


@query("latency_quantiles", sql=LOG + "SELECT * FROM " + pos_sql("request_log", "endpoint", lt.PCTS, "success"))
def latency_quantiles(spark, sf_dir):
    """P50/P95/P99 of successful calls: sorted[floor(n*q)]."""
    return lt.latency_quantiles(log(spark, sf_dir).where("success"), ["endpoint"])


@query("latency_quantiles_approx")
def latency_quantiles_approx(spark, sf_dir):
    return lt.latency_quantiles_approx(log(spark, sf_dir).where("success"), ["endpoint"])


@query("sla_share", sql=LOG + f"""
SELECT endpoint, CAST(sum(CASE WHEN latency_ms < {SLA_MS} THEN 1 ELSE 0 END) AS BIGINT) AS under_sla,
       count(*) AS n,
       CAST(floor(sum(CASE WHEN latency_ms < {SLA_MS} THEN 1 ELSE 0 END) * 100 / count(*)) AS BIGINT) AS under_sla_pct
FROM request_log WHERE success GROUP BY endpoint""")
def sla_share(spark, sf_dir):
    return lt.sla_share(log(spark, sf_dir).where("success"), ["endpoint"], SLA_MS)


@query("success_rate", sql=LOG + """
SELECT endpoint, count(*) AS total, CAST(sum(CAST(success AS INTEGER)) AS BIGINT) AS succeeded,
       count(*) - CAST(sum(CAST(success AS INTEGER)) AS BIGINT) AS failed,
       round(sum(CAST(success AS INTEGER)) * 100.0 / count(*), 6) AS success_rate
FROM request_log GROUP BY endpoint""")
def success_rate(spark, sf_dir):
    return lt.success_rate(log(spark, sf_dir), ["endpoint"])


@query("throughput", sql=LOG + """
SELECT endpoint, count(*) AS requests,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed_s,
       round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS rps
FROM request_log GROUP BY endpoint""")
def throughput(spark, sf_dir):
    return lt.throughput(log(spark, sf_dir), ["endpoint"])


@query("error_counts", sql=LOG + "SELECT error, count(*) AS n FROM request_log WHERE NOT success GROUP BY error")
def error_counts(spark, sf_dir):
    return lt.error_counts(log(spark, sf_dir))


OUTCOME_SQL = "CASE WHEN round(latency_ms / (latency_ms + 100.0), 6) > 0.5 THEN 'fraud' ELSE 'legitimate' END"


def _outcomes(spark, sf_dir):
    lg = log(spark, sf_dir).where("success")
    p = F.round(F.col("latency_ms") / (F.col("latency_ms") + 100.0), 6)
    return lg.withColumn("outcome", F.when(p > 0.5, "fraud").otherwise("legitimate"))


@query("outcome_share", sql=LOG + f"""
SELECT outcome, n, CAST(floor(n * 100 / sum(n) OVER ()) AS BIGINT) AS pct FROM (
  SELECT {OUTCOME_SQL} AS outcome, count(*) AS n FROM request_log WHERE success GROUP BY 1)""")
def outcome_share(spark, sf_dir):
    """Outcome counts of successful calls with integer-floor percent."""
    return lt.outcome_share(_outcomes(spark, sf_dir), "outcome")


@query("load_verdict", sql=LOG + f"""
, sr AS (SELECT endpoint, round(sum(CAST(success AS INTEGER)) * 100.0 / count(*), 6) AS success_rate
         FROM request_log GROUP BY endpoint),
p AS {pos_sql("request_log", "endpoint", {"p99": 0.99}, "success")}
SELECT sr.endpoint, sr.success_rate, p.p99,
       CASE WHEN sr.success_rate >= 99 AND p.p99 < {SLA_MS} THEN 'PASS'
            WHEN sr.success_rate >= 99 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict
FROM sr LEFT JOIN p USING (endpoint)""")
def load_verdict(spark, sf_dir):
    return lt.load_verdict(log(spark, sf_dir), ["endpoint"], SLA_MS)


@query("method_comparison", sql=LOG + f"""
, q AS {pos_sql("request_log", "endpoint", {"p95": 0.95, "p99": 0.99})}
SELECT endpoint, count(*) AS samples, round(avg(latency_ms), 6) AS avg_ms, min(latency_ms) AS min_ms,
       max(latency_ms) AS max_ms, any_value(q.p95) AS p95, any_value(q.p99) AS p99
FROM request_log JOIN q USING (endpoint) GROUP BY endpoint""")
def method_comparison(spark, sf_dir):
    return lt.method_comparison(log(spark, sf_dir), "endpoint")


@query("method_delta", sql=LOG + f"""
, a AS (SELECT avg(latency_ms) AS v FROM request_log WHERE endpoint = 'click'),
b AS (SELECT avg(latency_ms) AS v FROM request_log WHERE endpoint = 'view')
SELECT round(a.v, 6) AS avg_a, round(b.v, 6) AS avg_b, round(abs(b.v - a.v), 6) AS abs_diff_ms,
       CASE WHEN b.v - a.v > 0 THEN 'click' ELSE 'view' END AS faster,
       a.v < {SLA_MS} AS a_meets_target, b.v < {SLA_MS} AS b_meets_target
FROM a, b""")
def method_delta(spark, sf_dir):
    return lt.method_delta(log(spark, sf_dir), "endpoint", "click", "view", SLA_MS)


@query("label_counters", sql=LOG + f"""
SELECT endpoint, {OUTCOME_SQL} AS outcome, count(*) AS n FROM request_log WHERE success GROUP BY 1, 2""")
def label_counters(spark, sf_dir):
    return _outcomes(spark, sf_dir).groupBy("endpoint", "outcome").agg(F.count(F.lit(1)).alias("n"))


def _hist_sql(groups: str) -> str:
    les = lt.DEFAULT_BUCKETS
    arr = "[" + ", ".join(repr(float(b)) for b in les) + ", 'inf'::DOUBLE]"
    return f"""
, b AS (SELECT {groups}, list_count(list_filter({arr}[1:{len(les)}], lambda x: x < latency_ms / 1000.0)) AS bi
        FROM request_log),
g AS (SELECT DISTINCT {groups} FROM request_log),
full_ AS (SELECT g.*, i.bi FROM g, range(0, {len(les) + 1}) i(bi)),
c AS (SELECT {groups}, bi, count(*) AS c FROM b GROUP BY ALL)
SELECT f.{groups}, {arr}[f.bi + 1] AS le,
       CAST(sum(coalesce(c.c, 0)) OVER (PARTITION BY f.{groups} ORDER BY f.bi) AS BIGINT) AS cumulative_count
FROM full_ f LEFT JOIN c ON f.{groups} = c.{groups} AND f.bi = c.bi"""


@query("latency_histogram", sql=LOG[:-1] + _hist_sql("endpoint"))
def latency_histogram(spark, sf_dir):
    lg = log(spark, sf_dir).withColumn("latency_s", F.col("latency_ms") / 1000.0)
    return lt.histogram(lg, ["endpoint"], "latency_s")


@query("windowed_rates", sql=LOG + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, endpoint, count(*) AS requests,
       round(count(*) / 3600.0, 6) AS rps, round(avg(CASE WHEN success THEN 0.0 ELSE 1.0 END), 6) AS error_ratio
FROM request_log GROUP BY 1, 2""")
def windowed_rates(spark, sf_dir):
    return lt.windowed_rates(log(spark, sf_dir), "ts", "1 hour", ["endpoint"])


QUANTILE_SQL = LOG + """
, b AS (SELECT endpoint, date_trunc('day', ts) AS day,
               list_count(list_filter([0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0],
                                      lambda x: x < latency_ms / 1000.0)) AS i
        FROM request_log),
bk AS (SELECT * FROM (VALUES (0, 0.0, 0.005), (1, 0.005, 0.01), (2, 0.01, 0.025), (3, 0.025, 0.05),
       (4, 0.05, 0.075), (5, 0.075, 0.1), (6, 0.1, 0.25), (7, 0.25, 0.5), (8, 0.5, 0.75), (9, 0.75, 1.0),
       (10, 1.0, 2.5), (11, 2.5, 5.0), (12, 5.0, 7.5), (13, 7.5, 10.0), (14, 10.0, 'inf'::DOUBLE)) t(i, lo, hi)),
g AS (SELECT DISTINCT endpoint, day FROM b),
cnt AS (SELECT g.endpoint, g.day, bk.i, bk.lo, bk.hi,
               (SELECT count(*) FROM b WHERE b.endpoint = g.endpoint AND b.day = g.day AND b.i = bk.i) AS c
        FROM g CROSS JOIN bk),
cum AS (SELECT *, sum(c) OVER (PARTITION BY endpoint, day ORDER BY i) AS cc,
               sum(c) OVER (PARTITION BY endpoint, day) AS total FROM cnt),
hit AS (SELECT *, row_number() OVER (PARTITION BY endpoint, day ORDER BY i) AS r FROM cum
        WHERE cc >= 0.95 * total AND total > 0)
SELECT endpoint, day AS window_start,
       CASE WHEN hi = 'inf'::DOUBLE THEN lo ELSE lo + (hi - lo) * (0.95 * total - (cc - c)) / c END AS quantile
FROM hit WHERE r = 1"""


@query("histogram_quantile", sql=QUANTILE_SQL)
def histogram_quantile(spark, sf_dir):
    """Daily P95 per endpoint from cumulative buckets, interpolated inside the bucket."""
    lg = log(spark, sf_dir).withColumn("latency_s", F.col("latency_ms") / 1000.0) \
        .withColumn("window_start", F.window("ts", "1 day").start)
    h = lt.histogram(lg, ["endpoint", "window_start"], "latency_s")
    return lt.histogram_quantile(h, ["endpoint", "window_start"], 0.95)


@query("sustained_alerts", sql=LOG + """
, h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS requests,
               round(avg(CASE WHEN success THEN 0.0 ELSE 1.0 END), 6) AS error_ratio
        FROM request_log GROUP BY 1)
SELECT window_start, requests, error_ratio,
       sum(CASE WHEN error_ratio > 0.05 THEN 1 ELSE 0 END) OVER (
         ORDER BY epoch(window_start) // 3600 RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS sustained
FROM h""")
def sustained_alerts(spark, sf_dir):
    """Error ratio above 5 % in each of 3 consecutive hourly windows."""
    rates = lt.windowed_rates(log(spark, sf_dir), "ts", "1 hour")
    flagged = rates.withColumn("_hot", F.col("error_ratio") > 0.05)
    return lt.sustained(flagged, [], "window_start", "_hot", 3, 3600) \
        .select("window_start", "requests", "error_ratio", "sustained")


def alert_sql() -> str:
    parts = []
    for name, periods, p99, errors in lt.ALERT_RULES:
        test = (f"count(*) FILTER (latency_ms <= {p99}) <= floor(count(*) * 0.99)" if p99 is not None
                else f"count(*) FILTER (NOT success) / count(*) > {errors}")
        parts.append(f"""
SELECT '{name}' AS rule, window_start, requests, holds,
       sum(CASE WHEN holds THEN 1 ELSE 0 END) OVER (ORDER BY epoch(window_start) // 60
           RANGE BETWEEN {periods - 1} PRECEDING AND CURRENT ROW) = {periods} AS firing
FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) AS requests, {test} AS holds
      FROM request_log GROUP BY 1)""")
    return LOG + " UNION ALL ".join(parts)


@query("alert_rules", sql=alert_sql())
def alert_rules(spark, sf_dir):
    """The stated alerts on minute windows: slow for 5 and 15 minutes, failing for one."""
    return lt.alert_rules(log(spark, sf_dir), "ts", "latency_ms")


@query("minute_rates", sql=LOG + f"""
SELECT time_bucket(INTERVAL 5 MINUTE, r.ts) AS window_start, count(*) AS requests, round(count(*) / 300.0, 6) AS rps,
       round(avg(CASE WHEN success THEN 0.0 ELSE 1.0 END), 6) AS error_ratio,
       round(avg(CASE WHEN (({S.TRUST} < 40 AND value > 60) OR (event_id % 20 < 3 AND event_id % 10 = 0))
                      THEN 1.0 ELSE 0.0 END), 6) AS fraud_ratio
FROM request_log r JOIN events ON event_id = request_id GROUP BY 1""")
def minute_rates(spark, sf_dir):
    """Requests per second, error and fraud ratio in 5-minute windows."""
    t = Tables(spark, sf_dir)
    fraud = ad.transactions(t, with_velocity=False).select(
        F.col("transaction_id").cast("long").alias("request_id"), (F.col("is_fraud") == 1).alias("fraud"))
    return lt.windowed_rates(log(spark, sf_dir).join(fraud, "request_id"), "ts", "5 minutes", flag="fraud")


def rates_sql(minutes: int) -> str:
    return LOG + f"""
SELECT time_bucket(INTERVAL {minutes} MINUTE, ts) AS window_start, endpoint, count(*) AS requests,
       round(count(*) / {60.0 * minutes}, 6) AS rps, round(avg(CASE WHEN success THEN 0.0 ELSE 1.0 END), 6) AS error_ratio
FROM request_log GROUP BY 1, 2"""


@query("rates_1m", sql=rates_sql(1))
def rates_1m(spark, sf_dir):
    """Requests per second and error ratio per endpoint and minute."""
    return lt.windowed_rates(log(spark, sf_dir), "ts", "1 minute", ["endpoint"])


RANK_ERROR = 0.02
SKETCH_QS = (0.5, 0.95, 0.99)


@query("sketch_quantiles", sql=LOG + f"""
SELECT days, endpoint, period, count(*) AS requests, q.q AS q, true AS within
FROM (SELECT *, d.d AS days, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // d.d AS BIGINT) AS period
      FROM request_log, (VALUES (1), (7), (30)) d(d)), (VALUES {", ".join(f"({q})" for q in SKETCH_QS)}) q(q)
GROUP BY ALL""")
def sketch_quantiles(spark, sf_dir):
    """Quantiles of days, weeks and months from sketches kept by endpoint and hour (read once as
    rows, then never again), each held against its exact rank among the period's requests."""
    calls = log(spark, sf_dir)
    kept = saved(sk.hourly(calls, "ts", ["endpoint"], "latency_ms", "user_id"), "hourly-sketches")
    day = lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))
    spans = F.explode(F.array(*[F.lit(d) for d in (1, 7, 30)])).alias("days")
    period = lambda c: F.floor(day(c) / F.col("days")).cast("long").alias("period")
    told = sk.merged(kept.select("*", spans).select("*", period("hour")), ["days", "endpoint", "period"]) \
        .select("days", "endpoint", "period", F.inline(F.array(*[
            F.struct(F.lit(q).alias("q"), sk.quantile(q).alias("value")) for q in SKETCH_QS])))
    rows = calls.select("endpoint", "ts", "latency_ms", spans).select("*", period("ts"))
    # a value's rank is anywhere between the shares of rows below it and up to it
    held = rows.join(told, ["days", "endpoint", "period"]).groupBy("days", "endpoint", "period", "q").agg(
        F.count(F.lit(1)).alias("requests"), F.avg((F.col("latency_ms") < F.col("value")).cast("double")).alias("under"),
        F.avg((F.col("latency_ms") <= F.col("value")).cast("double")).alias("upto"))
    within = (F.col("under") - RANK_ERROR <= F.col("q")) & (F.col("q") <= F.col("upto") + RANK_ERROR)
    return held.select("days", "endpoint", "period", "requests", "q", within.alias("within"))


@query("sketch_users", sql=LOG + """
SELECT endpoint, count(*) AS requests, true AS within FROM request_log GROUP BY endpoint""")
def sketch_users(spark, sf_dir):
    """Distinct users per endpoint over all time from the hours' sketches, within 5 % of exact."""
    calls = log(spark, sf_dir)
    est = sk.merged(sk.hourly(calls, "ts", ["endpoint"], "latency_ms", "user_id"), ["endpoint"]) \
        .select("endpoint", F.col("n").alias("requests"), sk.distinct().alias("users"))
    exact = calls.groupBy("endpoint").agg(F.count_distinct("user_id").alias("exact"))
    return join_groups(est, exact, ["endpoint"]).select(
        "endpoint", "requests", (F.abs(F.col("users") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within"))
