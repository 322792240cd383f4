"""Queries: windows, as-of joins and store checks (2.4 JN6-JN10, 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import behavior as bh
from tessera.operators import online as on
from tessera.operators.asof import asof_join
from tessera.plans import sql as S
from tessera.plans.q_online import AS_OF, START, snapshot, transactions_in_range
from tessera.plans.q_sources import MID
from tessera.plans.registry import query
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

DAY_US = 86_400_000_000


def _events_of(t, kind, *cols):
    return t.events.where(F.col("event_type") == kind).select(*cols)


@query("asof_features", sql="""
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
p AS (SELECT user_id, ts AS feature_ts, value AS purchase_value FROM events WHERE event_type = 'purchase')
SELECT c.event_id, c.user_id, c.ts,
       CASE WHEN p.feature_ts >= c.ts - INTERVAL 2 DAY THEN p.feature_ts END AS feature_ts,
       CASE WHEN p.feature_ts >= c.ts - INTERVAL 2 DAY THEN p.purchase_value END AS purchase_value
FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts >= p.feature_ts""")
def asof_features(spark, sf_dir):
    """Clicks with the user's latest purchase at or before the click, TTL 2 days."""
    t = Tables(spark, sf_dir)
    clicks = _events_of(t, "click", "event_id", "user_id", "ts")
    buys = _events_of(t, "purchase", "user_id", F.col("ts").alias("feature_ts"), F.col("value").alias("purchase_value"))
    return asof_join(clicks, buys, ["user_id"], "ts", "feature_ts", ["purchase_value"], ttl_seconds=2 * 86_400)


@query("asof_ttl", sql="""
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
p AS (SELECT user_id, ts AS view_ts, value AS view_value FROM events WHERE event_type = 'view'),
j AS (SELECT c.*, p.view_ts, p.view_value FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts > p.view_ts)
SELECT event_id, user_id, ts,
       CASE WHEN view_ts >= ts - INTERVAL 6 HOUR THEN view_ts END AS view_ts,
       CASE WHEN view_ts >= ts - INTERVAL 6 HOUR THEN view_value END AS view_value,
       view_ts IS NOT NULL AND view_ts >= ts - INTERVAL 6 HOUR AS hit,
       CASE WHEN view_ts >= ts - INTERVAL 6 HOUR THEN (epoch_us(ts) - epoch_us(view_ts)) / 1000000.0 END AS age_s
FROM j""")
def asof_ttl(spark, sf_dir):
    """Purchases with the latest strictly earlier view within 6 hours; age and hit flag."""
    t = Tables(spark, sf_dir)
    buys = _events_of(t, "purchase", "event_id", "user_id", "ts")
    views = _events_of(t, "view", "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"))
    j = asof_join(buys, views, ["user_id"], "ts", "view_ts", ["view_value"], ttl_seconds=6 * 3600,
                  strict=True, bucket_seconds=6 * 3600, ts_alias="view_ts")
    age = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("view_ts").cast("timestamp"))) / 1e6
    return j.select("*", F.col("view_ts").isNotNull().alias("hit"), age.alias("age_s"))


@query("multi_view_training_set", sql="""
WITH e AS (SELECT event_id, user_id, ts, CAST(value > 60 AS INTEGER) AS label FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, ts AS click_ts, value AS click_value FROM events WHERE event_type = 'click'),
v AS (SELECT user_id, ts AS view_ts, value AS view_value FROM events WHERE event_type = 'view'),
x AS (SELECT user_id, ts AS error_ts, value AS error_value FROM events WHERE event_type = 'error'),
j1 AS (SELECT e.*, c.click_ts, c.click_value FROM e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts >= c.click_ts),
j2 AS (SELECT j1.*, v.view_ts, v.view_value FROM j1 ASOF LEFT JOIN v ON j1.user_id = v.user_id AND j1.ts >= v.view_ts),
j3 AS (SELECT j2.*, x.error_ts, x.error_value FROM j2 ASOF LEFT JOIN x ON j2.user_id = x.user_id AND j2.ts >= x.error_ts)
SELECT event_id, user_id, ts, label,
       CASE WHEN click_ts >= ts - INTERVAL 1 DAY THEN click_value END AS click_value,
       CASE WHEN view_ts >= ts - INTERVAL 1 DAY THEN view_value END AS view_value,
       CASE WHEN error_ts >= ts - INTERVAL 7 DAY THEN error_value END AS error_value
FROM j3""")
def multi_view_training_set(spark, sf_dir):
    """Purchases (label = value > 60) with three views joined point-in-time:
    last click (TTL 1 d), last view (TTL 1 d), last error (TTL 7 d)."""
    t = Tables(spark, sf_dir)
    ent = _events_of(t, "purchase", "event_id", "user_id", "ts", (F.col("value") > 60).cast("int").alias("label"))
    out = ent
    for kind, ttl in (("click", 1), ("view", 1), ("error", 7)):
        v = _events_of(t, kind, "user_id", F.col("ts").alias("_fts"), F.col("value").alias(f"{kind}_value"))
        out = asof_join(out, v, ["user_id"], "ts", "_fts", [f"{kind}_value"], ttl_seconds=ttl * 86_400,
                        ts_alias=f"_{kind}_ts").drop(f"_{kind}_ts")
    return out


@query("velocity_windows", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY epoch_us("timestamp") RANGE BETWEEN 3600000000 PRECEDING AND 1 PRECEDING) AS velocity_1h,
       count(*) OVER (PARTITION BY user_id ORDER BY epoch_us("timestamp") RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS velocity_24h,
       count(*) OVER (PARTITION BY user_id ORDER BY epoch_us("timestamp") RANGE BETWEEN 604800000000 PRECEDING AND 1 PRECEDING) AS velocity_7d
FROM transactions""")
def velocity_windows(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False).drop("velocity_last_24h")
    return bh.velocity_windows(tx).select("transaction_id", "user_id", "velocity_1h", "velocity_24h", "velocity_7d")


@query("spend_30d", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id,
       count(*) OVER w AS txn_count_30d, round(sum(amount) OVER w, 2) AS total_amount_30d,
       round(sum(amount) OVER w, 2) / count(*) OVER w AS avg_amount_30d,
       round(stddev_samp(amount) OVER w, 6) AS std_amount_30d
FROM transactions
WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us("timestamp") RANGE BETWEEN 2592000000000 PRECEDING AND 1 PRECEDING)""")
def spend_30d(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    out = bh.trailing_spend(tx, days=30)
    # amounts have two decimals: the rounded sum is exact, and the mean is that
    # exact sum over the count (no half-way rounding of the mean)
    total = F.round("total_amount_30d", 2)
    return out.select("transaction_id", "user_id", "txn_count_30d", total.alias("total_amount_30d"),
                      (total / F.col("txn_count_30d")).alias("avg_amount_30d"),
                      F.round("std_amount_30d", 6).alias("std_amount_30d"))


@query("prev_context", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id,
       lag(amount) OVER w AS prev_amount, lag(merchant_category) OVER w AS prev_merchant_category,
       (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w)) / 1000000.0 AS seconds_since_prev
FROM transactions WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp")""")
def prev_context(spark, sf_dir):
    """Previous transaction of the same user (a strict self as-of join, no TTL)."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    left = tx.select("transaction_id", "user_id", "timestamp")
    right = tx.select("user_id", F.col("timestamp").alias("_pts"), F.col("amount").alias("amount"),
                      F.col("merchant_category").alias("merchant_category"))
    j = asof_join(left, right, ["user_id"], "timestamp", "_pts", ["amount", "merchant_category"],
                  strict=True, prefix="prev_", ts_alias="_prev_ts")
    secs = (F.unix_micros(F.col("timestamp").cast("timestamp")) - F.unix_micros(F.col("_prev_ts").cast("timestamp"))) / 1e6
    return j.select("transaction_id", "user_id", "prev_amount", "prev_merchant_category",
                    secs.alias("seconds_since_prev"))


@query("behavioral_features", sql=S.with_(S.TRANSACTIONS) + """
, p AS (SELECT transaction_id, user_id, transaction_hour,
          count(*) OVER (PARTITION BY user_id, merchant_category ORDER BY "timestamp"
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS merchant_familiarity,
          count(*) OVER wu AS n, sum(transaction_hour) OVER wu AS s, sum(transaction_hour * transaction_hour) OVER wu AS s2
        FROM transactions
        WINDOW wu AS (PARTITION BY user_id ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT transaction_id, user_id, merchant_familiarity,
       CASE WHEN n >= 2 AND (s2 - s * s / n) > 0
            THEN round(abs(transaction_hour - s / n) / sqrt((s2 - s * s / n) / (n - 1)), 6) END AS hour_zscore
FROM p""")
def behavioral_features(spark, sf_dir):
    """Prior transactions at the same merchant (familiarity) and how unusual the
    hour is against the user's earlier hours (z-score)."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False) \
        .withColumn("hour2", F.col("transaction_hour") * F.col("transaction_hour"))
    fam = bh.prior_stats(tx.select("transaction_id", "user_id", "merchant_category", "timestamp"),
                         ["user_id", "merchant_category"], "timestamp", []) \
        .select("transaction_id", F.col("prior_count").alias("merchant_familiarity"))
    hrs = bh.prior_stats(tx.select("transaction_id", "user_id", "timestamp", "transaction_hour", "hour2"),
                         ["user_id"], "timestamp", ["transaction_hour", "hour2"])
    n, s, s2 = F.col("prior_count"), F.col("prior_sum_transaction_hour"), F.col("prior_sum_hour2")
    var = (s2 - s * s / n)
    z = F.when((n >= 2) & (var > 0), F.round(F.abs(F.col("transaction_hour") - s / n) / F.sqrt(var / (n - 1)), 6))
    return hrs.select("transaction_id", "user_id", z.alias("hour_zscore")).join(fam, "transaction_id")


@query("merchant_risk", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, merchant_category,
       count(*) OVER w AS prior_n, CAST(coalesce(sum(is_fraud) OVER w, 0) AS BIGINT) AS prior_fraud,
       round((coalesce(sum(is_fraud) OVER w, 0) + 1.0) / (count(*) OVER w + 2.0), 6) AS merchant_risk
FROM transactions
WINDOW w AS (PARTITION BY merchant_category ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def merchant_risk(spark, sf_dir):
    """Laplace-smoothed fraud rate of the merchant over strictly earlier rows.
    Five merchants hold all rows: prefix sums split each one across ranges."""
    tx = ad.transactions(Tables(spark, sf_dir)).select("transaction_id", "merchant_category", "timestamp", "is_fraud")
    p = bh.prior_stats(tx, ["merchant_category"], "timestamp", ["is_fraud"])
    return p.select("transaction_id", "merchant_category", F.col("prior_count").alias("prior_n"),
                    F.col("prior_sum_is_fraud").cast("long").alias("prior_fraud"),
                    F.round((F.col("prior_sum_is_fraud") + 1.0) / (F.col("prior_count") + 2.0), 6).alias("merchant_risk"))


@query("account_age", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id,
       CAST(date_diff('day', CAST(min("timestamp") OVER (PARTITION BY user_id) AS DATE), CAST("timestamp" AS DATE)) AS INTEGER) AS account_age_days
FROM transactions""")
def account_age(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return bh.account_age(tx).select("transaction_id", "user_id", "account_age_days")


@query("latest_run", sql=S.with_(S.RUN_LOG) + """
SELECT experiment, run_id, 'run_' || substr(CAST(run_id AS VARCHAR), 1, 8) AS short_id, start_time, metric FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn FROM run_log)
WHERE rn = 1""")
def latest_run(spark, sf_dir):
    runs = ad.run_log(Tables(spark, sf_dir))
    last = on.latest_per_key(runs, ["experiment"], ["start_time", "run_id"], ["metric"])
    return last.select("experiment", "run_id",
                       F.concat(F.lit("run_"), F.substring(F.col("run_id").cast("string"), 1, 8)).alias("short_id"),
                       "start_time", "metric")


@query("resolve_model_version", sql=S.with_(S.RUN_LOG) + """
, prod AS (SELECT experiment, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn
    FROM run_log WHERE status = 'F') WHERE rn = 1),
lat AS (SELECT experiment, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn
    FROM run_log) WHERE rn = 1)
SELECT lat.experiment, COALESCE(prod.run_id, lat.run_id) AS run_id,
       CASE WHEN prod.run_id IS NOT NULL THEN 'production' ELSE 'latest_run' END AS source
FROM lat LEFT JOIN prod USING (experiment)""")
def resolve_model_version(spark, sf_dir):
    """Latest 'production' (finished) run per experiment, else the latest run."""
    runs = ad.run_log(Tables(spark, sf_dir))
    prod = on.latest_per_key(runs.where(F.col("status") == "F"), ["experiment"], ["start_time", "run_id"], []) \
        .select("experiment", F.col("run_id").alias("prod_id"))
    lat = on.latest_per_key(runs, ["experiment"], ["start_time", "run_id"], []).select("experiment", "run_id")
    j = lat.join(prod, "experiment", "left")
    return j.select("experiment", F.coalesce("prod_id", "run_id").alias("run_id"),
                    F.when(F.col("prod_id").isNotNull(), "production").otherwise("latest_run").alias("source"))


@query("missing_entities", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF)) + """
SELECT count(*) AS n_requests,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.user_id = r.user_id)) AS n_missing,
       round(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.user_id = r.user_id)) / count(*), 6) AS missing_rate
FROM requests r""")
def missing_entities(spark, sf_dir):
    t = Tables(spark, sf_dir)
    req = ad.requests(t)
    miss = req.join(snapshot(t).select("user_id"), "user_id", "left_anti")
    from tessera.functions.ranking import attach_totals
    a = req.agg(F.count(F.lit(1)).alias("n_requests"))
    b = miss.agg(F.count(F.lit(1)).alias("n_missing"))
    return attach_totals(a, b, []).withColumn("missing_rate", F.round(F.col("n_missing") / F.col("n_requests"), 6))


@query("store_consistency", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF, "offline"),
                                       S.snapshot_cte(START, MID, "online")) + """
SELECT count(*) FILTER (WHERE o.user_id IS NULL) AS only_offline,
       count(*) FILTER (WHERE f.user_id IS NULL) AS only_online,
       """ + ",\n       ".join(
    f"count(*) FILTER (WHERE f.user_id IS NOT NULL AND o.user_id IS NOT NULL AND f.{c} IS DISTINCT FROM o.{c}) AS diff_{c}"
    for c in S.FEATURES) + """
FROM offline f FULL OUTER JOIN online o ON f.user_id = o.user_id""")
def store_consistency(spark, sf_dir):
    """Offline recomputation against the (older) online snapshot: keys on one side
    only and, per feature, keys whose values differ (null-safe)."""
    t = Tables(spark, sf_dir)
    off = on.materialize_latest(transactions_in_range(t, START, AS_OF), START, AS_OF)
    onl = on.materialize_latest(transactions_in_range(t, START, MID), START, MID)
    o = onl.select("user_id", *[F.col(c).alias("o_" + c) for c in S.FEATURES]).withColumn("_o", F.lit(True))
    j = off.withColumn("_f", F.lit(True)).join(o, "user_id", "full_outer")
    both = F.col("_f").isNotNull() & F.col("_o").isNotNull()
    return j.agg(F.count(F.when(F.col("_o").isNull(), 1)).alias("only_offline"),
                 F.count(F.when(F.col("_f").isNull(), 1)).alias("only_online"),
                 *[F.count(F.when(both & ~F.col(c).eqNullSafe(F.col("o_" + c)), 1)).alias("diff_" + c)
                   for c in S.FEATURES])


@query("score_distinct", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, round(amount / (amount + 100.0) * (1 + foreign_transaction * 0.1), 6) AS score,
       count(*) OVER (PARTITION BY amount, transaction_hour, merchant_category, foreign_transaction, location_mismatch,
                      device_trust_score, velocity_last_24h, cardholder_age) AS vector_copies
FROM transactions""")
def score_distinct(spark, sf_dir):
    """Score each distinct feature vector once, then join the score back on the
    full feature key (the key is the vector itself, never only its hash)."""
    tx = ad.transactions(Tables(spark, sf_dir))
    feats = S.FEATURES
    uniq = tx.groupBy(*feats).agg(F.count(F.lit(1)).alias("vector_copies"))
    scored = uniq.withColumn("score", F.round(F.col("amount") / (F.col("amount") + 100.0)
                                              * (1 + F.col("foreign_transaction") * 0.1), 6))
    s = scored.select(*[F.col(f).alias("_s_" + f) for f in feats], "score", "vector_copies")
    on_vec = [F.col(f).eqNullSafe(F.col("_s_" + f)) for f in feats]  # null-safe: a missing value is a value
    return tx.join(s, on_vec, "inner").select("transaction_id", "score", "vector_copies")
