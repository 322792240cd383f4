"""Queries: data quality, drift and governance (2.12 GV1-GV17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.ranking import join_groups
from tessera.operators import latency as lt
from tessera.operators import metrics as mt
from tessera.operators import quality as qa
from tessera.operators import sampling as sm
from tessera.plans import sql as S
from tessera.plans.q_metrics import FRAUD_SQL, fraud_scored
from tessera.plans.registry import query
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

SPLIT = "2024-01-15 00:00:00"
FRESH_AS_OF = "2024-01-31 00:00:00"
BINS = 10


def r6(c):
    return F.round(c, 6)


def drift_long(t):
    """events as (side, feature, v): reference = before SPLIT, current = after."""
    e = t.events.select(
        F.when(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"), "ref").otherwise("cur").alias("side"),
        F.col("value").alias("amount"), ad.trust_score().cast("double").alias("trust"),
        F.hour("ts").cast("double").alias("hour"))
    return e.unpivot(["side"], ["amount", "trust", "hour"], "feature", "v")


LONG_SQL = f"""
long AS (
  SELECT CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 'ref' ELSE 'cur' END AS side, 'amount' AS feature, value AS v FROM events
  UNION ALL SELECT CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 'ref' ELSE 'cur' END, 'trust', CAST({S.TRUST} AS DOUBLE) FROM events
  UNION ALL SELECT CASE WHEN ts < TIMESTAMP '{SPLIT}' THEN 'ref' ELSE 'cur' END, 'hour', CAST(hour(ts) AS DOUBLE) FROM events)"""

_QS = ", ".join(f"min(CASE WHEN pos = least(floor(n * {i / BINS!r}), n - 1) THEN v END)" for i in range(1, BINS))

PSI_SQL = f""",
rk AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS pos,
              count(*) OVER (PARTITION BY feature) AS n FROM long WHERE side = 'ref'),
bounds AS (SELECT feature, list_value({_QS}) AS bounds FROM rk GROUP BY feature),
binned AS (SELECT l.side, l.feature, len(list_filter(b.bounds, lambda x: x < l.v)) AS bin FROM long l JOIN bounds b USING (feature)),
cnt AS (SELECT feature, bin, count(*) FILTER (WHERE side = 'ref') AS nr, count(*) FILTER (WHERE side = 'cur') AS nc
        FROM binned GROUP BY ALL),
grid AS (SELECT feature, i AS bin FROM bounds, range(0, {BINS}) r(i)),
sh AS (SELECT g.feature, g.bin,
              greatest(coalesce(c.nr, 0) / sum(coalesce(c.nr, 0)) OVER (PARTITION BY g.feature), 0.0001) AS p,
              greatest(coalesce(c.nc, 0) / sum(coalesce(c.nc, 0)) OVER (PARTITION BY g.feature), 0.0001) AS q
       FROM grid g LEFT JOIN cnt c USING (feature, bin)),
psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM sh GROUP BY feature)"""

KS_SQL = """,
per AS (SELECT feature, v, count(*) FILTER (WHERE side = 'ref') AS a, count(*) FILTER (WHERE side = 'cur') AS b
        FROM long GROUP BY ALL),
cum AS (SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa,
               sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb
        FROM per WINDOW w AS (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, max(abs(fa - fb)) AS ks FROM cum GROUP BY feature)"""


def _sides(t):
    lg = drift_long(t)
    return lg.where(F.col("side") == "ref"), lg.where(F.col("side") == "cur")


@query("expectations", sql=S.with_(S.TRANSACTIONS) + """
SELECT 'column_exists' AS expectation, 'amount' AS "column", CAST(0 AS BIGINT) AS n_failed, true AS success
UNION ALL SELECT 'not_null', 'transaction_id', count(*) FILTER (WHERE transaction_id IS NULL),
                 count(*) FILTER (WHERE transaction_id IS NULL) = 0 FROM transactions
UNION ALL SELECT 'between', 'amount', count(*) FILTER (WHERE amount IS NULL OR NOT (amount BETWEEN 0 AND 400)),
                 count(*) FILTER (WHERE amount IS NULL OR NOT (amount BETWEEN 0 AND 400)) = 0 FROM transactions
UNION ALL SELECT 'in_set', 'merchant_category',
                 count(*) FILTER (WHERE merchant_category IS NULL OR merchant_category NOT IN ('click', 'error', 'purchase', 'signup', 'view')),
                 count(*) FILTER (WHERE merchant_category IS NULL OR merchant_category NOT IN ('click', 'error', 'purchase', 'signup', 'view')) = 0
          FROM transactions""")
def expectations(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return qa.expectations(tx, [
        ("column_exists", "amount", "exists", None),
        ("not_null", "transaction_id", "not_null", None),
        ("between", "amount", "between", (0, 400)),
        ("in_set", "merchant_category", "in_set", ("click", "error", "purchase", "signup", "view")),
    ])


@query("psi_drift", sql=S.with_(LONG_SQL)[:-1] + PSI_SQL + """
SELECT feature, round(psi, 6) AS psi, psi > 0.2 AS alert FROM psi""")
def psi_drift(spark, sf_dir):
    ref, cur = _sides(Tables(spark, sf_dir))
    p = qa.psi(ref, cur, "feature", "v", BINS)
    return p.select("feature", r6("psi").alias("psi"), (F.col("psi") > 0.2).alias("alert"))


@query("ks_drift", sql=S.with_(LONG_SQL)[:-1] + KS_SQL + "SELECT feature, round(ks, 6) AS ks FROM ks")
def ks_drift(spark, sf_dir):
    ref, cur = _sides(Tables(spark, sf_dir))
    return qa.ks_statistic(ref, cur, "feature", "v").select("feature", r6("ks").alias("ks"))


@query("mean_shift", sql=S.with_(LONG_SQL) + """
, r AS (SELECT feature, avg(v) AS m, stddev_samp(v) AS s FROM long WHERE side = 'ref' GROUP BY feature),
c AS (SELECT feature, avg(v) AS m FROM long WHERE side = 'cur' GROUP BY feature)
SELECT feature, round(r.m, 6) AS ref_mean, round(r.s, 6) AS ref_std, round(c.m, 6) AS cur_mean,
       round(abs(c.m - r.m) / r.s, 6) AS shift_sd, abs(c.m - r.m) / r.s > 3 AS alert
FROM r JOIN c USING (feature)""")
def mean_shift(spark, sf_dir):
    ref, cur = _sides(Tables(spark, sf_dir))
    m = qa.mean_shift(ref, cur, "feature", "v")
    return m.select("feature", *[r6(c).alias(c) for c in ("ref_mean", "ref_std", "cur_mean", "shift_sd")], "alert")


@query("drift_report", sql=S.with_(LONG_SQL)[:-1] + PSI_SQL + KS_SQL + """
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, (psi > 0.2 OR ks > 0.1) AS drifted,
       round(avg(CASE WHEN psi > 0.2 OR ks > 0.1 THEN 1.0 ELSE 0.0 END) OVER (), 6) AS share_drifted
FROM psi JOIN ks USING (feature)""")
def drift_report(spark, sf_dir):
    """All monitored columns: PSI, KS, a drift flag, and the share of drifted columns."""
    ref, cur = _sides(Tables(spark, sf_dir))
    j = join_groups(qa.psi(ref, cur, "feature", "v", BINS), qa.ks_statistic(ref, cur, "feature", "v"), ["feature"])
    j = j.withColumn("drifted", (F.col("psi") > 0.2) | (F.col("ks") > 0.1))
    j = qa.share(j, "drifted")
    return j.select("feature", r6("psi").alias("psi"), r6("ks").alias("ks"), "drifted",
                    r6("share_drifted").alias("share_drifted"))


CONF_SQL = "greatest(score, 1 - score)"


@query("confidence_histogram", sql=FRAUD_SQL + f"""
SELECT CAST(least(floor(({CONF_SQL} - 0.5) / 0.1), 4) AS BIGINT) AS bucket, count(*) AS n
FROM scored GROUP BY 1""")
def confidence_histogram(spark, sf_dir):
    sc = fraud_scored(Tables(spark, sf_dir))
    conf = F.greatest(F.col("score"), 1 - F.col("score"))
    b = F.least(F.floor((conf - 0.5) / 0.1), F.lit(4)).cast("long")
    return sc.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("low_confidence", sql=FRAUD_SQL + f"""
SELECT transaction_id, {CONF_SQL} AS confidence FROM scored WHERE {CONF_SQL} < 0.6""")
def low_confidence(spark, sf_dir):
    sc = fraud_scored(Tables(spark, sf_dir))
    conf = F.greatest(F.col("score"), 1 - F.col("score"))
    return sc.select("transaction_id", conf.alias("confidence")).where(F.col("confidence") < 0.6)


def _weekly_f1(t):
    tx = ad.transactions(t, with_velocity=False)
    score = F.round(F.col("amount") / (F.col("amount") + 100.0), 6)
    sc = tx.select(F.window("timestamp", "7 days").start.alias("week"), "is_fraud",
                   (score > 0.5).cast("int").alias("predicted"))
    b = mt.binary_metrics(sc, "is_fraud", "predicted", ["week"])
    from pyspark.sql import Window
    w = Window.orderBy("week")  # one row per week: a bounded, time-sized window
    return b.select("week", r6("f1").alias("f1")).withColumn("prev_f1", F.lag("f1").over(w)) \
        .withColumn("f1_change", r6(F.col("f1") - F.col("prev_f1")))


WEEKLY_SQL = f"""
, wk AS (SELECT time_bucket(INTERVAL 7 DAY, "timestamp", TIMESTAMP '1970-01-01') AS week, is_fraud,
                CAST(round(amount / (amount + 100.0), 6) > 0.5 AS INTEGER) AS predicted FROM transactions),
c AS (SELECT week, count(*) FILTER (WHERE is_fraud = 1 AND predicted = 1) AS tp,
             count(*) FILTER (WHERE is_fraud <> 1 AND predicted = 1) AS fp,
             count(*) FILTER (WHERE is_fraud = 1 AND predicted <> 1) AS fn FROM wk GROUP BY week),
f AS (SELECT week, round(CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0.0 END, 6) AS f1 FROM c),
fw AS (SELECT week, f1, lag(f1) OVER (ORDER BY week) AS prev_f1 FROM f)"""


@query("concept_drift", sql=S.with_(S.TRANSACTIONS)[:-1] + WEEKLY_SQL + """
SELECT week, f1, prev_f1, round(f1 - prev_f1, 6) AS f1_change FROM fw""")
def concept_drift(spark, sf_dir):
    """F1 of the scorer per event-time week and its change against the week before."""
    return _weekly_f1(Tables(spark, sf_dir))


@query("feature_freshness", sql=S.with_(S.TRANSACTIONS) + f"""
SELECT user_id, max("timestamp") AS last_update,
       round((epoch_us(TIMESTAMP '{FRESH_AS_OF}') - epoch_us(max("timestamp"))) / 3.6e9, 6) AS age_hours,
       (epoch_us(TIMESTAMP '{FRESH_AS_OF}') - epoch_us(max("timestamp"))) / 3.6e9 > 24 AS stale
FROM transactions GROUP BY user_id""")
def feature_freshness(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    f = qa.freshness(tx, "user_id", "timestamp", FRESH_AS_OF)
    return f.select("user_id", "last_update", r6("age_hours").alias("age_hours"), "stale")


@query("outliers", sql=S.with_(S.TRANSACTIONS) + """
, st AS (SELECT merchant_category, avg(amount) AS m, stddev_samp(amount) AS s,
                quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM transactions GROUP BY 1)
SELECT t.transaction_id, t.merchant_category, t.amount,
       CASE WHEN st.s > 0 THEN abs(t.amount - st.m) / st.s > 3 ELSE false END AS z_outlier,
       (t.amount < st.q1 - 1.5 * (st.q3 - st.q1) OR t.amount > st.q3 + 1.5 * (st.q3 - st.q1)) AS iqr_outlier
FROM transactions t JOIN st ON t.merchant_category IS NOT DISTINCT FROM st.merchant_category""")
def outliers(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return qa.outliers(tx, "merchant_category", "amount", "transaction_id")


@query("ab_test", sql=FRAUD_SQL + """
, a AS (SELECT CASE WHEN ('0x' || substr(md5(t.user_id), 1, 8))::BIGINT % 100 < 80 THEN 'champion' ELSE 'challenger' END AS arm,
               s.predicted = s.is_fraud AS ok
        FROM scored s JOIN transactions t USING (transaction_id)),
g AS (SELECT count(*) FILTER (WHERE arm = 'champion') AS n_c, count(*) FILTER (WHERE arm = 'challenger') AS n_t,
             count(*) FILTER (WHERE arm = 'champion' AND ok) AS s_c, count(*) FILTER (WHERE arm = 'challenger' AND ok) AS s_t FROM a),
z AS (SELECT *, s_c / n_c AS pc, s_t / n_t AS pt, (s_c + s_t) / (n_c + n_t) AS pool FROM g)
SELECT n_c, n_t, round(pc, 6) AS rate_control, round(pt, 6) AS rate_treatment, round((pt - pc) / pc, 6) AS lift,
       round((pt - pc) / sqrt(pool * (1 - pool) * (1 / n_c + 1 / n_t)), 6) AS z,
       ((pt - pc) / pc > 0.02 AND abs((pt - pc) / sqrt(pool * (1 - pool) * (1 / n_c + 1 / n_t))) > 1.96) AS promote
FROM z""")
def ab_test(spark, sf_dir):
    """Champion vs challenger arms (sticky by user): accuracy lift and two-proportion z."""
    t = Tables(spark, sf_dir)
    sc = fraud_scored(t).join(ad.transactions(t, with_velocity=False).select("transaction_id", "user_id"),
                              "transaction_id")
    arms = sm.traffic_split(sc, "user_id", [("champion", 80), ("challenger", 20)]) \
        .withColumn("ok", F.col("predicted") == F.col("is_fraud"))
    r = qa.two_proportion_test(arms, "arm", "ok", "champion", "challenger")
    return r.select("n_c", "n_t", *[r6(c).alias(c) for c in ("rate_control", "rate_treatment", "lift", "z")], "promote")


@query("promotion_gate", sql=FRAUD_SQL + """
, per AS (SELECT score, count(*) FILTER (WHERE is_fraud = 1) AS pos, count(*) FILTER (WHERE is_fraud <> 1) AS neg FROM scored GROUP BY score),
cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM per),
auc AS (SELECT sum(pos * (nb + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc FROM cum),
c AS (SELECT count(*) FILTER (WHERE is_fraud = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE is_fraud <> 1 AND predicted = 1) AS fp,
             count(*) FILTER (WHERE is_fraud = 1 AND predicted <> 1) AS fn FROM scored),
f AS (SELECT CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0.0 END AS f1 FROM c)
SELECT round(auc, 6) AS auc, round(f1, 6) AS f1,
       CASE WHEN auc > 0.90 AND f1 > 0.85 THEN 'promote' ELSE 'hold' END AS decision FROM auc, f""")
def promotion_gate(spark, sf_dir):
    """Promote only when AUC > 0.90 and F1 > 0.85."""
    sc = fraud_scored(Tables(spark, sf_dir))
    a = mt.roc_auc(sc, "is_fraud", "score").select("auc")
    b = mt.binary_metrics(sc, "is_fraud", "predicted").select("f1")
    j = qa.attach_totals(a, b, [])
    dec = F.when((F.col("auc") > 0.90) & (F.col("f1") > 0.85), "promote").otherwise("hold")
    return j.select(r6("auc").alias("auc"), r6("f1").alias("f1"), dec.alias("decision"))


@query("rollback_triggers", sql=S.with_(S.TRANSACTIONS, S.REQUEST_LOG)[:-1] + WEEKLY_SQL + """,
last AS (SELECT f1, prev_f1 FROM fw ORDER BY week DESC LIMIT 1),
sr AS (SELECT endpoint, round(100.0 * count(*) FILTER (WHERE NOT success) / count(*), 6) AS error_rate FROM request_log GROUP BY endpoint),
p AS (SELECT endpoint, min(CASE WHEN pos = least(floor(n * 0.99), n - 1) THEN latency_ms END) AS p99 FROM (
        SELECT endpoint, latency_ms, row_number() OVER (PARTITION BY endpoint ORDER BY latency_ms) - 1 AS pos,
               count(*) OVER (PARTITION BY endpoint) AS n FROM request_log WHERE success) GROUP BY endpoint)
SELECT sr.endpoint, sr.error_rate, p.p99, round((last.prev_f1 - last.f1) / last.prev_f1, 6) AS f1_drop,
       (sr.error_rate > 5 OR coalesce(p.p99 > 10, false) OR coalesce((last.prev_f1 - last.f1) / last.prev_f1 > 0.05, false)) AS rollback
FROM sr LEFT JOIN p ON sr.endpoint IS NOT DISTINCT FROM p.endpoint LEFT JOIN last ON true""")
def rollback_triggers(spark, sf_dir):
    """Roll back when error rate > 5 %, P99 > 10 ms, or F1 fell > 5 % week over week."""
    t = Tables(spark, sf_dir)
    wk = _weekly_f1(t)
    last = wk.orderBy(F.col("week").desc()).limit(1).select(
        r6((F.col("prev_f1") - F.col("f1")) / F.col("prev_f1")).alias("f1_drop"),
        ((F.col("prev_f1") - F.col("f1")) / F.col("prev_f1") > 0.05).alias("_f1_bad"))
    return rollback(ad.request_log(t), last)


def rollback(log, last):
    """Every endpoint of ``log``, also one whose requests all failed (no P99: the error rate
    alone decides) and a null one; ``last`` holds one row of f1_drop and _f1_bad or none."""
    sr = lt.success_rate(log, ["endpoint"]).select("endpoint", F.round(100.0 - F.col("success_rate"), 6).alias("error_rate"))
    p = lt.latency_quantiles(log.where("success"), ["endpoint"], qs={"p99": 0.99})
    j = qa.attach_totals(join_groups(sr, p, ["endpoint"], "left"), last, [])
    bad = lambda c: F.coalesce(c, F.lit(False))
    rb = (F.col("error_rate") > 5) | bad(F.col("p99") > 10) | bad(F.col("_f1_bad"))
    return j.select("endpoint", "error_rate", "p99", "f1_drop", rb.alias("rollback"))


RET_AS_OF = "1998-12-01 00:00:00"


@query("retention_classes", sql=f"""
SELECT CASE WHEN d <= 30 THEN 'hot' WHEN d <= 90 THEN 'warm' WHEN d <= 365 THEN 'cold' ELSE 'expired' END AS retention_class,
       count(*) AS n_rows
FROM (SELECT date_diff('day', CAST(l_shipdate AS DATE), DATE '{RET_AS_OF[:10]}') AS d FROM lineitem) GROUP BY 1""")
def retention_classes(spark, sf_dir):
    """Age class of each line item (30 / 90 / 365-day cuts from the as-of date)."""
    li = Tables(spark, sf_dir).lineitem
    d = F.datediff(F.lit(RET_AS_OF[:10]).cast("date"), F.to_date("l_shipdate"))
    cls = F.when(d <= 30, "hot").when(d <= 90, "warm").when(d <= 365, "cold").otherwise("expired")
    return li.groupBy(cls.alias("retention_class")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("period_change_alert", sql="""
WITH m AS (SELECT date_trunc('month', o_orderdate) AS period, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT period, total, lag(total) OVER (ORDER BY period) AS prev_total,
       round((total - lag(total) OVER (ORDER BY period)) / lag(total) OVER (ORDER BY period), 6) AS change,
       coalesce(abs((total - lag(total) OVER (ORDER BY period)) / lag(total) OVER (ORDER BY period)) > 0.2, false) AS alert
FROM m""")
def period_change_alert(spark, sf_dir):
    """Monthly order value against the month before; alert on a change above 20 %."""
    o = Tables(spark, sf_dir).orders.select(
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("period"), "o_totalprice")
    per = o.groupBy("period").agg(F.round(F.sum("o_totalprice"), 2).alias("amount"))
    p = qa.period_change(per, "period", "amount", 0.2)
    return p.select("period", "total", "prev_total", r6("change").alias("change"), "alert")


@query("weekly_report", sql=S.with_(S.REQUEST_LOG) + """
SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS week, count(*) AS requests,
       round(avg(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS success_rate, round(avg(latency_ms), 6) AS avg_latency_ms,
       round(avg(CASE WHEN latency_ms / (latency_ms + 100.0) > 0.5 THEN 1.0 ELSE 0.0 END), 6) AS fraud_share
FROM request_log GROUP BY 1""")
def weekly_report(spark, sf_dir):
    log = ad.request_log(Tables(spark, sf_dir))
    g = log.groupBy(F.window("ts", "7 days").start.alias("week")).agg(
        F.count(F.lit(1)).alias("requests"), r6(F.avg(F.col("success").cast("double"))).alias("success_rate"),
        r6(F.avg("latency_ms")).alias("avg_latency_ms"),
        r6(F.avg((F.col("latency_ms") / (F.col("latency_ms") + 100.0) > 0.5).cast("double"))).alias("fraud_share"))
    return g


def _lineage_sql() -> str:
    from tessera.plans.q_text import BOOK_CTES, SENT_CTES
    fraud = " UNION ALL ".join(f"SELECT '{f}' AS feature, 'fraud' AS model" for f in S.FEATURES)
    return S.with_(*BOOK_CTES, *SENT_CTES[1:]).replace("WITH ", "WITH " + S.SENTIMENT.strip() + ",", 1) + f"""
, uses AS (SELECT term AS feature, 'recommendation' AS model FROM bvocab
           UNION ALL SELECT term, 'sentiment' FROM svocab
           UNION ALL {fraud})
SELECT feature, list(DISTINCT model ORDER BY model) AS models, count(DISTINCT model) AS n_models
FROM uses GROUP BY feature"""


@query("feature_lineage", sql=_lineage_sql())
def feature_lineage(spark, sf_dir):
    """Feature -> models that read it: each model's inputs (the fraud model's
    eight columns, the fitted vocabularies of the two text models) as
    (model, feature) rows, grouped by feature."""
    from tessera.plans.q_text import book_vocabulary, sentiment_vocab
    t = Tables(spark, sf_dir)
    bv, sv = book_vocabulary(t)[1], sentiment_vocab(t)
    # the fraud model's inputs are its eight typed columns, whatever the vocabularies hold
    fraud = spark.createDataFrame([("fraud", f) for f in S.FEATURES], "model string, feature string")
    uses = (bv.select(F.lit("recommendation").alias("model"), F.col("term").alias("feature"))
            .unionByName(sv.select(F.lit("sentiment").alias("model"), F.col("term").alias("feature")))
            .unionByName(fraud))
    return uses.groupBy("feature").agg(F.sort_array(F.collect_set("model")).alias("models"),
                                       F.countDistinct("model").alias("n_models"))
