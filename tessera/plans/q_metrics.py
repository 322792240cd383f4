"""Queries: evaluation metrics (AG25-AG36) and sampling/splitting (2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import md5_key
from tessera.operators import metrics as mt
from tessera.operators import sampling as sm
from tessera.operators.features import SENTIMENT_NAMES
from tessera.plans import sql as S
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

LABELS = [-1, 0, 1]


def r6(c):
    return F.round(c, 6)


def sentiment_scored(t):
    """Labelled texts with a rule scorer's prediction (text length bands)."""
    s = ad.sentiment_texts(t)
    n = F.length("clean_text")
    pred = F.when(n < 800, -1).when(n < 3000, 0).otherwise(1)
    return s.select("doc_id", "category", pred.alias("predicted"))


SENT_SQL = S.with_(S.SENTIMENT) + """
, scored AS (SELECT doc_id, category,
                    CASE WHEN length(clean_text) < 800 THEN -1 WHEN length(clean_text) < 3000 THEN 0 ELSE 1 END AS predicted
             FROM sentiment)
"""


def fraud_scored(t):
    tx = ad.transactions(t, with_velocity=False)
    score = F.round(F.col("amount") / (F.col("amount") + 100.0), 6)
    return tx.select("transaction_id", "is_fraud", "foreign_transaction", "merchant_category",
                     score.alias("score"), (score > 0.5).cast("int").alias("predicted"))


FRAUD_SQL = S.with_(S.TRANSACTIONS) + """
, scored AS (SELECT transaction_id, is_fraud, foreign_transaction, merchant_category,
                    round(amount / (amount + 100.0), 6) AS score,
                    CAST(round(amount / (amount + 100.0), 6) > 0.5 AS INTEGER) AS predicted
             FROM transactions)
"""


def _per_class_sql(src="scored", actual="category", pred="predicted"):
    parts = []
    for lab in LABELS:
        parts.append(f"""SELECT {lab} AS label,
  count(*) FILTER (WHERE {actual} = {lab} AND {pred} = {lab}) AS tp,
  count(*) FILTER (WHERE {pred} = {lab}) AS pp, count(*) FILTER (WHERE {actual} = {lab}) AS support FROM {src}""")
    return "\nUNION ALL\n".join(parts)


PC_SQL = f""", pc0 AS ({_per_class_sql()}),
pc AS (SELECT label, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM pc0),
pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score FROM pc)
"""


@query("confusion_matrix", sql=SENT_SQL + """
SELECT category, count(*) FILTER (WHERE predicted = -1) AS pred_m1, count(*) FILTER (WHERE predicted = 0) AS pred_0,
       count(*) FILTER (WHERE predicted = 1) AS pred_1 FROM scored GROUP BY category""")
def confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(sentiment_scored(Tables(spark, sf_dir)), "category", "predicted", LABELS)


@query("per_class_metrics", sql=SENT_SQL + PC_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
       support FROM pcf""")
def per_class_metrics(spark, sf_dir):
    pc = mt.per_class(sentiment_scored(Tables(spark, sf_dir)), "category", "predicted", LABELS)
    return pc.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                     r6("f1_score").alias("f1_score"), "support")


@query("macro_metrics", sql=SENT_SQL + PC_SQL + """
SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1_score), 6) AS macro_f1, round(sum(tp) / sum(support), 6) AS accuracy FROM pcf""")
def macro_metrics(spark, sf_dir):
    m = mt.macro_metrics(sentiment_scored(Tables(spark, sf_dir)), "category", "predicted", LABELS)
    return m.select(*[r6(c).alias(c) for c in m.columns])


REPORT_SQL = SENT_SQL + PC_SQL + """
SELECT CASE label WHEN -1 THEN 'Negative' WHEN 0 THEN 'Neutral' ELSE 'Positive' END AS "row",
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM pcf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf"""


@query("classification_report", sql=REPORT_SQL)
def classification_report(spark, sf_dir):
    """Report rows written as an artifact (Parquet) and read back."""
    rep = mt.classification_report(sentiment_scored(Tables(spark, sf_dir)), "category", "predicted",
                                   LABELS, SENTIMENT_NAMES)
    rep = rep.select("row", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score")],
                     F.col("support").cast("long").alias("support"))
    path = scratch_path(spark, "classification-report")
    rep.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


BIN_SQL = """
SELECT {g} count(*) FILTER (WHERE is_fraud = 1 AND predicted = 1) AS tp,
       count(*) FILTER (WHERE is_fraud <> 1 AND predicted = 1) AS fp,
       count(*) FILTER (WHERE is_fraud = 1 AND predicted <> 1) AS fn,
       count(*) FILTER (WHERE is_fraud <> 1 AND predicted <> 1) AS tn FROM scored {gb}"""


def _bin_select(src):
    return f"""SELECT *, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0
            THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0.0 END, 6) AS f1,
       round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM {src}"""


@query("binary_metrics", sql=FRAUD_SQL + ", b AS (" + BIN_SQL.format(g="", gb="") + ")\n" + _bin_select("b"))
def binary_metrics(spark, sf_dir):
    b = mt.binary_metrics(fraud_scored(Tables(spark, sf_dir)), "is_fraud", "predicted")
    return b.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


AUC_SQL = """
, per AS (SELECT {g} score, count(*) FILTER (WHERE is_fraud = 1) AS pos, count(*) FILTER (WHERE is_fraud <> 1) AS neg
          FROM scored GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {p} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM per)
SELECT {g} CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) END AS auc
FROM cum {gb}"""


@query("roc_auc", sql=FRAUD_SQL + AUC_SQL.format(g="", p="1", gb=""))
def roc_auc(spark, sf_dir):
    return mt.roc_auc(fraud_scored(Tables(spark, sf_dir)), "is_fraud", "score")


@query("split_rate_check", sql=FRAUD_SQL + """
, s AS (SELECT transaction_id, is_fraud,
               row_number() OVER (PARTITION BY is_fraud ORDER BY md5(transaction_id || '|42')) AS rn,
               count(*) OVER (PARTITION BY is_fraud) AS n FROM scored),
t AS (SELECT is_fraud, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM s),
r AS (SELECT split, avg(is_fraud) AS rate, count(*) AS n FROM t GROUP BY split)
SELECT round(max(rate) FILTER (WHERE split = 'train'), 6) AS train_rate, round(max(rate) FILTER (WHERE split = 'test'), 6) AS test_rate,
       abs(max(rate) FILTER (WHERE split = 'train') - max(rate) FILTER (WHERE split = 'test')) < 0.01 AS balanced FROM r""")
def split_rate_check(spark, sf_dir):
    """Stratified 80/20 split keeps the fraud rate within 0.01 across splits."""
    sp = sm.stratified_split(fraud_scored(Tables(spark, sf_dir)), "transaction_id", "is_fraud", 0.2, 42)
    r = sm.class_rate_by_split(sp, "is_fraud")
    tr = F.max(F.when(F.col("split") == "train", F.col("rate")))
    te = F.max(F.when(F.col("split") == "test", F.col("rate")))
    return r.agg(r6(tr).alias("train_rate"), r6(te).alias("test_rate"), (F.abs(tr - te) < 0.01).alias("balanced"))


@query("stratified_split", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, is_fraud, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT transaction_id, is_fraud,
         row_number() OVER (PARTITION BY is_fraud ORDER BY md5(transaction_id || '|42')) AS rn,
         count(*) OVER (PARTITION BY is_fraud) AS n FROM transactions)""")
def stratified_split(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False).select("transaction_id", "is_fraud")
    return sm.stratified_split(tx, "transaction_id", "is_fraud", 0.2, 42)


@query("sample_n", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, amount FROM transactions ORDER BY md5(transaction_id || '|42') LIMIT 2000""")
def sample_n(spark, sf_dir):
    """Seeded sample of min(2000, n) rows."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False).select("transaction_id", "amount")
    return sm.sample_n(tx, "transaction_id", 2000, 42)


@query("traffic_split", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id,
       CASE WHEN ('0x' || substr(md5(user_id), 1, 8))::BIGINT % 100 < 80 THEN 'champion' ELSE 'challenger' END AS arm
FROM transactions""")
def traffic_split(spark, sf_dir):
    """Sticky 80/20 split by user: every transaction of a user goes to one arm."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False).select("transaction_id", "user_id")
    return sm.traffic_split(tx, "user_id", [("champion", 80), ("challenger", 20)])


@query("slice_metrics", sql=FRAUD_SQL + """
, b AS (""" + BIN_SQL.format(g="'foreign_transaction' AS slice, CAST(foreign_transaction AS VARCHAR) AS slice_value,",
                             gb="GROUP BY 1, 2") + """
        UNION ALL """ + BIN_SQL.format(g="'merchant_category', merchant_category,", gb="GROUP BY 1, 2") + """),
per AS (SELECT 'foreign_transaction' AS slice, CAST(foreign_transaction AS VARCHAR) AS slice_value, score,
               count(*) FILTER (WHERE is_fraud = 1) AS pos, count(*) FILTER (WHERE is_fraud <> 1) AS neg FROM scored GROUP BY ALL
        UNION ALL
        SELECT 'merchant_category', merchant_category, score,
               count(*) FILTER (WHERE is_fraud = 1), count(*) FILTER (WHERE is_fraud <> 1) FROM scored GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY slice, slice_value ORDER BY score
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM per),
a AS (SELECT slice, slice_value, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
             THEN sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) END AS auc FROM cum GROUP BY ALL),
m AS (""" + _bin_select("b") + """)
SELECT m.slice, m.slice_value, m.tp + m.fp + m.fn + m.tn AS n, m.precision, m.recall, m.f1, a.auc
FROM m JOIN a ON m.slice = a.slice AND m.slice_value IS NOT DISTINCT FROM a.slice_value""")
def slice_metrics(spark, sf_dir):
    """Binary metrics and AUC per slice (foreign transactions, merchant): one scan."""
    m = mt.slice_metrics(fraud_scored(Tables(spark, sf_dir)), "is_fraud", "predicted", "score",
                         [["foreign_transaction"], ["merchant_category"]])
    return m.select("slice", F.get("slice_value", F.lit(0)).alias("slice_value"), "n",
                    *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "auc")


COST_PER_1K = 0.25


@query("business_metrics", sql=FRAUD_SQL + f"""
, c AS (SELECT count(*) FILTER (WHERE is_fraud = 1 AND predicted = 1) AS tp,
               count(*) FILTER (WHERE is_fraud <> 1 AND predicted = 1) AS fp,
               count(*) FILTER (WHERE is_fraud = 1 AND predicted <> 1) AS fn,
               count(*) FILTER (WHERE is_fraud <> 1 AND predicted <> 1) AS tn FROM scored)
SELECT round(fp / (fp + tn), 6) AS fpr, round(fn / (fn + tp), 6) AS fnr, round(tp / (tp + fn), 6) AS detection_rate,
       round({COST_PER_1K} / 1000.0, 9) AS cost_per_prediction, tp + fp + fn + tn AS n FROM c""")
def business_metrics(spark, sf_dir):
    """False-positive / false-negative rates, detection rate, cost per prediction."""
    b = mt.binary_metrics(fraud_scored(Tables(spark, sf_dir)), "is_fraud", "predicted")
    return b.select(r6(F.col("fp") / (F.col("fp") + F.col("tn"))).alias("fpr"),
                    r6(F.col("fn") / (F.col("fn") + F.col("tp"))).alias("fnr"),
                    r6(F.col("tp") / (F.col("tp") + F.col("fn"))).alias("detection_rate"),
                    F.round(F.lit(COST_PER_1K) / 1000.0, 9).alias("cost_per_prediction"),
                    (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"))


@query("scorer_agreement", sql=S.with_(S.TRANSACTIONS) + """
, a AS (SELECT transaction_id, round(amount / (amount + 100.0), 6) AS s FROM transactions),
b AS (SELECT transaction_id, round(1 - device_trust_score / 100.0, 6) AS s FROM transactions)
SELECT count(*) AS n, round(avg(CASE WHEN (a.s > 0.5) = (b.s > 0.5) THEN 1.0 ELSE 0.0 END), 6) AS agreement_rate,
       round(avg(abs(a.s - b.s)), 6) AS mean_abs_diff
FROM a JOIN b USING (transaction_id)""")
def scorer_agreement(spark, sf_dir):
    """Two scorers on the same transactions: decision agreement and mean |difference|."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    a = tx.select("transaction_id", F.round(F.col("amount") / (F.col("amount") + 100.0), 6).alias("score"))
    b = tx.select("transaction_id", F.round(1 - F.col("device_trust_score") / 100.0, 6).alias("score"))
    m = mt.scorer_agreement(a, b, "transaction_id", "score")
    return m.select("n", r6("agreement_rate").alias("agreement_rate"), r6("mean_abs_diff").alias("mean_abs_diff"))
