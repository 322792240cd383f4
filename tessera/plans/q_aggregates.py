"""Queries: profiling aggregates, set operations, sorts (2.5 AG1-AG10, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as ft
from tessera.operators import profiling as pr
from tessera.operators.sampling import stratified_split
from tessera.plans import sql as S
from tessera.plans.q_online import AS_OF, START, snapshot
from tessera.plans.registry import query
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

NUMERIC = ["amount", "transaction_hour", "foreign_transaction", "location_mismatch",
           "device_trust_score", "velocity_last_24h", "cardholder_age"]


@query("class_balance", sql=S.with_(S.TRANSACTIONS) + """
SELECT count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_positive,
       round(avg(is_fraud), 6) AS positive_rate, round(1 - avg(is_fraud), 6) AS negative_rate
FROM transactions""")
def class_balance(spark, sf_dir):
    return pr.class_balance(ad.transactions(Tables(spark, sf_dir)), "is_fraud")


@query("label_distribution", sql=S.with_(S.SENTIMENT, S.SECOND_CORPUS) + """
SELECT category, CASE category WHEN -1 THEN 'Negative' WHEN 0 THEN 'Neutral' WHEN 1 THEN 'Positive' END AS name,
       count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM (SELECT clean_text AS t, category FROM sentiment UNION ALL SELECT clean_comment, category FROM comments)
WHERE t IS NOT NULL AND category IS NOT NULL GROUP BY category""")
def label_distribution(spark, sf_dir):
    """Labels of both corpora together, rows without text or label left out."""
    t = Tables(spark, sf_dir)
    s = ad.sentiment_texts(t).select(F.col("clean_text").alias("text"), "category").unionByName(
        ad.second_corpus(t).select(F.col("clean_comment").alias("text"), "category")).na.drop("any")
    s = s.withColumn("category", F.col("category").cast("int"))
    return pr.value_counts(s, "category").withColumn("name", ft.label_name("category"))


@query("top_categories", sql=S.with_(S.BOOKS) + """
SELECT categories, count(*) AS n FROM books GROUP BY categories ORDER BY n DESC, categories LIMIT 5""")
def top_categories(spark, sf_dir):
    return pr.top_values(ad.books(Tables(spark, sf_dir)), "categories", 5)


@query("user_activity", sql=S.with_(S.TRANSACTIONS) + """
SELECT count(*) AS total_transactions, count(DISTINCT user_id) AS distinct_users,
       round(count(*) * 1.0 / count(DISTINCT user_id), 6) AS avg_per_user,
       (SELECT max(c) FROM (SELECT count(*) AS c FROM transactions GROUP BY user_id)) AS max_per_user,
       (SELECT min(c) FROM (SELECT count(*) AS c FROM transactions GROUP BY user_id)) AS min_per_user
FROM transactions""")
def user_activity(spark, sf_dir):
    """Two-level aggregation: per user, then over users (no count-distinct pass)."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    per_user = tx.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
    return per_user.agg(F.sum("c").alias("total_transactions"),
                        F.count(F.lit(1)).alias("distinct_users"),
                        F.round(F.sum("c") / F.count(F.lit(1)), 6).alias("avg_per_user"),
                        F.max("c").alias("max_per_user"), F.min("c").alias("min_per_user"))


@query("top_users", sql=S.with_(S.TRANSACTIONS) + """
SELECT user_id, count(*) AS n FROM transactions GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5""")
def top_users(spark, sf_dir):
    return pr.top_values(ad.transactions(Tables(spark, sf_dir), with_velocity=False), "user_id", 5)


def _describe_sql():
    parts = []
    for c in NUMERIC:
        parts.append(f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM transactions""")
    return S.with_(S.TRANSACTIONS) + "\nUNION ALL\n".join(parts)


@query("describe_features", sql=_describe_sql())
def describe_features(spark, sf_dir):
    d = pr.describe(ad.transactions(Tables(spark, sf_dir)), NUMERIC)
    return d.select("feature", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")],
                    "min", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("text_length_stats", sql=S.with_(S.BOOKS) + """
, w AS (SELECT regexp_replace(lower(
           coalesce(title,'') || ' ' || coalesce(title,'') || ' ' || coalesce(subtitle,'') || ' ' ||
           coalesce(authors,'') || ' ' || coalesce(authors,'') || ' ' ||
           coalesce(categories,'') || ' ' || coalesce(categories,'') || ' ' || coalesce(categories,'') || ' ' ||
           coalesce(search_category,'') || ' ' || coalesce(search_category,'') || ' ' ||
           coalesce(description,'')), '^\\s+|\\s+$', '', 'g') AS t FROM books)
SELECT count(*) AS n_books, round(avg(length(t)), 4) AS avg_feature_length FROM w WHERE length(t) > 10""")
def text_length_stats(spark, sf_dir):
    w = ft.weighted_text(ad.books(Tables(spark, sf_dir)))
    return w.agg(F.count(F.lit(1)).alias("n_books"),
                 F.round(F.avg(F.length("combined_features")), 4).alias("avg_feature_length"))


REQ_COLS = ["transaction_id", "user_id"] + S.FEATURES


@query("null_profile", sql=S.with_(S.REQUESTS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, "
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0 AS offender FROM requests" for c in REQ_COLS))
def null_profile(spark, sf_dir):
    return pr.null_profile(ad.requests(Tables(spark, sf_dir)), REQ_COLS)


@query("label_domain_check", sql=S.with_(S.TRANSACTIONS, S.SENTIMENT) + """
SELECT 'is_fraud' AS label, CAST(value AS BIGINT) AS value, value IN (0, 1) AS in_domain
FROM (SELECT DISTINCT is_fraud AS value FROM transactions)
UNION ALL
SELECT 'category', CAST(value AS BIGINT), value IN (0, 1)
FROM (SELECT DISTINCT category AS value FROM sentiment)""")
def label_domain_check(spark, sf_dir):
    """Distinct label values and whether each lies in {0, 1} (a subset test)."""
    t = Tables(spark, sf_dir)
    a = pr.domain_check(ad.transactions(t, with_velocity=False), "is_fraud", [0, 1]) \
        .select(F.lit("is_fraud").alias("label"), F.col("value").cast("long").alias("value"), "in_domain")
    b = pr.domain_check(ad.sentiment_texts(t), "category", [0, 1]) \
        .select(F.lit("category").alias("label"), F.col("value").cast("long").alias("value"), "in_domain")
    return a.unionByName(b)


@query("finite_check", sql=S.with_(S.TRANSACTIONS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) "
    f"OR isinf(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END) AS BIGINT) AS non_finite, "
    f"sum(CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END) = 0 "
    f"AS finite FROM transactions" for c in NUMERIC))
def finite_check(spark, sf_dir):
    return pr.finite_check(ad.transactions(Tables(spark, sf_dir)), NUMERIC)


REQUIRED = ["transaction_id", "amount", "merchant_category", "is_fraud", "user_id", "description"]


@query("required_columns", sql=S.with_(S.TRANSACTIONS) + """
SELECT 'transaction_id' AS "column", count(transaction_id) AS non_null, true AS present FROM transactions
UNION ALL SELECT 'amount', count(amount), true FROM transactions
UNION ALL SELECT 'merchant_category', count(merchant_category), true FROM transactions
UNION ALL SELECT 'is_fraud', count(is_fraud), true FROM transactions
UNION ALL SELECT 'user_id', count(user_id), true FROM transactions
UNION ALL SELECT 'description', CAST(NULL AS BIGINT), false""")
def required_columns(spark, sf_dir):
    return pr.required_columns(ad.transactions(Tables(spark, sf_dir), with_velocity=False), REQUIRED)


UNION_SQL = S.with_(S.SENTIMENT, S.SECOND_CORPUS) + """
SELECT clean_text AS text, category, 'documents' AS corpus FROM sentiment
WHERE clean_text IS NOT NULL AND category IS NOT NULL
UNION ALL
SELECT clean_comment AS text, category, 'conversations' AS corpus FROM comments
WHERE clean_comment IS NOT NULL AND category IS NOT NULL"""


def union_corpora_df(t):
    a = ad.sentiment_texts(t).select("clean_text", "category").na.drop("any") \
        .withColumnRenamed("clean_text", "text").withColumn("corpus", F.lit("documents"))
    b = ad.second_corpus(t).select("clean_comment", "category").na.drop("any") \
        .withColumnRenamed("clean_comment", "text").withColumn("corpus", F.lit("conversations"))
    return a.unionByName(b)


@query("union_corpora", sql=UNION_SQL)
def union_corpora(spark, sf_dir):
    return union_corpora_df(Tables(spark, sf_dir))


@query("union_missing_cols", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + """
SELECT user_id, amount, device_trust_score, CAST(NULL AS VARCHAR) AS description FROM snapshot
UNION ALL
SELECT 'test_' || user_id, amount, device_trust_score, 'scenario user ' || user_id FROM snapshot
WHERE CAST(substr(user_id, 6, 4) AS INTEGER) < 5""")
def union_missing_cols(spark, sf_dir):
    """Union where only one side carries ``description``: the other gets nulls."""
    snap = snapshot(Tables(spark, sf_dir)).select("user_id", "amount", "device_trust_score")
    scen = snap.where(F.substring("user_id", 6, 4).cast("int") < 5).select(
        F.concat(F.lit("test_"), F.col("user_id")).alias("user_id"), "amount", "device_trust_score",
        F.concat(F.lit("scenario user "), F.col("user_id")).alias("description"))
    return snap.unionByName(scen, allowMissingColumns=True)


@query("distinct_items", sql=S.with_(S.BOOKS) + "SELECT DISTINCT search_category FROM books")
def distinct_items(spark, sf_dir):
    return ad.books(Tables(spark, sf_dir)).select("search_category").distinct()


@query("split_disjoint", sql=S.with_(S.TRANSACTIONS) + """
, s AS (SELECT transaction_id, is_fraud,
               row_number() OVER (PARTITION BY is_fraud ORDER BY md5(transaction_id || '|42')) AS rn,
               count(*) OVER (PARTITION BY is_fraud) AS n FROM transactions),
t AS (SELECT transaction_id, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM s)
SELECT (SELECT count(*) FROM t WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM t WHERE split = 'test') AS n_test,
       (SELECT count(*) FROM t a JOIN t b ON a.transaction_id = b.transaction_id
         AND a.split = 'train' AND b.split = 'test') AS n_overlap""")
def split_disjoint(spark, sf_dir):
    """Train/test disjointness: semi join of the two id sets must be empty."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    sp = stratified_split(tx, "transaction_id", "is_fraud", 0.2, 42)
    train = sp.where(F.col("split") == "train").select("transaction_id")
    test = sp.where(F.col("split") == "test").select("transaction_id")
    overlap = train.join(test, "transaction_id", "left_semi")
    counts = sp.agg(F.sum((F.col("split") == "train").cast("long")).alias("n_train"),
                    F.sum((F.col("split") == "test").cast("long")).alias("n_test"))
    from tessera.functions.ranking import attach_totals
    return attach_totals(counts, overlap.agg(F.count(F.lit(1)).alias("n_overlap")), [])


@query("head_n", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, user_id, amount FROM transactions ORDER BY CAST(transaction_id AS BIGINT) LIMIT 100""")
def head_n(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return tx.orderBy(F.col("transaction_id").cast("long")).limit(100).select("transaction_id", "user_id", "amount")


@query("top_k", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, amount FROM transactions ORDER BY amount DESC, transaction_id LIMIT 10""")
def top_k(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return tx.orderBy(F.col("amount").desc(), F.col("transaction_id")).limit(10).select("transaction_id", "amount")
