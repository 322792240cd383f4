"""Queries: projections, encodings, text shaping, request validation (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_32
from tessera.operators import features as ft
from tessera.operators import online as on
from tessera.plans import sql as S
from tessera.plans.q_online import AS_OF, START, snapshot
from tessera.plans.registry import query
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

CODES_SQL = """
codes AS (SELECT merchant_category, CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT merchant_category FROM transactions WHERE merchant_category IS NOT NULL))"""


@query("feature_matrix", sql=S.with_(S.TRANSACTIONS, CODES_SQL) + """
SELECT t.transaction_id, t.amount, t.transaction_hour,
       CAST(COALESCE(c.code, -1) AS TINYINT) AS merchant_category,
       t.foreign_transaction, t.location_mismatch, t.device_trust_score, t.velocity_last_24h,
       t.cardholder_age
FROM transactions t LEFT JOIN codes c USING (merchant_category)""")
def feature_matrix(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir))
    return ft.feature_matrix(tx, keep=["transaction_id"])


def _map_sql(mapping: dict, col: str, default: int = 4) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


# Serving-side categories used as request inputs for the static maps.
REQUEST_CATEGORIES = ["Electronics", "Travel", "Grocery", "Dining", "Other", "Gas", "Restaurant",
                      "Retail", "Entertainment", "Healthcare"]


def _mapped_category_spark(t):
    """Request categories: the serving names by event id, real event types otherwise."""
    tx = ad.transactions(t, with_velocity=False)
    n = len(REQUEST_CATEGORIES)
    arr = F.array(*[F.lit(c) for c in REQUEST_CATEGORIES])
    pick = F.when(F.col("transaction_id").cast("long") % 2 == 0,
                  F.element_at(arr, (F.col("transaction_id").cast("long") / 2 % n).cast("int") + 1)) \
        .otherwise(F.col("merchant_category"))
    return tx.select("transaction_id", pick.alias("merchant_category"))


def _mapped_category_sql() -> str:
    arr = "[" + ", ".join(f"'{c}'" for c in REQUEST_CATEGORIES) + "]"
    n = len(REQUEST_CATEGORIES)
    return f"""
cats AS (SELECT transaction_id,
                CASE WHEN CAST(transaction_id AS BIGINT) % 2 = 0
                     THEN {arr}[CAST(floor(CAST(transaction_id AS BIGINT) / 2 % {n}) AS INTEGER) + 1]
                     ELSE merchant_category END AS merchant_category
         FROM transactions)"""


@query("category_map_default", sql=S.with_(S.TRANSACTIONS, _mapped_category_sql()) + f"""
SELECT transaction_id, merchant_category,
       {_map_sql(ft.CATEGORY_MAP_SERVICE, 'merchant_category')} AS code_service,
       {_map_sql(ft.CATEGORY_MAP_STORE_SERVICE, 'merchant_category')} AS code_store_service
FROM cats""")
def category_map_default(spark, sf_dir):
    df = _mapped_category_spark(Tables(spark, sf_dir))
    return df.select("transaction_id", "merchant_category",
                     ft.map_codes("merchant_category", ft.CATEGORY_MAP_SERVICE).alias("code_service"),
                     ft.map_codes("merchant_category", ft.CATEGORY_MAP_STORE_SERVICE).alias("code_store_service"))


@query("category_binary", sql=S.with_(S.TRANSACTIONS, _mapped_category_sql()) + """
SELECT transaction_id, CASE WHEN merchant_category = 'Grocery' THEN 0 ELSE 1 END AS category_binary FROM cats""")
def category_binary(spark, sf_dir):
    df = _mapped_category_spark(Tables(spark, sf_dir))
    return df.select("transaction_id", ft.binary_category("merchant_category").alias("category_binary"))


@query("encoding_skew", sql=S.with_(S.TRANSACTIONS, _mapped_category_sql()) + f"""
, codes AS (SELECT merchant_category, CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT merchant_category FROM cats WHERE merchant_category IS NOT NULL))
SELECT merchant_category AS category, code AS train_code,
       {_map_sql(ft.CATEGORY_MAP_SERVICE, 'merchant_category')} AS serve_code,
       {_map_sql(ft.CATEGORY_MAP_STORE_SERVICE, 'merchant_category')} AS store_serve_code,
       CASE WHEN merchant_category = 'Grocery' THEN 0 ELSE 1 END AS binary_code,
       (code <> {_map_sql(ft.CATEGORY_MAP_SERVICE, 'merchant_category')}
        OR {_map_sql(ft.CATEGORY_MAP_SERVICE, 'merchant_category')}
           <> {_map_sql(ft.CATEGORY_MAP_STORE_SERVICE, 'merchant_category')}) AS skew
FROM codes""")
def encoding_skew(spark, sf_dir):
    return ft.encoding_skew(_mapped_category_spark(Tables(spark, sf_dir)))


WEIGHTED_SQL = """
weighted AS (
  SELECT book_id, title, categories,
         regexp_replace(lower(
           coalesce(title,'') || ' ' || coalesce(title,'') || ' ' || coalesce(subtitle,'') || ' ' ||
           coalesce(authors,'') || ' ' || coalesce(authors,'') || ' ' ||
           coalesce(categories,'') || ' ' || coalesce(categories,'') || ' ' || coalesce(categories,'') || ' ' ||
           coalesce(search_category,'') || ' ' || coalesce(search_category,'') || ' ' ||
           coalesce(description,'')), '^\\s+|\\s+$', '', 'g') AS combined_features
  FROM books)"""


@query("weighted_text", sql=S.with_(S.BOOKS, WEIGHTED_SQL) + """
SELECT book_id, combined_features FROM weighted WHERE length(combined_features) > 10""")
def weighted_text(spark, sf_dir):
    return ft.weighted_text(ad.books(Tables(spark, sf_dir))).select("book_id", "combined_features")


@query("time_range_filter", sql=S.with_(S.TRANSACTIONS) + f"""
SELECT transaction_id, user_id, "timestamp" FROM transactions
WHERE "timestamp" BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY AND TIMESTAMP '{AS_OF}'""")
def time_range_filter(spark, sf_dir):
    """Last 60 days up to the as-of time, both ends inclusive (as-of is a parameter)."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    end = F.lit(AS_OF).cast("timestamp_ntz")
    start = end - F.expr("INTERVAL 60 DAYS")
    rng = tx.where(F.col("timestamp").between(start, end)) if "timestamp" in tx.columns else tx
    return rng.select("transaction_id", "user_id", "timestamp")


TITLE_QUERY = "Ion"


@query("title_search", sql=S.with_(S.BOOKS) + f"""
SELECT book_id, title FROM books
WHERE contains(lower(title), lower('{TITLE_QUERY}'))
ORDER BY book_id LIMIT 5""")
def title_search(spark, sf_dir):
    """Case-insensitive literal substring (never a regex), nulls never match; first 5 by catalog order."""
    b = ad.books(Tables(spark, sf_dir))
    hit = F.coalesce(F.lower("title").contains(F.lower(F.lit(TITLE_QUERY))), F.lit(False))
    return b.where(hit).orderBy("book_id").limit(5).select("book_id", "title")


def reco_requests(t):
    """Recommendation requests from benchmark rows: by id (some unknown), by title, or empty."""
    bm = t.benchmark
    return bm.select(
        F.col("item_id").alias("request_id"),
        F.when(F.col("item_id") % 3 == 0, F.col("item_id") * 7)
         .when(F.col("item_id") % 3 == 1, F.col("item_id") * 7 + 100000000).alias("book_id"),
        F.when(F.col("item_id") % 3 == 2, F.lower(F.substring(F.col("text"), 2, 3))).alias("title"),
        F.when(F.col("item_id") % 4 == 0, F.lit(None)).otherwise((F.col("item_id") % 25) - 2).cast("int")
         .alias("num_recommendations"),
    )


RECO_REQ_SQL = """
reco_requests AS (
  SELECT item_id AS request_id,
         CASE WHEN item_id % 3 = 0 THEN item_id * 7 WHEN item_id % 3 = 1 THEN item_id * 7 + 100000000 END AS book_id,
         CASE WHEN item_id % 3 = 2 THEN lower(substr(text, 2, 3)) END AS title,
         CAST(CASE WHEN item_id % 4 = 0 THEN NULL ELSE item_id % 25 - 2 END AS INTEGER) AS num_recommendations
  FROM benchmark)"""


@query("resolve_query_item", sql=S.with_(S.BOOKS, RECO_REQ_SQL) + """
, by_title AS (
  SELECT r.request_id, min(b.book_id) AS book_id
  FROM reco_requests r JOIN books b ON r.book_id IS NULL AND r.title IS NOT NULL
       AND contains(lower(b.title), lower(r.title))
  GROUP BY r.request_id)
SELECT r.request_id,
       COALESCE(bi.book_id, bt.book_id) AS query_book_id,
       CASE WHEN COALESCE(bi.book_id, bt.book_id) IS NULL THEN 404 ELSE 200 END AS status
FROM reco_requests r
LEFT JOIN books bi ON r.book_id = bi.book_id
LEFT JOIN by_title bt ON r.request_id = bt.request_id""")
def resolve_query_item(spark, sf_dir):
    """Id lookup; without an id, the first title match in catalog order; else 404.

    The title match is a substring join: requests are few next to the catalog,
    so the request side (size checked) is broadcast into a filter over the catalog.
    """
    from tessera.operators.similar import resolve_items
    t = Tables(spark, sf_dir)
    return resolve_items(reco_requests(t), ad.books(t))


@query("response_projection", sql=S.with_(S.BOOKS) + """
SELECT book_id, title, coalesce(substr(description, 1, 200), '') AS description,
       CAST(average_rating AS DOUBLE) AS average_rating, CAST(ratings_count AS BIGINT) AS ratings_count
FROM books""")
def response_projection(spark, sf_dir):
    b = ad.books(Tables(spark, sf_dir))
    return b.select("book_id", "title", ft.truncate_text("description").alias("description"),
                    F.col("average_rating").cast("double").alias("average_rating"),
                    F.col("ratings_count").cast("long").alias("ratings_count"))


@query("assign_users", sql="""
WITH w AS (SELECT o_custkey AS uid, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
iv AS (SELECT uid, sum(n) OVER (ORDER BY uid) - n AS lo, sum(n) OVER (ORDER BY uid) AS hi, sum(n) OVER () AS total FROM w),
tx AS (SELECT event_id, ('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|7'), 1, 8))::BIGINT AS u FROM events),
placed AS (SELECT event_id, CAST(u * (SELECT max(total) FROM iv) // 4294967296 AS BIGINT) AS place FROM tx)
SELECT CAST(placed.event_id AS VARCHAR) AS transaction_id, printf('user_%04d', iv.uid) AS user_id
FROM placed JOIN iv ON placed.place >= iv.lo AND placed.place < iv.hi""")
def assign_users(spark, sf_dir):
    """Weighted key assignment: each transaction gets a customer, drawn with
    replacement in proportion to the number of orders."""
    from tessera.operators.sampling import weighted_assign
    t = Tables(spark, sf_dir)
    users = t.orders.where(F.col("o_custkey").isNotNull()) \
        .groupBy(F.col("o_custkey").alias("uid")).agg(F.count(F.lit(1)).alias("w"))
    tx = t.events.select(F.col("event_id").cast("string").alias("transaction_id"),
                         hash_32("event_id", seed=7).alias("u"))
    out = weighted_assign(tx, users, "u", "uid", "w")
    out = out.withColumn("user_id", ft.zero_pad_id("uid")).drop("uid", "u")
    return ft.move_column(out, "user_id", after="transaction_id")


# The features set for keys of each class.
RISK_OVERRIDES = {
    "high": {"device_trust_score": 25, "velocity_last_24h": 11, "foreign_transaction": 1,
             "location_mismatch": 1, "amount": 3500.0},
    "low": {"device_trust_score": 85, "velocity_last_24h": 1, "foreign_transaction": 0,
            "location_mismatch": 0, "amount": 55.0},
}
RISK_TYPES = {"amount": "double"}


def _override_sql(feature: str) -> str:
    high, low = RISK_OVERRIDES["high"][feature], RISK_OVERRIDES["low"][feature]
    return (f"CASE WHEN c_acctbal < 0 THEN {high} WHEN c_acctbal > 9000 THEN {low} "
            f"ELSE s.{feature} END AS {feature}")


@query("risk_scenarios", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + f"""
SELECT s.user_id, {", ".join(map(_override_sql, RISK_OVERRIDES["high"]))}
FROM snapshot s LEFT JOIN customer ON s.user_id = printf('user_%04d', c_custkey)""")
def risk_scenarios(spark, sf_dir):
    """Override features for two sets of keys: customers in debt are high risk, those
    with a balance over 9,000 low risk; other users keep their features."""
    t = Tables(spark, sf_dir)
    classes = t.customer.select(
        ft.zero_pad_id("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") < 0, "high").when(F.col("c_acctbal") > 9000, "low").alias("_class")) \
        .where(F.col("_class").isNotNull())
    return ft.override_by_class(snapshot(t), classes, "user_id", "_class", RISK_OVERRIDES) \
        .select("user_id", *[F.col(c).cast(RISK_TYPES.get(c, "long")).alias(c) for c in RISK_OVERRIDES["high"]])


RISK_SQL = "round(amount / (amount + 100.0), 6)"


@query("score_threshold", sql=S.with_(S.TRANSACTIONS) + f"""
SELECT transaction_id, {RISK_SQL} AS fraud_probability, {RISK_SQL} > 0.5 AS is_fraud,
       CASE WHEN {RISK_SQL} > 0.5 THEN 'FRAUD' ELSE 'LEGIT' END AS verdict
FROM transactions""")
def score_threshold(spark, sf_dir):
    """Threshold a probability at 0.5 and name the verdict."""
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    prob = F.round(F.col("amount") / (F.col("amount") + 100.0), 6)
    scored = tx.select("transaction_id", prob.alias("fraud_probability"))
    flag, verdict = ft.threshold_decision("fraud_probability")
    return scored.select("*", flag.alias("is_fraud"), verdict.alias("verdict"))


@query("validate_requests", sql=S.with_(S.REQUESTS) + """
SELECT transaction_id, CASE WHEN amount IS NULL THEN 'rejected' ELSE 'ok' END AS status,
       CASE WHEN amount IS NULL THEN 'missing_required_features' END AS error_type
FROM requests""")
def validate_requests(spark, sf_dir):
    r = ad.requests(Tables(spark, sf_dir))
    return on.validate_requests(r).select("transaction_id", "status", "error_type")


@query("validate_text_requests", sql=r"""
SELECT conv_id, turn, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\x09-\x0D\x20]') THEN 'rejected' ELSE 'ok' END AS status
FROM conversations""")
def validate_text_requests(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    blank = ft.blank_text("text")
    return c.select("conv_id", "turn", F.when(blank, "rejected").otherwise("ok").alias("status"))


@query("validate_reco_requests", sql=S.with_(RECO_REQ_SQL) + """
SELECT request_id, COALESCE(num_recommendations, 5) AS n,
       CASE WHEN book_id IS NULL AND (title IS NULL OR title = '') THEN 'missing_input'
            WHEN COALESCE(num_recommendations, 5) NOT BETWEEN 1 AND 20 THEN 'invalid_n'
            ELSE 'ok' END AS status
FROM reco_requests""")
def validate_reco_requests(spark, sf_dir):
    return validated_requests(reco_requests(Tables(spark, sf_dir)))


def validated_requests(r):
    """(request_id, n, status) per request: ok, missing_input or invalid_n."""
    n = F.coalesce(F.col("num_recommendations"), F.lit(5))
    missing = F.col("book_id").isNull() & (F.col("title").isNull() | (F.col("title") == ""))
    status = (F.when(missing, "missing_input").when(~n.between(1, 20), "invalid_n").otherwise("ok"))
    return r.select("request_id", n.alias("n"), status.alias("status"))
