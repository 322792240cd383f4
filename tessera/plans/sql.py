"""SQL twins of the adapters (DuckDB dialect), used only by the oracle."""

from __future__ import annotations

FEATURES = ["amount", "transaction_hour", "merchant_category", "foreign_transaction",
            "location_mismatch", "device_trust_score", "velocity_last_24h", "cardholder_age"]

TRUST = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

TRANSACTIONS = f"""
transactions AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         printf('user_%04d', user_id) AS user_id,
         ts AS "timestamp", ts AS created_timestamp,
         value AS amount,
         CAST(hour(ts) AS BIGINT) AS transaction_hour,
         event_type AS merchant_category,
         CAST(CASE WHEN event_id % 20 < 3 THEN 1 ELSE 0 END AS BIGINT) AS foreign_transaction,
         CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS location_mismatch,
         {TRUST} AS device_trust_score,
         CAST(18 + user_id % 62 AS BIGINT) AS cardholder_age,
         count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
                        RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS velocity_last_24h,
         CAST(CASE WHEN ({TRUST} < 40 AND value > 60)
                     OR (event_id % 20 < 3 AND event_id % 10 = 0) THEN 1 ELSE 0 END AS BIGINT) AS is_fraud
  FROM events)"""

REQUESTS = f"""
requests AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         printf('user_%04d', CASE WHEN event_id % 17 = 0 THEN user_id + 1000 ELSE user_id END) AS user_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS amount,
         CAST(CASE WHEN event_id % 5 = 1 THEN NULL ELSE hour(ts) END AS BIGINT) AS transaction_hour,
         CASE WHEN event_id % 6 = 2 THEN NULL WHEN event_id % 13 = 0 THEN '' ELSE event_type END AS merchant_category,
         CAST(CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 20 < 3 THEN 1 ELSE 0 END AS BIGINT) AS foreign_transaction,
         CAST(CASE WHEN event_id % 9 = 4 THEN NULL WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS location_mismatch,
         CAST(CASE WHEN event_id % 7 = 5 THEN NULL ELSE {TRUST} END AS BIGINT) AS device_trust_score,
         CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 5 END AS BIGINT) AS velocity_last_24h,
         CAST(CASE WHEN event_id % 8 = 6 THEN NULL ELSE 18 + user_id % 62 END AS BIGINT) AS cardholder_age
  FROM events)"""

SENTIMENT = """
sentiment AS (
  SELECT d.doc_id, d.text AS clean_text,
         CAST(CASE WHEN l.toxic = 1 THEN -1 WHEN l.quality = 1 THEN 1 ELSE 0 END AS INTEGER) AS category
  FROM documents d JOIN labels l USING (doc_id))"""

SECOND_CORPUS = """
comments AS (
  SELECT conv_id, turn, text AS clean_comment,
         CAST(CASE WHEN role = 'assistant' THEN 1 WHEN role = 'user' THEN 0 ELSE -1 END AS INTEGER) AS category
  FROM conversations)"""

BOOKS = """
books AS (
  SELECT doc_id AS book_id,
         split_part(text, chr(10), 1) AS title,
         CAST(NULL AS VARCHAR) AS subtitle,
         source AS authors, text AS description, lang AS categories,
         CAST(NULL AS VARCHAR) AS publisher, source AS search_category,
         CAST(NULL AS DOUBLE) AS average_rating, CAST(NULL AS BIGINT) AS ratings_count
  FROM documents)"""

REQUEST_LOG = f"""
request_log AS (
  SELECT event_id AS request_id, ts, user_id, event_type AS endpoint, value AS latency_ms,
         ({TRUST} % 20) <> 0 AS success,
         CASE WHEN ({TRUST} % 20) = 0 THEN 'E' || CAST({TRUST} AS VARCHAR) END AS error
  FROM events)"""

RUN_LOG = """
run_log AS (
  SELECT o_orderpriority AS experiment, o_orderkey AS run_id, o_orderdate AS start_time,
         o_totalprice AS metric, o_orderstatus AS status
  FROM orders)"""

RATINGS = """
ratings AS (
  SELECT o.o_custkey AS customer_id, l.l_partkey AS item_id, sum(l.l_quantity) AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def snapshot_cte(start: str, end: str, name: str = "snapshot") -> str:
    """Latest transaction per user in [start, end] (SQL twin of materialize_latest)."""
    cols = ", ".join(FEATURES)
    return f"""
{name} AS (
  SELECT user_id, {cols}, "timestamp" AS event_timestamp, created_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
              ORDER BY "timestamp" DESC, created_timestamp DESC, transaction_id DESC) AS rn
    FROM transactions
    WHERE "timestamp" BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}') WHERE rn = 1)"""
