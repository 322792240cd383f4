"""Queries: feature store side (materialise, lookup, fill, encode, upsert)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as ft
from tessera.operators import online as on
from tessera.plans import sql as S
from tessera.plans.registry import query
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

# Fixed parameters of the materialisation window (as-of time and 60-day look-back).
AS_OF = "2024-01-20 00:00:00"
START = "2023-11-21 00:00:00"


# Fixed value: time-to-live of the user feature view, in days.
TTL_DAYS = 365


def transactions_in_range(t: Tables, start: str = START, end: str = AS_OF):
    """Transactions of the window and of the 24 h before it, which their velocity
    looks back on: the time filter reaches the scan."""
    lo = F.lit(start).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(24))
    e = t.events.where((F.col("ts") >= lo) & (F.col("ts") <= F.lit(end).cast("timestamp_ntz")))
    return ad.transactions_from(e)


def snapshot(t: Tables):
    return on.materialize_latest(transactions_in_range(t), START, AS_OF)


def live_snapshot(t: Tables):
    """The rows a lookup at ``AS_OF`` may return."""
    return on.unexpired(snapshot(t), AS_OF, TTL_DAYS)


def _feature_case(falsy: bool) -> str:
    """SQL of fill_missing: request value wins, store fills a missing one."""
    def miss(f, alias="r"):
        c = f"{alias}.{f}"
        if not falsy:
            return f"{c} IS NULL"
        zero = "''" if f == "merchant_category" else "0"
        return f"({c} IS NULL OR {c} = {zero})"
    any_missing = " OR ".join(f"r.{f} IS NULL" for f in S.FEATURES)
    use = f"(({any_missing}) AND s.user_id IS NOT NULL)"
    cols = ",\n         ".join(
        f"CASE WHEN {use} AND {miss(f)} THEN s.{f} ELSE r.{f} END AS {f}" for f in S.FEATURES)
    return f"""
SELECT r.transaction_id, r.user_id,
         {cols},
         CASE WHEN {use} THEN 'store' ELSE 'request' END AS feature_source
FROM requests r LEFT JOIN snapshot s ON r.user_id = s.user_id"""


SNAP_SQL = S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF))


@query("materialize_latest", sql=SNAP_SQL + "SELECT * FROM snapshot")
def materialize_latest(spark, sf_dir):
    return snapshot(Tables(spark, sf_dir))


@query("online_lookup", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF)) + """
SELECT r.transaction_id, r.user_id, r.amount, s.amount AS store_amount,
       s.velocity_last_24h AS store_velocity_last_24h, s.event_timestamp AS store_event_timestamp,
       s.user_id IS NOT NULL AS store_hit
FROM requests r LEFT JOIN snapshot s ON r.user_id = s.user_id""")
def online_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    return j.select("transaction_id", "user_id", "amount", "store_amount", "store_velocity_last_24h",
                    "store_event_timestamp", "store_hit")


@query("online_lookup_ttl", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF)) + f"""
SELECT r.transaction_id, r.user_id, s.amount AS store_amount, s.event_timestamp AS store_event_timestamp,
       s.user_id IS NOT NULL AS store_hit
FROM requests r LEFT JOIN snapshot s
  ON r.user_id = s.user_id AND s.event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY""")
def online_lookup_ttl(spark, sf_dir):
    """Lookup in a view that expires after one day: older rows answer as absent."""
    t = Tables(spark, sf_dir)
    j = on.online_lookup(ad.requests(t), on.unexpired(snapshot(t), AS_OF, 1), "user_id")
    return j.select("transaction_id", "user_id", "store_amount", "store_event_timestamp", "store_hit")


@query("online_lookup_transaction", sql=S.with_(S.TRANSACTIONS, S.REQUESTS) + f"""
SELECT r.transaction_id, r.amount, t.amount AS store_amount, t.device_trust_score AS store_device_trust_score,
       t.transaction_id IS NOT NULL AS store_hit
FROM requests r LEFT JOIN (SELECT * FROM transactions
  WHERE "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{AS_OF}') t USING (transaction_id)""")
def online_lookup_transaction(spark, sf_dir):
    """Lookup in the store table keyed by transaction id (one row per transaction
    of the window)."""
    t = Tables(spark, sf_dir)
    tx = on.in_time_range(ad.transactions(t, with_velocity=False), "timestamp", START, AS_OF)
    store = on.latest_per_key(tx, ["transaction_id"], ["timestamp", "created_timestamp"],
                              ["amount", "device_trust_score"])
    j = on.online_lookup(ad.requests(t), store, "transaction_id")
    return j.select("transaction_id", "amount", "store_amount", "store_device_trust_score", "store_hit")


@query("fill_missing_null", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF))
       + _feature_case(False))
def fill_missing_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    return on.fill_missing(j, falsy_missing=False)


@query("fill_missing_falsy", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF))
       + _feature_case(True))
def fill_missing_falsy(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    return on.fill_missing(j, falsy_missing=True)


def _default_sql() -> str:
    cols = ",\n       ".join(
        f"CAST(CASE WHEN {c} IS NULL OR {c} = 0 THEN {d} ELSE {c} END AS BIGINT) AS {c}"
        for c, d in on.FEATURE_DEFAULTS.items())
    return f"""
, filled AS ({_feature_case(True)})
SELECT transaction_id, user_id, amount, merchant_category, feature_source,
       {cols}
FROM filled"""


@query("default_fill", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF))[:-1]
       + _default_sql())
def default_fill(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    return on.default_fill(on.fill_missing(j, falsy_missing=True), falsy_missing=True)


@query("category_codes", sql=S.with_(S.TRANSACTIONS) + """
, codes AS (SELECT merchant_category, CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT merchant_category FROM transactions WHERE merchant_category IS NOT NULL))
SELECT t.transaction_id, t.merchant_category, COALESCE(c.code, -1) AS merchant_category_code
FROM transactions t LEFT JOIN codes c USING (merchant_category)""")
def category_codes(spark, sf_dir):
    tx = ad.transactions(Tables(spark, sf_dir), with_velocity=False)
    return ft.category_codes(tx).select("transaction_id", "merchant_category", "merchant_category_code")


def flagship(spark, sf_dir):
    """Requests -> latest-per-user snapshot -> left lookup -> fill -> defaults -> codes."""
    t = Tables(spark, sf_dir)
    tx = ad.transactions(t, with_velocity=False)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    filled = on.default_fill(on.fill_missing(j, falsy_missing=False), falsy_missing=False)
    codes = ft.fit_category_codes(tx, "merchant_category")
    return ft.apply_category_codes(filled, "merchant_category", codes, out_col="merchant_category_code")


FLAGSHIP_SQL = S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF))[:-1] + f"""
, filled AS ({_feature_case(False)}),
codes AS (SELECT merchant_category, CAST(dense_rank() OVER (ORDER BY merchant_category) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT merchant_category FROM transactions WHERE merchant_category IS NOT NULL))
SELECT f.transaction_id, f.user_id, f.amount, f.merchant_category, f.feature_source,
       """ + ",\n       ".join(
    f"CAST(COALESCE({c}, {d}) AS BIGINT) AS {c}" for c, d in on.FEATURE_DEFAULTS.items()) + """,
       COALESCE(c.code, -1) AS merchant_category_code
FROM filled f LEFT JOIN codes c USING (merchant_category)"""

query("score_features_flagship", sql=FLAGSHIP_SQL)(flagship)
