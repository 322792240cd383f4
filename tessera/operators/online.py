"""Online snapshot: latest-per-key materialisation, keyed upsert, lookup, fill-missing.

The online store is a keyed snapshot table (one row per entity key) kept as
Parquet; a request table is scored against it with one left join instead of
one keyed read per request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.schemas import FRAUD_FEATURES


def in_time_range(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Both ends inclusive; bounds are parameters (no clock reads).  The filter
    is skipped when the column is absent (plan-time check on the schema)."""
    if ts_col not in df.columns:
        return df
    return df.where(F.col(ts_col).between(F.lit(start), F.lit(end)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   value_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the largest ``order`` tuple.

    ``max`` over a struct whose leading fields are the order columns is a
    combinable aggregate: each task keeps one row per key before the shuffle,
    so a hot key costs one row per task, not all its rows.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in (value_cols or df.columns) if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(c) for c in order + rest])
    return (df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
            .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in order + rest]))


def materialize_latest(transactions: DataFrame, start, end, key: str = "user_id",
                       ts_col: str = "timestamp", created_col: str = "created_timestamp",
                       id_col: str = "transaction_id") -> DataFrame:
    """Latest transaction per entity inside [start, end], tie-break by created time
    then id; output is the online snapshot row (features + event_timestamp)."""
    rng = in_time_range(transactions, ts_col, start, end)
    latest = latest_per_key(rng, [key], [ts_col, created_col, id_col], FRAUD_FEATURES)
    return latest.select(key, *FRAUD_FEATURES, F.col(ts_col).alias("event_timestamp"),
                         F.col(created_col).alias("created_timestamp"))


def upsert_snapshot(snapshot: DataFrame, batch: DataFrame, key: str, ts_col: str,
                    tie_cols: Sequence[str] = ()) -> DataFrame:
    """Keyed upsert, last write wins: union the current snapshot with a batch and
    keep the newest row per key (batch wins exact ties)."""
    cols = snapshot.columns
    old = snapshot.select(*cols).withColumn("_src", F.lit(0))
    new = batch.select(*cols).withColumn("_src", F.lit(1))
    both = old.unionByName(new)
    return latest_per_key(both, [key], [ts_col, "_src", *tie_cols], cols).select(*cols)


def unexpired(snapshot: DataFrame, as_of, ttl_days: int, ts_col: str = "event_timestamp") -> DataFrame:
    """Store rows whose age at ``as_of`` is within the view's time-to-live (a row
    exactly ``ttl_days`` old still counts; a null time does not)."""
    oldest = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(ttl_days))
    return snapshot.where(F.col(ts_col) >= oldest)


def online_lookup(requests: DataFrame, snapshot: DataFrame, key: str,
                  prefix: str = "store_") -> DataFrame:
    """One output row per request row; store columns null when the key is absent
    (or its row is past its time-to-live, if ``snapshot`` is ``unexpired``).

    A left join: AQE turns it into a broadcast join when the snapshot is small at
    run time; otherwise it is a shuffle join on the key."""
    store = snapshot.select(key, *[F.col(c).alias(prefix + c) for c in snapshot.columns if c != key])
    return requests.join(store.withColumn(prefix + "hit", F.lit(True)), on=key, how="left") \
        .withColumn(prefix + "hit", F.coalesce(F.col(prefix + "hit"), F.lit(False)))


def _missing(c: Column, falsy: bool, is_string: bool) -> Column:
    if not falsy:
        return c.isNull()
    return c.isNull() | (c == F.lit("") if is_string else c == F.lit(0))


def fill_missing(joined: DataFrame, features: Sequence[str] = FRAUD_FEATURES,
                 prefix: str = "store_", falsy_missing: bool = False,
                 string_features: Sequence[str] = ("merchant_category",),
                 store_label: str = "store") -> DataFrame:
    """Request value wins; the store value fills a missing one.

    The store is only consulted when at least one feature is null and the key was
    found (``feature_source`` tells which).  With ``falsy_missing=True`` a request
    whose store is consulted also has its 0 and '' replaced (by the store value,
    even a null one); a complete request keeps them.
    """
    flags = [_missing(F.col(f), falsy_missing, f in string_features) for f in features]
    any_missing = F.lit(False)
    for f in features:
        any_missing = any_missing | F.col(f).isNull()
    use_store = any_missing & F.col(prefix + "hit")
    filled = {f: F.when(use_store & fl, F.col(prefix + f)).otherwise(F.col(f)).alias(f)
              for f, fl in zip(features, flags)}
    keep = [filled.get(c, F.col(c)) for c in joined.columns if not c.startswith(prefix)]
    source = F.when(use_store, F.lit(store_label)).otherwise(F.lit("request")).alias("feature_source")
    return joined.select(*keep, source)


# Final defaults of the scoring path.
FEATURE_DEFAULTS = {
    "transaction_hour": 12,
    "foreign_transaction": 0,
    "location_mismatch": 0,
    "device_trust_score": 50,
    "velocity_last_24h": 1,
    "cardholder_age": 35,
}


def default_fill(df: DataFrame, falsy_missing: bool = True,
                 defaults: dict | None = None) -> DataFrame:
    """``x or default``: null (and, in falsy mode, 0) becomes the default."""
    out = df
    for c, d in (defaults or FEATURE_DEFAULTS).items():
        miss = _missing(F.col(c), falsy_missing, False)
        out = out.withColumn(c, F.when(miss, F.lit(d)).otherwise(F.col(c)).cast("long"))
    return out


def validate_requests(df: DataFrame, required: str = "amount") -> DataFrame:
    """Split into accepted and rejected rows (rejected carry an error type)."""
    return df.withColumn("status", F.when(F.col(required).isNull(), F.lit("rejected")).otherwise(F.lit("ok"))) \
             .withColumn("error_type", F.when(F.col(required).isNull(), F.lit("missing_required_features")))
