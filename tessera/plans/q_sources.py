"""Queries: scans, sources and sinks (2.1, 2.2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import online as on
from tessera.plans import sql as S
from tessera.plans.q_online import AS_OF, START, live_snapshot, snapshot, transactions_in_range
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources import adapters as ad
from tessera.sources import files as fs
from tessera.sources import store as st
from tessera.sources.schemas import ONLINE_USER_SCHEMA, TABLE_SCHEMAS
from tessera.sources.tables import Tables, read_table, table_path

ALL_TABLES = list(TABLE_SCHEMAS)


@query("scan_profile", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS n_columns FROM {t}" for t in ALL_TABLES))
def scan_profile(spark, sf_dir):
    parts = []
    for t in ALL_TABLES:
        df = read_table(spark, sf_dir, t)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(t).alias("table_name"), "n_rows",
                             F.lit(len(df.columns)).cast("long").alias("n_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("csv_roundtrip", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_roundtrip(spark, sf_dir):
    """events -> CSV (header) -> inferred read -> Parquet (snappy) -> typed read."""
    src = read_table(spark, sf_dir, "events")
    csv_path = fs.write_csv(src, scratch_path(spark, "events-csv"))
    inferred = fs.read_csv_inferred(spark, csv_path)
    pq = fs.write_parquet(inferred, scratch_path(spark, "events-pq"), codec="snappy")
    return fs.conform(spark.read.parquet(pq), TABLE_SCHEMAS["events"])


def _flat_tables() -> list[str]:
    """Tables that CSV can hold: those without nested columns."""
    return [t for t, schema in TABLE_SCHEMAS.items()
            if not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in schema.fields)]


def _conversion(spark, sf_dir):
    root = scratch_path(spark, "csv")
    for t in _flat_tables():
        fs.write_csv(read_table(spark, sf_dir, t), f"{root}/{t}.csv")
    return fs.convert_csv(spark, f"{root}/*.csv", scratch_path(spark, "converted"))


@query("csv_file_report")
def csv_file_report(spark, sf_dir):
    """Per-file CSV -> Parquet conversion report of all discovered files: rows, sizes,
    seconds, size saved %, failures kept as rows, and a total."""
    return _conversion(spark, sf_dir)


_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS file, 'ok' AS status, count(*) AS rows FROM {t}"
                                 for t in _flat_tables())


@query("conversion_rows", sql=f"""
WITH c AS ({_COUNTS_SQL})
SELECT * FROM c UNION ALL SELECT 'total', 'ok', CAST(sum(rows) AS BIGINT) FROM c""")
def conversion_rows(spark, sf_dir):
    """Rows that each converted file holds, read back from its Parquet form."""
    return _conversion(spark, sf_dir).select("file", "status", "rows")


@query("online_verify", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + """
SELECT user_id, amount, event_timestamp, count(*) OVER () AS total_rows
FROM snapshot ORDER BY user_id LIMIT 5""")
def online_verify(spark, sf_dir):
    """Row count of the online table and its first five rows by key."""
    snap = snapshot(Tables(spark, sf_dir))
    n = snap.agg(F.count(F.lit(1)).alias("total_rows"))
    head = snap.orderBy("user_id").limit(5).select("user_id", "amount", "event_timestamp")
    from tessera.functions.ranking import attach_totals
    return attach_totals(head, n, [])


REQUEST_JSON_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_hour", T.LongType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("foreign_transaction", T.LongType()),
    T.StructField("location_mismatch", T.LongType()),
    T.StructField("device_trust_score", T.LongType()),
    T.StructField("velocity_last_24h", T.LongType()),
    T.StructField("cardholder_age", T.LongType()),
])


@query("decode_requests", sql=S.with_(S.REQUESTS) + "SELECT * FROM requests")
def decode_requests(spark, sf_dir):
    """JSON request bodies (absent keys = missing) decoded with a fixed schema."""
    bodies = ad.requests(Tables(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("body"))
    decoded = bodies.select(F.from_json("body", REQUEST_JSON_SCHEMA, {"mode": "PERMISSIVE"}).alias("r"))
    return decoded.select("r.*")


VEC_SCHEMA = T.StructType([T.StructField("data", T.StructType([
    T.StructField("ndarray", T.ArrayType(T.ArrayType(T.DoubleType())))]))])
VEC_NAMES = ["amount", "transaction_hour", "merchant_category", "foreign_transaction",
             "location_mismatch", "device_trust_score", "velocity_last_24h", "cardholder_age"]


@query("decode_vector_requests", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, amount, CAST(transaction_hour AS DOUBLE) AS transaction_hour,
       CAST(CASE WHEN merchant_category = 'purchase' THEN 0 ELSE 1 END AS DOUBLE) AS merchant_category,
       CAST(foreign_transaction AS DOUBLE) AS foreign_transaction,
       CAST(location_mismatch AS DOUBLE) AS location_mismatch,
       CAST(device_trust_score AS DOUBLE) AS device_trust_score,
       CAST(velocity_last_24h AS DOUBLE) AS velocity_last_24h,
       CAST(cardholder_age AS DOUBLE) AS cardholder_age
FROM transactions""")
def decode_vector_requests(spark, sf_dir):
    """Positional-vector bodies {"data":{"ndarray":[[8 numbers]]}} back to named columns."""
    tx = ad.transactions(Tables(spark, sf_dir))
    cat = F.when(F.col("merchant_category") == "purchase", 0).otherwise(1)
    vec = F.array(*[(cat if c == "merchant_category" else F.col(c)).cast("double") for c in VEC_NAMES])
    body = F.to_json(F.struct(F.struct(F.array(vec).alias("ndarray")).alias("data")))
    bodies = tx.select("transaction_id", body.alias("body"))
    rows = bodies.select("transaction_id", F.explode(
        F.from_json("body", VEC_SCHEMA).getField("data").getField("ndarray")).alias("v"))
    return rows.select("transaction_id", *[F.col("v").getItem(i).alias(c) for i, c in enumerate(VEC_NAMES)])


@query("decode_vector_response", sql="""
SELECT event_id,
       CASE WHEN event_id % 2 = 0 THEN round(value / 1000.0, 6) ELSE round(1 - value / 1000.0, 6) END AS fraud_probability
FROM events""")
def decode_vector_response(spark, sf_dir):
    """Response arrays: element 1 when there are two (class probabilities), else element 0."""
    e = read_table(spark, sf_dir, "events")
    p = F.round(F.col("value") / 1000.0, 6)
    arr = F.when(F.col("event_id") % 2 == 0, F.array(F.round(1 - p, 6), p)).otherwise(F.array(F.round(1 - p, 6)))
    resp = e.select("event_id", arr.alias("prediction"))
    pick = F.when(F.size("prediction") >= 2, F.col("prediction")[1]).otherwise(F.col("prediction")[0])
    return resp.select("event_id", pick.alias("fraud_probability"))


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity_keys: tuple
    ttl_days: int
    schema: T.StructType
    timestamp_field: str = "event_timestamp"
    created_timestamp_column: str = "created_timestamp"


# The user feature view (entity user_id, TTL 365 days).
USER_FEATURES = FeatureView("user_features", ("user_id",), 365, ONLINE_USER_SCHEMA)
REGISTRY = {USER_FEATURES.name: USER_FEATURES}


def resolve_refs(df, refs: list[str], registry=REGISTRY):
    """'view:feature' references -> columns of the view; unknown view or feature is an error."""
    cols = []
    for ref in refs:
        view, _, feat = ref.partition(":")
        if view not in registry:
            raise KeyError(f"unknown feature view {view!r}")
        if feat not in registry[view].schema.fieldNames():
            raise KeyError(f"unknown feature {ref!r}")
        cols.append(F.col(feat).cast(registry[view].schema[feat].dataType).alias(feat))
    return df.select(*[F.col(k) for k in registry[refs[0].split(':')[0]].entity_keys], *cols)


REFS = ["user_features:cardholder_age", "user_features:device_trust_score",
        "user_features:velocity_last_24h", "user_features:amount"]


@query("feature_refs_select", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + """
SELECT user_id, CAST(cardholder_age AS INTEGER) AS cardholder_age,
       CAST(device_trust_score AS DOUBLE) AS device_trust_score,
       CAST(velocity_last_24h AS INTEGER) AS velocity_last_24h, amount
FROM snapshot""")
def feature_refs_select(spark, sf_dir):
    return resolve_refs(snapshot(Tables(spark, sf_dir)), REFS)


@query("pruned_scan", sql="SELECT l_orderkey, l_extendedprice FROM lineitem")
def pruned_scan(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")


@query("pushed_filter_scan", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem
WHERE l_extendedprice > 50000 AND l_returnflag = 'R'""")
def pushed_filter_scan(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return (li.where((F.col("l_extendedprice") > 50000) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"))


@query("partition_pruned_scan", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem WHERE year(l_shipdate) = 1995 AND month(l_shipdate) = 12""")
def partition_pruned_scan(spark, sf_dir):
    """Write lineitem partitioned by year/month, then read one partition back."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    path = fs.write_parquet(li.hint("rebalance", "year", "month"), scratch_path(spark, "lineitem-ym"),
                            partition_by=["year", "month"])
    back = spark.read.schema("l_orderkey long, l_linenumber int, l_quantity double, year int, month int") \
        .parquet(path)
    return back.where((F.col("year") == 1995) & (F.col("month") == 12))


@query("sql_external_count", sql="""
SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice > 50000""")
def sql_external_count(spark, sf_dir):
    name = "lineitem_ext"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING parquet "
              f"OPTIONS (path '{table_path(sf_dir, 'lineitem')}')")
    return spark.sql(f"SELECT count(*) AS n FROM {name} WHERE l_returnflag = 'R' AND l_extendedprice > 50000")


@query("add_timestamps", sql="""
WITH o AS (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, CAST(o.last_order AS TIMESTAMP) AS "timestamp",
       CAST((SELECT max(o_orderdate) FROM orders) AS TIMESTAMP) AS created_timestamp
FROM customer LEFT JOIN o ON c_custkey = o_custkey""")
def add_timestamps(spark, sf_dir):
    """Customers have no times: their latest order gives the event time (null
    without one), the latest of all orders the created time; written to a new path
    (never over the input) and read back."""
    orders = read_table(spark, sf_dir, "orders")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").cast("timestamp_ntz").alias("timestamp"))
    newest = orders.agg(F.max("o_orderdate").cast("timestamp_ntz")).scalar()
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    out = cust.join(last, F.col("c_custkey") == F.col("o_custkey"), "left") \
        .select("c_custkey", "c_name", "timestamp", newest.alias("created_timestamp"))
    path = fs.write_parquet(out, scratch_path(spark, "customer-ts"))
    return spark.read.parquet(path)


@query("materialize_to_store", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + "SELECT * FROM snapshot")
def materialize_to_store(spark, sf_dir):
    """Distributed append of the snapshot to the store (Parquet here), read back."""
    path = scratch_path(spark, "online-store")
    fs.save_to_store(snapshot(Tables(spark, sf_dir)), path, fmt="parquet", mode="append")
    return spark.read.parquet(path)


MID = "2024-01-10 00:00:00"


@query("upsert_snapshot", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + "SELECT * FROM snapshot")
def upsert_snapshot(spark, sf_dir):
    """Snapshot up to MID, then upsert the batch (MID, AS_OF]: equals the snapshot at AS_OF."""
    old, new = _versions(Tables(spark, sf_dir))
    path = scratch_path(spark, "snapshot-v1")
    fs.write_parquet(old, path)
    merged = on.upsert_snapshot(spark.read.parquet(path), new, "user_id", "event_timestamp", ["created_timestamp"])
    out = scratch_path(spark, "snapshot-v2")  # a new version, the old one stays readable
    fs.write_parquet(merged, out)
    return spark.read.parquet(out)


def _versions(t):
    """The snapshot at MID and the newest row per user of (MID, AS_OF], each from its own part of
    the events: the time filter reaches both scans."""
    old = on.materialize_latest(transactions_in_range(t, START, MID), START, MID)
    later = transactions_in_range(t, MID, AS_OF).where(F.col("timestamp") > F.lit(MID).cast("timestamp_ntz"))
    return old, on.materialize_latest(later, START, AS_OF)


@query("upsert_bucketed", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + "SELECT * FROM snapshot")
def upsert_bucketed(spark, sf_dir):
    """The same in a bucketed store: created empty with its schema, filled, then merged with the
    batch without an exchange of the stored rows."""
    old, new = _versions(Tables(spark, sf_dir))
    store = st.create_if_absent(spark, st.version_name("online_store"), old.schema, "user_id")
    order = ["event_timestamp", "created_timestamp"]
    first = st.upsert(store, old, st.version_name("online_store"), "user_id", order)
    return st.upsert(first, new, st.version_name("online_store"), "user_id", order)


@query("lookup_bucketed", sql=S.with_(S.TRANSACTIONS, S.REQUESTS, S.snapshot_cte(START, AS_OF)) + """
SELECT r.transaction_id, r.user_id, r.amount, s.amount AS store_amount,
       s.velocity_last_24h AS store_velocity_last_24h, s.event_timestamp AS store_event_timestamp,
       s.user_id IS NOT NULL AS store_hit
FROM requests r LEFT JOIN snapshot s ON r.user_id = s.user_id""")
def lookup_bucketed(spark, sf_dir):
    """Lookup in a bucketed store: only the requests are exchanged."""
    t = Tables(spark, sf_dir)
    store = st.write(live_snapshot(t), st.version_name("online_store"), "user_id")
    j = on.online_lookup(ad.requests(t), store, "user_id")
    return j.select("transaction_id", "user_id", "amount", "store_amount", "store_velocity_last_24h",
                    "store_event_timestamp", "store_hit")


@query("project_online_schema", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte(START, AS_OF)) + """
SELECT user_id, amount, CAST(transaction_hour AS INTEGER) AS transaction_hour, merchant_category,
       CAST(foreign_transaction AS INTEGER) AS foreign_transaction,
       CAST(location_mismatch AS INTEGER) AS location_mismatch,
       CAST(device_trust_score AS DOUBLE) AS device_trust_score,
       CAST(velocity_last_24h AS INTEGER) AS velocity_last_24h,
       CAST(cardholder_age AS INTEGER) AS cardholder_age, event_timestamp
FROM snapshot""")
def project_online_schema(spark, sf_dir):
    """Fallback write path: the whole snapshot projected onto the online schema
    (absent columns get defaults, present ones are cast)."""
    snap = snapshot(Tables(spark, sf_dir)).drop("created_timestamp")
    return fs.conform(snap, ONLINE_USER_SCHEMA, defaults={"velocity_last_24h": 0})


@query("online_rows_typed", sql=S.with_(S.TRANSACTIONS) + """
SELECT transaction_id, amount, CAST(transaction_hour AS INTEGER) AS transaction_hour,
       merchant_category, CAST(foreign_transaction AS INTEGER) AS foreign_transaction,
       CAST(location_mismatch AS INTEGER) AS location_mismatch,
       CAST(device_trust_score AS DOUBLE) AS device_trust_score,
       CAST(velocity_last_24h AS INTEGER) AS velocity_last_24h,
       CAST(cardholder_age AS INTEGER) AS cardholder_age, CAST(is_fraud AS INTEGER) AS is_fraud
FROM transactions""")
def online_rows_typed(spark, sf_dir):
    """Rows typed for the transaction table: key as string, doubles, ints."""
    tx = ad.transactions(Tables(spark, sf_dir))
    schema = T.StructType([T.StructField("transaction_id", T.StringType())]
                          + [f for f in ONLINE_USER_SCHEMA.fields if f.name not in ("user_id", "event_timestamp")]
                          + [T.StructField("is_fraud", T.IntegerType())])
    return fs.conform(tx, schema)


@query("codec_roundtrip", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS codec, count(*) AS n_rows, round(sum(l_extendedprice), 2) AS total FROM lineitem"
    for c in ("snappy", "gzip", "zstd")))
def codec_roundtrip(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    parts = []
    for codec in ("snappy", "gzip", "zstd"):
        path = fs.write_parquet(li, scratch_path(spark, f"lineitem-{codec}"), codec=codec)
        back = spark.read.parquet(path)
        parts.append(back.agg(F.count(F.lit(1)).alias("n_rows"),
                              F.round(F.sum("l_extendedprice"), 2).alias("total"))
                     .select(F.lit(codec).alias("codec"), "n_rows", "total"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
