"""Queries: Structured Streaming (2.11 SR1-SR8), each run to completion with
Trigger.AvailableNow over event files derived from the events table, then read
back as a batch table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import sql as S
from tessera.plans.q_online import AS_OF
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources import adapters as ad
from tessera.sources.schemas import FRAUD_FEATURES, TABLE_SCHEMAS
from tessera.sources.tables import Tables
from tessera.plans import q_latency as ql
from tessera.streaming import state as ks
from tessera.streaming import streams as st

N_FILES = 6
ROWS_PER_FILE = 1_000_000
MID = "2024-01-10 00:00:00"

SNAP_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()),
                            T.StructField("timestamp", T.TimestampNTZType()),
                            T.StructField("created_timestamp", T.TimestampNTZType()),
                            T.StructField("transaction_id", T.StringType())]
                           + [f for f in T.StructType([
                               T.StructField("amount", T.DoubleType()),
                               T.StructField("transaction_hour", T.LongType()),
                               T.StructField("merchant_category", T.StringType()),
                               T.StructField("foreign_transaction", T.LongType()),
                               T.StructField("location_mismatch", T.LongType()),
                               T.StructField("device_trust_score", T.LongType()),
                               T.StructField("velocity_last_24h", T.LongType()),
                               T.StructField("cardholder_age", T.LongType())]).fields])
ORDER = ["timestamp", "created_timestamp", "transaction_id"]


def event_files(spark, sf_dir, where=None, path=None, late_seconds=0):
    """Write events as files in time order, so the file source (oldest file first)
    replays them as an arriving stream.  With ``late_seconds`` an event arrives up to so much
    later, by a hash of its id, and so out of order within and across files.

    One parallel write, a file per time range of about a million rows; the driver
    only sets the files' times, in the order of their ranges."""
    e = Tables(spark, sf_dir).events
    if where is not None:
        e = e.where(where)
    path = path or scratch_path(spark, "event-files")
    n = e.agg(F.count(F.lit(1))).first()[0]
    if not n:
        return path
    files = max(N_FILES, -(-n // ROWS_PER_FILE))
    before = st.data_files(spark, path)
    if late_seconds:
        late = F.pmod(F.xxhash64("event_id"), F.lit(late_seconds)).cast("int")
        e = e.withColumn("_arrival", F.col("ts") + F.make_dt_interval(secs=late.cast("decimal(18,6)")))
    else:
        e = e.withColumn("_arrival", F.col("ts"))
    e.repartitionByRange(files, "_arrival").sortWithinPartitions("_arrival").drop("_arrival") \
        .write.mode("append").parquet(path)
    st.set_arrival_order(spark, sorted(st.data_files(spark, path) - before))
    return path


def event_stream(spark, path, files_per_trigger=1):
    return (spark.readStream.schema(TABLE_SCHEMAS["events"]).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def _snapshot_stream(spark, src):
    tx = ad.transactions_from(event_stream(spark, src), with_velocity=False)
    return tx.select(*[f.name for f in SNAP_SCHEMA.fields])


FULL_SNAP_SQL = S.with_(S.TRANSACTIONS, S.snapshot_cte("1900-01-01 00:00:00", "2100-01-01 00:00:00")) + """
SELECT user_id, amount, merchant_category, event_timestamp FROM snapshot"""


@query("stream_upsert", sql=FULL_SNAP_SQL)
def stream_upsert(spark, sf_dir):
    """Event stream -> per-batch keyed upsert into the online snapshot (last write wins)."""
    src = event_files(spark, sf_dir)
    root, ck = scratch_path(spark, "stream-snapshot"), scratch_path(spark, "stream-ck")
    st.run_available_now(_snapshot_stream(spark, src), st.upsert_sink(root, ["user_id"], ORDER, SNAP_SCHEMA), ck)
    snap = st.read_snapshot(spark, root, ["user_id"], ORDER, SNAP_SCHEMA)
    return snap.select("user_id", "amount", "merchant_category", F.col("timestamp").alias("event_timestamp"))


@query("incremental_materialize", sql=FULL_SNAP_SQL)
def incremental_materialize(spark, sf_dir):
    """Two runs on one checkpoint: the second sees only files added after the first
    (the high-water mark lives in the checkpoint), and upserts them."""
    src = scratch_path(spark, "event-files")
    root, ck = scratch_path(spark, "inc-snapshot"), scratch_path(spark, "inc-ck")
    sink = st.upsert_sink(root, ["user_id"], ORDER, SNAP_SCHEMA)
    event_files(spark, sf_dir, F.col("ts") < F.lit(MID).cast("timestamp_ntz"), src)
    st.run_available_now(_snapshot_stream(spark, src), sink, ck)
    event_files(spark, sf_dir, F.col("ts") >= F.lit(MID).cast("timestamp_ntz"), src)
    st.run_available_now(_snapshot_stream(spark, src), sink, ck)
    snap = st.read_snapshot(spark, root, ["user_id"], ORDER, SNAP_SCHEMA)
    return snap.select("user_id", "amount", "merchant_category", F.col("timestamp").alias("event_timestamp"))


@query("stream_velocity", sql="""
WITH w AS (SELECT user_id, date_trunc('hour', ts) - to_hours(k) AS window_start
           FROM events, range(0, 24) r(k))
SELECT user_id, window_start, window_start + INTERVAL 24 HOUR AS window_end, count(*) AS events
FROM w GROUP BY ALL""")
def stream_velocity(spark, sf_dir):
    """Events per user in 24-hour windows sliding by one hour, with a watermark;
    update-mode output upserted per (user, window) — the last update is final."""
    src = event_files(spark, sf_dir)
    root, ck = scratch_path(spark, "velocity"), scratch_path(spark, "velocity-ck")
    ev = event_stream(spark, src).withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need TIMESTAMP
    counts = st.sliding_counts(ev, "user_id", "ts", "24 hours", "1 hour", "2 hours") \
        .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("window_start", T.TimestampNTZType()),
                           T.StructField("window_end", T.TimestampNTZType()), T.StructField("events", T.LongType()),
                           T.StructField("_batch", T.LongType())])
    upsert = st.upsert_sink(root, ["user_id", "window_start"], ["_batch"], schema)

    def sink(batch, batch_id):
        upsert(batch.withColumn("_batch", F.lit(batch_id).cast("long")), batch_id)

    st.run_available_now(counts, sink, ck, output_mode="update")
    return st.read_snapshot(spark, root, ["user_id", "window_start"], ["_batch"], schema).drop("_batch")


TTL_HOURS = 48
LATE = 7_000  # seconds that events arrive late, under the watermarks' two hours


def late_stream(spark, sf_dir):
    """Events out of order within the lateness, and last a heartbeat without a user some days
    after all others: what moves the watermark on when a source falls silent."""
    src = event_files(spark, sf_dir, late_seconds=LATE)
    before = st.data_files(spark, src)
    e = Tables(spark, sf_dir).events
    beat = e.agg(F.max("ts").alias("last")).where("last IS NOT NULL") \
        .select((F.col("last") + F.expr("INTERVAL 4 DAYS")).alias("ts"))
    beat.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name)
                  for f in TABLE_SCHEMAS["events"].fields]).write.mode("append").parquet(src)
    st.set_arrival_order(spark, sorted(st.data_files(spark, src) - before))
    return event_stream(spark, src).withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need TIMESTAMP


def finished(spark, frame, name):
    """All rows that a streaming frame gives out, as a batch table."""
    ks.use_keyed_state(spark)
    root, ck = scratch_path(spark, name), scratch_path(spark, f"{name}-ck")
    st.run_available_now(frame, st.append_sink(root), ck)
    return spark.read.schema(frame.schema).parquet(root).select(*frame.columns)


@query("stream_velocity_exact", sql="""
SELECT event_id, user_id,
       count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING) AS velocity_24h
FROM events""")
def stream_velocity_exact(spark, sf_dir):
    """Exact trailing 24 h count per event of a stream with late rows: keys dealt over slices of
    six hours with carried counts, each slice's state gone when the watermark has passed it."""
    out = ks.trailing_counts(late_stream(spark, sf_dir), "user_id", "ts", "event_id")
    return finished(spark, out.withColumnRenamed("n", "velocity_24h"), "exact-velocity").where("event_id IS NOT NULL")


@query("stream_ttl_expiry", sql="""
SELECT user_id, ts AS last_seen, ts + INTERVAL 48 HOUR AS expired_at
FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)
WHERE next IS NULL OR next > ts + INTERVAL 48 HOUR""")
def stream_ttl_expiry(spark, sf_dir):
    """Every time that a user's online row got 48 hours old, told by event-time timers on a
    stream with late rows."""
    out = ks.expired_rows(late_stream(spark, sf_dir), "user_id", "ts", TTL_HOURS)
    return finished(spark, out, "expired").select(
        "user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("last_seen", "expired_at")]) \
        .where("user_id IS NOT NULL")


def _requests(spark, sf_dir):
    return ad.request_log_from(late_stream(spark, sf_dir))


def _plain_times(df):
    """In the batch queries' type of times."""
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_alert_rules", sql=ql.alert_sql())
def stream_alert_rules(spark, sf_dir):
    """The stated alerts on a stream with late rows: minute windows, then runs over them."""
    out = finished(spark, ks.alert_runs(_requests(spark, sf_dir), "ts", "latency_ms"), "alerts")
    return _plain_times(out)


@query("stream_rates_1m", sql=ql.rates_sql(1))
def stream_rates_1m(spark, sf_dir):
    """Requests per second and error ratio per endpoint and minute, on a stream with late rows."""
    out = finished(spark, ks.stream_rates(_requests(spark, sf_dir), "ts", "1 minute", ["endpoint"]), "rates")
    return _plain_times(out)


@query("stream_histogram_quantile", sql=ql.QUANTILE_SQL)
def stream_histogram_quantile(spark, sf_dir):
    """Daily P95 per endpoint from bucket counters, on a stream with late rows."""
    calls = _requests(spark, sf_dir).withColumn("latency_s", F.col("latency_ms") / 1000.0)
    out = finished(spark, ks.stream_quantiles(calls, "ts", "1 day", ["endpoint"], "latency_s", 0.95), "quantiles")
    return _plain_times(out)



@query("ttl_expire", sql=S.with_(S.TRANSACTIONS, S.snapshot_cte("2023-11-21 00:00:00", AS_OF)) + f"""
SELECT user_id, event_timestamp, event_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL {TTL_HOURS} HOUR AS expired
FROM snapshot""")
def ttl_expire(spark, sf_dir):
    """Online rows older than the TTL (48 h before the as-of time) are marked expired."""
    from tessera.plans.q_online import snapshot
    snap = snapshot(Tables(spark, sf_dir))
    cut = F.lit(AS_OF).cast("timestamp_ntz") - F.expr(f"INTERVAL {TTL_HOURS} HOURS")
    return snap.select("user_id", "event_timestamp", (F.col("event_timestamp") < cut).alias("expired"))
