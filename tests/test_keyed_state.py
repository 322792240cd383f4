"""Keyed streaming state: exact counts with late rows, state that ends, alerts on streams."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from tessera.operators import latency as lt
from tessera.plans.q_streams import finished
from tessera.session import scratch_path
from tessera.streaming import state as ks
from tessera.streaming import streams as st

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def arriving(spark, rows, schema, per_file=60):
    """Files of ``rows`` in the given order, replayed one by one."""
    src = scratch_path(spark, "arriving")
    for at in range(0, len(rows), per_file):
        before = st.data_files(spark, src)
        spark.createDataFrame(rows[at:at + per_file], schema).coalesce(1).write.mode("append").parquet(src)
        st.set_arrival_order(spark, sorted(st.data_files(spark, src) - before))
        time.sleep(0.01)
    files = sorted(st.data_files(spark, src), key=lambda f: st._fs(spark, f)[0].getFileStatus(
        st._fs(spark, f)[1]).getModificationTime())
    st.set_arrival_order(spark, files)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def made_events(seed, n=170, keys=("hot", "hot", "hot", "a", "b", None), late=3_000):
    """(id, key, time) in order of arrival, up to ``late`` seconds after their time; last a
    heartbeat far ahead."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = rnd.randint(0, 5 * 86_400)
        rows.append((at + rnd.randint(0, late), (i, rnd.choice(keys), T0 + dt.timedelta(seconds=at))))
    rows = [r for _, r in sorted(rows, key=lambda x: x[0])]
    return rows, rows + [(None, "beat", T0 + dt.timedelta(days=30))]


def last_state_rows(spark, checkpoint):
    return spark.read.format("statestore").load(checkpoint)


def test_trailing_counts_with_late_rows_and_a_hot_key(spark):
    rows, arrived = made_events(1)
    stream = arriving(spark, arrived, "id bigint, k string, t timestamp")
    width = 86_400
    out = ks.trailing_counts(stream, "k", "t", "id", width, "1 hour", 2)
    got = {r["id"]: (r["k"], r["n"]) for r in finished(spark, out, "counts").collect() if r["id"] is not None}
    want = {i: (k, sum(1 for _, k2, t2 in rows if k2 == k and t - dt.timedelta(seconds=width) <= t2 < t))
            for i, k, t in rows}
    assert got == want


def run_kept(spark, frame, mode="append"):
    """Runs a frame to its end and gives its query's last progress."""
    ks.use_keyed_state(spark)
    q = (frame.writeStream.foreachBatch(lambda df, i: df.count()).outputMode(mode)
         .option("checkpointLocation", scratch_path(spark, "kept")).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_state_is_gone_after_the_horizon(spark):
    _, arrived = made_events(2, 60)
    out = ks.trailing_counts(arriving(spark, arrived, "id bigint, k string, t timestamp"), "k", "t", "id", 7_200,
                             "1 hour", 1)
    ops = run_kept(spark, out).lastProgress["stateOperators"]
    # what is left belongs to the heartbeat: its open window, and its slice with what leaves it
    assert sum(o["numRowsTotal"] for o in ops if o["operatorName"] == "stateStoreSave") <= 1
    assert all(o["numRowsTotal"] <= 12 for o in ops), ops
    gone = ks.expired_rows(arriving(spark, arrived, "id bigint, k string, t timestamp"), "k", "t", 24, "1 hour", 3600)
    ops = run_kept(spark, gone).lastProgress["stateOperators"]
    assert all(o["numRowsTotal"] <= 6 for o in ops), ops


def test_a_key_is_dealt_over_tasks(spark):
    """The state's exchange is by key and slice, never by the key alone."""
    _, arrived = made_events(3, 10)
    out = ks.trailing_counts(arriving(spark, arrived, "id bigint, k string, t timestamp"), "k", "t", "id")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "slice" in plan.split("TransformWithState")[1].split("\n")[0]


def test_state_calls_follow_buckets_not_keys(spark):
    """Many keys of one slice share the state of a few buckets; their counts stay their own."""
    keys = 300
    rows = [(i, f"k{i % keys}", T0 + dt.timedelta(seconds=7 * i)) for i in range(2 * keys)]
    stream = arriving(spark, rows + [(None, "beat", T0 + dt.timedelta(hours=12))], "id bigint, k string, t timestamp", 1_000)
    out = ks.trailing_counts(stream, "k", "t", "id")
    ops = [o for p in run_kept(spark, out).recentProgress for o in p["stateOperators"] if "ransformWithState" in o["operatorName"]]
    assert ops and max(o["numRowsTotal"] for o in ops) < 1_000  # with a state for each key over 3,000
    got = {r["id"]: (r["k"], r["n"]) for r in finished(spark, out, "buckets").collect()}
    assert {i: (k, i // keys) for i, k, _ in rows} == {i: x for i, x in got.items() if i is not None}


def test_expired_rows_against_plain(spark):
    rows, arrived = made_events(4, 110)
    out = ks.expired_rows(arriving(spark, arrived, "id bigint, k string, t timestamp"), "k", "t", 12, "1 hour", 3_600)
    got = sorted((str(r["k"]), r["expired_at"] - r["last_seen"], r["last_seen"].timestamp())
                 for r in finished(spark, out, "gone").collect() if r["k"] != "beat")
    ttl = dt.timedelta(hours=12)
    want = sorted((str(k), ttl, t.timestamp()) for k, t in {(k, t) for _, k, t in rows}
                  if not any(k2 == k and t < t2 <= t + ttl for _, k2, t2 in rows))
    assert got == want and len(want) > 5


def test_expiry_calls_follow_buckets_not_keys(spark):
    """Many keys share the state and the timer of a few buckets; each expires at its own time."""
    keys = 400
    rows = [(i, f"k{i % keys}", T0 + dt.timedelta(seconds=97 * i)) for i in range(2 * keys)]
    rows.insert(0, (None, None, T0))
    stream = arriving(spark, rows + [(None, "beat", T0 + dt.timedelta(days=6))], "id bigint, k string, t timestamp", 250)
    out = ks.expired_rows(stream, "k", "t", 8, "1 hour", 3_600)
    ops = [o for p in run_kept(spark, out).recentProgress for o in p["stateOperators"]]
    assert ops and max(o["numRowsTotal"] for o in ops) < keys  # with a state and a timer for each key three times as many
    got = {(r["k"], r["last_seen"].timestamp()) for r in finished(spark, out, "expiry-buckets").collect()}
    ttl = dt.timedelta(hours=8)
    assert got == {(k, t.timestamp()) for _, k, t in rows if not any(k2 == k and t < t2 <= t + ttl for _, k2, t2 in rows)}


def test_online_state_is_forgotten_by_the_clock(spark):
    src, ck = scratch_path(spark, "clock"), scratch_path(spark, "clock-ck")
    root = scratch_path(spark, "clock-out")
    ks.use_keyed_state(spark)

    def step(name, rows):
        spark.createDataFrame(rows, "k string, t timestamp").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k string, t timestamp").parquet(src)
        out = ks.online_changes(stream, "k", "t", ttl_hours=30 / 3600)
        q = (out.writeStream.foreachBatch(lambda df, i: df.write.mode("append").parquet(f"{root}/{name}"))
             .outputMode("update").option("checkpointLocation", ck).trigger(once=True).start())
        assert q.awaitTermination(120)
        return {r["k"]: r["known"] for r in spark.read.parquet(f"{root}/{name}").collect()}

    at = lambda h: T0 + dt.timedelta(hours=h)
    assert step("a", [("x", at(0)), ("x", at(1)), (None, at(1))]) == {"x": False, None: False}
    assert step("b", [("x", at(2)), (None, at(0))]) == {"x": True}  # an older row changes nothing
    time.sleep(31)
    assert step("c", [("x", at(3))]) == {"x": False}  # forgotten


def test_alert_runs_with_gaps_and_mixed_files(spark):
    rnd = random.Random(5)
    rows = []
    for minute in [*range(0, 30), *range(33, 50), *range(52, 75)]:
        bad = 10 <= minute < 42 or minute > 60
        for _ in range(rnd.randint(1, 4)):
            at = minute * 60 + rnd.randint(0, 59)
            rows.append((at + rnd.randint(0, 900), (T0 + dt.timedelta(seconds=at), 20.0 if bad else 5.0,
                                                    rnd.random() > (0.5 if bad else 0.0))))
    rows = [r for _, r in sorted(rows, key=lambda x: x[0])]
    schema = "t timestamp, ms double, success boolean"
    stream = arriving(spark, rows + [(T0 + dt.timedelta(days=2), 1.0, True)], schema, 60)
    got = finished(spark, ks.alert_runs(stream, "t", "ms", lateness="30 minutes"), "alerts")
    want = lt.alert_rules(spark.createDataFrame(rows, schema), "t", "ms")
    cols = ["rule", "window_start", "requests", "holds", "firing"]
    key = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert key(got) == key(want)
    assert {r[4] for r in key(want)} == {True, False}


def test_bucket_quantile_like_the_histogram(spark):
    rnd = random.Random(6)
    rows = [("a" if i % 3 else None, rnd.choice([0.001, 0.02, 0.3, 4.0, 30.0])) for i in range(60)] + [("one", 0.2)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.01, 0.5, 0.95, 1.0):
        want = {r["g"]: r["quantile"] for r in lt.histogram_quantile(lt.histogram(df, ["g"], "v"), ["g"], q).collect()}
        counts = [F.count(F.when(lt.bucket_index("v", lt.DEFAULT_BUCKETS) == i, 1)).alias(f"c{i}") for i in range(15)]
        per = df.groupBy("g").agg(*counts)
        got = {r["g"]: r["quantile"] for r in per.select("g", lt.bucket_quantile(
            [F.col(f"c{i}") for i in range(15)], lt.DEFAULT_BUCKETS, q).alias("quantile")).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
