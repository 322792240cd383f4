"""Sliding counts: the events are dealt by key before they are multiplied, with the same rows."""

import collections
import datetime as dt

from tessera.streaming.streams import sliding_counts

START = dt.datetime(2024, 1, 1)


def test_events_are_dealt_by_key_before_they_are_multiplied(spark):
    rows = [(None if i % 11 == 0 else i % 5, START + dt.timedelta(minutes=13 * i)) for i in range(300)]
    df = spark.createDataFrame([*rows, *rows[:20], (1, None)], "user bigint, ts timestamp")
    got = sliding_counts(df, "user", "ts", "24 hours", "1 hour", "2 hours")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and plan.index("Expand") < plan.index("RepartitionByExpression [user")
    want = collections.Counter()
    for user, ts in [*rows, *rows[:20]]:
        hour = ts.replace(minute=0)
        want.update((user, hour - dt.timedelta(hours=k)) for k in range(24))
    assert {(r["user"], r["window_start"]): r["events"] for r in got.collect()} == want
