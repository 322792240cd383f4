"""Keyed state that expires: exact trailing counts, time-to-live of online rows and alert
runs, with ``transformWithState`` (list and value state, event-time timers, state
time-to-live).  The queries need the RocksDB state store (``use_keyed_state``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tessera.operators import latency as lt

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SECOND = 1_000_000


def use_keyed_state(spark: SparkSession) -> None:
    """``transformWithState`` works on this state store only."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


_NO_ID = -(1 << 63)


def _coded(key: str):
    """A key as a string that is never null: pandas would turn whole numbers beside a null
    into floats, which are other keys to the state store."""
    return F.when(F.col(key).isNull(), "").otherwise(F.concat(F.lit("="), F.col(key).cast("string")))


def _decoded(stream: DataFrame, key: str):
    return F.when(F.col("key") != "", F.substring("key", 2, 1 << 30).cast(stream.schema[key].dataType)).alias(key)


# exact trailing counts ------------------------------------------------------------

_EVENT, _LEAVES, _CARRIED = 0, 1, 2
_PACKED = ("key", "kind", "at", "id", "n")


class TrailingCount(StatefulProcessor):
    """One (bucket of keys, slice): the keys' events, the times at which earlier events leave the
    window inside it, and how many the window held when it began, as packed columns (a state
    call for some thousand rows).  When the watermark has passed the slice no row of it can
    still come: the counts go out, the state goes."""

    def __init__(self, slice_us: int):
        self.slice_us = slice_us

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "packed binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for p in rows:
            self.rows.appendList([(_pack(p[list(_PACKED)]),)])
        self.handle.registerTimer(-(-(int(key[1]) + 1) * self.slice_us // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t = pa.concat_tables([_unpacked(x[0]) for x in self.rows.get()])
        self.rows.clear()
        keys = pc.dictionary_encode(t["key"].combine_chunks())
        kind, at, n = (t[c].to_numpy() for c in ("kind", "at", "n"))
        code, own = keys.indices.to_numpy().astype(np.int64), kind == _EVENT
        if own.any():
            held = np.zeros(len(keys.dictionary), np.int64)
            np.add.at(held, code[kind == _CARRIED], n[kind == _CARRIED])
            # all times lie in the slice, so (key, time) is one number
            place = code * self.slice_us + (at - int(key[1]) * self.slice_us)
            mine, first = place[own], code[own] * self.slice_us
            before = lambda x: np.searchsorted(x, mine, "left") - np.searchsorted(x, first, "left")
            n = held[code[own]] + before(np.sort(mine)) - before(np.sort(place[kind == _LEAVES]))
            yield pd.DataFrame({"key": keys.dictionary.take(pa.array(code[own])).to_pandas(),
                                "id": t["id"].to_numpy()[own], "n": n.astype(np.int64)})

    def close(self) -> None:
        pass


def _pack(rows: pd.DataFrame) -> bytes:
    return _packed_table(pa.Table.from_pandas(rows, preserve_index=False))


def _packed_table(t: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(rows).read_all()


def trailing_counts(stream: DataFrame, key: str, ts: str, id_col: str, width: int = 86_400,
                    lateness: str = "2 hours", slices: int = 4, buckets: int = 32) -> DataFrame:
    """(``key``, ``id_col``, n): per event the number of its key's events in [ts - width, ts),
    once and for all: it goes out when the watermark has passed the event's slice, so
    every row that is less than ``lateness`` late has been counted, whenever it came.

    Keys are dealt over time slices (``width`` seconds hold ``slices``), so no task holds a
    key's whole window: a window aggregate (combined before its shuffle) counts each slice
    and carries the number to the slices after it; an event also goes to the slice in which
    it leaves the window.  The keys of a slice share the state of ``buckets``: state calls follow
    the buckets, not the keys.  Null times are dropped, a null key is a key; the state of a slice
    lives from its first row until the watermark passes its end.  ``id_col`` is a long.
    """
    if width % slices:
        raise ValueError("a window must hold whole slices")
    size = width // slices
    slice_us = size * _SECOND
    w = F.window(ts, f"{size} seconds")
    marked = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness)
    nothing = F.lit(0).cast("long")
    at = F.unix_micros(ts)
    # the window's last moment tells late rows as the window does, and passes to Python as one number
    ends, bucket = F.window_time("w").alias("ends"), F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")

    def rows(kind: int, when):
        return marked.select(w.alias("w"), _coded(key).alias("key"), F.floor(when / slice_us).cast("long").alias("slice"),
                             F.lit(kind).alias("kind"), when.alias("at"),
                             F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), nothing.alias("n")) \
            .select(ends, bucket, "slice", *_PACKED)

    counted = marked.groupBy(w.alias("w"), _coded(key).alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .select("w", ends, "key", "n")
    first = F.floor(F.unix_micros("w.start") / slice_us).cast("long")
    carried = counted.select("ends", bucket, F.explode(F.sequence(first + 1, first + slices)).alias("slice"), "key",
                             F.lit(_CARRIED).alias("kind"), nothing.alias("at"), nothing.alias("id"), "n")
    every = rows(_EVENT, at).unionByName(rows(_LEAVES, at + width * _SECOND)).unionByName(carried)
    return every.groupBy("bucket", "slice").transformWithStateInPandas(
        TrailingCount(slice_us), "key string, id bigint, n bigint", "append", "EventTime") \
        .select(_decoded(stream, key), F.nullif(F.col("id"), F.lit(_NO_ID)).alias(id_col), "n")


# time-to-live -----------------------------------------------------------------------

class Expiry(StatefulProcessor):
    """One bucket of keys: the times of those whose row may yet expire, as packed columns: the times
    without a later one within the time-to-live, and those that a late row could still come before.
    One timer, for the first expiry of the bucket, so state calls follow the buckets, not the keys."""

    def __init__(self, ttl_us: int, lateness_us: int):
        self.ttl_us, self.lateness_us = ttl_us, lateness_us

    def init(self, handle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "packed binary")

    def _sorted(self, new: list[pa.Table]):
        """Keys, each row's place among them and its time, by key and time, and which rows have no later one
        of their key within the time-to-live."""
        t = pa.concat_tables([_unpacked(x[0]) for x in self.times.get()] + new).select(["key", "at"])
        coded = pc.dictionary_encode(t["key"].combine_chunks())
        code, at = coded.indices.to_numpy().astype(np.int64), t["at"].to_numpy()
        order = np.lexsort((at, code))
        code, at = code[order], at[order]
        once = np.append(True, (np.diff(code) != 0) | (np.diff(at) != 0))[:len(at)]
        code, at = code[once], at[once]
        last = np.append((np.diff(code) != 0) | (np.diff(at) > self.ttl_us), True)[:len(at)]
        return coded.dictionary, code, at, last

    def _due(self, at: np.ndarray) -> np.ndarray:
        return -(-(at + self.ttl_us) // 1000)

    def _keep(self, keys: pa.Array, code: np.ndarray, at: np.ndarray, last: np.ndarray, keep: np.ndarray) -> None:
        if not keep.any():
            self.times.clear()
            return
        self.times.put([(_packed_table(pa.table({"key": keys.take(pa.array(code[keep])), "at": at[keep]})),)])
        if last[keep].any():
            self.handle.registerTimer(int(self._due(at[keep & last].min())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        keys, code, at, last = self._sorted([pa.Table.from_pandas(
            p[["key", "at"]], pa.schema([("key", pa.string()), ("at", pa.int64())]), preserve_index=False) for p in rows])
        recent = at > timerValues.getCurrentWatermarkInMs() * 1000 - self.lateness_us
        self._keep(keys, code, at, last, last | recent)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.times.exists():
            return
        keys, code, at, last = self._sorted([])
        due = last & (self._due(at) <= timerValues.getCurrentWatermarkInMs())
        # what lies before an expired row of its key has gone with it
        gone = np.full(len(keys), np.iinfo(np.int64).min)
        np.maximum.at(gone, code[due], at[due])
        self._keep(keys, code, at, last, at > gone[code])
        if due.any():
            yield pd.DataFrame({"key": keys.take(pa.array(code[due])).to_pandas(), "last_us": at[due]})

    def close(self) -> None:
        pass


def expired_rows(stream: DataFrame, key: str, ts: str, ttl_hours: int = 48,
                 lateness: str = "2 hours", lateness_seconds: int = 7_200, buckets: int = 32) -> DataFrame:
    """(``key``, last_seen, expired_at): every time that a key's online row got older than the
    time-to-live without a newer one, told when the watermark has passed that moment.  Rows
    in any order within ``lateness`` give the same result; a key's state is a few times and goes
    with its expiry.  The keys share the state of ``buckets``: state calls follow these."""
    ttl_us = ttl_hours * 3600 * _SECOND
    marked = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness)
    rows = marked.select(F.col(ts), _coded(key).alias("key"), F.unix_micros(ts).alias("at")) \
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    gone = rows.groupBy("bucket").transformWithStateInPandas(
        Expiry(ttl_us, lateness_seconds * _SECOND), "key string, last_us bigint", "append", "EventTime")
    return gone.select(_decoded(stream, key), F.timestamp_micros("last_us").alias("last_seen"),
                       F.timestamp_micros(F.col("last_us") + ttl_us).alias("expired_at"))


class Newest(StatefulProcessor):
    """The newest time of a key, forgotten ``ttl_ms`` after its last change."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "at bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = max(int(p["at"].max()) for p in rows)
        known = self.newest.exists()
        if known and self.newest.get()[0] >= new:
            return iter(())
        self.newest.update((new,))
        return iter([pd.DataFrame({"key": [key[0]], "at": [new], "known": [known]})])

    def close(self) -> None:
        pass


def online_changes(stream: DataFrame, key: str, ts: str, ttl_hours: float = 48) -> DataFrame:
    """(``key``, ``ts``, known): the newest time of each key that a micro-batch moved forward, and
    whether the store still knew the key.  Its state has a time-to-live by the clock: a key
    unchanged for ``ttl_hours`` is forgotten by the store itself.  A query over it is for running
    triggers: by the clock there is always one more batch, so available-now runs do not end."""
    rows = stream.where(F.col(ts).isNotNull()).select(_coded(key).alias("key"), F.unix_micros(ts).alias("at"))
    return rows.groupBy("key").transformWithStateInPandas(
        Newest(int(ttl_hours * 3_600_000)), "key string, at bigint, known boolean", "update", "ProcessingTime") \
        .select(_decoded(stream, key), F.timestamp_micros("at").alias(ts), "known")


# alerts -------------------------------------------------------------------------------

class Runs(StatefulProcessor):
    """How many minutes in a row a rule has held up to its last window."""

    def init(self, handle) -> None:
        self.run = handle.getValueState("run", "minute bigint, length bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        p = pd.concat(list(rows), ignore_index=True).sort_values("minute", kind="stable")
        last, length = self.run.get() if self.run.exists() else (None, 0)
        firing = []
        for minute, holds, periods in zip(p["minute"].tolist(), p["holds"].tolist(), p["periods"].tolist(), strict=True):
            length = (length + 1 if last == minute - 1 else 1) if holds else 0
            last = minute
            firing.append(length >= periods)
        self.run.update((last, length))
        yield pd.DataFrame({"rule": p["rule"], "minute": p["minute"], "requests": p["requests"],
                            "holds": p["holds"], "firing": firing})

    def close(self) -> None:
        pass


def alert_runs(stream: DataFrame, ts: str, latency_ms: str, ok: str = "success", rules=lt.ALERT_RULES,
               lateness: str = "2 hours") -> DataFrame:
    """``latency.alert_rules`` on a stream: (rule, window_start, requests, holds, firing), a row per
    rule and minute with requests, when the watermark has passed it.

    Two stateful operators in one query: a window aggregate finds each minute's facts and
    lets go of the minute; the rules' runs go over these minutes, of which one is kept a rule.
    Windows leave the aggregate in the order of the watermark, so a run sees its minutes in
    order however late or mixed their requests came; a minute without requests ends it.
    """
    names = [r[0] for r in rules]
    minutes = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness) \
        .groupBy(F.window(ts, "1 minute").alias("w")) \
        .agg(F.count(F.lit(1)).alias("requests"), *lt.rule_holds(latency_ms, ok, rules))
    told = F.array(*[F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("periods"), F.col(n).alias("holds"))
                     for r, n in zip(rules, names, strict=True)])
    each = minutes.select("w", "requests", F.explode(told).alias("r")) \
        .select("w", F.floor(F.unix_seconds("w.start") / 60).cast("long").alias("minute"), "requests", "r.*")
    runs = each.groupBy("rule").transformWithStateInPandas(
        Runs(), "rule string, minute bigint, requests bigint, holds boolean, firing boolean", "append", "None")
    return runs.select("rule", F.timestamp_seconds(F.col("minute") * 60).alias("window_start"),
                       "requests", "holds", "firing")


def stream_rates(stream: DataFrame, ts: str, width: str, groups=(), ok: str = "success", flag: str | None = None,
                 lateness: str = "2 hours") -> DataFrame:
    """``latency.windowed_rates`` on a stream, in append mode: a window's row when it is over."""
    return lt.windowed_rates(stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness), ts, width, groups, ok, flag)


def stream_quantiles(stream: DataFrame, ts: str, width: str, groups, value_col: str, q: float,
                     bounds=lt.DEFAULT_BUCKETS, lateness: str = "2 hours") -> DataFrame:
    """``latency.histogram_quantile`` on a stream: (window_start, groups, quantile) from the buckets'
    counts of each window, one counter a bucket in the aggregate's state."""
    counts = [F.count(F.when(lt.bucket_index(value_col, bounds) == i, 1)).alias(f"_b{i}")
              for i in range(len(bounds) + 1)]
    per = stream.where(F.col(ts).isNotNull()).withWatermark(ts, lateness) \
        .groupBy(F.window(ts, width).alias("w"), *groups).agg(*counts)
    return per.select(F.col("w.start").alias("window_start"), *groups,
                      lt.bucket_quantile([F.col(f"_b{i}") for i in range(len(bounds) + 1)], bounds, q).alias("quantile"))
