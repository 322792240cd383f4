"""Edge tables (a few rows each) for the operators with tricky semantics."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.functions.ranking import interpolated_quantiles, positional_quantiles, prefix_sums
from tessera.functions.windows import trailing_sums
from tessera.operators import metrics as mt
from tessera.operators.asof import asof_join
from tessera.operators.online import fill_missing, latest_per_key, online_lookup

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def ts(**kw):
    return T0 + dt.timedelta(**kw)


def test_asof_boundaries(spark):
    ent = spark.createDataFrame([
        (1, "a", ts()),                      # feature exactly at entity time
        (2, "b", ts()),                      # feature exactly at the TTL bound
        (3, "c", ts()),                      # feature 1 microsecond outside the TTL
        (4, "d", ts()),                      # two features, same time, different created
        (5, "e", ts()),                      # no earlier feature (only a later one)
        (6, "z", ts()),                      # key only on the entity side
    ], "id long, k string, t timestamp_ntz")
    feat = spark.createDataFrame([
        ("a", ts(), ts(), 1.0),
        ("a", ts(hours=-1), ts(), 0.5),
        ("b", ts(hours=-2), ts(), 2.0),
        ("c", ts(hours=-2, microseconds=-1), ts(), 3.0),
        ("d", ts(minutes=-5), ts(minutes=1), 4.1),
        ("d", ts(minutes=-5), ts(minutes=2), 4.2),
        ("e", ts(minutes=5), ts(), 5.0),
        ("y", ts(minutes=-1), ts(), 9.0),    # key only on the feature side
    ], "k string, ft timestamp_ntz, ct timestamp_ntz, v double")
    for bucket in (60, 3600, 86_400):
        out = asof_join(ent, feat, ["k"], "t", "ft", ["v"], ttl_seconds=7200, created_col="ct",
                        bucket_seconds=bucket)
        got = {r["id"]: r["v"] for r in out.collect()}
        assert got == {1: 1.0, 2: 2.0, 3: None, 4: 4.2, 5: None, 6: None}, (bucket, got)


def test_asof_strict_excludes_same_time(spark):
    ent = spark.createDataFrame([(1, "a", ts())], "id long, k string, t timestamp_ntz")
    feat = spark.createDataFrame([("a", ts(), 1.0), ("a", ts(seconds=-1), 0.5)], "k string, ft timestamp_ntz, v double")
    out = asof_join(ent, feat, ["k"], "t", "ft", ["v"], strict=True).collect()
    assert out[0]["v"] == 0.5


def test_asof_matches_brute_force_hot_key(spark):
    rnd = random.Random(3)
    ents = [(i, "hot" if i % 3 else f"k{i % 7}", ts(seconds=rnd.randint(0, 400_000))) for i in range(300)]
    feats = [("hot" if i % 2 else f"k{i % 7}", ts(seconds=rnd.randint(0, 400_000)), float(i)) for i in range(300)]
    e = spark.createDataFrame(ents, "id long, k string, t timestamp_ntz")
    f = spark.createDataFrame(feats, "k string, ft timestamp_ntz, v double")
    ttl = 50_000
    got = {r["id"]: r["v"] for r in asof_join(e, f, ["k"], "t", "ft", ["v"], ttl_seconds=ttl,
                                               bucket_seconds=3600).collect()}
    for i, k, t in ents:
        cands = [(ft, v) for kk, ft, v in feats if kk == k and ft <= t and ft >= t - dt.timedelta(seconds=ttl)]
        want = max(cands)[1] if cands else None
        assert got[i] == want


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([
        ("u1", ts(), ts(minutes=1), "x"), ("u1", ts(), ts(minutes=2), "y"), ("u1", ts(hours=-1), ts(hours=5), "z"),
        (None, ts(), ts(), "n"),
    ], "k string, t timestamp_ntz, c timestamp_ntz, v string")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["t", "c"], ["v"]).collect()}
    assert got == {"u1": "y", None: "n"}


def test_fill_missing_zero_vs_null(spark):
    req = spark.createDataFrame([("t1", "u1", 0, None), ("t2", "u2", None, 5), ("t3", "u9", None, None)],
                                "transaction_id string, user_id string, transaction_hour long, velocity_last_24h long")
    store = spark.createDataFrame([("u1", 7, 3), ("u2", 8, 4)], "user_id string, transaction_hour long, velocity_last_24h long")
    j = online_lookup(req, store, "user_id")
    feats = ["transaction_hour", "velocity_last_24h"]
    null_mode = {r["transaction_id"]: (r["transaction_hour"], r["velocity_last_24h"], r["feature_source"])
                 for r in fill_missing(j, feats, falsy_missing=False, string_features=()).collect()}
    assert null_mode == {"t1": (0, 3, "store"), "t2": (8, 5, "store"), "t3": (None, None, "request")}
    falsy = {r["transaction_id"]: r["transaction_hour"]
             for r in fill_missing(j, feats, falsy_missing=True, string_features=()).collect()}
    assert falsy == {"t1": 7, "t2": 8, "t3": None}


def test_positional_quantiles(spark):
    for n in (1, 2, 20, 100):
        vals = list(range(1, n + 1))
        df = spark.createDataFrame([(float(v),) for v in vals], "x double")
        r = positional_quantiles(df, "x", {"p50": 0.5, "p95": 0.95, "p99": 0.99}).collect()[0]
        s = sorted(vals)
        assert r["p50"] == s[min(int(n * 0.5), n - 1)]
        assert r["p95"] == s[min(int(n * 0.95), n - 1)]
        assert r["p99"] == s[min(int(n * 0.99), n - 1)]
    eq = spark.createDataFrame([(3.0,)] * 7, "x double")
    assert positional_quantiles(eq, "x", {"p": 0.9}).collect()[0]["p"] == 3.0


def test_interpolated_quantiles_match_numpy(spark):
    import numpy as np
    rnd = random.Random(5)
    rows = [("g1" if i % 4 else "g2", float(rnd.randint(0, 50))) for i in range(201)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["q1"], r["q2"]) for r in interpolated_quantiles(df, "x", {"q1": 0.25, "q2": 0.9}, ["g"]).collect()}
    for g in ("g1", "g2"):
        xs = [x for gg, x in rows if gg == g]
        assert abs(got[g][0] - np.quantile(xs, 0.25)) < 1e-9
        assert abs(got[g][1] - np.quantile(xs, 0.9)) < 1e-9


def test_prefix_sums_hot_group_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 4)}", i, rnd.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, w long")
    got = {(r["g"], r["o"]): (r["w_before"], r["w_upto"]) for r in prefix_sums(df, "o", ["w"], ["g"], 6).collect()}
    for g, o, w in rows:
        before = sum(ww for gg, oo, ww in rows if gg == g and oo < o)
        assert got[(g, o)] == (before, before + w)


def test_trailing_window_bounds(spark):
    df = spark.createDataFrame([("u", ts(hours=-24)), ("u", ts()), ("u", ts(hours=-24, microseconds=-1)),
                                ("u", ts(hours=-5)), ("v", ts())], "k string, t timestamp_ntz")
    out = trailing_sums(df, ["k"], "t", {"n": (86_400, F.lit(1).cast("long"))})
    got = {(r["k"], r["t"]): r["n"] for r in out.collect()}
    assert got[("u", ts())] == 2          # exactly w earlier counts, 1 us more does not
    assert got[("v", ts())] == 0
    assert got[("u", ts(hours=-24))] == 1


def test_classification_metrics_edges(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (0, 1)], "y int, p int")
    pc = {r["label"]: r for r in mt.per_class(df, "y", "p", [-1, 0, 1]).collect()}
    assert pc[-1]["precision"] == 0.0 and pc[-1]["support"] == 0      # never present, never predicted
    assert pc[0]["recall"] == 0.0                                      # never predicted
    assert pc[1]["precision"] == 0.5 and pc[1]["recall"] == 1.0


def test_auc_ties_and_extremes(spark):
    same = spark.createDataFrame([(1, 0.3), (0, 0.3), (1, 0.3), (0, 0.3)], "y int, s double")
    assert mt.roc_auc(same, "y", "s").collect()[0]["auc"] == 0.5
    perfect = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2)], "y int, s double")
    assert mt.roc_auc(perfect, "y", "s").collect()[0]["auc"] == 1.0
    tie = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert mt.roc_auc(tie, "y", "s").collect()[0]["auc"] == 0.875


def test_union_missing_column(spark):
    a = spark.createDataFrame([("u1", 1.0)], "user_id string, amount double")
    b = spark.createDataFrame([("t1", 2.0, "scenario")], "user_id string, amount double, description string")
    got = {r["user_id"]: r["description"] for r in a.unionByName(b, allowMissingColumns=True).collect()}
    assert got == {"u1": None, "t1": "scenario"}


def test_trailing_hot_key_matches_brute_force(spark):
    rnd = random.Random(17)
    rows = [("hot" if rnd.random() < 0.7 else "cold", ts(seconds=rnd.randint(0, 5 * 86_400)), float(i))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    w = 86_400
    out = trailing_sums(df, ["k"], "t", {"n": (w, F.lit(1).cast("long")),
                                         "s": (w, F.col("v").cast("decimal(18,6)"))},
                        bucket_seconds=7_200)
    got = {(r["k"], r["t"], r["v"]): (r["n"], r["s"]) for r in out.collect()}
    for k, t, v in rows:
        prior = [vv for kk, tt, vv in rows if kk == k and t - dt.timedelta(seconds=w) <= tt < t]
        n, s = got[(k, t, v)]
        assert n == len(prior)
        assert float(s) == sum(prior)


def test_trailing_null_key_time_and_no_sliding_frame(spark):
    df = spark.createDataFrame([(None, ts()), (None, ts(hours=1)), ("a", None), ("a", ts())],
                               "k string, t timestamp_ntz")
    out = trailing_sums(df, ["k"], "t", {"n": (86_400, F.lit(1).cast("long")),
                                         "h": (1_800, F.lit(1).cast("long"))})
    assert sorted(((r["k"], r["t"], r["n"], r["h"]) for r in out.collect()), key=repr) == sorted(
        [(None, ts(), 0, 0), (None, ts(hours=1), 1, 0), ("a", None, 0, 0), ("a", ts(), 0, 0)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding" in plan
    assert "RangeFrame, -" not in plan


def test_spread_leaves_split_scans_alone(spark):
    from tessera.sources.tables import spread
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(many).rdd.getNumPartitions() == 64
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, "id").rdd.getNumPartitions() > 1


def test_prior_stats_ties_are_not_prior(spark):
    from tessera.operators.behavior import prior_stats
    df = spark.createDataFrame([("m", 1, ts(), 1), ("m", 2, ts(), 0), ("m", 3, ts(hours=1), 1)],
                               "g string, id long, t timestamp_ntz, y long")
    got = {r["id"]: (r["prior_count"], r["prior_sum_y"]) for r in prior_stats(df, ["g"], "t", ["y"]).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (2, 1)}


def test_stratified_split_keeps_null_labels_and_duplicates(spark):
    from tessera.operators.sampling import stratified_split
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, None), (4, None), (5, "b")]
    out = stratified_split(spark.createDataFrame(rows, "id long, y string"), "id", "y", 0.5)
    assert sorted(((r["id"], r["y"]) for r in out.collect()), key=repr) == sorted(rows, key=repr)


def test_positional_quantiles_keep_null_group(spark):
    from tessera.functions.ranking import positional_quantiles
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("g", 5.0)], "g string, v double")
    got = {r["g"]: r["q"] for r in positional_quantiles(df, "v", {"q": 0.5}, ["g"]).collect()}
    assert got == {None: 2.0, "g": 5.0}


def test_asof_null_keys_and_ties_do_not_depend_on_buckets(spark):
    left = spark.createDataFrame([("u", ts(hours=5)), (None, ts(hours=5))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("u", ts(), 3.0), ("u", ts(), 9.0), (None, ts(), 1.0)],
                                  "k string, f timestamp_ntz, v double")
    for bucket in (3_600, 864_000):
        got = {r["k"]: r["v"] for r in asof_join(left, right, ["k"], "t", "f", ["v"],
                                                 bucket_seconds=bucket).collect()}
        assert got == {"u": 9.0, None: None}


def test_weighted_assign_gives_every_row_one_key(spark):
    import bisect
    from itertools import accumulate
    from tessera.operators.sampling import weighted_assign
    weights = {1: 3, 2: 0, 3: None, 4: 7, 5: 1, 6: 89}
    keys = spark.createDataFrame(list(weights.items()), "k long, w long")
    kept = [(k, w) for k, w in weights.items() if w]
    ends = list(accumulate(w for _, w in kept))
    borders = {-(-e * 2 ** 32 // ends[-1]) + d for e in ends for d in (-1, 0, 1)} | {0, 2 ** 32 - 1}
    us = sorted(u for u in borders if 0 <= u < 2 ** 32)
    rows = spark.createDataFrame([(u,) for u in us], "u long")
    got = {(r["u"], r["k"]) for r in weighted_assign(rows, keys, "u", "k", "w").collect()}
    assert got == {(u, kept[bisect.bisect_right(ends, u * ends[-1] >> 32)][0]) for u in us}


def test_expired_store_row_answers_as_absent(spark):
    import datetime as dt
    from tessera.operators.online import online_lookup, unexpired
    now = dt.datetime(2024, 1, 20)
    store = spark.createDataFrame(
        [("new", 1.0, now), ("edge", 2.0, now - dt.timedelta(days=2)),
         ("old", 3.0, now - dt.timedelta(days=2, seconds=1)), ("none", 4.0, None)],
        "user_id string, amount double, event_timestamp timestamp_ntz")
    asked = spark.createDataFrame([("new",), ("edge",), ("old",), ("none",), (None,)], "user_id string")
    got = online_lookup(asked, unexpired(store, "2024-01-20 00:00:00", 2), "user_id").collect()
    assert {(r["user_id"], r["store_hit"], r["store_amount"]) for r in got} == {
        ("new", True, 1.0), ("edge", True, 2.0), ("old", False, None), ("none", False, None), (None, False, None)}


def test_prior_stats_and_account_age_keep_null_groups(spark):
    from tessera.operators.behavior import account_age, prior_stats
    df = spark.createDataFrame([(None, ts(), 1), (None, ts(days=2), 5), ("m", ts(), 7)],
                               "g string, timestamp timestamp_ntz, y long")
    got = {(r["g"], r["timestamp"]): (r["prior_count"], r["prior_sum_y"])
           for r in prior_stats(df, ["g"], "timestamp", ["y"]).collect()}
    assert got == {(None, ts()): (0, 0), (None, ts(days=2)): (1, 1), ("m", ts()): (0, 0)}
    ages = {(r["g"], r["timestamp"]): r["account_age_days"] for r in account_age(df, "g").collect()}
    assert ages == {(None, ts()): 0, (None, ts(days=2)): 2, ("m", ts()): 0}


def test_dense_codes_over_many_values_and_none(spark):
    from tessera.functions.ranking import dense_codes
    words = [f"w{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in [*words, *words[:50], None]], "c string")
    got = {r["c"]: r["code"] for r in dense_codes(df, "c").collect()}
    assert got == {w: i for i, w in enumerate(words)}
    assert dense_codes(df.where("c = ''"), "c").count() == 0


def test_category_codes_over_the_limit_fail_loudly(spark):
    import pytest
    from tessera.operators.features import apply_category_codes, fit_category_codes
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "c string")
    codes = fit_category_codes(df, "c")
    for limit in (3, None):
        got = {r["c"]: r["k"] for r in apply_category_codes(df, "c", codes, "k", max_codes=limit).collect()}
        assert got == {"a": 0, "b": 1, "c": 2, None: -1}
    with pytest.raises(Exception, match="more than 2 codes"):
        apply_category_codes(df, "c", codes, "k", max_codes=2).collect()


def test_title_resolution_against_brute_force(spark):
    from tessera.operators.similar import resolve_items
    rng = random.Random(5)
    titles = {i: "".join(rng.choice("abAB _%") for _ in range(rng.randint(0, 9))) for i in range(60)}
    titles[60] = None
    asked = {i: "".join(rng.choice("abB _%") for _ in range(rng.randint(0, 6))) for i in range(80)}
    asked[80] = None
    cat = spark.createDataFrame(list(titles.items()), "book_id long, title string")
    req = spark.createDataFrame([(i, None, q) for i, q in asked.items()] + [(900, 7, "zzz"), (901, 999, "a")],
                                "request_id long, book_id long, title string")
    want = {i: min((b for b, t in titles.items() if t and q and q.lower() in t.lower()), default=None)
            for i, q in asked.items()} | {900: 7, 901: None}
    got = {r["request_id"]: r["query_book_id"] for r in resolve_items(req, cat).collect()}
    assert got == want


def test_override_by_class(spark):
    from tessera.operators.features import override_by_class
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 2), ("c", None, 2), (None, 1, 2)], "k string, x long, y long")
    classes = spark.createDataFrame([("a", "high"), ("c", "low"), ("z", "low")], "k string, c string")
    out = override_by_class(df, classes, "k", "c", {"high": {"x": 9}, "low": {"x": 0, "y": 5}})
    assert {tuple(r) for r in out.collect()} == {("a", 9, 2), ("b", 1, 2), ("c", 0, 5), (None, 1, 2)}


def test_null_groups_are_groups(spark):
    """A null group gets what its twin gets, in every grouped operator."""
    from tessera.operators import latency as lt
    from tessera.operators import quality as qa
    rnd = random.Random(8)
    base = [(float(rnd.randint(1, 40)), rnd.random() > 0.02, rnd.choice(["ref", "cur"])) for _ in range(80)]
    rows = [(i, g, *r) for i, (g, r) in enumerate((g, r) for g in ("twin", None) for r in base)] \
        + [(1000, "failed", 5.0, False, "cur")]
    log = spark.createDataFrame(rows, "id int, g string, latency_ms double, success boolean, side string")
    ref, cur = (log.where((F.col("side") == s) & (F.coalesce("g", F.lit("")) != "failed")) for s in ("ref", "cur"))

    def same(df, *rest):
        per = {}
        for r in df.collect():
            per.setdefault(r["g"], []).append(tuple(r[c] for c in df.columns if c not in ("g", *rest)))
        assert {"twin", None} <= per.keys()
        assert sorted(per["twin"], key=repr) == sorted(per[None], key=repr)
        return per

    verdicts = same(lt.load_verdict(log, ["g"], 50.0, min_success=90.0))
    assert verdicts["failed"] == [(0.0, None, "FAIL")] and verdicts[None][0][2] == "PASS"
    assert same(lt.method_comparison(log, "g"))["failed"][0][0] == 1
    hist = same(lt.histogram(log, ["g"], "latency_ms", [10.0, 20.0]))
    assert sorted(hist[None])[-1] == (float("inf"), 80)
    same(lt.histogram_quantile(lt.histogram(log, ["g"], "latency_ms"), ["g"], 0.5))
    found = qa.outliers(log, "g", "latency_ms", "id")
    assert found.count() == len(rows)
    same(found, "id")
    for df in (qa.psi(ref, cur, "g", "latency_ms"), qa.ks_statistic(ref, cur, "g", "latency_ms"),
               qa.mean_shift(ref, cur, "g", "latency_ms")):
        per = same(df)
        assert None not in per[None][0]
    for df in (lt.success_rate(log, ["g"]), lt.latency_quantiles(log, ["g"]), lt.sla_share(log, ["g"], 9.0),
               lt.outcome_share(log, "success", ["g"])):
        same(df)


def test_an_endpoint_without_success_rolls_back(spark):
    from tessera.plans.q_quality import rollback
    rows = [("a", 1.0, True), ("a", 2.0, True), ("down", 3.0, False), ("down", 4.0, False), (None, 99.0, True)]
    log = spark.createDataFrame(rows, "endpoint string, latency_ms double, success boolean")
    last = spark.createDataFrame([(0.01, False)], "f1_drop double, _f1_bad boolean")
    for weeks in (last, last.limit(0)):
        got = {r["endpoint"]: (r["error_rate"], r["p99"], r["rollback"]) for r in rollback(log, weeks).collect()}
        assert got == {"a": (0.0, 2.0, False), "down": (100.0, None, True), None: (0.0, 99.0, True)}


def test_slices_in_one_scan(spark):
    """Grouping sets against one pass per slice; null values are slices, and not all rows."""
    rnd = random.Random(9)
    rows = [(rnd.choice(["x", "y", None]), rnd.choice([0, 1, None]), rnd.randint(0, 1), rnd.randint(0, 1),
             rnd.randint(0, 5) / 5) for _ in range(200)]
    df = spark.createDataFrame(rows, "m string, f int, y int, p int, s double")
    slices = [["m"], ["f"], ["m", "f"], []]
    got = mt.slice_metrics(df, "y", "p", "s", slices)
    found = {(r["slice"], tuple(r["slice_value"])): r for r in got.collect()}
    assert len(found) == 3 + 3 + 9 + 1
    for cols in slices:
        keys = {tuple(None if r[i] is None else str(r[i]) for i in (("m", "f").index(c) for c in cols)) for r in rows}
        for key in keys:
            own = [r for r in rows if all((None if r[("m", "f").index(c)] is None else str(r[("m", "f").index(c)])) == k
                                          for c, k in zip(cols, key))]
            r = found[",".join(cols), key]
            pos, neg = [x for x in own if x[2] == 1], [x for x in own if x[2] == 0]
            assert (r["n"], r["tp"], r["fp"]) == (len(own), sum(x[3] for x in pos), sum(x[3] for x in neg))
            if pos and neg:
                u = sum((a[4] > b[4]) + 0.5 * (a[4] == b[4]) for a in pos for b in neg)
                assert abs(r["auc"] - u / (len(pos) * len(neg))) < 1e-12
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Expand") >= 1
