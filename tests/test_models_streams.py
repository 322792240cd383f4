"""Invariants for rows-only queries (models, approximate neighbours) and
streaming edge cases."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.session import scratch_path
from tessera.streaming import streams as st


def test_train_fraud_auc_bounds(spark, sf_dir):
    r = E.queries()["train_fraud"](spark, sf_dir).collect()[0]
    assert 0.5 <= r["auc"] <= 1.0
    assert 0.0 <= r["f1"] <= 1.0


def test_model_roundtrip_same_scores(spark, sf_dir):
    df = E.queries()["model_roundtrip"](spark, sf_dir)
    assert df.where(~F.col("same")).count() == 0


def test_nearest_in_blocks_against_brute_force(spark, sf_dir):
    import numpy as np
    from tessera.operators.similar import nearest
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id < 150")
    rows = emb.orderBy("vec_id").collect()
    v = np.array([r["embedding"] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    s = v @ v.T
    ids = [r["vec_id"] for r in rows]
    truth = {(ids[i], ids[j]) for i in range(len(ids)) if ids[i] % 7 == 0
             for j in [j for j in np.argsort(-s[i], kind="stable") if j != i][:3]}
    for block in (4, 4096):  # several blocks and one
        got = nearest(emb, emb.where("vec_id % 7 = 0"), "vec_id", "embedding", 3, block=block).collect()
        assert {(r["vec_id"], r["neighbor"]) for r in got} == truth
        assert len(got) == len(truth)


def test_request_over_the_limit_fails_loudly(spark):
    import pytest
    from tessera.operators.similar import first_n
    df = spark.createDataFrame([(1, 30), (2, 30)], "rank int, n int")
    with pytest.raises(Exception, match="at most 20"):
        first_n(df, "n", 20).collect()
    assert first_n(df, "n", 30).count() == 2


def test_stream_upsert_two_batches_and_restart(spark):
    schema = "k string, t timestamp_ntz, c timestamp_ntz, v double"
    t0 = dt.datetime(2024, 1, 1)
    src = scratch_path(spark, "edge-src")
    root, ck = scratch_path(spark, "edge-snap"), scratch_path(spark, "edge-ck")
    spark.createDataFrame([("a", t0, t0, 1.0), ("b", t0, t0, 2.0)], schema).coalesce(1).write.parquet(src)
    sink = st.upsert_sink(root, ["k"], ["t", "c"], spark.createDataFrame([], schema).schema)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        st.run_available_now(stream, sink, ck)

    run()
    # second file: newer row for a, an older (late) row for b, a duplicate of a's first row
    spark.createDataFrame([("a", t0 + dt.timedelta(hours=1), t0, 3.0), ("b", t0 - dt.timedelta(hours=1), t0, 9.0),
                           ("a", t0, t0, 1.0)], schema).coalesce(1).write.mode("append").parquet(src)
    run()  # restart from the checkpoint: only the new file is read
    snap = {r["k"]: r["v"] for r in st.read_snapshot(
        spark, root, ["k"], ["t", "c"], spark.createDataFrame([], schema).schema).collect()}
    assert snap == {"a": 3.0, "b": 2.0}
    assert len(st.versions(spark, root)) == 2


def test_approx_quantiles_close_to_exact(spark, sf_dir):
    q = E.queries()
    exact = {r["endpoint"]: r for r in q["latency_quantiles"](spark, sf_dir).collect()}
    approx = {r["endpoint"]: r for r in q["latency_quantiles_approx"](spark, sf_dir).collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        for p in ("p50", "p95", "p99"):
            assert abs(exact[k][p] - approx[k][p]) <= 0.05 * max(1.0, exact[k][p])


def test_csv_file_report_rows_match_tables(spark, sf_dir):
    rep = {r["file"]: r for r in E.queries()["csv_file_report"](spark, sf_dir).collect()}
    for t in ("events", "orders", "customer", "part"):
        n = spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
        assert rep[t]["rows"] == n
        assert rep[t]["parquet_bytes"] > 0 and rep[t]["csv_bytes"] > 0


def test_event_files_replay_in_time_order(spark, sf_dir):
    from tessera.plans.q_streams import event_files
    path = event_files(spark, sf_dir)
    files = sorted(st.data_files(spark, path), key=lambda f: st._fs(spark, f)[0].getFileStatus(
        st._fs(spark, f)[1]).getModificationTime())
    assert len(files) > 1
    spans = [spark.read.parquet(f).agg(F.min("ts"), F.max("ts")).first() for f in files]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_conversion_keeps_failures_as_rows(spark):
    from tessera.sources import files as fs
    root = scratch_path(spark, "conv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline, x'), (2, None)], "id int, t string")
    fs.write_csv(df, f"{root}/good.csv")
    fs.write_csv(df.limit(0).coalesce(1), f"{root}/zero.csv")
    spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bad.csv").getFileSystem(
        spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bad.csv"))
    out = scratch_path(spark, "conv-out")
    rep = {r["file"]: r for r in fs.convert_csv(spark, f"{root}/*.csv", out).collect()}
    assert rep["good"]["status"] == "ok" and rep["good"]["rows"] == 2
    assert rep["bad"]["status"] == "failed" and rep["bad"]["error"] and rep["bad"]["saved_pct"] is None
    assert rep["total"]["rows"] == sum(r["rows"] for f, r in rep.items() if f != "total")
    assert spark.read.parquet(out).where("file = 'good' AND id = 1").first()["t"] == 'a "quoted"\nline, x'


def test_conversion_jobs_follow_headers_not_files(spark):
    """Many small files in as many jobs as few; rows that do not parse are counted and kept."""
    import os
    from tessera.sources import files as fs

    def jobs(n, root):
        top = root.removeprefix("file:")
        os.makedirs(top)
        for i in range(n):
            with open(f"{top}/f{i:03d}.csv", "w") as f:
                f.write("a,b\n" + "".join(f"{i},{k}\n" for k in range(3)) + ("1,2,3,4\n" if i == 1 else ""))
        with open(f"{top}/text.csv", "w") as f:
            f.write('t,n\n"two\nlines",1\n"x ""y""",2\n')
        spark.sparkContext.setJobGroup(root, "conversion")
        rep = {r["file"]: r for r in fs.convert_csv(spark, f"{root}/*.csv", scratch_path(spark, "many-out")).collect()}
        spark.sparkContext.setJobGroup("tests", "")
        assert len(rep) == n + 2 and rep["text"]["rows"] == 2 and rep["text"]["corrupt"] == 0
        assert rep["f000"]["rows"] == 3 and rep["f001"]["rows"] == 4 and rep["f001"]["corrupt"] == 1
        assert rep["total"]["rows"] == 3 * n + 1 + 2 and all(r["parquet_bytes"] > 0 for r in rep.values())
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(root))

    # from 33 paths on Spark lists them by a job of its own for each read: both are beyond that
    assert jobs(80, scratch_path(spark, "many")) == jobs(40, scratch_path(spark, "few"))


def test_ndcg_against_brute_force(spark):
    import math
    from tessera.operators.models import ndcg
    rows = [(g, i, float((7 * i + g) % 5), float((3 * i + g) % 4)) for g in range(3) for i in range(12)]
    df = spark.createDataFrame(rows, "g int, i int, s double, q double")
    for r in ndcg(df, "g", "s", "q", "i", 10).collect():
        own = [x for x in rows if x[0] == r["g"]]
        dcg = lambda c: sum(x[3] / math.log2(k + 2) for k, x in enumerate(
            sorted(own, key=lambda x: (-x[c], x[1]))[:10]))
        assert abs(r["dcg"] - dcg(2)) < 1e-9 and abs(r["idcg"] - dcg(3)) < 1e-9


def test_als_ranks_and_held_out_ndcg(spark, sf_dir):
    q = E.queries()
    recs = q["als_recommend"](spark, sf_dir)
    per = recs.groupBy("customer_id").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("d"),
                                          F.max("rank").alias("r"))
    assert per.where("n <> 10 OR d <> 10 OR r <> 10").count() == 0
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey").distinct().count()
    assert per.count() <= orders and per.count() > 0
    got = q["als_ndcg"](spark, sf_dir).first()
    assert got["n_customers"] > 0 and 0.0 < got["ndcg_at_10"] <= 1.0


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    """No block of a large fit holds more ratings than stated; small fits keep MLlib's ten blocks."""
    from tessera.operators import models as md
    from tessera.session import checkpoint_root
    assert [md.als_model(ratings=n).getNumUserBlocks() for n in (0, 80_000_000, 216_000_000)] == [10, 10, 27]
    monkeypatch.setattr(md, "BLOCK_RATINGS", 100)
    checkpoint_root(spark)
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(60) for i in range(40) if (u + i) % 2]
    r = spark.createDataFrame(rows, "customer_id_code int, item_id_code int, quantity double")
    als = md.als_model(max_iter=3, ratings=len(rows))
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == 12 and als.getCheckpointInterval() == 2
    model = als.fit(r)
    assert model.userFactors.count() == 60 and model.itemFactors.count() == 40
