"""What the fits read: a table of its own, in no more partitions than cores, whatever the rows came from."""

import datetime as dt

import pytest

from tessera.operators import models as md
from tessera.plans import q_models as qm
from tessera.sources.schemas import TABLE_SCHEMAS
from tessera.sources.tables import Tables


class Seen(Exception):
    def __init__(self, df):
        self.df = df


class Asked:
    """An estimator that tells what it was to be fitted on."""

    def fit(self, df):
        raise Seen(df)


def table(spark, folder, name, rows):
    schema = TABLE_SCHEMAS[name]
    spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema) \
        .repartition(20).write.parquet(f"{folder}/{name}.parquet")


def fitted_on(spark, monkeypatch, estimator, run):
    """The rows of a fit, where files are cut into many more partitions than there are cores."""
    monkeypatch.setattr(md, estimator, lambda *a, **k: Asked())
    monkeypatch.setattr(qm, "_FITTED", {})
    cut = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in cut}
    for k, v in cut.items():
        spark.conf.set(k, v)
    try:
        with pytest.raises(Seen) as seen:
            run()
        df = seen.value.df
        return df.rdd.getNumPartitions(), df._jdf.queryExecution().optimizedPlan().toString(), df.collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_the_trees_read_a_table_in_as_many_partitions_as_cores(spark, tmp_path, monkeypatch):
    start = dt.datetime(2024, 1, 1)
    table(spark, tmp_path, "events", [
        {"event_id": i, "ts": start + dt.timedelta(minutes=7 * i), "user_id": i % 9, "event_type": "abc"[i % 3],
         "value": float(i % 100), "props": f'{{"k": {i % 100}}}'} for i in range(2000)])
    n, plan, rows = fitted_on(spark, monkeypatch, "fraud_estimator", lambda: qm._fit_fraud(Tables(spark, str(tmp_path))))
    assert n <= spark.sparkContext.defaultParallelism
    assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan
    frauds = sum(i % 100 < 40 and i % 100 > 60 or (i % 20 < 3 and i % 10 == 0) for i in range(2000))
    held = -(-frauds // 5), -(-(2000 - frauds) // 5)  # a fifth of each label is held out
    assert sorted(r["label"] for r in rows) == [0.0] * (2000 - frauds - held[1]) + [1.0] * (frauds - held[0])


def test_the_text_model_reads_a_table_in_as_many_partitions_as_cores(spark, tmp_path, monkeypatch):
    table(spark, tmp_path, "documents", [{"doc_id": i, "text": f"word w{i % 5} and x{i % 7} more", "lang": "en",
                                          "source": "s", "n_chars": 20} for i in range(300)])
    table(spark, tmp_path, "labels", [{"doc_id": i, "quality": i % 2, "toxic": int(i % 5 == 0)} for i in range(300)])
    table(spark, tmp_path, "conversations", [{"conv_id": i, "turn": 0, "role": ("user", "assistant", "system")[i % 3],
                                              "text": f"word of y{i % 6}"} for i in range(60)])
    n, plan, rows = fitted_on(spark, monkeypatch, "sentiment_model", lambda: qm._sentiment_fit(Tables(spark, str(tmp_path))))
    assert n <= spark.sparkContext.defaultParallelism
    assert "Join" not in plan and "Aggregate" not in plan
    # toxic 60 + system 20, quality 120 + assistant 20, the others 120 + user 20: a fifth of each is held out
    assert sorted(r["label"] for r in rows) == [0.0] * 64 + [1.0] * 112 + [2.0] * 112
    assert all(abs(r["features"].norm(2) - 1) < 1e-9 for r in rows)


def test_partitions_of_a_fit_are_even(spark, monkeypatch):
    """Of more files than cores, one with most of the rows, no partition gets more than its share; fewer stay as they are."""
    from tessera import session
    was = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # each file is a partition
    try:
        small = [session.saved(spark.range(3).repartition(1), "small") for _ in range(spark.sparkContext.defaultParallelism)]
        uneven = session.saved(spark.range(20_000).repartition(1), "large")
        few = uneven.union(small[0])
        for df in small:
            uneven = uneven.union(df)
        sizes = [len(x) for x in session.for_fit(uneven, "even").rdd.glom().collect()]
        assert len(sizes) == len(small)
        assert sum(sizes) == 20_000 + 3 * len(small) and max(sizes) < 1.05 * min(sizes)
        assert sorted(len(x) for x in session.for_fit(few, "few").rdd.glom().collect()) == [3, 20_000]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", was)
