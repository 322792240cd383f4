"""Every query with an SQL oracle agrees with DuckDB on the small tables."""

import json

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, canon

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLE[name]).df()
    gc, gr = canon(got)
    wc, wr = canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_fraud_scores_cover_every_transaction(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    scored = QUERIES["score_requests"](spark, sf_dir).toPandas()
    assert len(scored) == n and scored["transaction_id"].is_unique
    ok = scored["status"] == "ok"
    assert ok.any() and not ok.all()
    assert scored.loc[ok, "fraud_probability"].between(0, 1).all()
    assert scored.loc[~ok, "fraud_probability"].isna().all()
    assert (scored.loc[ok, "is_fraud"] == (scored.loc[ok, "fraud_probability"] > 0.5)).all()


def test_fraud_batch_scores_are_probabilities(spark, sf_dir):
    got = QUERIES["score_fraud"](spark, sf_dir).toPandas()
    assert len(got) and got["transaction_id"].is_unique
    assert got[[c for c in got.columns if "prob" in c or c == "score"][0]].between(0, 1).all()


def test_sentiment_reports_and_responses(spark, sf_dir):
    rep = QUERIES["train_sentiment"](spark, sf_dir).toPandas()
    assert set(rep["split"]) == {"train", "test"}
    got = QUERIES["sentiment_response"](spark, sf_dir).toPandas()
    assert len(got) == spark.read.parquet(f"{sf_dir}/benchmark.parquet").count()
    for p, c in zip(got["probabilities"], got["confidence"]):
        assert abs(sum(p.values()) - 1) < 1e-9 and max(p.values()) == c


def test_recommendation_response_for_every_request(spark, sf_dir):
    got = {r["request_id"]: json.loads(r["response"]) for r in QUERIES["reco_response"](spark, sf_dir).collect()}
    status = QUERIES["reco_status"](spark, sf_dir).collect()
    assert {r["request_id"]: (r["status_code"], r["num_results"]) for r in status} == {
        k: (v["status_code"], v["num_results"]) for k, v in got.items()}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
