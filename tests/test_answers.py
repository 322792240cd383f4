"""Answers to recommendation requests: titles are looked into once, and only the books of an answer meet it."""

import json

from tessera.plans import q_text as qt
from tessera.sources.schemas import TABLE_SCHEMAS
from tessera.sources.tables import Tables


def test_answers_resolve_once_and_join_few_books(spark, tmp_path, monkeypatch):
    docs = [(i, f"Title number {i}\nwords of kind{i % 4} and more{i % 3} here", "en", "s", 40) for i in range(1, 60)]
    docs += [docs[20], (None, "Title without an id\nwords of kind1", "en", "s", 30)]  # a book twice, a null id
    spark.createDataFrame(docs, TABLE_SCHEMAS["documents"]).write.parquet(f"{tmp_path}/documents.parquet")
    asked = [(3, "x"), (4, "x"), (5, "xtit"), (6, None), (8, "xqqq"), (11, None), (26, "xtit"), (27, "x")]
    spark.createDataFrame(asked, TABLE_SCHEMAS["benchmark"]).write.parquet(f"{tmp_path}/benchmark.parquet")
    calls, resolve = [], qt.resolve_items
    monkeypatch.setattr(qt, "resolve_items", lambda *a: calls.append(1) or resolve(*a))
    t = Tables(spark, str(tmp_path))
    found = qt.reco_answers(t)
    assert len(calls) == 1
    assert "documents.parquet" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path / "documents.parquet") not in "".join(found.inputFiles())
    got = {r["request_id"]: r for r in found.collect()}
    assert {k: r["status_code"] for k, r in got.items()} == {
        3: 200, 4: 404, 5: 200, 6: 200, 8: 404, 11: 400, 26: 400, 27: 400}
    assert [got[k]["query_book"]["book_id"] for k in (3, 5, 6)] == [21, 1, 42]
    first = {(r["request_id"], r["rank"]): r["book_id"] for r in qt.similar_items_df(t).collect()}
    for r in got.values():
        ranks = [(x["rank"], x["book_id"]) for x in r["recommendations"]]
        assert {x: b for x, b in ranks} == {x: b for (q, x), b in first.items() if q == r["request_id"]}
        assert r["num_results"] == len(ranks)
    twice = [x for r in got.values() for x in r["recommendations"] if x["book_id"] == docs[20][0]]
    assert len(twice) % 2 == 0  # a book that stands twice is given twice, as before
    assert json.loads(qt.reco_response(spark, str(tmp_path)).where("request_id = 4").first()["response"])["error"] == "not_found"
