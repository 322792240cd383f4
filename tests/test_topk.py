"""The block index: same rows as exhaustive scoring, and less of the postings read."""

import math
import random

from pyspark.sql import functions as F

from tessera.operators import codes, topk
from tessera.operators.similar import nearest
from tessera.session import saved


def zipf_weights(seed, n, terms=200, length=12):
    """Unit vectors with few terms each, some very common; common terms weigh less."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        picked = {min(int(rnd.paretovariate(0.7)), terms) for _ in range(length)}
        w = {t: rnd.random() * (0.2 + math.log(1 + t)) + 0.01 for t in picked}
        norm = math.sqrt(sum(x * x for x in w.values()))
        rows += [(i, f"t{t}", x / norm) for t, x in w.items()]
    return rows


def exhaustive(rows, queries):
    vec = {}
    for i, t, w in rows:
        vec.setdefault(i, {})[t] = w
    out = {}
    for qid, own, k in queries:
        score = {i: sum(w * vec[own].get(t, 0.0) for t, w in v.items()) for i, v in vec.items()
                 if i != own and any(t in vec[own] for t in v)}
        out[qid] = sorted(((-round(s, 10), i) for i, s in score.items()))[:k]
    return out


def searched(spark, rows, queries, block=16):
    topk.BLOCK, was = block, topk.BLOCK
    try:
        w = saved(spark.createDataFrame(rows, "id bigint, term string, weight double"), "w")
        index = saved(topk.build(w, "id"), "i")
    finally:
        topk.BLOCK = was
    q = spark.createDataFrame(queries, "qid bigint, own bigint, k int").join(
        w.select(F.col("id").alias("own"), "term", F.col("weight").alias("qw")), "own")
    best, cost = topk.search(saved(q, "q"), w, index, "id", max(k for *_, k in queries))
    got = {}
    for r in best.collect():
        got.setdefault(r["qid"], []).append((-round(r["score"], 10), r["id"]))
    return {k: sorted(v) for k, v in got.items()}, {r["qid"]: r for r in cost.collect()}, index


def test_same_rows_as_exhaustive_and_fewer_postings(spark):
    share = []
    for n in (150, 1200):
        rows = zipf_weights(1, n)
        copies = [(n + j, t, w) for j in range(3) for i, t, w in rows if i == 7]  # near copies raise the floor
        queries = [(i, i, 5) for i in range(0, 30, 3)] + [(100, 7, 3), (101, 9, 1)]
        got, cost, index = searched(spark, rows + copies, queries)
        want = exhaustive(rows + copies, queries)
        assert got == {q: v for q, v in want.items() if v}
        share.append(sum(r["read"] for r in cost.values()) / sum(r["postings"] for r in cost.values()))
        assert all(r["scored"] <= r["read"] <= r["postings"] for r in cost.values())
        assert index.agg(F.max("n")).first()[0] < 60  # a common term is many blocks
    assert share[1] < share[0] < 1 and share[1] < 0.8, share


def test_fewer_results_than_asked(spark):
    rows = [(1, "a", 1.0), (2, "a", 0.6), (2, "b", 0.8), (3, "b", 1.0), (4, "z", 1.0)]
    queries = [(1, 1, 5), (2, 2, 5), (4, 4, 5)]
    got, cost, _ = searched(spark, rows, queries)
    assert got == {1: [(-0.6, 2)], 2: [(-0.8, 3), (-0.6, 1)]} and cost[4]["scored"] == 0


def test_codes_find_the_same_neighbours(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(16)]) for i in range(400)]
    rows += [(1000 + i, [x + rnd.gauss(0, 1e-4) for x in rows[0][1]]) for i in range(12)]  # nearer than a code can tell
    rows += [(2000, list(rows[0][1])), (2001, list(rows[0][1])), (3000, None)]
    items = spark.createDataFrame(rows, "id bigint, v array<double>")
    queries = items.where("id % 50 = 0 AND v IS NOT NULL")
    index = saved(codes.encode(items, "id", "v"), "codes")
    key = lambda df: sorted((r["id"], r["rank"], r["neighbor"], round(r["similarity"], 9)) for r in df.collect())
    known = items.where("v IS NOT NULL")
    assert key(codes.nearest(items, index, queries, "id", "v", 5)) == key(nearest(known, queries, "id", "v", 5))
    pairs = codes.candidates(index, queries, "id", "v", 5).count()
    assert pairs < 0.25 * queries.count() * len(rows)
