"""Block scoring and the pruned vocabulary: same rows as plain joins and counts, without pairs as rows."""

import math
import random

from pyspark.sql import functions as F

from tessera.operators import blocks, similar
from tessera.operators import text as tt
from tessera.session import saved


def unit_rows(seed, n, terms=60, length=9):
    """Unit vectors over terms of very uneven frequency, some of them exact copies."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = {f"t{min(int(rnd.paretovariate(0.6)), terms)}": rnd.random() + 0.1 for _ in range(length)}
        if i % 5 == 4:
            v = {t: w for j, t, w in rows if j == i - 1}
        norm = math.sqrt(sum(x * x for x in v.values()))
        rows += [(i, t, x / norm) for t, x in v.items()]
    return rows


def plain(rows, own):
    vec = {}
    for i, t, w in rows:
        vec.setdefault(i, {})[t] = w
    score = {i: sum(w * vec[own].get(t, 0.0) for t, w in v.items()) for i, v in vec.items() if i != own}
    return {i: s for i, s in score.items() if s > 0}


def blocks_of(monkeypatch, cells=700, common=4):
    monkeypatch.setattr(blocks, "CELLS", cells)
    monkeypatch.setattr(blocks, "COMMON", common)


def test_every_item_against_all_is_no_join_on_terms(spark, monkeypatch):
    blocks_of(monkeypatch)
    rows = unit_rows(1, 400)
    w = saved(spark.createDataFrame(rows, "book_id bigint, term string, weight double"), "w")
    asked = [(f"r{i}", i, 1 + i % 6) for i in range(0, 400, 9)] + [("none", 100_000, 3)]
    q = spark.createDataFrame(asked, "request_id string, query_book_id bigint, n int")
    found = similar.similar_to(q, w, "book_id", 6)
    p = found._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in p and "Inner, (term" not in p  # pairs that share a term are no rows
    got = {}
    for r in found.collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["book_id"], round(r["similarity"], 9)))
    for name, own, n in asked[:-1]:
        best = sorted(plain(rows, own).items(), key=lambda x: (-round(x[1], 10), x[0]))[:n]
        assert sorted(got.pop(name)) == [(k, i, round(s, 9)) for k, (i, s) in enumerate(best, 1)]
    assert not got


def test_repeated_requests_add_up_as_before(spark, monkeypatch):
    blocks_of(monkeypatch)
    rows = unit_rows(2, 40)
    w = saved(spark.createDataFrame(rows, "book_id bigint, term string, weight double"), "w")
    q = spark.createDataFrame([(1, 3, 4), (1, 3, 4), (None, 5, 2), (2, None, 2)], "request_id int, query_book_id bigint, n int")
    got = {(r["request_id"], r["rank"]): (r["book_id"], r["similarity"]) for r in similar.similar_to(q, w, "book_id", 4).collect()}
    best = sorted(plain(rows, 3).items(), key=lambda x: (-round(x[1], 10), x[0]))
    assert [got[1, k][0] for k in range(1, 5)] == [i for i, _ in best[:4]]
    assert all(abs(got[1, k][1] - 2 * best[k - 1][1]) < 1e-9 for k in range(1, 5))
    assert sorted(k for r, k in got if r is None) == [1, 2] and len(got) == 6


def test_best_of_each_kind_and_by_bonus(spark, monkeypatch):
    blocks_of(monkeypatch)
    rows = unit_rows(3, 120)
    w = saved(spark.createDataFrame(rows, "book_id bigint, term string, weight double"), "w")
    q = spark.createDataFrame([(i, i, 5) for i in (0, 7, 50)], "request_id int, query_book_id bigint, n int")
    kind = {i: None if i % 4 == 3 else f"k{i % 4}" for i in range(110)}  # the last ten have none
    kinds = spark.createDataFrame(list(kind.items()), "id bigint, kind string")
    bonus = {i: None if i % 10 == 0 else (i * 37 % 100) / 100 for i in range(110)}
    extra = spark.createDataFrame(list(bonus.items()), "id bigint, bonus double")
    by_kind, by_bonus = {}, {}
    for r in similar.cosine_scores(q, w, "book_id", 2, carry=("n",), extras=kinds).collect():
        by_kind.setdefault(r["request_id"], set()).add(r["book_id"])
    for r in similar.cosine_scores(q, w, "book_id", 5, carry=("n",), extras=extra, scale=0.5).collect():
        by_bonus.setdefault(r["request_id"], set()).add(r["book_id"])
    for own in (0, 7, 50):
        score = {i: s for i, s in plain(rows, own).items() if i < 110}
        order = sorted(score, key=lambda i: (-round(score[i], 10), i))
        for k in {kind[i] for i in order}:
            assert set([i for i in order if kind[i] == k][:2]) <= by_kind[own], (own, k)
        worth = sorted(score, key=lambda i: (bonus[i] is None, -round(0.5 * score[i] + (bonus[i] or 0), 10), i))
        assert set(worth[:5]) <= by_bonus[own]
        groups = 2 * spark.sparkContext.defaultParallelism
        assert len(by_kind[own]) <= groups * 2 * 4 and len(by_bonus[own]) <= groups * 5  # not all of them


def test_dense_blocks_with_nulls_and_lengths(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(60, None), (61, [0.0] * 6), (62, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (63, [1.0, 2.0]), (64, [2.0, 4.0]), (5, rows[5][1])]
    items = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = {}
    for r in similar.dense_top_k(items, items.where("id IN (5, 61, 63)").withColumnRenamed("id", "q").dropDuplicates(["q"]),
                                 "id", "q", "v", 3).collect():
        got.setdefault(r["q"], []).append((r["rank"], r["id"], r["similarity"]))
    assert [(k, i) for k, i, _ in sorted(got[5])][:2] == [(1, 5), (2, 5)]
    assert [(i, s) for _, i, s in sorted(got[61])] == [(0, None), (1, None), (2, None)]  # no direction: by id
    assert [i for _, i, _ in sorted(got[63])] == [63, 64, 0] and abs(sorted(got[63])[1][2] - 1) < 1e-9


def test_dense_search_is_scored_by_matrix_products(spark, sf_dir):
    from tessera.sources.tables import Tables
    emb = Tables(spark, sf_dir).embeddings
    p = similar.nearest(emb, emb.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding", 5)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in p and "zip_with" not in p and "scalar-subquery" not in p


def many_texts(spark, n=300):
    """Few common words and many rare ones; some ids twice, null texts, a null id."""
    rnd = random.Random(5)
    word = lambda: f"w{min(int(rnd.paretovariate(0.5)), 4000)}x"
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(n)] + [(7, "w1x w1x w2x"), (7, "w1x w9x"), (None, "w1x w3x"), (9000, None)]
    return spark.createDataFrame(rows, "id bigint, text string")


def test_pruned_vocabulary_is_the_whole_one(spark, monkeypatch):
    docs = many_texts(spark)
    key = lambda df: sorted((r["term"], r["df"], r["tf_total"], round(r["idf"], 9)) for r in df.collect())
    calls = []
    counted = tt.fit_vocabulary
    monkeypatch.setattr(tt, "fit_vocabulary", lambda *a: calls.append(1) or counted(*a))
    again = 0
    # many terms in a bucket, bounds that drop the commonest, more features than there are, a cut that falls
    for buckets, cut, max_df, features in ((1 << 20, 4, 0.8, 40), (64, 1, 1.0, 20), (1 << 14, 1, 0.02, 30), (1 << 14, 1, 0.9, 10 ** 6), (4096, 2, 1.0, 200)):
        monkeypatch.setattr(tt, "BUCKETS", buckets)
        monkeypatch.setattr(tt, "CUT", cut)
        calls.clear()
        got = key(tt.fit_text_vocabulary(docs, "id", "text", min_df=2, max_df=max_df, max_features=features))
        again += len(calls) > 1
        assert got == key(counted(docs, tt.doc_terms(docs, "id", "text"), "id", 2, max_df, features)) and got
    assert again  # the cut had to fall at least once


def test_only_terms_of_the_vocabulary_are_counted_per_text(spark, sf_dir):
    """The (id, term) count and its shuffle see no other term, and all others are sums of a fixed number."""
    docs = many_texts(spark)
    vocab = tt.fit_text_vocabulary(docs, "id", "text", min_df=2, max_df=0.9, max_features=15)
    terms = tt.doc_terms(docs, "id", "text", among=tt.only(vocab, 15))
    p = terms._jdf.queryExecution().executedPlan().toString()
    count, semi = p.index("HashAggregate"), p.index("LeftSemi")
    assert count < semi < p.index("Generate")  # printed from the top: the rows are kept before they are counted
    assert {r["term"] for r in terms.select("term").distinct().collect()} == {r["term"] for r in vocab.collect()}
    from tessera.plans.q_text import book_index
    from tessera.sources.tables import Tables
    p = book_index(Tables(spark, sf_dir))[2]._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in p


def test_stop_words_are_looked_up(spark):
    from tessera.functions import text as tx
    df = spark.createDataFrame([(["the", "cat", "then", "and", "the", "i'm", "über"],), ([],), (None,)], "t array<string>")
    kept = df.select(tx.remove_stop_words(F.col("t")).alias("k"))
    assert [r["k"] for r in kept.collect()] == [["cat", "über"], [], None]
    assert "regexp_replace" not in kept._jdf.queryExecution().toString()


def test_recommendations_of_all_users_in_blocks(spark, monkeypatch):
    """Factors of very uneven length, ties and users without one: as every pair scored; and long items end the scan."""
    import numpy as np
    rnd = np.random.default_rng(6)
    items = rnd.normal(size=(500, 5)) * rnd.pareto(1.0, size=(500, 1))
    items[7], items[9] = items[3], 0.0
    users = np.r_[rnd.normal(size=(60, 5)), np.zeros((1, 5))]
    monkeypatch.setattr(blocks, "CELLS", 900)
    monkeypatch.setattr(blocks, "SCORES", 2000)
    df = lambda m, a, b: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{a} int, {b} array<double>")
    got = {}
    for r in blocks.dense_best(df(users, "q", "qv"), df(items, "id", "v"), 4, 25, 5).collect():
        got.setdefault(r["q"], []).append((-round(r["similarity"], 10), r["id"]))
    for u, s in enumerate(users @ items.T):
        assert sorted(got[u])[:4] == sorted((-round(x, 10), i) for i, x in enumerate(s))[:4], u
    seen = []
    scan = np.nonzero
    monkeypatch.setattr(blocks.np, "nonzero", lambda x: seen.append(x.size) or scan(x))
    blocks._scan(users[:60], items, np.arange(500), 4)
    assert sum(seen) < 0.7 * 60 * 500


def test_als_ranks_as_the_model_does(spark, monkeypatch):
    from tessera.operators import models as md
    rnd = random.Random(7)
    rows = [(u, i, rnd.randint(1, 9)) for u in range(30) for i in rnd.sample(range(40), 8)]
    model = md.als_model(rank=4, max_iter=3).fit(spark.createDataFrame(rows, "customer_id_code int, item_id_code int, quantity int"))
    got, want = {}, {}
    found = md.recommend(model, 5)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    for r in found.collect():
        got.setdefault(r["customer_id_code"], []).append((r["rank"], r["item_id_code"], r["score"]))
    for r in model.recommendForAllUsers(5).collect():
        want[r["customer_id_code"]] = [(x["item_id_code"], x["rating"]) for x in r["recommendations"]]
    assert got.keys() == want.keys()
    for u, best in got.items():
        assert [k for k, _, _ in sorted(best)] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in sorted(best)] == [x for _, x in want[u]]


def test_ratings_are_worked_out_once(spark, sf_dir, monkeypatch):
    from tessera.plans import q_models as qm
    from tessera.sources.tables import Tables
    calls = []
    monkeypatch.setattr(qm.ad, "ratings", lambda t, was=qm.ad.ratings: calls.append(1) or was(t))
    r = qm._coded_ratings(Tables(spark, sf_dir))
    p = r._jdf.queryExecution().executedPlan().toString()
    assert calls == [1] and "Join" not in p and "Aggregate" not in p


def test_pair_scores_and_cuts_are_those_of_the_joins(spark):
    rnd = random.Random(5)
    items = [(i, f"t{t}", rnd.random()) for i in range(60) for t in rnd.sample(range(30), 6)] + [(7, "t1", 0.5), (7, "t1", 0.25)]
    queries = [(100 + q, None if q == 3 else q, f"t{t}", rnd.random(), rnd.random() / 2) for q in range(8) for t in rnd.sample(range(34), 9)]
    pairs = [(100 + q, i) for q in range(8) for i in range(0, 66, q + 1)]
    room = {100 + q: 0.1 * q for q in range(8)}
    i = spark.createDataFrame(items, "id bigint, term string, w double")
    q = spark.createDataFrame([(a, o, t, w, c, room[a]) for a, o, t, w, c in queries],
                              "qid bigint, own bigint, term string, qw double, cut double, room double")
    score, over = {}, {}
    for a, own, term, qw, cut in queries:
        for id_, t, w in items:
            if t == term:
                score[a, id_] = score.get((a, id_), 0) + qw * w
                if w > cut and id_ != own:
                    over[a, id_] = over.get((a, id_), 0) + qw * (w - cut)
    few = blocks.FEW
    try:
        for blocks.FEW in (few, 0):
            got = blocks.pair_scores(spark.createDataFrame(pairs * 2, "qid bigint, id bigint"), q, i).collect()
            assert len(got) == len({(r["qid"], r["id"]) for r in got}) == sum(p in score for p in set(pairs))
            assert all(abs(r["score"] - score[r["qid"], r["id"]]) < 1e-12 for r in got)
    finally:
        blocks.FEW = few
    found = sorted((r["qid"], r["id"]) for r in blocks.above_cuts(q, i, len(items)).collect())
    assert found == sorted(p for p, x in over.items() if x >= room[p[0]])


def test_all_items_against_all_in_packed_blocks(spark, monkeypatch):
    """More queries than a group holds: no side is sent for each block of the other, and every item has its best."""
    blocks_of(monkeypatch, cells=1_500)
    rows = unit_rows(7, 300) + [(900, "alone", 1.0)]
    w = saved(spark.createDataFrame(rows, "book_id bigint, term string, weight double"), "w")
    asked = [(i, i, 3) for i in [*range(300), 900]] + [(1_000, 5, 3), (1_001, None, 3), (1_002, 77_777, 3)]
    q = spark.createDataFrame(asked, "request_id int, query_book_id bigint, n int")
    found = similar.similar_to(q, w, "book_id", 3)
    assert "CoGroup" not in found._jdf.queryExecution().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["book_id"], round(r["similarity"], 9)))
    for name, own, n in asked[:-2]:
        best = sorted(plain(rows, own).items(), key=lambda x: (-round(x[1], 10), x[0]))[:n]
        assert sorted(got.pop(name, [])) == [(k, i, round(s, 9)) for k, (i, s) in enumerate(best, 1)], name
    assert not got


def test_all_items_top_n_is_for_every_item(spark, tmp_path):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["river", "stone", "cloud", "lamp", "bread", "horse", "paper", "glass"]) for _ in range(12))
             for _ in range(60)]
    rows = [(i, "en", "src", t, len(t)) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string, n_chars bigint") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    import __spark_entry__ as E
    got = {r["book_id"] for r in E.queries()["all_items_top_n"](spark, str(tmp_path)).collect()}
    assert got == set(range(1, 61))
