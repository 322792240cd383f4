from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import text as tt


def test_tokens_bigrams_stopwords(spark):
    df = spark.createDataFrame([(1, "The Café, naïve café! a b xy"), (2, ""), (3, None)], "id long, t string")
    r = {x["id"]: x for x in df.select("id", tx.tokens("t").alias("tok")).collect()}
    assert r[1]["tok"] == ["the", "cafe", "naive", "cafe", "xy"]
    assert r[2]["tok"] == []
    toks = df.select("id", tx.tokens("t").alias("tok"))
    out = {x["id"]: x for x in toks.select("id", tx.remove_stop_words(F.col("tok")).alias("k"),
                                              tx.bigrams(F.col("tok")).alias("b")).collect()}
    assert out[1]["k"] == ["cafe", "naive", "cafe", "xy"]
    assert out[1]["b"] == ["the cafe", "cafe naive", "naive cafe", "cafe xy"]
    assert out[2]["b"] == []


def test_tfidf_smooth_idf_and_norm(spark):
    import math
    docs = spark.createDataFrame([(1, "apple banana"), (2, "apple cherry"), (3, "apple banana banana"), (4, "")],
                                 "id long, text string")
    terms = tt.doc_terms(docs, "id", "text", ngrams=False)
    vocab = tt.fit_vocabulary(docs, terms, "id", min_df=1, max_df=1.0)
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    assert abs(idf["apple"] - (math.log(5 / 4) + 1)) < 1e-12     # term in every non-empty doc
    w = tt.tfidf(terms, vocab, "id")
    norms = w.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-12 for r in norms)
    new = spark.createDataFrame([(9, "durian only")], "id long, text string")
    z = tt.transform_new(new, vocab, "id", "text").collect()
    assert len(z) == 1 and z[0]["weight"] == 0.0                 # only unknown terms: zero vector


def test_df_bounds_and_max_features_ties(spark):
    docs = spark.createDataFrame([(1, "aa bb cc"), (2, "aa bb dd"), (3, "aa ee ff")], "id long, text string")
    terms = tt.doc_terms(docs, "id", "text", ngrams=False)
    v = tt.fit_vocabulary(docs, terms, "id", min_df=2, max_df=0.8)
    assert sorted(r["term"] for r in v.collect()) == ["bb"]       # aa: df 3 > 0.8*3; singletons < 2
    v2 = tt.fit_vocabulary(docs, terms, "id", min_df=1, max_df=1.0, max_features=2)
    assert [r["term"] for r in v2.orderBy(F.col("tf_total").desc(), "term").collect()] == ["aa", "bb"]
