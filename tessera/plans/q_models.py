"""Queries: training, scoring and model checks (2.10)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_bucket
from tessera.functions.ranking import attach_totals
from tessera.operators import features as ft
from tessera.operators import metrics as mt
from tessera.operators import models as md
from tessera.operators import online as on
from tessera.operators import sampling as sm
from tessera.operators import text as tt
from tessera.operators.features import SENTIMENT_NAMES
from tessera.plans import sql as S
from tessera.plans.q_online import live_snapshot
from tessera.plans.q_text import SENT, terms_sql, vocab_sql
from tessera.plans.registry import query
from tessera.session import for_fit, saved, scratch_path
from tessera.sources import adapters as ad
from tessera.sources.schemas import FRAUD_MODEL_SCHEMA
from tessera.sources.tables import Tables, table_path

FEATURES = [f.name for f in FRAUD_MODEL_SCHEMA.fields]
# Boosting rounds and L-BFGS iterations of the two models.
GBT_ROUNDS = 100
SENT_ITERS = 1000
# The last fit of each kind in this session, with what it was fitted on: four queries use one model.
_FITTED: dict[str, tuple[tuple, object]] = {}


def _stamp(t: Tables, tables) -> tuple:
    """The application, and name, size and time of every file that the tables consist of."""
    jvm, out = t.spark.sparkContext._jvm, []
    for name in tables:
        p = jvm.org.apache.hadoop.fs.Path(table_path(t.sf_dir, name))
        fs = p.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
        out += [(str(x.getPath()), x.getLen(), x.getModificationTime()) for x in fs.listStatus(p)]
    return (t.spark.sparkContext.applicationId, *sorted(out))


def _once(kind: str, t: Tables, tables, fit):
    """The model of ``fit``, fitted anew whenever a file of ``tables`` has changed."""
    key = _stamp(t, tables)
    if _FITTED.get(kind, (None, None))[0] != key:
        _FITTED[kind] = (key, fit())
    return _FITTED[kind][1]


def _fraud_split(t):
    tx = ad.transactions(t)
    codes = ft.fit_category_codes(tx, "merchant_category")
    fm = ft.feature_matrix(tx, codes, keep=["transaction_id", "is_fraud"]) \
        .withColumn("label", F.col("is_fraud").cast("double"))
    return sm.stratified_split(fm, "transaction_id", "is_fraud", 0.2, 42), codes


def _fit_fraud(t):
    split, codes = _fraud_split(t)
    split = saved(split, "fraud-split")  # the fit reads it several times, the scores once more

    def fit():
        train = split.where(F.col("split") == "train").select("label", *FEATURES)
        return md.fraud_estimator(FEATURES, max_iter=GBT_ROUNDS).fit(for_fit(train, "fraud-train"))

    return _once("fraud", t, ["events"], fit), split, codes


def _scored(model, df):
    s = model.transform(df)
    p = md.positive_probability()
    return s.withColumn("score", p).withColumn("predicted", (p > 0.5).cast("int"))


@query("train_fraud")
def train_fraud(spark, sf_dir):
    """Boosted trees on the stratified 80 %; AUC, F1, precision, recall on the 20 %."""
    model, split, _ = _fit_fraud(Tables(spark, sf_dir))
    test = _scored(model, split.where(F.col("split") == "test"))
    auc = mt.roc_auc(test, "is_fraud", "score").select("auc", "n_pos", "n_neg")
    b = mt.binary_metrics(test, "is_fraud", "predicted").select("precision", "recall", "f1", "accuracy")
    return attach_totals(auc, b, [])


@query("score_fraud")
def score_fraud(spark, sf_dir):
    """Batch scoring of every transaction: probability of class 1 and the > 0.5 decision."""
    model, split, _ = _fit_fraud(Tables(spark, sf_dir))
    s = _scored(model, split)
    return s.select("transaction_id", "split", F.col("score").alias("fraud_probability"),
                    (F.col("predicted") == 1).alias("is_fraud_pred"))


@query("score_requests")
def score_requests(spark, sf_dir):
    """The whole request path as one plan: validate -> online lookup -> fill
    (falsy rule) -> defaults -> category codes -> typed features -> score ->
    threshold and verdict, with the feature source kept."""
    t = Tables(spark, sf_dir)
    model, _, codes = _fit_fraud(t)
    j = on.online_lookup(ad.requests(t), live_snapshot(t), "user_id")
    filled = on.default_fill(on.fill_missing(j, falsy_missing=True), falsy_missing=True)
    checked = on.validate_requests(filled)
    ok = checked.where(F.col("status") == "ok")
    fm = ft.feature_matrix(ok, codes, keep=["transaction_id", "feature_source"])
    s = _scored(model, fm)
    flag, verdict = ft.threshold_decision("score")
    scored = s.select("transaction_id", "feature_source", F.lit("ok").alias("status"),
                      F.col("score").alias("fraud_probability"), flag.alias("is_fraud"), verdict.alias("verdict"))
    rejected = checked.where(F.col("status") != "ok").select(
        "transaction_id", "feature_source", "status", F.lit(None).cast("double").alias("fraud_probability"),
        F.lit(None).cast("boolean").alias("is_fraud"), F.lit(None).cast("string").alias("verdict"))
    return scored.unionByName(rejected)


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Persist the fitted model, load it back, score again: predictions must agree."""
    model, split, _ = _fit_fraud(Tables(spark, sf_dir))
    loaded = md.save_and_load(model, scratch_path(spark, "fraud-model"))
    a = _scored(model, split).select("transaction_id", F.col("score").alias("before"))
    b = _scored(loaded, split).select("transaction_id", F.col("score").alias("after"))
    return a.join(b, "transaction_id").withColumn("same", F.col("before") == F.col("after"))


@query("class_weights", sql=S.with_(S.SENTIMENT) + """
SELECT category, count(*) AS n_c, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM sentiment GROUP BY category""")
def class_weights(spark, sf_dir):
    """Balanced class weights n / (k * n_c) for the sentiment labels."""
    s = ad.sentiment_texts(Tables(spark, sf_dir))
    w = md.class_weights(s, "category")
    return w.select("category", "n_c", "weight")


def _sentiment_corpus(t):
    """Both labelled corpora under one id, rows without text or label left out."""
    a = ad.sentiment_texts(t).select(
        F.concat_ws("-", F.lit("d"), "doc_id").alias("text_id"), F.col("clean_text").alias("text"), "category")
    b = ad.second_corpus(t).select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("text_id"),
        F.col("clean_comment").alias("text"), "category")
    return a.unionByName(b).na.drop("any", subset=["text", "category"])


def _sentiment_train_vocab(train):
    return tt.fit_text_vocabulary(train, "text_id", "text", **SENT)


def _sentiment_fit(t):
    """Split first; vocabulary, idf and class weights come from the training rows only."""
    split = saved(sm.stratified_split(_sentiment_corpus(t), "text_id", "category", 0.2, 42)
                  .withColumn("label", (F.col("category") + 1).cast("double")), "sentiment-split")
    known = split.where(F.col("split") == "train")
    vocab = _sentiment_train_vocab(known)
    vec, _ = md.tfidf_vectors(split, "text_id", "text", vocab, stop_words=SENT["stop_words"])
    weights = md.class_weights(known, "category").select("category", "weight")

    def fit():
        train = vec.where(F.col("split") == "train").join(weights, "category").select("label", "weight", "features")
        train = for_fit(train, "sentiment-train")
        total_weight = train.agg(F.sum("weight")).first()[0]  # one scalar for the penalty scale
        return md.sentiment_model(total_weight, max_iter=SENT_ITERS).fit(train)

    return _once("sentiment", t, ["documents", "labels", "conversations"], fit), vec, vocab


@query("train_sentiment")
def train_sentiment(spark, sf_dir):
    """TF-IDF + balanced multinomial logistic regression on both corpora; reports
    on the 80 % it was fitted on and on the 20 % held out."""
    model, vec, _ = _sentiment_fit(Tables(spark, sf_dir))
    done = model.transform(vec).withColumn("predicted", (F.col("prediction") - 1).cast("int"))
    reports = [mt.classification_report(done.where(F.col("split") == part), "category", "predicted",
                                        [-1, 0, 1], SENTIMENT_NAMES).withColumn("split", F.lit(part))
               for part in ("train", "test")]
    return reports[0].unionByName(reports[1])


@query("sentiment_train_vocabulary", sql=S.with_(
    S.SENTIMENT, S.SECOND_CORPUS, """
corpus AS (
  SELECT 'd-' || doc_id AS text_id, clean_text AS text, category FROM sentiment WHERE clean_text IS NOT NULL
  UNION ALL
  SELECT 'c-' || conv_id || '-' || turn, clean_comment, category FROM comments WHERE clean_comment IS NOT NULL)""", """
ranked AS (
  SELECT *, rank() OVER (PARTITION BY category ORDER BY md5(text_id || '|42')) AS k,
         count(*) OVER (PARTITION BY category) AS n FROM corpus)""", """
train AS (SELECT text_id, text FROM ranked WHERE k > ceil(n * 0.2))""",
    terms_sql("trterms", "train", "text_id", "text", SENT["stop_words"]),
    vocab_sql("trvocab", "trterms", "train", SENT["min_df"], SENT["max_df"], SENT["max_features"]))
    + "SELECT term, df, tf_total, round(idf, 6) AS idf FROM trvocab")
def sentiment_train_vocabulary(spark, sf_dir):
    """The vocabulary and idf that the sentiment model is fitted with: from the
    training rows of both corpora, never from the held-out ones."""
    split = sm.stratified_split(_sentiment_corpus(Tables(spark, sf_dir)), "text_id", "category", 0.2, 42)
    vocab = _sentiment_train_vocab(split.where(F.col("split") == "train"))
    return vocab.select("term", "df", "tf_total", F.round("idf", 6).alias("idf"))


@query("sentiment_response")
def sentiment_response(spark, sf_dir):
    """Unseen texts (benchmark): class, confidence = its probability, probability map, JSON."""
    t = Tables(spark, sf_dir)
    model, _, vocab = _sentiment_fit(t)
    new, _ = md.tfidf_vectors(t.benchmark, "item_id", "text", vocab, stop_words=SENT["stop_words"])
    p = model.transform(new).withColumn("_p", vector_to_array("probability"))
    label = (F.col("prediction") - 1).cast("int")
    probs = F.map_from_arrays(F.array(*[F.lit(SENTIMENT_NAMES[k]) for k in (-1, 0, 1)]), F.col("_p"))
    out = p.select(F.col("item_id").alias("request_id"), ft.truncate_text("text").alias("text"),
                   ft.label_name(label).alias("sentiment"), label.alias("label"),
                   F.array_max("_p").alias("confidence"), probs.alias("probabilities"))
    return out.withColumn("response", F.to_json(F.struct("request_id", "sentiment", "confidence", "probabilities")))


@query("sentiment_roundtrip", sql="SELECT item_id, true AS same, true AS whole FROM benchmark")
def sentiment_roundtrip(spark, sf_dir):
    """The text model from raw text to probabilities as one artefact, saved, loaded and applied to
    unseen texts: as before saving, and as the fitted stages one by one (to 1e-9)."""
    t = Tables(spark, sf_dir)
    model, _, vocab = _sentiment_fit(t)
    whole = md.text_pipeline(vocab, "text", model)
    loaded = md.save_and_load(whole, scratch_path(spark, "sentiment-model"))
    told = lambda df, name: df.select("item_id", vector_to_array("probability").alias(name))
    steps = model.transform(md.tfidf_vectors(t.benchmark, "item_id", "text", vocab, stop_words=SENT["stop_words"])[0])
    both = told(whole.transform(t.benchmark), "a").join(told(loaded.transform(t.benchmark), "b"), "item_id") \
        .join(told(steps, "c"), "item_id")
    near = F.forall(F.arrays_zip("a", "c"), lambda x: F.abs(x["a"] - x["c"]) < 1e-9)
    return both.select("item_id", (F.col("a") == F.col("b")).alias("same"), near.alias("whole"))


@query("fit_log")
def fit_log(spark, sf_dir):
    """The run log of our own fraud fit: its parameters and its metrics on the held-out rows."""
    model, _, _ = _fit_fraud(Tables(spark, sf_dir))
    trees = model.stages[-1]
    params = {p.name: v for p, v in trees.extractParamMap().items()
              if p.name in ("maxDepth", "stepSize", "maxIter", "seed", "lossType", "subsamplingRate")}
    return md.run_rows(trees.uid, {**params, "features": ",".join(FEATURES), "trees": trees.getNumTrees},
                       train_fraud(spark, sf_dir))


@query("run_metrics_long", sql=S.with_(S.RUN_LOG) + """
SELECT run_id, experiment, 'metric' AS "key", CAST(metric AS VARCHAR) AS "value" FROM run_log
UNION ALL SELECT run_id, experiment, 'status', status FROM run_log
UNION ALL SELECT run_id, experiment, 'start_time', strftime(start_time, '%Y-%m-%d %H:%M:%S') FROM run_log""")
def run_metrics_long(spark, sf_dir):
    """Run log as a long (run, key, value) table — one row per logged key."""
    r = ad.run_log(Tables(spark, sf_dir)).select(
        "run_id", "experiment", F.col("metric").cast("string").alias("metric"), "status",
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"))
    return r.unpivot(["run_id", "experiment"], ["metric", "status", "start_time"], "key", "value")


@query("ndcg_at_10", sql=S.with_(S.RATINGS) + """
, pop AS (SELECT item_id, sum(quantity) AS popularity FROM ratings GROUP BY item_id),
r AS (SELECT r.customer_id, r.item_id, r.quantity, p.popularity FROM ratings r JOIN pop p USING (item_id)),
pr AS (SELECT customer_id, quantity, row_number() OVER (PARTITION BY customer_id ORDER BY popularity DESC, item_id) AS k FROM r),
ir AS (SELECT customer_id, quantity, row_number() OVER (PARTITION BY customer_id ORDER BY quantity DESC, item_id) AS k FROM r),
dcg AS (SELECT customer_id, sum(quantity / log2(k + 1)) AS dcg FROM pr WHERE k <= 10 GROUP BY customer_id),
idcg AS (SELECT customer_id, sum(quantity / log2(k + 1)) AS idcg FROM ir WHERE k <= 10 GROUP BY customer_id)
SELECT count(*) AS n_customers, round(avg(dcg / idcg), 6) AS ndcg_at_10 FROM dcg JOIN idcg USING (customer_id)""")
def ndcg_at_10(spark, sf_dir):
    """NDCG@10 of a popularity ranking against each customer's own quantities."""
    from tessera.operators.similar import top_k_per_group
    r = ad.ratings(Tables(spark, sf_dir))
    pop = r.groupBy("item_id").agg(F.sum("quantity").alias("popularity"))
    rp = r.join(pop, "item_id")
    pred = top_k_per_group(rp, "customer_id", "popularity", "item_id", 10, "k")
    ideal = top_k_per_group(rp, "customer_id", "quantity", "item_id", 10, "k")
    gain = F.col("quantity") / F.log2(F.col("k") + 1)
    d = pred.groupBy("customer_id").agg(F.sum(gain).alias("dcg"))
    i = ideal.groupBy("customer_id").agg(F.sum(gain).alias("idcg"))
    return d.join(i, "customer_id").agg(F.count(F.lit(1)).alias("n_customers"),
                                        F.round(F.avg(F.col("dcg") / F.col("idcg")), 6).alias("ndcg_at_10"))


def _coded_ratings(t):
    """The ratings and their codes as a table: the codes and the fit read them many times."""
    r = saved(ad.ratings(t), "ratings")
    return saved(md.with_codes(r, ["customer_id", "item_id"]), "coded-ratings")


@query("als_recommend")
def als_recommend(spark, sf_dir):
    """Implicit-feedback ALS on customer x part quantities; top 10 parts per customer."""
    r = _coded_ratings(Tables(spark, sf_dir))
    found = md.recommend(md.als_model(ratings=r.count()).fit(r), 10)
    customers = r.select("customer_id", "customer_id_code").distinct()
    items = r.select("item_id", "item_id_code").distinct()
    return found.join(customers, "customer_id_code").join(items, "item_id_code") \
        .select("customer_id", "rank", "item_id", "score")


@query("als_ndcg")
def als_ndcg(spark, sf_dir):
    """NDCG@10 of the ALS ranking on held-out ratings (a fifth of the customer x part
    pairs, by hash); the model is fitted on the others.  Held-out pairs with a customer or
    part unknown to the model rank last."""
    r = _coded_ratings(Tables(spark, sf_dir)).withColumn(
        "_held", hash_bucket(F.concat_ws("-", "customer_id", "item_id"), buckets=5, seed=42) == 0)
    model = md.als_model(ratings=r.count()).setColdStartStrategy("nan").fit(r.where(~F.col("_held")))
    scored = model.transform(r.where("_held")).withColumn(
        "score", F.nanvl(F.col("prediction"), F.lit(float("-inf")).cast("float")))
    g = md.ndcg(scored, "customer_id", "score", "quantity", "item_id")
    return g.agg(F.count(F.lit(1)).alias("n_customers"),
                 F.round(F.avg(F.col("dcg") / F.col("idcg")), 6).alias("ndcg_at_10"))
