"""Queries: tokenising, TF-IDF fit/apply, similar items (2.9 TX1-TX11, JN5, WN4, ML7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import features as ft
from tessera.operators import text as tt
from tessera.operators import topk
from tessera.operators.similar import resolve_items, similar_to
from tessera.plans import sql as S
from tessera.plans.q_features import RECO_REQ_SQL, WEIGHTED_SQL, reco_requests, validated_requests
from tessera.plans.registry import query
from tessera.session import saved, scratch_path
from tessera.sources import adapters as ad
from tessera.sources.tables import Tables

# Fixed parameters of the two vectorisers.
RECO = dict(min_df=2, max_df=0.8, max_features=5000, stop_words=True)
SENT = dict(min_df=2, max_df=0.95, max_features=10000, stop_words=False)

STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.english_stop_words()) + "]"
TOK = r"regexp_extract_all(strip_accents(lower({c})), '[\p{{L}}\p{{N}}_]{{2,}}')"


def tok_sql(c: str) -> str:
    return TOK.format(c=c)


def terms_sql(name: str, src: str, id_col: str, text_col: str, stop: bool) -> str:
    t = tok_sql(text_col)
    if stop:
        t = f"list_filter({t}, lambda x: NOT list_contains({STOP_SQL}, x))"
    return f"""
{name}_tok AS (SELECT {id_col}, {t} AS t FROM {src}),
{name} AS (SELECT {id_col}, term, count(*) AS tf FROM (
    SELECT {id_col}, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
    FROM {name}_tok) GROUP BY ALL)"""


def vocab_sql(name: str, terms: str, src: str, min_df: int, max_df: float, max_features: int) -> str:
    return f"""
{name} AS (SELECT term, df, tf_total, ln((1 + n_docs) / (1 + df)) + 1 AS idf, n_docs FROM (
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf_total, (SELECT count(*) FROM {src}) AS n_docs
    FROM {terms} GROUP BY term)
  WHERE df >= {min_df} AND df <= {max_df} * n_docs
  ORDER BY tf_total DESC, term LIMIT {max_features})"""


def weights_sql(name: str, terms: str, vocab: str, id_col: str) -> str:
    return f"""
{name}_raw AS (SELECT t.{id_col}, t.term, t.tf * v.idf AS w FROM {terms} t JOIN {vocab} v USING (term)),
{name} AS (SELECT {id_col}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS weight FROM {name}_raw)"""


BOOK_CTES = [S.BOOKS, WEIGHTED_SQL,
             "wbooks AS (SELECT book_id, combined_features FROM weighted WHERE length(combined_features) > 10)",
             terms_sql("bterms", "wbooks", "book_id", "combined_features", True),
             vocab_sql("bvocab", "bterms", "wbooks", RECO["min_df"], RECO["max_df"], RECO["max_features"]),
             weights_sql("bweights", "bterms", "bvocab", "book_id")]


def _book_fit(t):
    """Weighted catalog text, its vocabulary and counts, both tables."""
    wb = ft.weighted_text(ad.books(t)).select("book_id", "combined_features")
    return wb, *tt.fit_text(wb, "book_id", "combined_features", **RECO)


def book_vocabulary(t):
    """Weighted catalog text and its vocabulary, a table."""
    return _book_fit(t)[:2]


def book_index(t):
    """The recommendation index: weighted catalog text -> vocabulary -> weights, from the counts
    that the vocabulary was fitted on."""
    wb, vocab, terms = _book_fit(t)
    terms = tt.only(vocab, RECO["max_features"])(terms)
    return wb, vocab, tt.tfidf(terms, vocab, "book_id", vocab_bound=RECO["max_features"])


def book_weights(t):
    """The index's weights as a table, for queries that read it several times."""
    return saved(book_index(t)[2], "book-weights")


@query("tokenize", sql=f"SELECT doc_id, len({tok_sql('text')}) AS n_tokens FROM documents")
def tokenize(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", F.size(tx.tokens("text")).cast("long").alias("n_tokens"))


@query("strip_accents", sql="SELECT doc_id, strip_accents(text) AS text FROM documents")
def strip_accents(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", tx.strip_accents("text").alias("text"))


@query("ngrams", sql=f"""
WITH t AS (SELECT doc_id, {tok_sql('text')} AS t FROM documents)
SELECT doc_id, len(t) AS n_unigrams, greatest(len(t) - 1, 0) AS n_bigrams,
       len(list_distinct(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])))) AS n_distinct_terms
FROM t""")
def ngrams(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", tx.tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_unigrams"),
                    F.size(tx.bigrams(F.col("t"))).cast("long").alias("n_bigrams"),
                    F.size(F.array_distinct(tx.uni_and_bigrams(F.col("t")))).cast("long").alias("n_distinct_terms"))


@query("remove_stopwords", sql=f"""
WITH t AS (SELECT doc_id, {tok_sql('text')} AS t FROM documents)
SELECT doc_id, len(t) AS n_tokens, len(list_filter(t, lambda x: NOT list_contains({STOP_SQL}, x))) AS n_kept FROM t""")
def remove_stopwords(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", tx.tokens("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                    F.size(tx.remove_stop_words(F.col("t"))).cast("long").alias("n_kept"))


@query("vocabulary", sql=S.with_(*BOOK_CTES) + "SELECT term, df, tf_total, round(idf, 6) AS idf FROM bvocab")
def vocabulary(spark, sf_dir):
    _, vocab = book_vocabulary(Tables(spark, sf_dir))
    return vocab.select("term", "df", "tf_total", F.round("idf", 6).alias("idf"))


@query("tfidf_weights", sql=S.with_(*BOOK_CTES) + "SELECT book_id, term, round(weight, 6) AS weight FROM bweights")
def tfidf_weights(spark, sf_dir):
    _, _, w = book_index(Tables(spark, sf_dir))
    return w.select("book_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_matrix_stats", sql=S.with_(*BOOK_CTES) + """
SELECT (SELECT count(*) FROM wbooks) AS n_rows, (SELECT count(*) FROM bweights) AS nnz,
       (SELECT count(*) FROM bvocab) AS vocabulary,
       round((1 - (SELECT count(*) FROM bweights) / ((SELECT count(*) FROM wbooks) * (SELECT count(*) FROM bvocab))) * 100, 4) AS sparsity_pct""")
def tfidf_matrix_stats(spark, sf_dir):
    wb, vocab, w = book_index(Tables(spark, sf_dir))  # the vocabulary is small beside the weights
    return tt.matrix_stats(w, vocab, wb, "book_id")


SENT_CTES = [S.SENTIMENT, terms_sql("sterms", "sentiment", "doc_id", "clean_text", False),
             vocab_sql("svocab", "sterms", "sentiment", SENT["min_df"], SENT["max_df"], SENT["max_features"])]


def sentiment_vocab(t):
    return tt.fit_text_vocabulary(ad.sentiment_texts(t), "doc_id", "clean_text", **SENT)


@query("tfidf_transform_new", sql=S.with_(*SENT_CTES, terms_sql("nterms", "benchmark", "item_id", "text", False),
                                         weights_sql("nweights", "nterms", "svocab", "item_id")) + """
SELECT b.item_id, w.term, round(coalesce(w.weight, 0.0), 6) AS weight
FROM benchmark b LEFT JOIN nweights w USING (item_id)""")
def tfidf_transform_new(spark, sf_dir):
    """Unseen texts (benchmark) through the vocabulary fitted on the labelled corpus."""
    t = Tables(spark, sf_dir)
    vocab = sentiment_vocab(t)
    w = tt.transform_new(t.benchmark, vocab, "item_id", "text", vocab_bound=SENT["max_features"])
    return w.select("item_id", "term", F.round("weight", 6).alias("weight"))


RESOLVED_SQL = """
, by_title AS (
  SELECT r.request_id, min(b.book_id) AS book_id
  FROM reco_requests r JOIN books b ON r.book_id IS NULL AND r.title IS NOT NULL
       AND contains(lower(b.title), lower(r.title))
  GROUP BY r.request_id),
resolved AS (
  SELECT r.request_id, COALESCE(bi.book_id, bt.book_id) AS query_book_id, COALESCE(r.num_recommendations, 5) AS n
  FROM reco_requests r LEFT JOIN books bi ON r.book_id = bi.book_id
  LEFT JOIN by_title bt ON r.request_id = bt.request_id
  WHERE COALESCE(bi.book_id, bt.book_id) IS NOT NULL AND COALESCE(r.num_recommendations, 5) BETWEEN 1 AND 20)"""

SIMILAR_SQL = S.with_(*BOOK_CTES, RECO_REQ_SQL)[:-1] + RESOLVED_SQL + """,
q AS (SELECT r.request_id, r.query_book_id, r.n, w.term, w.weight FROM resolved r JOIN bweights w ON w.book_id = r.query_book_id),
s AS (SELECT q.request_id, any_value(q.query_book_id) AS query_book_id, any_value(q.n) AS n, w.book_id,
             sum(q.weight * w.weight) AS sim
      FROM q JOIN bweights w USING (term) GROUP BY q.request_id, w.book_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(sim, 10) DESC, book_id) AS rank
           FROM s WHERE book_id <> query_book_id)
"""


# Fixed value: the most recommendations a request may ask for.
MAX_RECOMMENDATIONS = 20


def resolved_requests(t, resolved=None):
    """The requests to be answered; ``resolved``: what ``resolve_items`` found, if it is there already."""
    req = reco_requests(t)
    res = resolve_items(req, ad.books(t)) if resolved is None else resolved
    n = F.coalesce(F.col("num_recommendations"), F.lit(5))
    return (res.where(F.col("status") == 200).join(req.select("request_id", n.alias("n")), "request_id")
            .where(F.col("n").between(1, MAX_RECOMMENDATIONS)).select("request_id", "query_book_id", "n"))


def similar_items_df(t, resolved=None):
    return similar_to(resolved_requests(t, resolved), book_weights(t), "book_id", MAX_RECOMMENDATIONS)


@query("similar_items", sql=SIMILAR_SQL + """
SELECT request_id, CAST(rank AS INTEGER) AS rank, book_id, round(sim, 6) AS similarity FROM ranked WHERE rank <= n""")
def similar_items(spark, sf_dir):
    """Cosine top-n per request over the whole catalog, the query item excluded by id."""
    s = similar_items_df(Tables(spark, sf_dir))
    return s.select("request_id", "rank", "book_id", F.round("similarity", 6).alias("similarity"))


def indexed_search(t):
    """The requests' query vectors against the block index: (best, what was read)."""
    w = book_weights(t)
    index = saved(topk.build(w, "book_id"), "book-blocks")
    queries = resolved_requests(t).join(w.withColumnRenamed("book_id", "query_book_id"), "query_book_id") \
        .select(F.col("request_id").alias("qid"), F.col("query_book_id").alias("own"), F.col("n").alias("k"),
                "term", F.col("weight").alias("qw"))
    return topk.search(saved(queries, "query-vectors"), w, index, "book_id", MAX_RECOMMENDATIONS)


@query("similar_items_indexed", sql=SIMILAR_SQL + """
SELECT request_id, CAST(rank AS INTEGER) AS rank, book_id, round(sim, 6) AS similarity FROM ranked WHERE rank <= n""")
def similar_items_indexed(spark, sf_dir):
    """``similar_items`` through the block index: only postings that may matter are read."""
    best, _ = indexed_search(Tables(spark, sf_dir))
    return best.select(F.col("qid").alias("request_id"), "rank", F.col("id").alias("book_id"),
                       F.round("score", 6).alias("similarity"))


@query("index_reads", sql=SIMILAR_SQL + """
, df AS (SELECT term, count(*) AS df FROM bweights GROUP BY term),
total AS (SELECT q.request_id, CAST(sum(df.df) AS BIGINT) AS postings FROM q JOIN df USING (term) GROUP BY q.request_id)
SELECT request_id, postings, true AS within FROM total""")
def index_reads(spark, sf_dir):
    """Per request the postings of its terms, and that the index read and scored no more of
    them (that the share read falls as a catalog grows is asserted in ``tests/test_topk.py``)."""
    _, cost = indexed_search(Tables(spark, sf_dir))
    return cost.select(F.col("qid").alias("request_id"), "postings",
                       ((F.col("read") <= F.col("postings")) & (F.col("scored") <= F.col("read"))).alias("within"))


@query("index_roundtrip", sql=SIMILAR_SQL + """
SELECT request_id, CAST(rank AS INTEGER) AS rank, book_id, round(sim, 6) AS similarity FROM ranked WHERE rank <= n""")
def index_roundtrip(spark, sf_dir):
    """The index (its weights) written as a table and read again answers as before."""
    t = Tables(spark, sf_dir)
    w = book_index(t)[2]
    path = scratch_path(spark, "book-index")
    w.write.parquet(path)
    s = similar_to(resolved_requests(t), spark.read.parquet(path), "book_id", MAX_RECOMMENDATIONS)
    return s.select("request_id", "rank", "book_id", F.round("similarity", 6).alias("similarity"))


def reco_answers(t):
    """One row per request: status_code 200, 400 (invalid) or 404 (no such book),
    error, the query book (score 1.0) and the ranked recommendations (maybe none).  Titles are
    looked into once, and only the books of an answer meet it."""
    req = reco_requests(t)
    resolved = saved(resolve_items(req, ad.books(t)), "resolved")
    asked = validated_requests(req).join(resolved.select("request_id", "query_book_id"), "request_id")
    code = (F.when(F.col("status") != "ok", 400).when(F.col("query_book_id").isNull(), 404).otherwise(200))
    asked = asked.withColumn("status_code", code).select(
        "request_id", "status_code", F.when(code == 400, F.col("status")).when(code == 404, "not_found").alias("error"),
        F.when(code == 200, F.col("query_book_id")).alias("query_book_id"))
    books = ad.books(t).select("book_id", "title", "authors", "categories", "average_rating", "ratings_count",
                               ft.truncate_text("description").alias("description"),
                               F.lit(None).cast("string").alias("thumbnail"))
    fields = books.columns
    found = saved(similar_items_df(t, resolved), "recommended")
    needed = saved(found.select("book_id").union(resolved.select("query_book_id")).distinct(), "answer-ids")
    books = saved(books.join(needed, "book_id", "left_semi"), "answer-books")
    recs = found.join(books, "book_id").groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", *fields, F.round("similarity", 6).alias("similarity_score")))) \
        .alias("recommendations"))
    own = books.select(F.col("book_id").alias("query_book_id"),
                       F.struct(*fields, F.lit(1.0).alias("similarity_score")).alias("query_book"))
    answers = asked.join(own, "query_book_id", "left").join(recs, "request_id", "left")
    none = F.array().cast(recs.schema["recommendations"].dataType)
    return answers.withColumn("recommendations", F.coalesce("recommendations", none)) \
        .withColumn("num_results", F.size("recommendations"))


@query("reco_response")
def reco_response(spark, sf_dir):
    """One JSON document per request, whatever its status."""
    a = reco_answers(Tables(spark, sf_dir))
    return a.select("request_id", F.to_json(F.struct(
        "status_code", "error", "query_book", "recommendations", "num_results")).alias("response"))


@query("reco_status", sql=S.with_(*BOOK_CTES, RECO_REQ_SQL)[:-1] + SIMILAR_SQL[SIMILAR_SQL.index(RESOLVED_SQL):] + """,
got AS (SELECT request_id, count(*) AS c FROM ranked WHERE rank <= n GROUP BY request_id),
hit AS (SELECT r.request_id, COALESCE(bi.book_id, bt.book_id) AS book_id
        FROM reco_requests r LEFT JOIN books bi ON r.book_id = bi.book_id LEFT JOIN by_title bt USING (request_id))
SELECT r.request_id,
       CAST(CASE WHEN r.book_id IS NULL AND (r.title IS NULL OR r.title = '') THEN 400
                 WHEN COALESCE(r.num_recommendations, 5) NOT BETWEEN 1 AND 20 THEN 400
                 WHEN hit.book_id IS NULL THEN 404 ELSE 200 END AS INTEGER) AS status_code,
       CAST(COALESCE(got.c, 0) AS INTEGER) AS num_results
FROM reco_requests r LEFT JOIN hit USING (request_id) LEFT JOIN got USING (request_id)""")
def reco_status(spark, sf_dir):
    """Status code and number of recommendations of every request's answer."""
    return reco_answers(Tables(spark, sf_dir)).select("request_id", "status_code", "num_results")
