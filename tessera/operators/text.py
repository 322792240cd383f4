"""TF-IDF on long tables (doc, term, weight) with the vectoriser's defaults:
raw term counts, document-frequency bounds, top features by corpus count,
smoothed idf ln((1+n)/(1+df))+1 and L2-normalised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions.joins import bounded_broadcast
from tessera.functions.ranking import attach_totals
from tessera.operators import grams
from tessera.session import saved
from tessera.sources.tables import spread

BUCKETS = 1 << 20  # sums of occurrences by a hash of the term
CUT = 4  # buckets first looked into for each feature


def occurrences(docs: DataFrame, id_col: str, text_col: str, stop_words: bool = False,
                ngrams: bool = True) -> DataFrame:
    """(id, term), one row per occurrence: tokens, optional stop-word removal (before
    n-grams), 1-2-grams."""
    toks = tx.tokens(text_col)
    if stop_words:
        toks = tx.remove_stop_words(toks)
    # tokens become a column first, so the n-gram expression reuses them
    staged = docs.select(id_col, toks.alias("_tok"))
    terms = tx.uni_and_bigrams(F.col("_tok")) if ngrams else F.col("_tok")
    # explode_outer: a plain explode makes the optimizer infer a size(...) > 0
    # filter and re-evaluate the token expressions under the scan
    return staged.select(id_col, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def doc_terms(docs: DataFrame, id_col: str, text_col: str, stop_words: bool = False,
              ngrams: bool = True, among=lambda rows: rows) -> DataFrame:
    """(id, term, tf): the occurrences that ``among`` keeps, counted per (id, term).  The texts
    are dealt by id where the scan has few tasks, else the count is combined inside each task
    before the shuffle; either way only terms that ``among`` keeps are held or sent."""
    rows = occurrences(spread(docs.select(id_col, text_col), id_col), id_col, text_col, stop_words, ngrams)
    return among(rows).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def only(terms: DataFrame, bound: int | None):
    """Of occurrences or counts those of the ``terms`` (at most ``bound``) alone, also for ``doc_terms``."""
    return lambda rows: rows.join(bounded_broadcast(terms.select("term"), BUCKETS, bound), "term", "left_semi")


def fit_vocabulary(docs: DataFrame, terms: DataFrame, id_col: str, min_df: int = 2,
                   max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """(term, df, tf_total, idf): df bounds, then the ``max_features`` terms with
    the largest corpus count (ties by term).  The count per term is a combinable
    aggregate, so a very common term costs one row per task before the shuffle."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    stats = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf_total"))
    stats = attach_totals(stats, n_docs, [])
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n_docs")))
    if max_features:
        kept = kept.orderBy(F.col("tf_total").desc(), F.col("term").asc()).limit(max_features)
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    return kept.select("term", "df", "tf_total", idf.alias("idf"), "n_docs")


def fit_text(docs: DataFrame, id_col: str, text_col: str, min_df: int, max_df: float,
             max_features: int, stop_words: bool = False) -> tuple[DataFrame, DataFrame]:
    """``fit_vocabulary`` of all terms of the texts, without counting most of them, and the (id, term, tf)
    it was fitted on, which has at least all terms of the vocabulary; both are tables.

    First the occurrences of all terms are counted by hash bucket, a fixed number of sums.  A term
    occurs at most as often as its bucket, so only terms of buckets above a cut are counted one by
    one.  Where ``max_features`` of them stay within the bounds and none is rarer than the cut, no
    other term can be among the first; else the cut falls, to what the last of them has or to
    nothing, and they are counted again.  The result is exact with any cut.

    So the texts are taken apart twice, and counted where they lie; counts are sent by (id, term) only
    where an id has several texts."""
    spark, stop = docs.sparkSession, list(tx.english_stop_words()) if stop_words else []
    texts = spread(docs.select(id_col, text_col), id_col, spark.sparkContext.defaultParallelism) \
        .select(id_col, tx.tokens(text_col).alias("_tok"))
    sums = saved(grams.bucket_sums(texts, "_tok", BUCKETS, stop), "term-buckets")
    largest = sums.orderBy(F.col("n").desc()).limit(CUT * max_features)
    cut = largest.agg(F.min("n")).first()[0] or 0
    while True:
        # at most ``BUCKETS`` numbers, as one bit each in the tasks; none where all are counted
        heavy = sums.where(F.col("n") >= cut).select("b").toArrow()["b"].to_numpy() if cut > 1 else None
        rows = saved(grams.counts(texts, id_col, "_tok", BUCKETS, heavy, stop), "term-counts")
        marks, terms = rows.where("term IS NULL"), rows.where("term IS NOT NULL")
        if marks.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            terms = terms.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
        vocab = saved(fit_vocabulary(marks, terms, id_col, min_df, max_df, max_features), "vocabulary")
        n, last = vocab.agg(F.count(F.lit(1)), F.min("tf_total")).first()
        if cut <= 1 or (n == max_features and last >= cut):
            return vocab, terms
        cut = last if n == max_features else 0


def fit_text_vocabulary(docs: DataFrame, id_col: str, text_col: str, min_df: int, max_df: float,
                        max_features: int, stop_words: bool = False) -> DataFrame:
    """The vocabulary of ``fit_text``."""
    return fit_text(docs, id_col, text_col, min_df, max_df, max_features, stop_words)[0]


def tfidf(terms: DataFrame, vocab: DataFrame, id_col: str, vocab_bound: int | None = None) -> DataFrame:
    """(id, term, weight) with unit L2 norm per id.  The vocabulary is bounded by
    ``max_features`` and broadcast after a size check; the norm is a window per
    id (at most one row per vocabulary term)."""
    v = bounded_broadcast(vocab.select("term", "idf"), bound=vocab_bound)
    w = terms.join(v, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / norm).alias("weight"))


def transform_new(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
                  stop_words: bool = False, vocab_bound: int | None = None) -> DataFrame:
    """Apply a fitted vocabulary + idf to new texts: unknown terms dropped; rows
    without a known term keep a zero vector (null term, weight 0)."""
    t = doc_terms(docs, id_col, text_col, stop_words, among=only(vocab, vocab_bound))
    known = tfidf(t, vocab, id_col, vocab_bound)
    return docs.select(id_col).join(known, id_col, "left").fillna(0.0, ["weight"])


def matrix_stats(weights: DataFrame, vocab: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    rows = docs.agg(F.count(F.lit(1)).alias("n_rows"))
    nnz = weights.agg(F.count(F.lit(1)).alias("nnz"))
    voc = vocab.agg(F.count(F.lit(1)).alias("vocabulary"))
    s = attach_totals(attach_totals(rows, nnz, []), voc, [])
    return s.withColumn("sparsity_pct",
                        F.round((1 - F.col("nnz") / (F.col("n_rows") * F.col("vocabulary"))) * 100, 4))
