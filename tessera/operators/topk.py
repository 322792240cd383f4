"""Exact cosine top-k over sparse unit vectors without reading whole posting lists.

An inverted index holds each term's postings in blocks of like weight, with the largest
weight of each block.  A query first scores the items of its few best blocks exactly: its
k-th best score so far is a floor.  Then every term of the query gets a cut such that an
item whose weights all stay at their cuts could not reach the floor; postings at or
below the cuts are not read (whole blocks are skipped by their largest weight), and of
the items seen above them only those whose bound reaches the floor are scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ranking import join_groups
from tessera.operators import blocks
from tessera.session import saved

BLOCK = 512  # postings in a block, about
STEP = 4  # weight classes between a weight and its half
SEEDS = 4  # blocks that a query reads first, for each result asked for
SLACK = 1e-9  # floating sums may differ by this much


def build(weights: DataFrame, id_col: str) -> DataFrame:
    """(term, cls, part, top, n, posts): blocks of a term's postings (id, w).  A block holds one class
    of weights (a factor of 2**(1/STEP)); a class of more than ``BLOCK`` postings is dealt by a hash of
    the id, so that a term in most items is many blocks and no task gathers them."""
    w = weights.select("term", F.col(id_col).alias("id"), F.col("weight").alias("w")).where("w > 0")
    cls = F.floor(-F.log2("w") * STEP).cast("int")
    sized = w.withColumn("cls", cls)
    per = sized.groupBy("term", "cls").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    dealt = join_groups(sized, per, ["term", "cls"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    return dealt.groupBy("term", "cls", "part").agg(
        F.max("w").alias("top"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("id", "w")).alias("posts"))


def _exact(pairs: DataFrame, queries: DataFrame, weights: DataFrame, id_col: str) -> DataFrame:
    """(qid, id, score) of (qid, id) pairs, from the items' own vectors."""
    items = weights.select(F.col(id_col).alias("id"), "term", F.col("weight").alias("w"))
    return blocks.pair_scores(pairs, queries, items)


def _best(scored: DataFrame, by: Column, k: Column | str, most: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(by.desc(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most) \
        .where(F.col("rank") <= k)


def with_cuts(queries: DataFrame, terms: DataFrame, floors: DataFrame) -> DataFrame:
    """``queries`` with the floor and each term's cut.

    Common light terms are cut at their largest weight first, which skips them, for as long
    as these largest contributions add up to at most nine tenths of the floor (the others need
    some room).  The rest of the floor is shared among the other terms by their
    weight in the query.  Any cuts whose contributions add up to less than the floor are safe.
    """
    q = queries.join(terms, "term").join(floors, "qid", "left") \
        .withColumn("floor", F.coalesce("floor", F.lit(0.0))).withColumn("most", F.col("qw") * F.col("top"))
    # dear first: postings that a unit of the floor saves
    order = Window.partitionBy("qid").orderBy((F.col("df") / F.col("most")).desc(), "term")
    before = F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0))
    q = q.withColumn("skip", before <= 0.9 * F.col("floor"))
    whole = Window.partitionBy("qid")
    spent = F.sum(F.when(F.col("skip"), F.col("most")).otherwise(0.0)).over(whole)
    other = F.sum(F.when(F.col("skip"), 0.0).otherwise(F.col("qw") * F.col("qw"))).over(whole)
    share = F.greatest(F.col("floor") - spent - SLACK, F.lit(0.0)) * F.try_divide(F.col("qw"), other)
    return q.withColumn("cut", F.when(F.col("skip"), F.col("top")).otherwise(F.least(share, F.col("top"))))


def search(queries: DataFrame, weights: DataFrame, index: DataFrame, id_col: str, max_k: int) -> tuple[DataFrame, DataFrame]:
    """The k items of the best score for each query (never the query's own item), as (qid, id,
    score, rank), and what was read: (qid, postings, read, skipped_terms, scored).

    ``queries``: (qid, own, k, term, qw), unit vectors with the item of their own or null;
    k is at most ``max_k``.  Only items that share a term with the query have a score.
    ``index`` should be a table (it is read three times).
    """
    terms = index.groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top"))
    about = queries.select("qid", "own", "k").distinct()

    # 1. a floor from the exact scores of the best blocks' items
    heads = queries.join(index.select("term", "cls", "part", "top"), "term")
    first = Window.partitionBy("qid").orderBy((F.col("qw") * F.col("top")).desc(), "term", "part")
    chosen = heads.withColumn("r", F.row_number().over(first)).where(F.col("r") <= SEEDS * max_k) \
        .where(F.col("r") <= SEEDS * F.col("k")).drop("top", "r")
    chosen = saved(chosen, "first-blocks")
    few = F.broadcast(chosen) if chosen.count() <= blocks.FEW else chosen  # then the postings stay where they are
    seeds = few.join(index.select("term", "cls", "part", "posts"), ["term", "cls", "part"]) \
        .select("qid", "own", "k", "qw", F.inline("posts")) \
        .where(~F.col("id").eqNullSafe(F.col("own"))) \
        .groupBy("qid", "k", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("part"))
    some = saved(_best(seeds, F.col("part"), 2 * F.col("k"), 2 * max_k).select("qid", "k", "id"), "first-pairs")
    exact = _exact(some.select("qid", "id"), queries, weights, id_col).join(about.select("qid", "k"), "qid")
    # k scores at or above the floor are known
    floors = _best(exact, F.col("score"), F.col("k"), max_k).groupBy("qid", "k") \
        .agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where("n = k").select("qid", "floor")

    # 2. the postings above the cuts: blocks that no query needs are not read
    cut = saved(with_cuts(queries, terms, floors), "query-cuts")
    wanted = cut.where(~F.col("skip"))
    need = wanted.join(index.withColumnRenamed("top", "block_top"), "term").where(F.col("block_top") > F.col("cut"))
    used = cut.groupBy("qid").agg(F.sum(F.col("qw") * F.col("cut")).alias("used"), F.first("floor").alias("floor"))
    least = wanted.groupBy("term").agg(F.min("cut").alias("least"))
    posts = index.join(least, "term").where(F.col("top") > F.col("least")) \
        .select("term", "least", F.inline("posts")).where(F.col("w") > F.col("least")).drop("least")
    # what is not above a term's cut adds the cut at most
    room = (F.col("floor") - F.col("used") - SLACK).alias("room")
    viable = saved(blocks.above_cuts(wanted.drop("floor").join(used, "qid").select("qid", "own", "term", "qw", "cut", room),
                                     posts, index.agg(F.sum("n")).first()[0] or 0), "viable-pairs")

    # 3. exact scores of what is left
    scored = _exact(viable, queries, weights, id_col).join(about, "qid")
    best = _best(scored, F.round("score", 10), F.col("k"), max_k).select("qid", "id", "score", "rank")
    read = need.groupBy("qid").agg(F.sum("n").alias("read"))
    cost = cut.groupBy("qid").agg(F.sum("df").alias("postings"), F.sum(F.col("skip").cast("long")).alias("skipped_terms")) \
        .join(read, "qid", "left").join(viable.groupBy("qid").agg(F.count(F.lit(1)).alias("scored")), "qid", "left")
    return best, cost.select("qid", "postings", F.coalesce("read", F.lit(0)).alias("read"), "skipped_terms",
                             F.coalesce("scored", F.lit(0)).alias("scored"))
