"""Sampling, splitting and weighted assignment with portable md5 hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_bucket, md5_key
from tessera.functions.joins import bounded_broadcast
from tessera.functions.ranking import attach_totals, prefix_sums


def weighted_assign(rows: DataFrame, keys: DataFrame, u_col: str, key_col: str, w_col: str,
                    buckets: int = 4096) -> DataFrame:
    """Give each row the key whose interval of cumulative weight holds the row's
    number (sampling keys with replacement, p ~ weight).

    ``u_col`` is uniform in 0 .. 2^32 - 1 and weights are whole numbers, so the
    intervals [before, upto) meet without gaps or overlaps: every row gets exactly
    one key.  Null, zero and negative weights are never drawn.  A range join made
    an equi-join: the weight axis is cut into ``buckets`` cells; each interval is
    listed under every cell it overlaps, and each row looks into its own cell.
    """
    k = keys.where(F.col(w_col) > 0).groupBy(key_col).agg(F.sum(F.col(w_col).cast("long")).alias("_w"))
    total = k.agg(F.sum("_w").alias("_tot"))
    iv = attach_totals(prefix_sums(k, key_col, ["_w"]), total, [])

    def cell(c: str) -> Column:
        return F.expr(f"CAST(CAST({c} AS DECIMAL(28,0)) * {buckets} DIV _tot AS INT)")

    cells = iv.withColumn("_last", F.col("_w_upto") - 1).select(
        key_col, F.col("_w_before").alias("_lo"), F.col("_w_upto").alias("_hi"),
        F.explode(F.sequence(cell("_w_before"), cell("_last"))).alias("_cell"))
    r = attach_totals(rows, total, []) \
        .withColumn("_at", F.expr(f"CAST(CAST({u_col} AS DECIMAL(19,0)) * CAST(_tot AS DECIMAL(19,0)) "
                                  "DIV 4294967296 AS BIGINT)"))
    r = r.withColumn("_cell", cell("_at")).drop("_tot")
    j = r.join(bounded_broadcast(cells), on="_cell", how="inner")
    return j.where((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))) \
        .drop("_cell", "_lo", "_hi", "_at")


def stratified_split(df: DataFrame, id_col: str, label_col: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Exact stratified split: inside each label, rows ordered by md5(id|seed);
    the first ceil(test_size * n_label) rows go to test (rows of one id together; a
    null label is a label).  Ranks come from the
    distributed prefix sums, so a dominant label is not sorted in one task."""
    h = df.withColumn("_h", md5_key(id_col, seed=seed))
    # rows that share an id share its hash: one row per hash, with their number
    ones = h.groupBy(label_col, "_h").agg(F.count(F.lit(1)).alias("_one"))
    ranked = prefix_sums(ones, "_h", ["_one"], [label_col])
    totals = ones.groupBy(label_col).agg(F.sum("_one").alias("_n"))
    ranked = attach_totals(ranked, totals, [label_col]).select(
        F.col(label_col).alias("_label"), F.col("_h").alias("_h2"),
        (F.col("_one_upto") <= F.ceil(F.col("_n") * test_size)).alias("_test"))
    out = h.join(ranked, (h["_h"] == ranked["_h2"]) & h[label_col].eqNullSafe(ranked["_label"])) \
        .drop("_label", "_h2")
    return out.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_h", "_test")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of n rows: the n smallest md5(id|seed).  A top-n, so each
    task keeps n rows before the final merge (TakeOrderedAndProject)."""
    return df.withColumn("_h", md5_key(id_col, seed=seed)).orderBy("_h").limit(n).drop("_h")


def traffic_split(df: DataFrame, key_col: str, weights: Sequence[tuple[str, int]], seed: str = "") -> DataFrame:
    """Sticky split by key: 8 hex digits of md5(key) mod 100 against cumulative weights."""
    b = hash_bucket(key_col, buckets=100, seed=seed or None)
    arm = None
    cum = 0
    for name, w in weights:
        cum += w
        arm = F.when(b < cum, F.lit(name)) if arm is None else arm.when(b < cum, F.lit(name))
    return df.withColumn("arm", arm.otherwise(F.lit(weights[-1][0])))


def class_rate_by_split(df: DataFrame, label_col: str, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.avg(F.col(label_col).cast("double")).alias("rate"),
                                     F.count(F.lit(1)).alias("n"))
