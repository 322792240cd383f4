"""Exact dedup by a tree-merge of sorted digest runs.

Every partition of the table starts with a run: its texts' digests, each with the
row that stays and the number of rows.  Runs are merged in binomial rounds: round k
brings together the ``2**bits`` partitions that agree in all higher bits of their
number, so a text in a third of all rows shrinks to one entry for each run before
it moves on, and no round gathers more than ``2**bits`` entries of one text.  Entries
are ordered by a 64-bit digest; they are merged only where their SHA-256 and length
agree as well, so every level holds verified smallest identifiers.  The way back
to the rows deals a frequent text over as many parts as its share of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import save

#: White space that does not count when texts are compared.
SPACE = r"[\x20\x09-\x0D]+"
_PARTS = 1000  # a text with more than one row in so many is dealt out
_KEY = ["digest", "sha", "n_bytes"]


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def _digests(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(row, ``_id``, best, key columns) per row of ``df``; ``row`` is unique and its
    upper bits are the partition.  The least ``best`` is the row that stays."""
    text = F.col(f"`{text_col}`")
    plain = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("_id"),
                      F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n"),
                      normalised(text).alias("plain"))
    best = F.struct((-F.col("n")).alias("less"), F.col("_id").isNull().alias("unnamed"),
                    F.col("_id").alias("id"), F.col("row").alias("row"))
    return plain.select("row", "_id", best.alias("best"), F.xxhash64("plain").alias("digest"),
                        F.unhex(F.sha2("plain", 256)).alias("sha"),
                        F.octet_length("plain").alias("n_bytes"))


def merge_runs(rows: DataFrame, partitions: int, bits: int = 3) -> DataFrame:
    """One run of all digests from the runs of ``partitions`` partitions: key columns,
    best and size, in rounds that merge ``2**bits`` neighbouring runs each."""
    runs = rows.select(F.shiftright("row", 33).alias("run"), *_KEY, "best",
                       F.lit(1).cast("long").alias("size"))
    while True:
        partitions = -(-partitions >> bits)
        runs = runs.groupBy(F.shiftright("run", bits).alias("run"), *_KEY) \
            .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        if partitions <= 1:
            return runs.drop("run")


def find_copies(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                bits: int = 3, parts: int = _PARTS) -> DataFrame:
    """(``id_col``, keep_id, group_size, kept, text_sha256) per row of ``df``.

    Texts are equal when they are so without ASCII white space.  Of equal texts the
    row with the most code points stays, of these the one with the least id (rows
    without an id last), of rows that share all this the first read: exactly one row
    of each group has ``kept``.  A null text is empty, and empty texts form a group like
    any other.  Texts of any length are hashed whole; an empty table gives
    an empty result.  Other columns of ``df`` are not read, whatever their names.
    """
    rows = save(_digests(df, text_col, id_col), "digests")
    seen = rows.agg(F.max(F.shiftright("row", 33)).alias("last"), F.count("*").alias("n")).first()
    merged = merge_runs(rows, (seen["last"] or 0) + 1, bits)
    groups = save(merged.filter("size > 1"), "copies")
    share = F.ceil(F.col("size") * parts / max(1, seen["n"])).cast("int")
    # a part holds at least one row in ``parts``, so there are fewer hot texts than that
    hot = F.broadcast(groups.filter(F.col("size") * parts > seen["n"])
                      .select(*_KEY, share.alias("deal")))
    dealt = rows.join(hot, _KEY, "left").withColumn(
        "part", F.pmod("row", F.coalesce("deal", F.lit(1))).cast("int"))
    answers = groups.withColumn("part", F.explode(F.sequence(F.lit(0), share - 1)))
    found = dealt.join(answers.select(*_KEY, "part", F.col("best").alias("stays"), "size"),
                       [*_KEY, "part"], "left")
    alone = F.col("stays").isNull()
    return found.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("stays.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: one of each group of equal
    texts, by the rule of ``find_copies``.  Of rows that share id, length and text, that
    with the least hash of all its columns stays.  Clashing column names are kept apart."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    text = F.col(f"`{text_col}`")
    rows = df.select(whole.alias("_all"), F.col(f"`{id_col}`").alias("_id"),
                     F.length(F.coalesce(text, F.lit(""))).alias("_n"),
                     F.sha2(normalised(text), 256).alias("_sha"))
    stay = find_copies(df, text_col, id_col).filter("kept") \
        .select(F.col(id_col).alias("_stay"), F.col("text_sha256").alias("_sha2"))
    same = (rows["_sha"] == stay["_sha2"]) & rows["_id"].eqNullSafe(stay["_stay"])
    order = Window.partitionBy("_sha", "_id").orderBy(F.desc("_n"), F.xxhash64("_all"))
    return rows.join(stay, same, "left_semi").withColumn("_k", F.row_number().over(order)) \
        .filter("_k = 1").select("_all.*")
