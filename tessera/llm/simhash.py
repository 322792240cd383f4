"""SimHash near-dedup with pigeonring filtering.

Two fingerprints of 64 bits that differ in ``distance`` = 2 of them or fewer are
cut into three segments on a ring.  By the pigeonring principle some segment
begins a chain whose differences stay within the proportional budget at every
length: 2/3 of a bit (so none) in the first, 4/3 (so one) in the first two, two
in all three.  Candidates therefore agree in one segment and differ in at most
one bit of the next: an equi-join on these 42 or 43 bits, one side with each
clear bit of the second segment set in turn.  The full Hamming check follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import by_shuffle, groups_of_bytes, save
from tessera.llm.components import connected

_SEGMENTS = (21, 21, 22)
_BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64 bits; a bit is set if it is in over half the shingles' hashes."""
    ws = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    joined = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = np.append(0, ends[:-1])
    k = min(shingle, len(ws))
    spans = zip(starts[:len(ws) - k + 1].tolist(), (ends[k - 1:] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(ws) - k + 1
    for at in range(0, n, _BLOCK):
        h = np.fromiter((digest(joined[s:e], seed) for (s, e), _ in
                         zip(spans, range(min(_BLOCK, n - at)), strict=False)), "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 shingle: int = 3, seed: int = 42, group_bytes: int = 4 << 20) -> DataFrame:
    """(``_id``, ``_th``, fp) per row of ``df`` (``_th``: hash of the text); null and
    empty texts have fingerprint 0."""
    rows = df.select(F.col(f"`{id_col}`").alias("_id"),
                     F.xxhash64(F.col(f"`{text_col}`")).alias("_th"),
                     F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of_bytes(batches, "_text", group_bytes):
            for b in group:
                fp = np.array([fingerprint(t or "", shingle, seed)
                               for t in b.column("_text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([
                    b.column("_id"), b.column("_th"), pa.array(fp.view(np.int64))],
                    ["_id", "_th", "fp"])

    return rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, _th bigint, fp bigint")


def _chain_keys(fp: Column) -> list[tuple[int, Column, list[int]]]:
    """Per chain start: its number, its first two segments, and the second's bits."""
    out, at = [], 0
    for i, first in enumerate(_SEGMENTS):
        second = _SEGMENTS[(i + 1) % len(_SEGMENTS)]
        ring = fp if at == 0 else F.shiftrightunsigned(fp, at).bitwiseOR(
            F.shiftleft(fp, 64 - at))
        key = ring.bitwiseAND(F.lit((1 << first + second) - 1))
        out.append((i, key, [1 << first + j for j in range(second)]))
        at += first
    return out


def links(distinct: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``fp`` that differ in
    one or two bits (each found at every chain start that it satisfies)."""
    index, probes = None, None
    for i, key, bits in _chain_keys(F.col("fp")):
        own = distinct.select(F.lit(i).alias("i"), key.alias("key"), F.col("fp").alias("b"))
        # a bit that differs is clear on one side: setting clear bits finds each pair
        clear = F.array(*[F.lit(x).cast("long") for x in [0, *bits]])
        tried = distinct.select(F.col("fp").alias("a"), key.alias("k"), F.explode(clear).alias("x")) \
            .filter(F.col("k").bitwiseAND(F.col("x")) == 0) \
            .select(F.lit(i).alias("i"), F.col("k").bitwiseOR(F.col("x")).alias("key"), "a")
        index = own if index is None else index.unionByName(own)
        probes = tried if probes is None else probes.unionByName(tried)
    return (by_shuffle(probes).join(index, ["i", "key"])
            .filter("a <> b AND bit_count(a ^ b) <= 2")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _components(df: DataFrame, text_col: str, id_col: str, shingle: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows' (``_id``, ``_th``, fp), and of each distinct fp its (fp, label, least): the
    least fingerprint of its component and the least id of its rows."""
    fps = save(fingerprints(df, text_col, id_col, shingle, seed), "fingerprints")
    distinct = save(fps.groupBy("fp").agg(F.min("_id").alias("least")), "distinct")
    parts = connected(links(distinct.select("fp")))
    named = distinct.join(by_shuffle(parts), distinct["fp"] == parts["node"], "left") \
        .select("fp", F.coalesce("label", "fp").alias("label"), "least")
    return fps, named


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    shingle: int = 3, seed: int = 42) -> DataFrame:
    """(``id_col``, ``_th`` hash of the text, fp long, component_id) per row of ``df``.

    ``component_id`` is the least id reachable over links (fingerprints at two
    bits or fewer), itself included; null ids count for nothing in it.  Texts
    that are null, empty or without words have fingerprint zero and are linked
    like any other.  Equal fingerprints meet before the join, so groups of
    copies cost one row; repeated rows repeat; an empty table gives none.  Texts of any
    length count whole; other columns of ``df`` are not read, whatever their names.
    """
    fps, named = _components(df, text_col, id_col, shingle, seed)
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_fp = named.select("fp", "label").join(by_shuffle(least), "label").select("fp", "component_id")
    return fps.join(by_shuffle(of_fp), "fp").select(F.col("_id").alias(id_col), "_th", "fp", "component_id")


def keep_one(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3,
             seed: int = 42) -> DataFrame:
    """One row of ``df`` for each group of near-duplicates, with its own columns: that of the
    least id (rows without an id last), among equal ids that of the least hash of its text,
    then of all its columns.

    Groups are the components of linked fingerprints, so rows that share an id but not a
    group are different documents and both stay, and of copies without an id one stays.
    Texts without words are one group; an empty table gives none; columns of ``df`` keep
    their names, whatever they are.
    """
    cols = df.columns
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
                     F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_th"))
    fps, named = _components(df, text_col, id_col, shingle, seed)
    # a group shrinks to one row per fingerprint and task before its label brings it together
    order = F.struct(F.col("_id").isNull().alias("unnamed"), F.col("_id").alias("_id"), F.col("_th").alias("_th"))
    first = fps.groupBy("fp").agg(F.min(order).alias("first")).join(by_shuffle(named.select("fp", "label")), "fp") \
        .groupBy("label").agg(F.min("first").alias("first")).select("first.*")
    same = rows["_id"].eqNullSafe(first["_id"]) & (rows["_th"] == first["_th"])
    again = F.row_number().over(Window.partitionBy("_id", "_th").orderBy(F.xxhash64("_row")))
    return rows.join(by_shuffle(first), same, "left_semi").withColumn("_k", again).filter("_k = 1").select("_row.*")
