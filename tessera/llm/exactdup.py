"""Suffix-array dedup by a run-length index.

A string of ``window`` bytes that starts at two or more places of the corpus is
repeated, and every byte it covers goes.  Work is dealt out so that equal windows
meet (``segments``): texts are cut into segments of neighbouring windows with one
minimizer, and only segments whose minimizer occurs twice go on.  Segments that
are equal throughout are counted as one.  What differs but shares a minimizer is
indexed in blocks of whole minimizers (``runindex``): the run-compressed
Burrows-Wheeler transform, sampled at run ends, gives the matching statistics of
all segments, and matches of ``window`` bytes are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import groups_of_bytes, save
from tessera.llm.runindex import long_matches
from tessera.llm.segments import segments

_GROUP = 96 << 10  # bytes of text hashed at once: fits a core's cache
_BLOCK = 2 << 20  # bytes of segments indexed at once, and one more minimizer of as many at most
_HOT = 1000  # keys with over one part in so many of all rows are salted
_SALTS = 64


def _documents(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``_id``, ``_mark`` (the text's hash, to tell rows with one id apart), ``_text``."""
    text = F.col(f"`{text_col}`")
    return df.select(F.col(f"`{id_col}`").alias("_id"),
                     F.xxhash64(text).alias("_mark"),
                     F.coalesce(text, F.lit("")).alias("_text"))


def _place(start: np.ndarray, again: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First window, ``again`` and number of windows in one long."""
    return start.astype(np.int64) << 32 | again.astype(np.int64) << 8 | n.astype(np.int64)


def _start(at: Column) -> Column:
    return F.shiftright(at, 32)


def _again(at: Column) -> Column:
    return F.shiftright(at, 8).bitwiseAND(F.lit(1))


def _count(at: Column) -> Column:
    return at.bitwiseAND(F.lit(0xFF))


def cut(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, dig, ``_id``, ``_mark``, at): the segments of all texts; ``key`` is the least hash,
    ``dig`` a hash of the segment's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of_bytes(batches, "_text", _GROUP):
            b = pa.Table.from_batches(group).combine_chunks()
            raw = [t.encode() for t in b.column("_text").to_pylist()]
            data = b"".join(raw)
            ends = np.cumsum([len(x) for x in raw])
            begins = ends - [len(x) for x in raw]
            key, first, n, again = segments(np.frombuffer(data, np.uint8), begins, ends, window,
                                              gram)
            if not len(key):
                continue
            doc = np.searchsorted(ends, first, side="right")
            dig = np.array([xxhash.xxh3_64_intdigest(data[s:e]) for s, e in
                            zip(first.tolist(), (first + n + window - 1).tolist(), strict=True)],
                           np.uint64)
            doc_at = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array(dig.view(np.int64)),
                b.column("_id").combine_chunks().take(doc_at),
                b.column("_mark").combine_chunks().take(doc_at),
                pa.array(_place(first - begins[doc], again, n))], ["key", "dig", "_id", "_mark", "at"])

    kind = dict(docs.dtypes)["_id"]
    return docs.mapInArrow(run, f"key bigint, dig bigint, _id {kind}, _mark bigint, at bigint")


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` (``_id``, ``_mark`` and a list per document) beside their texts."""
    r = rows.withColumnRenamed("_id", "_id2").withColumnRenamed("_mark", "_mark2")
    return docs.join(r, docs["_id"].eqNullSafe(r["_id2"])
                     & (docs["_mark"] == r["_mark2"]), "left").drop("_id2", "_mark2")


def _contents(chosen: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """``chosen`` segments (key, n, ``_id``, ``_mark``, at) with their bytes: one row per
    document meets its text, and the segments are cut out of it."""
    per_doc = chosen.groupBy("_id", "_mark") \
        .agg(F.collect_list(F.struct("key", "n", "at")).alias("list"))
    cut_out = F.substring(F.col("_text").cast("binary"), (_start(F.col("at")) + 1).cast("int"),
                          (_count(F.col("at")) + (window - 1)).cast("int"))
    return (_with_text(per_doc, docs).filter("list IS NOT NULL")
            .select("_id", "_mark", "_text", F.inline("list"))
            .select("key", "n", "_id", "_mark", "at", cut_out.alias("bytes")))


def _matched(batches: Iterator[pa.RecordBatch], window: int,
             kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Spans [from, to) of windows of single segments found in another segment;
    rows come in order of their key."""
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        found = long_matches([r[5] for r in held], window)
        rows = [(r[2], r[3], (r[4] >> 32) + lo, (r[4] >> 32) + hi)
                for r, spans in zip(held, found, strict=True) if r[1] == 1 for lo, hi in spans]
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:]]],
            ["_id", "_mark", "lo", "hi"])

    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if size > _BLOCK and row[0] != held[-1][0]:
                yield flush()
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield flush()


def _crowded(rows: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """Repeated windows (as spans) of segments whose minimizer has too many
    different segments for one block: counted window by window, by two hashes
    of its bytes, so that no key gathers unequal rows."""
    spread = (_contents(rows.withColumn("n", F.lit(0)), docs, window)
              .select("_id", "_mark", "at", "bytes",
                      F.explode(F.sequence(F.lit(0), (_count(F.col("at")) - 1).cast("int"))).alias("w"))
              .withColumn("own", F.substring("bytes", F.col("w") + 1, F.lit(window)))
              .select("_id", "_mark",
                      (_start(F.col("at")) + F.col("w")).alias("lo"),
                      F.xxhash64("own").alias("a"), F.xxhash64(F.lit(1), "own").alias("b")))
    many = spread.groupBy("a", "b").count().filter("count > 1")
    return spread.join(many, ["a", "b"], "left_semi") \
        .select("_id", "_mark", "lo", (F.col("lo") + 1).alias("hi"))


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for group in groups_of_bytes(batches, "_text", 4 << 20):
        b = pa.Table.from_batches(group)
        cols: list[list] = [[], [], []]
        for text, found in zip(b.column("_text"), b.column("found"), strict=True):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            gone = np.zeros(len(raw) + 1, np.int32)
            if found.is_valid:
                v = found.values
                np.add.at(gone, v.field("lo").to_numpy(), 1)
                np.add.at(gone, v.field("hi").to_numpy() + (window - 1), -1)
            gone = np.cumsum(gone[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            cols[0].append(len(raw))
            cols[1].append([{"start": s, "end": e} for s, e in
                            zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            cols[2].append(raw[~gone].tobytes())
        yield from pa.table({"_id": b.column("_id"), "n_bytes": pa.array(cols[0], pa.int64()),
                             "removed": pa.array(cols[1], pa.list_(span)),
                             "kept": pa.array(cols[2], pa.binary())}).combine_chunks().to_batches()


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   window: int = 200, gram: int = 64, crowd: int | None = None) -> DataFrame:
    """(``id_col``, n_bytes, removed, kept) per row of ``df``: the byte spans covered
    by ``window``-byte strings that start at two places or more, and the bytes
    that are left.

    A null text is empty; texts shorter than ``window`` keep everything.  Repeated
    rows are copies of each other and lose all bytes that their windows cover.
    An empty table gives an empty result.  A minimizer with more than ``crowd``
    different segments (a passage in very many settings; by default what may
    exceed ``_BLOCK``) is not gathered in one block: its windows are counted one
    by one, with the same result.
    """
    if not 0 < window - gram + 1 < 256 or gram < 8:
        raise ValueError("a window must have 1 to 255 substrings of 8 bytes or more")
    if crowd is None:  # the longest segment has window - gram + 1 windows
        crowd = max(1, _BLOCK // (2 * window - gram))
    docs = _documents(df, text_col, id_col)
    spans = repeated_windows(docs, window, gram, crowd)
    per_doc = spans.groupBy("_id", "_mark").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    rows = _with_text(per_doc, docs).select("_id", "_text", "found")
    kind = dict(docs.dtypes)["_id"]
    return rows.mapInArrow(
        lambda it: _remove(it, window),
        f"_id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    ).withColumnRenamed("_id", id_col)


def _semi(rows: DataFrame, counted: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` whose ``on`` stands in ``counted`` (on, n; the n add up to ``total``
    or less).  A key with over a thousandth of ``total`` is dealt over many tasks;
    there are under a thousand of these, whatever the input, so they are broadcast."""
    hot = F.broadcast(counted.filter(F.col("n") * _HOT > total).select(*on, F.lit(True).alias("_hot")))
    deal = F.when(F.col("_hot"), F.pmod(F.xxhash64("_id", "_mark", "at"), F.lit(_SALTS)).cast("int")).otherwise(0)
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = counted.join(hot, on, "left").select(*on, F.explode(all_salts).alias("_salt"))
    return rows.join(hot, on, "left").withColumn("_salt", deal) \
        .join(keys, [*on, "_salt"], "left_semi").drop("_hot", "_salt")


def repeated_windows(docs: DataFrame, window: int, gram: int, crowd: int) -> DataFrame:
    """(``_id``, ``_mark``, lo, hi): spans of repeated windows, by their first byte."""
    all_ = cut(docs, window, gram)
    # a segment may also repeat inside itself
    often = save(all_.groupBy("key").agg(F.sum(1 + _again(F.col("at"))).alias("n"))
                 .filter("n > 1"), "often")
    total = often.agg(F.sum("n")).first()[0] or 0
    # small beside the texts, and read three times
    again = save(_semi(all_, often, ["key"], total), "segments")
    distinct = again.groupBy("key", "dig").agg(F.count("*").alias("n"),
                                               F.min(F.struct("_id", "_mark", "at")).alias("rep"))
    state = save(distinct.groupBy("key").agg(F.count("*").alias("kinds"),
                                             F.sum(F.when(F.col("n") == 1, 1)).alias("single"),
                                             F.max(_again(F.col("rep.at"))).alias("again"))
                 .filter("single > 0 AND (kinds > 1 OR again = 1)"), "minimizers")
    whole = _semi(again, distinct.filter("n > 1"), ["key", "dig"], total).select(
        "_id", "_mark", _start(F.col("at")).alias("lo"),
        (_start(F.col("at")) + _count(F.col("at"))).alias("hi"))
    few = distinct.join(state.filter(F.col("kinds") <= crowd), "key", "left_semi") \
        .select("key", "n", "rep.*")
    kind = docs.schema["_id"].dataType
    arrow = to_arrow_type(kind)
    differing = _contents(few, docs, window).repartition("key").sortWithinPartitions("key") \
        .mapInArrow(lambda it: _matched(it, window, arrow),
                    f"_id {kind.simpleString()}, _mark bigint, lo bigint, hi bigint")
    spans = whole.unionByName(differing)
    crowded = state.filter(F.col("kinds") > crowd)
    if not crowded.isEmpty():
        rows = again.join(crowded, "key", "left_semi").select("key", "_id", "_mark", "at")
        spans = spans.unionByName(_crowded(rows, docs, window))
    return spans
