"""Exact nearest vectors through 8-bit codes.

Every unit vector is kept a second time as one signed byte per dimension, with its scale
and the length of its rounding error.  The dot product with a unit query differs from
that of the code by no more than this length, so the codes (an eighth of the bytes)
are scanned first, as matrix products, and only the pairs whose upper bound reaches
the query's k-th lower bound are scored from the vectors themselves: recall stays 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.similar import dot, unit

ROWS = 2048  # vectors in a block of codes
QUERIES = 1024  # queries in a block
_SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def encode(items: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(ids, codes, scales, errors): blocks of up to ``ROWS`` vectors; null, zero and
    non-finite vectors have no direction and are left out."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), unit(vec).alias("v")) \
        .where("v IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x))")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                b = batch.slice(at, ROWS)
                v = _matrix(b.column("v"))
                scale = np.abs(v).max(axis=1) / 127
                code = np.rint(v / scale[:, None]).astype(np.int8)
                error = np.sqrt(((v - code * scale[:, None]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([b.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([code.tobytes()]),
                    pa.array([scale.tobytes()]), pa.array([error.tobytes()])], ["ids", "codes", "scales", "errors"])

    return rows.mapInArrow(run, "ids array<bigint>, codes binary, scales binary, errors binary")


def _bounds(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(qid, id, lo, hi) of the pairs that may be among a query's k best of this task."""
    low: dict[bytes, np.ndarray] = {}  # per block of queries, each one's k best lower bounds so far
    for batch in batches:
        for row in batch.to_pylist():
            qids = np.array([x["qid"] for x in row["qs"]], np.int64)
            if not len(qids):
                continue
            q = np.array([x["qv"] for x in row["qs"]], np.float64)
            ids = np.array(row["ids"], np.int64)
            code = np.frombuffer(row["codes"], np.int8).reshape(len(ids), -1).astype(np.float64)
            sim = (code @ q.T) * np.frombuffer(row["scales"])[:, None]
            error = np.frombuffer(row["errors"])[:, None]
            own = ids[:, None] == qids[None, :]
            lo = np.where(own, -np.inf, sim - error)
            key = qids.tobytes()
            both = np.concatenate([low.get(key, np.full((k, len(qids)), -np.inf)), lo])
            low[key] = np.partition(both, len(both) - k, axis=0)[len(both) - k:]
            i, j = np.nonzero((sim + error >= low[key].min(axis=0)[None, :] - _SLACK) & ~own)
            yield pa.RecordBatch.from_arrays([
                pa.array(qids[j]), pa.array(ids[i]), pa.array(lo[i, j]), pa.array((sim + error)[i, j])],
                ["qid", "id", "lo", "hi"])


def candidates(index: DataFrame, queries: DataFrame, query_id: str, vec: str, k: int) -> DataFrame:
    """(qid, id): the pairs that may be among the k best of a query of a stated set, the query's own id
    left out.  Queries go out in blocks of about ``QUERIES``, each one array value beside
    every block of codes, and each one more scan of the codes."""
    q = queries.select(F.struct(F.col(query_id).cast("long").alias("qid"), unit(vec).alias("qv")).alias("q")) \
        .where("q.qv IS NOT NULL AND size(q.qv) > 0 AND NOT exists(q.qv, x -> x IS NULL OR isnan(x))")
    blocks = max(1, -(-queries.count() // QUERIES))
    out = None
    for b in range(blocks):
        own = q.where(F.pmod(F.xxhash64("q.qid"), F.lit(blocks)) == b).agg(F.sort_array(F.collect_list("q")).alias("qs"))
        part = index.withColumn("qs", own.scalar()) \
            .mapInArrow(lambda it: _bounds(it, k), "qid bigint, id bigint, lo double, hi double")
        out = part if out is None else out.unionByName(part)
    best = Window.partitionBy("qid").orderBy(F.col("lo").desc(), "id")
    floor = out.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k) \
        .groupBy("qid").agg(F.min("lo").alias("floor"))
    return out.join(floor, "qid").where(F.col("hi") >= F.col("floor") - _SLACK).select("qid", "id")


def nearest(items: DataFrame, index: DataFrame, queries: DataFrame, item_id: str, vec: str, k: int) -> DataFrame:
    """(``item_id``, rank, neighbor, similarity): the k nearest items of each query item, as
    ``similar.nearest`` finds them; only ``candidates`` are scored from their vectors."""
    pairs = candidates(index, queries, item_id, vec, k)
    v = items.select(F.col(item_id).cast("long").alias("id"), unit(vec).alias("v"))
    scored = pairs.join(v, "id").join(queries.select(F.col(item_id).cast("long").alias("qid"), unit(vec).alias("qv")), "qid") \
        .select("qid", "id", dot(F.col("qv"), F.col("v")).alias("similarity"))
    w = Window.partitionBy("qid").orderBy(F.round("similarity", 10).desc(), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select(F.col("qid").alias(item_id), "rank", F.col("id").alias("neighbor"), "similarity")
