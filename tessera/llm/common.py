"""Column helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Separators between words of letters, digits and non-ASCII characters.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Separators between words of anything but ASCII white space.
WHITE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case.  ``lower`` also changes other letters, which stay
    non-ASCII, except for the two whose lower case is ASCII: these are replaced
    by another non-ASCII letter first."""
    return F.lower(F.replace(F.replace(c, F.lit("\u212a"), F.lit("\u00e5")),
                             F.lit("\u0130"), F.lit("\u00e5")))


def words(text: Column, separators: str) -> Column:
    """The words of a text; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def keyed(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """``_id`` and ``_th``: a document's id and text hash.  Rows that repeat
    both are the same document; rows that share the id alone are not."""
    return df.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text)).alias("_th"),
                     F.coalesce(F.col(text), F.lit("")).alias("_text"))


def on_document(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Join on (``_id``, ``_th``), null ids included."""
    b = b.withColumnRenamed("_id", "_id2").withColumnRenamed("_th", "_th2")
    cond = (a["_th"] == b["_th2"]) & a["_id"].eqNullSafe(b["_id2"])
    return a.join(b, cond, how).drop("_id2", "_th2")


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: both sides are shuffled and sorted.
    Spark sizes a saved table by its compressed files and counts no rows that an explode
    makes, so it would send a large side to the driver and to every task."""
    return df.hint("merge")


def save(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it again: cuts
    the lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def groups_of_bytes(batches: Iterator[pa.RecordBatch], column: str,
                    limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive slices of record batches whose ``column`` holds about
    ``limit`` bytes in all; one longer value stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lens = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
        start = 0
        for i, n in enumerate(lens):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield held
                held, size, start = [], 0, i
            size += n
        if start < len(lens):
            held.append(batch.slice(start))
    if held:
        yield held
