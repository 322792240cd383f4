"""A keyed store in buckets: lookups and upserts that never shuffle the stored side.

A store is a table bucketed and sorted by its key, in as many buckets as the session
shuffles into (or more).  A join on the key then reads bucket by bucket: only the requests
or the batch are exchanged.  An upsert writes the next version beside the old one, whose
readers are not disturbed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    return max(buckets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Names and types in order; whether nulls are allowed does not count."""
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType, key: str,
                     buckets: int | None = None) -> DataFrame:
    """The store ``name``, made empty with ``schema`` where there is none; a store of another
    schema is refused."""
    if spark.catalog.tableExists(name):
        found = spark.table(name)
        if not same_columns(found.schema, schema):
            raise ValueError(f"{name} holds {found.schema.simpleString()}, not {schema.simpleString()}")
        return found
    return write(spark.createDataFrame([], schema), name, key, buckets)


def write(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` as the bucketed table ``name`` below the shared folder: one sorted file a bucket."""
    spark = df.sparkSession
    n = _buckets(spark, buckets)
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key).mode("overwrite")
     .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(name))
    return spark.table(name)


def version_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def upsert(store: DataFrame, batch: DataFrame, name: str, key: str, order: Sequence[str],
           buckets: int | None = None) -> DataFrame:
    """The next version of ``store``, as the table ``name``: rows of ``batch`` (one a key) win over
    stored ones that are not newer by ``order``.  The stored side is read in its buckets and
    merged with the batch's; its rows are not exchanged."""
    cols = store.columns
    spark = store.sparkSession
    n = _buckets(spark, buckets)
    row = lambda p: F.struct(*[F.col(f"{p}.{c}").alias(c) for c in cols])
    old, new = store.alias("old"), batch.select(*cols).alias("new")
    both = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    rank = lambda p: F.struct(*[F.col(f"{p}.{c}") for c in order])
    wins = F.col(f"old.{key}").isNull() | (F.col(f"new.{key}").isNotNull() & (rank("new") >= rank("old")))
    merged = both.select(F.when(wins, row("new")).otherwise(row("old")).alias("r")).select("r.*")
    (merged.write.bucketBy(n, key).sortBy(key).mode("overwrite").option("path", scratch_path(spark, name))
     .format("parquet").saveAsTable(name))
    return spark.table(name)
