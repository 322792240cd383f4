"""Reading the input tables with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.schemas import TABLE_SCHEMAS


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def pin_utc(spark: SparkSession) -> None:
    """The files hold zone-less timestamps; all time arithmetic assumes UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the declared schema; Catalyst prunes columns and
    pushes filters into this scan."""
    pin_utc(spark)
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``Tables(spark, d).events`` is a scan of events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        pin_utc(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_SCHEMAS:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row work enough tasks: when the scan yields fewer
    partitions than the session's parallelism (one large row group, say),
    hash-partition by ``key`` (deterministic under retries, and later
    aggregations/windows on that key reuse it).  A scan that is already split
    into many partitions, as on a cluster, is left alone."""
    spark = df.sparkSession
    target = min_partitions or max(spark.sparkContext.defaultParallelism,
                                   int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    try:
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001  (no RDD access, e.g. a remote session)
        pass
    return df.repartition(target, key) if key else df.repartition(target)
