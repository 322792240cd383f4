"""File sources and sinks: CSV/Parquet conversion, codecs, partitioned layout,
pluggable keyed-store sink, file discovery and conversion reports."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Quotes inside values are doubled, so that values with quotes and line ends survive.
_CSV = {"header": True, "escape": '"'}


def write_csv(df: DataFrame, path: str) -> str:
    (df.write.mode("overwrite").options(**_CSV)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .csv(path))
    return path


def read_csv_inferred(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV with a header and inferred types (the one place we infer).  ``multi_line``
    is for values with line ends; such files are not split."""
    return (spark.read.options(**_CSV).option("inferSchema", True).option("multiLine", multi_line)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("preferDate", False).csv(path))


def write_parquet(df: DataFrame, path: str, codec: str = "snappy",
                  partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    w = df.write.mode(mode).option("compression", codec)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Project onto ``schema``: cast present columns, add absent ones as their
    default (or null)."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def find_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, sorted, through the file system of Spark's inputs."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(str(x.getPath()) for x in found or [])


def _csv_parts(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, header, many_lines, paths, csv_bytes) of every file or folder that fits ``pattern``
    and holds data: its first line, whether a value holds a line end (a line with an odd number of
    quotes) and its part files, from one scan of all of them as lines."""
    depth = len(pattern.rstrip("/").split("/")) if "://" not in pattern else len(pattern.rstrip("/").split("/")) - 2
    meta = F.col("_metadata")
    lines = spark.read.option("recursiveFileLookup", True).text(find_folders(spark, pattern)).select(
        "value", meta["file_path"].alias("path"), meta["file_size"].alias("bytes"),
        meta["file_block_start"].alias("at"), F.monotonically_increasing_id().alias("row"))
    odd = F.max((F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1)
    parts = lines.groupBy("path", "bytes").agg(
        F.min_by("value", F.struct("at", "row")).alias("header"), odd.alias("many_lines"))
    plain = F.regexp_replace("path", r"^[a-z]+:(//[^/]*)?/+", "/")
    name = F.regexp_replace(F.get(F.split(plain, "/"), F.lit(depth - 1)), r"\.csv$", "")
    return parts.withColumn("file", name).groupBy("file", "header").agg(
        F.max("many_lines").alias("many_lines"), F.collect_list("path").alias("paths"), F.sum("bytes").alias("csv_bytes"))


def convert_csv(spark: SparkSession, pattern: str, target: str, codec: str = "snappy") -> DataFrame:
    """Convert every CSV file or folder that fits ``pattern`` to Parquet below ``target`` and
    report one row each: rows, rows that did not parse, sizes, size saved %; one without data or whose parts
    disagree about their columns is a row with its error.  The last row, ``total``, sums the rest.

    Files with the same header are one table: read together (types inferred over all of them, a
    corrupt-record column for what does not fit), written in one job to
    ``target``/table=N/file=NAME, and counted from what was written.  So the jobs follow
    the number of different headers, not of files, and only files in which a value holds a
    line end are read unsplit.  The driver holds one line per file."""
    found = {}
    for path in find_folders(spark, pattern):
        found[path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")] = None
    begun = time.time()
    known = [r for r in _csv_parts(spark, pattern).collect()] if found else []
    for r in known:
        found[r["file"]] = [*(found.get(r["file"]) or []), r]
    errors = {f: "no data" if not rs else "parts with different columns" for f, rs in found.items()
              if not rs or len(rs) > 1}
    groups: dict[tuple, list] = {}
    for r in known:
        if r["file"] not in errors:
            groups.setdefault((r["header"], r["many_lines"]), []).append(r)
    done = None
    for i, ((_, many), rs) in enumerate(sorted(groups.items())):
        paths = [p for r in rs for p in r["paths"]]
        out = f"{target}/table={i}"
        one = _convert_table(spark, paths, {p: r["file"] for r in rs for p in r["paths"]}, out, many, codec)
        done = one if done is None else done.unionByName(one)
    lines = [(f, sum(r["csv_bytes"] for r in rs or [])) for f, rs in found.items()]
    told = spark.createDataFrame(lines, "file string, csv_bytes bigint")
    bad = spark.createDataFrame(list(errors.items()), "file string, error string")
    none = spark.createDataFrame([], "file string, rows bigint, corrupt bigint, parquet_bytes bigint")
    rep = told.join(done if done is not None else none, "file", "left").join(bad, "file", "left") \
        .fillna(0, ["rows", "corrupt", "parquet_bytes"]) \
        .withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed")) \
        .withColumn("seconds", F.lit(round(time.time() - begun, 3)))
    total = rep.agg(F.lit("total").alias("file"), F.lit("ok").alias("status"), *[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "corrupt", "csv_bytes", "parquet_bytes")],
        F.coalesce(F.max("seconds"), F.lit(0.0)).alias("seconds"), F.lit(None).cast("string").alias("error"))
    saved = F.round((1 - F.try_divide(F.col("parquet_bytes"), F.col("csv_bytes"))) * 100, 1)
    return rep.unionByName(total).withColumn("saved_pct", F.when(F.col("status") == "ok", saved)) \
        .select("file", "status", "rows", "corrupt", "csv_bytes", "parquet_bytes", "seconds", "error", "saved_pct")


_CORRUPT = "_corrupt_record"


def _convert_table(spark: SparkSession, paths: list[str], file_of: dict[str, str], out: str, many_lines: bool,
                   codec: str) -> DataFrame:
    """Files of one header as one partitioned table; (file, rows, corrupt, parquet_bytes) of what
    was written.  Rows that do not parse are kept beside the others, in ``_corrupt_record``."""
    schema = read_csv_inferred(spark, paths, many_lines).schema
    rows = (spark.read.options(**_CSV).schema(T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]))
            .option("multiLine", many_lines).option("columnNameOfCorruptRecord", _CORRUPT)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(paths))
    names = spark.createDataFrame(list(file_of.items()), "_path string, file string")
    named = rows.withColumn("_path", F.col("_metadata.file_path")).join(F.broadcast(names), "_path").drop("_path")
    named.write.mode("overwrite").option("compression", codec).partitionBy("file").parquet(out)
    back = spark.read.schema(named.schema).parquet(out).select("file", F.col(_CORRUPT).isNotNull().alias("bad"),
                                          F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b"))
    # one row per written file first, so that its size counts once
    per = back.groupBy("file", "p", "b").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    return per.groupBy(F.col("file").cast("string").alias("file")).agg(
        F.sum("n").alias("rows"), F.sum("bad").alias("corrupt"), F.sum("b").alias("parquet_bytes"))


def save_to_store(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                  options: dict | None = None) -> None:
    """Pluggable sink: Parquet by default; any DataFrameWriter format (a key-value
    store connector, when present on the classpath) takes the same call."""
    w = df.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
