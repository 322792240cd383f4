"""WARC archives: monolithic gzip streams, normalised to one member per record.

``write_archives`` lets Spark write records as gzip text files, each a single
stream.  ``normalise`` inflates every file's stream once, cuts it into records,
compresses each as a member of its own, and writes a sidecar index with the
offset and length of every member.  All files go through Spark's readers and
writers, so any store that Spark reaches will do.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import save

_END = "\r\n\r\n"
_CHUNK = 1 << 20
_SALTS = 64
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(h: Column) -> Column:
    """Base32 of 40 hex digits (a SHA-1), without padding."""
    signs = F.array(*map(F.lit, _BASE32))
    out = []
    for at in range(0, 40, 10):
        v = F.conv(F.substring(h, at + 1, 10), 16, 10).cast("long")
        out += [F.get(signs, F.shiftright(v, s).bitwiseAND(F.lit(31)).cast("int"))
                for s in range(35, -1, -5)]
    return F.concat(*out)


def _record_id(id_: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), F.coalesce(id_.cast("string"), F.lit("null"))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        F.lit(">"))


def _with_last(rows: DataFrame, min_bytes: int, hot_part: int) -> DataFrame:
    """``rows`` with ``_last``, the largest id among equal payloads that stand twice or
    more, else null.  A payload with over one part in ``hot_part`` of these rows is dealt
    over many tasks; there are under ``hot_part`` such, whatever the input, so they
    are broadcast."""
    again = save(rows.filter(F.col("_n") >= min_bytes).groupBy("_sha", "_n")
                 .agg(F.max("_id").alias("_last"), F.count("*").alias("_k")).filter("_k > 1"), "payloads")
    total = again.agg(F.sum("_k")).first()[0] or 0
    is_hot = F.col("_k") * hot_part > total
    hot = F.broadcast(again.filter(is_hot).select("_sha", "_n", F.col("_last").alias("_hot_last"),
                                                  F.lit(True).alias("_hot")))
    rest = again.filter(~is_hot).select("_sha", "_n", "_last", F.lit(0).alias("_salt"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_id", "_url"), F.lit(_SALTS)).cast("int") + 1).otherwise(0)
    return (rows.join(hot, ["_sha", "_n"], "left").withColumn("_salt", salt)
            .join(rest, ["_sha", "_n", "_salt"], "left")
            .withColumn("_last", F.coalesce("_hot_last", "_last")).drop("_hot", "_hot_last", "_salt"))


def records(df: DataFrame, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", min_bytes: int = 0,
            date: str = "1970-01-01T00:00:00Z", hot_part: int = 1000) -> DataFrame:
    """One WARC record per row of ``df`` as text (column ``value``), without the
    two line ends that follow a record.

    Of the rows with equal payloads of at least ``min_bytes`` bytes the one with
    the largest id is a response and the others revisit it; smaller payloads are
    all responses.  A null payload is empty; a null id is never the largest
    unless all are null; rows that repeat the largest id are responses too.

    Payloads that stand alone need no partner; the table of the others, without
    bodies, is written to the shared folder first.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url"),
                     F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("_body"))
    rows = rows.withColumn("_sha", F.sha1(F.col("_body").cast("binary"))) \
        .withColumn("_n", F.octet_length("_body"))
    r = _with_last(rows, min_bytes, hot_part)
    first = F.col("_last").isNull() | F.coalesce(F.col("_id") == F.col("_last"), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("_n").cast("string"), F.lit(_END))
    block = F.when(first, F.concat(http, F.col("_body"))).otherwise(http)
    url = F.regexp_replace(F.col("_url"), r"[\x00-\x20\x7F]", "%20")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")),
                          F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(first, "response").otherwise("revisit")),
        line("WARC-Record-ID", _record_id(F.col("_id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("_sha")))),
        line("WARC-Profile", F.when(~first, "http://netpreserve.org/warc/1.1/revisit/"
                                            "identical-payload-digest")),
        line("WARC-Refers-To", F.when(~first, _record_id(F.col("_last")))),
        line("X-Page-ID", F.col("_id")), line("X-Refers-To-Page", F.when(~first, F.col("_last"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)), F.lit("\r\n"))
    return r.select(F.concat(head, block).alias("value"))


def write_archives(recs: DataFrame, path: str, per_file: int = 20_000) -> None:
    """Each task writes gzip streams of up to ``per_file`` records: a reader takes a whole archive
    as one value, so archives must stay below 2 GB."""
    recs.write.option("compression", "gzip").option("lineSep", _END) \
        .option("maxRecordsPerFile", per_file).text(path)


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or many, piece by piece (zero bytes between
    members are padding); a member without its end is an error."""
    at, inflate = 0, None
    while at < len(content):
        if inflate is None:
            if content[at] == 0:
                at += 1
                continue
            inflate = zlib.decompressobj(31)
        piece = content[at:at + _CHUNK]
        out = inflate.decompress(piece)
        at += len(piece) - len(inflate.unused_data)
        if inflate.eof:
            inflate = None
        yield out
    if inflate is not None:
        raise ValueError("a gzip stream is cut off")


def _cut(content: bytes) -> Iterator[bytes]:
    """The records of a gzip file, inflated piece by piece."""
    held = bytearray()
    pieces = _inflated(content)
    need, ended = 0, False

    def more() -> bool:
        for p in pieces:
            held.extend(p)
            return True
        return False

    while True:
        while (head := held.find(_END.encode())) < 0 and not ended:
            ended = not more()
        if head < 0:
            if held.strip():
                raise ValueError("a record has no header")
            return
        length = re.search(rb"(?i)\r\nContent-Length: *(\d+)", held[:head])
        if not held.startswith(b"WARC/") or not length:
            raise ValueError("a record has no length")
        need = head + 8 + int(length[1])
        while len(held) < need and not ended:
            ended = not more()
        if len(held) < need:
            raise ValueError("a record is cut off")
        yield bytes(held[:need])
        del held[:need]


def _headers(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = record.partition(_END.encode())
    fields = (x.partition(": ") for x in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, _, v in fields}, block[:-4]


def _archive_name(path: str) -> str:
    """A name for each file: its part number where it has one, and a digest of its path."""
    m = re.search(r"part-(\d+)-.*?(?:-c(\d+))?\.[^/]*$", path)
    name = f"{m[1]}-{m[2] or '000'}" if m else re.sub(r"\W+", "-", path.rsplit("/", 1)[-1])[:80]
    return f"{name}-{hashlib.sha1(path.encode()).hexdigest()[:16]}"


_EMPTY_MEMBER = gzip.compress(b"", 6, mtime=0)


def _own_member(record: bytes) -> bytes:
    """The record as a gzip member that ends with a zero byte, as the size of less than 16 MB
    does; a larger one is followed by an empty member."""
    member = gzip.compress(record, 6, mtime=0)
    return member if member[-1] == 0 else member + _EMPTY_MEMBER


def _own_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("kind", pa.string()), ("archive", pa.string()), ("seq", pa.int64()),
                        ("value", pa.binary())])
    for b in batches:
        for path, content in zip(b.column("path"), b.column("content"), strict=True):
            name, at, seq, index, out, size = _archive_name(path.as_py()), 0, 0, [], [], 0
            for record in _cut(content.as_py()):
                member = _own_member(record)
                fields, _ = _headers(record)
                index.append(json.dumps({
                    "offset": at, "length": len(member), "id": fields.get("warc-record-id"),
                    "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"),
                    "digest": fields.get("warc-payload-digest")}))
                out.append(("warc", name, seq, member))
                at += len(member)
                seq, size = seq + 1, size + len(member)
                if size > _CHUNK:
                    yield _rows(out, schema)
                    out, size = [], 0
            index.append("")
            out.append(("index", name, seq, _own_member("\n".join(index).encode())))
            yield _rows(out, schema)


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    kind, name, seq, value = zip(*out, strict=True)
    ended = [v[:-1] for v in value]  # the writer ends each value with a zero byte: its own last one
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(name), pa.array(seq, pa.int64()),
                                       pa.array(ended, pa.binary())], schema=schema)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite every archive below ``source``, of one gzip stream or of several members: one
    gzip member per record below ``target``/kind=warc/archive=NAME, and its index, JSON lines in
    a gzip file, below ``target``/kind=index/archive=NAME.  NAME holds a digest of the
    archive's path, so files of one name in several folders or writes stay apart.  A
    stream or record that is cut off is an error; an archive without records has an empty
    index; archives of 2 GB or more cannot be read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source) \
        .select("path", "content")
    members = files.mapInArrow(_own_members,
                               "kind string, archive string, seq bigint, value binary")
    members.sortWithinPartitions("kind", "archive", "seq") \
        .select("kind", "archive", F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", "\x00").partitionBy("kind", "archive").text(target)


def member(content: bytes, offset: int, length: int) -> bytes:
    """One record of a normalised archive, by its entry in the index."""
    return gzip.decompress(content[offset:offset + length])


def _members(content: bytes) -> Iterator[bytes]:
    """The records of a normalised archive (empty members are none)."""
    at = 0
    view = memoryview(content)
    while at < len(content):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof and at < len(content):
            piece = view[at:at + (1 << 16)]
            out.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        if not inflate.eof:
            raise ValueError("a member is cut off")
        if record := b"".join(out):
            yield record


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for content in b.column("content"):
            out = []
            for record in _members(content.as_py()):
                f, block = _headers(record)
                http, _, payload = block.partition(_END.encode())
                if f["warc-type"] == "response":
                    n = len(payload)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                else:
                    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = f["warc-payload-digest"].removeprefix("sha1:")
                out.append((f.get("x-page-id"), n, digest, f["warc-type"],
                            f.get("x-refers-to-page")))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i == 1 else pa.string()) for i, c in enumerate(cols)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, target: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), ids as
    strings: one row per record of the normalised archives.  The digest and size
    of a response are taken of the payload as read."""
    files = spark.read.format("binaryFile").load(target) \
        .filter(F.col("path").contains("/kind=warc/")).select("content")
    return files.mapInArrow(_read, "page_id string, payload_bytes bigint, payload_digest string, "
                                   "record_type string, refers_to string")
