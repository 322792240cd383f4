"""The WARC normaliser on archives that it did not write."""

import gzip
import io
import json
import os
import random

import pytest

from tessera.llm import warc
from tessera.session import scratch_path


def record(i, body):
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{i}>\r\nX-Page-ID: {i}\r\n"
            f"Content-Length: {len(body) + 19}\r\n\r\n").encode()
    return head + b"HTTP/1.1 200 OK\r\n\r\n" + body + b"\r\n\r\n"


def local(path):
    return path.removeprefix("file:")


def put(folder, name, content):
    os.makedirs(local(folder), exist_ok=True)
    with open(os.path.join(local(folder), name), "wb") as f:
        f.write(content)


def archives(target):
    """(records by a standard reader of all members, records by the index) of each archive."""
    out = []
    top = local(target)
    for name in sorted(os.listdir(f"{top}/kind=warc")):
        data = b"".join(open(f"{top}/kind=warc/{name}/{f}", "rb").read() for f in
                        sorted(os.listdir(f"{top}/kind=warc/{name}")) if f.startswith("part-"))
        files = [f for f in os.listdir(f"{top}/kind=index/{name}") if f.startswith("part-")]
        assert len(files) == 1
        index = [json.loads(x) for x in gzip.open(f"{top}/kind=index/{name}/{files[0]}").read().splitlines()]
        out.append((gzip.GzipFile(fileobj=io.BytesIO(data)).read(),
                    [warc.member(data, x["offset"], x["length"]) for x in index]))
    return out


def test_many_members_mixed_files_and_large_records(spark):
    rnd = random.Random(2)
    recs = [record(i, bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 5, 3000])))) for i in range(30)]
    large = record(99, b"x" * (17 << 20))  # over 16 MB: its size does not end with a zero byte
    src, target = scratch_path(spark, "any"), scratch_path(spark, "any-out")
    put(src, "one.warc.gz", gzip.compress(b"".join(recs[:10])))
    put(src, "each.warc.gz", b"".join(map(gzip.compress, recs[10:20])))
    cut = len(recs[20]) // 2  # members that do not end where records do
    put(src, "mixed.warc.gz", gzip.compress(recs[20][:cut]) + gzip.compress(recs[20][cut:] + recs[21])
        + gzip.compress(b"") + gzip.compress(recs[22] + large + recs[23]))
    put(src, "empty.warc.gz", gzip.compress(b""))
    warc.normalise(spark, src, target)
    want = [recs[:10], recs[10:20], [*recs[20:23], large, recs[23]]]
    got = archives(target)
    assert sorted(len(i) for _, i in got) == sorted(map(len, want))
    for whole, by_index in got:
        assert b"".join(by_index) == whole and by_index in want
    assert warc.read_archives(spark, target).count() == sum(map(len, want))


@pytest.mark.parametrize("broken", [
    lambda r: gzip.compress(r)[:-8], lambda r: gzip.compress(r)[:-20], lambda r: gzip.compress(r) + gzip.compress(r)[:30],
    lambda r: gzip.compress(r[:-1]), lambda r: gzip.compress(r) + b"junk"])
def test_cut_off_archives_are_errors(broken):
    with pytest.raises(Exception):
        list(warc._cut(broken(record(1, b"body" * 100))))


def test_two_writes_in_one_folder_stay_apart(spark):
    src, target = scratch_path(spark, "twice"), scratch_path(spark, "twice-out")
    for at in (0, 10):
        rows = spark.createDataFrame([(at + i, f"http://a/{i}", f"<p>{at + i}</p>") for i in range(10)],
                                     "page_id bigint, url string, html string").coalesce(1)
        warc.records(rows).coalesce(1).write.mode("append").option("compression", "gzip") \
            .option("lineSep", "\r\n\r\n").text(src)
    warc.normalise(spark, src, target)
    got = archives(target)
    assert [len(i) for _, i in got] == [10, 10]
    assert {r["page_id"] for r in warc.read_archives(spark, target).collect()} == {str(i) for i in range(20)}
