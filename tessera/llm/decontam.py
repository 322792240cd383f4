"""Benchmark decontamination by suffix arrays over the training texts.

Documents are shards of words; each shard sorts its suffixes (their first
``window`` words, as codes of the benchmark's vocabulary), and every suffix of
every benchmark item is found in it by binary search: the range of equal ones
gives the locations, and the match is followed on to its longest.  Suffixes
whose first words begin no benchmark suffix can match none and are not sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups_of_bytes, on_document

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))


def split_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, A-Z in lower case."""
    return (text or "").encode().translate(_TABLE).split()


def _compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 per row of two matrices of equal shape, the first column first."""
    out = np.zeros(len(a), np.int8)
    for c in range(a.shape[1]):
        open_ = out == 0
        out[open_] = np.sign((a[open_, c] > b[open_, c]).astype(np.int8)
                             - (a[open_, c] < b[open_, c]).astype(np.int8))
    return out


def _search(sorted_keys: np.ndarray, keys: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all ``keys`` at once."""
    lo = np.zeros(len(keys), np.int64)
    hi = np.full(len(keys), len(sorted_keys), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        c = _compare(sorted_keys[mid], keys[open_])
        go = c <= 0 if right else c < 0
        lo[open_[go]] = mid[go] + 1
        hi[open_[~go]] = mid[~go]
    return lo


class Benchmark:
    """Items as word codes, and their distinct windows with the items that hold each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        code = self.vocabulary.setdefault
        found: dict[tuple, int] = {}
        of: dict[int, set[str]] = {}
        self.at: list[tuple[int, int]] = []  # one place of each window: item, word
        for k, (item, text) in enumerate(items):
            ids = [code(w, len(self.vocabulary)) for w in split_words(text)]
            self.words.append(np.array([*ids, -2], np.int32))
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                w = found.setdefault(tuple(ids[i:i + n]), len(found))
                if w == len(self.at):
                    self.at.append((k, i))
                of.setdefault(w, set()).add(item)
        windows = list(found)
        self.items = [sorted(of[w]) for w in range(len(windows))]
        self.lens = np.array([len(w) for w in windows], np.int64)
        # codes from 1; 0 sorts before all words and the top value after them
        self.bits = 16 if len(self.vocabulary) < (1 << 16) - 2 else 32
        self.top = (1 << self.bits) - 1
        rows = np.zeros((len(windows), window), np.int64)
        for i, w in enumerate(windows):
            rows[i, :len(w)] = np.array(w) + 1
        pad = np.arange(window) >= self.lens[:, None]
        self.low = self.pack(rows)
        self.high = self.pack(np.where(pad, self.top, rows))
        self.seeds = {}
        for n in sorted({min(3, int(x)) for x in self.lens}):
            own = rows[np.minimum(self.lens, 3) == n, :n]
            self.seeds[n] = np.unique(self._seed([own[:, c] for c in range(n)]))

    def _seed(self, columns: list[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64)
        return key ^ (key >> np.uint64(29))

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """Rows of codes as a few 64-bit columns that compare like the rows."""
        per = 64 // self.bits
        cols = []
        for at in range(0, rows.shape[1], per):
            key = np.zeros(len(rows), np.uint64)
            for j in range(per):
                c = rows[:, at + j].astype(np.uint64) if at + j < rows.shape[1] else np.uint64(0)
                key = (key << np.uint64(self.bits)) | c
            cols.append(key)
        return np.stack(cols, axis=1)

    def suffix_array(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, keys) in order of their suffixes, for the suffixes of ``codes``
        (from 1; 0 outside the vocabulary and between texts) that can match."""
        padded = np.append(codes, np.zeros(self.window, codes.dtype))
        can = np.zeros(len(codes), bool)
        for n, seeds in self.seeds.items():
            key = self._seed([padded[c:c + len(codes)] for c in range(n)])
            at = np.searchsorted(seeds, key)
            can |= seeds[np.minimum(at, len(seeds) - 1)] == key
        places = np.flatnonzero(can & (codes > 0))
        keys = self.pack(padded[places[:, None] + np.arange(self.window)])
        order = np.lexsort(keys.T[::-1])
        return places[order], keys[order]

    def locate(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, window, longest) of every occurrence of a window in ``codes``;
        ``longest`` is the verbatim match from there with the window's item."""
        places, keys = self.suffix_array(codes)
        if not len(places) or not len(self.lens):
            return (np.zeros(0, np.int64),) * 3
        lo, hi = _search(keys, self.low, False), _search(keys, self.high, True)
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = places[np.repeat(lo, n) + step]
        longest = self.lens[which].copy()
        flat = np.concatenate(self.words)
        begins = np.cumsum([0, *map(len, self.words)])
        at = np.array([begins[k] + i for k, i in self.at])[which]
        padded = np.append(codes, 0)
        open_ = np.arange(len(place))
        while len(open_):
            a = padded[np.minimum(place[open_] + longest[open_], len(codes))]
            b = flat[np.minimum(at[open_] + longest[open_], len(flat) - 1)] + 1
            open_ = open_[(a == b) & (a > 0)]
            longest[open_] += 1
        return place, which, longest


def _scan(batches: Iterator[pa.RecordBatch], items: list[tuple[str, str]], window: int,
          group_bytes: int) -> Iterator[pa.RecordBatch]:
    bench = Benchmark(items, window)
    get = bench.vocabulary.get
    for group in groups_of_bytes(batches, "_text", group_bytes):
        b = pa.Table.from_batches(group)
        parts, lens = [], []
        for t in b.column("_text").to_pylist():
            ws = split_words(t)
            lens.append(len(ws))
            parts.append(np.fromiter((get(w, -1) for w in ws), np.int32, len(ws)) + 1)
            parts.append(np.zeros(1, np.int32))
        lens = np.array(lens, np.int64)
        begins = np.cumsum(lens + 1) - lens - 1
        place, which, longest = bench.locate(np.concatenate(parts))
        doc = np.searchsorted(begins, place, side="right") - 1
        order = np.lexsort((place, doc))
        place, which, longest, doc = place[order], which[order], longest[order], doc[order]
        cuts = np.searchsorted(doc, np.arange(len(lens) + 1))
        hits, names, most, where = [], [], [], []
        for d in range(len(lens)):
            s = slice(cuts[d], cuts[d + 1])
            p = place[s] - begins[d]
            if not len(p):
                hits.append([])
                names.append([])
                most.append(0)
                where.append(None)
                continue
            end = np.maximum.accumulate(p + bench.lens[which[s]])
            new = np.append(True, p[1:] > end[:-1])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)
            hits.append([{"start": int(x), "end": int(y)}
                         for x, y in zip(p[new], end[last], strict=True)])
            names.append(sorted({i for w in np.unique(which[s]) for i in bench.items[w]}))
            k = int(np.argmax(longest[s]))
            most.append(int(longest[s][k]))
            where.append(int(p[k]))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        yield from pa.table({
            "_id": b.column("_id"), "_th": b.column("_th"), "n_words": pa.array(lens),
            "hits": pa.array(hits, pa.list_(span)), "items": pa.array(names, pa.list_(pa.string())),
            "longest": pa.array(most, pa.int64()), "longest_at": pa.array(where, pa.int64()),
        }).combine_chunks().to_batches()


def match_benchmark(df: DataFrame, benchmark: DataFrame, text_col: str = "text",
                    id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text",
                    window: int = 13, block_bytes: int = 16 << 20,
                    group_bytes: int = 6 << 20) -> DataFrame:
    """(``id_col``, ``_th``, n_words, hits, items, longest, longest_at) per row of ``df``.

    ``hits`` are the merged spans (words from 0, end exclusive) covered by
    windows of the benchmark: ``window`` consecutive words of an item, or all
    words of a shorter one.  ``items`` are the ids, as strings, of the items with
    such windows; ``longest`` and ``longest_at`` the longest verbatim match and
    its first place.  Null and empty texts have no words; a null item id counts
    as ``null``.  Repeated rows repeat; empty tables give no rows or no hits.

    The benchmark goes to the tasks in blocks of about ``block_bytes``; a larger
    one takes several passes, whose spans are merged.
    """
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null"))
                             .alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit(""))
                             .alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    docs = df.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`"))
                     .alias("_th"), F.col(f"`{text_col}`").alias("_text"))
    schema = (f"_id {dict(docs.dtypes)['_id']}, _th bigint, n_words bigint, "
              "hits array<struct<start:bigint,end:bigint>>, items array<string>, "
              "longest bigint, longest_at bigint")

    def block(k: int) -> DataFrame:
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k)
        held = [tuple(r) for r in own.collect()]  # one block: bounded by block_bytes
        return docs.mapInArrow(lambda it: _scan(it, held, window, group_bytes), schema)

    out = block(0)
    if n_blocks > 1:
        for k in range(1, n_blocks):
            out = out.unionByName(block(k))
        out = out.groupBy("_id", "_th").agg(
            F.max("n_words").alias("n_words"),
            _merge(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max("longest").alias("longest"),
            F.max_by("longest_at", "longest").alias("longest_at"))
        out = on_document(docs.select("_id", "_th"), out, "inner")
    return out.withColumnRenamed("_id", id_col)


def _merge(spans):
    """Overlapping or touching spans as one."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]),
                      joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), none, step)


def contaminated(found: DataFrame) -> DataFrame:
    """``found`` with n_hit (words inside hits) and ``contaminated``: at least one
    word, and a twentieth of all, are hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text",
                        id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` that are not contaminated, with its own columns."""
    bad = contaminated(match_benchmark(df, benchmark, text_col, id_col, **options)) \
        .filter("contaminated").select(F.col(id_col).alias("_id"), "_th").distinct()
    th = F.xxhash64(F.col(f"`{text_col}`"))
    return df.join(bad, (th == bad["_th"]) & df[id_col].eqNullSafe(bad["_id"]), "left_anti")
