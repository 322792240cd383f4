"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

A phrase's occurrences are the suffixes (of pieces) that begin with it.  Passes over the
texts count words and, in bitmaps of fixed size, pairs and triples of neighbouring
words; the last gives every suffix up to the longest phrase, cut before the first word,
pair or triple that cannot be frequent, equal ones of a task as one.  Suffixes are routed by
their leading words (the first, and one of 16 buckets of the second, so that a very common
word is dealt out): all occurrences of a phrase of two words or more meet in one part.  There
pointers to them are sorted word by word with three-way partitions, whose equal part is
a phrase and its size the count; parts below the least count are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import groups_of_bytes, save

_GROUP = 4 << 20  # bytes of text cut into words at once
_WORDS = 32_000_000  # words of text whose frequent suffixes one part should hold
_SECOND = 16  # buckets of the second word
_BITS = (16, 27)  # of the bitmaps: at most 16 MB each, whatever the input
_BLOCK = 16  # bits of a bucket's place in its block
_DEALS = 32  # parts of a language whose best are found apart
_HELD = 2_000_000  # rows that a task sums up before it gives them out
_UND = "und"

_BYTE = np.zeros(256, np.uint8)  # 0 letter, 1 blank, 2 end of a piece
_BYTE[[0x20, 0x09]] = 1
_BYTE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def cut_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(id of each word, the distinct words, its piece, its text) for all words of
    ``texts`` in order."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _BYTE[data]
    letter = kind == 0
    edge = np.diff(letter.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    body = data[letter]
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(body))
    coded = words.dictionary_encode()
    return (coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, piece,
            np.searchsorted(ends, begin, side="right"))


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the words (a large string array)."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + n + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if n else np.zeros(0, np.uint8)
    if not n:
        return np.zeros(0, np.uint64)
    at = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
    power = np.full(max(1, int(np.diff(offsets).max())), np.uint64(0x9E3779B97F4A7C15))
    power = np.cumprod(power, dtype=np.uint64)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], offsets[:-1] - offsets[0])
    return _mix(h)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * np.uint64(0x94D049BB133111EB) + b)


def _lang_hash(lang: str) -> np.uint64:
    return _hashes(pa.array([lang], pa.large_string()))[0]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``_GROUP`` bytes at once."""
    for group in groups_of_bytes(batches, "text", _GROUP):
        t = pa.Table.from_batches(group)
        langs = t.column("lang").to_pylist()
        texts = t.column("text").cast(pa.binary()).to_pylist()
        for lang in dict.fromkeys(langs):
            yield lang, [x for x, own in zip(texts, langs, strict=True) if own == lang]


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(_UND)).alias("lang"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def _summed(parts: Iterator[pa.Table], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Tables with a count ``n``, as one row per ``by`` of a task; what is more than
    ``_HELD`` rows even so goes out before."""
    held: list[pa.Table] = []
    fresh = 0

    def merged() -> pa.Table:
        t = pa.concat_tables(held).group_by(by).aggregate([("n", "sum")]).rename_columns([*by, "n"])
        return t.combine_chunks()

    for part in parts:
        held.append(part)
        fresh += len(part)
        if fresh > _HELD:
            held = [merged()]
            fresh = 0
            if len(held[0]) > _HELD:
                yield from held.pop().to_batches()
    if held:
        yield from merged().to_batches()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f): occurrences of every word in every language."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for lang, texts in _groups(batches):
            ids, words, _, _ = cut_words(texts)
            yield pa.table([pa.array([lang] * len(words), pa.string()), words.cast(pa.string()),
                            pa.array(np.bincount(ids, minlength=len(words)).astype(np.int64))], ["lang", "word", "n"])

    return docs.mapInArrow(lambda it: _summed(parts(it), ["lang", "word"]), "lang string, word string, n bigint") \
        .groupBy("lang", "word").agg(F.sum("n").alias("f"))


class _Bits:
    """A bitmap over hashes: no false negative, of at most ``2**_BITS[1]`` bits."""

    def __init__(self, blocks: list, bits: int):
        self.bits = bits
        self.flags = np.zeros((1 << bits) >> 3, np.uint8)
        size = (1 << _BLOCK) >> 3
        for block, part in blocks:
            self.flags[block * size:(block + 1) * size] = np.frombuffer(part, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _bits_for(n: int) -> int:
    """About a bit for each of ``n`` hashes, within ``_BITS``."""
    return min(max(int(n).bit_length(), _BITS[0]), _BITS[1])


def _packed(buckets: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(block, low, n): the buckets hit by a task and how often, as 16-bit places and
    32-bit counts of each block of 2**16 buckets."""

    def told(b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        block = b >> _BLOCK
        first = np.flatnonzero(np.diff(block, prepend=-1))
        ends = np.append(first[1:], len(b))
        low, n = (b & (1 << _BLOCK) - 1).astype("<u2"), n.astype("<u4")
        return pa.RecordBatch.from_arrays([
            pa.array(block[first], pa.int32()),
            pa.array([low[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary()),
            pa.array([n[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary())], ["block", "low", "n"])

    all_b, all_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for new in buckets:
        both = np.concatenate([all_b, new])
        weight = np.concatenate([all_n, np.ones(len(new), np.int64)])
        order = np.argsort(both, kind="stable")
        both = both[order]
        first = np.flatnonzero(np.diff(both, prepend=-1))
        all_b = both[first]
        all_n = np.add.reduceat(weight[order], first) if len(first) else weight
        if len(all_b) > _HELD:
            yield told(all_b, all_n)
            all_b, all_n = all_b[:0], all_n[:0]
    if len(all_b):
        yield told(all_b, all_n)


def _bitmap(packed: DataFrame, bits: int, least: int) -> _Bits:
    """The buckets that all tasks together hit ``least`` times or more: summed by block on
    Spark, of which one fixed-size bitmap comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None
        for b in batches:
            for block, low, n in zip(*[b.column(c).to_pylist() for c in ("block", "low", "n")], strict=True):
                if block != now:
                    if now is not None:
                        yield flags(now, sums)
                    now, sums = block, np.zeros(1 << _BLOCK, np.int64)
                sums[np.frombuffer(low, "<u2")] += np.frombuffer(n, "<u4")
        if now is not None:
            yield flags(now, sums)

    def flags(block: int, sums: np.ndarray) -> pa.RecordBatch:
        part = np.packbits(sums >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part])], ["block", "part"])

    rows = packed.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, part binary")
    return _Bits([(r["block"], bytes(r["part"])) for r in rows.collect()], bits)


_PACKED = "block int, low binary, n binary"


def _word_bits(frequent: DataFrame, bits: int) -> _Bits:
    """The bitmap of the words of ``frequent`` (lang, word)."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in batches:
            h = _hashes(b.column("word").cast(pa.large_string()))
            langs = b.column("lang").dictionary_encode()
            own = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)
            if len(h):
                yield (_pair(own[langs.indices.to_numpy()], h) >> np.uint64(64 - bits)).astype(np.int64)

    rows = frequent.select("lang", "word").mapInArrow(lambda it: _packed(buckets(it)), _PACKED)
    return _bitmap(rows, bits, 1)


def _grams(lang: str, texts: list[bytes], maps: list[_Bits], longest: int) -> tuple:
    """Word ids, the distinct words, and for k = 1 .. ``longest`` the hash of the k-gram at
    each word and whether it may be frequent: inside a piece, of parts that may be, and in
    the k-th of ``maps`` (as far as there are)."""
    ids, names, piece, _ = cut_words(texts)
    own = _pair(np.full(len(names), _lang_hash(lang)), _hashes(names))
    h, may = own[ids], maps[0].has(own)[ids] if len(ids) else np.zeros(0, bool)
    out = [(h, may)]
    for k in range(1, longest):
        n = max(0, len(ids) - k)
        may = may[:n] & may[1:n + 1] & (piece[:n] == piece[k:])
        if k <= len(maps):  # the last of these is what is counted or looked up
            h = _pair(h[:n], own[ids[k:]])
            if k < len(maps):
                at = np.flatnonzero(may)
                may[at] = maps[k].has(h[at])
        out.append((h, may))
    return ids, names, out


def _gram_bits(docs: DataFrame, maps: list[Broadcast], bits: int, least: int) -> _Bits:
    """The bitmap of grams of a word more than ``maps`` know, that may occur ``least`` times."""
    size = len(maps) + 1

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        known = [m.value for m in maps]
        for lang, texts in _groups(batches):
            h, may = _grams(lang, texts, known, size)[2][-1]
            yield (h[may] >> np.uint64(64 - bits)).astype(np.int64)

    return _bitmap(docs.mapInArrow(lambda it: _packed(buckets(it)), _PACKED), bits, least)


def suffixes(docs: DataFrame, maps: list[Broadcast], longest: int) -> DataFrame:
    """(lang, w1, bucket, rest): suffixes of two words or more, cut before the first gram of
    ``maps`` that cannot be frequent, as their first word, the bucket of their second, and the
    list of what follows (w2 .. w``longest``, n); equal ones of a task are one entry."""
    names_of = [f"w{k + 1}" for k in range(longest)]

    def parts(batches: Iterator[pa.RecordBatch], known: dict[str, int]) -> Iterator[pa.Table]:
        bits = [m.value for m in maps]
        for lang, texts in _groups(batches):
            ids, names, grams = _grams(lang, texts, bits, longest)
            at = np.flatnonzero(grams[1][1])
            if not len(at):
                continue
            padded = np.concatenate([ids, np.zeros(longest, ids.dtype)])
            cols = [padded[at]]
            for k in range(1, longest):
                may = np.concatenate([grams[k][1], np.zeros(k + longest, bool)])
                cols.append(np.where(may[at], padded[at + k], -1))
            # the task's numbers of the words instead of the batch's
            used = np.unique(np.concatenate(cols))
            used = used[used >= 0]
            to = np.full(len(names) + 1, -1, np.int32)
            to[used] = [known.setdefault(w, len(known)) for w in names.take(pa.array(used)).to_pylist()]
            yield pa.table({"lang": pa.array([lang] * len(at), pa.string()),
                            **{k: to[c] for k, c in zip(names_of, cols, strict=True)},
                            "n": np.ones(len(at), np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in _summed(parts(batches, known), ["lang", *names_of]):
            words = pa.array(list(known), pa.string())
            bucket = (_hashes(words.cast(pa.large_string())) % np.uint64(_SECOND)).astype(np.int32)
            lang = b.column("lang").dictionary_encode()
            col = [b.column(k).to_numpy() for k in names_of]
            second = bucket[col[1]]
            order = np.lexsort([second, col[0], lang.indices.to_numpy()])
            key = np.stack([lang.indices.to_numpy()[order], col[0][order], second[order]])
            first = np.flatnonzero(np.append(True, (np.diff(key) != 0).any(axis=0)))
            told = [words.take(pa.array(c[order], pa.int32(), mask=c[order] < 0)) for c in col[1:]]
            rest = pa.StructArray.from_arrays([*told, b.column("n").take(pa.array(order))], [*names_of[1:], "n"])
            yield pa.RecordBatch.from_arrays([
                b.column("lang").take(pa.array(order[first])), words.take(pa.array(key[1][first])),
                pa.array(key[2][first], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), rest)],
                ["lang", "w1", "bucket", "rest"])

    kinds = ", ".join(f"{k}: string" for k in names_of[1:])
    return docs.mapInArrow(run, f"lang string, w1 string, bucket int, rest array<struct<{kinds}, n: bigint>>")


def quicksort_counts(keys: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(pointer to one suffix, words, count) of every prefix of rows of ``keys`` (-1: no
    word) whose rows weigh ``least`` or more, by a multikey three-way quicksort of
    pointers to the full depth; lighter parts are abandoned."""
    n, depths = keys.shape
    order = np.arange(n)
    found, todo = [], [(0, n, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        own = order[lo:hi]
        k = keys[own, depth]
        pivot = np.sort(k[[0, (hi - lo) >> 1, -1]])[1]
        less, more = k < pivot, k > pivot
        same = own[~(less | more)]
        low, high = own[less], own[more]
        order[lo:hi] = np.concatenate([low, same, high])
        a, b = lo + len(low), hi - len(high)
        if len(low) and weight[low].sum() >= least:
            todo.append((lo, a, depth))
        if len(high) and weight[high].sum() >= least:
            todo.append((b, hi, depth))
        if pivot >= 0:
            size = int(weight[same].sum())
            if size >= least:
                found.append((int(same[0]), depth + 1, size))
                if depth + 1 < depths:
                    todo.append((a, b, depth + 1))
    return found


def _part_counts(batches: Iterator[pa.RecordBatch], longest: int, least: int,
                 schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The frequent phrases of one part of the routed suffixes."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    lists = t.column("rest").combine_chunks()
    at = pa.array(np.repeat(np.arange(len(t)), pc.list_value_length(lists).to_numpy()))
    rest = lists.flatten()
    cols = [t.column("lang").take(at), t.column("w1").take(at)]
    cols = [c.combine_chunks() for c in cols] + [rest.field(f"w{k + 1}") for k in range(1, longest)]
    # ids in the order of the words' bytes, one numbering for all columns
    every = pa.chunked_array(cols).unique().drop_null()
    every = every.take(pc.sort_indices(every))
    keys = np.stack([pc.fill_null(pc.index_in(c, every), -1).to_numpy().astype(np.int32) for c in cols], axis=1)
    found = [(keys[i, :depth], n) for i, depth, n in
             quicksort_counts(keys, rest.field("n").to_numpy(), least) if depth > 2]
    text = every.to_pylist()
    yield pa.RecordBatch.from_arrays([
        pa.array([text[k[0]] for k, _ in found], pa.string()),
        pa.array([" ".join(text[i] for i in k[1:]) for k, _ in found], pa.string()),
        pa.array([len(k) - 1 for k, _ in found], pa.int32()),
        pa.array([n for _, n in found], pa.int64())], schema=schema)


def frequent_phrases(docs: DataFrame, words: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 2 to ``longest`` words that occur ``least``
    times or more; ``docs`` (lang, text) and their ``words`` (lang, word, f)."""
    spark = docs.sparkSession
    frequent = words.filter(F.col("f") >= least)
    seen = words.agg(F.sum("f").alias("n")).first()["n"] or 0
    share = spark.sparkContext.broadcast
    maps = [share(_word_bits(frequent, _bits_for(16 * frequent.count())))]
    for _ in range(min(2, longest - 1)):
        maps.append(share(_gram_bits(docs, maps, _bits_for(seen), least)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen // _WORDS))
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])
    return suffixes(docs, maps, longest).repartition(parts, "lang", "w1", "bucket") \
        .mapInArrow(lambda it: _part_counts(it, longest, least, schema),
                    "lang string, phrase string, size int, f bigint")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5,
                 least: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all collocations: phrases of 2 to ``longest``
    words within a piece (texts are split at ``[.,;:!?]`` and line ends), in lower case A-Z,
    that occur ``least`` times or more in their language and in no longer such phrase
    just as often.

    n counts the language's words, a the phrase; the score is floor(1000 a n / (l r)) for the
    cut into two parts (of l and r occurrences) where it is least, ties to the shortest
    first part.  A null text is empty, a null language ``und``; repeated rows count again;
    long texts are read whole; an empty table gives an empty result.  Other columns of
    ``df`` are not read, whatever their names."""
    docs = _texts(df, text_col, lang_col)
    words = save(word_counts(docs), "words")
    found = save(frequent_phrases(docs, words, longest, least), "phrases")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = found.select("lang", "phrase", "f").unionByName(
        words.filter(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), "f"))
    return _scored(_longest_only(found), counts, total)


def _part(first: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def _longest_only(found: DataFrame) -> DataFrame:
    """Without the phrases that stand in one of a word more just as often (and so in any
    longer one: what lies between occurs as often)."""
    shorter = found.filter("size > 2").select(
        "lang", F.explode(F.array(_part(1, F.col("size") - 1), _part(2, F.col("size") - 1))).alias("phrase"), "f")
    inside = shorter.groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    return found.join(inside, ["lang", "phrase"], "left") \
        .filter("over IS NULL OR over < f").drop("over")


def _scored(found: DataFrame, counts: DataFrame, total: DataFrame) -> DataFrame:
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))) \
        .withColumn("head", _part(1, F.col("k"))).withColumn("tail", _part(F.col("k") + 1, F.col("size")))
    side = lambda name, value: counts.select(
        "lang", F.col("phrase").alias(name), F.col("f").alias(value))
    both = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]) \
        .join(total, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * wide("f")).cast("decimal(19,0)") * wide("n"),
                            wide("l") * wide("r")).cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(best) \
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_collocations(df: DataFrame, first: int = 2000, **options) -> DataFrame:
    """The ``first`` collocations of each language by score, then a (both descending), then
    phrase, with their ``rank`` from 1: a report."""
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    deal = F.pmod(F.xxhash64("phrase"), F.lit(_DEALS))
    some = F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*best))
    # a language's first rows are among the first of its parts, which are found apart
    few = collocations(df, **options).withColumn("deal", deal).withColumn("some", some) \
        .filter(F.col("some") <= first)
    return few.withColumn("rank", rank).filter(F.col("rank") <= first) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
