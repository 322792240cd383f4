"""1-2-grams of token lists counted a run of texts at a time, in numpy: no occurrence is a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

TOKENS = 1 << 18  # tokens looked at at once, or those of one text


def _runs(tokens: pa.Array, stop: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: their words, each token's place among these and its text, and the tokens that have
    a next one in their text.  Words of ``stop`` are left out first."""
    n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, a = np.cumsum(n), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - n[a] + TOKENS, "right")))
        coded = pc.dictionary_encode(tokens.slice(a, b - a).flatten())
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(a, b), n[a:b])
        if len(stop):
            keep = ~pc.is_in(words, value_set=stop).to_numpy(zero_copy_only=False)[code]
            code, text = code[keep], text[keep]
        yield words, code, text, np.flatnonzero(text[1:] == text[:-1])
        a = b


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)


def _buckets(h: np.ndarray, code: np.ndarray, pairs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets, of ``n``, of the words and of the pairs: the same for a term wherever it stands."""
    two = h[code[pairs]] * np.uint64(0x9E3779B97F4A7C15) + h[code[pairs + 1]] * np.uint64(0xC2B2AE3D27D4EB4F)
    return tuple(((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64) for x in (h[code], two))


def bucket_sums(texts: DataFrame, tokens: str, buckets: int, stop: list[str]) -> DataFrame:
    """(b, n): occurrences of all 1-2-grams by hash bucket; a task holds ``buckets`` sums."""
    def summed(batches):
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, code, _, pairs in _runs(batch.column(0), pa.array(stop, pa.string())):
                for b in _buckets(_hashes(words), code, pairs, buckets):
                    n += np.bincount(b, minlength=buckets)
        b = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(n[b])], ["b", "n"])

    return texts.select(tokens).mapInArrow(summed, "b long, n long").groupBy("b").agg(F.sum("n").alias("n"))


def counts(texts: DataFrame, id_col: str, tokens: str, buckets: int, heavy: np.ndarray | None, stop: list[str]) -> DataFrame:
    """(id, term, tf): 1-2-grams counted per text, only those of the ``heavy`` buckets if these are given;
    and one row for each text, with a null term and 1."""
    bits = None if heavy is None else np.packbits(np.isin(np.arange(buckets), heavy))

    def counted(batches):
        among = None if bits is None else np.unpackbits(bits, count=buckets).astype(bool)
        for batch in batches:
            ids = batch.column(0)
            yield rows(ids, pa.nulls(len(ids), pa.string()), np.ones(len(ids), np.int64))
            for words, code, text, pairs in _runs(batch.column(1), pa.array(stop, pa.string())):
                size, one, two = len(words), np.arange(len(code)), pairs
                if among is not None:
                    b = _buckets(_hashes(words), code, pairs, buckets)
                    one, two = one[among[b[0]]], two[among[b[1]]]
                span = size + size * size  # of a word its place, of a pair the word's and the next one's
                key, tf = np.unique(np.r_[text[one] * span + code[one],
                                          text[two] * span + size + code[two] * size + code[two + 1]], return_counts=True)
                if len(key):
                    at, gram = np.divmod(key, span)
                    gram, place = np.unique(gram, return_inverse=True)
                    first, second = np.divmod(gram[gram >= size] - size, size)
                    terms = pa.concat_arrays([words.take(pa.array(gram[gram < size])), pc.binary_join_element_wise(
                        words.take(pa.array(first)), words.take(pa.array(second)), " ")])
                    yield rows(ids.take(pa.array(at)), terms.take(pa.array(place)), tf)

    def rows(ids, terms, tf):
        return pa.RecordBatch.from_arrays([ids, terms, pa.array(tf, pa.int64())], [id_col, "term", "tf"])

    schema = StructType([StructField(id_col, texts.schema[id_col].dataType), StructField("term", StringType()),
                         StructField("tf", LongType())])
    return texts.select(id_col, tokens).mapInArrow(counted, schema)
