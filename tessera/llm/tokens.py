"""Token counts by a SentencePiece model, in Arrow batches that return lengths only.

Texts are split at safe boundaries: a single space between two other characters.
No piece of the model holds a word mark inside, so no merge crosses such a
space, and the mark the library puts before each part stands for the space.
Parts that repeat are encoded once; new ones go to the library in batches
balanced by bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups_of_bytes

_MARK = "▁"
#: A space with another space or a written word mark beside it is not safe.
_UNSAFE = re.compile(f"^ | $|  |{_MARK} | {_MARK}")
_SAFE = re.compile(f"(?<=[^ {_MARK}]) (?=[^ {_MARK}])")


def safe_parts(text: str) -> list[str]:
    """Parts of ``text`` whose token counts add up to the text's."""
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


class _Codes(dict):
    def __missing__(self, part: str) -> int:
        code = self[part] = len(self)
        return code


class Counter:
    """Token counts of texts; ``held`` bounds the parts remembered by their
    characters, ``batch`` the characters sent to the library at once."""

    def __init__(self, model: str, held: int = 32 << 20, batch: int = 1 << 20):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        self.split = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.held, self.batch = held, batch
        self.clear()

    def clear(self) -> None:
        self.codes, self.lengths, self.size = _Codes(), np.zeros(0, np.int64), 0

    def counts(self, texts: list[str]) -> np.ndarray:
        if self.size > self.held:
            self.clear()
        code = self.codes.__getitem__
        rows = [np.fromiter(map(code, safe_parts(t) if self.split else [t]), np.int32) if t
                else np.zeros(0, np.int32) for t in texts]
        new = list(self.codes)[len(self.lengths):] if len(self.codes) > len(self.lengths) else []
        got, part, size = [], [], 0
        for p in new:
            part.append(p)
            size += len(p)
            if size >= self.batch:
                got += map(len, self.sp.encode(part, num_threads=1))
                self.size, part, size = self.size + size, [], 0
        got += map(len, self.sp.encode(part, num_threads=1))
        self.size += size + 64 * len(new)
        self.lengths = np.concatenate([self.lengths, np.array(got, np.int64)])
        return np.array([self.lengths[r].sum() for r in rows], np.int64)


def count_tokens(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 model: str | None = None, group_bytes: int = 4 << 20) -> DataFrame:
    """(``id_col``, n_bytes, n_tokens) per row of ``df``: UTF-8 bytes of the text
    and its tokens without begin, end or special tokens.

    A null or empty text has 0 of both.  Rows are counted one by one: repeated
    rows repeat, and an empty table gives an empty result.  ``model`` is the
    path of the model file on every executor.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for group in groups_of_bytes(batches, "_text", group_bytes):
            for b in group:
                n = counter.counts([t or "" for t in b.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    b.column("_id"),
                    pc.fill_null(pc.cast(
                        pc.binary_length(b.column("_text")), pa.int64()), 0),
                    pa.array(n)], ["_id", "n_bytes", "n_tokens"])

    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(count, f"_id {kind}, n_bytes bigint, n_tokens bigint") \
        .withColumnRenamed("_id", id_col)
