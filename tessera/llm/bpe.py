"""Byte-level BPE by a hierarchical-bitmap rank queue.

All new pre-tokens of a batch are encoded together.  Their bytes stand in one
linked list; every adjacent pair that forms a token waits in the bucket of that
token's rank, and a bitmap of two levels tells the lowest bucket in use (find
first set).  Emptying a bucket merges all its pairs at once: pre-tokens do not
touch each other, so the lowest rank of all is the lowest of each that holds
it.  Entries whose pair has changed since are stale and are skipped.  Work
follows the number of merges, also for a pre-token of millions of bytes.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups_of_bytes

_WORD = 256
_MERGED = 1 << 18
#: A space is a safe place to cut unless white space follows it.
_BOTH = re.compile(r" [\s\x85]")


class RankQueue:
    """Buckets of list positions per rank; ``pop`` empties the lowest."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // _WORD + 1)
        self.high = 0
        self.buckets: dict[int, list[np.ndarray]] = defaultdict(list)

    def push(self, ranks: np.ndarray, at: np.ndarray) -> None:
        """Positions ``at`` (rising) with the rank of each one's pair."""
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(at)]
        for k, r in enumerate(ranks[starts[:-1]].tolist()):
            self.buckets[r].append(at[starts[k]:starts[k + 1]])
            self.low[r // _WORD] |= 1 << r % _WORD
            self.high |= 1 << r // _WORD

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self.high:
            return None
        i = (self.high & -self.high).bit_length() - 1
        word = self.low[i]
        r = i * _WORD + (word & -word).bit_length() - 1
        self.low[i] = word & (word - 1)
        if not self.low[i]:
            self.high &= self.high - 1
        held = self.buckets.pop(r)
        return r, held[0] if len(held) == 1 else np.unique(np.concatenate(held))


class Vocabulary:
    """Ranks of a tiktoken file, with the pairs that form each token."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.size = max(self.ranks.values()) + 1
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        get = self.ranks.get
        pairs = sorted((a * self.size + b, r) for t, r in self.ranks.items()
                       for k in range(1, len(t))
                       if (a := get(t[:k])) is not None and (b := get(t[k:])) is not None)
        self.pair_keys = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [-1], np.int64)
        flat = [b""] * self.size
        for t, r in self.ranks.items():
            flat[r] = t
        self.flat = np.frombuffer(b"".join(flat), np.uint8)
        self.ends = np.cumsum([len(t) for t in flat])
        self.known = np.array([len(t) for t in flat]) > 0

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair of ids forms, -1 for none."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each): every one of ``tokens`` encoded by itself."""
        lens = np.array([len(t) for t in tokens], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        n = len(ids)
        owner = np.repeat(np.arange(len(tokens), dtype=np.int32), lens)
        ends = np.cumsum(lens)
        # position n is a wall: the pair before it and those at ends have no rank
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = n
        before[(ends - lens)] = n
        after[n] = before[n] = n
        ids = np.append(ids, np.int32(-1))
        pair = np.full(n + 1, -1, np.int32)
        for at in range(0, n, _MERGED):
            inner = np.flatnonzero(after[at:min(n, at + _MERGED)] != n) + at
            pair[inner] = self.pair_rank(ids[inner], ids[inner + 1])
        queue = RankQueue(self.size)
        live = np.flatnonzero(pair >= 0).astype(np.int32)
        queue.push(pair[live], live)
        alive = np.ones(n + 1, bool)
        while (got := queue.pop()) is not None:
            rank, at = got
            at = at[pair[at] == rank]  # the rest are stale
            if len(at) > 1:
                # of pairs that overlap in a row every second one goes stale
                joined = after[at[:-1]] == at[1:]
                if joined.any():
                    first = np.append(True, ~joined)
                    k = np.arange(len(at))
                    at = at[(k - np.maximum.accumulate(np.where(first, k, 0))) % 2 == 0]
            if not len(at):
                continue
            right = after[at]
            ids[at] = rank
            alive[right] = False
            pair[right] = -1
            nxt = after[right]
            after[at] = nxt
            before[nxt] = at
            before[n] = after[n] = n
            prev = before[at]
            has_next, has_prev = at[nxt != n], prev[prev != n]
            touched = np.unique(np.concatenate([has_next, has_prev]))
            pair[at] = -1
            new = self.pair_rank(ids[touched], ids[after[touched]])
            pair[touched] = new
            keep = new >= 0
            queue.push(new[keep], touched[keep])
        kept = np.flatnonzero(alive[:n])
        return ids[kept], np.bincount(owner[kept], minlength=len(tokens))


def _gather(starts: np.ndarray, lens: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The slices ``flat[s:s + n]``, one after the other."""
    total = int(lens.sum())
    if not total:
        return flat[:0]
    step = np.repeat(starts - np.append(0, np.cumsum(lens)[:-1]), lens)
    return flat[step + np.arange(total)]


class _Codes(dict):
    def __missing__(self, part: str) -> int:
        code = self[part] = len(self)
        return code


class Encoder:
    """Texts to ids.  Parts of texts that a space begins are remembered; ``held``
    bounds their characters and only decides when they are forgotten."""

    def __init__(self, vocabulary: Vocabulary, held: int = 12 << 20):
        self.v, self.held = vocabulary, held
        self.clear()

    def clear(self) -> None:
        self.codes, self.done, self.size = _Codes(), 0, 0
        self.flat = np.zeros(0, np.uint32)
        self.starts = self.lens = np.zeros(0, np.int64)

    def _parts(self, text: str) -> list[str]:
        """Parts that the pattern never matches across: each begins with the
        space that its first match takes in."""
        if not _BOTH.search(text):
            head, *rest = text.split(" ")
            return [head, *[" " + w for w in rest]]
        return self.v.pattern.findall(text)

    def _learn(self) -> None:
        new = list(self.codes)[self.done:] if len(self.codes) > self.done else []
        if not new:
            return
        find, ranks = self.v.pattern.findall, self.v.ranks
        tokens, known, n_tokens = _Codes(), [], np.zeros(len(new), np.int64)
        used: list[int] = []
        for i, part in enumerate(new):
            found = find(part)
            n_tokens[i] = len(found)
            used += [tokens[t] for t in found]
        raw = [t.encode() for t in tokens]
        known = [ranks.get(t, -1) for t in raw]
        rest = [t for t, r in zip(raw, known, strict=True) if r < 0]
        ids, counts = self.v.merge(rest) if rest else (np.zeros(0, np.int64), [])
        is_known = np.array(known, np.int64) >= 0
        lens = np.ones(len(raw), np.int64)
        lens[~is_known] = counts
        starts = np.cumsum(lens) - lens
        flat = np.empty(int(lens.sum()), np.uint32)
        flat[starts[is_known]] = np.array(known, np.int64)[is_known]
        mask = np.ones(len(flat), bool)
        mask[starts[is_known]] = False
        flat[mask] = ids
        use = np.array(used, np.int64)
        part_flat = _gather(starts[use], lens[use], flat) if len(use) else flat[:0]
        per_use = np.append(0, np.cumsum(lens[use])) if len(use) else np.zeros(1, np.int64)
        ends = per_use[np.cumsum(n_tokens)]
        begins = np.append(0, ends[:-1])
        self.starts = np.concatenate([self.starts, begins + len(self.flat)])
        self.lens = np.concatenate([self.lens, ends - begins])
        self.flat = np.concatenate([self.flat, part_flat])
        self.done = len(self.codes)
        self.size += sum(map(len, new)) + 64 * len(new)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.size > self.held:
            self.clear()
        code = self.codes.__getitem__
        rows = [np.fromiter(map(code, self._parts(t)), np.int32) if t else
                np.zeros(0, np.int32) for t in texts]
        self._learn()
        return [_gather(self.starts[r], self.lens[r], self.flat) for r in rows]


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    """The bytes of ``ids``; an id outside the vocabulary is an error."""
    if len(ids) and not (int(ids.max()) < v.size and v.known[ids].all()):
        raise ValueError("an id is not in the vocabulary")
    ends = v.ends[ids]
    starts = np.where(ids > 0, v.ends[ids.astype(np.int64) - 1], 0)
    return _gather(starts, ends - starts, v.flat).tobytes()


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                 decoded: bool = False, group_bytes: int = 8 << 20) -> DataFrame:
    """(``id_col``, n_tokens, ids) per row of ``df``: the ids of the whole text as
    binary, little-endian unsigned 32-bit integers, without special tokens.
    ``decoded`` adds ``bytes``, the bytes that these ids decode to, in the same
    worker (a second one beside it would double the Python memory of a task).

    A null or empty text has no ids (empty binary).  Rows are encoded one by
    one: repeated rows repeat, and an empty table gives an empty result.
    ``path`` is the rank file on every executor.
    """
    path = path or default_vocabulary()
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path, pattern)
        encoder = Encoder(v)
        for group in groups_of_bytes(batches, "_text", group_bytes):
            b = pa.Table.from_batches(group).combine_chunks()
            ids = encoder.encode([t or "" for t in b.column("_text").to_pylist()])
            out = {
                "_id": b.column("_id"), "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids": pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
            }
            if decoded:
                out["bytes"] = pa.array([decode(v, x) for x in ids], pa.binary())
            yield from pa.table(out).to_batches()

    schema = f"_id {dict(rows.dtypes)['_id']}, n_tokens bigint, ids binary"
    return rows.mapInArrow(run, schema + ", bytes binary" * decoded) \
        .withColumnRenamed("_id", id_col)


def decode_ids(df: DataFrame, ids_col: str = "ids", out_col: str = "bytes",
               path: str | None = None, group_bytes: int = 4 << 20) -> DataFrame:
    """``df`` with ``out_col``: the bytes of the ids in ``ids_col`` (as written by
    ``encode_texts``).  Null ids decode to empty bytes."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path)
        for group in groups_of_bytes(batches, ids_col, group_bytes):
            for b in group:
                got = [decode(v, np.frombuffer(x or b"", "<u4"))
                       for x in b.column(ids_col).to_pylist()]
                yield b.append_column(out_col, pa.array(got, pa.binary()))

    base = df.drop(out_col) if out_col in df.columns else df
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, `{out_col}` binary")
