"""A run-length index over a block of strings, and their matching statistics."""

from __future__ import annotations

import numpy as np

_PACK = 7  # symbols of 9 bits in one key


class RunIndex:
    """Suffix order of a block of byte strings, kept as the runs of its
    Burrows-Wheeler transform with the suffixes sampled at both run ends.

    A string ends in a mark of its own, so no match goes past its end.  The
    longest match of a suffix with its neighbours in suffix order is compared
    only where a run begins; inside a run it is one less than that of the
    suffix one to the left, so streaming over the text gives all of them.
    """

    def __init__(self, data: np.ndarray, lens: np.ndarray):
        lens = np.asarray(lens, np.int64)
        self.ends = np.cumsum(lens + 1) - 1  # places of the end marks
        self.begins = self.ends - lens
        total = int(self.ends[-1]) + 1
        sym = np.zeros(total, np.int64)
        body = np.ones(total, bool)
        body[self.ends] = False
        sym[body] = data.astype(np.int64) + 1
        self.sym = sym
        #: symbols before the end mark
        self.left = np.repeat(self.ends, lens + 1) - np.arange(total)
        pack = np.zeros(total, np.int64)
        padded = np.append(sym, np.zeros(_PACK, np.int64))
        for j in range(_PACK):
            pack = (pack << 9) | np.where(self.left > j, padded[j:j + total], 0)
        self.pack = pack
        order = self._suffix_order()
        before = sym[order - 1]
        before[order == 0] = 0
        head = np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0))
        at = np.flatnonzero(head)[1:]
        #: first suffix of each run but the first, and last suffix of the run before
        self.heads, self.tails = order[at], order[at - 1]
        self.runs = len(at) + 1

    def _suffix_order(self) -> np.ndarray:
        total = len(self.pack)
        order = np.argsort(self.pack, kind="stable")
        key = self.pack[order]
        slots = np.arange(total)
        rank = np.empty(total, np.int64)
        size = _PACK
        while True:
            own = order[slots]
            # equal keys are one group, unless they reach their end marks: these
            # differ, and stable sorting has left them in order
            new = np.append(True, (key[1:] != key[:-1]) | (self.left[own[1:]] < size))
            first = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
            rank[own] = first
            alone = new & np.append(new[1:], True)
            slots = slots[~alone]
            if not len(slots):
                return order
            own = order[slots]
            key = rank[own] * (total + 1) + rank[own + size]
            by = np.argsort(key, kind="stable")
            order[slots] = own[by]
            key = key[by]
            size *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_] + out[open_], b[open_] + out[open_]
            p, q = self.pack[x], self.pack[y]
            whole = (p == q) & (self.left[x] >= _PACK) & (self.left[y] >= _PACK)
            part = open_[~whole]
            diff = (p ^ q)[~whole]
            high = np.floor(np.log2(np.maximum(diff, 1).astype(np.float64))).astype(np.int64)
            # a rounded logarithm may be one too high: check against the bit itself
            high -= (np.int64(1) << high) > np.maximum(diff, 1)
            same = np.where(diff == 0, _PACK, (9 * _PACK - 1 - high) // 9)
            out[part] += np.minimum(same, np.minimum(self.left[x], self.left[y])[~whole])
            open_ = open_[whole]
            out[open_] += _PACK
        return out

    def matching_statistics(self) -> np.ndarray:
        """Per place, the longest match of the text there with any other place."""
        reach = np.zeros(len(self.sym), np.int64)
        n = self._common(self.heads, self.tails)
        np.maximum.at(reach, self.heads, n + self.heads)
        np.maximum.at(reach, self.tails, n + self.tails)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(len(reach)), 0)


def long_matches(strings: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per string the runs [from, to) of places whose next ``length`` bytes stand
    anywhere else in the block too."""
    if not strings:
        return []
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), [len(s) for s in strings])
    marked = np.append(index.matching_statistics() >= length, False)
    edges = np.flatnonzero(np.diff(np.append(False, marked).astype(np.int8)))
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    of = np.searchsorted(index.ends, edges[::2])
    for s, lo, hi in zip(of.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        out[s].append((lo - int(index.begins[s]), hi - int(index.begins[s])))
    return out
