"""Segments of texts that share a minimizer, so that equal windows meet.

Every window of ``window`` bytes belongs to the least hash of its ``gram``-byte
substrings; equal windows have the same.  A segment is a run of neighbouring
windows with the same least hash (its key).
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram``-byte substring (8 bytes or more), by doubling:
    that of 2n bytes is made of those of two neighbours of n bytes."""
    pairs = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
    fours = pairs[:-2].astype(np.uint32) << np.uint32(16) | pairs[2:]
    h = _mix((fours[:-4].astype(np.uint64) << np.uint64(32) | fours[4:]) * _BASE)
    size = 8
    while size < gram:
        step = min(size, gram - size)
        h = h[:len(h) - step] * _BASE + h[step:]
        size += step
    return _mix(h)


def sliding(least, h: np.ndarray, width: int) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of every ``width`` neighbours."""
    size = 1
    while size < width:
        step = min(size, width - size)
        h = least(h[:len(h) - step], h[step:])
        size += step
    return h


def segments(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int,
             gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window's place, number of windows, again) over the texts
    ``data[begin:end]``; at most ``window - gram + 1`` windows to a segment.

    ``again`` is set wherever the least substring may stand in the segment twice,
    so that two windows of one segment may be equal.
    """
    width = window - gram + 1
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    if len(data) < window:
        return none
    h = gram_hashes(data, gram)
    key = sliding(np.minimum, h, width)
    # windows that lie within one text
    inside = np.zeros(len(key) + 1, np.int32)
    long_ = ends - begins >= window
    np.add.at(inside, begins[long_], 1)
    np.add.at(inside, ends[long_] - window + 1, -1)
    ok = np.cumsum(inside[:-1]) > 0
    new = np.append(True, key[1:] != key[:-1])
    new[begins[long_]] = True
    new &= ok
    new[1:] |= ok[1:] & ~ok[:-1]
    first = np.flatnonzero(new)
    if not len(first):
        return none
    # a run ends at the next run or where its text's windows end
    stop = np.append(first[1:], len(key))
    last_of_text = ends[long_] - window + 1
    stop = np.minimum(stop, last_of_text[np.searchsorted(last_of_text, first, side="right")])
    n = stop - first
    if (n > width).any():
        pieces = -(-n // width)
        of = np.repeat(np.arange(len(n)), pieces)
        step = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = first[of] + step * width
        n = np.minimum(stop[of] - first, width)
    # a substring is the least of some window around it if the largest of their
    # keys is its own hash
    around = sliding(np.maximum, np.concatenate([
        np.zeros(width - 1, np.uint64), key, np.zeros(width - 1, np.uint64)]), width)
    picked = np.sort(h[around == h])
    twice = np.unique(picked[1:][picked[1:] == picked[:-1]])
    key = key[first]
    return key, first, n, np.isin(key, twice)
