"""Words of many texts at once, as byte ranges, and their XXH64 hashes, with numpy.

Python workers get texts as one Arrow buffer; cutting and hashing it with array
operations costs a fraction of what an object per word would.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

# The primes of XXH64.
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)


def byte_table(chars: bytes) -> np.ndarray:
    """Which of the 256 byte values are among `chars`."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


@dataclass
class Words:
    """Words of consecutive texts: lower-cased, each followed by one space in `data` (8 more bytes at the end)."""

    data: np.ndarray          # bytes
    begin: np.ndarray         # [word]
    end: np.ndarray           # [word]
    first: np.ndarray         # [text + 1]: where a text's words begin
    old_end: np.ndarray       # [word]: where the word ended in the texts' own bytes
    raw: np.ndarray           # the texts' own bytes


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a binary array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, between: np.ndarray) -> Words:
    """The runs of bytes that are not `between` words, A-Z lower-cased; a text's end ends its last word."""
    raw, offsets = buffers(texts)
    low = _LOWER[raw]
    word = ~between[low]
    before, after = np.zeros(len(low), bool), np.zeros(len(low), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    if len(low):
        before[offsets[:-1][offsets[:-1] < len(low)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    old_begin = np.flatnonzero(word & ~before)
    old_end = np.flatnonzero(word & ~after) + 1
    length = old_end - old_begin
    end = np.cumsum(length + 1) - 1
    data = np.full((end[-1] + 1 if len(end) else 0) + 8, 32, np.uint8)
    inside = np.ones(len(data), bool)
    inside[end] = False
    inside[len(data) - 8:] = False
    data[inside] = low[word]
    return Words(data, end - length, end, np.searchsorted(old_begin, offsets), old_end, raw)


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(sum_: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(sum_ + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int | np.ndarray = 42) -> np.ndarray:
    """XXH64 of the byte ranges; `data` needs 8 more bytes after the last range. `seed`: one, or one per range."""
    n = (end - begin).astype(np.int64)
    at = begin.astype(np.int64)
    eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (max(0, len(data) - 7),), (1,))
    four = np.lib.stride_tricks.as_strided(data[:4].view("<u4"), (max(0, len(data) - 3),), (1,))
    seeds = np.broadcast_to(np.asarray(seed, np.uint64), n.shape)
    with np.errstate(over="ignore"):
        h = seeds + _P5
        wide = np.flatnonzero(n >= 32)
        if len(wide):
            wide = wide[np.argsort(-(n[wide] >> 5), kind="stable")]        # most stripes first
            stripes, place, s = n[wide] >> 5, at[wide].copy(), seeds[wide]
            lanes = [s + _P1 + _P2, s + _P2, s.copy(), s - _P1]
            for j in range(int(stripes[0])):
                live = int(np.searchsorted(-stripes, -j, side="left"))     # those with more than j stripes
                for i in range(4):
                    lanes[i][:live] = _round(lanes[i][:live], eight[place[:live] + 8 * i])
                place[:live] += 32
            total = _rotated(lanes[0], 1) + _rotated(lanes[1], 7) + _rotated(lanes[2], 12) + _rotated(lanes[3], 18)
            for lane in lanes:
                total = (total ^ _round(np.zeros_like(lane), lane)) * _P1 + _P4
            h[wide] = total
            at[wide] = place
        h += n.astype(np.uint64)
        rest = n & 31
        for j in range(3):
            some = np.flatnonzero(rest >> 3 > j)
            if len(some):
                h[some] = _rotated(h[some] ^ _round(np.zeros(len(some), np.uint64), eight[at[some]]), 27) * _P1 + _P4
                at[some] += 8
        some = np.flatnonzero(rest & 4)
        if len(some):
            h[some] = _rotated(h[some] ^ (four[at[some]].astype(np.uint64) * _P1), 23) * _P2 + _P3
            at[some] += 4
        for j in range(3):
            some = np.flatnonzero((rest & 3) > j)
            if len(some):
                h[some] = _rotated(h[some] ^ (data[at[some]].astype(np.uint64) * _P5), 11) * _P1
                at[some] += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges (which may overlap) as an Arrow string array."""
    length = (end - begin).astype(np.int32)
    offsets = np.append(0, np.cumsum(length, dtype=np.int64))
    if offsets[-1] > 2 ** 31 - 1:
        raise ValueError("more than 2 GB in one batch")
    offsets = offsets.astype(np.int32)
    places = np.repeat((begin - offsets[:-1]).astype(np.int32 if len(data) < 2 ** 31 else np.int64), length)
    places += np.arange(offsets[-1], dtype=places.dtype)
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(data.take(places)))
