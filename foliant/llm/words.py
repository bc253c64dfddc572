"""Words of a batch of texts as numpy arrays of hashes, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09-0x0D. All multi-byte characters of UTF-8 are word
characters, so the bytes of a batch can be cut without decoding them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Odd 64-bit constants of the hashes below.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD1342543DE82EF95)
#: Bytes of a run from which it is hashed on its own.
LONG_RUN = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of the texts in them); a null text has no bytes."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the non-empty byte runs, eight bytes a step; long runs are hashed one by one."""
    out = (ends - starts).astype(np.uint64) * WORD_BASE
    if not len(out):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    long = np.flatnonzero(ends - starts > LONG_RUN)
    active = np.flatnonzero(ends - starts <= LONG_RUN)
    place, left = starts[active], (ends - starts)[active]
    while len(active):
        chunk = eight[place]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h = (out[active] ^ chunk) * BYTE_BASE
        out[active] = h ^ (h >> np.uint64(32))
        more = left > 8
        active, place, left = active[more], place[more] + 8, left[more] - 8
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix(out)


class Words:
    """``starts``, ``ends`` (byte places), ``hashes`` of all words; ``bounds``: the words of text i are bounds[i]:bounds[i+1]."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(texts)
        if lower:
            self.data = _LOWER[self.data]
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = ~_SPACE[self.data]
        # a word also ends where its text ends
        cuts = self.offsets[1:-1]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[cuts] = True
        before, here = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(here & (~before | edge))
        self.ends = np.flatnonzero(before & (~here | edge))
        self.hashes = run_hashes(self.data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` hashes, at its first place; by doubling, so about log2(size) steps."""
    out = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    if not len(out):
        return out
    done, base = 0, WORD_BASE
    part, length, power = hashes, 1, base  # part: hashes of runs of `length`; power: base ** length
    left, total = size, None
    while left:
        if left & 1:
            piece = part[done : done + len(out)]
            total = piece if total is None else total * power + piece
            done += length
        left >>= 1
        if left:
            part = part[:-length] * power + part[length:]
            with np.errstate(over="ignore"):
                power = power * power
            length *= 2
    return mix(total + np.uint64(size))


def whole_windows(bounds: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Places where a run of ``size`` words lies inside one text."""
    inside = np.zeros(max(0, n_words - size + 1), bool)
    for_start = np.repeat(bounds[1:], np.diff(bounds))[: len(inside)]
    inside[:] = np.arange(len(inside)) + size <= for_start
    return np.flatnonzero(inside)
