"""Words, shingles and lines of many texts at once, as numpy arrays over their bytes.

A text is UTF-8; word borders are ASCII characters, so bytes tell words apart. Words are
named by 64-bit hashes of their bytes, lines by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_ROLL = _U(0xD1342543DE82EF95)
_FULL = _U(0xFFFFFFFFFFFFFFFF)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that end at ASCII white space.
PLAIN = np.ones(256, dtype=bool)
PLAIN[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words made of digits, small letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_string array without nulls, and where each text begins and ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where a text begins."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(mask) + 1, bool)
    cut[offsets] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | cut[1:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashed(parts: np.ndarray, sizes: np.ndarray, part_of: Callable[[np.ndarray, int], np.ndarray],
            whole: Callable[[int], bytes], most: int) -> np.ndarray:
    """64-bit hashes of spans that consist of ``parts`` 64-bit values each. Each value goes
    through ``mix`` with all before it, so no relation between two spans carries over to
    their hashes; spans of more than ``most`` values are hashed as ``whole`` bytes."""
    out = mix(sizes.astype(_U) * _BASE + _BASE)
    at = np.arange(len(out))
    for k in range(most):
        at = at[parts[at] > k]
        if not len(at):
            break
        out[at] = mix(out[at] ^ part_of(at, k)) + _BASE
    for i in np.flatnonzero(parts > most).tolist():
        out[i] = int.from_bytes(blake2b(whole(i), digest_size=8).digest(), "little")
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of spans, eight bytes at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts

    def part(at: np.ndarray, k: int) -> np.ndarray:
        rest = np.minimum(sizes[at] - 8 * k, 8).astype(_U)
        return eight[starts[at] + 8 * k] & (_FULL >> (_U(64) - _U(8) * rest))

    return _hashed((sizes + 7) >> 3, sizes, part, lambda i: data[starts[i]:ends[i]].tobytes(), 4)


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the values in spans, in their order."""
    sizes = ends - starts
    return _hashed(sizes, sizes, lambda at, k: values[starts[at] + k],
                   lambda i: values[starts[i]:ends[i]].tobytes(), 32)


def wide_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of a 128-bit hash of the bytes of spans."""
    held = data.tobytes()
    made = b"".join([blake2b(held[a:b], digest_size=16).digest()
                     for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    both = np.frombuffer(made, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


class Words:
    """Words of a column: ``starts``/``ends`` in ``data``; text i has words first[i]:first[i+1]."""

    def __init__(self, column: pa.Array, kind: np.ndarray, lower: bool):
        self.data, self.offsets = flat(column)
        if lower:
            self.data = LOWER[self.data]
        self.starts, self.ends = runs(kind[self.data], self.offsets)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))


class Lines:
    """Lines of the texts of ``words``: text i has lines first[i]:first[i+1], one at least.

    ``full`` tells which have a word; line j's words are w0[j]:w1[j].
    """

    def __init__(self, words: Words):
        offsets, n = words.offsets, len(words.counts)
        breaks = np.flatnonzero(words.data == 10)
        own = per_text(np.searchsorted(offsets, breaks, "right") - 1, n) + 1
        self.words, self.counts = words, own
        self.first = np.concatenate([[0], np.cumsum(own)])
        self.doc = np.repeat(np.arange(n), own)
        opens, closes = np.ones(len(self.doc), bool), np.ones(len(self.doc), bool)
        opens[self.first[:-1]] = closes[self.first[1:] - 1] = False
        self.begins, self.ends = np.zeros(len(opens), np.int64), np.zeros(len(opens), np.int64)
        self.begins[~opens], self.begins[opens] = offsets[:-1], breaks + 1
        self.ends[~closes], self.ends[closes] = offsets[1:], breaks
        self.w0 = np.searchsorted(words.starts, self.begins)
        self.w1 = np.searchsorted(words.starts, self.ends)
        self.full = self.w1 > self.w0

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The halves of a 128-bit hash of each line with a word, from its first word to its
        last one and with A-Z lower-cased."""
        words = self.words
        a, b = words.starts[self.w0[self.full]], words.ends[self.w1[self.full] - 1]
        return wide_hashes(LOWER[words.data], a, b)


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n values from each place on (the last n - 1 places: of fewer)."""
    out = hashes.copy()
    for k in range(1, n):
        out *= _ROLL
        out[:max(0, len(out) - k)] += hashes[k:]
    return mix(out + _U(n))


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Places of 0..n-1 that lie in a span of ``width`` from one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values in the order of their texts as one list per text."""
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(values).cast(kind)).cast(pa.list_(kind))


def per_text(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, minlength=n).astype(np.int64)
