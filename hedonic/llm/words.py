"""Vectorised word splitting and hashing of UTF-8 text, shared by the operators.

Everything works on bytes: the word classes in use are unions of ASCII classes
and "every byte from 0x80", so splitting bytes equals splitting code points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; bounds the 64-bit work arrays whatever a text's length.
CHUNK = 1 << 20

U64 = np.uint64
_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

#: Byte classes: runs of bytes outside the six ASCII white-space characters.
NON_SPACE = np.ones(256, bool)
NON_SPACE[list(_SPACE)] = False

#: Digits, letters and every byte from 0x80 (upper case counts, as it is lowered).
ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_a:_b + 1] = True

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the weak low bits of a polynomial hash."""
    h = h ^ (h >> U64(32))
    h = h * U64(0x9E3779B97F4A7C15)
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))
        return self.up, self.down


_BYTE_POWERS = Powers(0x5851F42D4C957F2D)
_BYTE_VALUES = _values(20240601)


@dataclass
class Words:
    """Words of several texts laid end to end."""

    data: np.ndarray  # uint8, texts each followed by one space
    doc_start: np.ndarray  # byte offset of each text, and the end of all
    start: np.ndarray  # byte span of each word
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def join_texts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by a space, and the offsets. Null is empty."""
    raw = [b"" if t is None else t.encode() if isinstance(t, str) else bytes(t) for t in texts]
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=at[1:])
    return np.frombuffer(b" ".join([*raw, b""]) if raw else b"", np.uint8), at


def split(data: np.ndarray, doc_start: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of bytes of the class ``is_word``; a space must not be in it."""
    return split_mask(data, doc_start, is_word[data])


def split_mask(data: np.ndarray, doc_start: np.ndarray, m: np.ndarray) -> Words:
    """Maximal runs of the bytes marked in ``m``, where the space after each text is not."""
    edge = np.flatnonzero(m[1:] != m[:-1]) + 1
    if len(m) and m[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]  # every text ends with a space, so runs end too
    return Words(data, doc_start, start, end, np.searchsorted(start, doc_start))


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The byte spans as Arrow strings; all together below 2 GB."""
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    if not len(at) or at[-1] >= 1 << 31:
        raise ValueError("spans of 2 GB or more")
    raw = data[np.arange(at[-1]) + np.repeat(start - at[:-1], size)]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw)))


def hash_words(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    out = np.empty(len(w.start), U64)
    i, n = 0, len(w.start)
    while i < n:
        lo = w.start[i]
        j = max(i + 1, int(np.searchsorted(w.end, lo + CHUNK, side="right")))
        hi = w.end[j - 1]
        up, down = _BYTE_POWERS.get(int(hi - lo) + 1)
        acc = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE_VALUES[w.data[lo:hi]] * up[:hi - lo], dtype=U64, out=acc[1:])
        s, e = w.start[i:j] - lo, w.end[i:j] - lo
        out[i:j] = (acc[e] - acc[s]) * down[s]
        i = j
    return mix(out + (w.end - w.start).astype(U64))


def batches(texts: list, limit: int):
    """Index ranges of consecutive texts of about ``limit`` characters; a longer text stands alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = 0 if t is None else len(t)
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)
