"""Words of many texts at once, as byte spans and 64-bit hashes, in array operations.

Both word classes used here are decided byte by byte in UTF-8 (all bytes from 0x80 belong to words), so texts
are never decoded. A word's hash is a polynomial over its bytes modulo 2**64, mixed with its length.
"""

from __future__ import annotations

from functools import cache

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_BLOCK = 1 << 20

#: Bytes of words: everything but space and 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words: 0-9, a-z (texts are lower-cased first), A-Z and everything from 0x80.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Bytes of words: a-z, A-Z and everything from 0x80.
LETTERS = ALNUM.copy()
LETTERS[[*range(0x30, 0x3A)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = np.full(n, _P, np.uint64), np.full(n, _PINV, np.uint64)
    p[0] = q[0] = 1
    return np.cumprod(p), np.cumprod(q)


def _span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = len(data)
    p, q = _powers(max(_BLOCK + 4096, 1 << int(size).bit_length() if size > _BLOCK + 4096 else 0))
    run = np.empty(size + 1, np.uint64)
    run[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:size], out=run[1:])
    h = (run[end] - run[start]) * q[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _blocks(data: bytes, member: np.ndarray):
    """Place, bytes, and starts and ends of words of each block of one buffer; blocks end between words."""
    whole = np.frombuffer(data, np.uint8)
    at = 0
    while at < len(whole):
        to = min(len(whole), at + _BLOCK)
        while to < len(whole):
            gap = np.flatnonzero(~member[whole[max(at, to - 4096) : to]])
            if len(gap):
                to = max(at, to - 4096) + int(gap[-1]) + 1
                break
            to = min(len(whole), to + _BLOCK)
        part = whole[at:to]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = member[part]
        edge = np.diff(inside)
        yield at, part, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = to


def words_of(data: bytes, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of one buffer, worked in blocks that end between words."""
    starts, ends, hashes = [], [], []
    for at, part, s, e in _blocks(data, member):
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(_span_hash(part, s, e))
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def spans_of(data: bytes, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of one buffer."""
    none = np.zeros(0, np.int64)
    found = [(none, none), *((s + at, e + at) for at, _, s, e in _blocks(data, member))]
    return np.concatenate([s for s, _ in found]), np.concatenate([e for _, e in found])


def span_hashes(buf: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of any spans of a buffer, sorted by start, worked in blocks; equal bytes hash alike wherever they stand."""
    whole, out, i = np.frombuffer(buf, np.uint8), [], 0
    while i < len(start):
        at = int(start[i])
        j = max(i + 1, int(np.searchsorted(start, at + _BLOCK)))
        to = int(end[i:j].max())
        out.append(_span_hash(whole[at:to], start[i:j] - at, end[i:j] - at))
        i = j
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Words:
    """Words of a list of texts: buf the joined bytes, start, end and hash by word, ptr by text: words of text i are ptr[i]:ptr[i+1]."""

    def __init__(self, texts: list[bytes], member: np.ndarray = SPACED, lower: bool = True):
        buf = b" ".join(texts) + b" "
        self.buf = buf.lower() if lower else buf
        self.at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.at[1:])
        self.start, self.end, self.hash = words_of(self.buf, member)
        self.ptr = np.searchsorted(self.start, self.at)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def prefix(self, n: int) -> np.ndarray:
        """Hash of each word's first n bytes (all of a shorter word)."""
        return span_hashes(self.buf, self.start, np.minimum(self.start + n, self.end))

    def text(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]]


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x100000001B3) + mix(words[k : len(words) - n + 1 + k] + np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    return mix(out)
