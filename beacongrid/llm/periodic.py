"""Runs of periodic words by the linear-time tandem repeat method of Gusfield and Stoye (2004).

A text is a sequence of words, compared by 64-bit hashes. A run of length >= max(least, times * q) and period q >= 1 has equal windows of
least - least // times words at distance q, and every word of it lies in such a window, so only stretches of words covered by windows that
occur again nearby are looked at; all others hold no run. The stretches of a slice of texts are put one after another, with separators that occur once, and then:

1.  Basic factors are numbered for every power of two (Karp, Miller and Rosenberg 1972), which gives the suffix array and the longest common
    extension of any two places, forwards and backwards, in a few array operations.
2.  The text falls into its LZ blocks. The right half of a square's leftmost occurrence touches two blocks at most, so extensions around
    block borders, one for each border and period, find squares that cover every leftmost occurrence.
3.  The suffix tree (as intervals of the suffix array, with suffix links) holds a mark for each of these squares. From each mark a walk along suffix links, a word
    at a time, marks the square's rotations until one is marked already or occurs nowhere: then the vocabulary of squares is complete. Squares whose half is itself a
    repetition are left out from the start, as all of their rotations are such too, and shorter ones stand for them; so occurrences stay within n log n.
4.  The leaves below a mark are where its square occurs. Squares of one period at neighbouring places merge into a run, whose end then is known.

A stretch takes some 400 bytes a word in the task that reads its text; texts without a stretch take nothing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import as_bytes, lean, ready, slices, table, typed
from ._words import SPACED, Words, mix, windows

LEAST, TIMES = 24, 3
#: Words of stretches that are worked at once; a longer stretch is worked alone.
TOGETHER = 1 << 16


def stretches(words: np.ndarray, ptr: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """[start, end) of stretches of words outside which no run lies; text i has words ptr[i]:ptr[i+1]."""
    wide, n = least - least // times, len(words)
    if n < least:
        return []
    own = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    key = mix(windows(words, wide) + own[: n - wide + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    whole = np.flatnonzero(own[: n - wide + 1] == own[wide - 1 :])
    order = whole[np.argsort(key[whole], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    room, starts = np.diff(ptr)[own[a]], None
    for _ in range(8):  # any number of turns leaves every run inside; more turns leave less beside them
        good = (b - a) * times <= room
        if starts is not None and good.all():
            break
        a, b = a[good], b[good]
        change = np.zeros(n + 1, np.int32)
        for at in (a, b):
            np.add.at(change, at, 1)
            np.add.at(change, at + wide, -1)
        on = np.cumsum(change[:-1]) > 0
        begins = on.copy()
        begins[1:] &= ~on[:-1] | (own[1:] != own[:-1])
        which = np.cumsum(begins) - 1
        starts = np.flatnonzero(begins)
        if not len(starts):
            return []
        sizes = np.bincount(which[on], minlength=len(starts))
        room = np.where(which[a] == which[b], sizes[which[a]], 0)
    return [(s, s + n) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n >= least]


class Factors:
    """Numbers of the basic factors of s, its suffix array and extensions."""

    def __init__(self, s: np.ndarray):
        n = self.n = len(s)
        now = np.unique(s, return_inverse=True)[1].astype(np.int64)
        self.levels, step = [], 1
        while True:
            self.levels.append(np.append(now, -1).astype(np.int32))
            if now.max() == n - 1:
                break
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = now[step:] + 1
            now = np.unique(now * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
            step *= 2
        self.rank = now
        self.sa = np.empty(n, np.int64)
        self.sa[now] = np.arange(n)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from places i and j (different ones, n included) on."""
        i, j = i.copy(), j.copy()
        first = i.copy()
        for k in reversed(range(len(self.levels) - 1)):
            step = (self.levels[k][i] == self.levels[k][j]).astype(np.int64) << k
            i += step
            j += step
        return i - first

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words up to places i and j (different ones, -1 included), both counted."""
        i, j = i + 1, j + 1
        last = i.copy()
        for k in reversed(range(len(self.levels) - 1)):
            p, q = i - (1 << k), j - (1 << k)
            step = ((p >= 0) & (q >= 0) & (self.levels[k][np.maximum(p, 0)] == self.levels[k][np.maximum(q, 0)])).astype(np.int64) << k
            i -= step
            j -= step
        return last - i


def lz_blocks(f: Factors) -> np.ndarray:
    """Where the LZ blocks start: each is the longest factor that also starts earlier (the two may overlap), or one new word; n at the end."""
    before, after, stack = [-1] * f.n, [-1] * f.n, []
    for i in f.sa.tolist():
        while stack and stack[-1] > i:
            after[stack.pop()] = i
        if stack:
            before[i] = stack[-1]
        stack.append(i)
    at, longest = np.arange(f.n), np.zeros(f.n, np.int64)
    for other in (np.array(before), np.array(after)):
        has = other >= 0
        longest[has] = np.maximum(longest[has], f.ahead(at[has], other[has]))
    size, starts, i = longest.tolist(), [], 0
    while i < f.n:
        starts.append(i)
        i += size[i] or 1
    return np.array([*starts, f.n])


def _each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, 1..count) for every index."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + 1


def covering_squares(f: Factors) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of primitive squares, at the start of the repetition around each block border; every primitive square's leftmost occurrence lies in such a repetition."""
    b = lz_blocks(f)
    here, end, then = b[:-1], b[1:], np.append(b[2:], f.n)
    of, k = _each(then - here)  # the right half reaches the block's end
    good = end[of] >= k
    of, k = of[good], k[good]
    e = end[of]
    found = [(e - k - (back := f.back(e - k - 1, e - 1)), k, f.ahead(e - k, e) + back)]
    of, k = _each(end - here)  # the right half lies in the block, the left one begins before it
    h = here[of]
    found.append((h - (back := f.back(h - 1, h + k - 1)), k, f.ahead(h, h + k) + back))
    start, half, matched = (np.concatenate(x) for x in zip(*found, strict=True))
    some = matched >= half
    start, half = np.unique(np.stack([start[some], half[some]]), axis=1) if some.any() else (start[:0], half[:0])
    return _primitive(f, start, half)


def _primitive(f: Factors, start: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squares whose half isn't itself a repetition of something shorter."""
    if not len(half):
        return start, half
    factor = np.zeros(int(half.max()) + 1, np.int64)  # a prime factor of each number
    for p in range(2, len(factor)):
        if not factor[p]:
            factor[p::p] = p
    good, rest = np.ones(len(half), bool), half.copy()
    while len(on := np.flatnonzero(rest > 1)):
        p = factor[rest[on]]
        d = half[on] // p
        good[on[f.ahead(start[on], start[on] + d) >= 2 * half[on] - d]] = False
        rest[on] //= p
    return start[good], half[good]


class Tree:
    """The suffix tree of s as intervals of its suffix array. Inner nodes are 0 (the root) to m - 1, the leaf of rank r is m + r."""

    def __init__(self, f: Factors):
        n, self.f = f.n, f
        shared = f.ahead(f.sa[:-1], f.sa[1:])
        depth, left, right, up, leaf, stack = [0], [0], [n - 1], [0], [0] * n, [0]
        for r, d in enumerate([*shared.tolist(), 0]):
            if depth[stack[-1]] < d:
                leaf[r] = len(depth)
            else:
                leaf[r] = stack[-1]
                while depth[stack[-1]] > d:
                    v = stack.pop()
                    right[v] = r
                    if depth[stack[-1]] < d:
                        up[v] = len(depth)
                        depth.append(d), left.append(left[v]), right.append(n - 1), up.append(0)
                        stack.append(up[v])
                    else:
                        up[v] = stack[-1]
                continue
            depth.append(d), left.append(r), right.append(n - 1), up.append(0)
            stack.append(leaf[r])
        m = self.m = len(depth)
        self.least = [np.concatenate([[-1], shared, [-1]])]  # least[k][r]: of the common lengths of ranks r - 1 and r, to 2**k further on
        while (1 << len(self.least)) <= n:
            a, k = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(a[:-k], a[k:]))
        self.nodes = np.array(left) * n + right
        self.by_span = np.argsort(self.nodes)
        self.nodes = self.nodes[self.by_span]
        d, l = np.array(depth), np.array(left)
        self.link = np.zeros(m, np.int64)
        deep = np.flatnonzero(d > 1)
        self.link[deep] = self.place(f.sa[l[deep]] + 1, d[deep] - 1)
        self.link = self.link.tolist()
        parent, low = np.array(up[1:] + leaf), np.concatenate([l[1:], np.arange(n)])
        order = np.lexsort((low, parent))
        begin = f.sa[low] + d[parent]
        self.kids_of = np.searchsorted(parent[order], np.arange(m + 1)).tolist()
        self.low, self.kid = low[order].tolist(), np.concatenate([np.arange(1, m), m + np.arange(n)])[order].tolist()
        self.first = f.levels[0][begin][order].tolist()
        self.up = up + leaf
        self.left, self.right = left + list(range(n)), right + list(range(n))
        self.depth = depth + (n - f.sa).tolist()

    def place(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The upper end of what starts with the `size` words (one at least) at place `at`: its node, or the node below it on its edge."""
        l = self.f.rank[at].copy()
        r = l.copy()
        for k in reversed(range(len(self.least))):
            t, step = self.least[k], 1 << k
            l -= step * ((l - step + 1 >= 0) & (t[np.clip(l - step + 1, 0, len(t) - 1)] >= size))
            r += step * ((r + 1 < len(t)) & (t[np.clip(r + 1, 0, len(t) - 1)] >= size))
        found = self.by_span[np.minimum(np.searchsorted(self.nodes, l * self.f.n + r), self.m - 1)]
        return np.where(l == r, self.m + l, found)

    def rotations(self, start: np.ndarray, half: np.ndarray) -> dict[tuple[int, int], int]:
        """The vocabulary: (node, half) of every square that a walk along suffix links from the given ones meets."""
        sa, rank, word = self.f.sa.tolist(), self.f.rank.tolist(), self.f.levels[0].tolist()
        depth, left, up, link, kids, m = self.depth, self.left, self.up, self.link, self.kids_of, self.m
        marked: dict[tuple[int, int], int] = {}
        for u, q in zip(self.place(start, 2 * half).tolist(), half.tolist(), strict=True):
            size = 2 * q - 1
            while (u, q) not in marked:
                marked[u, q] = 1
                i = sa[left[u]]
                to, w = rank[i + 1], link[up[u]]
                while depth[w] < size:
                    w = self.kid[bisect_right(self.low, to, kids[w], kids[w + 1]) - 1]
                if depth[w] > size:
                    if word[sa[left[w]] + size] != word[i]:
                        break
                    u = w
                elif w < m:
                    at = bisect_left(self.first, word[i], kids[w], kids[w + 1])
                    if at == kids[w + 1] or self.first[at] != word[i]:
                        break
                    u = self.kid[at]
                else:
                    break
        return marked


def repetitions(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every maximal repetition of s of length >= 2 * period, by period and start. Each s ends in a number that occurs once."""
    f = Factors(s)
    start, half = covering_squares(f)
    if not len(start):
        return (start,) * 3
    tree = Tree(f)
    marked = np.array(list(tree.rotations(start, half)), np.int64)
    low = np.array(tree.left)[marked[:, 0]]
    of, k = _each(np.array(tree.right)[marked[:, 0]] - low + 1)
    at, q = f.sa[low[of] + k - 1], marked[of, 1]
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (q[1:] != q[:-1]))
    first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(at)) - 1
    return at[first], at[last] + 2 * q[first] - at[first], q[first]


def runs_of(words: np.ndarray, ptr: np.ndarray, least: int = LEAST, times: int = TIMES) -> dict[int, list[tuple[int, int, int]]]:
    """Text number -> its runs (start, length, period), by start and period; texts without a run are left out."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    held: list[tuple[int, int]] = []

    def settle() -> None:
        sizes = np.array([e - s for s, e in held])
        known = np.unique(np.concatenate([words[s:e] for s, e in held]), return_inverse=True)[1]
        ends = np.cumsum(sizes)
        joined = np.insert(known, ends, len(known) + np.arange(len(held)))
        begin = ends - sizes + np.arange(len(held))
        start, length, period = repetitions(joined)
        long = (length >= least) & (length >= times * period)
        for a, n, q in zip(start[long].tolist(), length[long].tolist(), period[long].tolist(), strict=True):
            k = int(np.searchsorted(begin, a, "right")) - 1
            at = held[k][0] + a - int(begin[k])
            text = int(np.searchsorted(ptr, at, "right")) - 1
            out.setdefault(text, []).append((at - int(ptr[text]), n, q))
        held.clear()

    total = 0
    for s, e in stretches(words, ptr, least, times):
        if held and total + e - s > TOGETHER:
            settle()
            total = 0
        held.append((s, e))
        total += e - s
    if held:
        settle()
    return {k: sorted(v, key=lambda r: (r[0], r[2])) for k, v in out.items()}


def _runs(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                texts = as_bytes(b.column("text"))
                w = Words(texts, SPACED, lower=False)
                found, collapsed, best = runs_of(w.hash, w.ptr, least, times), [], []
                for k, text in enumerate(texts):
                    words, runs = text.split(), found.get(k, ())
                    if runs:
                        kept = np.ones(len(words), bool)
                        for start, length, period in runs:
                            kept[start + period : start + length] = False
                        words = [words[i] for i in np.flatnonzero(kept).tolist()]
                    collapsed.append(b" ".join(words))
                    best.append(min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None)
                row = lambda r: {"start": r[0], "length": r[1], "period": r[2]}
                kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
                listed = pa.array([[row(r) for r in found.get(k, ())] for k in range(len(texts))], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([b.column("id"), listed, pa.array([r and row(r) for r in best], kind), pa.array(collapsed, pa.binary()).cast(pa.string())], ["id", "runs", "strongest", "collapsed"])

    return lean(run)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(id_col, runs, strongest, collapsed), one row per row of docs.

    Words are runs of anything but space and 0x09-0x0D, compared as they stand, numbered from 0. runs: array of (start, length, period) of every stretch of words with smallest
    period `period`, of length max(least, times * period) or more (times is 2 or more), that no neighbouring word extends, by start and period. strongest: the one of the greatest
    length / period; of equal ones that of the smallest start, then period; null without a run. collapsed: the words joined by one space, without those that a run holds after its first `period` words.

    Null and empty texts and texts without words have no run and an empty collapsed text. Very long texts are read whole. Null ids and repeated rows each have their row. No rows, no result rows.
    Further columns, whatever their names, are not read.
    """
    ready(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return base.mapInArrow(_runs(least, times), typed(base.schema["id"].dataType, f"runs array<{run}>, strongest {run}, collapsed string")).withColumnRenamed("id", id_col)


@lean
def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In a tenth of the texts, by id, the words from some place on repeat the first of them, as the query's contract says."""
    for whole in batches:
        for b in slices(whole, "text"):
            out = as_bytes(b.column("text"))
            for k, name in enumerate(b.column("id").to_pylist()):
                h = zlib.crc32(str(name).encode()) if name is not None else 1
                words = out[k].split() if h % 10 == 0 else ()
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    head = words[a : a + p]
                    out[k] = b" ".join(words[:a] + (head * (n // p + 1))[: n - a])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.binary()).cast(pa.string())], ["id", "text"])


def planted(docs: DataFrame) -> DataFrame:
    """(id, text) of documents with periodic passages planted by id: let h be the CRC-32 of the id's decimal digits and g = h // 10. If h % 10 = 0 and there are n > 0 words, each word i >= a = g % n becomes
    word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). A null id plants nothing."""
    base = ready(docs.sparkSession) and docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(_planted, base.schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")), "id")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    top = F.col("strongest")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        F.expr("1000L * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
