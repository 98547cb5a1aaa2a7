"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Items and documents become sequences of lower-cased words. The automaton's patterns are the items' windows of 13 words
(a shorter item is one window) over the numbers of the items' words. It is compiled into sorted arrays, written to one file in the shared
folder, which Spark hands to every executor, and mapped into memory by the workers. However many items there are, there is one automaton,
and every text is read once. Matches are word ranges, mapped back to code points of the original text.

A text's words are cut where two neighbours never follow each other in an item: no match crosses such a place, and no state but the root survives
it. What is left, in stretches of STRETCH words that overlap by one word less than a window, goes through the automaton side by side, one word a step.

The driver builds the arrays level by level, at some 250 bytes for each word of the items.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import as_bytes, lean, ready, ship, slices, table, typed
from ._words import ALNUM, Words

WINDOW, STRETCH = 13, 256

#: The arrays of a compiled automaton. Words are numbered from 1 as their hashes in vocab. State k + 1 is where edge k leads; an edge is state * wide + word, so edges
#: are sorted, level by level. links: the state of the longest proper suffix; hit: the nearest state on the way of links, itself included, that ends a window;
#: ends: states that do, of and item their items; follow: word * wide + word of neighbours in items; text and offset: the items' names.
ARRAYS = {"head": "<i8", "vocab": "<u8", "edge": "<i8", "follow": "<i8", "links": "<i4", "hit": "<i4", "depth": "<i4", "ends": "<i4", "of": "<i4", "item": "<i4", "offset": "<i8", "text": "u1"}


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for n[0] numbers, then those from start[1], and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def _go(edge: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether there are these edges, and the states they lead to."""
    if not len(edge):
        return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
    at = np.searchsorted(edge, key)
    return edge[np.minimum(at, len(edge) - 1)] == key, at + 1


def compile_automaton(items: list[tuple[str, str]], window: int) -> Iterator[bytes]:
    """The automaton of (name, text) items as a file: sizes, then ARRAYS, each from a multiple of 8 bytes on."""
    w = Words([t.encode() for _, t in items], ALNUM)
    vocab, size = np.unique(w.hash), np.diff(w.ptr)
    ids, wide = np.searchsorted(vocab, w.hash) + 1, len(vocab) + 1
    n = np.where(size > 0, size - np.minimum(window, size) + 1, 0)  # windows of each item
    own, at = np.repeat(np.arange(len(items)), n), _ranges(w.ptr[:-1], n)
    deep = np.minimum(window, size)[own]
    state, first, levels = np.zeros(len(at), np.int64), 1, []
    for d in range(int(deep.max(initial=0))):
        on = np.flatnonzero(deep > d)
        key, back = np.unique(state[on] * wide + ids[at[on] + d], return_inverse=True)
        state[on] = first + back
        levels.append((np.arange(first, first + len(key)), key))
        first += len(key)
    edge = np.concatenate([np.zeros(0, np.int64), *(k for _, k in levels)])
    links, hit, depth = np.zeros(first, np.int64), np.zeros(first, np.int64), np.zeros(first, np.int64)
    ends = np.unique(state)
    hit[ends] = ends
    for d, (level, key) in enumerate(levels):
        now, word, left = links[key // wide], key % wide, np.arange(len(level) if d else 0)
        while len(left):
            ok, to = _go(edge, now[left] * wide + word[left])
            links[level[left[ok]]] = to[ok]
            left = left[~ok]
            left = left[now[left] > 0]
            now[left] = links[now[left]]
        depth[level] = d + 1
        none = level[hit[level] == 0]
        hit[none] = hit[links[none]]
    pair = np.unique(np.stack([state, own], 1), axis=0) if len(state) else np.zeros((0, 2), np.int64)
    same = np.repeat(np.arange(len(items)), size)
    beside = np.flatnonzero(same[1:] == same[:-1])
    names = [name.encode() for name, _ in items]
    arrays = {
        "head": np.array([wide, deep.min() if len(deep) else 0, len(levels)]), "vocab": vocab, "edge": edge, "follow": np.unique(ids[beside] * wide + ids[beside + 1]), "links": links, "hit": hit, "depth": depth, "ends": ends,
        "of": np.searchsorted(pair[:, 0], np.append(ends, first)), "item": pair[:, 1], "offset": np.concatenate([[0], np.cumsum([len(x) for x in names])]), "text": np.frombuffer(b"".join(names), np.uint8),
    }
    yield np.array([len(arrays[k]) for k in ARRAYS], "<i8").tobytes()
    for k, kind in ARRAYS.items():
        data = arrays[k].astype(kind).tobytes()
        yield data + bytes(-len(data) % 8)


class Automaton:
    """The compiled file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        at = 8 * len(ARRAYS)
        for (k, kind), n in zip(ARRAYS.items(), data[:at].view("<i8").tolist(), strict=True):
            size = n * np.dtype(kind).itemsize
            setattr(self, k, data[at : at + size].view(kind))
            at += size + -size % 8
        self.wide, self.least, self.longest = self.head.tolist()

    def names_of(self, state: int) -> list[str]:
        """Names of the items of which a state ends a window."""
        i = int(np.searchsorted(self.ends, state))
        return [self.text[self.offset[k] : self.offset[k + 1]].tobytes().decode() for k in self.item[self.of[i] : self.of[i + 1]].tolist()]

    def _stretches(self, ids: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of the runs of words that follow each other in items, where they are as long as the shortest window."""
        joins, _ = _go(self.follow, ids[:-1] * self.wide + ids[1:])
        inner = ptr[1:-1]
        joins[inner[(inner > 0) & (inner < len(ids))] - 1] = False
        cut = np.flatnonzero(np.concatenate([[True], ~joins, [True]]))
        a, b = cut[:-1], cut[1:]
        keep = (b - a >= self.least) & (ids[a] > 0)
        return a[keep], b[keep]

    def scan(self, hashes: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences in the words of texts: first word, end and the state that ends the window, sorted; words of text i are ptr[i]:ptr[i+1]."""
        none = np.zeros(0, np.int64)
        if not self.longest or not len(hashes):
            return none, none, none
        ids = np.searchsorted(self.vocab, hashes)
        ids = np.where(self.vocab[np.minimum(ids, len(self.vocab) - 1)] == hashes, ids + 1, 0)
        a, b = self._stretches(ids, ptr)
        pieces = np.maximum(1, -(-(b - a - self.longest + 1) // STRETCH))
        first = np.repeat(a, pieces) + STRETCH * _ranges(np.zeros(len(a), np.int64), pieces)
        size = np.minimum(STRETCH + self.longest - 1, np.repeat(b, pieces) - first)
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        state, found = np.zeros(len(first), np.int64), []
        for step in range(int(size.max(initial=0))):
            left = np.arange(np.searchsorted(-size, -step))  # pieces of more than `step` words
            on, word = len(left), ids[first[left] + step]
            while len(left):
                ok, to = _go(self.edge, state[left] * self.wide + word[left])
                state[left[ok]] = to[ok]
                left = left[~ok]
                left = left[state[left] > 0]
                state[left] = self.links[state[left]]
            hit = self.hit[state[:on]]
            while (some := np.flatnonzero(hit)).size:
                found.append((first[some] + step + 1, hit[some].astype(np.int64)))
                hit = np.where(hit > 0, self.hit[self.links[hit]], 0)
        if not found:
            return none, none, none
        end, what = (np.concatenate(x) for x in zip(*found, strict=True))
        start = end - self.depth[what]
        order = np.lexsort((what, end, start))
        return start[order], end[order], what[order]


def merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of ranges, sorted by their start."""
    out: list[list[int]] = []
    for a, b in zip(first.tolist(), end.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scan(name: str, with_text: bool):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton(SparkFiles.get(name))
        for whole in batches:
            for b in slices(whole, "text"):
                w = Words(as_bytes(b.column("text")), ALNUM)
                start, end, state = machine.scan(w.hash, w.ptr)
                of = np.searchsorted(w.ptr, start, "right") - 1
                hits, items, spans = [0] * b.num_rows, [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
                for i in np.unique(of).tolist():
                    p, q = np.searchsorted(of, [i, i + 1])
                    ranges = merged(start[p:q], end[p:q])
                    hits[i] = sum(z - a for a, z in ranges)
                    items[i] = sorted({x for k in np.unique(state[p:q]).tolist() for x in machine.names_of(k)})
                    at, to = w.at[i : i + 2].tolist()
                    point = np.cumsum((np.frombuffer(w.buf, np.uint8, to - at, at) & 0xC0) != 0x80)
                    spans[i] = [{"start": int(point[w.start[a] - at]) - 1, "end": int(point[w.end[z - 1] - 1 - at])} for a, z in ranges]
                cols = {"id": b.column("id"), "text": b.column("text"), "n_words": pa.array(np.diff(w.ptr), pa.int64()), "n_hit": pa.array(hits, pa.int64()), "items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, span)}
                if not with_text:
                    del cols["text"]
                yield pa.RecordBatch.from_pydict(cols)

    return lean(run)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Occurrences of benchmark windows: (id_col, n_words, n_hit, items, spans), one row per row of docs.

    items: ids (as text, sorted, distinct) of items one of whose windows occurs; spans: the hit stretches in code points,
    end exclusive. Null and empty texts have no words and no hits; very long ones are read whole. Items without words have no windows; an item with a
    null id counts under the empty text; repeated items and ids count once, items of one text all. Repeated rows of docs each give a row. id_col may be of any type, a struct too; with_text hands the text through.
    No rows, no result rows; no items, no hits. Further columns, whatever their names, are not read.
    """
    spark = ready(docs.sparkSession)
    given = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("id"), F.col(item_text_col).cast("string").alias("text")).where("text is not null").distinct()
    rows = sorted((r["id"], r["text"]) for r in given.toLocalIterator())
    name = ship(spark, compile_automaton(rows, window))
    kind = docs.select(id_col).schema[0].dataType
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = base.mapInArrow(_scan(name, with_text), typed(kind, "text string, " * with_text + "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"))
    return out.withColumnRenamed("id", id_col)


def contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2), lambda i: array_to_string(ws[i:i + least(13, len(ws)) - 1], ' '))) AS g
  FROM b WHERE len(ws) > 0),
k AS (SELECT DISTINCT n FROM p),
g AS (
  SELECT doc_id, k.n AS n, unnest(range(1, len(ws) - k.n + 2)) AS i, unnest(list_transform(range(1, len(ws) - k.n + 2), lambda i: array_to_string(ws[i:i + k.n - 1], ' '))) AS g
  FROM d, k WHERE len(ws) >= k.n),
m AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p ON p.n = g.n AND p.g = g.g),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
