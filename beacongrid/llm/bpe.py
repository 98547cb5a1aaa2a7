"""BPE encoding and decoding through a minimal acyclic transducer of frequent words, with exact merges for all others.

Words (letter runs) are counted over all texts; the most frequent ones are encoded once by exact merging and compiled into a minimal
automaton (Daciuk et al. 2000): states with equal right languages are one, so suffixes are shared, and each edge carries the
number of words before it, so a path yields the word's number and with it its ids. The automaton is one file in the shared folder, which
Spark hands to every executor; workers map it into memory. A piece that isn't in it is merged exactly, by rank, left first.
Which words are in the automaton changes speed only, never ids. What a task has looked up or merged it keeps while it runs, up to 2 * CACHE pieces (some 60 MB); nothing stays in the worker.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import struct
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, lean, ready, ship, slices, table
from ._words import LETTERS, Words

LEXICON, CACHE = 1 << 16, 100_000


def byte_chars() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself if it is printable Latin-1, else one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 0x100
    for b in range(256):
        out.append(chr(b if b in own else more))
        more += b not in own
    return out


class Merger:
    """Pieces of a tokenizer file with word ends, and exact merging."""

    def __init__(self, spec: bytes):
        given = json.loads(spec)
        model = given["model"]
        self.vocab: dict[str, int] = model["vocab"]
        own = {t: t for t in self.vocab}  # one copy of each string
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(own.get(a, a), own.get(b, b)): i for i, (a, b) in enumerate(pairs)}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.begins = os.path.commonprefix(list(self.special))
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.piece = regex.compile(given["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.chars = byte_chars()

    def pieces(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.piece.findall(text.lower())

    def tokens(self, piece: str) -> list[str]:
        """Tokens of one piece."""
        s = list(piece) if piece.isascii() and piece.isprintable() and " " not in piece else [self.chars[b] for b in piece.encode()]
        if not s:
            return []
        s[-1] += self.end
        return self._long(s) if len(s) > 64 else self._short(s)

    def _short(self, s: list[str]) -> list[str]:
        get, none = self.rank.get, len(self.rank)
        ranks = [get(p, none) for p in zip(s, s[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            s[i] += s.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = get((s[i], s[i + 1]), none)
            if i:
                ranks[i - 1] = get((s[i - 1], s[i]), none)
        return s

    def _long(self, s: list[str]) -> list[str]:
        """As _short, in n log n: a heap of (rank, place) over a linked list."""
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := self.rank.get((s[i], s[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = a + b, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.rank.get((s[x], s[y]))) is not None:
                    heapq.heappush(heap, (r, x, s[x], s[y]))
        return [x for x in s if x]

    def ids(self, piece: str) -> list[int]:
        return [self.vocab[t] for t in self.tokens(piece)]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic transducer of the words as one file: a head of seven counts and offsets, then int32 arrays and labels."""
    states: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # state, label, target
    free: list[int] = []

    def settle(n: int) -> None:
        """Ends of the path beyond n steps are complete: each becomes the known state of its right language, or a known one."""
        while len(path) > n:
            state, label, target = path.pop()
            key = (final[target], tuple(states[target].items()))
            same = known.get(key)
            if same is None:
                known[key] = target
            else:
                states[state][label] = same
                free.append(target)

    last = b""
    ordered = sorted(words)
    for w in ordered:
        n = 0
        while n < min(len(w), len(last)) and w[n] == last[n]:
            n += 1
        settle(n)
        at = path[-1][2] if path else 0
        for c in w[n:]:
            if free:
                new = free.pop()
                states[new], final[new] = {}, False
            else:
                new = len(states)
                states.append({})
                final.append(False)
            states[at][c] = new
            path.append((at, c, new))
            at = new
        final[at] = True
        last = w
    settle(0)
    order, number, stack = [], {}, [0]
    while stack:
        s = stack.pop()
        if s not in number:
            number[s] = len(order)
            order.append(s)
            stack.extend(states[s].values())
    count: dict[int, int] = {}
    walk = [(0, False)]
    while walk:
        s, done = walk.pop()
        if s in count:
            continue
        if done:
            count[s] = final[s] + sum(count[t] for t in states[s].values())
        else:
            walk.append((s, True))
            walk.extend((t, False) for t in states[s].values() if t not in count)
    first, label, target, skip = [0], [], [], []
    for s in order:
        ahead = int(final[s])
        for c, t in sorted(states[s].items()):
            label.append(c)
            target.append(number[t])
            skip.append(ahead)
            ahead += count[t]
        first.append(len(label))
    offset = np.concatenate([[0], np.cumsum([len(words[w]) for w in ordered])])
    ids = [i for w in ordered for i in words[w]]
    arrays = [np.array(x, "<i4") for x in (first, [int(final[s]) for s in order], label, target, skip, offset, ids)]
    return np.array([len(a) for a in arrays], "<i4").tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """The compiled file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        sizes, at, arrays = data[:28].cast("i"), 28, []
        for n in sizes:
            arrays.append(data[at : at + 4 * n].cast("i"))
            at += 4 * n
        self.first, self.final, self.label, self.target, self.skip, self.offset, self.id = arrays

    def find(self, word: bytes) -> list[int] | None:
        """Ids of a word; None if it isn't in the automaton."""
        first, label, target, skip = self.first, self.label, self.target, self.skip
        state = number = 0
        for c in word:
            b = first[state + 1]
            e = bisect_left(label, c, first[state], b)
            if e >= b or label[e] != c:
                return None
            number += skip[e]
            state = target[e]
        return self.id[self.offset[number] : self.offset[number + 1]].tolist() if self.final[state] else None


class Pieces(dict):
    """Packed ids and decoded bytes of pieces; from the automaton, or else merged. When CACHE pieces are held, those not met since the last time go."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None):
        super().__init__()
        self.merger, self.lexicon, self.old = merger, lexicon, {}

    def __missing__(self, piece: str) -> tuple[bytes, bytes]:
        out = self.old.get(piece)
        if out is None:
            ids = self.lexicon.find(piece.encode()) if self.lexicon else None
            ids = self.merger.ids(piece) if ids is None else ids
            out = (struct.pack(f"<{len(ids)}I", *ids), " ".join(self.merger.names[i] for i in ids).encode())
        if len(piece) < 100:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text in UTF-8."""
        m = self.merger
        if not m.split or m.begins not in text:
            found = [self[p] for p in m.pieces(text)]
        else:
            found = []
            for part in m.split.split(text):
                if part in m.special:
                    found.append((np.array([m.special[part]], "<u4").tobytes(), part.encode()))
                else:
                    found += [self[p] for p in m.pieces(part)]
        return b"".join([a for a, _ in found]), b" ".join([b for _, b in found])


def _encode(shared, name: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(Merger(shared.value), Lexicon(SparkFiles.get(name)) if name else None)
        for whole in batches:
            for b in slices(whole, "text"):
                got = [pieces.encode(t or "") for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(a) // 4 for a, _ in got], pa.int64()), pa.array([a for a, _ in got], pa.binary()), pa.array([d for _, d in got], pa.binary())],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    return lean(run)


@lean
def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that occur twice or more in a slice of a batch, with their counts."""
    for whole in batches:
        for b in slices(whole, "text", 8 << 20):
            w = Words(as_bytes(b.column("text")), LETTERS)
            _, first, n = np.unique(w.hash, return_index=True, return_counts=True)
            first, n = first[n > 1], n[n > 1]
            short = w.end[first] - w.start[first] < 64
            yield pa.RecordBatch.from_arrays([pa.array([w.text(i) for i in first[short].tolist()], pa.binary()), pa.array(n[short], pa.int64())], ["word", "n"])


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON) -> list[bytes]:
    """The most frequent words of all texts, at most `most`: all words of the count levels that fit."""
    with Scratch(docs.sparkSession) as scratch:
        counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_frequent, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = scratch.written(counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int")))
        least, held = None, 0
        for r in sorted(counts.groupBy("level").agg(F.count("*").alias("k")).collect(), reverse=True):
            held += r["k"]
            if held > most:
                break
            least = r["level"]
        return counts.where(F.col("level") >= least).select("word").toArrow()["word"].to_pylist() if least is not None else []


def bpe(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", lexicon: int = LEXICON) -> DataFrame:
    """(id_col, n_tokens, ids, decoded), one row per row of docs: ids packed as little-endian unsigned 32-bit integers, decoded UTF-8 bytes.

    tokenizer: path of a tokenizer file of byte-level BPE with word ends. Special tokens' strings in a text are those tokens. Null and empty texts have
    no ids. Null ids and repeated rows each have their row. No rows, no result rows. Further columns, whatever their names, are not read.
    """
    spark = ready(docs.sparkSession)
    with open(tokenizer, "rb") as f:
        spec = f.read()
    merger, known = Merger(spec), {}
    for w in frequent_words(docs, text_col, lexicon) if lexicon else []:
        piece = w.decode("utf-8", "ignore")
        if piece.encode() == w and merger.pieces(piece) == [piece]:
            known[w] = merger.ids(piece)
    name = ship(spark, [compile_lexicon(known)]) if known else None
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = base.mapInArrow(_encode(spark.sparkContext.broadcast(spec), name), f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(bpe(table(spark, sf_dir, "documents"), tokenizer_path()))
