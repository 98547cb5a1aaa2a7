"""Packing by powers of two: each document is cut into pieces of binary lengths, and pieces of one length make a bucket.

A document of T tokens has T // most pieces of `most` tokens, then one piece for each binary digit of the rest, longest first. A piece is a
sequence by itself, so no sequence crosses documents and none is padded: a batch takes sequences of one bucket. Sequences are numbered bucket by bucket, longest first,
without gaps, so a bucket is a range of numbers (`buckets`).

Token ids come from words between white space, which no token crosses, and the signs at their ends apart: each distinct piece of a task is encoded once, by the tokenizer's library, and the ids of a
slice of texts are gathered from those by array operations. A task keeps some WORDS distinct pieces at most (about 50 MB) and forgets them when it ends.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import as_bytes, lean, ready, slices, table, typed, written
from ._words import ALNUM, LETTERS, SPACED, span_hashes, spans_of
from .bpe import tokenizer_path

LONGEST, END, WORDS = 4096, 2, 1 << 20
#: Pieces that go to the tokenizer at once.
TOGETHER = 1 << 14



#: What is known of a tokenizer whose words are cut further: how it normalises and splits.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII = LETTERS.copy()
_ASCII[0x80:] = False
_ALNUM = ALNUM.copy()
_ALNUM[0x80:] = False
#: Second bytes of the letters U+00C0 to U+00FF, whose first is 0xC3.
_LATIN = np.zeros(256, bool)
_LATIN[[i for i in range(0x80, 0xC0) if i not in (0x97, 0xB7)]] = True


class Pieces:
    """Pieces of a list of texts that can be encoded one by one: buf the joined bytes, start, end, hash and plain by piece, ptr by text: pieces of text i are ptr[i]:ptr[i+1].

    A piece is a word between white space. Where signs are given, up to eight of them at the end of a word are a piece of their own if an ASCII letter or digit or a letter of Latin-1 stands before;
    a piece of such letters alone is plain, and its A-Z are lower-cased.
    """

    def __init__(self, texts: list[bytes], signs: np.ndarray | None):
        self.buf = b" ".join(texts) + b" "
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=at[1:])
        self.start, self.end = spans_of(self.buf, SPACED)
        self.plain = np.zeros(len(self.start), bool)
        if signs is not None:
            self._cut(signs)
        self.hash = span_hashes(self.buf, self.start, self.end)
        self.ptr = np.searchsorted(self.start, at)

    def _cut(self, signs: np.ndarray) -> None:
        data = np.frombuffer(self.buf, np.uint8).copy()
        letter = _ASCII[data]
        second = np.flatnonzero(_LATIN[data[1:]] & (data[:-1] == 0xC3)) + 1
        letter[second] = letter[second - 1] = True
        core = self.end.copy()
        for _ in range(8):
            on = np.flatnonzero(core > self.start)
            on = on[signs[data[core[on] - 1]]]
            if not len(on):
                break
            core[on] -= 1
        last = core - 1
        tail = np.flatnonzero((core < self.end) & (core > self.start) & (letter[last] | _ALNUM[data[last]]))
        self.start, core_end = np.insert(self.start, tail + 1, core[tail]), self.end.copy()
        core_end[tail] = core[tail]
        self.end = np.insert(core_end, tail + 1, self.end[tail])
        other = np.flatnonzero(~letter & SPACED[data])
        self.plain = np.searchsorted(other, self.start) == np.searchsorted(other, self.end)
        capital = np.flatnonzero((data >= 0x41) & (data <= 0x5A))
        capital = capital[self.plain[np.searchsorted(self.start, capital, "right") - 1]]
        data[capital] |= 0x20
        self.buf = data.tobytes()

    def joined(self, i: np.ndarray) -> str:
        """The pieces named, with a space between."""
        size = self.end[i] - self.start[i] + 1
        to = np.cumsum(size)
        out = np.frombuffer(self.buf, np.uint8)[np.arange(size.sum()) + np.repeat(self.start[i] - (to - size), size)]
        out[to - 1] = 0x20
        return out[:-1].tobytes().decode("utf-8", "replace")


class Encoder:
    """Ids of many texts at once. Tokens of the vocabulary never hold space or 0x09-0x0D, and neither lower-casing nor composition looks across them, so words between them are encoded one by one.

    A tokenizer that lower-cases and splits as the bundled one does never joins a letter or digit with the sign after it, so signs at the end of words are pieces of their own, and a piece of letters
    alone is one word to it: many of those go to it as one text, which it encodes in half the time. Signs that stand in added tokens aren't cut off. Other tokenizers get whole words.
    """

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.signs = signs_of(spec)
        self._clear()

    def _clear(self) -> None:
        """Forgets all pieces. hash: of each known piece, sorted; start and size: where its ids are in `ids`."""
        self.hash, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.held = np.zeros(1 << 16, np.uint32), 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hash, hashes)
        known = at < len(self.hash)
        known[known] = self.hash[at[known]] == hashes[known]
        return at, known

    def _encoded(self, pieces: Pieces, i: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces named, one after another, and how many each has."""
        ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(i), TOGETHER):
            text = pieces.joined(i[k : k + TOGETHER])
            got = self.tokenizer.encode(text if plain else text.split(" "), is_pretokenized=not plain, add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            size.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(i[k : k + TOGETHER])))
        return np.concatenate(ids), np.concatenate(size)

    def _learn(self, pieces: Pieces, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The place of each distinct piece among the known ones; new ones are encoded."""
        if len(self.hash) > WORDS:
            self._clear()
        at, known = self._find(hashes)
        if known.all():
            return at
        new = np.flatnonzero(~known)
        plain = pieces.plain[first[new]]
        start, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for kind in (True, False):
            on = np.flatnonzero(plain == kind)
            ids, size[on] = self._encoded(pieces, first[new[on]], kind)
            while self.held + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
            self.ids[self.held : self.held + len(ids)] = ids
            start[on] = self.held + np.cumsum(size[on]) - size[on]
            self.held += len(ids)
        self.hash, self.start, self.size = (np.insert(old, at[new], more) for old, more in ((self.hash, hashes[new]), (self.start, start), (self.size, size)))
        return np.searchsorted(self.hash, hashes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin."""
        w = Pieces(texts, self.signs)
        hashes, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        piece = self._learn(w, hashes, first)[inverse]
        n = self.size[piece]
        end = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(end[-1]) + np.repeat(self.start[piece] - end[:-1], n)
        return self.ids[at], end[w.ptr]


def signs_of(spec: bytes) -> np.ndarray | None:
    """By byte, the ASCII signs that may be cut off from words of a tokenizer file; None if it isn't known to lower-case and split as the bundled one."""
    given = json.loads(spec)
    normal, split = given.get("normalizer") or {}, given.get("pre_tokenizer") or {}
    cut = (split.get("pretokenizers") or [{}])[0]
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    if normal.get("normalizers") != _NORMAL or cut != {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True} or split["pretokenizers"][1:] != [byte_level]:
        return None
    added = given.get("added_tokens") or []
    sign = re.compile(r"[!-/:-@\[-`{-~]")
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or not sign.search(t["content"]) for t in added):
        return None
    out = np.zeros(256, bool)
    out[[b for b in range(0x21, 0x7F) if sign.match(chr(b)) and not any(chr(b) in t["content"] for t in added)]] = True
    return out


def lengths(tokens: int, most: int = LONGEST) -> list[int]:
    """Lengths of a document's pieces, in order: as many of `most` (a power of two) as there are, then the binary digits of the rest."""
    rest = tokens % most
    return [most] * (tokens // most) + [1 << k for k in reversed(range(most.bit_length())) if rest >> k & 1]


def _cut(shared, most: int, end: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        last = np.array([] if end is None else [end], np.uint32)
        for whole in batches:
            for b in slices(whole, "text"):
                ids, ptr = encoder.encode(as_bytes(b.column("text")))
                ids = ids.astype("<u4", copy=False)
                row, start, size, piece, tokens = [], [], [], [], []
                for k in range(b.num_rows):
                    own = np.concatenate([ids[ptr[k] : ptr[k + 1]], last]).astype("<u4", copy=False).tobytes()
                    at = 0
                    for n in lengths(len(own) // 4, most):
                        row.append(k)
                        start.append(at)
                        size.append(n)
                        piece.append(own[4 * at : 4 * (at + n)])
                        tokens.append(len(own) // 4)
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(piece, pa.binary()), pa.array(tokens, pa.int64())],
                    ["id", "start", "length", "ids", "doc_tokens"],
                )

    return lean(run)


def decompose(docs: DataFrame, tokenizer: str, most: int = LONGEST, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, ids, doc_tokens): the pieces of every row of docs, of 1, 2, 4 ... `most` tokens.

    ids: the piece's token ids packed as little-endian unsigned 32-bit integers. start: ids of the document before it. doc_tokens: ids of the whole document, the id `end` that closes it included
    (end None: nothing closes it, and a document without tokens has no piece). tokenizer: path of a tokenizer file whose tokens don't hold white space. most: a power of two.

    Null and empty texts are the closing id alone, one piece of one token. A document of exactly `most` tokens is one piece. Very long texts are cut like others. Null ids and
    repeated rows each have their pieces. No rows, no result rows. Further columns, whatever their names, are not read.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    spark = ready(docs.sparkSession)
    with open(tokenizer, "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = typed(base.schema["id"].dataType, "start long, length long, ids binary, doc_tokens long")
    return base.mapInArrow(_cut(spec, most, end), kind).withColumnRenamed("id", id_col)


def numbered(pieces: DataFrame) -> DataFrame:
    """pieces, each with sequence_id and offset (0): numbers without gaps, bucket by bucket, longest first. Columns named _part, _at, _n and _before are taken here.

    The pieces are written once into the shared folder. Numbers follow from counts by (length, part of the written table), which are as many as there are parts, so no bucket
    meets in one task. Repeated pieces each have their number. No rows, no result rows.
    """
    held = written(pieces.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = held.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    totals = counts.groupBy("length").agg(F.sum("_n").alias("_n"))
    longer = totals.select(F.col("length").alias("_longer"), F.col("_n").alias("_more"))
    base = totals.select("length").join(F.broadcast(longer), F.col("_longer") > F.col("length"), "left").groupBy("length").agg(F.coalesce(F.sum("_more"), F.lit(0)).alias("_base"))  # a row for each power of two
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_before")).join(F.broadcast(base), "length")
    order = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_at"))
    own = held.withColumn("_n", order).join(first, ["length", "_part"])
    return own.select(*(f"`{c}`" for c in pieces.columns), (F.col("_base") + F.col("_before") + F.col("_n") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def buckets(sequences: DataFrame) -> DataFrame:
    """(length, sequences, first_id, last_id) of each bucket of numbered(): what a loader needs to draw batches of one length."""
    return sequences.groupBy("length").agg(F.count("*").alias("sequences"), F.min("sequence_id").alias("first_id"), F.max("sequence_id").alias("last_id"))


def write_buckets(sequences: DataFrame, path: str) -> None:
    """A folder for each length. Rows stay in the tasks that hold them, so a large bucket is many files."""
    sequences.write.partitionBy("length").parquet(path)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = decompose(table(spark, sf_dir, "documents"), tokenizer_path())
    return numbered(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
