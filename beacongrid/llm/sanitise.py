"""PII removal by information-theoretic sanitisation (after Sanchez and Batet's C-sanitized).

Base: e-mail addresses, IP addresses, payment cards and phone numbers, found by pattern, and secrets: runs of key characters that mix letters and digits and whose
own information (length times entropy) is that of a random key. These are the protected entities. A term t near
an entity e reveals it as far as the corpus says: PMI(t, e) = log2(n(t, e) N / (n(t) n(e))), against what there is to reveal,
IC(e) = log2(N / n(e)). All four count distinct texts: those in which t stands near e, all, those with t, and those with e. So copies of one text count
once throughout, and one signature in many texts counts often. In place of n(t, e) / n(t) stands its lower confidence bound (Chernoff, at an error of
ERROR), so what few texts show counts for less, without a least count. A term that so discloses a share of at least `generalise` of IC(e) is generalised
where it stands near e; from `remove` on it is removed. A place that two entities flag differently is removed.

Most entities are mentioned once, and one text can show nothing for sure. So with `by_kind` each kind is an entity as well, of which every value of the kind is a mention: n(e) and n(t, e) then count the texts
with any value of the kind, and with t near one, and IC(e) is the kind's information, which is far less than a value's. A term that so discloses tells that such a value stands here, even where it is masked. Thresholds are
the same; what a term discloses of its value is judged as ever beside it.

Contexts exist only around entities, so only they are shuffled. n(t) is counted in one pass over all texts for the terms that would reach
`generalise` if they stood nowhere else; only texts with copies are shuffled for it. The table of terms is broadcast up to MOST_TERMS, as the flagged places
and the keys of texts with copies are up to MOST_PLACES; beyond that the pass counts every word and joins shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, as_bytes, joined, lean, ready, row_columns, row_of, slices, table, typed, written
from ._words import ALNUM, Words

KINDS = ("email", "ip", "card", "phone")
PROTECTED = (*KINDS, "secret")
#: Bits of a secret at least, and changes between letters and digits in it.
SECRET_BITS, SECRET_TURNS = 64.0, 4
WIDTH, ERROR, GENERALISE, REMOVE, MOST_TERMS, MOST_PLACES = 6, 0.01, 0.8, 0.95, 1 << 20, 300_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_TURN = re.compile(r"(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, from each @ outwards, so that a long run without @ costs nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((a, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def _parts_fit(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split("."))


def _luhn(s: str) -> bool:
    d = [int(c) for c in s if c.isdigit()]
    return 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of all base matches, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if text.count(".") >= 3:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _parts_fit(m[0])]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and _luhn(m[0])]
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def secrets(text: str) -> list[tuple[int, int]]:
    """Runs that look like keys: SECRET_TURNS changes between letters and digits, and SECRET_BITS of information by their own characters' frequencies."""
    out = []
    for m in _KEY.finditer(text):
        if len(_TURN.findall(m[0])) >= SECRET_TURNS:
            n = len(m[0])
            if n * math.log2(n) - sum(c * math.log2(c) for c in Counter(m[0]).values()) >= SECRET_BITS:
                out.append((m.start(), m.end()))
    return out


def entities(text: str) -> list[tuple[int, int, int]]:
    """(kind's number in PROTECTED, start, end): base spans, then secrets outside them."""
    base = base_spans(text)
    return base + [(len(KINDS), a, b) for a, b in secrets(text) if not any(x < b and a < y for _, x, y in base)]


def _h(s: str) -> int:
    return np.int64(np.uint64(xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")))).item()


#: The entity that stands for all values of a kind.
OF_KIND = [_h(k) for k in PROTECTED]


def lower_ascii(s: str) -> str:
    return s.translate({c: c + 32 for c in range(65, 91)})


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, str]]]]:
    """For each protected span: its entity, and the terms near it as (start, end, text): up to WIDTH words on either side, on its line, however long, and outside all protected spans."""
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    starts = [a for a, _ in taken]
    out = []
    for kind, a, b in spans:
        terms = []
        for m in _before(text, a) + _after(text, b):
            k = bisect_left(starts, m.end())
            if not k or taken[k - 1][1] <= m.start():
                terms.append((m.start(), m.end(), lower_ascii(m[0])))
        out.append((_h(f"{PROTECTED[kind]} {lower_ascii(text[a:b])}"), terms))
    return out


def _before(text: str, at: int, room: int = 256) -> list[re.Match]:
    """The last WIDTH terms of the line before a place, read from it outwards."""
    while True:
        low = max(0, at - room)
        line = text.rfind("\n", low, at) + 1
        low, whole = (line, True) if line else (low, low == 0)
        found = list(_TERM.finditer(text, low, at))
        if not whole and found and found[0].start() == low and _TERM.match(text[low - 1]):
            del found[0]  # part of a word
        if whole or len(found) >= WIDTH:
            return found[-WIDTH:]
        room *= 4


def _after(text: str, at: int, room: int = 256) -> list[re.Match]:
    """The first WIDTH terms of the line from a place on."""
    while True:
        high = min(len(text), at + room)
        line = text.find("\n", at, high)
        high, whole = (line, True) if line >= 0 else (high, high == len(text))
        found = list(_TERM.finditer(text, at, high))
        if not whole and found and found[-1].end() == high and _TERM.match(text[high]):
            del found[-1]
        if whole or len(found) >= WIDTH:
            return found[:WIDTH]
        room *= 4


@lean
def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each term near an entity: document key, entity, its kind's entity, term and its place; one without a term for an entity that has none near."""
    for b in batches:
        cols: list[list] = [[] for _ in range(7)]
        for key, size, text in zip(b.column("k").to_pylist(), b.column("n").to_pylist(), b.column("text").to_pylist(), strict=True):
            if text and (spans := entities(text)):
                for (kind, *_), (e, terms) in zip(spans, contexts(text, spans), strict=True):
                    for a, z, t in terms or [(None, None, None)]:
                        for col, v in zip(cols, (key, size, e, OF_KIND[kind], t if t is None else t.encode("utf-8", "surrogatepass"), a, z), strict=True):
                            col.append(v)
        hashes = iter(Words([t for t in cols[4] if t is not None], ALNUM).hash.view(np.int64).tolist())  # each term is one word
        cols[4] = [t if t is None else next(hashes) for t in cols[4]]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["k", "n", "e", "c", "t", "start", "end"])


def _document_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value if shared is not None else None
        sums = np.zeros(len(wanted) if wanted is not None else 0, np.int64)  # of the wanted terms, over the whole partition
        for whole in batches:
            for b in slices(whole, "text"):
                w = Words(as_bytes(b.column("text")), ALNUM)
                h, own = w.hash, w.owner().astype(np.uint64)
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                    hit = wanted[at] == h
                    h, own = at[hit], own[hit]
                order = np.lexsort((own, h))
                h, own = h[order], own[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
                if wanted is not None:
                    sums += np.bincount(h[new], minlength=len(sums))
                    continue
                u, n = np.unique(h[new].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n.astype(np.int64))], ["t", "n_t"])
        found = np.flatnonzero(sums)
        for i in range(0, len(found), 1 << 16):
            at = found[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(wanted[at].view(np.int64)), pa.array(sums[at])], ["t", "n_t"])

    return lean(run)


def surely(k: np.ndarray, n: np.ndarray, error: float = ERROR) -> np.ndarray:
    """Lower confidence bound of a share of which k of n were seen: the least q with n * KL(k / n, q) <= log(1 / error)."""
    p = k / n
    low, high = np.zeros(len(p)), p.astype(float)
    for _ in range(50):
        q = (low + high) / 2
        apart = p * np.log(p / q) + (1 - p) * np.log(np.maximum(1 - p, 1e-300) / np.maximum(1 - q, 1e-300))
        out = n * apart > -np.log(error)
        low, high = np.where(out, q, low), np.where(out, high, q)
    return high


def _disclosing(total: int, generalise: float, remove: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_te, n_t, n_e = (b.column(c).to_numpy().astype(float) for c in ("n_te", "n_t", "n_e"))
            share = 1 + np.log2(surely(n_te, n_t)) / np.log2(total / n_e)  # PMI(t, e) / IC(e)
            hit = np.flatnonzero(share >= generalise)
            kind = np.where(share[hit] >= remove, "removed", "term").tolist()
            yield pa.RecordBatch.from_arrays([b.column("e").take(pa.array(hit)), b.column("t").take(pa.array(hit)), pa.array(kind, pa.string())], ["e", "t", "kind"])

    return run


def cleaned(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Protected spans become [EMAIL], [IP], [CARD], [PHONE] or [SECRET], generalised terms [TERM]; removed terms go. Overlapping spans are one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out.append(text[at:a])
            out.append("" if kind == "removed" else f"[{kind.upper()}]")
        at = b
    return "".join(out) + text[at:]


@lean
def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for whole in batches:
        for b in slices(whole, "text"):
            found, text_out = [], []
            for text, more in zip(b.column("text").to_pylist(), b.column("terms").to_pylist(), strict=True):
                own = [(PROTECTED[k], a, z) for k, a, z in entities(text)] if text else []
                own += sorted({(m["kind"], m["start"], m["end"]) for m in more or ()}, key=lambda s: (s[0] != "term", s[1]))
                found.append([{"kind": k, "start": a, "end": z} for k, a, z in own])
                text_out.append(cleaned(text, own) if own else text)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, kind), pa.array(text_out, pa.string())], ["id", "spans", "clean_text"])


def _each_once(base: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(text) once for each distinct text of base, and their number. Null texts are none."""
    base = base.where("text is not null")
    copied = scratch.written(base.groupBy("k", "n").agg(F.count("*").alias("copies")).where("copies > 1"))
    keys, surplus = copied.agg(F.count("*"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()
    copied = copied.select("k", "n")
    copied = F.broadcast(copied) if keys <= MOST_PLACES else copied
    several = base.join(copied, ["k", "n"], "left_semi").dropDuplicates(["k", "n"])
    return base.join(copied, ["k", "n"], "left_anti").select("text").unionByName(several.select("text")), base.count() - surplus


def disclosing_terms(base: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, by_kind: bool = False) -> DataFrame:
    """(k, n, terms): places near entities, by key and byte length of the text, that disclose them; base: (text, k, n)."""
    with Scratch(base.sparkSession) as scratch:
        return written(_disclosing_terms(base, scratch, generalise, remove, by_kind))


def _disclosing_terms(base: DataFrame, scratch: Scratch, generalise: float, remove: float, by_kind: bool) -> DataFrame:
    spark = base.sparkSession
    near = scratch.written(base.mapInArrow(_mentions, "k long, n long, e long, c long, t long, start int, end int"))
    near = near.withColumn("e", F.explode(F.array("e", "c"))).drop("c") if by_kind else near.drop("c")
    of_entity = near.select("e", "k", "n").distinct().groupBy("e").agg(F.count("*").alias("n_e"))
    of_pair = scratch.written(near.where("t is not null").select("e", "t", "k", "n").distinct().groupBy("e", "t").agg(F.count("*").alias("n_te")))
    texts, total = _each_once(base, scratch)
    # the bound of n of n texts is ERROR ** (1 / n), so no other pair can reach `generalise`
    can = F.col("n_te") * F.log2(F.lit(float(total)) / F.col("n_e")) * (1 - generalise) >= -np.log2(ERROR).item() - 1e-6
    of_pair = scratch.written(joined(of_pair, of_entity, ["e"]).where(can))
    terms = of_pair.select("t").distinct()
    few = terms.count()
    if few:
        shared = None
        if few <= MOST_TERMS:
            shared = spark.sparkContext.broadcast(np.sort(terms.toPandas()["t"].to_numpy(np.int64).view(np.uint64)))
        of_term = texts.mapInArrow(_document_counts(shared), "t long, n_t long").groupBy("t").agg(F.sum("n_t").alias("n_t"))
        of_term = scratch.written(of_term)
    else:
        of_term = terms.withColumn("n_t", F.lit(0).cast("long"))
    flagged = joined(of_pair, of_term, ["t"]).select("e", "t", "n_te", "n_t", "n_e").mapInArrow(_disclosing(total, generalise, remove), "e long, t long, kind string")
    places = joined(near, scratch.written(flagged), ["e", "t"]).groupBy("k", "n", "start", "end").agg(F.min("kind").alias("kind"))  # removed before term
    return places.groupBy("k", "n").agg(F.collect_list(F.struct("kind", "start", "end")).alias("terms"))


def sanitise(docs: DataFrame, text_col: str = "text", by_kind: bool = False) -> DataFrame:
    """(columns of docs but text_col, spans, clean_text), one row per row of docs. spans: (kind, start, end) by kind as listed (email, ip, card, phone, secret, term, removed), then start, in code points.
    by_kind also judges terms by what they disclose of a kind as a whole, so that terms beside values of one mention each count together.

    Null texts have no spans and stay null; empty ones stay empty. Very long texts and lines are read whole. Ids aren't used, so null ones change nothing. Repeated rows are treated alike; a term that reaches a threshold exactly is flagged. No rows,
    no result rows. A column of docs that is named like a result column gives way to it.
    """
    ready(docs.sparkSession)
    but = (text_col, "spans", "clean_text")
    packed = docs.select(row_of(docs, but).alias("id"), F.col(text_col).cast("string").alias("text"))
    base = packed.withColumn("k", F.xxhash64("text")).withColumn("n", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    terms = disclosing_terms(base.select("text", "k", "n"), by_kind=by_kind)
    places = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    both = base.join(F.broadcast(terms), ["k", "n"], "left") if places <= MOST_PLACES else joined(base, terms, ["k", "n"], "left")
    out = both.select("id", "text", "terms").mapInArrow(_spans, typed(packed.schema["id"].dataType, "spans array<struct<kind:string,start:int,end:int>>, clean_text string"))
    return out.select(*row_columns(docs, "id", but), "spans", "clean_text")


def op6_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"), by_kind=True)
    told = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return got.select("doc_id", *(count(k) for k in KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), count("secret"))
