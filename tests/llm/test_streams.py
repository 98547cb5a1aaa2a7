"""Source divergence, periodic runs and packing against brute force, the tokenizer's library and edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from beacongrid.llm import bpe, divergence, packing, periodic, queries
from beacongrid.llm._words import mix

SF = "/root/testdata/sf0.001"


# ---- periodic runs ----


def plain_runs(w, least=24, times=3):
    """Every maximal repetition, by comparing words at each distance."""
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, times * q) and not any(q % d == 0 and all(w[k] == w[k + d] for k in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_words(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return rng.choices("ab", k=rng.randrange(90))
    if kind == 1:
        return rng.choices("abc", k=rng.randrange(200))
    if kind == 2:
        a, b = "a", "ab"
        while len(b) < 150:
            a, b = b, b + a
        return list(b)
    if kind == 3:
        return ["x"] * rng.randrange(80)
    out = []
    for _ in range(rng.randrange(1, 6)):
        unit = rng.choices("abcdefgh" if kind == 4 else "ab", k=rng.randrange(1, 14))
        out += (unit * 20)[: rng.randrange(5, 80)] + rng.choices("abxyz", k=rng.randrange(5))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_repetitions_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(25):
        w = some_words(rng)
        s = np.array([ord(c) for c in w] + [1 << 20])
        start, length, period = periodic.repetitions(s)
        assert sorted(zip(start.tolist(), length.tolist(), period.tolist(), strict=True), key=lambda r: (r[0], r[2])) == plain_runs(w, 2, 2)


@pytest.mark.parametrize("least,times", [(24, 3), (10, 2), (6, 4)])
def test_stretches_hold_every_run(least, times):
    rng = random.Random(7)
    texts = [some_words(rng) for _ in range(150)]
    words = mix(np.array([ord(c) for w in texts for c in w], np.uint64))
    ptr = np.cumsum([0, *map(len, texts)])
    got = periodic.runs_of(words, ptr, least, times)
    assert {k: got.get(k, []) for k in range(len(texts))} == {k: plain_runs(w, least, times) for k, w in enumerate(texts)}


def test_vocabulary_of_rotations():
    w = "abcabcabxabcabcab"
    f = periodic.Factors(np.array([*map(ord, w), 999]))
    start, half = periodic.covering_squares(f)
    tree = periodic.Tree(f)
    found = {w[f.sa[tree.left[u]] :][: 2 * q] for u, q in tree.rotations(start, half)}
    assert found == {"abcabc", "bcabca", "cabcab"}
    b = periodic.lz_blocks(periodic.Factors(np.array([*map(ord, "abababc"), 999]))).tolist()
    assert b == [0, 1, 2, 6, 7, 8]


def plain_query(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    w = [x.decode() for x in w]
    runs = plain_runs(w)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha(lines), sha(collapsed(w, runs)))


def test_periodic_query_equals_brute_force(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    short = d[d["text"].str.len() < 9000]
    got = queries.QUERIES["op12_periodic_runs"](spark, SF)
    rows = {r["doc_id"]: tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) for r in got.collect()}
    assert len(rows) == len(d)
    assert all(rows[i] == plain_query(i, t) for i, t in zip(short["doc_id"].tolist(), short["text"], strict=True))
    assert sum(r[1] > 0 for r in rows.values()) > 5


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 23), (5, "x " * 24), (5, "x " * 24), (None, "a b " * 12), (6, "a b c " * 8 + "a b"), (7, "é\x85 ü " * 30), (8, "one two " * 40_000), (9, "A a " * 11 + "A A " * 12)]


def test_periodic_edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("id", F.lit(2))
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(EDGES)
    for (i, t), r in zip(sorted(EDGES, key=str), sorted(got, key=lambda r: str((r["doc_id"], next((t for i, t in EDGES if i == r["doc_id"]), None)))), strict=True):
        w = [x.decode() for x in (t or "").encode().split()]
        want = plain_runs(w) if len(w) < 1000 else [(0, 80_000, 2)]
        assert [tuple(x) for x in r["runs"]] == want and r["collapsed"] == collapsed(w, want) and r["doc_id"] == i
        assert (r["strongest"] is None) == (not want)
    ties = periodic.periodic_runs(spark.createDataFrame([(1, "x y " * 12 + "q " + "z v " * 12)], "doc_id long, text string")).first()
    assert tuple(ties["strongest"]) == (0, 24, 2)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


# ---- packing ----


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.no_truncation(), t.no_padding()
    return t


def check_pieces(got, texts):
    """Pieces of each row as the library's ids cut by binary lengths; ids of sequences without gaps, longest first."""
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    tok = library()
    for i, t in texts.items():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            n = r["length"]
            assert r["start"] == at and n & (n - 1) == 0 and n <= 4096 and r["offset"] == 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())
            at += n
        assert at == len(ids) and len(by[i]) == len(ids) // 4096 + bin(len(ids) % 4096).count("1")
    order = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in order] == list(range(len(got)))
    assert [r["length"] for r in order] == sorted((r["length"] for r in got), reverse=True)


def test_packing_query_equals_library(spark):
    d = pd.read_parquet(f"{SF}/documents.parquet")
    check_pieces(queries.QUERIES["op13_packing"](spark, SF).collect(), dict(zip(d["doc_id"].tolist(), d["text"], strict=True)))


ODD = {
    1: None, 2: "", 3: " \n ", 4: "Don't 'tis it'll ''s x's 12a3 --'ve \"'s", 5: "Straße ΣΑΣ é ́x a b c d \x85 \x1c ﬁ İI", 6: "<|endoftext|> a<|startoftext|>b <|endof text|>", 7: "日本語 ไทย 한국어 👍🏽 x‍y",
    8: "word " * 9000, 9: "x" * 20_000, 10: "a " * 4095, 11: "a " * 4096, 12: "﻿a � İ",
}


def test_packing_of_odd_texts(spark):
    docs = spark.createDataFrame(list(ODD.items()), "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("id", F.lit(1)).repartition(3)
    pieces = packing.decompose(docs, bpe.tokenizer_path())
    seq = packing.numbered(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
    check_pieces(seq.collect(), ODD)
    by = {r["length"]: r for r in packing.buckets(seq).collect()}
    assert by[4096]["first_id"] == 0 and sum(r["sequences"] for r in by.values()) == seq.count()
    assert all(r["last_id"] - r["first_id"] + 1 == r["sequences"] for r in by.values())


def test_packing_edges(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "")], "doc_id long, text string")
    got = packing.numbered(packing.decompose(docs, bpe.tokenizer_path())).collect()
    assert Counter((r["doc_id"], r["length"]) for r in got) == {(None, 4): 1, (1, 4): 2, (2, 1): 1} and sorted(r["sequence_id"] for r in got) == [0, 1, 2, 3]
    assert packing.numbered(packing.decompose(docs.limit(0), bpe.tokenizer_path())).count() == 0
    open_ = packing.decompose(docs, bpe.tokenizer_path(), most=2, end=None).collect()
    assert Counter(r["length"] for r in open_) == {2: 3, 1: 3}
    with pytest.raises(ValueError):
        packing.decompose(docs, bpe.tokenizer_path(), most=12)
    packing.write_buckets(packing.decompose(docs, bpe.tokenizer_path()), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).groupBy("length").count().count() == 2


@pytest.mark.parametrize("change", [None, "cased", "split", "added"])
def test_signs_and_capitals_are_learned_once(change):
    """Words that differ in capitals and in signs at their ends are a few pieces, if the tokenizer lower-cases and splits so; ids are the library's in any case."""
    import json

    from tokenizers import Tokenizer

    with open(bpe.tokenizer_path(), "rb") as f:
        spec = json.load(f)
    if change == "cased":
        spec["normalizer"]["normalizers"].pop()
    elif change == "split":
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}]+[.,]?|[^\s]"
    elif change == "added":
        spec["added_tokens"].append({**spec["added_tokens"][0], "id": 49408, "content": "ab."})
    raw = json.dumps(spec).encode()
    lib = Tokenizer.from_str(raw.decode())
    lib.no_truncation(), lib.no_padding()
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(3, 9))) for _ in range(100)]
    texts = [" ".join(w.title() + sign if k % 2 else w + sign for w in words) for k, sign in enumerate(["", ".", ",", "!?", "&&&", "...", '."', "'"])]
    few = packing.Encoder(raw)
    few.encode([t.encode() for t in texts])
    if change is None:
        assert len(few.hash) <= 2 * 100 + 8
    odd = [*"abJ'.,;!<|>*&$ \n19", "é", "É", "×", "÷", "\u0301", "\u030c", "\u0338", "İ", "Σ", "ﬁ", "ª", "½", "»", "\xa0", "'s", "'LL", "<|endoftext|>", "<|EndOfText|>", "\ufeff", "日", "ab."]
    texts += ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(3000)] + ["word" + "." * 30, "." * 5000 + "a", "1." * 50, ""]
    ids, ptr = few.encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert ids[ptr[i] : ptr[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids, t


# ---- divergence ----


def plain_divergence(rows, least, top):
    import re

    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    seen, n, groups = Counter(), Counter(), defaultdict(set)
    for lang, source, ws in docs:
        groups[lang].add(source)
        seen.update((lang, t) for t in set(ws))
        n.update((lang, source, t) for t in ws)
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), c in seen.items() if x == lang and c >= least]
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        share = lambda c, m: 1 + 10**9 * (c + 5) // (m + 5 * len(kept))  # noqa: B023,E731
        p = {s: {t: share(n[lang, s, t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(n[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


ROWS = [("The cat, the CAT and the dog42dog Éa", "en", "a"), ("the cat sat", "en", "b"), ("the the dog", "en", None), (None, "en", "d"), ("", None, "a"), ("cat " * 3000, None, "b"), ("12 34", "fr", "a"), ("le chat", "fr", "b"), ("the cat sat", "en", "b"), ("ünter ünter", "en", "a"), ("solo solo", "xx", "only")]


@pytest.mark.parametrize("least,cells", [(1, 1 << 22), (2, 1 << 22), (2, 8), (50, 1 << 22)])
def test_divergence_equals_brute_force(spark, least, cells):
    docs = spark.createDataFrame(ROWS, "text string, lang string, source string")
    for c in ("doc", "term", "p", "kind", "n"):
        docs = docs.withColumn(c, F.lit("clash"))
    want = plain_divergence(ROWS, least, 3)
    for parts in (1, 5):
        got = divergence.divergence(docs.repartition(parts), least=least, top=3, cells=cells).collect()
        assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == want
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_partial_and_long_runs(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 300)
    rng = random.Random(1)
    rows = [(" ".join(rng.choices("abcdefghijklmnop", k=30)), rng.choice("xy"), f"s{rng.randrange(5)}") for _ in range(200)]
    parts = [divergence.pa.RecordBatch.from_pylist([{"text": t, "lang": g, "source": s, "doc": i} for i, (t, g, s) in enumerate(rows[k : k + 20], k)]) for k in range(0, 200, 20)]
    sums = Counter()
    for b in divergence._partial_runs(iter(parts)):
        for r in b.to_pylist():
            sums[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter((g, s, t) for x, g, s in rows for t in x.split())
    assert sums == want
    one = [{"lang": "x", "term": "t", "source": f"s{k // 30_000}", "doc": k, "docs": 1, "n": 2, "h": 5} for k in range(90_000)]
    rest = [{**one[0], "term": "u", "docs": 29}, {**one[0], "term": "v", "docs": 30, "h": 6}]
    kind = divergence.pa.schema([*(f for f in divergence._PARTIAL if f.name != "doc"), ("h", divergence.pa.int64())])
    feed = [divergence.pa.RecordBatch.from_pylist(x, schema=kind) for x in (one[:70_000], one[70_000:80_000], one[80_000:], rest)]
    got = [(r["term"], r["source"], r["n"], r["all_n"], r["head"]) for b in divergence._scan(30)(iter(feed)) for r in b.to_pylist()]
    assert got == [("t", "s0", 60_000, 180_000, True), ("t", "s1", 60_000, 180_000, False), ("t", "s2", 60_000, 180_000, False), ("v", "s0", 2, 2, True)]


def test_long_run_as_spark_deals_it(spark):
    """More than a block of partial runs of one term: the hash in front of them comes as a column that is never null."""
    n = 150_000
    runs = spark.range(0, n, 1, 1).selectExpr("'x' lang", "'t' term", f"concat('s', id div {n // 3}) source", "1L docs", "2L n", "xxhash64('x', 't') h")
    assert not runs.schema["h"].nullable
    got = runs.mapInArrow(divergence._scan(30), "lang string, term string, source string, n long, all_n long, head boolean").collect()
    assert [tuple(r) for r in got] == [("x", "t", f"s{i}", n // 3 * 2, n * 2, i == 0) for i in range(3)]
