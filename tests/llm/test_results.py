"""Results of the operators against SQL, brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from beacongrid.llm import bpe, class_lm, components, decontaminate, html_blocks, html_extract, language_id, near_dedup, quality, queries, sanitise, sharding, toxicity
from beacongrid.llm._words import ALNUM, SPACED, Words

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    d = pd.read_parquet(f"{SF}/documents.parquet")
    return dict(zip(d["doc_id"], d["text"], strict=True))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(name, spark, oracle, same):
    assert same(queries.QUERIES[name](spark, SF).toPandas(), oracle(queries.SQL[name], SF))


def test_words_equal_expressions():
    odd = ["a b", "", " é\x85x\x1cy ", "A1-b_c\n\x0bd", "x" * 3_000_000 + " y", "日本 語"]
    for member, p in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        w = Words([t.encode() for t in odd], member, lower=False)
        for i, t in enumerate(odd):
            assert [w.text(k).decode() for k in range(w.ptr[i], w.ptr[i + 1])] == re.findall(p, t)
    w = Words([b"one two", b"two one one"])
    assert w.hash[0] == w.hash[3] == w.hash[4] and w.hash[1] == w.hash[2] != w.hash[0]


def test_superminhash_estimates_and_ignores_order():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 62, 5000).astype(np.uint64)
    errors = []
    for n, shared in ((5, 4), (100, 60), (1000, 850), (2000, 200)):
        a, b = pool[:n], np.concatenate([pool[:shared], pool[2000 : 2000 + n - shared]])[:n]
        both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = near_dedup.superminhash(np.concatenate([a, b, a[::-1]]), np.array([0, n, 2 * n, 3 * n]))
        assert (s[0] == s[2]).all() and (s != near_dedup._FREE).all()
        errors.append(abs((s[0] == s[1]).mean() - both))
    assert max(errors) < 0.1
    assert (near_dedup.superminhash(pool[:0], np.array([0, 0])) == near_dedup._FREE).all()


def test_large_group_of_near_copies_equals_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(420):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(90)] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(500 + i, " ".join(f"u{rng.randrange(50)}" for _ in range(30))) for i in range(50)]
    sets = {i: {tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, block=64).collect()}
    assert got == {i: find(i) for i in sets}


def test_components_of_a_chain(spark, monkeypatch):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    want = {i: 0 for i in range(301)} | {2000: 2000, 2001: 2000}
    assert {r["node"]: r["label"] for r in components.components(e, "a", "b").collect()} == want
    monkeypatch.setattr(components, "ONE_TASK", 0)
    assert {r["node"]: r["label"] for r in components.components(e, "a", "b").collect()} == want


def test_spans_point_at_the_original(spark):
    docs = spark.createDataFrame([(1, "Été: The QUICK-brown fox, éa jumps. Nothing else")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "the quick brown fox éa")], "item_id long, text string")
    r = decontaminate.decontaminate(docs, items).first()
    assert r["n_hit"] == 5 and [docs.first()["text"][s["start"] : s["end"]] for s in r["spans"]] == ["The QUICK-brown fox, éa"]


def test_automaton_equals_brute_force(tmp_path, monkeypatch):
    rng = random.Random(1)
    for k in range(120):
        word = lambda v=rng.choice([2, 3, 6, 30]): f"w{rng.randrange(v)}"
        items = [(str(i), " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14, 20])))) for i in range(rng.choice([0, 1, 3, 6]))]
        texts = [" ".join(word() if rng.random() < 0.9 else "zz" for _ in range(rng.choice([0, 1, 3, 10, 40, 90]))) for _ in range(rng.choice([0, 1, 4]))]
        window = rng.choice([2, 4, 13])
        monkeypatch.setattr(decontaminate, "STRETCH", rng.choice([1, 2, 5, 256]))
        (tmp_path / f"{k}").write_bytes(b"".join(decontaminate.compile_automaton(items, window)))
        machine, w = decontaminate.Automaton(str(tmp_path / f"{k}")), Words([t.encode() for t in texts], ALNUM)
        got = {(a, z, n) for a, z, s in zip(*(x.tolist() for x in machine.scan(w.hash, w.ptr)), strict=True) for n in machine.names_of(s)}
        want = set()
        for at, t in zip(w.ptr.tolist(), texts):
            for name, i in items:
                n = min(window, len(i.split()))
                grams = {tuple(i.split()[j : j + n]) for j in range(len(i.split()) - n + 1)}
                want |= {(at + j, at + j + n, name) for j in range(len(t.split()) - n + 1) if n and tuple(t.split()[j : j + n]) in grams}
        assert got == want


def test_many_items_make_one_automaton_and_one_scan(spark):
    rng = random.Random(2)
    items = [(i, " ".join(f"{rng.randrange(10**7):x}" for _ in range(700))) for i in range(1100)]
    assert sum(len(t) for _, t in items) > 4_500_000
    docs = [(0, " ".join(items[7][1].split()[100:140])), (1, "nothing of it")]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in got.collect()} == {0: (40, ["7"]), 1: (0, [])}


def test_base_spans_equal_expressions(texts):
    odd = ["a@b.c@d.e.f x@y", "1.2.3.4.5.6.7.8 300.1.1.1 00001.2.3.4", "4111 1111 1111 1111-4111-1111-1111-1111 4111111111111111", "+1 (555) 010-9999++44 20 7946 0958 x", "+" * 50, "1" * 5000, "a" * 20000, "@" * 500]
    for t in [*texts.values(), *odd]:
        want = []
        for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+(?:\.[0-9]+){3}", r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
            for m in re.finditer(p, t) if len(t) < 6000 else ():
                d = re.sub("[^0-9]", "", m[0])
                ok = k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 3 and 9 <= len(d) <= 15
                if k == 2 and 13 <= len(d) <= 19:
                    ok = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
                if ok:
                    want.append((k, m.start(), m.end()))
        if len(t) < 6000:
            assert sanitise.base_spans(t) == want
        else:
            sanitise.base_spans(t)


def test_terms_that_disclose_are_found(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} {word()} Zorblax {word()} reach joe@corp.example {word()} {word()} the") for i in range(12)]
    rows += [(100 + i, f"{word()} the {word()} plain {word()}") for i in range(400)]
    rows += [(600 + i, f"mail x{i}@corp.example about the {word()}") for i in range(20)]
    got = {r["doc_id"]: r for r in sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(12):
        assert "Zorblax" not in got[i]["clean_text"] and "[EMAIL]" in got[i]["clean_text"] and got[i]["clean_text"].endswith("the")
    assert all(got[100 + i]["clean_text"] == rows[12 + i][1] for i in range(400))
    assert all(len(got[600 + i]["spans"]) == 1 for i in range(20))


def test_a_signature_in_many_documents_discloses(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda: " ".join(word() for _ in range(8))
    rows = [(i, f"{text()}\nregards Zorblax\njoe@corp.example Quuxel the\n{text()} the") for i in range(40)]
    rows += [(100 + i, f"{text()} the {text()}") for i in range(600)]
    rows += [(800 + i, f"{text()}\nmail x{i}@corp.example or {word()} now") for i in range(20)]
    got = {r["doc_id"]: r["clean_text"] for r in sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(40):
        assert re.sub(r"\[TERM\]", "", got[i]) == rows[i][1].replace("joe@corp.example Quuxel", "[EMAIL] ")
    assert all(got[800 + i] == rows[640 + i][1].replace(f"x{i}@corp.example", "[EMAIL]") for i in range(20))


def test_copies_change_no_disclosure(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, f"{word()} {word()}\nZorblax joe@corp.example the\n{word()} the") for i in range(12)]
    rows += [(100 + i, f"{word()} the {word()}") for i in range(600)]
    many = rows + [(1000 * (1 + i) + k, rows[i][1]) for i in range(12) for k in range(100)]
    one, all_ = ({r["doc_id"]: r["clean_text"] for r in sanitise.sanitise(spark.createDataFrame(x, "doc_id long, text string")).collect()} for x in (rows, many))
    assert all("Zorblax" not in one[i] and one[i] == all_[i] for i in range(12))
    assert all(all_[i] == one[i // 1000 - 1] for i in all_ if i >= 1000)


def test_terms_of_a_long_line_are_found():
    gap = "-" * 3000
    text = f"far{gap} one two three {gap} four joe@corp.example five {gap}\nnext"
    (_, terms), = sanitise.contexts(text, sanitise.base_spans(text))
    assert [text[a:z] for a, z, _ in terms] == ["far", "one", "two", "three", "four", "five"]
    long = "y" * 5000
    (_, terms), = sanitise.contexts(f"{long} a@b.example {long}", [(0, 5001, 5012)])
    assert [z - a for a, z, _ in terms] == [5000, 5000]


def test_secrets():
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    text = f'token = "{key}" and averyveryverylongwordwithoutnumbers and 1234567890123456789012345 and release-2024-january-notes-x'
    assert [text[a:b] for a, b in sanitise.secrets(text)] == [key]
    assert sanitise.cleaned(text, [("secret", *sanitise.secrets(text)[0])]).startswith('token = "[SECRET]" and')


@pytest.mark.parametrize("by_kind", [False, True])
def test_flagged_terms_equal_plain_counts(spark, by_kind):
    """Every entity and term by plain loops over distinct texts."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcde") for _ in range(2))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 6))) + rng.choice(["", " m1@corp.example Blip", " m2@corp.example Clap", f" m{i}@corp.example"]) + rng.choice(["", " Zorb Quux", " Zorb"]) + " " + word()) for i in range(500)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 500, 7)]
    texts = sorted({t for _, t in rows})
    near, with_t, with_e = {}, Counter(), Counter()

    def mentions(t):
        spans = sanitise.base_spans(t)
        found = sanitise.contexts(t, spans)
        return found + [(sanitise.PROTECTED[s[0]], terms) for s, (_, terms) in zip(spans, found, strict=True)] * by_kind

    for t in texts:
        with_t.update({sanitise.lower_ascii(x) for x in re.findall(r"[0-9A-Za-z]+", t)})
        found = mentions(t)
        with_e.update({e for e, _ in found})
        for e, terms in found:
            for *_, x in terms:
                near.setdefault((e, x), set()).add(t)
    flagged = {}
    for (e, x), where in near.items():
        share = 1 + math.log2(sanitise.surely(np.array([len(where)]), np.array([with_t[x]]))[0]) / math.log2(len(texts) / with_e[e])
        if share >= 0.8:
            flagged[e, x] = "removed" if share >= 0.95 else "term"
    assert flagged and by_kind == any(e == "email" for e, _ in flagged)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in sanitise.sanitise(spark.createDataFrame(rows, "doc_id long, text string"), by_kind=by_kind).collect()}
    for i, t in rows:
        base = [(sanitise.KINDS[k], a, b) for k, a, b in sanitise.base_spans(t)]
        places = {}
        for e, terms in mentions(t):
            for a, z, x in terms:
                if (e, x) in flagged:
                    places[a, z] = min(flagged[e, x], places.get((a, z), "term"))
        more = [(kind, a, z) for (a, z), kind in places.items()]
        assert got[i] == base + sorted(more, key=lambda s: (s[0] != "term", s[1]))


def test_kinds_tell_planted_terms_of_single_mentions(spark):
    """Every address stands in one text; only the kind as a whole shows which words go with it. Half of the planted words stand by phones."""
    rng = random.Random(21)
    common = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    plain = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, f"{plain(20)} Korvin x{i}@h{i}.example {plain(20)}") for i in range(40)]
    rows += [(100 + i, f"{plain(20)} Tellun +1 555 {1000000 + i} {plain(20)}") for i in range(40)]
    rows += [(200 + i, f"{plain(20)} y{i}@g{i}.example {plain(20)}") for i in range(40)]
    rows += [(1000 + i, plain(40)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    told = lambda got: {(r["doc_id"], text[r["doc_id"]][s["start"] : s["end"]]) for r in got.collect() for s in r["spans"] if s["kind"] in ("term", "removed")}
    assert not told(sanitise.sanitise(docs))
    assert told(sanitise.sanitise(docs, by_kind=True)) == {(i, "Korvin") for i in range(40)} | {(100 + i, "Tellun") for i in range(40)}


def test_base_digest_equals_plain_expressions(spark, texts):
    got = {r["doc_id"]: r["base_sha256"] for r in queries.QUERIES["op6_sanitise"](spark, SF).collect()}
    for i, t in texts.items():
        out = []
        for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(?:\.[0-9]+){3}"), ("card", r"[0-9](?:[ -]?[0-9])+"), ("phone", r"\+[0-9][ ().0-9-]+[0-9]")):
            for m in re.finditer(p, t or ""):
                d = [int(x) for x in m[0] if x.isdigit()]
                odd = sum(d[::-1][0::2]) + sum(sum(map(int, str(2 * x))) for x in d[::-1][1::2])
                if kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255 or kind == "card" and 13 <= len(d) <= 19 and odd % 10 == 0 or kind == "phone" and 9 <= len(d) <= 15:
                    out.append(f"{kind}:{m.start()}:{m.end()}")
        assert got[i] == hashlib.sha256(",".join(out).encode()).hexdigest()


def test_confidence_bound():
    k, n = np.array([1, 3, 5, 50, 500]), np.array([1, 3, 10, 100, 1000])
    q = sanitise.surely(k, n)
    assert np.allclose(q[:2], [0.01, 0.01 ** (1 / 3)]) and (np.diff(q[2:]) > 0).all() and (q < k / n).all()


def test_tokens_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    odd = {-1: "a<|endoftext|>b <|startoftext|>", -2: "it's we'll I'VE 12345 ß ΣΊΣΥΦΟΣ İ", -3: "x\x1cy\x85z q​w", -4: "日本語😀👍🏽!!", -5: "'" * 5 + "s't", -6: "ab" * 4000, -7: "ﬁ Å é ᾳ"}
    all_ = dict(texts) | odd
    got = bpe.bpe(spark.createDataFrame(list(all_.items()), "doc_id long, text string"), bpe.tokenizer_path(), lexicon=500).collect()
    for r in got:
        e = t.encode(all_[r["doc_id"]], add_special_tokens=False)
        assert np.frombuffer(r["ids"], "<u4").tolist() == e.ids and bytes(r["decoded"]).decode() == t.decode(e.ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    rng = random.Random(9)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode(): [rng.randrange(100) for _ in range(rng.randint(1, 3))] for _ in range(400)}
    words |= {p.encode() + b"tion": [1] for p in "uvwxyz"}
    (tmp_path / "x").write_bytes(bpe.compile_lexicon(words))
    lex = bpe.Lexicon(str(tmp_path / "x"))
    assert all(lex.find(w) == i for w, i in words.items())
    assert lex.find(b"") is None and lex.find(b"tion") is None and lex.find(b"ution!") is None
    trie = {w[:i] for w in words for i in range(len(w) + 1)}
    right = {(p in words, tuple(sorted((q[len(p) :], True) for q in words if q.startswith(p)))) for p in trie}
    assert len(lex.final) == len(right)


def test_quality_counts_equal_plain_ones(spark, texts):
    got = {r["doc_id"]: r for r in quality.quality(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {k + j for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for j in range(8)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(hit) > 30 * len(w)) and not (r["base_failed"] and r["kept"])


def test_fences_and_verdict_equal_exact_quartiles(spark):
    """Groups small enough for sketches to be exact: 8 times as far above the median as the middle of what lies above it; groups of under 50 rows, and rates that never do, take their language's fence, or none."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefg") for _ in range(n))
    rows = []
    for i in range(170):
        lang, source = ("en", "a") if i < 90 else ("en", "b") if i < 110 else ("fr", None)
        w = [word(rng.randint(2, 6)) for _ in range(rng.randint(20, 40))]
        w += ["#$%"] * (rng.randint(0, 2) if i % 11 else 25)
        rows.append((i, "\n".join([" ".join(w), *(["same line"] * (rng.randint(0, 1) if i % 13 else 9))]), lang, source))
    got = {r["doc_id"]: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)).collect()}
    good = [r for r in got.values() if not r["base_failed"]]
    rank = lambda v, q: sorted(v)[min(len(v) - 1, max(0, math.ceil(q * len(v)) - 1))]
    for r in got.values():
        own = [x for x in good if (x["lang"], x["source"]) == (r["lang"], r["source"])]
        every = [x for x in good if x["lang"] == r["lang"]]
        own = own if len(own) >= quality.ENOUGH else every
        within = True
        for k in quality.RATES:
            v = [x[k] for x in own]
            top = next((m + 8 * (rank(up, 0.5) - m) for m, up in ((m, [z for z in y if z > m]) for y in (v, [x[k] for x in every]) for m in [rank(y, 0.5)]) if up), math.inf)
            assert math.isclose(r[f"{k}_top"], top, rel_tol=1e-9)
            within = within and r[k] <= top
        assert r["kept"] == (not r["base_failed"] and within)
    assert len({r["kept"] for r in good}) == 2


def test_many_sketches_merge_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(quality, "FAN", 4)
    monkeypatch.setattr(quality, "HELD", 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(8)
    got = quality.quality(docs).select("doc_id", "kept").collect()
    assert len(got) == docs.count() and sum(r["kept"] for r in got) > len(got) / 2


def test_sketches_keep_ranks_however_rows_are_dealt():
    rng = np.random.default_rng(4)
    x = np.concatenate([np.zeros(30_000), rng.exponential(size=90_000)])
    rng.shuffle(x)
    for n in (1, 7, 64):
        whole = quality.Kll()
        for p in np.array_split(x, n):
            whole.merge(quality.Kll.load(quality.Kll().add(p).dump()))
        for q, v in zip((0.5, 0.75, 0.9, 0.99), whole.quantiles([0.5, 0.75, 0.9, 0.99]), strict=True):
            assert abs((x <= v).mean() - q) < 0.01
        mid, up = whole.upper()
        above = x[x > mid]
        assert abs((above <= up).mean() - 0.5) < 0.02


def test_rates_without_spread_have_no_fence():
    assert quality.fence(0.0, 0.0) == math.inf and quality.fence(1.0, 1.5) == 5.0 and quality.Kll().add(np.zeros(10)).upper() == (0.0, 0.0)


@pytest.mark.parametrize("percent", [30, 40, 50, 60, 71, 80, 90])
def test_pairs_at_the_threshold_share_a_band(percent):
    """Pairs of sets just above the threshold: of 600, none misses every band (expected misses: 1e-5)."""
    rng = np.random.default_rng(percent)
    bands, rows = near_dedup.bands_for(percent), near_dedup.rows_for(percent)
    assert bands * rows <= near_dedup.LANES and (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS
    n, pairs = 300, 600
    both = -(-2 * n * percent // (100 + percent))
    sets = []
    for _ in range(pairs):
        e = rng.integers(1, 1 << 62, 2 * n - both).astype(np.uint64)
        sets += [e[:n], e[n - both :]]
    s = near_dedup.superminhash(np.concatenate(sets), np.arange(0, (2 * pairs + 1) * n, n))[:, : bands * rows].reshape(pairs, 2, bands, rows)
    assert (s[:, 0] == s[:, 1]).all(2).any(1).all()


def test_toxicity_with_a_word_in_every_text(spark):
    """One word in all labelled texts tells nothing and ends nothing."""
    rng = random.Random(6)
    rows = [(i, "common " + " ".join(rng.choices("alpha beta gamma delta omega".split(), k=20)) + (" vileword vileword awfulness" if i % 3 == 0 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert min(got[i] for i in range(0, 120, 3)) > 0.5 > max(got[i] for i in range(120) if i % 3)


def test_toxicity_learns_from_repeated_rows_once(spark):
    docs, labels = spark.read.parquet(f"{MORE}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{MORE}/labels.parquet")
    one = labels.join(docs, "doc_id").where("toxic = 1 and crc32(cast(cast(doc_id as string) as binary)) % 5 != 0").orderBy("doc_id").first()["doc_id"]
    many = docs.unionByName(docs.where(F.col("doc_id") == one).crossJoin(spark.range(500)).select("doc_id", "text"))
    score = lambda d: {(r["doc_id"], round(r["score"], 9)) for r in toxicity.toxicity(d, labels).collect()}
    assert score(many) == score(docs)


def test_toxicity_query_columns(spark):
    got = queries.QUERIES["op2_toxicity"](spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(got["doc_id"]) == sorted(docs["doc_id"]) and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5).astype(int)).all() and (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()


def test_sketches_merge():
    rng = np.random.default_rng(2)
    x = rng.normal(size=40_000)
    parts = [quality.Kll().add(p) for p in np.array_split(x, 37)]
    whole = quality.Kll()
    for p in parts:
        whole.merge(quality.Kll.load(p.dump()))
    assert whole.n == len(x)
    for q in (0.05, 0.25, 0.5, 0.75, 0.95):
        assert abs((x <= whole.quantiles([q])[0]).mean() - q) < 0.03


def test_segments_equal_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        s = np.array([rng.choice([-2, -1, -0.5, 1, 3]) for _ in range(rng.randint(0, 14))], float)
        best = max([0.0, *(s[a:b].sum() for a in range(len(s)) for b in range(a + 1, len(s) + 1))])
        got = toxicity.maximal_segments(s)
        assert math.isclose(max([0.0, *(v for *_, v in got)]), best, abs_tol=1e-9)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(got, got[1:], strict=False)) and all(math.isclose(s[a:b].sum(), v, abs_tol=1e-9) for a, b, v in got)


def test_toxicity_on_held_out_rows(spark):
    got = toxicity.toxicity(spark.read.parquet(f"{MORE}/documents.parquet"), spark.read.parquet(f"{MORE}/labels.parquet")).where("held_out").toPandas()
    m = got.merge(pd.read_parquet(f"{MORE}/labels.parquet"), on="doc_id")
    hit, toxic = m["score"] >= 0.5, m["toxic"] == 1
    assert (hit & toxic).sum() / toxic.sum() > 0.6 and (hit & toxic).sum() / hit.sum() > 0.9


def test_all_maximal_segments_equal_their_definition():
    """Ruzzo and Tompa: the best segment, then the same left and right of it."""
    rng = random.Random(6)

    def split(s, a, b):
        best = max(((sum(s[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i = -best[2]
        j = i - best[1]
        return [*split(s, a, i), (i, j, best[0]), *split(s, j, b)]

    for _ in range(150):
        s = [rng.choice([-7, -3, -1, 2, 4, 9]) + rng.random() for _ in range(rng.randint(0, 16))]
        got = toxicity.maximal_segments(np.array(s, float))
        want = split(s, 0, len(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want] and np.allclose([v for *_, v in got], [v for *_, v in want])


def test_expectations_hold_on_clean_texts():
    """Of random texts without structure, about a share of e has a segment that is expected e times or less."""
    rng = np.random.default_rng(4)
    s, p = np.array([-1.5, 0.5, 1.0, 2.0]), np.array([0.9, 0.06, 0.03, 0.01])
    lam = toxicity._lambda(s, p)
    texts = [rng.choice(s, n, p=p) for n in rng.integers(50, 400, 4000)]
    top = np.array([max([0.0, *(v for *_, v in toxicity.maximal_segments(x))]) for x in texts])
    words = np.array([len(x) for x in texts], float)
    k = toxicity.tail_factor(top, np.ones(len(top)), words, lam)
    for e in (0.02, 0.05, 0.2):
        share = (k * words * np.exp(-lam * top) <= e).mean()
        assert e / 3 < share < 1.7 * e


def test_language_on_held_out_rows(spark):
    got = language_id.language_id(spark.read.parquet(f"{MORE}/documents.parquet")).where("held_out").toPandas()
    m = got.merge(pd.read_parquet(f"{MORE}/documents.parquet"), on="doc_id")
    assert (m["lang"] == m["lang_pred"]).mean() > 0.98


def test_svm_meets_its_dual():
    """Primal and dual objective meet, so the machine is the optimum of its problem."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 5)).astype(np.float32)
    y = np.where(x[:, 0] + 0.7 * x[:, 1] + rng.normal(size=80) * 0.5 > 0.3, 1.0, -1.0)
    w = language_id.svm(x, y, np.arange(80), cost=1.0, rounds=3000)
    share = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) / 80 * 2
    a = np.column_stack([x, np.ones(80)])
    value = lambda v: 0.5 * v @ v + (share * np.maximum(0, 1 - y * (a @ v))).sum()
    assert all(value(w) <= value(w + d) + 1e-2 for d in rng.normal(size=(400, 6)) * rng.choice([1e-3, 1e-2, 0.1, 1.0], size=(400, 1)))


def test_a_language_of_one_hot_text_is_learned(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(5000)] + [(5000 + i, f"le chat dort sous la table numéro {i}", "fr") for i in range(300)]
    got = language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").groupBy("lang_pred").count().collect()
    assert {r["lang_pred"] for r in got} == {"en", "fr"}


def test_copies_leave_the_sample_of_a_language_whole(spark):
    rows = [("aa", "the hot text")] * 9800 + [("aa", f"text number {chr(97 + i % 26)} {i}") for i in range(199)] + [("bb", f"un autre texte {i}") for i in range(30)]
    seen = []
    real, language_id.Identifier = language_id.Identifier, lambda x, y: seen.append((len(x), Counter(y))) or real(x, y)
    try:
        language_id.fit(spark.createDataFrame(rows, "lang string, text string"), 100)
    finally:
        language_id.Identifier = real
    assert seen == [(80, Counter(aa=50, bb=30))]


def test_class_model_beats_unigrams_and_base_is_exact(spark):
    got = class_lm.class_lm(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    d = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t.translate(low)) + [None] for i, t in d.items()}
    c = Counter(w for i, h in zip(got["doc_id"], got["held_out"], strict=True) if not h for w in words[i])
    n, v = sum(c.values()), len(c)
    for r in got.itertuples():
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[r.doc_id]), rel_tol=1e-9)
        assert r.n_tokens == len(words[r.doc_id]) and r.n_known == sum(w in c for w in words[r.doc_id]) and r.train_tokens == n
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() and (got["score"] < 0).all()


@pytest.mark.parametrize("least", [1, 2, 10**9])
def test_class_score_equals_plain_sums_and_sums_to_one(spark, least, monkeypatch):
    """Every text's score from the model's own classes by plain loops; the probabilities of all words, one unknown a group and the end sum to 1 after any class."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("aa bb cc dd ee ff gg".split()) for _ in range(rng.randint(0, 9)))) for i in range(60)] + [(60, "zz only once qq zz"), (61, "aa unseen?! bb")]
    models = []
    real = class_lm.fit
    monkeypatch.setattr(class_lm, "fit", lambda *a: models.append(real(*a)) or models[-1])
    got = class_lm.class_lm(spark.createDataFrame(rows, "doc_id long, text string"), least=least).collect()
    m = models[0]
    lex, key = m.lexicon, lambda w: int(class_lm.tokens([w.encode()])[0][0])
    words = {r["doc_id"]: dict(rows)[r["doc_id"]].split() + [None] for r in got}
    c = Counter(w for r in got if not r["held_out"] for w in words[r["doc_id"]])
    group = lambda w: key(w) & 255
    types = Counter(group(w) for w, n in c.items() if w is not None and n < least)

    def cls(w):
        return int(lex.look(np.array([class_lm.END if w is None else key(w)]))[1][0])

    mass = Counter()
    for w, n in c.items():
        mass[cls(w)] += n
    mass[cls(None)] += 0.5
    for g in range(256):
        mass[int(lex.of[len(lex.core) + 1 + g])] += 0.5

    def p(w, before):
        if w is None:
            own = c[None] + 0.5
        elif c[w] >= least:
            own = c[w]
        else:
            own = c[w] - m.discount if c[w] else m.discount * types[group(w)] + 0.5
        return 10 ** m.step[before, cls(w)] * own / mass[cls(w)]

    for r in got:
        before, want = cls(None), 0.0
        for w in words[r["doc_id"]]:
            want += math.log10(p(w, before))
            before = cls(w)
        assert math.isclose(r["score"], want, rel_tol=1e-9), words[r["doc_id"]]
        assert r["n_known"] == sum(w in c for w in words[r["doc_id"]])
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (sum(c.values()) + len(c) + 1)) for w in words[r["doc_id"]]), rel_tol=1e-9)
    for before in range(class_lm.CLASSES):
        total = sum(p(w, before) for w in c)
        total += sum(10 ** m.step[before, int(lex.of[len(lex.core) + 1 + g])] * (m.discount * types[g] + 0.5) / mass[int(lex.of[len(lex.core) + 1 + g])] for g in range(256))
        classes = {cls(w) for w in c} | {int(k) for k in lex.of[len(lex.core) + 1 :]}
        assert math.isclose(total, sum(10 ** m.step[before, k] for k in classes), rel_tol=1e-9) and math.isclose(sum(10 ** m.step[before]), 1, rel_tol=1e-9)


def test_exchange_separates_two_languages():
    pairs = np.zeros((8, 8))
    pairs[np.ix_([0, 2, 4, 6], [0, 2, 4, 6])] = 10
    pairs[np.ix_([1, 3, 5, 7], [1, 3, 5, 7])] = 10
    pairs[0, 1] = pairs[1, 0] = 1
    of = class_lm.exchange(pairs[[0, 1, 3, 2, 5, 4, 6, 7]][:, [0, 1, 3, 2, 5, 4, 6, 7]], 2)
    assert len(set(of[[0, 3, 5, 6]])) == len(set(of[[1, 2, 4, 7]])) == 1


def test_main_text():
    model = html_extract.fit([])
    p = "<p>" + "A sentence that says something, and then some more of it. " * 3 + "</p>"
    page = f"<html><head><title>t</title><script>var a = '<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><div class='cookie-banner'>We use cookies.</div><article><h1>Head</h1>{p}<p>x &lt; y &amp;&#233;<br>z<b>b</b>old.{p}</article><div id=comments><p>Nice post, thanks a lot for it.</p></div><footer>&copy; Someone</footer>"
    text, *_ = html_extract.main_text(page, model)
    assert text.startswith("Head A sentence") and "x < y &é zbold." in text
    assert not any(s in text for s in ("Home", "cookies", "Nice post", "Someone", "no"  "</p>"))
    assert html_extract.main_text("", model) == html_extract.main_text(None, model) == ("", 0, 0)
    fresh = [(html_extract.features(b), [int(x.mark == "1") for x in b]) for b in map(html_blocks.blocks, html_extract.made_pages(80, seed=77))]
    right = sum(a == b for f, y in fresh for a, b in zip(model.decode(f), y, strict=True))
    assert right / sum(len(y) for _, y in fresh) > 0.97


def test_pages_whose_names_say_nothing():
    """Without telling names of class and id, tags and text features alone must find the main text."""
    model = html_extract.fit([])
    for unnamed, least in ((0.0, 0.985), (1.0, 0.95)):
        fresh = [(html_extract.features(b), [int(x.mark == "1") for x in b]) for b in map(html_blocks.blocks, html_extract.made_pages(120, seed=91, unnamed=unnamed))]
        right = sum(a == b for f, y in fresh for a, b in zip(model.decode(f), y, strict=True))
        assert right / sum(len(y) for _, y in fresh) > least


def test_main_text_of_all_given_pages(spark):
    """Every row of pages has one <article>, read here by the standard library's parser, which the operator doesn't use."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        apart = frozenset("p h1 h2 h3 br li div article ul".split())

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.parts = False, [""]

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            self.parts += [""] * (tag in self.apart)

        def handle_endtag(self, tag):
            self.inside &= tag != "article"
            self.parts += [""] * (tag in self.apart)

        def handle_data(self, data):
            self.parts[-1] += data if self.inside else ""

    def read(page):
        parser = Article()
        parser.feed(page or "")
        parser.close()
        return " ".join(x for x in (" ".join(p.split()) for p in parser.parts) if x)

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = html_extract.op1_main_text(spark, SF).collect()
    text = {r["page_id"]: read(r["html"]) for r in pages}
    assert len(got) == len(pages) and {(r["page_id"], r["url"]) for r in got} == {(r["page_id"], r["url"]) for r in pages}
    assert all(r["text"] == text[r["page_id"]] and r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("tag", ["<svg viewBox='0 0 1 1' />", "<math/>", "<select><option>", "<object data=x>", "<canvas>", "<iframe src=x>", "<template>"])
def test_unclosed_and_empty_elements_leave_the_page(tag):
    name = re.match("<([a-z]+)", tag)[1]
    page = f"<p>one</p>{tag}<p>two</p><{name}></{name}><p>three</p><!-- </{name}> --><p>four"
    assert [b.text for b in html_blocks.blocks(page)] == ["one", "two", "three", "four"]


def test_raw_elements_nest_and_math_is_text():
    page = "<p>a<object>x<object>y</object>z</object>b <math><mi>E</mi><mo>=</mo><annotation>tex</annotation></math> c</p><p>d<script>e"
    assert [b.text for b in html_blocks.blocks(page)] == ["ab E= c", "d"]


def test_long_pages_teach_and_are_read_whole(spark):
    para = lambda i: f"<p>Sentence number {i} says something, and then some more of it. It goes on for a while.</p>"
    page = "<nav><a href=/>Home</a></nav><article><h1>Head</h1>" + "".join(map(para, range(3000))) + "</article><footer>&copy; Someone</footer>"
    assert len(page) > 200_001
    seen = []
    real, html_extract._train = html_extract._train, lambda pages, *a: seen.append(max(len(k) for _, k, _ in pages)) or real(pages[:40], 20)
    try:
        got = html_extract.extract(spark.createDataFrame([(1, "u", page), (2, "v", page), (3, "w", None)], "page_id long, url string, html string")).orderBy("page_id").collect()
    finally:
        html_extract._train = real
    assert seen == [3003]
    assert got[0]["text"] == got[1]["text"] and got[0]["n_blocks"] == 3003 and "Sentence number 2999 says" in got[0]["text"] and got[2]["text"] == ""


def test_training_climbs_the_likelihood():
    """The weights are where the penalised likelihood, by summing over all labellings, has no slope."""
    rng = random.Random(2)
    pages = [([rng.sample(["bias", "ends", "long", "rights"], rng.randint(0, 4)) for _ in range(n)], [rng.randint(0, 1) for _ in range(n)]) for n in (1, 2, 3, 3, 5)]
    m = html_extract.train(pages, rounds=3000, ridge=0.1)
    names, theta = sorted(m.names, key=m.names.get), np.concatenate([m.w, m.step.ravel(), m.start])

    def value(th):
        w, step, start = th[:-6], th[-6:-2].reshape(2, 2), th[-2:]
        out = -0.05 * th @ th
        for fs, ys in pages:
            of = lambda y: start[y[0]] + sum(w[names.index(f)] for f, k in zip(fs, y, strict=True) if k for f in f) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False))
            every = [of([k >> i & 1 for i in range(len(fs))]) for k in range(1 << len(fs))]
            out += (of(ys) - np.logaddexp.reduce(every)) / len(pages)
        return out

    best = value(theta)
    for i in range(len(theta)):
        for d in (1e-2, -1e-2):
            moved = theta.copy()
            moved[i] += d
            assert value(moved) <= best + 1e-5


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        m = html_extract.Crf({"a": 0, "b": 1}, rng.normal(size=2) * 2, rng.normal(size=(2, 2)), rng.normal(size=2))
        f = [[x for x in "ab" if rng.random() < 0.5] for _ in range(6)]
        s = m.scores(f)
        best = max(range(64), key=lambda k: m.start[k >> 5 & 1] + sum(s[i] * (k >> (5 - i) & 1) for i in range(6)) + sum(m.step[k >> (6 - i) & 1, k >> (5 - i) & 1] for i in range(1, 6)))
        assert m.decode(f) == [best >> (5 - i) & 1 for i in range(6)]


def test_directory_and_deep_splits(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "NEXT_BITS", 3)
    docs = spark.createDataFrame([(i, "y" * (50 + i % 40)) for i in range(300)], "doc_id long, text string")
    placed = sharding.shards(docs, 400)
    want = {}
    h = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i in range(300)}
    for i in h:
        for d in range(61):
            if sum(50 + j % 40 for j in h if h[j] >> (60 - d) == h[i] >> (60 - d)) <= 400:
                want[i] = d
                break
    assert {r["doc_id"]: r["depth"] for r in placed.collect()} == want
    d = sorted(sharding.directory(placed).collect(), key=lambda r: r["low"])
    assert d[0]["low"] >= 0 and d[-1]["high"] <= 1 << 60 and all(a["high"] <= b["low"] for a, b in zip(d, d[1:], strict=False)) and sum(r["shard_rows"] for r in d) == 300


def test_hot_key_spreads_over_shards(spark):
    rows = [(1, "x" * 90)] * 60 + [(i, "y" * 50) for i in range(2, 30)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 400).toPandas()
    assert len(got) == len(rows) and got["shard_bytes"].max() <= 400 and (got.groupby("shard")["n_bytes"].sum() == got.groupby("shard")["shard_bytes"].first()).all()


def test_pipeline_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    d = pd.read_parquet(f"{SF}/documents.parquet")
    d = d[[language_id.has_letter(t) for t in d["text"]]]
    sets = {}
    for i, t in zip(d["doc_id"], d["text"], strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                up[max(ra, rb)] = min(ra, rb)
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    word = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    grams = {tuple(w[k : k + min(13, len(w))]) for w in map(word, bench["text"]) if w for k in range(len(w) - min(13, len(w)) + 1)}
    sizes = {len(g) for g in grams}
    want = {}
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.tokenizer_path())
    for i, t in zip(d["doc_id"], d["text"], strict=True):
        if find(i) != i:
            continue
        w = word(t)
        hit = {k + j for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in grams for j in range(n)}
        if hit and 20 * len(hit) >= len(w):
            continue
        want[i] = t
    assert set(got) == set(want)
    clean = {r["doc_id"]: r["clean_text"] for r in sanitise.sanitise(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")).collect()}
    for i, r in got.items():
        ids = tok.encode(clean[i], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


