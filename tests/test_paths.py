"""Anchors, storylines on every path and the watchdog, against plain Python and pinned cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from beacongrid.functions import fuzzy, names
from beacongrid.operators import linking, storylines
from beacongrid.params import BOILERPLATE, Linking, Vocabulary
from beacongrid.streaming import watchdog

H = 3_600_000_000


def grams(words):
    return {f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)}


def plain_similarity(a, b):
    x, w = grams(re.findall(r"[^\W_]+", a.lower())), re.findall(r"[^\W_]+", b.lower())
    runs = [grams(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
    return max((len(x & y) / len(x | y) for y in runs), default=0.0)


PAIRS = [("sanaa", "sana'a", 0.571), ("catania", "catania–fontanarossa", 1.0), ("heathrow", "london heathrow", 1.0), ("rochester", "manchester", 0.4), ("varanasi", "varna", 0.25), ("pittsburgh", "pisa", 0.143), ("orsk", "omsk", None), ("", "oslo", 0.0), ("oslo", "", 0.0)]


def test_strict_word_similarity(spark):
    rng = random.Random(2)
    some = [(" ".join("".join(rng.choices("abc'é-", k=rng.randrange(1, 6))) for _ in range(rng.randrange(4))), " ".join("".join(rng.choices("abcé", k=rng.randrange(1, 6))) for _ in range(rng.randrange(5)))) for _ in range(120)]
    rows = [p[:2] for p in PAIRS] + some
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", names.strict_word_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert all(abs(r["s"] - plain_similarity(r["a"], r["b"])) < 1e-9 for r in got)
    assert all(w is None or round(r["s"], 3) == w for r, (_, _, w) in zip(got, PAIRS, strict=False))


@pytest.mark.parametrize(("name", "core"), [("Lal Bahadur Shastri International Airport", "lal bahadur shastri"), ("Varanasi airport", "varanasi"), ("Airport", ""), ("the international airfield", ""), ("Russian capital", "russian"), ("Beijing Capital International Airport", "beijing"), ("Kuwait City Airport", "kuwait"), ("Sana'a International Airport", "sana'a"), ("Catania–Fontanarossa Airport", "catania–fontanarossa")])
def test_core_name(spark, name, core):
    assert spark.createDataFrame([(name,)], "n string").select(names.core_name(F.col("n")).alias("c")).first()["c"] == core


ANCHORS = [("SAH", "Sana'a International Airport"), ("MAN", "Manchester Airport"), ("VAR", "Varna Airport"), ("NRT", "Narita International Airport"), ("ASF", "Narimanovo Airport"), ("HKB0", "Kabul Star Hotel"), ("PEK", "Beijing Capital International Airport"), ("LHR", "London Heathrow Airport"), ("LGW", "London Gatwick Airport"), ("SHJ", "Sharjah International Airport")]


@pytest.mark.parametrize(
    ("asked", "code"),
    [("Sanaa airport", "SAH"), ("Rochester Airport", None), ("Varanasi airport", None), ("Narita Airport", "NRT"), ("Kabul", None), ("Russian capital", None), ("Airport", None), ("Heathrow", "LHR"), ("London", None), ("Lal Bahadur Shastri International Airport", None), ("nrt", "NRT"), ("hkb0", "HKB0"), ("x" * 201, None), ("", None), (None, None)],
)
def test_resolved_anchor(spark, asked, code):
    a = spark.createDataFrame([(c, n, []) for c, n in ANCHORS], "code string, canonical_name string, aliases array<string>")
    got = fuzzy.resolve(spark.createDataFrame([(1, asked)], "id long, name string"), "id", "name", a).collect()
    assert [r["code"] for r in got] == ([code] if code else [])
    assert all(r["how"] != "fuzzy" or 0.5 <= r["confidence"] <= 0.6 for r in got)


def test_resolving_equals_comparing_all(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcde", k=rng.randrange(2, 7)))
    anchors = [(f"{chr(65 + k // 26)}{chr(65 + k % 26)}X", " ".join(word() for _ in range(rng.randrange(1, 4))) + " Airport", []) for k in range(60)]
    asked = [(i, " ".join(word() for _ in range(rng.randrange(1, 3)))) for i in range(250)] + [(1000 + k, n[:-9] + "a") for k, (_, n, _) in enumerate(anchors)]
    strip = lambda t: " ".join(re.sub(BOILERPLATE, " ", t.lower()).split())
    want = {}
    for i, q in asked:
        sims = sorted(((plain_similarity(strip(q), strip(n)), c) for c, n, _ in anchors), reverse=True)
        if sims[0][0] >= 0.5 and sims[1][0] / sims[0][0] <= 0.9:
            want[i] = sims[0][1]
    df = spark.createDataFrame(anchors, "code string, canonical_name string, aliases array<string>")
    got = fuzzy.resolve(spark.createDataFrame(asked, "id long, name string"), "id", "name", df).where("how = 'fuzzy'").collect()
    taken = {r["id"] for r in fuzzy.resolve(spark.createDataFrame(asked, "id long, name string"), "id", "name", df).where("how != 'fuzzy'").collect()}
    assert {r["id"]: r["code"] for r in got} == {i: c for i, c in want.items() if i not in taken} and len(want) > 30


# ---- storylines ----


def tokens_of(hint):
    w = [x for x in hint.split() if x not in Vocabulary().stop_words]
    return list(dict.fromkeys(w)), list(dict.fromkeys(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]))


def plain_assign(rows, newest):
    """One loop over all events of all countries; every open storyline is compared."""
    p, shared, held, out, opened = Linking(), set(Vocabulary().shared_words), {}, {}, 0
    for i, t, land, anchor, place, hint in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[0])):
        uni, tok = tokens_of(hint)
        held = {n: e for n, e in held.items() if t - e[0] <= 14 * 24 * H}
        best = None
        head = sorted(held.values(), key=lambda e: (e[0], e[6]))[-newest:]
        for n, (u, l2, a2, p2, uni2, tok2, _, place_) in held.items():
            if land and l2 and land != l2:
                continue
            sim = len(set(tok) & set(tok2)) / len(set(tok) | set(tok2)) if tok and tok2 else 0.0
            both = set(uni) & set(uni2)
            telling = both - shared
            plain = [w for w in telling if sum(w in e[4] for e in head) < 3]
            same = bool(anchor and a2 and anchor.upper() == a2.upper())
            ok = sim > 0.4 and telling or t - u <= 72 * H and len(both) >= 2 and plain and len(both) / min(len(uni), len(uni2)) >= 0.5 or same and (t - u <= 72 * H or sim >= 0.2) or not same and place and place == p2 and sim >= 0.2
            if ok and (best is None or (-sim, place_) < best[:2]):
                best = (-sim, place_, n)
        name, at = (i, opened) if best is None else (best[2], best[1])
        opened += best is None
        held[name] = (t, land, anchor, place, uni, tok, i, at)
        out[i] = name
    return out


KIND = "id long, t long, country string, anchor string, place string, hint string"


@pytest.mark.parametrize("countries", [[None, "A", "B"], ["A"], [None]])
def test_assignment_on_all_paths_equals_a_plain_loop(spark, countries):
    rng = random.Random(len(countries))
    words = "kyiv drone refinery dock raid ferry sector north blast river".split()
    t, rows = 0, []
    for i in range(400):
        t += rng.choice([0, 1, 5, 40, 90]) * H if rng.random() > 0.01 else 17 * 24 * H
        rows.append((i, t if rng.random() > 0.02 else None, rng.choice(countries), rng.choice([None, "AAA", "aaa", "BBB", ""]) if rng.random() < 0.2 else None, rng.choice([None, "P", "Q"]), " ".join(rng.choices(words, k=rng.randrange(0, 5)))))
    want = plain_assign(rows, 200)
    df = linking.with_tokens(spark.createDataFrame(rows, KIND), "hint")
    for n in (1, 7):
        got = {r["id"]: r["storyline_of"] for r in storylines.assign_on_all_paths(df.repartition(n)).collect()}
        assert got == want
    assert len(set(want.values())) > 5


def test_census_counts_the_newest_storylines_only():
    rng = random.Random(3)
    held = storylines.OpenStorylines(Linking(), frozenset(), newest=4)
    for i in range(200):
        uni, tok = tokens_of(" ".join(rng.choices("a b c d e f g h i j k l m n o p".split()[:12], k=3)))
        held.expire(i * H)
        held.add({"id": i, "t": i * H, "country": None, "anchor": None, "place": None, "tokens": tok, "unigrams": uni})
        last = sorted(held.open.values(), key=lambda e: e[0]["t"])[-4:]
        want = {}
        for e, _ in last:
            for w in set(e["unigrams"]):
                want[w] = want.get(w, 0) + 1
        assert {w: n for w, n in held.census.items() if n} == want


def test_overexposed_words_change_a_link(spark):
    """Two hints of one town share only words that three other storylines name too: containment no longer speaks."""
    hints = ["twin falls shooting mall", "idaho twin falls river", "twin falls fair", "twin falls parade rain wind", "falls twin snow ice hail"]
    ev = [(i, i * H, "US", None, None, h) for i, h in enumerate(hints)]
    pair = [(10, 20 * H, "US", None, None, "twin falls depot alarm"), (11, 21 * H, "US", None, None, "twin falls boat")]
    df = linking.with_tokens(spark.createDataFrame(pair, KIND), "hint")
    ab = linking.candidate_pairs(df, "id", [F.col("unigrams")])
    few = storylines.ambient_words(linking.with_tokens(spark.createDataFrame(ev[:2], KIND), "hint").withColumn("s", F.col("id")), "s").first()["words"]
    many = storylines.ambient_words(linking.with_tokens(spark.createDataFrame(ev, KIND), "hint").withColumn("s", F.col("id")), "s").first()["words"]
    assert few == [] and many == ["falls", "twin"]
    linked = lambda w: ab.where(storylines.linked_under("a", "b", F.array(*map(F.lit, w)).cast("array<string>"))).count()
    assert linked(few) == 1 and linked(many) == 0
    same = linking.with_tokens(spark.createDataFrame([(i, i * H, "US", None, None, "kyiv drone strike") for i in range(40)], KIND), "hint").withColumn("s", F.lit("one"))
    assert storylines.ambient_words(same, "s").first()["words"] == []


def test_blocks_keep_apart_what_cannot_meet(spark):
    D = 24 * H
    rows = [(1, 0, "A"), (2, 10 * D, "A"), (3, 25 * D, "A"), (4, 0, "B"), (5, 100 * D, "A"), (6, 101 * D, None), (7, 102 * D, "B")]
    df = spark.createDataFrame([(*r[:3], None, None, "x") for r in rows], KIND)
    got = {r["id"]: r["block"] for r in storylines.independent_blocks(df).collect()}
    assert got[1] == got[2] != got[3] and got[4] not in (got[1], got[3]) and got[5] == got[6] == got[7]


# ---- watchdog ----


def plain_pages(beats, until, silence=3, again=2):
    out = set()
    for s in {s for s, _ in beats}:
        at = sorted({t for x, t in beats if x == s})
        for a, b in zip(at, [*at[1:], until + 1], strict=True):
            p = a + silence * 3_600_000
            while p < b:
                out.add((s, a, p))
                p += again * 3_600_000
    return out


def test_watchdog_stream_equals_batch_over_restarts(spark, tmp_path):
    rng = random.Random(5)
    m = 60_000
    beats, t = [], 0
    for _ in range(60):
        t += rng.choice([5, 30, 179, 180, 181, 400, 700]) * m
        beats.append((rng.choice("ab"), t))
    beats += [("c", 7 * m), ("z", t + 20 * m)]
    beats.sort(key=lambda b: b[1])
    until = max(t for _, t in beats) - 10 * m  # the watermark in the end
    batch = watchdog.pages(spark.createDataFrame(beats, "s string, t long"), "s", "t", until)
    want = {(r["source"], r["last_seen"], r["paged_at"]) for r in batch.collect()}
    assert want == {p for p in plain_pages([b for b in beats if b[1] <= until], until)} and len(want) > 20
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", watchdog.ROCKS)
    try:
        for part in (beats[:20], beats[20:45], beats[45:]):
            spark.createDataFrame(part, "s string, t long").select("s", F.timestamp_millis("t").alias("at")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema("s string, at timestamp").parquet(str(tmp_path / "in"))
            q = watchdog.paging(stream, "s", "at").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
            q.awaitTermination(240)
            assert q.exception() is None
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = [(r["source"], r["last_seen"], r["paged_at"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(set(got) - want) == [] and sorted(want - set(got)) == [] and len(got) == len(set(got))
