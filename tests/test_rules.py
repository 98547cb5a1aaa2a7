"""Rules that SQL doesn't say, against plain Python; order and partitions don't matter; streams equal batches."""

import difflib
import math
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from beacongrid.functions import fuzzy, text
from beacongrid.operators import alerts, ingest, linking, reports
from beacongrid.plans.bindings import incidents
from beacongrid.sources import feeds, ports
from beacongrid.streaming import state

SF = "/root/testdata/sf0.001"
H = 3_600_000_000


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("title", "kind"),
    [
        ("Border war latest: what we know", "desk_label"),
        ("At least 7 killed in latest strikes", None),
        ("Siege, day 1,628: drones over the port", "war_diary"),
        ("Two killed on day 2 of protests", None),
        ("Two years after the raid", "retrospective"),
        ("Man charged over blast", "judicial"),
        ("Troops planted charges under the bridge", None),
        ("Suspect arrested in July shooting that killed teen", "arrest_for_earlier_incident"),
        ("113 arrested after protest turns violent", None),
        ("Autopsy conducted on shooting suspect", "post_mortem"),
        ("Casualty toll in the north up by 1,240 over past day", "toll_revision"),
        ("Body recovered from rubble after airstrike", "remains_recovery"),
        ("Thousands attend funeral of slain officer", "burial"),
        ("Strike on funeral procession wounds 12", None),
        ("Hostages safely rescued after raid", "resolution"),
        ("What we know about the raid", "explainer"),
        ("Inquiry into the raid opens", "probe"),
        ("Harbor shelled | Live: Gazette", None),
    ],
)
def test_aftermath(spark, title, kind):
    assert one(spark, text.aftermath("t"), t=title) == kind


@pytest.mark.parametrize(
    ("title", "kind", "want"),
    [
        ("Bus overturns on highway, 4 dead", "mass_casualty_event", "transport_accident"),
        ("Bus stop opens", "mass_casualty_event", None),
        ("Drone crashes into bus stop", "mass_casualty_event", None),
        ("Floods leave 30 dead", "civilian_casualties", "natural"),
        ("Floods strand 7,000 at airport", "civilian_casualties", None),
        ("Floods leave 30 dead", "missile_strike", None),
        ("Stampede at stadium", "mass_casualty_event", "crowd_crush"),
        ("Mine collapse traps ten", "mass_casualty_event", "structural_collapse"),
        ("Gas leak kills six", "mass_casualty_event", "industrial"),
    ],
)
def test_accidental_cause(spark, title, kind, want):
    assert one(spark, text.accidental_cause("t", "k"), t=title, k=kind) == want


def test_year_repair(spark):
    as_of = F.expr("TIMESTAMP_NTZ '2026-01-05 00:00:00'")
    cases = [
        ("2024-12-31 10:00:00", "2026-01-02 09:00:00", "2025-12-31 10:00:00"),  # across New Year, and the last day of a month stays
        ("2024-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-01 00:00:00"),
        ("2023-12-26 00:00:00", "2026-01-02 00:00:00", None),  # a real anniversary
        ("2025-12-20 00:00:00", "2026-01-02 00:00:00", "2025-12-20 00:00:00"),  # sane as it is
        ("2024-02-29 00:00:00", "2026-01-02 00:00:00", None),
        ("2026-03-01 00:00:00", "2026-01-02 00:00:00", None),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string").select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert [None if r["x"] is None else str(r["x"]) for r in df.select(text.repaired_year("a", "b", as_of).alias("x")).collect()] == [w for *_, w in cases]


@pytest.mark.parametrize(("severe", "top", "n", "want"), [(3, 71, 3, "Kritik"), (2, 71, 10, "Kritik"), (2, 71, 9, "Yüksek"), (0, 100, 1, "Yüksek"), (0, 70, 1, "Yükseltilmiş"), (0, 63, 5, "Yükseltilmiş"), (0, 63, 4, "Normal"), (0, 59, 99, "Normal")])
def test_risk_level(spark, severe, top, n, want):
    assert one(spark, reports.risk_level(F.col("c"), F.col("m"), F.col("n")), c=severe, m=top, n=n) == want


def test_penalized_sources_make_nothing_official(spark):
    df = spark.createDataFrame([("a", "x.gov"), ("b", "www.p.example"), ("b", "q.p.example"), ("b", "bad.example"), ("c", "x.gov"), ("c", "p.example"), ("c", "r.example")], "k string, d string")
    got = reports.verification(df, "k", "d", reports.official(F.col("d")), (F.col("d") == "bad.example") | ((F.col("d") == "x.gov") & (F.col("k") == "a")))
    assert {r["k"]: (r["n_independent"], r["label"]) for r in got.collect()} == {"a": (0, "single"), "b": (1, "single"), "c": (3, "official")}


def test_nearby_goes_round_the_globe_and_over_poles(spark):
    rng = random.Random(8)
    at = lambda: (rng.choice([rng.uniform(-90, 90), rng.uniform(80, 90), rng.uniform(-1, 1)]), rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), rng.uniform(-180, -179)]))
    points, places = [(i, *at()) for i in range(150)] + [(900, 0.0, 179.95)], [(i, *at(), 1) for i in range(150)] + [(901, 0.0, -179.95, 1)]

    def km(a, b):
        p, q, d = math.radians(a[1]), math.radians(b[1]), math.radians(b[2] - a[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(d / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0.0)))

    a, b = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(places, "place_id long, lat double, lon double, tier int")
    for radius in (50.0, 700.0):
        got = {(r["id"], r["place_id"]) for r in linking.nearby(a, b, radius, 1000).collect()}
        assert got == {(p[0], q[0]) for p in points for q in places if km(p, q) <= radius} and (900, 901) in got


def test_missing_country_meets_every_country(spark):
    df = spark.createDataFrame([(1, 0, "A"), (2, 0, None), (3, 0, "B"), (4, 0, None)], "id long, t long, country string").withColumn("hint", F.lit("zebra kiosk")).withColumn("anchor", F.lit(None).cast("string")).withColumn("place", F.lit(None).cast("string"))
    pairs = linking.candidate_pairs(linking.with_tokens(df, "hint"), "id", [F.col("unigrams")])
    assert sorted((r["x"], r["y"]) for r in pairs.where(linking.linked("a", "b")).select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).collect()) == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]


def test_co_located_equals_brute_force(spark):
    """A place of half of all rows, ties, windows that end exactly, repeated rows, and rows without time, type, country, anchor or point."""
    rng, span = random.Random(14), 6 * 3_600_000_000
    none = lambda x, p=0.1: None if rng.random() < p else x
    times = [k * span // 4 + rng.choice([0, 0, 1, -1]) for k in range(-8, 40)]
    rows = []
    for i in range(400):
        hot = rng.random() < 0.5
        lat, lon = (10.0, 179.9) if hot else (round(rng.uniform(9, 11), 2), rng.choice([179.9, -179.9, 179.5]))
        rows.append((i, none(rng.choice(times)), none("AB"[rng.random() < 0.2]), none(rng.choice(["x", "x", "x", "y", "z"])), none("a" if hot else rng.choice("bcd"), 0.4), none(lat, 0.3), lon))
    rows += [(400 + k, *rows[k][1:]) for k in range(30)]

    def km(a, b):
        p, q, d = math.radians(a[5]), math.radians(b[5]), math.radians(b[6] - a[6])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(d / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0.0)))

    want = {}
    for a in rows:
        if a[1] is None or a[2] is None:
            continue
        met = {b[3] for b in rows if b[1] is not None and b[2] == a[2] and a[1] <= b[1] <= a[1] + span and b[3] is not None and ((a[4] is not None and a[4] == b[4]) or (a[5] is not None and b[5] is not None and km(a, b) <= 50))}
        if len(met) >= 2:
            want[a[0]] = len(met)
    df = spark.createDataFrame(rows, "id long, t long, country string, event_type string, anchor string, lat double, lon double")
    assert want and {r["id"]: r["types"] for r in linking.co_located(df).collect()} == want
    assert linking.co_located(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        linking.co_located(df, most_types=2)


def test_candidates_by_place_and_by_country(spark):
    hour = 3_600_000_000
    rows = [(1, "A", 0, ["fire", "dock"], "p"), (2, None, 48 * hour, ["quake"], "p"), (3, "B", 0, ["fire", "dock"], "p"), (4, "A", -48 * hour, ["fire", "port"], None), (5, "A", 49 * hour, ["fire", "dock"], "p"), (6, "A", None, ["fire"], "p"), (7, None, 0, ["fire"], None), (8, "A", hour, [], None)]
    df = spark.createDataFrame(rows, "id long, country string, t long, unigrams array<string>, place string")
    got = sorted((r["a_id"], r["b_id"], round(r["kin"], 3)) for r in linking.adjudication_candidates(df, "id", "country", place="place").collect())
    assert got == [(1, 2, 1.0), (1, 4, 0.333), (2, 1, 1.0), (2, 3, 1.0), (2, 5, 1.0), (3, 2, 1.0), (4, 1, 0.333), (5, 2, 1.0)]
    assert linking.adjudication_candidates(df, "id", "country", place="place", most=1).where("a_id = 2").first()["b_id"] == 1


def test_hosts_of_one_publisher_are_one_source(spark):
    rows = [(1, "s", "www.own.co.uk"), (2, "s", "live.own.co.uk"), (3, "s", "a.other.com"), (4, "s", "b.other.com"), (5, "s", None), (6, "u", "x.com")]
    df = spark.createDataFrame(rows, "id long, s string, domain string").withColumn("own", F.when(F.col("s") == "s", "own.co.uk").otherwise("x.com"))
    assert [tuple(r) for r in ingest.corroborated(df, "s", "own", "domain", [F.asc("id")]).collect()] == [("s", 1, "other.com")]


def test_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    places = {"kyiv": None, "lviv": None}
    word = lambda: rng.choice("strike hits port ship fire crew kyiv lviv dock harbour dawn".split())
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 6))), " ".join(word() for _ in range(rng.choice([2, 30]))), rng.choice([None, "kyiv", ""])) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, title string, body string, place string")
    got = {r["id"]: r["duplicate_of"] for r in ingest.duplicates_of(df.where("id >= 80"), df.where("id < 80"), "id", [F.desc("id")], places, most=60).collect()}
    grams = lambda t: set(t.split()) if len(t.split()) < 4 else {tuple(t.split()[k : k + 4]) for k in range(len(t.split()) - 3)}
    share = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    named = lambda t: {p for p in places if p in (t or "").split()}

    def first(x):
        for y in reversed(rows[20:80]):
            p, q = named(x[1]), named(f"{y[1]} {y[3] or ''}")
            if p and q and not p & q:
                continue
            ratio = difflib.SequenceMatcher(None, x[1], y[1]).ratio() if x[1] and y[1] else 0.0
            if ratio >= 0.65 or share(set(x[1].split()), set(y[1].split())) >= 0.72 or (len(x[2]) > 100 and len(y[2]) > 100 and share(grams(x[2]), grams(y[2])) >= 0.4):
                return y[0]
        return None

    assert got == {x[0]: first(x) for x in rows[80:]}
    assert len({v for v in got.values() if v is not None}) > 5


def test_two_keys_claim_together(spark):
    rows = [
        (1, 0, 2, "a", "g", True),
        (2, H, 2, "b", "g", True),  # another storyline, the same place
        (3, H, 3, "b", "g", True),  # worse: goes out, raises g
        (4, 2 * H, 2, "a", None, True),
        (5, 2 * H, 3, "c", "g", True),
        (6, 3 * H, 3, "d", None, False),  # fails, claims nothing
        (7, 3 * H, 1, "d", None, True),
        (8, 6 * H, 2, "a", "g", True),  # 5 hours after the last claim on g
        (9, 6 * H, 1, None, None, True),
    ]
    df = spark.createDataFrame(rows, "id long, t long, rank int, key string, geo string, sent boolean").where("key is not null")
    want = {1: "sent", 2: "suppressed", 3: "sent", 4: "suppressed", 5: "suppressed", 6: "failed", 7: "sent", 8: "sent"}
    for n in (1, 8):
        assert {r["id"]: r["decision"] for r in alerts.two_key_claims(df.repartition(n)).collect()} == want


def test_failed_delivery_frees_both_keys(spark):
    df = spark.createDataFrame([(1, 0, 1, "a", "g", True), (2, H, 2, "b", "g", False), (3, 2 * H, 1, "c", "g", True)], "id long, t long, rank int, key string, geo string, sent boolean")
    assert {r["id"]: r["decision"] for r in alerts.two_key_claims(df).collect()} == {1: "sent", 2: "failed", 3: "sent"}


def test_shingles_of_a_long_text(spark):
    t = " ".join(f"w{i % 19_000}" for i in range(20_000))
    began = time.time()
    assert one(spark, F.size(text.shingles("t")), t=t) == 19_000 and time.time() - began < 30
    assert one(spark, F.array_sort(text.shingles("t")), t="a b a") == ["a", "b"] and one(spark, text.shingles("t"), t="") == []
    assert one(spark, text.shingles("t"), t="a b c d e a b c d") == ["a b c d", "b c d e", "c d e a", "d e a b", "e a b c"]


@pytest.mark.parametrize(("title", "want"), [("Blast Hits Port - Daily Wire", "blast hits port"), ("A - b | a suffix that is certainly longer than forty-five characters", "a b a suffix that is certainly longer than fortyfive characters"), ("Çatışma: X-Y!", "çatışma xy"), ("", "")])
def test_norm_title(spark, title, want):
    assert one(spark, text.norm_title("t"), t=title) == want


def test_suppression_sequences():
    seq = [(1, 0, 1), (2, H, 1), (3, 2 * H, 3), (4, 3 * H, 2), (5, 5 * H, 2), (6, 6 * H + 1, 1), (7, 20 * H, 1)]
    told, now = alerts.fold_suppression(seq, None, 4)
    assert [b for _, b in told] == [False, True, False, True, True, False, False]
    assert now == (1, 24 * H)


def _batch(e):
    return {(r["id"], r["blocked"]) for r in alerts.suppressed(e, "country", "id", "t", "r").collect()}


def test_suppression_ignores_partitions_and_order(spark):
    e = incidents(spark, SF).where("t is not null").withColumn("r", alerts.rank(F.col("alert_tier"))).select("country", "id", "t", "r")
    want = _batch(e)
    for n in (1, 4, 16):
        assert _batch(e.repartition(n).orderBy(F.desc("id"))) == want
    by = {}
    for r in sorted(e.where("r > 0").collect(), key=lambda r: (r["t"], r["id"])):
        by.setdefault(r["country"], []).append((r["id"], r["t"], r["r"]))
    assert {x for rows in by.values() for x in alerts.fold_suppression(rows, None, 4)[0]} == want


def test_suppression_stream_equals_batch(spark, tmp_path):
    e = incidents(spark, SF).where("t is not null").withColumn("r", alerts.rank(F.col("alert_tier"))).select("country", "id", "t", "r")
    want = _batch(e)
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    run = state.suppression(stream, "country", "id", "t", "r").writeStream.format("memory").queryName("claims").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert run.awaitTermination(120)
    assert {(r["id"], r["blocked"]) for r in spark.table("claims").collect()} == want


def test_late_rows_drop_in_stream_as_in_batch(spark, tmp_path):
    e = incidents(spark, SF).select("id", F.col("published_at").cast("timestamp").alias("p"), (F.col("ingested_at") + F.expr("INTERVAL 3 DAYS") * (F.col("id") % 2)).cast("timestamp").alias("i"))
    e.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    state.on_time(stream, "p", "i").select("id").writeStream.format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert {r["id"] for r in spark.table("late").collect()} == {r["id"] for r in e.where("id % 2 = 0").collect()}


def test_assignment_ignores_partitions(spark):
    e = linking.with_tokens(incidents(spark, SF), "hint")
    want = {tuple(r) for r in linking.assign_in_order(e, "country").collect()}
    for n in (1, 16):
        assert {tuple(r) for r in linking.assign_in_order(e.repartition(n), "country").collect()} == want


def _by_country(spark, with_undated):
    e = linking.with_tokens(incidents(spark, SF), "hint").select("id", "country", "t", "tokens").collect()
    out = {}
    for r in sorted(e, key=lambda r: (r["t"] is not None, r["t"] or 0, r["id"])):
        if with_undated or r["t"] is not None:
            out.setdefault(r["country"], []).append((r["id"], r["t"], set(r["tokens"])))
    return out


def test_assignment_equals_plain_python(spark):
    want = {}
    for rows in _by_country(spark, False).values():
        lines = []  # (name, time of the newest, its tokens), in order of opening
        for i, t, own in rows:
            sims = [(len(own & held) / len(own | held), -k) for k, (_, last, held) in enumerate(lines) if t - last <= 14 * 24 * H]
            sim, k = max(sims, default=(0.0, 0))
            if sim > 0.4:
                want[i] = lines[-k][0]
                lines[-k] = (lines[-k][0], t, own)
            else:
                want[i] = i
                lines.append((i, t, own))
    assert {r["id"]: r["storyline_of"] for r in linking.assign_in_order(linking.with_tokens(incidents(spark, SF), "hint"), "country").collect()} == want


def test_centrist_clusters_equal_plain_python(spark):
    want = {}
    for rows in _by_country(spark, True).values():
        heads = []
        for i, _, own in rows:
            sim, k = max(((len(own & held) / len(own | held), -k) for k, (_, held) in enumerate(heads)), default=(0.0, 0))
            want[i] = heads[-k][0] if sim >= 0.4 else i
            if sim < 0.4:
                heads.append((i, own))
    e = linking.with_tokens(incidents(spark, SF), "hint")
    assert {r["id"]: r["cluster"] for r in linking.centrist_clusters(e, "country").collect()} == want
    assert {r["id"]: r["cluster"] for r in linking.centrist_clusters(e.repartition(7), "country").collect()} == want


def test_merged_runs_equal_plain_python(spark):
    runs = {}
    for r in sorted(incidents(spark, SF).select("id", "hint", "country", "anchor", "t", "severity").collect(), key=lambda r: (r["t"] is not None, r["t"] or 0, r["id"])):
        own = runs.setdefault(tuple(x for x in (r["hint"], r["country"], r["anchor"]) if x is not None), [])
        t = r["t"]
        if own and (t is None and own[-1][0]["t"] is None or t is not None and own[-1][0]["t"] is not None and t - own[-1][0]["t"] <= 24 * H):
            own[-1].append(r)
        else:
            own.append([r])
    want = {(x[0]["id"], len(x), max(r["severity"] for r in x)) for own in runs.values() for x in own}
    assert {(r["first_id"], r["members"], r["severity"]) for r in linking.anchored_runs(incidents(spark, SF), ["hint", "country", "anchor"], "t", "id", "severity").collect()} == want


def test_seqmatch_equals_difflib(spark):
    got = spark.createDataFrame([("abcd", "bcde"), ("", "a"), ("x" * 250 + "abc", "abc" + "x" * 250)], "a string, b string").select("a", "b", fuzzy.matcher_ratio("a", "b").alias("r")).collect()
    assert [r["r"] for r in got] == [difflib.SequenceMatcher(None, r["a"], r["b"]).ratio() if r["a"] and r["b"] else 0.0 for r in got]


def test_anchored_runs_start_at_their_first_event(spark):
    df = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 20 * H, 9), ("a", 3, 30 * H, 1), ("b", 4, None, 1), ("b", 5, None, 3), ("b", 6, 0, 1)], "k string, id long, t long, s int")
    got = {tuple(r) for r in linking.anchored_runs(df, ["k"], "t", "id", "s").collect()}
    assert got == {(1, 2, 9, 2), (3, 1, 1, 3), (4, 2, 3, 5), (6, 1, 1, 6)}


def test_similar_pairs_equal_brute_force(spark):
    texts = [(i, " ".join(f"w{(i * k) % 7}" for k in range(3 + i % 9))) for i in range(60)]
    df = spark.createDataFrame(texts, "id long, t string")
    sets = {}
    for i, t in texts:
        w = t.split()
        sets[i] = set(w) if len(w) < 4 else {" ".join(w[j : j + 4]) for j in range(len(w) - 3)}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.4}
    assert {(r["a"], r["b"]) for r in ingest.similar_pairs(df, "id", F.col("t"), 0.4).collect()} == want
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in ingest.link_counts(*ingest.similar_classes(df, "id", F.col("t"), 0.4)).collect()}
    assert got == {i: (min(j for j in sets if sets[j] == sets[i]), sum(i in p for p in want)) for i in sets}


def test_feeds_strict_and_forgiving():
    rss = '<rss><channel><item><title>A &amp; b</title><link>https://x.example/1</link><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate><source url="https://www.y.example/f">Y</source></item></channel></rss>'
    assert feeds.items_of(rss) == [("A & b", "https://x.example/1", None, "2024-01-01", "y.example")]
    assert feeds.items_of("<rss><item><title>A & b</title><link>l</link></item>") == [("A & b", "l", None, None, None)]
    assert feeds.items_of(None) == feeds.items_of("") == []


def test_json_repair():
    assert fuzzy.first_object('```json\n{"a": 1, "b": [2,],}\n```') == '{"a":1,"b":[2]}'
    assert fuzzy.first_object("no {broken") is None and fuzzy.first_object(None) is None
    assert fuzzy.all_objects('[{"a":1}, {"b": , {"c":{"d":2}}') == ['{"a":1}', '{"c":{"d":2}}']


def test_classifier_failure_keeps_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    assert fuzzy.classified(df, "t", ports.stub_classifier, "relevance int, llm_confidence double").where("relevance is not null").count() == 2

    def down(texts):
        raise OSError

    assert fuzzy.classified(df, "t", down, "relevance int, llm_confidence double").where("relevance is null").count() == 2


@pytest.mark.parametrize(("hint", "want"), [("  Port FIRE,  Jun8 unknown ", "port fire"), ("in-n-out nov20", "in-n-out"), ("Unknown", None), (None, None)])
def test_hint_normal(spark, hint, want):
    df = spark.createDataFrame([(hint,)], "t string")
    assert df.select(text.normalized_hint("t").alias("x")).first()["x"] == want


def test_day_labels(spark):
    rows = [("2026-01-02 10:00:00", None, "same_day", True), ("2026-01-02 10:00:00", None, "approximate", None), (None, "2026-01-03 00:00:00", None, True), (None, None, "this_week", True), ("2026-01-02 10:00:00", None, "same_day", False)]
    df = spark.createDataFrame(rows, "o string, p string, c string, v boolean").select(F.col("o").cast("timestamp_ntz").alias("o"), F.col("p").cast("timestamp_ntz").alias("p"), "c", "v")
    got = [r["x"] for r in df.select(text.day_label("o", "p", "c", "v").alias("x")).collect()]
    assert got == ["2026-01-02", "2026-01-02 (yaklaşık)", "2026-01-03 (tarih kaynağın yayın tarihine dayalı)", "tarih belirsiz (gün tahmini)", "2026-01-02 (tarih doğrulanmadı — yayın tarihi teyit edilemedi)"]


def test_fetching_asks_again(spark):
    def fetch(url):
        fetch.n = getattr(fetch, "n", 0) + 1
        if url == "down" or fetch.n % 2:
            raise OSError
        return None if url == "gone" else f"body of {url}"

    df = spark.createDataFrame([("a",), ("down",), ("gone",), (None,)], "u string").coalesce(1)
    assert {r["u"]: r["body"] for r in ports.fetched(df, "u", fetch).collect()} == {"a": "body of a", "down": None, "gone": None, None: None}


def test_bucket_waits():
    at = [0.0]
    b = ports.Bucket(2.0, 3.0, lambda: at[0])
    assert [b.take() for _ in range(5)] == [0, 0, 0, 0.5, 1.0]
    at[0] = 10.0
    assert b.take(3) == 0 and b.take() == 0.5


def test_a_long_chain_of_keys_takes_few_rounds(spark, monkeypatch):
    """Row i joins keys i and i + 1, so all are one stream; names are shuffled, so labels don't run along the chain."""
    n, rounds, real = 200, [], alerts.settled
    monkeypatch.setattr(alerts, "settled", lambda df: rounds.append(1) or real(df))
    name = [f"k{(i * 83) % n:03d}" for i in range(n)]
    df = spark.createDataFrame([(i, i, 1, name[i // 2], f"g{(i + 1) // 2}", True) for i in range(2 * n)], "id long, t long, rank int, key string, geo string, sent boolean")
    got = {r["id"]: r["decision"] for r in alerts.two_key_claims(df).collect()}
    held, want = {}, {}
    for i in range(2 * n):
        want[i] = alerts.claim(held, i, 1, [name[i // 2], f"g{(i + 1) // 2}"], True, 4)
    assert got == want
    assert len(rounds) < 16


def test_executors_get_the_package(tmp_path):
    """Two executors with no path to the repository import it from the zip in the shared folder."""
    import os
    import subprocess
    import sys

    from beacongrid.session import ROOT, packed

    assert packed() == packed()
    job = f"""
import sys
sys.path.insert(0, {ROOT!r})
import pyarrow as pa
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", {str(tmp_path)!r}).config("spark.ui.enabled", "false").getOrCreate()
from beacongrid.session import reachable
def where(batches):
    from beacongrid.functions import fuzzy
    for _ in batches:
        yield pa.RecordBatch.from_pylist([{{"at": fuzzy.__file__}}])
print("AT", [r["at"] for r in reachable(reachable(spark)).range(4).mapInArrow(where, "at string").distinct().collect()])
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", job], capture_output=True, text=True, env=env, cwd=tmp_path, timeout=180).stdout
    assert "AT ['" in out and ".zip/beacongrid/functions/fuzzy.py" in out and ROOT not in out
