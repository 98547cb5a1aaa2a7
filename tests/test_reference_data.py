"""Airspace cards against a plain loop, merged reference tables, domains by rules, feeds as a data source."""

import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from beacongrid.functions import names
from beacongrid.operators import airspace
from beacongrid.sources import feed_source

FIRS = [("AAAA", ["A"], 0.0, 10.0, 0.0, 10.0), ("AABB", ["A", "B"], 0.0, 30.0, 0.0, 30.0), ("BBBB", ["B"], 10.0, 20.0, 10.0, 20.0), ("CCCC", ["C"], 40.0, 50.0, 40.0, 50.0), ("CCC1", ["C"], 41.0, 42.0, 41.0, 42.0)]
BORDERS = [("AAAA", "AABB"), ("AABB", "BBBB"), ("CCCC", "AABB"), ("CCC1", "CCCC")]
ZONES = [("B", "z1", None), ("B", "z2", "2030"), ("B", "z3", None), ("B", "z4", None)]
AIRPORTS = [(i, "ABC"[i % 3], i % 2, (i * 7) % 50 + 0.5, (i * 11) % 50 + 0.25) for i in range(30)]


def plain_cards(clusters, most):
    """One cluster after another, as a report is written."""
    countries = {f[0]: f[1] for f in FIRS}
    shut = {c for c, *_ in ZONES}
    restricted = lambda i: any(c in shut for c in countries[i])
    order = lambda ids: sorted(ids, key=lambda i: (not restricted(i), i))
    beside = lambda i: {b for a, b in BORDERS if a == i} | {a for a, b in BORDERS if b == i}
    out = {}
    for land in sorted({c[1] for c in clusters}):
        done, seen, firs_seen = [], set(), set()
        for i, _, where, sev, lat, lon, aviation in sorted((c for c in clusters if c[1] == land), key=lambda c: (-(c[3] if c[3] is not None else -1), c[0])):
            inside = [f for f in FIRS if lat is not None and lon is not None and f[2] <= lat <= f[3] and f[4] <= lon <= f[5]]
            if inside:
                best = min(inside, key=lambda f: (land not in f[1], (f[3] - f[2]) * (f[5] - f[4]), f[0]))[0]
                scope, firs, around = "point", [best], order(beside(best))
            else:
                own = [f[0] for f in FIRS if land in f[1]]
                if not own:
                    continue
                scope, firs, around = "country", order(own), order({b for a in own for b in beside(a)} - set(own))
            if scope == "country" and (firs[0] in firs_seen or not (aviation or any(map(restricted, firs)))):
                continue
            key = (firs[0], (where or "").strip().lower())
            if key in seen:
                continue
            seen.add(key)
            firs_seen.add(firs[0])
            done.append((i, scope, firs, around))
            if len(done) == most:
                break
        out[land] = done
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cards_equal_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    clusters = [(i, rng.choice("ABCX"), rng.choice(["Dock", "dock ", "Mall", None]), rng.choice([10, 50, 50, 90, None]), *((rng.uniform(0, 60), rng.uniform(0, 60)) if rng.random() < 0.6 else (None, None)), rng.random() < 0.3) for i in range(60)]
    df = spark.createDataFrame(clusters, "id long, country string, location string, severity int, lat double, lon double, aviation boolean")
    made = airspace.cards(
        df, spark.createDataFrame(FIRS, "icao string, countries array<string>, south double, north double, west double, east double"), spark.createDataFrame(BORDERS, "a string, b string"),
        spark.createDataFrame(ZONES, "country string, zone string, valid_until string"), spark.createDataFrame(AIRPORTS, "place_id long, country string, tier int, lat double, lon double"), radius=900.0, most_cards=4,
    )
    got = {}
    for r in sorted(made.collect(), key=lambda r: (r["country"], r["place_rank"])):
        got.setdefault(r["country"], []).append((r["id"], r["scope"], [f["icao"] for f in r["firs"]], [f["icao"] for f in r["neighbours"] or []]))
        assert all(len(f["czib"]) <= 3 and f["free"] == (not f["czib"]) for f in r["firs"])
        assert r["scope"] == "country" or [a["km"] for a in r["airports"] or []] == sorted(a["km"] for a in r["airports"] or [])
    want = {k: v for k, v in plain_cards(clusters, 4).items() if v}
    assert got == want
    small = airspace.compact(made, 1).withColumn("line", airspace.summary_line(F.col("firs"), F.col("more_firs"))).where("country = 'B' and scope = 'country'").collect()
    assert all(r["line"] == "AABB* +1" and [z for f in r["firs"] for z in f["zones"]] == ["z1", "z2", "z3"] for r in small)


def test_merged_reference(spark):
    kind = "code string, name string, country string, lat double, lon double"
    curated = spark.createDataFrame([("AAA", "good", "A", 5.0, 5.0), ("BBB", "away", "B", 5.0, 50.0), (None, "none", "A", 5.0, 5.0), ("EEE", "nan", "A", float("nan"), 1.0)], kind)
    seeded = spark.createDataFrame([("aaa", "old", "A", 1.0, 1.0), ("BBB", "kept", "b", 15.0, 15.0), ("BBB", "kept", "b", 15.0, 15.0), ("CCC", "x", "XX", 1.0, 1.0), ("DDD", "x", "Z", 91.0, 1.0), ("FFF", "free", "Z", 1.0, 1.0)], kind)
    boxes = spark.createDataFrame([(1, "A", 0.0, 10.0, 0.0, 10.0), (2, "B", 10.0, 20.0, 10.0, 20.0), (3, "B", 60.0, 70.0, 0.0, 1.0)], "box_id int, box_country string, south double, north double, west double, east double")
    got = sorted((r["code"] or "", r["origin"], r["name"], r["reason"] or "") for r in airspace.merged_reference([("curated", curated), ("seeded", seeded)], boxes).collect())
    assert got == [
        ("", "curated", "none", "no code"), ("AAA", "curated", "good", ""), ("AAA", "seeded", "old", "superseded"), ("BBB", "curated", "away", "outside its country"), ("BBB", "seeded", "kept", ""), ("BBB", "seeded", "kept", "superseded"),
        ("CCC", "seeded", "x", "no country"), ("DDD", "seeded", "x", "out of range"), ("EEE", "curated", "nan", "no coordinates"), ("FFF", "seeded", "free", ""),
    ]
    assert airspace.merged_reference([("seeded", seeded.limit(0))], boxes).count() == 0


def test_country_of_a_city(spark):
    df = spark.createDataFrame([("Lagos",), ("New Lagos Port",), ("oslo",), ("Nowhere",), (None,), ("Port Said by Lagos",)], "n string")
    assert [r["c"] for r in df.select(airspace.country_of(F.col("n"), {"port said": "EG", "lagos": "NG", "oslo": "NO"}).alias("c")).collect()] == ["NG", "NG", "NO", "XX", "XX", "EG"]


@pytest.mark.parametrize(
    ("host", "suffix", "domain"),
    [("a.b.example.com", "com", "example.com"), ("b.co.uk", "co.uk", "b.co.uk"), ("a.b.co.uk", "co.uk", "b.co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.y.ck", "y.ck", "x.y.ck"), ("y.ck", "y.ck", "y.ck"), ("a.www.ck", "ck", "www.ck"), ("www.ck", "ck", "www.ck"), ("ck", "ck", "ck"), ("a.b.unknown", "unknown", "b.unknown"), ("A.Example.COM.", "com", "example.com"), ("localhost", "localhost", "localhost")],
)
def test_registrable_by_rules(spark, host, suffix, domain):
    rules = spark.createDataFrame([(r,) for r in ("com", "co.uk", "uk", "*.ck", "!www.ck", "ck", "// remark", "", None)], "rule string")
    r = names.registrable_by(spark.createDataFrame([(host,), (host,), (None,), ("",)], "h string"), "h", rules).collect()
    assert [(x["suffix"], x["domain"]) for x in r] == [(suffix, domain)]


RSS = '<rss><channel><item><title>One</title><link>http://x/1</link><pubDate>Mon, 29 Jan 2024 10:00:00 +0100</pubDate><source url="https://www.pub.example/f">P</source></item><item><title>Old</title><link>http://x/2</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item><item><title>Undated</title><link>http://x/3</link></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Two</title><link href="http://x/4"/><published>2024-01-30T00:00:00Z</published></entry></feed>'
BROKEN = '<rss><channel><item><title>A &nbsp; <br> B</title><link>http://x/5</link><pubDate>Tue, 30 Jan 2024 00:00:00 GMT</pubDate></item><entry><title>C</title><link href="http://x/6"/><published>2024-01-30T05:00:00+02:00</published></entry>'


def test_landed_feeds(spark, tmp_path):
    for name, xml in (("a.xml", RSS), ("b.xml", ATOM), ("c.xml", BROKEN), ("d.xml", "not a feed"), ("e.xml", "<rss><channel/></rss>")):
        (tmp_path / name).write_text(xml)
    (tmp_path / "more.jsonl").write_text("\n".join([json.dumps({"feed": "f1", "xml": ATOM}), "{broken", json.dumps({"feed": "f2", "xml": None}), ""]))
    feeds = lambda **o: feed_source.register(spark).read.format("landed_feeds").options(**o).load(str(tmp_path))
    got = {(r["feed"].rpartition("/")[2], r["title"], r["link"], r["kind"], r["domain"]) for r in feeds(as_of="2024-01-31", bytes="1").collect()}
    assert got == {
        ("a.xml", "One", "http://x/1", "strict", "pub.example"), ("b.xml", "Two", "http://x/4", "strict", None), ("c.xml", "A \xa0 <br> B", "http://x/5", "lenient", None), ("c.xml", "C", "http://x/6", "lenient", None), ("d.xml", None, None, "corrupt", None),
        ("f1", "Two", "http://x/4", "strict", None), ("more.jsonl", None, None, "corrupt", None), ("f2", None, None, "corrupt", None),
    }
    assert feeds(as_of="2024-01-31", bytes="1").rdd.getNumPartitions() == 6
    assert {r["title"] for r in feeds().collect()} == {"One", "Old", "Two", "A \xa0 <br> B", "C", None}
    assert "Undated" in {r["title"] for r in feeds(dated="false").collect()}
    assert {r["corrupt_record"] for r in feeds().where("kind = 'corrupt'").collect()} == {"not a feed", "{broken", None}
    (tmp_path / "none").mkdir()
    assert feed_source.register(spark).read.format("landed_feeds").load(str(tmp_path / "none")).count() == 0


def test_advisories_are_dated_items(spark, tmp_path):
    item = lambda t, d, day: f"<item><title>{t}</title><link>http://gov/x</link><description>{d}</description><pubDate>{day}</pubDate></item>"
    texts = [("Level 3: go", "", "30 Jan 2024"), ("Level 2", "advisory raised", "Mon, 29 Jan 2024"), ("Level 4", "&lt;p&gt;no change&lt;/p&gt;", "2024-01-30"), ("Level 1", "", "2024-01-30"), ("Do not travel", "", "2024-01-10"), ("Level 4", "", "")]
    (tmp_path / "us.xml").write_text("<rss><channel>" + "".join(item(*t) for t in texts) + "</channel></rss>")
    (tmp_path / "curated.xml").write_text("<rss><channel>" + item("Change of note", "", "2024-01-28") + "</channel></rss>")
    got = feed_source.register(spark).read.format("landed_feeds").options(advisories="true", curated="curated", as_of="2024-01-31").load(str(tmp_path)).collect()
    assert {(r["title"], r["link"]) for r in got} == {("Level 3: go", "http://gov/x#adv-20240130"), ("Level 2", "http://gov/x#adv-20240129"), ("Change of note", "http://gov/x#adv-20240128")}


def test_moments():
    at = datetime(2024, 1, 30, tzinfo=UTC)
    assert all(feed_source.moment(t) == at for t in ("2024-01-30", "2024-01-30T00:00:00Z", "2024-01-30T02:00:00+02:00", "Tue, 30 Jan 2024 00:00:00 GMT", "Tue, 30 Jan 2024", "30 Jan 2024", "2024-01-30 00:00:00"))
    assert feed_source.moment("soon") is None and feed_source.moment(" ") is None and feed_source.moment(None) is None
