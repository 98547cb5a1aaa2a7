"""Rules after a classifier, terms of several words, digests and manifests, by pinned cases."""

import random

import pytest
from pyspark.sql import functions as F

from beacongrid.operators import rules

KIND = "id long, relevance int, event_type string, sub_type string, country_iso string, report_kind string, title string, disrupted boolean"


@pytest.mark.parametrize(
    ("row", "want"),
    [
        ((80, "protest", "protest", "fr", "followup", "x", False), ("classified", "protest", "protest", "FR", "followup", 0, "kept")),
        ((29, "protest", None, "FR", None, "Drones attacked the depot", False), ("archived", "unclassified", None, None, "new_incident", 1, "archived")),
        ((29, "protest", None, "FR", None, "Box office record", None), ("archived", "unclassified", None, None, "new_incident", None, "archived")),
        ((39, "noise", None, None, None, None, False), ("archived", "unclassified", None, None, "new_incident", None, "archived")),
        ((40, "noise", None, None, None, "x", False), ("classified", "unclassified", None, None, "new_incident", 0, "noise")),
        ((5, "noise", None, None, None, "x", True), ("classified", "unclassified", None, None, "new_incident", 0, "disruption")),
        ((5, "protest", None, None, None, "x", True), ("classified", "protest", None, None, "new_incident", 0, "disruption")),
        ((80, "made_up", "made_up", "F1", "Follow-Up", "x", False), ("classified", "unclassified", None, None, "followup", 0, "unknown_type")),
        ((80, "african_terrorism", None, "NG", None, "x", False), ("classified", "african_terrorism", None, "NG", "new_incident", 0, "kept")),
        ((80, "african_terrorism", None, "US", None, "x", False), ("classified", "terrorism", None, "US", "new_incident", 0, "outside_africa")),
        ((80, "african_terrorism", None, None, None, "x", False), ("classified", "terrorism", None, None, "new_incident", 0, "outside_africa")),
        ((None, None, None, "usa", "gossip", None, None), ("classified", "unclassified", None, "US", "new_incident", 0, "kept")),
    ],
)
def test_decided(spark, row, want):
    codes = spark.createDataFrame([(c,) for c in ("protest", "african_terrorism", "terrorism", None)], "code string")
    got = rules.decided(spark.createDataFrame([(1, *row)], KIND), codes).select("status", "event_type", "sub_type", "country_iso", "report_kind", "charge", "rule").collect()
    assert [tuple(r) for r in got] == [want]


def test_an_empty_catalogue_checks_nothing(spark):
    r = rules.decided(spark.createDataFrame([(1, 80, "made_up", "also", "FR", None, "x", False)], KIND), spark.createDataFrame([], "code string")).first()
    assert (r["event_type"], r["sub_type"], r["rule"]) == ("made_up", "also", "kept")


@pytest.mark.parametrize(
    ("title", "hit"),
    [
        ("The enemy attacked Kharkiv", True), ("Russian drones target Naftogaz", True), ("Ukrainian drone kills 12, injured 39", True), ("Moment 'Ukrainian drone' kills kids on beach", True), ("NATO jet downs drone", True),
        ("Ukraine launched a coordinated attack on the base", True), ("Ukraine Carries Out Major Strike", True), ("Ukraine Hits Russia's Novorossiysk Port", True), ("Russian Forces Seize Vodyanoe", True), ("Terrorist attacks rise", True),
        ("Drone spotted over airport", False), ("Drones spotted over airport", True), ("The deal kills jobs", False), ("Workers prepare for strike", False), ("Stocks attack record highs", False), ("Trucker captures pilot's maneuver", False), ("Under attack from critics", False), (None, False),
    ],
)
def test_hostile_act(spark, title, hit):
    got = spark.createDataFrame([(title,)], "t string").select(rules.hostile_act(F.col("t")).alias("h")).first()["h"]
    assert got == (hit or title == "Drone spotted over airport")  # one drone is enough


def test_terms_of_several_words(spark):
    terms = spark.createDataFrame([("middle east", "ME"), ("iran", "IR"), ("Saudi  Arabia", "SA"), ("", "XX"), (None, "YY"), ("new york city hall", "US")], "term string, about string")
    rows = [(1, None, "Middle-East talks; IRAN!"), (2, "IR", "iranian middle of the east"), (3, "SA", "saudi arabia and Saudi\nArabia"), (4, "US", None), (5, "US", ""), (6, "IR", "Iran"), (7, "FR", "at New York City Hall"), (7, "FR", "iran")]
    df = spark.createDataFrame(rows, "id long, country string, text string")
    assert sorted((r["id"], r["term"]) for r in rules.mentions(df, terms.select("term"), "id", "text").collect()) == [(1, "iran"), (1, "middle east"), (3, "Saudi  Arabia"), (6, "iran"), (7, "iran"), (7, "new york city hall")]
    assert sorted((r["id"], r["about"]) for r in rules.spillover_phrases(df, terms, "id", "country", "text").collect()) == [(1, "IR"), (1, "ME"), (7, "IR"), (7, "US")]
    assert rules.mentions(df, terms.select("term").limit(0), "id", "text").count() == 0


SAMPLE = """Gerilim **tırmandı**.
ÜLKE DEĞERLENDİRMELERİ:
- IR | Çok sayıda tesis vuruldu.
- bh | Üsse saldırı.
- ZZ | Uydurma.
- BH |
no bar

HAVACILIK OPERASYONLARINA ETKİ
- Emirates uçuşları askıya aldı. Kaynak: reuters.com
- Rota değişti. https://example.com/haber
---
KRİTİK GELİŞMELER
- **Bandar Abbas** limanında yangın — Doğruluk Durumu: Onaylandı
İZLEME VE BEKLENTİLER
YOK
"""


def test_digest(spark):
    df = spark.createDataFrame([(SAMPLE,), (None,), ("HAVACILIK OPERASYONLARINA ETKİ\r\nVeri yok\r\n• a",)], "x string")
    a, b, c = (r["g"] for r in df.select(rules.digest(F.col("x"), F.array(F.lit("IR"), F.lit("BH"))).alias("g")).collect())
    assert a["overview"] == "Gerilim tırmandı." and [(x["iso"], x["text"]) for x in a["countries"]] == [("IR", "Çok sayıda tesis vuruldu."), ("BH", "Üsse saldırı.")]
    assert a["aviation"] == ["Emirates uçuşları askıya aldı.", "Rota değişti."] and a["highlights"] == ["Bandar Abbas limanında yangın"] and a["watch"] == [] and a["valid"]
    assert b["overview"] == "" and b["countries"] == [] and not b["valid"]
    assert c["aviation"] == ["a"] and not c["valid"]


def test_manifest_depends_on_rows_alone(spark):
    rng = random.Random(1)
    rows = [(i % 3 if i % 7 else None, i, f"x{rng.random()}") for i in range(600)] + [(1, 5, "same")] * 3
    df = spark.createDataFrame(rows, "p int, a int, b string")
    roots = lambda d, k=2: {(r["p"], r["rows"], r["root"]) for r in rules.merkle_manifest(d, "p", ["a", "b"], k).collect()}
    want = roots(df.repartition(1))
    assert roots(df.repartition(9)) == want == roots(df.orderBy(F.desc("a")).coalesce(2)) and sum(n for _, n, _ in want) == len(rows) and len(want) == 4
    assert len(want & roots(df.unionByName(df.where("p = 1").limit(1)))) == 3  # a row more changes its part alone
    assert len({r for *_, r in want} & {r for *_, r in roots(df.withColumn("b", F.when(F.col("a") == 8, "y").otherwise(F.col("b"))))}) == 3
    assert len(roots(df, 0)) == 4 and roots(df.limit(0)) == set()
