"""What grows with the square of a group, or lands in one task, stays small: plans and results on tables with large groups."""

import io
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from beacongrid.functions import text
from beacongrid.operators import forecast, linking, storylines
from beacongrid.params import Linking
from beacongrid.plans import queries as q
from beacongrid.sources import feed_source

SF, HOUR = "/root/testdata/sf0.001", 3_600_000_000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def located(spark, n: int, seed: int):
    """n rows of few hints, places and anchors, some without a country, a time or an anchor, or with an empty one."""
    rng = random.Random(seed)
    hint = lambda: " ".join(rng.choice(["harbor", "fire", "sector", "north", "rail", "zone", "seven", "update"]) for _ in range(rng.randint(0, 4)))
    rows = [(i, rng.choice([None, *[rng.randint(0, 400) * HOUR] * 9]), rng.choice(["A", "A", "B", None]), rng.choice([None, "", "x", "X", "y"]), rng.choice([None, None, "p", "r"]), hint()) for i in range(n)]
    return linking.with_tokens(spark.createDataFrame(rows, "id long, t long, country string, anchor string, place string, hint string").repartition(3), "hint")


@pytest.mark.parametrize("words", [None, [], ["fire", "rail"]])
def test_linked_pairs_are_those_of_all_pairs(spark, words):
    df = located(spark, 120, 5)
    a, b = (df.select(F.struct("id", "t", "country", "anchor", "place", "tokens", "unigrams").alias(k)) for k in "ab")
    all_ = a.crossJoin(b).where("a.id < b.id")
    ambient = None if words is None else spark.createDataFrame([(words,)], "words array<string>")
    want = all_.where(linking.linked("a", "b") if words is None else storylines.linked_under("a", "b", F.array(*map(F.lit, words)).cast("array<string>")))
    want = sorted(tuple(r) for r in want.select("a.id", "b.id", text.jaccard(F.col("a.tokens"), F.col("b.tokens"))).toDF("a", "b", "s").collect())
    got = linking.linked_pairs(df, "id", ambient)
    assert want and sorted(tuple(r) for r in got.collect()) == want
    first = {}
    for x, y, s in want:
        first[y] = min(first.get(y, (0, 0)), (-s, x)) if y in first else (-s, x)
    assert {r["b_id"]: (-r["similarity"], r["a_id"]) for r in linking.best_match(got).collect()} == first


@pytest.mark.parametrize("name", ["storyline_pairs", "storyline_pairs_telling"])
def test_pairs_are_not_shuffled(spark, name):
    """Pairs leave the joins as they are: none are counted, sorted or dealt out again."""
    above = plan(q.QUERIES[name](spark, SF)).split("Join")[0]
    assert not any(x in above for x in ("Aggregate", "Exchange", "Window"))


def test_best_match_shuffles_one_pair_a_similarity(spark):
    above = plan(q.QUERIES["storyline_best"](spark, SF)).split("Join")[0]
    assert above.count("Exchange") == 2 and "partial_min(a_id" in above


def test_an_event_meets_few_open_storylines():
    """Hints that share a word with all others don't bring all open storylines to each event."""

    class Seen(dict):
        n = 0

        def __getitem__(self, k):
            Seen.n += 1
            return super().__getitem__(k)

    held, rng = storylines.OpenStorylines(Linking(), frozenset(["sector"])), random.Random(1)
    held.open = Seen()
    for i in range(6000):
        words = [rng.choice(["harbor fire", "border clash", "rail strike", "power outage"]), "sector", str(rng.randrange(30))]
        uni = " ".join(words).split()
        held.expire(i * HOUR // 100)
        held.add({"id": i, "t": i * HOUR // 100, "country": rng.choice([None, *(f"N{k}" for k in range(25))]), "anchor": None, "place": rng.choice([None, "p"]), "tokens": uni + [f"{a} {b}" for a, b in zip(uni, uni[1:], strict=False)], "unigrams": uni})
    assert len(held.open) > 150 and Seen.n < 30 * 6000


@pytest.mark.parametrize("most", [1, 3])
@pytest.mark.parametrize("place", [None, "place"])
def test_candidates_are_those_of_all_pairs(spark, place, most):
    df = located(spark, 160, 9)
    a, b = (df.select(F.struct("id", "t", "country", "place", "unigrams").alias(k)) for k in "ab")
    kin = F.when(F.col("a.country") == F.col("b.country"), text.jaccard(F.col("a.unigrams"), F.col("b.unigrams")))
    if place:
        kin = F.when((F.col("a.place") == F.col("b.place")) & F.coalesce(F.col("a.country") == F.col("b.country"), F.lit(True)), 1.0).otherwise(kin)
    every = a.crossJoin(b).where((F.col("a.id") != F.col("b.id")) & (F.abs(F.col("a.t") - F.col("b.t")) <= 48 * HOUR)).select("a.id", "b.id", kin).toDF("a", "b", "kin").where("kin >= 0.1").collect()
    want = []
    for i in {r["a"] for r in every}:
        want += sorted(((r["a"], r["b"], r["kin"]) for r in every if r["a"] == i), key=lambda r: (-r[2], r[1]))[:most]
    got = linking.adjudication_candidates(df, "id", "country", most=most, place=place)
    assert want and sorted(tuple(r) for r in got.select("a_id", "b_id", "kin").collect()) == sorted(want)


def test_candidates_of_one_hint_are_not_all_its_pairs(spark):
    """2,000 rows of one hint, country and hour have 4 million pairs; each row takes six."""
    df = spark.range(2000).select("id", F.lit("A").alias("country"), (F.col("id") * 1000).alias("t"), F.array(F.lit("harbor"), F.lit("fire")).alias("unigrams"))
    got = linking.adjudication_candidates(df, "id", "country")
    assert "MapInPandas" in plan(got)
    assert got.where("b_id < 7").count() == got.count() == 12000


@pytest.mark.parametrize("ahead", [False, True])
def test_sums_within_reach_are_those_of_a_sliding_window(spark, ahead):
    rng = random.Random(2)
    rows = [(i, rng.choice(["A", "B", None]), rng.choice([None, *[rng.randint(-50, 50)] * 8]), rng.randint(0, 3)) for i in range(300)]
    for span in (1, 7, 24, 1000):
        want = {i: sum(v for _, c, u, v in rows if c == g and u is not None and (t <= u <= t + span if ahead else t - span <= u <= t)) for i, g, t, _ in rows if t is not None}
        got = forecast.within_reach(spark.createDataFrame(rows, "id long, g string, t long, v int").repartition(3), "g", "t", span, F.col("v"), "n", ahead)
        assert {r["id"]: r["n"] for r in got.collect()} == want


@pytest.mark.parametrize("name", ["new_activity", "flash_verified"])
def test_no_frame_slides(spark, name):
    """A frame with two moving ends is added up anew for each row."""
    frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]+), ", plan(q.QUERIES[name](spark, SF)))
    assert frames and all(f == "unboundedpreceding$()" for f in frames)


def test_points_of_one_small_cell_do_not_meet_each_other(spark):
    """90 points within 14 km, each with events of every stretch: events stay as many as they are, though all points lie within reach."""
    df = spark.range(4000).selectExpr("id", "id * 3600000 AS t", "'A' AS country", "CASE WHEN id % 400 = 0 THEN 'y' ELSE 'x' END AS event_type", "CAST(NULL AS STRING) AS anchor", "CAST(10 + id % 10 / 100D AS DOUBLE) AS lat", "CAST(20 + id % 9 / 100D AS DOUBLE) AS lon")
    got = linking.co_located(df)
    assert got.count() == 4000 - 399
    assert "lag(" not in plan(got) and "lat2#" not in plan(got)


def test_large_files_of_lines_are_cut(spark, tmp_path):
    """Each line comes once, whatever range it begins in, and no task holds a file."""
    xml = "<rss><channel><item><title>T</title><link>http://x/1</link></item></channel></rss>"
    with open(tmp_path / "a.jsonl", "w") as f:
        for i in range(9000):
            f.write(json.dumps({"feed": f"f{i}", "xml": xml, "more": "é" * (i % 97)}, ensure_ascii=False) + "\n" * (i % 3 + 1))
    got = feed_source.register(spark).read.format("landed_feeds").options(dated="false", bytes="1").load(str(tmp_path))
    assert got.rdd.getNumPartitions() == 2
    assert sorted(r["feed"] for r in got.where("kind = 'strict'").collect()) == sorted(f"f{i}" for i in range(9000)) and got.count() == 9000


def test_lines_of_ranges_are_all_lines():
    rng = random.Random(4)
    for _ in range(500):
        data = b"".join(bytes(rng.choices(b"ab\n\n", k=rng.randint(0, 30))) for _ in range(rng.randint(0, 4)))
        most, block = rng.randint(1, 12), rng.randint(1, 9)
        got = [x for at in range(0, len(data), most) for x in feed_source.lines_of(io.BytesIO(data), at, min(at + most, len(data)), block) if x]
        assert got == [x for x in data.split(b"\n") if x]


def test_equal_points_and_places_of_one_spot_meet_once(spark):
    """2,000 points at one spot and 2,000 places at another are 4 million hits; each point takes three."""
    a = spark.range(2000).selectExpr("id", "10D AS lat", "20D AS lon")
    b = spark.range(2000).selectExpr("id AS place_id", "10.5D AS lat", "20D AS lon", "CAST(id % 3 AS INT) AS tier")
    got = linking.nearby(a, b, 600.0, 3)
    assert sorted({(r["place_id"], r["k"]) for r in got.collect()}) == [(0, 1), (3, 2), (6, 3)] and got.count() == 6000
    ranked = plan(q.QUERIES["nearby_airports"](spark, SF)).split("windowspecdefinition(")[1]
    assert ranked.startswith("cell#")
