"""Storylines: candidate pairs, best matches, sequential assignment, clusters, timelines."""

from __future__ import annotations

import bisect
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, haversine
from ..functions.text import containment, hint_tokens, hint_words, jaccard
from ..params import Linking, Vocabulary
from ..session import settled


def with_tokens(df: DataFrame, hint: str, v: Vocabulary = Vocabulary()) -> DataFrame:
    return df.withColumn("tokens", hint_tokens(hint, v)).withColumn("unigrams", F.array_distinct(hint_words(hint, v)))


def common_tokens(df: DataFrame, storyline: str, least: int = 3) -> DataFrame:
    """(token, storylines): words that stand in `least` storylines or more, so that they tell none apart."""
    return df.select(storyline, F.explode("unigrams").alias("token")).groupBy("token").agg(F.countDistinct(storyline).alias("storylines")).where(F.col("storylines") >= least)


def linked(a: str, b: str, p: Linking = Linking(), v: Vocabulary = Vocabulary()) -> Column:
    """Whether two events (structs with t in microseconds, country, anchor, place, tokens, unigrams) belong to one storyline."""
    x, y = F.col(a), F.col(b)
    gap = F.abs(x["t"] - y["t"])
    hours = lambda n: F.lit(n * 3_600_000_000)
    sim = jaccard(x["tokens"], y["tokens"])
    shared = F.array_intersect(x["unigrams"], y["unigrams"])
    telling = F.filter(shared, lambda w: ~w.isin(*v.shared_words))
    by_words = (sim > p.jaccard) & (F.size(telling) > 0)
    by_parts = (gap <= hours(p.containment_hours)) & (F.size(shared) >= 2) & (F.size(telling) >= 1) & (containment(x["unigrams"], y["unigrams"]) >= p.containment)
    same_anchor = F.coalesce(F.upper(x["anchor"]) == F.upper(y["anchor"]), F.lit(False))
    by_anchor = same_anchor & ((gap <= hours(p.assist_hours)) | (sim >= p.assist))
    by_place = ~same_anchor & F.coalesce(x["place"] == y["place"], F.lit(False)) & (sim >= p.assist)
    land = F.coalesce(x["country"] == y["country"], F.lit(True))
    return F.coalesce(gap <= hours(24 * p.days), F.lit(False)) & land & (by_words | by_parts | by_anchor | by_place)


def candidate_pairs(df: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    """(a, b) structs of rows that share a blocking key and whose countries don't differ, each pair once. Rows without a country meet those of every country. A pair that no key joins can't be linked if keys cover every linking path."""
    cols = ["id", "t", "country", "anchor", "place", "tokens", "unigrams"]
    row = df.select(F.struct(F.col(id_col).alias("id"), *cols[1:]).alias("e"), F.explode(F.array_distinct(F.array_compact(F.flatten(F.array(*keys))))).alias("k"))
    other = row.select("k", F.col("e").alias("b"))
    home = row.where("e.country is not null").select("k", F.col("e.country").alias("c"), F.col("e").alias("a"))
    same = home.join(other.withColumn("c", F.col("b.country")), ["k", "c"]).where("a.id < b.id").select("a", "b")
    free = row.where("e.country is null").select("k", F.col("e").alias("a")).join(other, "k").where("a.id < b.id or (a.id > b.id and b.country is not null)")
    swap = F.col("a.id") > F.col("b.id")
    free = free.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))
    return same.unionByName(free).withColumn("_a", F.col("a.id")).withColumn("_b", F.col("b.id")).dropDuplicates(["_a", "_b"]).drop("_a", "_b")


def linked_pairs(df: DataFrame, id_col: str, ambient: DataFrame | None = None, p: Linking = Linking(), v: Vocabulary = Vocabulary()) -> DataFrame:
    """(a_id, b_id, similarity): the pairs that `linked` links, or storylines.linked_under if `ambient` (one row: words) is given, each once, the smaller id first.

    Pairs are never shuffled. Words decide between classes of rows of one country and hint, so classes meet first, each two by the least word they share that tells; rows of linked classes then meet, and rows of
    one anchor or place, by stretches of time. A pair comes by its words, else by its anchor, else by its place. Rows: id, t, country, anchor, place, tokens, unigrams; a row without t is in no pair.
    """
    hour, span = 3_600_000_000, p.days * 86_400_000_000
    by, none = ["country", "tokens", "unigrams"], F.array().cast("array<string>")
    anchor = F.upper("anchor") if ambient is None else F.upper(F.nullif(F.col("anchor"), F.lit("")))
    row = settled(df.where("t is not null").select(F.col(id_col).alias("id"), "t", *by, anchor.alias("anchor"), "place", F.floor(F.col("t") / span).alias("h")))
    classes = settled(row.groupBy(*by).agg(F.min("id").alias("c")))
    told = lambda pairs: pairs.withColumn("words", none) if ambient is None else pairs.crossJoin(F.broadcast(ambient))  # noqa: E731  one row
    near = lambda rows: rows.withColumn("h", F.explode(F.array(F.col("h") - 1, F.col("h"), F.col("h") + 1)))
    tells = lambda words: F.filter(words, lambda w: ~w.isin(*v.shared_words))

    gap, sim = F.abs(F.col("a.t") - F.col("b.t")), jaccard(F.col("a.tokens"), F.col("b.tokens"))
    shared = F.array_intersect(F.col("a.unigrams"), F.col("b.unigrams"))
    by_words = (sim > p.jaccard) & (F.size(tells(shared)) > 0)
    by_parts = (F.size(shared) >= 2) & (F.size(F.array_except(tells(shared), F.col("words"))) >= 1) & (containment(F.col("a.unigrams"), F.col("b.unigrams")) >= p.containment)

    kinds = classes.select(F.struct("c", *by).alias("e"), F.explode(F.array_distinct(tells(F.col("unigrams")))).alias("w"))
    akin = told(_compatible(kinds, kinds, ["w"]).where(F.col("w") == F.array_min(tells(shared))))
    akin = akin.select(F.col("a.c").alias("ca"), F.col("b.c").alias("cb"), sim.alias("similarity"), F.when(by_words, span).when(by_parts, min(span, p.containment_hours * hour)).alias("within")).where("within is not null")
    named = classes.select(*(F.col(k).alias(f"_{k}") for k in by), "c")
    of = row.join(named, row["country"].eqNullSafe(named["_country"]) & (row["tokens"] == named["_tokens"]) & (row["unigrams"] == named["_unigrams"])).select("id", "t", "h", "c")
    a, b = of.select(F.col("id").alias("a_id"), "t", "h", F.col("c").alias("ca")), near(of).select(F.col("id").alias("b_id"), F.col("t").alias("u"), "h", F.col("c").alias("cb"))
    words = a.join(akin, "ca").join(b, ["cb", "h"]).where((F.col("a_id") < F.col("b_id")) & (F.abs(F.col("t") - F.col("u")) <= F.col("within"))).select("a_id", "b_id", "similarity")

    e = row.select("h", "anchor", "place", F.struct("id", "t", *by, "anchor").alias("e"))
    first = (F.col("a.id") < F.col("b.id")) & (gap <= span) & ~(by_words | by_parts & (gap <= p.containment_hours * hour))
    same = F.coalesce(F.col("a.anchor") == F.col("b.anchor"), F.lit(False))
    ends = lambda pairs, how: told(pairs).where(first & how).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), sim.alias("similarity"))
    at = lambda k: _compatible(e.where(F.col(k).isNotNull()), near(e.where(F.col(k).isNotNull())), [k, "h"])
    return words.unionByName(ends(at("anchor"), (gap <= p.assist_hours * hour) | (sim >= p.assist))).unionByName(ends(at("place"), ~same & (sim >= p.assist)))


def _compatible(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, b: the rows `e` (structs with country) of both sides under equal keys, where countries don't differ; a missing one meets all."""
    a, b = a.select(*keys, F.col("e.country").alias("_g"), F.col("e").alias("a")), b.select(*keys, F.col("e.country").alias("_g"), F.col("e").alias("b"))
    some, free = F.col("_g").isNotNull(), F.col("_g").isNull()
    out = a.where(some).join(b.where(some), [*keys, "_g"]).drop("_g")
    return out.unionByName(a.where(free).drop("_g").join(b.drop("_g"), keys)).unionByName(a.where(some).drop("_g").join(b.where(free).drop("_g"), keys))


def best_match(pairs: DataFrame) -> DataFrame:
    """For each b, the a of the greatest similarity; ties by the smallest id: (b_id, similarity, a_id). Pairs are counted together where they are made, so only one for each b and similarity is shuffled."""
    least = pairs.groupBy("b_id", "similarity").agg(F.min("a_id").alias("a_id"))
    w = Window.partitionBy("b_id").orderBy(F.desc("similarity"))
    return least.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def assign_in_order(df: DataFrame, block: str, p: Linking = Linking()) -> DataFrame:
    """(id, storyline_of): events of a block, in time order, each joining the storyline of the most similar newest member, or opening its own, named by its id.

    The result depends on order, so a block is one stream: rows are dealt by block and sorted, and only the newest event of each storyline within the time window is held, by its tokens, so that a row meets
    only storylines it shares one with. Ties go to the storyline opened first.
    Rows: block, id, t (microseconds), unigrams, tokens.
    """
    span = p.days * 86_400_000_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, open_, by, opened = None, {}, {}, itertools.count()

        def close(name: int) -> None:
            for w in open_.pop(name)[1]:
                by[w].discard(name)

        for pdf in batches:
            out = []
            for k, i, t, tokens in zip(pdf["k"].tolist(), pdf["i"].tolist(), pdf["t"].tolist(), pdf["tokens"].tolist(), strict=True):
                if k != at:
                    at, open_, by = k, {}, {}
                own, best, best_sim = set(tokens), None, p.jaccard
                shared = Counter(s for w in own for s in by.get(w, ()))
                for s, n in shared.items():
                    last, held, place = open_[s]
                    if t - last > span:
                        close(s)
                        continue
                    sim = n / (len(own) + len(held) - n)
                    if sim > best_sim or best is not None and sim == best_sim and place < open_[best][2]:
                        best, best_sim = s, sim
                name, place = (i, next(opened)) if best is None else (best, open_[best][2])
                if best is not None:
                    close(name)
                open_[name] = (t, own, place)
                for w in own:
                    by.setdefault(w, set()).add(name)
                out.append((i, name))
            for s in [s for s, (last, *_) in open_.items() if len(pdf) and t - last > span]:
                close(s)
            yield pd.DataFrame(out, columns=["id", "storyline_of"]).astype("int64")

    rows = df.where("t is not null").select(F.col(block).alias("k"), F.col("id").alias("i"), "t", "tokens")
    return rows.repartition("k").sortWithinPartitions("k", "t", "i").mapInPandas(run, "id long, storyline_of long")


def anchored_runs(df: DataFrame, keys: list[str], micros: str, id_col: str, severity: str, hours: int = 24) -> DataFrame:
    """Merges equal rows into runs no longer than `hours` from the run's first event: (keys, first, members, severity, title_id: of the most severe).

    A run's start depends on the run before, so rows stream through in order, by key; only the open run is held.
    """
    span = hours * 3_600_000_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            out = []
            for k, t, i, s in zip(pdf["k"].tolist(), pdf["t"].tolist(), pdf["i"].tolist(), pdf["s"].tolist(), strict=True):
                t = None if t is None or t != t else int(t)
                near = held is not None and held[0] == k and (t is None and held[1] is None or t is not None and held[1] is not None and t - held[1] <= span)
                if near:
                    held[3] += 1
                    if s > held[4]:
                        held[4], held[5] = s, i
                else:
                    if held is not None:
                        out.append(tuple(held))
                    held = [k, t, i, 1, s, i]
            yield pd.DataFrame(out, columns=list("ktfnsi")).astype({"t": "Int64"})
        if held is not None:
            yield pd.DataFrame([tuple(held)], columns=list("ktfnsi")).astype({"t": "Int64"})

    rows = df.select(F.concat_ws("\x1f", *keys).alias("k"), F.col(micros).alias("t"), F.col(id_col).alias("i"), F.col(severity).alias("s"))
    out = rows.repartition("k").sortWithinPartitions("k", F.asc_nulls_first("t"), "i").mapInPandas(run, "k string, t long, f long, n long, s int, i long")
    return out.select(F.col("f").alias("first_id"), F.col("n").alias("members"), F.col("s").alias("severity"), F.col("i").alias("title_id"))


def centrist_clusters(df: DataFrame, block: str, least: float = 0.40) -> DataFrame:
    """(id, cluster): in order of t and id, each row joins the cluster whose first member is the most similar, from `least` on (ties: the earlier), or opens one named by its id. Held: the first members of one block, by their tokens, so that a row meets only those it shares one with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, heads, by = None, [], {}
        for pdf in batches:
            out = []
            for k, i, tokens in zip(pdf["k"].tolist(), pdf["i"].tolist(), pdf["tokens"].tolist(), strict=True):
                if k != at:
                    at, heads, by = k, [], {}
                own = frozenset(tokens)
                shared = Counter(h for w in own for h in by.get(w, ()))
                best = min(((-sim, h) for h, n in shared.items() if (sim := n / (len(own) + heads[h][1] - n)) >= least), default=None)
                if best is None:
                    for w in own:
                        by.setdefault(w, []).append(len(heads))
                    heads.append((i, len(own)))
                out.append((i, i if best is None else heads[best[1]][0]))
            yield pd.DataFrame(out, columns=["id", "cluster"]).astype("int64")

    rows = df.select(F.col(block).alias("k"), F.col("id").alias("i"), "t", "tokens")
    return rows.repartition("k").sortWithinPartitions("k", F.asc_nulls_first("t"), "i").mapInPandas(run, "id long, cluster long")


def timeline(df: DataFrame, group: str, *order: Column) -> DataFrame:
    return df.withColumn("seq", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def head_tail(df: DataFrame, group: str, order: list[Column], head: int = 5, tail: int = 55) -> DataFrame:
    """The first and last rows of long groups; short ones whole."""
    n = F.count("*").over(Window.partitionBy(group))
    return timeline(df, group, *order).withColumn("_n", n).where((F.col("_n") <= head + tail) | (F.col("seq") <= head) | (F.col("seq") > F.col("_n") - tail)).drop("_n")


def severity_trend(df: DataFrame, group: str, order: list[Column], severity: str, step: float = 5.0) -> DataFrame:
    """Later half's mean less the first half's: rising, falling or steady."""
    n = F.count("*").over(Window.partitionBy(group))
    half = timeline(df, group, *order).withColumn("late", F.col("seq") > F.floor(n / 2))
    g = half.groupBy(group).agg(F.avg(F.when(F.col("late"), F.col(severity))).alias("b"), F.avg(F.when(~F.col("late"), F.col(severity))).alias("a"))
    d = F.col("b") - F.coalesce("a", "b")
    return g.select(group, F.when(d > step, "rising").when(d < -step, "falling").otherwise("steady").alias("trend"))


def summaries(df: DataFrame, group: str, micros: str, severity: str, domain: str) -> DataFrame:
    """Events, sources, span in hours and peak of each storyline."""
    return df.groupBy(group).agg(
        F.count("*").alias("n_events"), F.countDistinct(domain).alias("n_sources"), F.round((F.max(micros) - F.min(micros)) / 3_600_000_000, 1).alias("span_hours"), F.max(severity).alias("peak"), F.sum((F.col(severity) >= 80).cast("long")).alias("severe")
    )


def cells(lat: Column, lon: Column, km: float) -> tuple[Column, Column]:
    """A point's own cell, and those in which its neighbours within `km` lie, as (cy, cx) structs: bands of latitude as high as the radius, cut into equal columns at least as wide as the radius where the band lies
    nearest to a pole. Columns go round the globe; around a pole there is one."""
    deg = km / 111.0
    reach = math.sin(min(math.pi / 2, km / EARTH_KM))
    narrow = lambda cy: F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(cy), F.abs(cy + 1)) * deg)))
    columns = lambda cy: F.when(narrow(cy) > 1.01 * reach, F.greatest(F.lit(1), F.floor(360 / (1.01 * F.degrees(F.asin(F.lit(reach) / F.greatest(narrow(cy), F.lit(reach)))))))).otherwise(F.lit(1)).cast("long")
    column = lambda n: F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * n).cast("long")
    cell = lambda cy, cx: F.struct(cy.alias("cy"), cx.alias("cx"))
    own = F.floor(lat / F.lit(deg)).cast("long")
    near = [cell(own + i, F.pmod(column(columns(own + i)) + j, columns(own + i))) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return cell(own, column(columns(own))), F.array_distinct(F.array(*near))


def nearby(points: DataFrame, places: DataFrame, km: float, most: int) -> DataFrame:
    """The `most` nearest places within `km` of each point: (id, place_id, distance, k). Points and places meet in cells, so only neighbours are compared.

    Equal points are compared once, and of places at one spot the first `most` (by tier, then id) stand for all, as they are equally far. A point lies in one cell, so its hits are ranked where they are found."""
    some = points.where("lat is not null and lon is not null").select("id", "lat", "lon")
    a = some.select("lat", "lon").distinct().withColumn("cell", cells(F.col("lat"), F.col("lon"), km)[0])
    spot = Window.partitionBy("lat", "lon").orderBy("tier", "place_id")
    b = places.where("lat is not null and lon is not null").withColumn("_k", F.row_number().over(spot)).where(F.col("_k") <= most)
    b = b.select("place_id", F.col("lat").alias("plat"), F.col("lon").alias("plon"), "tier", F.explode(cells(F.col("lat"), F.col("lon"), km)[1]).alias("cell"))
    d = haversine(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    hits = a.join(b, "cell").withColumn("distance", d).where(F.col("distance") <= km)
    w = Window.partitionBy("cell", "lat", "lon").orderBy("distance", "tier", "place_id")
    best = hits.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).groupBy("lat", "lon").agg(F.collect_list(F.struct("place_id", "distance", "k")).alias("_n"))
    return some.join(best, ["lat", "lon"]).select("id", F.inline("_n"))


def box_of(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """The smallest box that holds each point, one of the point's own country first: (id, box_id). Boxes are cut into whole degrees, so points meet them by equality."""
    a = points.where("lat is not null and lon is not null").withColumn("cy", F.floor("lat")).withColumn("cx", F.floor("lon"))
    whole = lambda lo, hi: F.explode(F.sequence(F.floor(lo), F.floor(hi)))
    b = boxes.withColumn("cy", whole("south", "north")).withColumn("cx", whole("west", "east"))
    inside = F.col("lat").between(F.col("south"), F.col("north")) & F.col("lon").between(F.col("west"), F.col("east"))
    foreign = F.coalesce(F.col("country") != F.col("box_country"), F.lit(True)).cast("int")
    size = (F.col("north") - F.col("south")) * (F.col("east") - F.col("west"))
    w = Window.partitionBy("id").orderBy("_f", "_s", "box_id")
    return a.join(b, ["cy", "cx"]).where(inside).withColumn("_f", foreign).withColumn("_s", size).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("id", "box_id")


def _types_ahead(rows: DataFrame, place: list[str], types: list[str], span: int) -> DataFrame:
    """(id, m0, m1, ...): for each row that starts (own), a word of bits for every 62 types: which occur among the rows of its place (place, t, kind: its type's number) within `span` from it, itself included. One backward pass over a
    place keeps the next time of each type; no pairs are made."""
    w = Window.partitionBy(*place).orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    soon = [F.coalesce(F.min(F.when(F.col("kind") == k, F.col("t"))).over(w) - F.col("t") <= span, F.lit(False)) for k in range(len(types))]
    bits = [sum((F.when(x, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, x in enumerate(soon[at : at + 62])), F.lit(0).cast("long")).alias(f"m{at // 62}") for at in range(0, len(types), 62)]
    return rows.select("id", "own", *bits).where("own").drop("own")


def co_located(df: DataFrame, hours: int = 6, km: float = 50.0, most_types: int = 200) -> DataFrame:
    """Flash convergence: starts of a window of `hours` with two event types or more at one place: (id, types). Places are equal anchors, or points within `km`. Rows: id, t (microseconds), country, event_type, anchor, lat, lon; without time or country a row meets nothing.

    Time is cut into stretches of `hours`, and an event goes to its own and to the one before, so each (country, place, stretch) is worked apart, however much a country or a place reports. Events don't meet
    events, and few points meet points: small cells of the globe do, each with the circle that holds its points. Two cells that lie within `km` as a whole are swept together; only where the radius cuts through two
    cells their points are compared, and each point is swept with those in reach. Types are a closed list of at most `most_types`; more are an error.
    """
    span = hours * 3_600_000_000
    types = [r[0] for r in df.select("event_type").where("event_type is not null").distinct().limit(most_types + 1).collect()]
    if len(types) > most_types:
        raise ValueError(f"over {most_types} event types")
    if len(types) < 2:
        return df.select("id", F.lit(0).cast("long").alias("types")).where("false")
    lat, lon = F.col("lat"), F.col("lon")
    # a tenth of the radius high; as wide at the equator
    small = [F.floor(lat / F.lit(km / 1110.0)).cast("long").alias("sy"), F.floor(lon / F.lit(km / 1110.0)).cast("long").alias("sx")]
    e = df.where("t is not null and country is not null").select("id", "t", "country", (F.nullif(F.array_position(F.array(*map(F.lit, types)), F.col("event_type")), F.lit(0)) - 1).cast("short").alias("kind"), "anchor", "lat", "lon", F.floor(F.col("t") / span).alias("h"))
    dealt = lambda rows: rows.withColumn("_h", F.explode(F.array(F.col("h"), F.col("h") - 1))).where((F.col("_h") == F.col("h")) | F.col("kind").isNotNull()).withColumn("own", F.col("_h") == F.col("h")).drop("h").withColumnRenamed("_h", "h")
    by_anchor = _types_ahead(dealt(e.where("anchor is not null")).select("id", "own", "country", "anchor", "h", "t", "kind"), ["country", "anchor", "h"], types, span)

    at = e.where("lat is not null and lon is not null").withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in ("lat", "lon")}).where("lat is not null and lon is not null").select("*", *small)
    points = settled(at.select("country", "sy", "sx", "lat", "lon").distinct())
    mid, by = [F.avg("lat").alias("y"), F.avg("lon").alias("x")], ["country", "sy", "sx"]
    circle = settled(points.join(points.groupBy(*by).agg(*mid), by).groupBy(*by, "y", "x").agg(F.max(haversine(F.col("y"), F.col("x"), lat, lon)).alias("r")).withColumn("c", F.monotonically_increasing_id()))
    # any point of a cell lies within its circle of the middle, so points within km have middles within km and both radii, each a fifth of km at most
    wide = km * 1.5
    y, x = F.col("y"), F.col("x")
    here, there = circle.select(*by, "y", "x", "r", "c", cells(y, x, wide)[0].alias("cell")), circle.select("country", *(F.col(c).alias(f"{c}2") for c in ("sy", "sx", "y", "x", "r")), F.explode(cells(y, x, wide)[1]).alias("cell"))
    apart = haversine(y, x, F.col("y2"), F.col("x2"))
    meet = here.join(there, ["country", "cell"]).withColumn("d", apart).where(F.col("d") - F.col("r") - F.col("r2") <= km + 1e-6)
    same = (F.col("sy") == F.col("sy2")) & (F.col("sx") == F.col("sx2"))
    whole = F.when(same, 2 * F.col("r")).otherwise(F.col("d") + F.col("r") + F.col("r2")) <= km - 1e-6
    meet = settled(meet.select(*by, "sy2", "sx2", "c", whole.alias("whole")))

    to = meet.where("whole").select("country", F.col("sy2").alias("sy"), F.col("sx2").alias("sx"), "c", same.alias("home"))
    near = dealt(at.join(to, by)).withColumn("own", F.col("own") & F.col("home")).where("own or kind is not null")
    by_cell = _types_ahead(near.select("id", "own", "c", "h", "t", "kind"), ["c", "h"], types, span)

    cut = meet.where("not whole")
    p = points.select(*by, lat.alias("to_lat"), lon.alias("to_lon"))
    q = points.select("country", F.col("sy").alias("sy2"), F.col("sx").alias("sx2"), "lat", "lon")
    reach = cut.join(p, by).join(q, ["country", "sy2", "sx2"]).where(haversine(F.col("to_lat"), F.col("to_lon"), lat, lon) <= km).select("country", "to_lat", "to_lon", "lat", "lon")
    reach = reach.unionByName(reach.select("country", "to_lat", "to_lon").distinct().select("*", F.col("to_lat").alias("lat"), F.col("to_lon").alias("lon")))
    seen = dealt(at.join(reach, ["country", "lat", "lon"])).withColumn("own", F.col("own") & (lat == F.col("to_lat")) & (lon == F.col("to_lon"))).where("own or kind is not null")
    by_point = _types_ahead(seen.select("id", "own", "country", F.col("to_lat").alias("lat"), F.col("to_lon").alias("lon"), "h", "t", "kind"), ["country", "lat", "lon", "h"], types, span)

    flags = [f"m{k}" for k in range(0, -(-len(types) // 62))]
    told = by_anchor.unionByName(by_cell).unionByName(by_point).groupBy("id").agg(*(F.bit_or(c).alias(c) for c in flags))
    return told.select("id", sum((F.bit_count(c).cast("long") for c in flags), F.lit(0).cast("long")).alias("types")).where("types >= 2")


def adjudication_candidates(df: DataFrame, id_col: str, group: str, hours: int = 48, least: float = 0.1, most: int = 6, place: str | None = None) -> DataFrame:
    """(a_id, b_id, kin): for each row, the rows within `hours` that may tell of the same incident, the most akin first, `most` at most (the limit is the feature); ties by id.

    Two nets. By group (a country): rows of one group whose words (unigrams) have a likeness of `least` or more; rows that share no word aren't akin. By place, if a column is named: rows of one place whose groups
    don't differ where both are known, with a kin of 1, whatever their words. A row without time has no candidates.

    Rows don't meet rows: cells (a stretch of `hours` of one group's equal words, or of one group's place) meet cells, each two by their least shared word. A row sees all of its own stretch, so a cell that is
    less akin than `most` rows there is left out; of a cell it takes the `most` smallest ids within reach.
    """
    span = hours * 3_600_000_000
    row = settled(df.where("t is not null").select(F.col(id_col).alias("id"), F.col(group).alias("country"), "t", F.array_sort("unigrams").alias("unigrams"), (F.col(place) if place else F.lit(None)).cast("string").alias("p"), F.floor(F.col("t") / span).alias("h")))
    cell = lambda rows, net, *by: rows.groupBy("country", *by, "h").agg(F.min("id").alias("c"), F.count("*").alias("n")).select(F.lit(net).alias("net"), F.struct("c", "n", "h", "country", *by).alias("e"))
    at = lambda cells: cells.withColumn("h", F.col("e.h"))
    near = lambda cells: cells.withColumn("h", F.explode(F.array(F.col("e.h") - 1, F.col("e.h"), F.col("e.h") + 1)))
    ends = lambda pairs, kin: pairs.select("net", F.col("a.c").alias("ca"), F.col("a.h").alias("ha"), F.col("b.c").alias("c"), F.col("b.h").alias("h"), F.col("b.n").alias("n"), kin.alias("kin"))
    mine = lambda rows, cells, *by: rows.join(cells.select("e.*", "net").select(*(F.col(k).alias(f"_{k}") for k in ("country", "h", *by)), "c", "net"), F.col("country").eqNullSafe(F.col("_country")) & (F.col("h") == F.col("_h")) & (F.col(by[0]) == F.col(f"_{by[0]}"))).select("net", "c", "id", "t", "h")

    told = row.where("country is not null and size(unigrams) > 0")
    cells = settled(cell(told, 0, "unigrams"))
    word = cells.withColumn("w", F.explode("e.unigrams"))
    a, b = (x.select("net", "h", "w", F.col("e.country").alias("g"), F.col("e").alias(k)) for x, k in ((at(word), "a"), (near(word), "b")))
    meet = a.join(b.drop("net"), ["g", "w", "h"]).where(F.col("w") == F.array_min(F.array_intersect("a.unigrams", "b.unigrams")))
    links = ends(meet, jaccard(F.col("a.unigrams"), F.col("b.unigrams"))).where(F.col("kin") >= least)
    held = mine(told, cells, "unigrams")
    if place:
        placed = row.where("p is not null")
        spots = settled(cell(placed, 1, "p"))
        spot = spots.withColumn("p", F.col("e.p"))
        links = links.unionByName(ends(_compatible(at(spot), near(spot), ["net", "p", "h"]), F.lit(1.0)))
        held = held.unionByName(mine(placed, spots, "p"))
    own = F.when(F.col("h") == F.col("ha"), F.col("n")).otherwise(0)
    of = Window.partitionBy("net", "ca", "ha")
    above = F.sum(own).over(of.orderBy(F.desc("kin"))) - F.sum(own).over(Window.partitionBy("net", "ca", "ha", "kin"))
    links = settled(links.withColumn("_above", above).where(F.col("_above") <= most).select("net", "ca", "c", "kin", (F.col("h") - F.col("ha")).alias("side")))  # a row is in its own cell: hence <=
    held = settled(held)

    asked = held.select("net", F.col("c").alias("ca"), F.col("id").alias("a_id"), "t").join(links, ["net", "ca"]).drop("ca")
    first = held.withColumn("_k", F.row_number().over(Window.partitionBy("net", "c").orderBy("id"))).where(F.col("_k") <= most + 1).select("net", "c", F.col("id").alias("b_id"))
    beside = asked.where("side = 0").join(first, ["net", "c"]).where("a_id != b_id").select("a_id", "b_id", "kin")
    # before and after, a row reaches a part of a cell: all from its far end inwards
    ends_ = links.where("side != 0").select("net", "c", "side").distinct()
    marks = held.join(ends_, ["net", "c"]).select("net", "c", "side", (F.col("side") * F.col("t")).alias("at"), F.lit(0).alias("own"), "id", F.lit(0.0).alias("kin"))
    marks = marks.unionByName(asked.where("side != 0").select("net", "c", "side", (F.col("side") * F.col("t") + span).alias("at"), F.lit(1).alias("own"), F.col("a_id").alias("id"), "kin"))
    reach = _least_so_far(marks, ["net", "c", "side"], most)
    kin = beside.unionByName(reach).repartition("a_id").groupBy("a_id", "b_id").agg(F.max("kin").alias("kin"))
    w = Window.partitionBy("a_id").orderBy(F.desc("kin"), "b_id")
    return kin.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).drop("_rn")


def _least_so_far(marks: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(a_id, b_id, kin): for each mark with own = 1, the `most` smallest ids of marks with own = 0 of its keys up to it, in order of `at`. Marks stream by; so many ids are held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for pdf in batches:
            out = []
            for *k, own, i, kin in zip(*(pdf[c].tolist() for c in (*keys, "own", "id", "kin")), strict=True):
                if k != key:
                    key, held = k, []
                if own:
                    out.extend((i, b, kin) for b in held)
                elif len(held) < most or i < held[-1]:
                    bisect.insort(held, i)
                    del held[most:]
            yield pd.DataFrame(out, columns=["a_id", "b_id", "kin"]).astype({"kin": "float64"})

    kind = marks.schema["id"].dataType.simpleString()
    return marks.repartition(*keys).sortWithinPartitions(*keys, "at", "own").mapInPandas(run, f"a_id {kind}, b_id {kind}, kin double")
