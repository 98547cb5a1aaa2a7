"""Airspace: reference tables merged by precedence, and cards that say which airspace, neighbours, restrictions and airports an incident touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lifecycle import adjacency
from .linking import box_of, nearby


def country_of(name: Column, cities: dict[str, str], unknown: str = "XX") -> Column:
    """The country of a named city: the whole name first, else the first listed city that the name contains, else `unknown`. cities: lower-case city to ISO code, a bounded list."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    whole = F.create_map(*(F.lit(x) for kv in cities.items() for x in kv))[low] if cities else F.lit(None).cast("string")
    return F.coalesce(whole, *(F.when(low.contains(c), F.lit(iso)) for c, iso in cities.items()), F.lit(unknown))


def merged_reference(sources: list[tuple[str, DataFrame]], boxes: DataFrame) -> DataFrame:
    """Rows of several reference tables as one, each with `origin` and `reason`: null for the row of each code that is kept, else why it isn't.

    sources: (name, rows of code, name, country, lat, lon), the most trusted first. boxes: box_id, box_country, south, north, west, east (a box counts its borders; a country may have several). Reasons, the first that fits:
    `no code`, `no country` (null, empty or XX), `no coordinates`, `out of range`, `outside its country` (in none of the boxes of its country, where it has any), `superseded` (a more trusted row has the code; within a table the one of the
    smallest name, latitude and longitude is kept). Rows without coordinates are kept out. Repeated rows: one is kept.
    """
    rows = None
    for k, (origin, df) in enumerate(sources):
        part = df.select(F.upper(F.trim("code")).alias("code"), "name", F.upper(F.trim("country")).alias("country"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.lit(origin).alias("origin"), F.lit(k).alias("_trust"))
        rows = part if rows is None else rows.unionByName(part)
    b = boxes.groupBy("box_country").agg(F.collect_list(F.struct("south", "north", "west", "east")).alias("_boxes"))  # the boxes of one country
    rows = rows.join(b, F.col("country") == F.col("box_country"), "left").drop("box_country")
    inside = F.exists("_boxes", lambda x: F.col("lat").between(x["south"], x["north"]) & F.col("lon").between(x["west"], x["east"]))
    fault = (
        F.when(F.coalesce(F.col("code"), F.lit("")) == "", "no code")
        .when(F.coalesce(F.col("country"), F.lit("XX")).isin("", "XX"), "no country")
        .when(F.col("lat").isNull() | F.col("lon").isNull() | F.isnan("lat") | F.isnan("lon"), "no coordinates")
        .when(~F.col("lat").between(-90, 90) | ~F.col("lon").between(-180, 180), "out of range")
        .when(F.col("_boxes").isNotNull() & ~inside, "outside its country")
    )
    rows = rows.withColumn("_fault", fault).drop("_boxes")
    w = Window.partitionBy("code", F.col("_fault").isNull()).orderBy("_trust", "name", "lat", "lon")
    reason = F.coalesce("_fault", F.when(F.row_number().over(w) > 1, F.lit("superseded")))
    return rows.withColumn("reason", reason).drop("_fault", "_trust")


def _views(firs: DataFrame, zones: DataFrame, most: int = 3) -> DataFrame:
    """(icao, view): a region with the restrictions in force over any of its countries, `most` named at most. zones: country, zone, valid_until of what is in force."""
    over = firs.select("icao", F.explode("countries").alias("country")).join(zones, "country").select("icao", F.struct("zone", "valid_until").alias("z")).distinct()
    named = over.groupBy("icao").agg(F.slice(F.array_sort(F.collect_list("z")), 1, most).alias("czib"))
    none = F.array().cast("array<struct<zone:string,valid_until:string>>")
    v = firs.join(named, "icao", "left")
    return v.select("icao", F.struct(F.col("czib").isNull().alias("free"), "icao", "countries", F.coalesce("czib", none).alias("czib")).alias("view"))


def cards(clusters: DataFrame, firs: DataFrame, borders: DataFrame, zones: DataFrame, airports: DataFrame, radius: float = 500.0, most_airports: int = 3, most_cards: int = 5) -> DataFrame:
    """Airspace cards: (country, place_rank, id, scope, location, icao, firs, neighbours, airports), the first `most_cards` of each country (that limit is the feature).

    clusters: id, country, location, severity, lat, lon, aviation (whether it is about aviation itself); firs: icao, countries, south, north, west, east; borders: a, b (either direction); zones: country, zone, valid_until; airports:
    place_id, country, tier, lat, lon. A cluster with a point in a region has scope `point`: the smallest region that holds it, one of its own country first, and the nearest airports within `radius` km. Any other has
    scope `country`: all of its country's regions, none of which is claimed for it, and the country's airports by tier. firs and neighbours are arrays of (free, icao, countries, czib), the restricted ones first; icao is the first region's.
    Clusters are taken by severity, then id. A card of scope `country` is left out where an earlier card has its region, and where it has nothing to say: not about aviation and nothing restricted. One card
    for each region and location. Clusters in no region and of no known country have no card.
    """
    views = _views(firs, zones)
    edges = adjacency(borders, "a", "b")
    c = clusters.where("id is not null").select("id", "country", "location", "severity", "lat", "lon", F.coalesce("aviation", F.lit(False)).alias("aviation"))
    boxes = firs.select(F.col("icao").alias("box_id"), F.explode("countries").alias("box_country"), "south", "north", "west", "east")
    at = box_of(c.select("id", "country", "lat", "lon"), boxes).select("id", F.col("box_id").alias("icao"))
    near = nearby(c.join(at, "id", "left_semi").select("id", "lat", "lon"), airports, radius, most_airports).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "place_id", "distance"))).alias("n"))
    near = near.select("id", F.transform("n", lambda a: F.struct(a["place_id"].alias("place_id"), F.round(a["distance"], 0).cast("long").alias("km"))).alias("airports"))

    located = c.join(at, "id").join(views, "icao").join(near, "id", "left")
    around = edges.join(views.select(F.col("icao").alias("b"), "view"), "b").groupBy("a").agg(F.array_sort(F.collect_list("view")).alias("neighbours"))
    located = located.join(around.withColumnRenamed("a", "icao"), "icao", "left").select("id", "country", "location", "severity", "aviation", F.lit("point").alias("scope"), F.array("view").alias("firs"), "neighbours", "airports")

    own = firs.select("icao", F.explode("countries").alias("country")).distinct()
    land = own.join(views, "icao").groupBy("country").agg(F.array_sort(F.collect_list("view")).alias("firs"))
    outside = own.join(edges.withColumnRenamed("a", "icao"), "icao").select("country", F.col("b").alias("icao")).distinct().join(own, ["country", "icao"], "left_anti")
    beside = outside.join(views, "icao").groupBy("country").agg(F.array_sort(F.collect_list("view")).alias("neighbours"))
    by_tier = Window.partitionBy("country").orderBy("tier", "place_id")
    main = airports.withColumn("k", F.row_number().over(by_tier)).where(F.col("k") <= most_airports).groupBy("country").agg(F.array_sort(F.collect_list(F.struct("k", "place_id"))).alias("n"))
    main = main.select("country", F.transform("n", lambda a: F.struct(a["place_id"].alias("place_id"), F.lit(None).cast("long").alias("km"))).alias("airports"))
    land = land.join(beside, "country", "left").join(main, "country", "left")
    placed = c.join(at, "id", "left_anti").select("id", "country", "location", "severity", "aviation").join(land, "country").select("id", "country", "location", "severity", "aviation", F.lit("country").alias("scope"), "firs", "neighbours", "airports")

    every = located.unionByName(placed).withColumn("icao", F.col("firs")[0]["icao"]).withColumn("_place", F.lower(F.trim(F.coalesce("location", F.lit("")))))
    says = (F.col("scope") == "point") | F.col("aviation") | F.exists("firs", lambda f: ~f["free"])
    order = [F.desc_nulls_last("severity"), F.asc("id")]
    by_fir = Window.partitionBy("country", "icao").orderBy(*order)
    same = Window.partitionBy("country", "icao", "scope", "_place").orderBy(*order)
    ranked = every.where(says).withColumn("_n", F.row_number().over(by_fir)).withColumn("_first", F.first(F.struct("scope", "_place")).over(by_fir)).withColumn("_k", F.row_number().over(same))
    open_ = F.when(F.col("scope") == "country", F.col("_n") == 1).otherwise((F.col("_k") == 1) & ~((F.col("_first.scope") == "country") & (F.col("_first._place") == F.col("_place"))))
    kept = ranked.where(open_).withColumn("place_rank", F.row_number().over(Window.partitionBy("country").orderBy(*order))).where(F.col("place_rank") <= most_cards)
    return kept.select("country", "place_rank", "id", "scope", "location", "icao", "firs", "neighbours", "airports")


def compact(made: DataFrame, most_firs: int = 6) -> DataFrame:
    """Cards with what a reader of a summary needs: restricted neighbours by name, the others by code, and for a country the first `most_firs` regions and how many more there are."""
    code = lambda v: v["icao"]
    named = lambda v: F.struct(v["icao"].alias("icao"), F.transform(v["czib"], lambda z: z["zone"]).alias("zones"))
    n = F.coalesce("neighbours", F.array().cast(made.schema["neighbours"].dataType))
    return made.select(
        "country", "place_rank", "id", "scope", "location", F.transform(F.slice("firs", 1, most_firs), named).alias("firs"), F.greatest(F.size("firs") - most_firs, F.lit(0)).alias("more_firs"),
        F.transform(F.filter(n, lambda v: ~v["free"]), named).alias("restricted"), F.transform(F.filter(n, lambda v: v["free"]), code).alias("others"), F.transform(F.coalesce("airports", F.array().cast(made.schema["airports"].dataType)), lambda a: a["place_id"]).alias("airports"),
    )


def summary_line(firs: Column, more: Column) -> Column:
    """Codes of the regions with a star for each restricted one, and how many more there are."""
    codes = F.array_join(F.transform(firs, lambda f: F.concat(f["icao"], F.when(F.size(f["zones"]) > 0, "*").otherwise(""))), ", ")
    return F.when(more > 0, F.concat(codes, F.lit(" +"), more.cast("string"))).otherwise(codes)
