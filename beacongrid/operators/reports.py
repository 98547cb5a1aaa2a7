"""Daily reports: event windows, countries, clusters, labels, spill-over, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import aftermath, flight_disruption, registrable
from ..params import NOT_NEWS, RISK, SAFETY_ONLY, SEVERE, STRATEGIC


def event_time(as_of: Column) -> Column:
    """Occurred, else published, else ingested; never later than as_of."""
    return F.least(F.coalesce("occurred_at", "published_at", "ingested_at"), as_of)


def in_window(df: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Half open: a row at the start is in, a row at the end is not."""
    at = event_time(as_of)
    return df.where((at >= as_of - F.expr(f"INTERVAL {hours} HOURS")) & (at < as_of))


def country_selection(df: DataFrame, country: str, severity: str, matching: Column, least: int = 3, severe: int = 80, least_matching: int = 1, most: int = 5) -> DataFrame:
    """Countries with many scored events, a severe one, or enough that match (disrupted flights, say); the last two protect a country: it comes before all that only have many."""
    g = df.where(F.col(country).isNotNull() & F.col(severity).isNotNull()).groupBy(country).agg(F.count("*").alias("n"), F.max(severity).alias("top"), F.count_if(matching).alias("matching"))
    strong = (F.col("top") >= severe) | (F.col("matching") >= least_matching)
    return g.where((F.col("n") >= least) | strong).withColumn("protected", strong).orderBy(F.desc("protected"), F.desc("n"), country).limit(most)


def official(domain: Column, suffixes: tuple[str, ...] = (".gov", ".mil", ".int"), state_media: dict[str, str] | None = None, country: Column | None = None) -> Column:
    """State media count at home only; else an .int domain or a label gov or mil."""
    label = F.arrays_overlap(F.split(domain, r"\."), F.array(F.lit("gov"), F.lit("mil")))
    ok = label | domain.endswith(".int")
    for s in suffixes:
        ok = ok | domain.endswith(s)
    if state_media and country is not None:
        home = F.create_map(*(F.lit(x) for kv in state_media.items() for x in kv))[domain]
        ok = F.when(home.isNotNull(), F.coalesce(home == country, F.lit(False))).otherwise(ok)
    return F.coalesce(ok, F.lit(False))


def verification(df: DataFrame, cluster: str, domain: str, is_official: Column, penalized: Column) -> DataFrame:
    """official, corroborated (two independent sources) or single. Sources are registrable domains; those that are penalised neither count nor make a cluster official."""
    ok = ~F.coalesce(penalized, F.lit(False))
    return df.groupBy(cluster).agg(F.max((is_official & ok).cast("int")).alias("_o"), F.countDistinct(F.when(ok, registrable(F.col(domain)))).alias("n_independent")).select(
        cluster, "n_independent", F.when(F.col("_o") == 1, "official").when(F.col("n_independent") >= 2, "corroborated").otherwise("single").alias("label")
    )


def absorbed(df: DataFrame, group: str, place: str, country_level: Column, text: str) -> DataFrame:
    """Country-level members join their group's largest place if their text names it: adds place_of."""
    located = df.where(~country_level).groupBy(group, place).agg(F.count("*").alias("n"))
    main = located.groupBy(group).agg(F.max(F.struct("n", place)).alias("m")).select(group, F.col(f"m.{place}").alias("_main"))
    named = F.contains(F.lower(F.col(text)), F.lower(F.col("_main")))
    return df.join(main, group, "left").withColumn("place_of", F.when(country_level & F.coalesce(named, F.lit(False)), F.col("_main")).otherwise(F.col(place))).drop("_main")


def clusters(df: DataFrame, keys: list[str], id_col: str, best: list[Column], domain: str, severity: str, deaths: str, sources: int = 5) -> DataFrame:
    """One row a cluster: representative, members, severity, deaths, up to `sources` domains in order of their best member."""
    w = Window.partitionBy(*keys).orderBy(*best)
    r = df.withColumn("_rn", F.row_number().over(w))
    d = r.groupBy(*keys, domain).agg(F.min("_rn").alias("_p")).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("_p")))
    src = d.where(F.col("_k") <= sources).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", domain))), lambda x: x[domain]), ",").alias("sources"))
    n = d.groupBy(*keys).agg(F.count("*").alias("n_sources"))
    g = r.groupBy(*keys).agg(F.max(F.when(F.col("_rn") == 1, F.col(id_col))).alias("representative"), F.count("*").alias("members"), F.max(severity).alias("severity"), F.max(deaths).alias("deaths"))
    return g.join(src, keys).join(n, keys)


def ranked(df: DataFrame, most: int) -> DataFrame:
    """The top clusters by severity, deaths, members and sources."""
    return df.orderBy(F.desc("severity"), F.desc("deaths"), F.desc("members"), F.desc("n_sources"), "representative").limit(most)


def spillover(df: DataFrame, terms: DataFrame, id_col: str, country: str, text: str) -> DataFrame:
    """(id, about): rows whose text names another country by one of its terms. terms: (term, about), single lower-case words, joined to the words of the text."""
    words = df.select(id_col, country, F.explode(F.array_distinct(F.split(F.lower(text), r"[^a-z0-9_]+"))).alias("term"))
    return words.join(terms, "term").where(~F.col(country).eqNullSafe(F.col("about"))).select(id_col, "about").distinct()


def risk_level(confirmed_severe: Column, top: Column, n: Column) -> Column:
    """Of a country's clusters: those both severe and corroborated, the highest severity, and their number."""
    first = F.when((confirmed_severe >= 3) | ((confirmed_severe >= 2) & (n >= 10)), RISK[0])
    return first.when((confirmed_severe >= 1) | (top >= SEVERE), RISK[1]).when((top >= 64) | ((top >= 60) & (n >= 5)), RISK[2]).otherwise(RISK[3])


def retrospective(df: DataFrame, cluster: str, title: str = "title", report_kind: str = "report_kind") -> DataFrame:
    """(cluster, retrospective): whether every member reports on what is already known, by its kind or its headline."""
    old = F.coalesce(F.col(report_kind).isin(*NOT_NEWS), F.lit(False)) | aftermath(title).isNotNull()
    return df.groupBy(cluster).agg(F.bool_and(old).alias("retrospective"))


def section(event_type: Column, safety: tuple[str, ...] = SAFETY_ONLY, strategic: tuple[str, ...] = STRATEGIC) -> Column:
    """Where a cluster goes: strategic, field, or nowhere (null) if it is of safety alone."""
    return F.when(F.coalesce(event_type.isin(*strategic), F.lit(False)), "strategic").when(~F.coalesce(event_type.isin(*safety), F.lit(False)), "field")


def airspace_relevant(event_type: Column, text: Column, threats: tuple[str, ...], disrupted: Column | None = None) -> Column:
    """A type that threatens airspace, or a text that reports disrupted flights."""
    return F.coalesce(event_type.isin(*threats), F.lit(False)) | (flight_disruption(text) if disrupted is None else disrupted)


def with_dim(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with columns of a dimension, null where it has no such key; dim has one row a key."""
    return df.join(dim.select(key, *columns), key, "left")


def coordinates(df: DataFrame, gazetteer: DataFrame, key: str, iso: str) -> DataFrame:
    """df with lat, lon of its place key. gazetteer: (place, lat, lon, place_iso), one row a place. An entry of another country than the row's is refused."""
    g = gazetteer.select(F.col("place").alias("_p"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), "place_iso")
    other = F.coalesce((F.upper(F.trim(F.col(iso))) != "") & (F.col("place_iso") != "") & (F.upper(F.trim(F.col(iso))) != F.col("place_iso")), F.lit(False))
    got = df.join(g, F.col(key) == F.col("_p"), "left")
    return got.withColumn("lat", F.when(~other, F.col("_lat"))).withColumn("lon", F.when(~other, F.col("_lon"))).drop("_p", "_lat", "_lon", "place_iso")


def narrative_queue(df: DataFrame, storyline: str, id_col: str, micros: str, cache: DataFrame | None = None, least: int = 2, most: int | None = 10) -> DataFrame:
    """Storylines to be told (storyline, n, last, signature, stale): those whose rows differ from what the cache (storyline, held) was told of come first, then the newest; `most` is the feature, None gives all, unordered.

    A signature is a digest of a storyline's ids in order and its last time; a storyline's ids are few, as they are of one window.
    """
    g = df.groupBy(storyline).agg(F.count("*").alias("n"), F.max(micros).alias("last"), F.sha2(F.concat(F.array_join(F.array_sort(F.collect_list(id_col)), ","), F.lit("#"), F.max(micros).cast("string")), 256).alias("signature")).where(F.col("n") >= least)
    q = g.withColumn("held", F.lit(None).cast("string")) if cache is None else g.join(cache, storyline, "left")
    q = q.withColumn("stale", ~F.coalesce(F.col("held") == F.col("signature"), F.lit(False))).drop("held")
    return q if most is None else q.orderBy(F.desc("stale"), F.desc("last"), F.desc("n"), storyline).limit(most)
