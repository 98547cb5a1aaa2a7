"""What follows a classifier: one ordered chain of rules, each row with the rule that decided it; terms of several words; digests of reports; manifests as trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import in_africa
from ..params import DIGEST_EMPTY, DIGEST_HEADERS, HOSTILE_ACT, NOT_NEWS


def hostile_act(title: Column) -> Column:
    """Whether a headline asserts a hostile act; null counts as none."""
    return F.coalesce(title.rlike(HOSTILE_ACT), F.lit(False))


def report_kind(said: Column) -> Column:
    """A known kind, however spaced or hyphenated; anything else is a new incident."""
    plain = F.regexp_replace(F.lower(F.coalesce(said, F.lit(""))), r"[\s_-]+", "")
    return F.when(plain.isin(*NOT_NEWS), plain).otherwise("new_incident")


def iso_code(said: Column) -> Column:
    """The first two letters, in upper case; null if they aren't two letters A-Z."""
    two = F.substring(F.upper(F.trim(said)), 1, 2)
    return F.when(two.rlike("^[A-Z]{2}$"), two)


def decided(df: DataFrame, catalogue: DataFrame, floor: int = 30, noise_floor: int = 40, disrupted_floor: int = 40, fallback: str = "unclassified", scoped: str = "african_terrorism", scoped_fallback: str = "terrorism") -> DataFrame:
    """df with status, event_type, sub_type, country_iso, report_kind, charge and rule, after a classifier's answer.

    Rows: relevance (null: 50), event_type (null: `fallback`), sub_type, country_iso, report_kind, title, disrupted (whether flights are). catalogue: (code) of the types in force; an empty one checks nothing.
    In order: `disruption`: what disrupts flights has disrupted_floor at least, and isn't noise. `archived`: under floor, or noise under noise_floor: archived as `fallback`; charge is 1 if the headline asserts a hostile act
    (the outlet claimed what the text doesn't hold), else null. Of what stays charge is 0. `noise`: noise becomes `fallback`. `unknown_type`: a type outside the catalogue becomes `fallback`; such a sub_type goes. `outside_africa`:
    the type scoped to Africa becomes its parent elsewhere. rule names the last that changed the type or the status, else `kept`. Country codes and kinds of report are brought into form.
    """
    codes = catalogue.where("code is not null").select("code").distinct()
    checks = F.broadcast(codes.agg((F.count("*") > 0).alias("_checks")))  # one row
    kinds = codes.select(F.col("code").alias("_type"))
    subs = codes.select(F.col("code").alias("_sub"))
    disrupted = F.coalesce("disrupted", F.lit(False))
    rel = F.least(F.greatest(F.coalesce("relevance", F.lit(50)), F.lit(0)), F.lit(100))
    rows = df.withColumn("_said", F.coalesce("event_type", F.lit(fallback)))
    rescued = disrupted & (rel < disrupted_floor)
    rows = rows.withColumn("_rel", F.when(rescued, F.lit(disrupted_floor)).otherwise(rel)).withColumn("_saved", rescued).withColumn("_now", F.when(rescued & (F.col("_said") == "noise"), fallback).otherwise(F.col("_said")))
    gone = (F.col("_rel") < floor) | ((F.col("_now") == "noise") & (F.col("_rel") < noise_floor))
    rows = rows.withColumn("_gone", gone).crossJoin(checks).join(kinds, F.col("_now") == F.col("_type"), "left").join(subs, F.col("sub_type") == F.col("_sub"), "left")
    unknown = F.col("_checks") & F.col("_type").isNull() & ~F.col("_now").isin("noise", fallback)
    iso = iso_code(F.col("country_iso"))
    outside = (F.col("_now") == scoped) & ~unknown & ~in_africa(iso)
    new = {
        "status": F.when(F.col("_gone"), "archived").otherwise("classified"),
        "event_type": F.when(F.col("_gone") | (F.col("_now") == "noise") | unknown, fallback).when(outside, scoped_fallback).otherwise(F.col("_now")),
        "sub_type": F.when(~F.col("_gone") & (~F.col("_checks") | F.col("_sub").isNotNull()), F.col("sub_type")),
        "country_iso": F.when(~F.col("_gone"), iso),
        "report_kind": report_kind(F.col("report_kind")),
        "charge": F.when(~F.col("_gone"), 0).when(hostile_act(F.col("title")), 1),
        "rule": F.when(F.col("_gone"), "archived").when(outside, "outside_africa").when(unknown, "unknown_type").when(F.col("_now") == "noise", "noise").when(F.col("_saved"), "disruption").otherwise("kept"),
    }
    return rows.select(*(F.col(f"`{c}`") for c in df.columns if c not in new), *(v.alias(k) for k, v in new.items()))


def mentions(df: DataFrame, terms: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id_col, term) of each term, of one word or several, that stands in a text between borders of words. terms: (term). Words are letters, digits and _; what stands between them doesn't matter. Terms without a word are never found.

    A text gives its runs of as many words as some term has, and they meet the terms by equality."""
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    t = terms.where("term is not null").select("term", words(F.col("term")).alias("w")).where(F.size("w") > 0).select("term", F.array_join("w", " ").alias("g"), F.size("w").alias("n"))
    sizes = [r["n"] for r in t.select("n").distinct().collect()]  # lengths of terms, a handful
    if not sizes:
        return df.select(id_col, F.lit(None).cast("string").alias("term")).limit(0)
    w = df.where(F.col(text).isNotNull()).select(id_col, words(F.col(text)).alias("w"))

    def grams(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))
        return F.when(F.size("w") >= n, every).otherwise(F.array().cast("array<string>"))

    every = F.array_distinct(F.flatten(F.array(*map(grams, sorted(sizes)))))
    return w.select(id_col, F.explode(every).alias("g")).join(t, "g").select(id_col, "term").distinct()


def spillover_phrases(df: DataFrame, terms: DataFrame, id_col: str, country: str, text: str) -> DataFrame:
    """(id_col, about): rows whose text names another country by one of its terms, of one word or several. terms: (term, about). A row without a country is another country's to all."""
    named = mentions(df, terms, id_col, text).join(terms, "term").select(id_col, "about").distinct()
    return df.select(id_col, country).distinct().join(named, id_col).where(~F.col(country).eqNullSafe(F.col("about"))).select(id_col, "about").distinct()


def digest(text: Column, known: Column) -> Column:
    """A written digest as a struct (overview, countries, aviation, highlights, watch, valid): lines under the five headers, in order; before any header it is overview.

    Links, marks of markdown, sources and verification labels are stripped from lines; lines without a letter or digit go. A country's line is `ISO | text`, of a code in `known` (array of upper-case codes). Lines that only say that there is nothing
    are no items. valid: there is an overview. Null text is an empty digest.
    """
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"https?://\S+", ""), r"[*_#`]+", ""), r"(?iu)\s*—?\s*Kaynak:.*$", ""), r"(?iu)\s*—?\s*Doğruluk Durumu:.*$", ""))
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), clean), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    at = lambda x: F.array_position(F.array(*map(F.lit, DIGEST_HEADERS)), F.upper(F.trim(F.regexp_replace(x, ":+$", "")))).cast("int")
    none = F.array().cast("array<struct<s:int,x:string>>")
    step = lambda acc, x: F.when(at(x) > 0, F.struct(at(x).alias("s"), acc["out"].alias("out"))).otherwise(F.struct(acc["s"].alias("s"), F.array_append(acc["out"], F.struct(acc["s"].alias("s"), F.trim(F.regexp_replace(x, r"^[•*\- ]+", "")).alias("x"))).alias("out")))
    told = F.aggregate(lines, F.struct(F.lit(1).alias("s"), none.alias("out")), step)["out"]
    of = lambda k: F.transform(F.filter(told, lambda r: r["s"] == k), lambda r: r["x"])
    items = lambda k: F.filter(of(k), lambda x: ~F.lower(F.trim(x)).isin(*DIGEST_EMPTY))
    land = F.transform(F.filter(of(2), lambda x: x.contains("|")), lambda x: F.struct(F.substring(F.upper(F.trim(F.substring_index(x, "|", 1))), 1, 2).alias("iso"), F.trim(F.regexp_replace(x, r"^[^|]*\|", "")).alias("text")))
    overview = F.trim(F.array_join(of(1), " "))
    return F.struct(overview.alias("overview"), F.filter(land, lambda c: F.array_contains(known, c["iso"]) & (c["text"] != "")).alias("countries"), items(3).alias("aviation"), items(4).alias("highlights"), items(5).alias("watch"), (overview != "").alias("valid"))


def merkle_manifest(df: DataFrame, part: str, columns: list[str], depth: int = 2) -> DataFrame:
    """(part, rows, root): a digest of each part's JSON lines that doesn't depend on their order or partitions and never gathers rows.

    A line is a leaf by the SHA-256 of its JSON, with the number of times it stands; leaves fall into 16 ** depth buckets by the first digits of their hash; a bucket's digest is that of its leaves in order, and every further
    level digests at most 16 children, down to one root. A bucket holds rows / 16 ** depth leaves of 64 digits or so: choose depth by the largest part. Rows of a null part are a part. No rows, no parts.
    """
    leaf = df.select(F.col(part).alias("part"), F.sha2(F.to_json(F.struct(*columns)).cast("binary"), 256).alias("h")).groupBy("part", "h").agg(F.count("*").alias("n"))
    node = leaf.groupBy("part", F.substring("h", 1, depth).alias("at")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("h", F.lit(":"), F.col("n").cast("string")))), ","), 256).alias("d"))
    for level in reversed(range(depth)):
        child = F.concat("at", F.lit(":"), "d")
        node = node.groupBy("part", F.substring("at", 1, level).alias("at")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(child)), ","), 256).alias("d"))
    return node.select(F.col("part").alias(part), F.col("n").alias("rows"), F.col("d").alias("root"))
