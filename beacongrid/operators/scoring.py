"""Severity, confidence, source quality and entity rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import Scoring, Vocabulary


def credibility(df: DataFrame, domain: str, table: DataFrame, unknown: float = 0.6) -> DataFrame:
    """credibility of each row's domain: its own entry, else that of the parent domain listed first, else `unknown`. table: (parent, score, place), distinct parents, place their order in the list.

    Each distinct domain is split into its suffixes, which are joined by equality.
    """
    names = df.select(domain).where(F.col(domain).isNotNull()).distinct()
    dot = names.select(domain, F.explode(F.sequence(F.lit(1), F.size(F.split(domain, r"\.")))).alias("i"))
    tails = dot.select(domain, F.expr(f"substring_index(`{domain}`, '.', -i)").alias("tail"))
    own = F.when(F.col("tail") == F.col(domain), -1).otherwise(F.col("place"))
    best = tails.join(table, F.col("tail") == F.col("parent")).groupBy(domain).agg(F.min_by("score", own).alias("credibility"))
    return df.join(best, domain, "left").withColumn("credibility", F.coalesce("credibility", F.lit(unknown)))


def has_mass_casualties(deaths: Column, injuries: Column, p: Scoring = Scoring()) -> Column:
    return F.coalesce((deaths >= p.deaths) | (injuries >= p.injuries), F.lit(False))


def severity(base: Column, near: Column, restricted: Column, deaths: Column, injuries: Column, umbrella: Column, aviation: Column, planned: Column, safety: Column, p: Scoring = Scoring()) -> Column:
    """Base, proximity, zone and casualties; an umbrella type without place or casualties is capped; then aviation, planned closures and accidents, in this order."""
    mass = has_mass_casualties(deaths, injuries, p)
    located = F.coalesce(near >= p.near, F.lit(False))
    s = F.coalesce(base, F.lit(p.base)) + p.proximity * located.cast("int") + p.restricted_zone * F.coalesce(restricted, F.lit(False)).cast("int") + p.casualties * mass.cast("int")
    harmed = F.coalesce((deaths > 0) | (injuries > 0), F.lit(False))
    s = F.least(F.lit(p.top), F.when(umbrella & ~located & ~harmed, F.least(s, F.lit(p.umbrella_cap))).otherwise(s))
    s = F.least(F.lit(p.top), s + p.aviation * aviation.cast("int"))
    s = F.when(planned, F.least(s, F.lit(p.planned_cap))).otherwise(s)
    return F.when(safety & ~mass, F.least(s, F.lit(p.safety_cap))).otherwise(s)


def diversity(domains: Column) -> Column:
    """Of a number of distinct domains."""
    return F.when(domains <= 1, 0.3).when(domains == 2, 0.5).when(domains == 3, 0.7).otherwise(F.least(F.lit(1.0), 0.85 + 0.03 * (domains - 4)))


def confidence(llm: Column, anchor: Column, spread: Column, trust: Column | None = None, p: Scoring = Scoring()) -> Column:
    raw = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(llm * p.llm_weight + anchor * p.anchor_weight + spread * p.diversity_weight + 1e-9, 3)))
    return raw if trust is None else raw * trust


def domain_penalty(df: DataFrame, domain: str, false_alarm: Column, prior: DataFrame | None = None) -> DataFrame:
    """Running counts of claims and false alarms by domain, and their share; prior counts are added by a full join."""
    now = df.groupBy(domain).agg(F.count("*").alias("total"), F.sum(false_alarm.cast("long")).alias("false_alarms"))
    if prior is not None:
        old = prior.select(domain, F.col("total").alias("_t"), F.col("false_alarms").alias("_f"))
        now = now.join(old, domain, "full").select(domain, (F.coalesce("total", F.lit(0)) + F.coalesce("_t", F.lit(0))).alias("total"), (F.coalesce("false_alarms", F.lit(0)) + F.coalesce("_f", F.lit(0))).alias("false_alarms"))
    return now.withColumn("penalty", F.col("false_alarms") / F.col("total"))


def penalized(df: DataFrame, least: float = 0.5, seen: int = 5) -> DataFrame:
    return df.where((F.col("penalty") >= least) & (F.col("total") >= seen))


def anchor_veto(anchor_country: Column, claimed: Column) -> Column:
    """Whether an anchor stands: not if both countries are known and differ."""
    return ~F.coalesce(anchor_country != claimed, F.lit(False))


def best_sibling(df: DataFrame, group: str, id_col: str, text: str, conf: str, level: str) -> DataFrame:
    """For rows without high confidence, the group's most confident named anchor if it ranks above the row's own level."""
    rank = lambda c: F.when(F.col(c) == "HIGH", 3).when(F.col(c) == "MEDIUM", 2).otherwise(1)
    best = df.where(F.col(text).isNotNull()).groupBy(group).agg(F.max(F.struct(rank(level).alias("r"), F.col(conf).alias("c"), (-F.col(id_col)).alias("i"), F.col(text).alias("t"))).alias("b"))
    return df.join(best, group).where(rank(level) < F.col("b.r")).select(id_col, F.col(level).alias("from_level"), F.col("b.t").alias("anchor"), (-F.col("b.i")).alias("sibling"))


def rescaled(base: Column, cap: int = 90, knee: int = 60, slope: float = 0.5) -> Column:
    """A catalogue's base severity above the knee, compressed and capped; ties round to even."""
    return F.least(F.lit(cap), F.when(base <= knee, base).otherwise(F.bround(knee + (base - knee) * slope, 0).cast("int")))


def latest_per(df: DataFrame, key: str, *order: Column) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def vocabulary_table(spark, v: Vocabulary = Vocabulary()) -> DataFrame:
    return spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(v.credibility.items())], "parent string, score double, place int")


def corroboration_weight(sources: Column) -> Column:
    """The row itself and its corroborating sources."""
    return 1 + F.greatest(F.coalesce(F.size(sources), F.lit(0)), F.lit(0))


def top_k(df: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first k rows of each group. The limit is the feature; Spark keeps k rows a task before it shuffles."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= k).drop("_rn")
