"""Weekly risk: tension index, trajectories, watchlists, flash triggers, grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import Tension


def tension(df: DataFrame, country: str, p: Tension = Tension(), clusters: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """Components v, s_avg, s_max, r, q, x, c (and d with clusters), and the index, 0 to 100, by country.

    df: severity, t (microseconds or null), credibility, event_type, hint. clusters: (country, cluster_count); previous: (country, prev_ti).
    """
    sev = F.least(F.greatest(F.coalesce(F.col("severity").cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(100.0))
    newest = df.groupBy(country).agg(F.max("t").alias("newest"))
    e = df.withColumn("sev", sev).join(newest, country)
    age = F.coalesce((F.col("newest") - F.col("t")) / 3_600_000_000.0, F.lit(p.undated_age_hours))
    e = e.withColumn("w", F.pow(F.lit(2.0), -age / p.half_life_hours))
    kind = F.coalesce("event_type", F.lit(""))
    any_ = lambda c: F.max(c.cast("int"))
    g = e.groupBy(country).agg(
        F.count("*").alias("n"), F.avg("sev").alias("s_avg"), F.max("sev").alias("s_max"), (F.sum(F.col("w") * F.col("sev")) / F.sum("w")).alias("r"), (100 * F.avg("credibility")).alias("q"),
        (any_(kind.contains("cyber")) + any_((kind == "airspace_restriction") | F.lower(F.coalesce("hint", F.lit(""))).contains("notam")) + any_(~kind.isin("cyber_infrastructure", "airspace_restriction"))).alias("domains"),
    )
    most = g.agg(F.max("n").alias("most"))
    g = g.join(F.broadcast(most)).withColumn("v", 100 * F.col("n") / F.col("most"))  # one row
    g = g.withColumn("x", F.when(F.col("domains") == 3, 100.0).when(F.col("domains") == 2, 50.0).otherwise(0.0)).withColumn("c", F.when((F.col("s_max") >= 80) & (F.col("domains") >= 2), 100.0).otherwise(0.0))
    if clusters is None:
        g = g.withColumn("d", F.lit(0.0))
    else:
        g = g.join(clusters, country, "left").withColumn("d", F.least(F.lit(100.0), 100 * F.log1p(F.coalesce("cluster_count", F.lit(0)).cast("double")) / F.log(F.lit(11.0))))
    parts = ((p.volume, "v"), (p.diversity, "d"), (p.severity_avg, "s_avg"), (p.severity_max, "s_max"), (p.recency, "r"), (p.quality, "q"), (p.cross_domain, "x"), (p.critical, "c"))
    static = sum((w * F.col(k) for w, k in parts), F.lit(0.0))
    g = g.withColumn("static", static / (1 - p.delta))
    g = g.join(previous, country, "left").withColumn("delta", F.coalesce(F.col("static") - F.col("prev_ti"), F.lit(0.0))) if previous is not None else g.withColumn("delta", F.lit(0.0))
    return g.withColumn("ti", F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("static") * (1 - p.delta) + p.delta * F.col("delta"))))


def z_scores(df: DataFrame, country: str, week: str, value: str, weeks: int = 8) -> DataFrame:
    """z of each week's value against up to `weeks` before it (two at least; deviation 1 at least), and the trajectory."""
    w = Window.partitionBy(country).orderBy(week).rowsBetween(-weeks, -1)
    n, mean, dev = F.count(value).over(w), F.avg(value).over(w), F.greatest(F.stddev_pop(value).over(w), F.lit(1.0))
    z = F.when(n >= 2, (F.col(value) - mean) / dev).otherwise(F.lit(0.0))
    delta = F.col(value) - F.coalesce(mean, F.col(value))
    return df.withColumn("z", z).withColumn("trajectory", F.when((delta > 8) & (z > 1), "escalating").when(delta < -8, "easing").otherwise("stable"))


def watch(df: DataFrame) -> Column:
    """watchlist: calm but rising; emerging: one to three clusters with a severe event from a credible source."""
    return F.when((F.col("ti") <= 50) & (F.col("delta") > 0) & (F.col("z") > 0.5), "watchlist").when(F.col("cluster_count").between(1, 3) & F.col("severe_credible"), "emerging")


def within_reach(df: DataFrame, group: str, micros: str, span: int, value: Column, name: str, ahead: bool = False) -> DataFrame:
    """df with the sum of `value` over the rows of a group from `span` microseconds before a row up to it (with `ahead`: from it up to `span` after it), both ends and ties included. Rows without time go.

    A frame that slides by values is added up anew for each row, so a row's work would grow with the window. Time is cut into stretches of `span` instead: a window is the beginning of one stretch and the end of the
    one before, each a running sum over one sorted stretch, so work is in proportion and a group is many tasks.
    """
    t, h = F.col(micros), F.floor(F.col(micros) / span)
    mark = lambda at, h, late: F.struct(at.alias("at"), h.alias("h"), F.lit(late).alias("late"))
    marks = df.where(t.isNotNull()).withColumn("_v", value).withColumn("_m", F.explode(F.array(mark(t, h, False), mark(t + span, h + 1, True)))).select("*", "_m.*").drop("_m")
    of = Window.partitionBy(group, "h")
    now, late = (F.when(F.col("late") == x, F.col("_v")).otherwise(0) for x in (False, True))
    run = of.orderBy("at")
    total = F.sum(now).over(run.rangeBetween(Window.unboundedPreceding, 0)) + F.sum(late).over(of) - F.coalesce(F.sum(late).over(run.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return marks.withColumn(name, total).where(F.col("late") == ahead).drop("_v", "at", "h", "late")


def flash_verified(df: DataFrame, hours: int = 6, credible: float = 0.8, sure: float = 0.66, least: int = 3) -> DataFrame:
    """Starts of a window of `hours` with `least` verified events or more in a country: (id, verified)."""
    ok = F.coalesce(((F.col("credibility") >= credible) | (F.col("confidence") >= sure)).cast("int"), F.lit(0))
    e = df.select("id", "country", "t", ok.alias("ok"))
    return within_reach(e, "country", "t", hours * 3_600_000_000, F.col("ok"), "verified", ahead=True).where(F.col("verified") >= least).select("id", "verified")


def flash_triggers(z: DataFrame, meeting: DataFrame, verified: DataFrame, top: float = 3.0, most: int = 5) -> DataFrame:
    """One trigger a country: z above `top`; else its first start that converges or is verified, convergence first. z: (country, z); the others: (country, id, t)."""
    high = z.where(F.col("z") > top).select("country", F.lit("z_score").alias("trigger"), F.lit(None).cast("long").alias("id"), F.lit(0).alias("r"))
    starts = meeting.select("country", "id", "t", F.lit(0).alias("k")).unionByName(verified.select("country", "id", "t", F.lit(1).alias("k")))
    first = starts.groupBy("country").agg(F.min(F.struct("t", "id", "k")).alias("m")).join(high, "country", "left_anti")
    low = first.select("country", F.when(F.col("m.k") == 0, "convergence").otherwise("verified").alias("trigger"), F.col("m.id").alias("id"), F.lit(1).alias("r"))
    return high.unionByName(low).orderBy("r", "country").limit(most).drop("r")


def grades(df: DataFrame) -> DataFrame:
    """Forecasts against what came: rows of report, predicted, confidence_label, delta, z, flagged. Escalating: delta above 8 and z above 1; de-escalating: delta below -8."""
    actual = F.when((F.col("delta") > 8) & (F.col("z") > 1), "Escalating").when(F.col("delta") < -8, "De-escalating").otherwise("Stable")
    prob = F.when(F.col("confidence_label") == "HIGH", 0.9).when(F.col("confidence_label") == "LOW", 0.5).otherwise(0.7)
    e = df.withColumn("actual", actual).withColumn("hit", (F.col("predicted") == F.col("actual")).cast("int")).withColumn("up", (F.col("actual") == "Escalating").cast("int"))
    called = (F.col("flagged")).cast("int")
    return e.groupBy("report").agg(
        F.avg("hit").alias("accuracy"), F.avg(F.pow(prob - F.col("hit"), 2)).alias("brier"), F.try_divide(F.sum(F.col("up") * called), F.sum("up")).alias("recall"), F.try_divide(F.sum((1 - F.col("up")) * called), F.sum(called)).alias("false_alarm_rate")
    )


def calibration(df: DataFrame, last: int = 4) -> DataFrame:
    """Over the newest graded reports: cases, hits and over- and under-calls by country."""
    newest = df.select("report").distinct().orderBy(F.desc("report")).limit(last)
    e = df.join(newest, "report", "left_semi")
    return e.groupBy("country").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("long")).alias("hits"), F.sum(((F.col("predicted") == "Escalating") & (F.col("hit") == 0)).cast("long")).alias("over"), F.sum(((F.col("predicted") == "De-escalating") & (F.col("hit") == 0)).cast("long")).alias("under"))


def fallback(df: DataFrame, country: str, severity: str, most: int = 8) -> DataFrame:
    """The countries of the highest mean severity, where no model says which matter; the limit is the feature."""
    return df.groupBy(country).agg(F.avg(severity).alias("ti")).orderBy(F.desc("ti"), country).limit(most)
