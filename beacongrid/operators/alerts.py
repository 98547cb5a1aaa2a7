"""Alert tiers, suppression and escalation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import accidental_cause, aftermath
from ..params import FRESH, NOT_NEWS, TIERS, Alerts
from ..session import settled


def rank(tier: Column) -> Column:
    """3, 2, 1 for CRITICAL, ALERT, WATCH; 0 else."""
    out = F.lit(0)
    for i, t in enumerate(reversed(TIERS)):
        out = F.when(tier == t, i + 1).otherwise(out)
    return out


def _ladder(sev: Column, conf: Column, certainty: Column, located: Column, corroboration: Column, p: Alerts) -> Column:
    """Tier number of the ladder, raised by the two floors to ALERT at most."""
    fresh = certainty.isin(*FRESH)
    n = F.lit(0)
    for k, t in enumerate(reversed(p.ladder)):
        ok = (sev >= t.severity) & (conf >= t.confidence)
        ok = ok & located if t.located else ok
        ok = ok & (located | fresh) if t.located_or_fresh else ok
        ok = ok & fresh if t.fresh else ok
        n = F.when(ok, k + 1).otherwise(n)
    watch = p.ladder[-1].severity
    floor = fresh & ((sev >= p.severity_floor) | ((corroboration >= p.corroboration_floor) & (sev >= watch)))
    return F.when(floor, F.greatest(n, F.lit(2))).otherwise(n)


def tiers(df: DataFrame, as_of: Column, p: Alerts = Alerts()) -> DataFrame:
    """tier and veto for rows with severity, confidence, time_certainty, date_verified, published_at, anchor, latitude, n_corroborating, event_type, title and report_kind.

    A fresh time on an unverified date counts as unknown; an unknown one on a verified date published within a day counts as the previous day. Advisories go by
    severity alone. Vetoes: the unverified date where it cost the tier; below CRITICAL, headlines and articles about old news; at any tier, accidents.
    """
    verified = F.coalesce("date_verified", F.lit(True))
    raw = F.coalesce("time_certainty", F.lit("unknown"))
    unverified = ~verified & raw.isin(*FRESH)
    known = F.when(unverified, "unknown").otherwise(raw)
    recent = F.coalesce(F.col("published_at") >= as_of - F.expr("INTERVAL 1 DAY"), F.lit(False))
    certainty = F.when((known == "unknown") & verified & recent, "previous_day").otherwise(known)
    located = F.coalesce(F.col("anchor") != "", F.lit(False)) | F.col("latitude").isNotNull()
    sev, conf, more = F.coalesce("severity", F.lit(0)), F.coalesce("confidence", F.lit(0.0)), F.coalesce("n_corroborating", F.lit(0))
    advisory = F.coalesce(F.col("event_type").isin(*p.advisory_types), F.lit(False))
    n = F.when(advisory, F.when(sev >= p.advisory_severity, 2).otherwise(1)).otherwise(_ladder(sev, conf, certainty, located, more, p))
    would = _ladder(sev, conf, raw, located, F.lit(0), p)
    veto = (
        F.when(advisory, F.lit(None))
        .when((n == 0) & unverified & (would > 0), "date_unverified")
        .when(n.isin(1, 2) & aftermath("title").isNotNull(), "aftermath_title")
        .when(n.isin(1, 2) & F.col("report_kind").isin(*NOT_NEWS), F.concat(F.lit("report_kind_"), F.col("report_kind")))
        .when((n > 0) & accidental_cause("title", "event_type").isNotNull(), F.concat(F.lit("accidental_"), accidental_cause("title", "event_type")))
    )
    out = df.withColumn("_n", n).withColumn("veto", veto)
    name = F.when(F.col("_n") == 3, TIERS[0]).when(F.col("_n") == 2, TIERS[1]).when(F.col("_n") == 1, TIERS[2])
    return out.withColumn("tier", F.when(F.col("veto").isNull(), name)).drop("_n")


def suppression_keys(storyline: Column, id_col: Column, anchor: Column, country: Column, place: Column) -> tuple[Column, Column]:
    """The storyline's key (the row's own without a storyline), and the place's (null without a place)."""
    own = F.concat_ws("|", storyline, F.coalesce(anchor, F.lit("UNKNOWN")))
    loc = F.coalesce(anchor, place)
    return F.when(storyline.isNull(), F.concat(F.lit("no_storyline|"), id_col)).otherwise(own), F.when(loc.isNotNull() & (loc != "UNKNOWN"), F.concat_ws("|", F.lit("geofp"), F.coalesce(country, F.lit("??")), loc))


def fold_suppression(rows: list[tuple[int, int, int]], state: tuple[int, int] | None, hours: int) -> tuple[list[tuple[int, bool]], tuple[int, int] | None]:
    """rows: (id, microseconds, rank) of one key in time order; state: (rank, expiry). An active claim of the same or a higher rank blocks; a firing row raises the rank, never lowers it, and renews the expiry."""
    out = []
    for i, t, r in rows:
        active = state is not None and t < state[1]
        blocked = active and r <= state[0]
        out.append((i, blocked))
        if not blocked:
            state = (max(r, state[0]) if active else r, t + hours * 3_600_000_000)
    return out, state


def suppressed(df: DataFrame, key: str, id_col: str, micros: str, tier_rank: str, hours: int = 4) -> DataFrame:
    """(id, blocked) by the claim state of each key, in time order; ties go by id.

    State lives by key, so rows are dealt by key and sorted in each partition, then streamed through once: a hot key costs time, never memory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for pdf in batches:
            out = []
            for k, i, t, r in zip(pdf["k"].tolist(), pdf["i"].tolist(), pdf["t"].tolist(), pdf["r"].tolist(), strict=True):
                if k != at:
                    at, state = k, None
                told, state = fold_suppression([(i, t, r)], state, hours)
                out += told
            yield pd.DataFrame(out, columns=["id", "blocked"])

    rows = df.where(F.col(tier_rank) > 0).select(F.col(key).alias("k"), F.col(id_col).cast("long").alias("i"), F.col(micros).cast("long").alias("t"), F.col(tier_rank).cast("int").alias("r"))
    return rows.repartition("k").sortWithinPartitions("k", "t", "i").mapInPandas(run, "id long, blocked boolean")


def fresh_enough(ingested: Column, as_of: Column, p: Alerts = Alerts()) -> Column:
    """Whether a row is young enough to page: `stale_days` since its intake at most. A row without a time of intake is."""
    return F.coalesce(ingested >= as_of - F.expr(f"INTERVAL {p.stale_days} DAYS"), F.lit(True))


def claim(held: dict[str, tuple[int, int]], t: int, r: int, keys: list[str], sent: bool, hours: int) -> str:
    """Decision on a row of rank r at microsecond t, after those before it; held: (rank, expiry) by key. A row is suppressed if a live claim on one of its keys is of its rank or higher; else it claims all its keys,
    raising the ranks of live claims and renewing expiries, and is sent; if sending fails it sets all its keys free, older claims on them included."""
    for k in [k for k in keys if k in held and held[k][1] <= t]:
        del held[k]
    if any(k in held and r <= held[k][0] for k in keys):
        return "suppressed"
    for k in keys:
        if sent:
            held[k] = (max(r, held[k][0]) if k in held else r, t + hours * 3_600_000_000)
        else:
            held.pop(k, None)
    return "sent" if sent else "failed"


def two_key_claims(df: DataFrame, hours: int = 4) -> DataFrame:
    """(id, decision): sent, suppressed or failed, by the claims on two keys. df: id, t (microseconds), rank (over 0), key, geo (may be null), sent (whether delivery worked).

    A decision depends on those before it on either key, so rows that keys join, directly or over other rows, are one stream: such groups are components of the graph of keys, found by joining
    whole groups to the smallest group beside them, so a long chain of keys takes far fewer rounds than it has links; rows are dealt by group, sorted, and only the claims of the open group are held.
    """
    rows = df.where("rank > 0 and t is not null")
    edges = rows.where("geo is not null").select("key", "geo").distinct()
    label = settled(edges.select("key", F.col("key").alias("group")).distinct())
    while True:
        low = edges.join(label, "key").groupBy("geo").agg(F.min("group").alias("low"))
        near = edges.join(low, "geo").groupBy("key").agg(F.min("low").alias("low"))
        to = settled(label.join(near, "key").groupBy("group").agg(F.min("low").alias("to")))
        if to.where("to < group").isEmpty():
            break
        for _ in range(2):  # a group that joins another may find that joining a third
            to = to.join(to.select(F.col("group").alias("to"), F.col("to").alias("further")), "to").select("group", F.col("further").alias("to"))
        label = settled(label.join(to, "group").select("key", F.col("to").alias("group")))
    dealt = rows.join(label, "key", "left").select(F.coalesce("group", "key").alias("k"), F.col("id").alias("i"), "t", F.col("rank").cast("int").alias("r"), "key", "geo", "sent")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, {}
        for pdf in batches:
            done = []
            for k, i, t, r, a, b, sent in zip(*(pdf[c].tolist() for c in ("k", "i", "t", "r", "key", "geo", "sent")), strict=True):
                if k != at:
                    at, held = k, {}
                done.append((i, claim(held, t, r, [x for x in (a, b) if isinstance(x, str)], bool(sent), hours)))
            yield pd.DataFrame(done, columns=["id", "decision"]).astype({"id": "int64"})

    return dealt.repartition("k").sortWithinPartitions("k", "t", "i").mapInPandas(run, "id long, decision string")


def escalations(df: DataFrame, group: str, order: list[Column], tier_rank: Column) -> DataFrame:
    """peak: highest rank so far; escalated: a row above the peak of the rows before it."""
    w = Window.partitionBy(group).orderBy(*order)
    before = F.max("_r").over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = df.withColumn("_r", tier_rank).where("_r > 0")
    return out.withColumn("peak", F.max("_r").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("escalated", F.coalesce(F.col("_r") > before, F.lit(False))).drop("_r")


def quiet_closures(df: DataFrame, group: str, micros: str, hours: int = 12) -> DataFrame:
    """Runs of pages without a gap of `hours` or more: (group, opened, closed, pages); each closes `hours` after its last page."""
    gap = hours * 3_600_000_000
    w = Window.partitionBy(group).orderBy(micros)
    new = (F.col(micros) - F.lag(micros).over(w) >= gap).cast("int")
    runs = df.where(F.col(micros).isNotNull()).withColumn("_s", F.sum(F.coalesce(new, F.lit(0))).over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(group, "_s").agg(F.min(micros).alias("opened"), (F.max(micros) + gap).alias("closed"), F.count("*").alias("pages")).drop("_s")


def recent_paged(claims: DataFrame, events: DataFrame, as_of_micros: int, most: int = 6) -> DataFrame:
    """Storylines with a live claim, their highest tier and latest expiry; the top by expiry."""
    live = claims.where(F.col("expires") > as_of_micros).join(events, "id")
    return live.groupBy("storyline").agg(F.max("tier_rank").alias("tier_rank"), F.max("expires").alias("expires")).orderBy(F.desc("expires"), "storyline").limit(most)


def located(anchor: Column, latitude: Column) -> Column:
    """Whether a place is known: an anchor or a coordinate."""
    return F.coalesce(anchor != "", F.lit(False)) | latitude.isNotNull()
