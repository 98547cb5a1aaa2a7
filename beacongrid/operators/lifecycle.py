"""States, retention, archives, watchdogs, keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matured(df: DataFrame, ingested: str, as_of: Column, hours: int = 2) -> DataFrame:
    return df.where(F.col(ingested) < as_of - F.expr(f"INTERVAL {hours} HOURS"))


def archivable(df: DataFrame, storyline: str, occurred: str, ingested: str, as_of: Column, days: int = 14, undated_days: int = 60) -> DataFrame:
    """Rows whose event is old and whose storyline has none since; undated rows by their intake. Two branches, so that the first is a plain anti join."""
    cut = as_of - F.expr(f"INTERVAL {days} DAYS")
    fresh = df.where(F.col(occurred) >= cut).select(storyline).distinct()
    dated = df.where(F.col(occurred) < cut).join(fresh, storyline, "left_anti")
    undated = df.where(F.col(occurred).isNull() & (F.col(ingested) < as_of - F.expr(f"INTERVAL {undated_days} DAYS")))
    return dated.unionByName(undated.select(*dated.columns))


def retained(df: DataFrame, status: str, tier: str, ingested: str, as_of: Column, days: int = 30) -> DataFrame:
    """All but archived rows without a tier that are older than `days`."""
    gone = (F.col(status) == "archived") & F.col(tier).isNull() & (F.col(ingested) < as_of - F.expr(f"INTERVAL {days} DAYS"))
    return df.where(~F.coalesce(gone, F.lit(False)))


def next_status(status: Column, relevance: Column, floor: int = 15) -> Column:
    return F.when(status == "raw", "deduped").when((status == "deduped") & (relevance < floor), "archived").otherwise(status)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """State after a merge by key, with _op: insert, update, keep. New rows replace old ones whole."""
    cols = [c for c in old.columns if c != key]
    a, b = old.select(F.col(key), F.struct(*cols).alias("_o")), new.select(F.col(key), F.struct(*cols).alias("_n"))
    both = a.join(b, key, "full")
    pick = [F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c) for c in cols]
    return both.select(key, *pick, F.when(F.col("_o").isNull(), "insert").when(F.col("_n").isNull(), "keep").otherwise("update").alias("_op"))


def gaps(df: DataFrame, micros: str, hours: float, group: str | None = None) -> DataFrame:
    """Silences longer than `hours` between a group's neighbouring rows: (group, since, hours)."""
    w = Window.partitionBy(*([group] if group else [])).orderBy(micros)
    e = df.withColumn("since", F.lag(micros).over(w)).withColumn("gap_hours", (F.col(micros) - F.col("since")) / 3_600_000_000)
    return e.where(F.col("gap_hours") > hours)


def run_allowed(df: DataFrame, started: str, ok: Column, as_of_micros: int, minutes: int = 45) -> DataFrame:
    """One row: minutes since the last success, and whether a run may start."""
    age = (F.lit(as_of_micros) - F.max(F.when(ok, F.col(started)))) / 60_000_000
    return df.agg(age.alias("age_minutes")).withColumn("allowed", F.coalesce(F.col("age_minutes") >= minutes, F.lit(True)))


def manifest(df: DataFrame, part: str, id_col: str, columns: list[str]) -> DataFrame:
    """Rows, and SHA-256 of their JSON lines in order of id, by part. Parts are bounded by the caller (days, chunks)."""
    line = F.struct(F.col(id_col).alias("i"), F.to_json(F.struct(*columns)).alias("j"))
    return df.groupBy(part).agg(F.count("*").alias("rows"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["j"]), "\n"), 256).alias("sha256"))


def zones_by_country(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Active zones by ISO code: (iso, zones). Unknown country names are dropped."""
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    e = df.where("active").select("zone", F.explode(F.filter(F.transform(F.split("countries", r"\s*[,;]\s*"), lambda c: known[F.lower(c)]), lambda x: x.isNotNull())).alias("iso"))
    return e.groupBy("iso").agg(F.array_join(F.array_sort(F.collect_set("zone")), ",").alias("zones"))


def adjacency(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges in both directions, once, without loops."""
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b")))
    return both.where("a != b").distinct()


def acquired(df: DataFrame, claims: DataFrame, id_col: str, now: Column) -> DataFrame:
    """df after workers tried to lock rows: claims (id, worker, at). The first claim on a free row of status deduped wins, by time, then worker; lock_owner, heartbeat and status follow."""
    first = claims.groupBy(id_col).agg(F.min(F.struct("at", "worker")).alias("_c"))
    free = F.col("_c").isNotNull() & (F.col("status") == "deduped") & F.col("lock_owner").isNull()
    got = df.join(first, id_col, "left")
    return got.select(
        *(c for c in df.columns if c not in ("status", "lock_owner", "heartbeat")), F.when(free, "locked").otherwise(F.col("status")).alias("status"), F.when(free, F.col("_c.worker")).otherwise(F.col("lock_owner")).alias("lock_owner"), F.when(free, now).otherwise(F.col("heartbeat")).alias("heartbeat")
    )


def released(df: DataFrame, releases: DataFrame, id_col: str) -> DataFrame:
    """df after workers gave rows back: releases (id, worker, requeue). Only the owner's counts; a row that is still locked is queued again if asked for; a second release changes nothing."""
    r = releases.groupBy(id_col, F.col("worker").alias("lock_owner")).agg(F.bool_or("requeue").alias("_q"))
    got = df.join(r, [id_col, "lock_owner"], "left")
    own = F.col("_q").isNotNull()
    return got.select(*(c for c in df.columns if c not in ("status", "lock_owner")), F.when(own & F.col("_q") & (F.col("status") == "locked"), "deduped").otherwise(F.col("status")).alias("status"), F.when(~own, F.col("lock_owner")).alias("lock_owner"))


def transitioned(df: DataFrame, changes: DataFrame, id_col: str) -> DataFrame:
    """df with the status of each row that changes (id, from_status, to_status) names, where its status is still from_status; one change a row and status."""
    got = df.join(changes.select(id_col, F.col("from_status").alias("status"), "to_status"), [id_col, "status"], "left")
    return got.select(*(F.coalesce("to_status", "status").alias("status") if c == "status" else F.col(c) for c in df.columns))


def degradations(stats: DataFrame, sample: int = 10) -> DataFrame:
    """(stage, problem) of a run's counters: (stage, name, value, message). An error, failed events, and dates of which none could be verified in `sample` fetched articles or more."""
    error = stats.where("name = 'error' and message is not null").select("stage", F.col("message").alias("problem"))
    failed = stats.where("name = 'events_failed' and value > 0").select("stage", F.concat(F.col("value").cast("string"), F.lit(" event(s) failed")).alias("problem"))
    g = stats.groupBy("stage").agg(F.coalesce(F.max(F.when(F.col("name") == "full_text_attempted", F.col("value"))), F.lit(0)).alias("a"), F.coalesce(F.max(F.when(F.col("name") == "publish_dates_verified", F.col("value"))), F.lit(0)).alias("v"))
    down = g.where((F.col("stage") == "pass_a") & (F.col("a") >= sample) & (F.col("v") == 0)).select("stage", F.concat(F.lit("no date verified in "), F.col("a").cast("string"), F.lit(" articles")).alias("problem"))
    return error.unionByName(failed).unionByName(down)


def counters(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows and the median of a value, rounded down, by group."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.floor(F.median(value)).cast("int").alias(f"median_{value}"))


def metrics(df: DataFrame, kind: str, since: Column, at: str, payload: str, path: str) -> DataFrame:
    """Rows of each kind since a time, and the sum of one number of their JSON payload."""
    return df.where(F.col(at) >= since).groupBy(kind).agg(F.count("*").alias("n"), F.sum(F.get_json_object(payload, path).cast("int")).alias("total"))


def relevance_status(severity: Column, event_type: Column, disrupted: Column, floor: int = 30, protest_floor: int = 40, disrupted_floor: int = 40) -> Column:
    """archived or classified: disrupted flights count for `disrupted_floor` at least; protests need more than others."""
    s = F.when(disrupted, F.greatest(severity, F.lit(disrupted_floor))).otherwise(severity)
    return F.when((s < floor) | ((event_type == "protest") & (s < protest_floor)), "archived").otherwise("classified")
