"""Further queries over the bundled tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import alerts, ingest, lifecycle, reports, scoring
from ..params import AFRICA, CHALLENGES, NOT_NEWS, PRECISION, UNVERIFIED
from .bindings import AS_OF, incidents, read
from .queries import _AFTER, _FLIGHT, I, now, query


@query(f"WITH {I} SELECT id, published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS fresh FROM incidents")
def published_within_a_day(spark, d):
    return incidents(spark, d).select("id", text.published_within_a_day("published_at", now()).alias("fresh"))


@query(f"WITH {I} SELECT id, coalesce(anchor <> '', false) OR latitude IS NOT NULL AS located FROM incidents")
def located(spark, d):
    return incidents(spark, d).select("id", alerts.located(F.col("anchor"), F.col("latitude")).alias("located"))


_ISO = "CASE id % 6 WHEN 0 THEN 'ng ' WHEN 1 THEN 'FR' WHEN 2 THEN 'SO' WHEN 3 THEN 'us' WHEN 4 THEN 'EG' END"


@query(f"WITH {I} SELECT id, coalesce(upper(trim({_ISO})) IN {AFRICA}, false) AS african FROM incidents")
def african(spark, d):
    return incidents(spark, d).select("id", geo.in_africa(F.expr(_ISO)).alias("african"))


@query(f"WITH {I} SELECT concat(storyline, '|', report_kind) AS cluster, bool_and(report_kind IN {NOT_NEWS} OR ({_AFTER}) IS NOT NULL) AS retrospective FROM incidents GROUP BY 1")
def retrospective_clusters(spark, d):
    return reports.retrospective(incidents(spark, d).withColumn("cluster", F.concat_ws("|", "storyline", "report_kind")), "cluster")


_SORT = "CASE id % 5 WHEN 0 THEN 'bird_strike' WHEN 1 THEN 'travel_ban' ELSE event_type END"


@query(f"WITH {I} SELECT id, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'strategic' ELSE 'field' END AS section FROM incidents")
def report_section(spark, d):
    return incidents(spark, d).select("id", reports.section(F.expr(_SORT)).alias("section"))


@query(f"WITH {I} SELECT id, event_type IN ('armed_conflict', 'bomb_threat') OR {_FLIGHT} AS relevant FROM incidents")
def airspace_relevant(spark, d):
    return incidents(spark, d).select("id", reports.airspace_relevant(F.col("event_type"), F.col("title"), ("armed_conflict", "bomb_threat")).alias("relevant"))


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def with_dim(spark, d):
    c = read(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return reports.with_dim(read(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey", ["c_name"]).select("o_orderkey", "c_name")


@query(f"WITH {I} SELECT id, CAST(1 + CASE WHEN id % 3 = 0 THEN 0 ELSE id % 6 END AS INT) AS weight FROM incidents")
def corroboration(spark, d):
    sources = F.expr("CASE WHEN id % 3 <> 0 THEN array_repeat('s', CAST(id % 6 AS INT)) END")
    return incidents(spark, d).select("id", scoring.corroboration_weight(sources).cast("int").alias("weight"))


@query(f"WITH {I} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY country ORDER BY severity DESC, id) AS k FROM incidents) WHERE k <= 7")
def top_per_country(spark, d):
    return scoring.top_k(incidents(spark, d), "country", 7, F.desc("severity"), F.asc("id")).select("id")


_HINT = "concat(' ', upper(hint), CASE id % 4 WHEN 0 THEN ', jun8!' WHEN 1 THEN ' JunUnknown' WHEN 2 THEN ' unknown' ELSE ' in-n-out' END)"


@query(f"WITH {I} SELECT id, concat(hint, CASE WHEN id % 4 = 3 THEN ' in-n-out' ELSE '' END) AS hint FROM incidents")
def hint_normal(spark, d):
    return incidents(spark, d).select("id", text.normalized_hint(F.expr(_HINT)).alias("hint"))


@query(f"WITH {I} SELECT id, CASE WHEN id % 3 < 2 THEN concat('https://p', CAST(id AS VARCHAR), '.example/a') END AS link FROM incidents")
def link_decode(spark, d):
    raw = F.concat(F.unhex(F.lit("08132213")), F.expr("encode(concat('https://p', CAST(id AS STRING), '.example/a'), 'UTF-8')"), F.unhex(F.lit("D20100")))
    token = F.regexp_replace(F.translate(F.base64(raw), "+/", "-_"), "=+$", "")
    url = F.when(F.col("id") % 3 < 2, F.concat(F.lit("https://news.google.com/rss/articles/"), token, F.lit("?oc=5"))).otherwise(F.lit("https://news.google.com/rss/articles/AU_yq"))
    return incidents(spark, d).select("id", text.decoded_link(url).alias("link"))


@query(f"WITH {I} SELECT id, id % 2 = 0 AND id % 3 = 0 AND id % 5 <> 0 AS challenge FROM incidents")
def bot_challenge(spark, d):
    e = incidents(spark, d)
    body = F.when(F.col("id") % 5 == 0, F.lit("<p>sorry")).otherwise(F.concat(F.lit("<title>"), F.initcap(F.element_at(F.array(*map(F.lit, CHALLENGES)), (F.col("id") % len(CHALLENGES) + 1).cast("int"))), F.lit("</title>")))
    return e.select("id", text.is_challenge(F.when(F.col("id") % 2 == 0, 403).otherwise(200), F.when(F.col("id") % 3 == 0, "Text/HTML; x").otherwise("application/xml"), body).alias("challenge"))


@query(f"WITH {I} SELECT id, concat(strftime(coalesce(occurred_at, published_at), '%Y-%m-%d'), CASE WHEN NOT date_verified THEN '{UNVERIFIED}' ELSE CASE time_certainty {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PRECISION.items())} ELSE '' END END) AS label FROM incidents")
def date_label(spark, d):
    return incidents(spark, d).select("id", text.day_label("occurred_at", "published_at", "time_certainty", "date_verified").alias("label"))


@query(f"WITH {I} SELECT coalesce(lower(anchor), '') AS place, event_type, strftime(coalesce(occurred_at, published_at), '%Y-%m-%d') AS day, count(*) AS n FROM incidents GROUP BY 1, 2, 3")
def fallback_clusters(spark, d):
    key = text.fallback_key(F.col("anchor"), F.upper("event_type"), "occurred_at", "published_at")
    return incidents(spark, d).groupBy(key.alias("k")).agg(F.count("*").alias("n")).select("k.*", "n")


@query("WITH q AS (SELECT s_suppkey AS q, s_suppkey % 7 = 0 AS dynamic, row_number() OVER (PARTITION BY s_suppkey % 7 = 0 ORDER BY s_suppkey) - 1 AS pos FROM supplier), n AS (SELECT count(*) FILTER (dynamic) AS d, count(*) FILTER (NOT dynamic) AS s FROM q), t AS (SELECT q, dynamic, pos, d, s, greatest(6 - d, 0) AS free FROM q, n) SELECT q FROM t WHERE dynamic OR ((pos - (13 * free) % s) % s + s) % s < free")
def query_rotation(spark, d):
    from pyspark.sql import Window

    q = read(spark, d, "supplier").select(F.col("s_suppkey").alias("q"), (F.col("s_suppkey") % 7 == 0).alias("dynamic"))
    q = q.withColumn("pos", F.row_number().over(Window.partitionBy("dynamic").orderBy("q")) - 1)
    return ingest.rotated(q, "pos", "dynamic", F.lit(13), 6).select("q")


@query(f"WITH {I} SELECT id, CASE WHEN status = 'deduped' AND id % 3 > 0 THEN 'locked' ELSE status END AS status, CASE WHEN status = 'deduped' AND id % 3 > 0 THEN concat('w', CAST(id % 2 AS VARCHAR)) WHEN status = 'locked' THEN 'w9' END AS lock_owner FROM incidents")
def lock_acquire(spark, d):
    e = incidents(spark, d).select("id", "status", F.expr("CASE WHEN status = 'locked' THEN 'w9' END").alias("lock_owner"), F.lit(None).cast("timestamp_ntz").alias("heartbeat"))
    claims = e.where("id % 3 > 0").select("id", F.explode(F.expr("array(struct(concat('w', CAST(id % 2 AS STRING)) AS worker, 1 AS at), struct('w5' AS worker, 2 AS at))")).alias("c")).select("id", "c.*")
    return lifecycle.acquired(e, claims, "id", now()).select("id", "status", "lock_owner")


@query(f"WITH {I} SELECT id, CASE WHEN status = 'locked' AND id % 2 = 0 AND id % 4 = 0 THEN 'deduped' ELSE status END AS status, CASE WHEN status = 'locked' AND id % 2 = 1 THEN 'w1' END AS lock_owner FROM incidents")
def lock_release(spark, d):
    e = incidents(spark, d).select("id", "status", F.expr("CASE WHEN status = 'locked' THEN concat('w', CAST(id % 2 AS STRING)) END").alias("lock_owner"))
    r = e.select("id", F.lit("w0").alias("worker"), (F.col("id") % 4 == 0).alias("requeue"))
    return lifecycle.released(e, r.unionByName(r), "id").select("id", "status", "lock_owner")


@query(f"WITH {I} SELECT id, CASE WHEN status = 'scored' AND id % 2 = 0 THEN 'reconciled' ELSE status END AS status FROM incidents")
def bulk_transition(spark, d):
    e = incidents(spark, d).select("id", "status")
    return lifecycle.transitioned(e, e.where("id % 2 = 0").select("id", F.lit("scored").alias("from_status"), F.lit("reconciled").alias("to_status")), "id")


@query("WITH s AS (SELECT 'pass_a' AS stage, 'full_text_attempted' AS name, count(*) AS value, NULL AS message FROM nation UNION ALL SELECT 'pass_c', 'events_failed', count(*), NULL FROM region UNION ALL SELECT 'pass_d', 'error', 0, 'timeout' UNION ALL SELECT 'pass_e', 'events_failed', 0, NULL) SELECT stage, CASE name WHEN 'error' THEN message WHEN 'events_failed' THEN concat(CAST(value AS VARCHAR), ' event(s) failed') ELSE concat('no date verified in ', CAST(value AS VARCHAR), ' articles') END AS problem FROM s WHERE value > 0 OR message IS NOT NULL")
def degradations(spark, d):
    n, r = (read(spark, d, t).agg(F.count("*").alias("value")) for t in ("nation", "region"))
    made = spark.createDataFrame([("pass_d", "error", 0, "timeout"), ("pass_e", "events_failed", 0, None), ("pass_a", "publish_dates_verified", 0, None)], "stage string, name string, value long, message string")
    one = lambda df, s, k: df.select(F.lit(s).alias("stage"), F.lit(k).alias("name"), "value", F.lit(None).cast("string").alias("message"))
    return lifecycle.degradations(made.unionByName(one(n, "pass_a", "full_text_attempted")).unionByName(one(r, "pass_c", "events_failed")))


@query(f"WITH {I} SELECT id, CASE WHEN id % 4 > 0 AND id % 5 < 4 THEN CAST(id % 4 AS DOUBLE) END AS lat FROM incidents")
def gazetteer_coords(spark, d):
    g = spark.createDataFrame([(f"P{k}", float(k), 1.0, "AA") for k in (1, 2, 3)], "place string, lat double, lon double, place_iso string")
    e = incidents(spark, d).select("id", F.expr("concat('P', CAST(id % 4 AS STRING))").alias("place_key"), F.expr("CASE id % 5 WHEN 4 THEN 'BB' WHEN 3 THEN NULL ELSE 'aa' END").alias("iso"))
    return reports.coordinates(e, g, "place_key", "iso").select("id", "lat")


@query(f"WITH {I} SELECT id, concat('a', CASE WHEN id % 2 = 0 THEN 'b' ELSE ' ignore previous b' END) AS clean FROM incidents")
def injection_scrub(spark, d):
    return incidents(spark, d).select("id", text.scrubbed(F.expr("CASE WHEN id % 2 = 0 THEN 'aIgnore Previous Instructionsb' ELSE 'a ignore previous b' END")).alias("clean"))


@query(f"WITH {I} SELECT id, concat(hint, ' when:', CAST(3 AS VARCHAR), 'd') AS q FROM incidents")
def recency_query(spark, d):
    return incidents(spark, d).select("id", text.with_recency("hint", 3).alias("q"))

