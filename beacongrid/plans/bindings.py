"""The bundled tables seen as incidents, headlines, articles and pages.

A binding is a list of SQL expressions that both engines read, so that a query and its oracle start from the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reachable

AS_OF = "2024-01-31 00:00:00"
AS_OF_MICROS = 1_706_659_200_000_000

INCIDENTS = {
    "id": "event_id",
    "occurred_at": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END",
    "published_at": "ts + INTERVAL '3' HOUR",
    "ingested_at": "ts + INTERVAL '4' HOUR",
    "country": "n_name",
    "country_iso": "concat('N', CAST(n_nationkey AS STRING))",
    "storyline": "concat('st', CAST(user_id AS STRING))",
    "event_type": "CASE event_type WHEN 'click' THEN 'armed_conflict' WHEN 'error' THEN 'cyber_infrastructure' WHEN 'purchase' THEN 'protest' WHEN 'signup' THEN 'airspace_restriction' ELSE 'bomb_threat' END",
    "severity": "CAST(least(floor(value), 100) AS INT)",
    "confidence": "CAST(event_id % 101 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "domain": "concat('news.src', CAST(event_id % 8 AS STRING), '.example.com')",
    "hint": "concat(CASE user_id % 4 WHEN 0 THEN 'harbor fire' WHEN 1 THEN 'border clash' WHEN 2 THEN 'rail strike' ELSE 'power outage' END, ' sector ', CAST(user_id % 30 AS STRING), CASE WHEN event_id % 3 = 0 THEN ' update' ELSE ' zone' END)",
    "anchor": "CASE WHEN event_id % 5 < 2 THEN concat('A', CAST(user_id % 40 AS STRING)) END",
    "anchor_level": "CASE event_id % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END",
    "latitude": "CASE WHEN event_id % 7 <> 0 THEN CAST(user_id * 37 % 140 - 70 AS DOUBLE) + CAST(event_id % 10 AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "longitude": "CASE WHEN event_id % 7 <> 0 THEN CAST(user_id * 53 % 300 - 150 AS DOUBLE) + CAST(event_id % 9 AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "time_certainty": "CASE event_id % 5 WHEN 0 THEN 'same_day' WHEN 1 THEN 'previous_day' WHEN 2 THEN 'this_week' WHEN 3 THEN 'approximate' ELSE 'unknown' END",
    "deaths": "CAST(event_id % 6 AS INT)",
    "injuries": "CAST(event_id % 13 AS INT)",
    "report_kind": "CASE event_id % 6 WHEN 0 THEN 'followup' WHEN 1 THEN 'roundup' WHEN 2 THEN 'commentary' ELSE 'new_incident' END",
    "date_verified": "event_id % 4 <> 0",
    "n_corroborating": "CAST(event_id % 4 AS INT)",
    "title": "concat(CASE event_id % 9 WHEN 0 THEN 'Live updates: ' WHEN 1 THEN 'Breaking: ' WHEN 2 THEN 'Two years after ' ELSE '' END, CASE event_id % 11 WHEN 0 THEN 'Explosion' WHEN 1 THEN 'Car crash' WHEN 2 THEN 'Gas leak' WHEN 3 THEN 'Drone attack' WHEN 4 THEN 'Football riot' WHEN 5 THEN 'Airport closed' WHEN 6 THEN 'Hostage taking' WHEN 7 THEN 'Celebrity protest' WHEN 8 THEN 'Missile strike' WHEN 9 THEN 'Flight diverted by bomb' ELSE 'Council meeting' END, ' near sector ', CAST(user_id % 30 AS STRING), CASE WHEN event_id % 4 < 2 THEN concat(', ', CAST(event_id % 23 AS STRING), ' killed') ELSE '' END, CASE event_id % 3 WHEN 0 THEN ' - Daily Wire' WHEN 1 THEN ' | Gazette' ELSE '' END)",
    "url": "concat('https://www.src', CAST(event_id % 8 AS STRING), '.example.com/2024/', CASE WHEN event_id % 2 = 0 THEN concat('01/', lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0'), '/') ELSE concat('0', CAST(event_id % 9 + 1 AS STRING), '/') END, CASE WHEN event_id % 50 = 0 THEN '0123456789abcdef0123456789abcdef' ELSE concat('item-', CAST(event_id % 500 AS STRING)) END, '?ref=', CAST(event_id % 3 AS STRING))",
    "status": "CASE event_id % 7 WHEN 0 THEN 'raw' WHEN 1 THEN 'deduped' WHEN 2 THEN 'locked' WHEN 3 THEN 'classified' WHEN 4 THEN 'scored' WHEN 5 THEN 'reconciled' ELSE 'archived' END",
    "alert_tier": "CASE event_id % 10 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'ALERT' WHEN 2 THEN 'WATCH' END",
}
#: Microseconds since 1970 of occurred_at, in each engine's words.
MICROS = {"spark": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END)", "duckdb": "epoch_us(CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END)"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = read(spark, sf_dir, "events"), read(spark, sf_dir, "nation")
    cols = [F.expr(v).alias(k) for k, v in INCIDENTS.items()]
    return e.join(n, F.expr("user_id % 25 = n_nationkey")).select(*cols, F.expr(MICROS["spark"]).alias("t"))


def incidents_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in INCIDENTS.items())
    return f"incidents AS (SELECT {cols}, {MICROS['duckdb']} AS t FROM events JOIN nation ON user_id % 25 = n_nationkey)"


def dealt(df: DataFrame) -> DataFrame:
    """df, dealt out to all cores where fewer tasks than that would read it: a file of one row group is one task's, however long its texts are."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(read(spark, sf_dir, "documents")).select("doc_id", F.substring("text", 1, 80).alias("title"), F.col("text").alias("body"), "source", "lang")


ARTICLES = "articles AS (SELECT doc_id, substr(text, 1, 80) AS title, text AS body, source, lang FROM documents)"
