"""Queries over the bundled tables, each with the SQL that says the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import alerts, forecast, ingest, lifecycle, linking, reports, scoring
from ..params import ACCIDENTS, AFTERMATH, ANY_CAUSE, AVIATION_NEXUS, HOSTILE_CONTEXT, INJECTIONS, LABELS, RISK, SEVERE, Vocabulary
from .bindings import ARTICLES, AS_OF, AS_OF_MICROS, articles, incidents, incidents_sql, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOW = f"TIMESTAMP_NTZ '{AS_OF}'"
now = lambda: F.expr(NOW)
V = Vocabulary()
I = incidents_sql()  # noqa: E741
CRED = "cred(parent, score) AS (VALUES " + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in sorted(V.credibility.items())) + ")"
#: Credibility of one of the bound domains, which have two parents listed at most.
CREDIT = "coalesce((SELECT score FROM cred WHERE parent = substr(domain, 6)), (SELECT score FROM cred WHERE parent = 'example.com'), 0.6)"
H = 3_600_000_000


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c, name: str):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


def credible(df: DataFrame, spark: SparkSession) -> DataFrame:
    return scoring.credibility(df, "domain", scoring.vocabulary_table(spark), V.unknown_credibility)


def b(alternation: str) -> str:
    return f"'\\b(?:{alternation})\\b'"


# ---- text ----


_CLEAN = "regexp_replace(html, '</?[a-zA-Z][^>]*>', ' ', 'g')"
for _p in INJECTIONS:
    _CLEAN = f"regexp_replace({_CLEAN}, '(?i){_p}', '', 'g')"


@query(rf"SELECT page_id, md5(trim(regexp_replace({_CLEAN}, '[ \t\n\f\r\x0B]+', ' ', 'g'))) AS canonical_md5 FROM pages")
def canonicalize(spark, d):
    return read(spark, d, "pages").select("page_id", F.md5(text.canonical("html")).alias("canonical_md5"))


@query("SELECT page_id, sha256(regexp_replace(lower(trim(url)), '[?#].*$', '')) AS url_hash FROM pages")
def url_hash(spark, d):
    return read(spark, d, "pages").select("page_id", text.url_hash("url").alias("url_hash"))


_NORM = r"""norm AS (SELECT id, trim(regexp_replace(regexp_replace(CASE
  WHEN contains(lower(title), ' - ') AND length(trim(regexp_extract(lower(title), '(?s)^(.*) - (.*)$', 2))) <= 45 THEN trim(regexp_extract(lower(title), '(?s)^(.*) - (.*)$', 1))
  WHEN contains(lower(title), ' | ') AND length(trim(regexp_extract(lower(title), '(?s)^(.*) \| (.*)$', 2))) <= 45 THEN trim(regexp_extract(lower(title), '(?s)^(.*) \| (.*)$', 1))
  ELSE lower(title) END, '[^\p{L}\p{N}\p{M}_\s]', '', 'g'), '\s+', ' ', 'g')) AS title FROM incidents)"""


@query(f"WITH {I}, {_NORM} SELECT id, title AS norm_title FROM norm")
def norm_title(spark, d):
    return incidents(spark, d).select("id", text.norm_title("title").alias("norm_title"))


@query(rf"""WITH {I}, {_NORM}, w AS (SELECT id, list_distinct(list_filter(string_split(title, ' '), lambda x: x <> '')) AS w FROM norm)
SELECT a.id, round(CASE WHEN len(a.w) = 0 OR len(b.w) = 0 THEN 0.0 ELSE len(list_intersect(a.w, b.w)) / CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE) END, 6) AS similarity FROM w a JOIN w b ON b.id = a.id + 1""")
def title_jaccard(spark, d):
    w = incidents(spark, d).select("id", text.words(text.norm_title("title")).alias("w"))
    other = w.select((F.col("id") - 1).alias("id"), F.col("w").alias("x"))
    return w.join(other, "id").select("id", r6(text.jaccard("w", "x"), "similarity"))


@query(rf"""WITH {ARTICLES}, w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', '', 'g'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM articles)
SELECT doc_id, len(list_distinct(CASE WHEN len(w) < 4 THEN w ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS n_shingles FROM w""")
def shingles(spark, d):
    body = F.trim(F.regexp_replace(F.regexp_replace(F.lower("body"), text.NOT_WORD, ""), r"\s+", " "))
    return articles(spark, d).select("doc_id", F.size(text.shingles(body)).cast("long").alias("n_shingles"))


_CAS = rf"coalesce(list_max(list_transform(list_concat(regexp_extract_all(lower(title), '\b([0-9]{{1,6}}) (?:{V.casualties})\b', 1), regexp_extract_all(lower(title), '\b(?:{V.casualties}) ([0-9]{{1,6}})\b', 1)), lambda x: CAST(x AS INT))), 0)"
_HITS = lambda v: rf"len(list_distinct(regexp_extract_all(lower(title), '\b({v})\b', 1)))"


@query(f"WITH {I} SELECT id, CAST({_CAS} AS INT) AS casualties FROM incidents")
def casualties(spark, d):
    return incidents(spark, d).select("id", text.casualty_count("title").alias("casualties"))


@query(rf"WITH {I}, c AS (SELECT id, title, {_CAS} AS n FROM incidents) SELECT id, CAST(4 * least({_HITS(V.critical)}, 3) + least({_HITS(V.keywords)}, 5) + CASE WHEN n >= 10 THEN 5 WHEN n > 0 THEN 3 ELSE 0 END + CAST(regexp_matches(lower(title), {b(V.breaking)}) AS INT) AS INT) AS priority FROM c")
def priority_score(spark, d):
    return incidents(spark, d).select("id", text.priority("title").cast("int").alias("priority"))


_HAS = lambda v: f"regexp_matches(lower(title), {b(v)})"
_NOISE = f"CASE WHEN {_HAS(V.retrospective)} THEN true WHEN {_HAS(V.military)} AND NOT {_HAS(V.cancelling)} THEN false ELSE {_HAS(V.noise)} END"
_FLIGHT = f"({_HAS(V.aviation)} AND {_HAS(V.disruption)})"


@query(f"WITH {I} SELECT id, {_NOISE} AS noise FROM incidents")
def noise_gate(spark, d):
    return incidents(spark, d).select("id", text.is_noise("title").alias("noise"))


@query(f"WITH {I} SELECT id, {_HAS(V.keywords)} AS security FROM incidents")
def security_kw(spark, d):
    return incidents(spark, d).select("id", text.has("title", V.keywords).alias("security"))


@query(f"WITH {I} SELECT id, {_FLIGHT} AS disrupted FROM incidents")
def flight_disruption(spark, d):
    return incidents(spark, d).select("id", text.flight_disruption("title").alias("disrupted"))


@query(f"""WITH {I}, s AS (SELECT id, {_NOISE} AS noisy, {_HAS(V.high_signal)} AS high, {_CAS} > 0 AS hurt, {_FLIGHT} AND NOT {_NOISE} AS flight, {_HAS(V.keywords)} AS kw, id % 8 < 2 AS trusted FROM incidents)
SELECT id, CAST(least(100, greatest(0, CASE WHEN high THEN 45 WHEN flight OR kw THEN 25 ELSE 0 END + CASE WHEN flight THEN 20 ELSE 0 END + CASE WHEN hurt THEN 15 ELSE 0 END + CASE WHEN trusted THEN 10 ELSE 0 END - CASE WHEN noisy AND NOT high THEN 30 ELSE 0 END)) AS INT) AS score, high AS high_signal, flight, high OR flight OR kw AS security, hurt AS casualty, noisy FROM s""")
def relevance_score(spark, d):
    e = incidents(spark, d)
    got = text.relevance("title", F.col("id") % 8 < 2)
    return e.select("id", *(c.cast("int").alias(k) if k == "score" else c.alias(k) for k, c in got.items()))


@query(f"WITH {I} SELECT id, CASE WHEN status = 'raw' THEN 'deduped' WHEN status = 'deduped' AND severity < 15 THEN 'archived' ELSE status END AS status FROM incidents")
def prescreen(spark, d):
    return incidents(spark, d).select("id", lifecycle.next_status(F.col("status"), F.col("severity")).alias("status"))


_TITLE = r"trim(regexp_replace(title, '\s+[-|–—]\s+[^-|–—]*$', ''))"


def _kinds(kinds, labels=()) -> str:
    """The CASE that names the first kind whose patterns fit."""
    at = lambda k, p: f"regexp_matches({_TITLE if k in labels else 'title'}, '{p}')"
    return "CASE " + " ".join("WHEN " + " AND ".join([at(k, p) for p in need] + [f"NOT {at(k, p)}" for p in never]) + f" THEN '{k}'" for k, need, never in kinds) + " END"


#: A kind of event that says nothing about its cause, for every second incident.
_CASUALTY = "CASE WHEN id % 2 = 0 THEN 'mass_casualty_event' ELSE event_type END"
_AFTER = _kinds(AFTERMATH, LABELS)
_CAUSE_OF = lambda kind: f"CASE WHEN {kind} IN {ANY_CAUSE} AND NOT regexp_matches(title, '{AVIATION_NEXUS}') AND NOT regexp_matches(title, '{HOSTILE_CONTEXT}') THEN {_kinds(ACCIDENTS)} END"
_CAUSE = _CAUSE_OF("event_type")


@query(f"WITH {I} SELECT id, {_AFTER} AS kind FROM incidents")
def aftermath_kind(spark, d):
    return incidents(spark, d).select("id", text.aftermath("title").alias("kind"))


@query(f"WITH {I} SELECT id, {_CAUSE_OF(_CASUALTY)} AS kind FROM incidents")
def accidental_cause(spark, d):
    return incidents(spark, d).select("id", text.accidental_cause("title", F.expr(_CASUALTY)).alias("kind"))


@query(f"WITH {I} SELECT id, regexp_extract(lower(url), '^[a-z]+://(?:www\\.)?([^/?#:]+)', 1) IN ('src3.example.com') OR len(string_split(title, '|')) > 3 OR regexp_matches(url, '/[0-9a-f]{{24,}}(?:[/?#]|$)') AS farm FROM incidents")
def content_farm(spark, d):
    return incidents(spark, d).select("id", text.is_content_farm("url", "title", ("src3.example.com",)).alias("farm"))


_POST = "concat('https://www.facebook.com/page', CAST(id % 5 AS STRING), '/posts/', CAST(id AS STRING))"


@query(f"WITH {I} SELECT id, CASE WHEN id % 2 = 0 THEN CASE id % 5 WHEN 0 THEN 'zero.example' WHEN 1 THEN 'one.example' ELSE 'facebook.com' END ELSE regexp_extract(url, '^https://www\\.([^/]+)', 1) END AS publisher FROM incidents")
def social_publisher(spark, d):
    e = incidents(spark, d).select("id", F.expr(f"CASE WHEN id % 2 = 0 THEN {_POST} ELSE url END").alias("url"))
    return e.select("id", text.social_publisher("url", {"page0": "zero.example", "page1": "one.example"}).alias("publisher"))


@query(rf"""WITH l AS (SELECT doc_id, length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS n, length(regexp_replace(text, '[^\p{{Latin}}]', '', 'g')) AS k FROM documents)
SELECT doc_id, round(CASE WHEN n = 0 THEN 0.0 ELSE (n - k) / CAST(n AS DOUBLE) END, 6) AS ratio FROM l""")
def non_latin_ratio(spark, d):
    return read(spark, d, "documents").select("doc_id", r6(text.non_latin_ratio("text"), "ratio"))


_ADV = "concat('Advisory level ', CAST(id % 5 AS STRING), CASE id % 4 WHEN 0 THEN ', no change' WHEN 1 THEN ', raised' WHEN 2 THEN ', reconsider travel' ELSE '' END)"


@query(f"WITH {I}, a AS (SELECT id, greatest(CASE WHEN id % 5 > 0 THEN id % 5 ELSE 0 END, CASE WHEN id % 4 = 2 THEN 3 ELSE 0 END) AS n FROM incidents) SELECT id, CAST(n AS INT) AS level, id % 4 <> 0 AND (n >= 3 OR id % 4 = 1) AS worth FROM a")
def advisory_gate(spark, d):
    e = incidents(spark, d).select("id", F.expr(_ADV).alias("a"))
    return e.select("id", text.advisory_level("a").cast("int").alias("level"), text.advisory_worth("a").alias("worth"))


@query(r"SELECT page_id, CASE WHEN len(p) <= 2 THEN h WHEN array_to_string(p[-2:], '.') IN ('co.uk', 'com.tr', 'com.au', 'co.jp', 'gov.uk') THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain FROM (SELECT page_id, h, string_split(h, '.') AS p FROM (SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www\.', '') AS h FROM pages))")
def reg_domain(spark, d):
    return read(spark, d, "pages").select("page_id", text.registrable(text.host("url")).alias("domain"))


@query(f"WITH {I} SELECT id, CASE WHEN id % 2 = 0 THEN concat('2024-01-', lpad(CAST(id % 28 + 1 AS VARCHAR), 2, '0')) ELSE CAST(last_day(CAST(concat('2024-0', CAST(id % 9 + 1 AS VARCHAR), '-01') AS DATE)) AS VARCHAR) END AS day FROM incidents")
def url_date(spark, d):
    return incidents(spark, d).select("id", text.url_day("url").cast("string").alias("day"))


@query(None)
def page_date(spark, d):
    made = F.expr("CASE id % 4 WHEN 0 THEN concat('<script>{\"datePublished\": \"2024-01-', lpad(CAST(id % 28 + 1 AS STRING), 2, '0'), 'T10:00\"}</script>') WHEN 1 THEN '<meta property=\"article:published_time\" content=\"2024-01-09\">' WHEN 2 THEN '<time datetime=\"2024-01-11\">' ELSE '<p>' END")
    return incidents(spark, d).select("id", text.page_day(made).cast("string").alias("day"))


SQL["page_date"] = f"WITH {I} SELECT id, CASE id % 4 WHEN 0 THEN concat('2024-01-', lpad(CAST(id % 28 + 1 AS VARCHAR), 2, '0')) WHEN 1 THEN '2024-01-09' WHEN 2 THEN '2024-01-11' END AS day FROM incidents"


#: Every third time has a stale year, every third is of another season and is given up, all others are of the day before their publication.
_REPAIR = "CASE id % 3 WHEN 0 THEN published_at WHEN 2 THEN published_at - INTERVAL 1 DAY END"


@query(f"WITH {I} SELECT id, strftime({_REPAIR}, '%Y-%m-%d %H:%M:%S') AS at FROM incidents WHERE published_at <= TIMESTAMP '{AS_OF}' AND published_at - INTERVAL 1 DAY >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY")
def year_repair(spark, d):
    e = incidents(spark, d).where(f"published_at <= {NOW} and published_at - INTERVAL 1 DAY >= {NOW} - INTERVAL 30 DAYS")
    claimed = F.expr("CASE id % 3 WHEN 0 THEN published_at - make_dt_interval(datediff(to_date(published_at), add_months(to_date(published_at), -24))) WHEN 1 THEN published_at - INTERVAL 100 DAYS ELSE published_at - INTERVAL 1 DAY END")
    return e.select("id", F.date_format(text.repaired_year(claimed, F.col("published_at"), now()), "yyyy-MM-dd HH:mm:ss").alias("at"))


_PROP = "CASE WHEN event_id % 3 = 0 THEN 'high' WHEN event_id % 3 = 1 THEN props ELSE CAST(event_id % 150 AS STRING) END"


@query(f"SELECT event_id, least(100, greatest(0, coalesce(TRY_CAST({_PROP} AS INT), 0))) AS score FROM events")
def safe_cast(spark, d):
    return read(spark, d, "events").select("event_id", F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(F.expr(f"try_cast({_PROP} AS INT)"), F.lit(0)))).alias("score"))


# ---- places ----

_HAV = "2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(1 - h, 0.0)))"


@query(f"""WITH {I}, p AS (SELECT id, pow(sin(radians(48.0 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(CAST(48 AS DOUBLE))) * pow(sin(radians(2.0 - longitude) / 2), 2) AS h FROM incidents WHERE latitude IS NOT NULL)
SELECT id, round({_HAV}, 6) AS km FROM p""")
def haversine(spark, d):
    e = incidents(spark, d).where("latitude is not null")
    return e.select("id", r6(geo.haversine(F.col("latitude"), F.col("longitude"), F.lit(48.0), F.lit(2.0)), "km"))


ALIASES = {"zone": "ZZ", "harbor": "HB", "border clash sector 1 zone": "B1"}


@query(f"WITH {I} SELECT id, CASE WHEN lower(hint) = 'border clash sector 1 zone' THEN 'B1' WHEN hint LIKE 'harbor %' THEN 'HB' WHEN hint LIKE '% zone' THEN 'ZZ' ELSE upper(hint) END AS place FROM incidents")
def geo_key(spark, d):
    return incidents(spark, d).select("id", geo.geo_key(F.col("hint"), ALIASES).alias("place"))


_PLACES = {"harbor": "coast", "coast": None, "border": "inland", "inland": None, "rail": "inland"}


@query(f"WITH {I}, p AS (SELECT id, CASE WHEN hint LIKE 'harbor%' THEN 'coast' WHEN hint LIKE 'border%' OR hint LIKE 'rail%' THEN 'inland' END AS p FROM incidents) SELECT a.id, coalesce(a.p <> b.p, false) AS veto FROM p a JOIN p b ON b.id = a.id + 1")
def place_veto(spark, d):
    p = incidents(spark, d).select("id", geo.places_in(F.col("hint"), _PLACES).alias("p"))
    return p.join(p.select((F.col("id") - 1).alias("id"), F.col("p").alias("q")), "id").select("id", geo.places_disagree(F.col("p"), F.col("q")).alias("veto"))


_AIRPORTS = "airports AS (SELECT s_suppkey AS place_id, CAST(s_suppkey * 37 % 140 - 70 AS DOUBLE) AS plat, CAST(s_suppkey * 53 % 300 - 150 AS DOUBLE) AS plon, CAST(s_suppkey % 3 AS INT) AS tier FROM supplier)"


def _airports(spark, d):
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("place_id"), F.expr("CAST(s_suppkey * 37 % 140 - 70 AS DOUBLE)").alias("lat"), F.expr("CAST(s_suppkey * 53 % 300 - 150 AS DOUBLE)").alias("lon"), F.expr("CAST(s_suppkey % 3 AS INT)").alias("tier"))


@query(f"""WITH {I}, {_AIRPORTS}, x AS (SELECT id, place_id, tier, pow(sin(radians(plat - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(plat)) * pow(sin(radians(plon - longitude) / 2), 2) AS h FROM incidents, airports WHERE latitude IS NOT NULL),
y AS (SELECT id, place_id, tier, {_HAV} AS km FROM x), z AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY km, tier, place_id) AS k FROM y WHERE km <= 600)
SELECT id, place_id, round(km, 6) AS km, CAST(k AS INT) AS k FROM z WHERE k <= 3""")
def nearby_airports(spark, d):
    e = incidents(spark, d).select("id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return linking.nearby(e, _airports(spark, d), 600.0, 3).select("id", "place_id", r6("distance", "km"), "k")


_BOXES = "boxes AS (SELECT n_nationkey AS box_id, concat('N', CAST(n_nationkey AS VARCHAR)) AS box_country, CAST(n_nationkey * 6 - 80 AS DOUBLE) AS south, CAST(n_nationkey * 6 - 65 AS DOUBLE) AS north, CAST(n_nationkey * 12 - 170 AS DOUBLE) AS west, CAST(n_nationkey * 12 - 90 AS DOUBLE) AS east FROM nation)"


@query(f"""WITH {I}, {_BOXES}, z AS (SELECT id, box_id, row_number() OVER (PARTITION BY id ORDER BY CAST(country_iso <> box_country AS INT), (north - south) * (east - west), box_id) AS k FROM incidents JOIN boxes ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east)
SELECT id, box_id FROM z WHERE k = 1""")
def fir_for_point(spark, d):
    boxes = read(spark, d, "nation").select(F.col("n_nationkey").alias("box_id"), F.expr("concat('N', CAST(n_nationkey AS STRING))").alias("box_country"), *(F.expr(f"CAST({x} AS DOUBLE)").alias(k) for k, x in {"south": "n_nationkey * 6 - 80", "north": "n_nationkey * 6 - 65", "west": "n_nationkey * 12 - 170", "east": "n_nationkey * 12 - 90"}.items()))
    e = incidents(spark, d).select("id", F.col("country_iso").alias("country"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return linking.box_of(e, boxes)


@query("WITH e AS (SELECT n_nationkey AS a, (n_nationkey * 3 + 1) % 25 AS b FROM nation) SELECT DISTINCT CAST(a AS INT) AS a, CAST(b AS INT) AS b FROM (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) WHERE a <> b")
def fir_adjacency(spark, d):
    e = read(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("a"), ((F.col("n_nationkey") * 3 + 1) % 25).cast("int").alias("b"))
    return lifecycle.adjacency(e, "a", "b")


# ---- intake ----


@query(f"WITH {I}, r AS (SELECT id, row_number() OVER (PARTITION BY sha256(regexp_replace(lower(trim(url)), '[?#].*$', '')) ORDER BY ingested_at, id) AS k FROM incidents) SELECT id FROM r WHERE k = 1")
def dedup_url(spark, d):
    e = incidents(spark, d).withColumn("h", text.url_hash("url"))
    return ingest.keep_first(e, "h", F.asc("ingested_at"), F.asc("id")).select("id")


@query(f"WITH {I} SELECT id FROM incidents WHERE url NOT IN (SELECT url FROM incidents WHERE id < 300)")
def new_urls(spark, d):
    e = incidents(spark, d)
    return ingest.new_rows(e, e.where("id < 300"), "url").select("id")


_INTER = """b AS (SELECT id, domain, severity, t, CASE WHEN severity >= 60 THEN 0 ELSE 1 END AS band FROM incidents),
dd AS (SELECT *, row_number() OVER (PARTITION BY band, domain ORDER BY severity DESC, t DESC NULLS LAST, id) AS depth FROM b),
l AS (SELECT band, domain, row_number() OVER (PARTITION BY band ORDER BY severity DESC, t DESC NULLS LAST, id) AS turn FROM dd WHERE depth = 1)"""


@query(f"WITH {I}, {_INTER} SELECT id, CAST(dd.band AS INT) AS band, CAST(depth AS INT) AS depth, CAST(turn AS INT) AS turn FROM dd JOIN l ON l.band = dd.band AND l.domain = dd.domain")
def interleave(spark, d):
    e = incidents(spark, d).select("id", "domain", "severity", "t")
    return ingest.interleave(e, "domain", "severity", "t", "id", urgent=60).select("id", "band", "depth", "turn")


@query(f"WITH {I}, r AS (SELECT id, domain, severity, row_number() OVER (PARTITION BY domain ORDER BY severity DESC, id) AS k FROM incidents) SELECT id, domain FROM r WHERE k <= CASE WHEN domain = 'news.src0.example.com' THEN 4 ELSE 8 END ORDER BY severity DESC, id LIMIT 40")
def ingest_budget(spark, d):
    e = incidents(spark, d)
    return ingest.budgeted(e, "domain", [F.desc("severity"), F.asc("id")], 40, 8, {"news.src0.example.com": 4}).select("id", "domain")


@query(f"""WITH {I}, d AS (SELECT storyline, id, concat('src', CAST(id % 8 AS VARCHAR), '.example') AS domain FROM incidents), x AS (SELECT *, row_number() OVER (PARTITION BY storyline, domain ORDER BY id) AS k FROM d), o AS (SELECT storyline, arg_min(domain, id) AS own FROM d GROUP BY storyline),
y AS (SELECT x.storyline, x.domain, row_number() OVER (PARTITION BY x.storyline ORDER BY x.id) AS j FROM x JOIN o ON o.storyline = x.storyline WHERE k = 1 AND domain <> own)
SELECT storyline, count(*) AS n_sources, string_agg(domain, ',' ORDER BY j) AS domains FROM y WHERE j <= 5 GROUP BY storyline""")
def corroborate(spark, d):
    """Each publisher has two hosts."""
    e = incidents(spark, d).withColumn("domain", F.expr("concat(CASE WHEN id % 3 = 0 THEN 'news' ELSE 'www' END, '.src', id % 8, '.example')"))
    own = e.groupBy("storyline").agg(F.min_by("domain", "id").alias("own"))
    return ingest.corroborated(e.join(own, "storyline"), "storyline", "own", "domain", [F.asc("id")])


@query(rf"""WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', '', 'g'), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN w ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, count(*) AS n_links, min(b) FILTER (c = p.n AND c = q.n) AS twin FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE c / CAST(p.n + q.n - c AS DOUBLE) >= 0.4 GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(twin, doc_id)) AS class_id, coalesce(n_links, 0) AS n_links FROM documents LEFT JOIN e ON a = doc_id""")
def near_dup_shingles(spark, d):
    body = F.trim(F.regexp_replace(F.regexp_replace(F.lower("body"), text.NOT_WORD, ""), r"\s+", " "))
    return ingest.link_counts(*ingest.similar_classes(articles(spark, d), "doc_id", body, 0.4)).withColumnRenamed("id", "doc_id")


@query(None)
def duplicate_of(spark, d):
    """Incoming: the second half of incidents; the pool: the newest 2000 of the first, with their place."""
    e = incidents(spark, d).select("id", "title", F.concat_ws(" ", "title", "hint").alias("body"), F.col("hint").alias("place"), "ingested_at")
    half = e.agg(F.expr("percentile_approx(ingested_at, 0.5)").alias("half"))
    e = e.join(F.broadcast(half))  # one row
    return ingest.duplicates_of(e.where("ingested_at > half"), e.where("ingested_at <= half"), "id", [F.desc("ingested_at"), F.desc("id")], _PLACES)


@query(f"""WITH {I}, g AS (SELECT storyline, count(*) AS n, max(severity) AS top, max(occurred_at) AS last FROM incidents WHERE occurred_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY AND TIMESTAMP '{AS_OF}' GROUP BY 1 HAVING count(*) >= 2)
SELECT storyline, n, top FROM g WHERE floor(epoch(TIMESTAMP '{AS_OF}')) - floor(epoch(last)) <= CASE WHEN top >= 80 THEN 168 WHEN top >= 60 THEN 72 ELSE 36 END * 3600 ORDER BY top DESC, last DESC, storyline LIMIT 15""")
def dynamic_queries(spark, d):
    e = incidents(spark, d)
    return ingest.query_set(e, "storyline", "occurred_at", "severity", now()).select("storyline", "n", "top")


# ---- scoring ----


@query(f"WITH {I}, {CRED} SELECT id, {CREDIT} AS credibility FROM incidents")
def source_credibility(spark, d):
    return credible(incidents(spark, d), spark).select("id", "credibility")


@query(f"WITH {I} SELECT storyline, n, round(CASE WHEN n <= 1 THEN 0.3 WHEN n = 2 THEN 0.5 WHEN n = 3 THEN 0.7 ELSE least(1.0, 0.85 + 0.03 * (n - 4)) END, 6) AS diversity FROM (SELECT storyline, count(DISTINCT domain) AS n FROM incidents GROUP BY storyline)")
def diversity(spark, d):
    g = incidents(spark, d).groupBy("storyline").agg(F.countDistinct("domain").alias("n"))
    return g.select("storyline", "n", r6(scoring.diversity(F.col("n")).cast("double"), "diversity"))


_BASE = "CASE event_type WHEN 'armed_conflict' THEN 60 WHEN 'bomb_threat' THEN 70 WHEN 'protest' THEN 30 WHEN 'airspace_restriction' THEN 45 END"
_NEAR = "CASE anchor_level WHEN 'HIGH' THEN 0.9 WHEN 'MEDIUM' THEN 0.6 ELSE 0.2 END"


@query(f"""WITH {I}, a AS (SELECT id, event_type, deaths, injuries, title, coalesce({_BASE}, 20) + CASE WHEN {_NEAR} >= 0.6 THEN 30 ELSE 0 END + CASE WHEN id % 12 = 0 THEN 20 ELSE 0 END + CASE WHEN deaths >= 3 OR injuries >= 10 THEN 20 ELSE 0 END AS s, {_NEAR} >= 0.6 AS near, deaths >= 3 OR injuries >= 10 AS mass FROM incidents),
c AS (SELECT *, least(100, CASE WHEN event_type = 'armed_conflict' AND NOT near AND NOT (deaths > 0 OR injuries > 0) THEN least(s, 50) ELSE s END) AS s2 FROM a),
e AS (SELECT *, least(100, s2 + CASE WHEN {_HAS(V.aviation)} THEN 15 ELSE 0 END) AS s3 FROM c),
f AS (SELECT *, CASE WHEN event_type = 'airspace_restriction' AND id % 2 = 0 THEN least(s3, 40) ELSE s3 END AS s4 FROM e)
SELECT id, CAST(CASE WHEN event_type = 'protest' AND NOT mass THEN least(s4, 40) ELSE s4 END AS INT) AS severity FROM f""")
def severity(spark, d):
    e = incidents(spark, d)
    kind = F.col("event_type")
    s = scoring.severity(F.expr(_BASE), F.expr(_NEAR), F.col("id") % 12 == 0, F.col("deaths"), F.col("injuries"), kind == "armed_conflict", text.has("title", V.aviation), (kind == "airspace_restriction") & (F.col("id") % 2 == 0), kind == "protest")
    return e.select("id", s.cast("int").alias("severity"))


@query(f"""WITH {I}, {CRED}, n AS (SELECT storyline, count(DISTINCT domain) AS n FROM incidents GROUP BY storyline),
v AS (SELECT id, {CREDIT} AS trust, greatest(0.0, least(1.0, round(CAST(confidence * 0.4 + CAST({_NEAR} AS DOUBLE) * 0.3 + CASE WHEN n <= 1 THEN CAST(0.3 AS DOUBLE) WHEN n = 2 THEN CAST(0.5 AS DOUBLE) WHEN n = 3 THEN CAST(0.7 AS DOUBLE) ELSE least(CAST(1.0 AS DOUBLE), CAST(0.85 AS DOUBLE) + CAST(0.03 AS DOUBLE) * (n - 4)) END * 0.3 AS DOUBLE) + 1e-9, 3))) AS raw FROM incidents JOIN n USING (storyline))
SELECT id, round(raw * trust, 6) AS confidence FROM v""")
def confidence(spark, d):
    e = credible(incidents(spark, d), spark)
    n = e.groupBy("storyline").agg(F.countDistinct("domain").alias("n"))
    c = scoring.confidence(F.col("confidence"), F.expr(f"CAST({_NEAR} AS DOUBLE)"), scoring.diversity(F.col("n")).cast("double"), F.col("credibility"))
    return e.join(n, "storyline").select("id", r6(c, "confidence"))


_PEN = "SELECT source AS domain, count(*) AS total, sum(1 - quality) AS false_alarms FROM labels JOIN documents USING (doc_id) GROUP BY source"


@query(f"WITH p AS ({_PEN}) SELECT domain, total * 2 AS total, CAST(false_alarms * 2 AS BIGINT) AS false_alarms, round(false_alarms / CAST(total AS DOUBLE), 6) AS penalty FROM p")
def domain_penalty(spark, d):
    e = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", F.col("source").alias("domain")), "doc_id")
    once = scoring.domain_penalty(e, "domain", F.col("quality") == 0)
    return scoring.domain_penalty(e, "domain", F.col("quality") == 0, once).select("domain", "total", "false_alarms", r6("penalty", "penalty"))


@query(f"WITH p AS ({_PEN}) SELECT domain, total FROM p WHERE false_alarms / CAST(total AS DOUBLE) >= 0.2 AND total >= 5")
def penalized_domains(spark, d):
    e = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", F.col("source").alias("domain")), "doc_id")
    return scoring.penalized(scoring.domain_penalty(e, "domain", F.col("quality") == 0), 0.2).select("domain", "total")


@query(f"WITH {I} SELECT id, NOT coalesce(country_iso <> CASE WHEN id % 6 > 0 THEN concat('N', CAST(id % 2 + CAST(substr(country_iso, 2) AS INT) AS VARCHAR)) END, false) AS stands FROM incidents")
def anchor_veto(spark, d):
    claimed = F.expr("CASE WHEN id % 6 > 0 THEN concat('N', CAST(id % 2 + CAST(substr(country_iso, 2) AS INT) AS STRING)) END")
    return incidents(spark, d).select("id", scoring.anchor_veto(F.col("country_iso"), claimed).alias("stands"))


_RANK = lambda c: f"CASE {c} WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END"


@query(f"""WITH {I}, s AS (SELECT storyline, id AS sibling, anchor, {_RANK('anchor_level')} AS r, row_number() OVER (PARTITION BY storyline ORDER BY {_RANK('anchor_level')} DESC, confidence DESC, id) AS k FROM incidents WHERE anchor IS NOT NULL)
SELECT i.id, i.anchor_level AS from_level, s.anchor, s.sibling FROM incidents i JOIN s ON s.storyline = i.storyline AND k = 1 WHERE {_RANK('i.anchor_level')} < s.r""")
def anchor_upgrade(spark, d):
    return scoring.best_sibling(incidents(spark, d), "storyline", "id", "anchor", "confidence", "anchor_level")


@query(f"""WITH {I}, r AS (SELECT event_type, severity, least(90, CASE WHEN severity <= 60 THEN severity ELSE CAST(round_even(60 + (severity - 60) * 0.5, 0) AS INT) END) AS s FROM incidents)
SELECT event_type, count(*) AS n, CAST(sum(CAST(severity >= 65 AS INT)) AS BIGINT) AS before_alert, CAST(sum(CAST(s >= 65 AS INT)) AS BIGINT) AS after_alert, CAST(sum(severity - s) AS BIGINT) AS lowered FROM r GROUP BY event_type""")
def severity_replay(spark, d):
    e = incidents(spark, d).withColumn("s", scoring.rescaled(F.col("severity")))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum((F.col("severity") >= 65).cast("long")).alias("before_alert"), F.sum((F.col("s") >= 65).cast("long")).alias("after_alert"), F.sum((F.col("severity") - F.col("s")).cast("long")).alias("lowered"))


# ---- alerts ----

_LAD = lambda c, more: f"greatest(CASE WHEN sev >= 80 AND confidence >= 0.62 AND located AND {c} IN ('same_day','previous_day') THEN 3 WHEN sev >= 65 AND confidence >= 0.5 AND (located OR {c} IN ('same_day','previous_day')) THEN 2 WHEN sev >= 45 AND confidence >= 0.4 AND {c} IN ('same_day','previous_day') THEN 1 ELSE 0 END, CASE WHEN {c} IN ('same_day','previous_day') AND (sev >= 90 OR ({more} >= 2 AND sev >= 45)) THEN 2 ELSE 0 END)"


@query(f"""WITH {I}, a AS (SELECT *, severity AS sev, coalesce(anchor <> '', false) OR latitude IS NOT NULL AS located, NOT date_verified AND time_certainty IN ('same_day','previous_day') AS unv FROM incidents),
c AS (SELECT *, CASE WHEN unv THEN 'unknown' ELSE time_certainty END AS kn FROM a),
f AS (SELECT *, CASE WHEN kn = 'unknown' AND date_verified AND published_at >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY THEN 'previous_day' ELSE kn END AS ce FROM c),
g AS (SELECT *, {_LAD('ce', 'n_corroborating')} AS n, {_LAD('time_certainty', '0')} AS would, {_AFTER} AS am, {_CAUSE} AS ca FROM f),
v AS (SELECT id, n, CASE WHEN n = 0 AND unv AND would > 0 THEN 'date_unverified' WHEN n IN (1, 2) AND am IS NOT NULL THEN 'aftermath_title' WHEN n IN (1, 2) AND report_kind IN ('followup','roundup','commentary') THEN concat('report_kind_', report_kind) WHEN n > 0 AND ca IS NOT NULL THEN concat('accidental_', ca) END AS veto FROM g)
SELECT id, CASE WHEN veto IS NULL THEN CASE n WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WATCH' END END AS tier, veto FROM v""")
def alert_tier(spark, d):
    return alerts.tiers(incidents(spark, d), now()).select("id", "tier", "veto")


@query(f"WITH {I} SELECT id, concat_ws('|', storyline, coalesce(anchor, 'UNKNOWN')) AS key, CASE WHEN coalesce(anchor, nullif(hint, '')) IS NOT NULL THEN concat_ws('|', 'geofp', country_iso, coalesce(anchor, hint)) END AS geo FROM incidents")
def suppression_keys(spark, d):
    a, g = alerts.suppression_keys(F.col("storyline"), F.col("id").cast("string"), F.col("anchor"), F.col("country_iso"), F.col("hint"))
    return incidents(spark, d).select("id", a.alias("key"), g.alias("geo"))


@query(None)
def suppression(spark, d):
    e = incidents(spark, d).where("t is not null").withColumn("r", alerts.rank(F.col("alert_tier")))
    return alerts.suppressed(e, "country", "id", "t", "r")


@query(None)
def two_key_claims(spark, d):
    """Every seventh delivery fails."""
    key, geo = alerts.suppression_keys(F.col("storyline"), F.col("id").cast("string"), F.col("anchor"), F.col("country_iso"), F.col("hint"))
    return alerts.two_key_claims(incidents(spark, d).select("id", "t", alerts.rank(F.col("alert_tier")).alias("rank"), key.alias("key"), geo.alias("geo"), (F.col("id") % 7 != 0).alias("sent")))


@query(f"WITH {I} SELECT id, ingested_at - INTERVAL 10 DAY >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AS fresh FROM incidents")
def alert_freshness(spark, d):
    return incidents(spark, d).select("id", alerts.fresh_enough(F.col("ingested_at") - F.expr("INTERVAL 10 DAYS"), now()).alias("fresh"))


@query(f"""WITH {I}, r AS (SELECT id, storyline, t, CASE alert_tier WHEN 'CRITICAL' THEN 3 WHEN 'ALERT' THEN 2 WHEN 'WATCH' THEN 1 ELSE 0 END AS r FROM incidents WHERE t IS NOT NULL)
SELECT id, max(r) OVER w AS peak, coalesce(r > max(r) OVER (PARTITION BY storyline ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS escalated FROM r WHERE r > 0 WINDOW w AS (PARTITION BY storyline ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def escalation(spark, d):
    e = incidents(spark, d).where("t is not null").select("id", "storyline", "t", "alert_tier")
    return alerts.escalations(e, "storyline", [F.asc("t"), F.asc("id")], alerts.rank(F.col("alert_tier"))).select("id", "peak", "escalated")


@query(f"""WITH {I}, a AS (SELECT storyline, t, CASE WHEN t - lag(t) OVER (PARTITION BY storyline ORDER BY t) >= {12 * H} THEN 1 ELSE 0 END AS new FROM incidents WHERE t IS NOT NULL AND alert_tier IS NOT NULL),
b AS (SELECT storyline, t, sum(new) OVER (PARTITION BY storyline ORDER BY t) AS s FROM a) SELECT storyline, min(t) AS opened, max(t) + {12 * H} AS closed, count(*) AS pages FROM b GROUP BY storyline, s""")
def quiet_sessions(spark, d):
    return alerts.quiet_closures(incidents(spark, d).where("alert_tier is not null"), "storyline", "t")


@query(f"""WITH {I}, c AS (SELECT storyline, CASE alert_tier WHEN 'CRITICAL' THEN 3 WHEN 'ALERT' THEN 2 ELSE 1 END AS r, t + {4 * H} AS x FROM incidents WHERE alert_tier IS NOT NULL AND t IS NOT NULL)
SELECT storyline, CAST(max(r) AS INT) AS tier_rank, max(x) AS expires FROM c WHERE x > {AS_OF_MICROS - 24 * H} GROUP BY storyline ORDER BY expires DESC, storyline LIMIT 6""")
def recent_paged(spark, d):
    e = incidents(spark, d).where("alert_tier is not null and t is not null")
    claims = e.select("id", (F.col("t") + 4 * H).alias("expires"))
    return alerts.recent_paged(claims, e.select("id", "storyline", alerts.rank(F.col("alert_tier")).alias("tier_rank")), AS_OF_MICROS - 24 * H).select("storyline", F.col("tier_rank").cast("int").alias("tier_rank"), "expires")


@query(f"""WITH {I} SELECT id, count(*) OVER (PARTITION BY country ORDER BY t RANGE BETWEEN {24 * H} PRECEDING AND CURRENT ROW) - 1 AS others FROM incidents WHERE t IS NOT NULL""")
def new_activity(spark, d):
    e = incidents(spark, d).select("id", "country", "t")
    return forecast.within_reach(e, "country", "t", 24 * H, F.lit(1), "n").select("id", (F.col("n") - 1).alias("others"))


# ---- storylines ----

_TOK = r"""tok AS (SELECT *, list_filter(string_split(hint, ' '), lambda x: x NOT IN ('the','a','an','at','in','on','of','to','and','or','near','update') AND x <> '') AS w FROM incidents),
tk AS (SELECT *, list_distinct(w) AS u, list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS s FROM tok)"""


@query(f"WITH {I}, {_TOK} SELECT id, len(s) AS n_tokens, array_to_string(list_sort(s), ',') AS tokens FROM tk")
def hint_tokens(spark, d):
    e = linking.with_tokens(incidents(spark, d), "hint")
    return e.select("id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join(F.array_sort("tokens"), ",").alias("tokens"))


@query(f"WITH {I}, {_TOK} SELECT a.id, round(len(list_intersect(a.u, b.u)) / CAST(least(len(a.u), len(b.u)) AS DOUBLE), 6) AS containment FROM tk a JOIN tk b ON b.id = a.id + 1")
def containment(spark, d):
    e = linking.with_tokens(incidents(spark, d), "hint").select("id", "unigrams")
    return e.join(e.select((F.col("id") - 1).alias("id"), F.col("unigrams").alias("v")), "id").select("id", r6(text.containment("unigrams", "v"), "containment"))


@query(f"WITH {I}, {_TOK} SELECT token, count(DISTINCT storyline) AS storylines FROM (SELECT storyline, unnest(u) AS token FROM tk) GROUP BY token HAVING count(DISTINCT storyline) >= 3")
def overexposed_tokens(spark, d):
    return linking.common_tokens(linking.with_tokens(incidents(spark, d), "hint"), "storyline")


def _newest(spark, d):
    """The newest event of each storyline."""
    e = incidents(spark, d).where("t is not null")
    return scoring.latest_per(e, "storyline", F.desc("t"), F.desc("id"))


@query(f"WITH {I}, r AS (SELECT id, storyline, row_number() OVER (PARTITION BY storyline ORDER BY t DESC, id DESC) AS k FROM incidents WHERE t >= {AS_OF_MICROS - 14 * 24 * H}) SELECT id, storyline FROM r WHERE k = 1")
def linking_pool(spark, d):
    e = incidents(spark, d).where(F.col("t") >= AS_OF_MICROS - 14 * 24 * H)
    return scoring.latest_per(e, "storyline", F.desc("t"), F.desc("id")).select("id", "storyline")


#: A country that every thirteenth row lacks, and a place that every third has.
_LAND = "CASE WHEN id % 13 <> 0 THEN country_iso END"
_SPOT = "CASE WHEN id % 3 = 0 THEN concat('P', CAST(CAST(substr(storyline, 3) AS INT) % 17 AS STRING)) END"
_PAIRS = f"""nw AS (SELECT *, {_LAND} AS land, {_SPOT} AS spot, row_number() OVER (PARTITION BY storyline ORDER BY t DESC, id DESC) AS k FROM tk WHERE t IS NOT NULL),
p AS (SELECT a.id AS a_id, b.id AS b_id, abs(a.t - b.t) AS gap, a.anchor = b.anchor AS same, a.spot = b.spot AS near, len(list_intersect(a.s, b.s)) / CAST(len(list_distinct(list_concat(a.s, b.s))) AS DOUBLE) AS sim, list_intersect(a.u, b.u) AS sh, len(list_intersect(a.u, b.u)) / CAST(least(len(a.u), len(b.u)) AS DOUBLE) AS con
  FROM nw a JOIN nw b ON coalesce(a.land = b.land, true) AND a.id < b.id WHERE a.k = 1 AND b.k = 1),
lk AS (SELECT a_id, b_id, sim FROM p WHERE gap <= {14 * 24 * H} AND ((sim > 0.4 AND len(list_filter(sh, lambda x: x <> 'sector')) > 0) OR (gap <= {72 * H} AND len(sh) >= 2 AND len(list_filter(sh, lambda x: x <> 'sector')) >= 1 AND con >= 0.5) OR (coalesce(same, false) AND (gap <= {72 * H} OR sim >= 0.2)) OR (NOT coalesce(same, false) AND coalesce(near, false) AND sim >= 0.2)))"""


def _located(spark, d):
    """The newest event of each storyline with its words, land and spot."""
    return linking.with_tokens(_newest(spark, d).withColumn("country", F.expr(_LAND)), "hint").withColumn("place", F.expr(_SPOT))


@query(f"WITH {I}, {_TOK}, {_PAIRS} SELECT a_id, b_id, round(sim, 6) AS similarity FROM lk")
def storyline_pairs(spark, d):
    return linking.linked_pairs(_located(spark, d), "id").select("a_id", "b_id", r6("similarity", "similarity"))


@query(f"WITH {I}, {_TOK}, {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY b_id ORDER BY sim DESC, a_id) AS j FROM lk) SELECT b_id, a_id FROM r WHERE j = 1")
def storyline_best(spark, d):
    return linking.best_match(linking.linked_pairs(_located(spark, d), "id")).select("b_id", "a_id")


@query(None)
def storyline_assign(spark, d):
    return linking.assign_in_order(linking.with_tokens(incidents(spark, d), "hint"), "country")


@query(None)
def exact_merge(spark, d):
    return linking.anchored_runs(incidents(spark, d), ["hint", "country", "anchor"], "t", "id", "severity")


@query(None)
def centrist_clusters(spark, d):
    return linking.centrist_clusters(linking.with_tokens(incidents(spark, d), "hint"), "country")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS seq FROM conversations")
def timeline(spark, d):
    return linking.timeline(read(spark, d, "conversations"), "conv_id", F.asc_nulls_first("turn")).select("conv_id", "turn", F.col("seq").cast("long").alias("seq"))


@query(f"WITH {I}, r AS (SELECT id, row_number() OVER (PARTITION BY storyline ORDER BY t NULLS FIRST, id) AS seq, count(*) OVER (PARTITION BY storyline) AS n FROM incidents) SELECT id, seq FROM r WHERE n <= 60 OR seq <= 5 OR seq > n - 55")
def head_tail(spark, d):
    return linking.head_tail(incidents(spark, d), "storyline", [F.asc_nulls_first("t"), F.asc("id")]).select("id", F.col("seq").cast("long").alias("seq"))


@query(f"""WITH {I}, r AS (SELECT storyline, severity, row_number() OVER (PARTITION BY storyline ORDER BY t NULLS FIRST, id) > floor(count(*) OVER (PARTITION BY storyline) / 2.0) AS late FROM incidents),
g AS (SELECT storyline, avg(severity) FILTER (late) AS b, avg(severity) FILTER (NOT late) AS a FROM r GROUP BY storyline) SELECT storyline, CASE WHEN b - coalesce(a, b) > 5 THEN 'rising' WHEN b - coalesce(a, b) < -5 THEN 'falling' ELSE 'steady' END AS trend FROM g""")
def severity_trend(spark, d):
    return linking.severity_trend(incidents(spark, d), "storyline", [F.asc_nulls_first("t"), F.asc("id")], "severity")


@query(f"WITH {I} SELECT storyline, count(*) AS n_events, count(DISTINCT domain) AS n_sources, round((max(t) - min(t)) / CAST({H} AS DOUBLE), 1) AS span_hours, max(severity) AS peak, CAST(sum(CAST(severity >= 80 AS INT)) AS BIGINT) AS severe FROM incidents GROUP BY storyline")
def storyline_summary(spark, d):
    return linking.summaries(incidents(spark, d), "storyline", "t", "severity", "domain")


# ---- weekly ----

_TI = f"""e AS (SELECT country, event_type, hint, CAST(least(greatest(severity, 0), 100) AS DOUBLE) AS sev, t, max(t) OVER (PARTITION BY country) AS newest, {CREDIT} AS cr FROM incidents),
g AS (SELECT country, count(*) AS n, avg(sev) AS s_avg, max(sev) AS s_max, sum(w * sev) / sum(w) AS r, 100 * avg(cr) AS q, max(CAST(contains(event_type, 'cyber') AS INT)) + max(CAST(event_type = 'airspace_restriction' AS INT)) + max(CAST(event_type NOT IN ('cyber_infrastructure', 'airspace_restriction') AS INT)) AS dm
  FROM (SELECT *, pow(2.0, -coalesce((newest - t) / 3600000000.0, 72.0) / 24.0) AS w FROM e) GROUP BY country),
c AS (SELECT *, 100.0 * n / max(n) OVER () AS v, CASE dm WHEN 3 THEN 100.0 WHEN 2 THEN 50.0 ELSE 0.0 END AS x, CASE WHEN s_max >= 80 AND dm >= 2 THEN 100.0 ELSE 0.0 END AS c FROM g),
st AS (SELECT *, (0.15 * v + 0.20 * s_avg + 0.15 * s_max + 0.10 * r + 0.05 * q + 0.05 * x + 0.05 * c) / 0.85 AS static FROM c)"""


@query(f"WITH {I}, {CRED}, {_TI} SELECT country, n, round(v, 6) AS v, round(s_avg, 6) AS s_avg, s_max, round(r, 6) AS r, round(q, 6) AS q, CAST(x AS DOUBLE) AS x, CAST(c AS DOUBLE) AS c, round(least(100.0, greatest(0.0, static * 0.85)), 6) AS ti FROM st")
def tension_components(spark, d):
    g = forecast.tension(credible(incidents(spark, d), spark), "country")
    return g.select("country", "n", r6("v", "v"), r6("s_avg", "s_avg"), "s_max", r6("r", "r"), r6("q", "q"), "x", "c", r6("ti", "ti"))


@query(None)
def tension_index(spark, d):
    e = credible(incidents(spark, d), spark)
    k = linking.centrist_clusters(linking.with_tokens(e, "hint"), "country").join(e.select("id", "country"), "id").groupBy("country").agg(F.countDistinct("cluster").alias("cluster_count"))
    prev = e.groupBy("country").agg((F.avg("severity") / 2).alias("prev_ti"))
    g = forecast.tension(e, "country", clusters=k, previous=prev)
    return g.select("country", "cluster_count", r6("d", "d"), r6("delta", "delta"), r6("ti", "ti"))


_WEEK = "w AS (SELECT country, CAST(floor(t / 604800000000) AS BIGINT) AS week, avg(severity) AS value FROM incidents WHERE t IS NOT NULL GROUP BY 1, 2)"


def _weekly(spark, d):
    e = incidents(spark, d).where("t is not null").withColumn("week", F.floor(F.col("t") / 604_800_000_000).cast("long"))
    return forecast.z_scores(e.groupBy("country", "week").agg(F.avg("severity").alias("value")), "country", "week", "value")


_Z = f"""{_WEEK}, h AS (SELECT *, count(*) OVER x AS n, avg(value) OVER x AS m, greatest(stddev_pop(value) OVER x, 1.0) AS dv FROM w WINDOW x AS (PARTITION BY country ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN n >= 2 THEN (value - m) / dv ELSE 0.0 END AS z, value - coalesce(m, value) AS delta FROM h)"""


@query(f"WITH {I}, {_Z} SELECT country, week, round(z, 6) AS z, CASE WHEN delta > 8 AND z > 1 THEN 'escalating' WHEN delta < -8 THEN 'easing' ELSE 'stable' END AS trajectory FROM z")
def ti_zscore(spark, d):
    return _weekly(spark, d).select("country", "week", r6("z", "z"), "trajectory")


@query(f"WITH {I}, {CRED}, g AS (SELECT country, avg(severity) AS ti, avg(severity) - 20 AS delta, (avg(severity) - 20) / 5 AS z, 1 + count(*) % 5 AS k, bool_or(severity >= 60 AND {CREDIT} >= 0.8) AS sc FROM incidents GROUP BY country) SELECT country, CASE WHEN ti <= 50 AND delta > 0 AND z > 0.5 THEN 'watchlist' WHEN k BETWEEN 1 AND 3 AND sc THEN 'emerging' END AS list FROM g")
def watchlist(spark, d):
    e = credible(incidents(spark, d), spark)
    g = e.groupBy("country").agg(F.avg("severity").alias("ti"), (F.avg("severity") - 20).alias("delta"), ((F.avg("severity") - 20) / 5).alias("z"), (1 + F.count("*") % 5).alias("cluster_count"), F.bool_or((F.col("severity") >= 60) & (F.col("credibility") >= 0.8)).alias("severe_credible"))
    return g.select("country", forecast.watch(g).alias("list"))


_HAV2 = "pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)"
_MEET = f"""m AS (SELECT a.id, a.country, a.t, count(DISTINCT b.event_type) AS types FROM incidents a JOIN incidents b ON a.country = b.country AND b.t BETWEEN a.t AND a.t + {6 * H}
  WHERE coalesce(a.anchor = b.anchor, false) OR coalesce(2 * 6371.0 * atan2(sqrt({_HAV2}), sqrt(greatest(1 - ({_HAV2}), 0.0))) <= 50, false) GROUP BY 1, 2, 3 HAVING count(DISTINCT b.event_type) >= 2)"""


def _meeting(spark, d):
    e = incidents(spark, d).select("id", "t", "country", "event_type", "anchor", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return linking.co_located(e)


@query(f"WITH {I}, {_MEET} SELECT id, types FROM m")
def flash_convergence(spark, d):
    return _meeting(spark, d)


_VER = f"v AS (SELECT id, country, t, sum(CAST({CREDIT} >= 0.8 OR confidence >= 0.66 AS INT)) OVER (PARTITION BY country ORDER BY t RANGE BETWEEN CURRENT ROW AND {6 * H} FOLLOWING) AS n FROM incidents WHERE t IS NOT NULL)"


@query(f"WITH {I}, {CRED}, {_VER} SELECT id, CAST(n AS BIGINT) AS verified FROM v WHERE n >= 3")
def flash_verified(spark, d):
    return forecast.flash_verified(credible(incidents(spark, d), spark))


@query(f"""WITH {I}, {CRED}, {_VER}, {_MEET}, {_Z}, hi AS (SELECT country, max(z) AS z FROM z GROUP BY country), s AS (SELECT country, id, t, 0 AS k FROM m UNION ALL SELECT country, id, t, 1 FROM v WHERE n >= 3),
f AS (SELECT country, id, k, row_number() OVER (PARTITION BY country ORDER BY t, id, k) AS j FROM s WHERE country NOT IN (SELECT country FROM hi WHERE z > 1.2)),
o AS (SELECT country, 'z_score' AS trigger, NULL AS id, 0 AS r FROM hi WHERE z > 1.2 UNION ALL SELECT country, CASE k WHEN 0 THEN 'convergence' ELSE 'verified' END, id, 1 FROM f WHERE j = 1)
SELECT country, trigger, CAST(id AS BIGINT) AS id FROM o ORDER BY r, country LIMIT 5""")
def flash_triggers(spark, d):
    e = credible(incidents(spark, d), spark)
    z = _weekly(spark, d).groupBy("country").agg(F.max("z").alias("z"))
    at = e.select("id", "country", "t")
    return forecast.flash_triggers(z, _meeting(spark, d).join(at, "id"), forecast.flash_verified(e).join(at, "id"), top=1.2)


_FC = "fc AS (SELECT week AS report, country, delta, z, CASE WHEN hash1 = 0 THEN 'Escalating' WHEN hash1 = 1 THEN 'De-escalating' ELSE 'Stable' END AS predicted, CASE WHEN hash1 = 2 THEN 'HIGH' WHEN hash1 = 1 THEN 'LOW' ELSE 'MEDIUM' END AS confidence_label, hash1 < 2 AS flagged FROM (SELECT *, CAST(substr(country, 8) AS BIGINT) % 3 AS hash1 FROM z))"
_GR = f"{_FC}, gr AS (SELECT *, CASE WHEN delta > 8 AND z > 1 THEN 'Escalating' WHEN delta < -8 THEN 'De-escalating' ELSE 'Stable' END AS actual FROM fc), gh AS (SELECT *, CAST(predicted = actual AS INT) AS hit, CAST(actual = 'Escalating' AS INT) AS up, CAST(flagged AS INT) AS called, CASE confidence_label WHEN 'HIGH' THEN 0.9 WHEN 'LOW' THEN 0.5 ELSE 0.7 END AS p FROM gr)"


def _forecasts(spark, d):
    z = _weekly(spark, d)
    w = Window.partitionBy("country").orderBy("week").rowsBetween(-8, -1)
    z = z.withColumn("delta", F.col("value") - F.coalesce(F.avg("value").over(w), F.col("value"))).withColumn("k", F.substring("country", 8, 9).cast("long") % 3)
    k = F.col("k")
    return z.select(F.col("week").alias("report"), "country", "delta", "z", F.when(k == 0, "Escalating").when(k == 1, "De-escalating").otherwise("Stable").alias("predicted"), F.when(k == 2, "HIGH").when(k == 1, "LOW").otherwise("MEDIUM").alias("confidence_label"), (k < 2).alias("flagged"))


@query(f"WITH {I}, {_Z}, {_GR} SELECT report, round(avg(hit), 6) AS accuracy, round(avg(pow(p - hit, 2)), 6) AS brier, round(sum(up * called) / CAST(nullif(sum(up), 0) AS DOUBLE), 6) AS recall, round(sum((1 - up) * called) / CAST(nullif(sum(called), 0) AS DOUBLE), 6) AS false_alarm_rate FROM gh GROUP BY report")
def forecast_grading(spark, d):
    g = forecast.grades(_forecasts(spark, d))
    return g.select("report", *(r6(c, c) for c in ("accuracy", "brier", "recall", "false_alarm_rate")))


@query(f"WITH {I}, {_Z}, {_GR} SELECT country, count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, CAST(sum(CAST(predicted = 'Escalating' AND hit = 0 AS INT)) AS BIGINT) AS \"over\", CAST(sum(CAST(predicted = 'De-escalating' AND hit = 0 AS INT)) AS BIGINT) AS \"under\" FROM gh WHERE report IN (SELECT DISTINCT report FROM gh ORDER BY report DESC LIMIT 4) GROUP BY country")
def calibration(spark, d):
    f = _forecasts(spark, d)
    actual = F.when((F.col("delta") > 8) & (F.col("z") > 1), "Escalating").when(F.col("delta") < -8, "De-escalating").otherwise("Stable")
    return forecast.calibration(f.withColumn("hit", (F.col("predicted") == actual).cast("int")))


# ---- daily ----


@query(f"WITH {I} SELECT id FROM incidents WHERE least(coalesce(occurred_at, published_at, ingested_at), TIMESTAMP '{AS_OF}') >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR AND least(coalesce(occurred_at, published_at, ingested_at), TIMESTAMP '{AS_OF}') < TIMESTAMP '{AS_OF}'")
def event_window(spark, d):
    return reports.in_window(incidents(spark, d), now(), 48).select("id")


_SCORED = "status IN ('scored', 'reconciled', 'archived')"


@query(f"""WITH {I}, g AS (SELECT country_iso, count(*) AS n, max(severity) AS top, count(*) FILTER (status <> 'archived' AND {_FLIGHT}) AS matching FROM incidents WHERE {_SCORED} AND country_iso IS NOT NULL AND severity IS NOT NULL GROUP BY country_iso)
SELECT country_iso, n, top, matching FROM g WHERE n >= 3 OR top >= 80 OR matching >= 1 ORDER BY (top >= 80 OR matching >= 1) DESC, n DESC, country_iso LIMIT 5""")
def country_selection(spark, d):
    disrupted = (F.col("status") != "archived") & text.flight_disruption("title")
    return reports.country_selection(incidents(spark, d).where(_SCORED), "country_iso", "severity", disrupted).select("country_iso", "n", "top", "matching")


_DOM = "CASE WHEN id % 9 = 0 THEN 'news.gov.example' WHEN id % 9 = 1 THEN 'state.example' ELSE domain END"


@query(f"WITH {I} SELECT id, id % 9 = 0 OR (id % 9 = 1 AND country_iso = 'N3') AS official FROM incidents")
def official_domain(spark, d):
    return incidents(spark, d).select("id", reports.official(F.expr(_DOM), state_media={"state.example": "N3"}, country=F.col("country_iso")).alias("official"))


_SOLE = "CASE WHEN CAST(substr(storyline, 3) AS INT) % 3 = 0 THEN 'news.src3.example.com' ELSE domain END"


@query(f"""WITH {I}, s AS (SELECT storyline, {_DOM.replace('domain END', _SOLE + ' END')} AS domain FROM incidents), g AS (SELECT storyline, max(CAST(domain = 'news.gov.example' AND CAST(substr(storyline, 3) AS INT) % 2 = 0 AS INT)) AS o,
  count(DISTINCT CASE WHEN domain <> 'news.src3.example.com' AND NOT (domain = 'news.gov.example' AND CAST(substr(storyline, 3) AS INT) % 2 = 1) THEN regexp_extract(domain, '([^.]+[.][^.]+)$', 1) END) AS n FROM s GROUP BY storyline)
SELECT storyline, n AS n_independent, CASE WHEN o = 1 THEN 'official' WHEN n >= 2 THEN 'corroborated' ELSE 'single' END AS label FROM g""")
def verification_label(spark, d):
    e = incidents(spark, d).withColumn("domain", F.expr(_SOLE)).withColumn("domain", F.expr(_DOM))
    penalized = (F.col("domain") == "news.src3.example.com") | ((F.col("domain") == "news.gov.example") & (F.substring("storyline", 3, 9).cast("int") % 2 == 1))
    return reports.verification(e, "storyline", "domain", reports.official(F.col("domain")), penalized)


_PL = "CASE WHEN id % 4 = 0 THEN country_iso ELSE concat('sector ', CAST(CAST(substr(storyline, 3) AS INT) % 30 AS STRING)) END"


@query(f"""WITH {I}, p AS (SELECT id, storyline, title, id % 4 = 0 AS cl, {_PL} AS place FROM incidents), l AS (SELECT storyline, place, count(*) AS n FROM p WHERE NOT cl GROUP BY 1, 2),
m AS (SELECT storyline, place AS main, row_number() OVER (PARTITION BY storyline ORDER BY n DESC, place DESC) AS k FROM l)
SELECT id, CASE WHEN cl AND coalesce(contains(lower(title), lower(main)), false) THEN main ELSE place END AS place_of FROM p LEFT JOIN m ON m.storyline = p.storyline AND k = 1""")
def absorb(spark, d):
    e = incidents(spark, d).withColumn("place", F.expr(_PL))
    return reports.absorbed(e, "storyline", "place", F.col("id") % 4 == 0, "title").select("id", "place_of")


_CL = f"""r AS (SELECT *, row_number() OVER (PARTITION BY storyline, event_type ORDER BY deaths DESC, injuries DESC, t DESC NULLS LAST, id) AS k FROM incidents),
dm AS (SELECT storyline, event_type, domain, row_number() OVER (PARTITION BY storyline, event_type ORDER BY min(k)) AS j FROM r GROUP BY 1, 2, 3),
ds AS (SELECT storyline, event_type, string_agg(domain, ',' ORDER BY j) FILTER (j <= 5) AS sources, count(*) AS n_sources FROM dm GROUP BY 1, 2),
cl AS (SELECT storyline, event_type, max(id) FILTER (k = 1) AS representative, count(*) AS members, max(severity) AS severity, max(deaths) AS deaths FROM r GROUP BY 1, 2)"""


def _clusters(spark, d):
    return reports.clusters(incidents(spark, d), ["storyline", "event_type"], "id", [F.desc("deaths"), F.desc("injuries"), F.desc_nulls_last("t"), F.asc("id")], "domain", "severity", "deaths")


@query(f"WITH {I}, {_CL} SELECT storyline, event_type, representative, members, severity, deaths, sources, n_sources FROM cl JOIN ds USING (storyline, event_type)")
def sitrep_clusters(spark, d):
    return _clusters(spark, d)


@query(f"WITH {I}, {_CL} SELECT storyline, event_type, representative FROM cl JOIN ds USING (storyline, event_type) ORDER BY severity DESC, deaths DESC, members DESC, n_sources DESC, representative LIMIT 18")
def cluster_rank(spark, d):
    return reports.ranked(_clusters(spark, d), 18).select("storyline", "event_type", "representative")


@query(f"WITH {I} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY storyline, event_type ORDER BY deaths DESC, injuries DESC, t DESC NULLS LAST, id) AS k FROM incidents) WHERE k = 1")
def cluster_rep(spark, d):
    e = incidents(spark, d).withColumn("c", F.concat_ws("|", "storyline", "event_type"))
    return scoring.latest_per(e, "c", F.desc("deaths"), F.desc("injuries"), F.desc_nulls_last("t"), F.asc("id")).select("id")


@query(f"WITH {I}, t(term, about) AS (VALUES ('harbor', 'N1'), ('airport', 'N2'), ('drone', 'N3')) SELECT DISTINCT id, about FROM incidents JOIN t ON list_contains(regexp_split_to_array(lower(title), '[^a-z0-9_]+'), term) AND country_iso IS DISTINCT FROM about")
def spillover(spark, d):
    terms = spark.createDataFrame([("harbor", "N1"), ("airport", "N2"), ("drone", "N3")], "term string, about string")
    return reports.spillover(incidents(spark, d), terms, "id", "country_iso", "title")


@query(f"""WITH {I}, g AS (SELECT country, event_type, count(*) FILTER (severity >= {SEVERE} AND n_corroborating >= 2) AS c, max(severity) AS m, count(DISTINCT storyline) AS n FROM incidents GROUP BY country, event_type)
SELECT country, event_type, CASE WHEN c >= 3 OR (c >= 2 AND n >= 10) THEN '{RISK[0]}' WHEN c >= 1 OR m >= {SEVERE} THEN '{RISK[1]}' WHEN m >= 64 OR (m >= 60 AND n >= 5) THEN '{RISK[2]}' ELSE '{RISK[3]}' END AS level FROM g""")
def risk_level(spark, d):
    g = incidents(spark, d).groupBy("country", "event_type").agg(F.count_if((F.col("severity") >= SEVERE) & (F.col("n_corroborating") >= 2)).alias("c"), F.max("severity").alias("m"), F.countDistinct("storyline").alias("n"))
    return g.select("country", "event_type", reports.risk_level(F.col("c"), F.col("m"), F.col("n")).alias("level"))


@query(f"WITH {I} SELECT id, CASE lower(concat('Sector ', CAST(id % 20 AS VARCHAR))) WHEN 'sector 1' THEN 'first' ELSE concat('sector ', CAST(id % 20 AS VARCHAR)) END AS place FROM incidents")
def location_key(spark, d):
    name = F.expr("concat('Sector ', CAST(id % 20 AS STRING), CASE id % 3 WHEN 0 THEN ' City' WHEN 1 THEN ' Province, Region' ELSE '' END)")
    return incidents(spark, d).select("id", text.location_key(name, {"sector 1": "first"}).alias("place"))


# ---- life cycle ----


@query(f"WITH {I} SELECT id FROM incidents WHERE ingested_at < TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR AND status = 'deduped'")
def matured(spark, d):
    return lifecycle.matured(incidents(spark, d).where("status = 'deduped'"), "ingested_at", now()).select("id")


@query(f"WITH {I} SELECT id FROM incidents WHERE published_at >= ingested_at - INTERVAL 2 DAY AND occurred_at >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")
def late_drop(spark, d):
    e = incidents(spark, d)
    return e.where(F.col("published_at") >= F.col("ingested_at") - F.expr("INTERVAL 2 DAYS")).where(F.col("occurred_at") >= now() - F.expr("INTERVAL 10 DAYS")).select("id")


_CUT = f"TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"


@query(f"WITH {I} SELECT id FROM incidents WHERE (occurred_at < {_CUT} AND storyline NOT IN (SELECT storyline FROM incidents WHERE occurred_at >= {_CUT} AND id % 40 = 0)) OR (occurred_at IS NULL AND ingested_at < TIMESTAMP '{AS_OF}' - INTERVAL 20 DAY)")
def archivable(spark, d):
    e = incidents(spark, d).select("id", "storyline", "occurred_at", "ingested_at")
    seen = e.where((F.col("occurred_at") < now() - F.expr("INTERVAL 14 DAYS")) | F.col("occurred_at").isNull() | (F.col("id") % 40 == 0))
    return lifecycle.archivable(seen, "storyline", "occurred_at", "ingested_at", now(), undated_days=20).select("id")


@query(f"WITH {I} SELECT id FROM incidents WHERE NOT (status = 'archived' AND alert_tier IS NULL AND ingested_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY)")
def retention(spark, d):
    return lifecycle.retained(incidents(spark, d), "status", "alert_tier", "ingested_at", now(), days=10).select("id")


@query(f"WITH {I} SELECT coalesce(country_iso, '??') AS iso, count(*) AS n FROM incidents GROUP BY 1")
def geo_distribution(spark, d):
    return incidents(spark, d).groupBy(F.coalesce("country_iso", F.lit("??")).alias("iso")).agg(F.count("*").alias("n"))


@query(f"WITH {I} SELECT status, count(*) AS n, CAST(floor(median(severity)) AS INT) AS median_severity FROM incidents GROUP BY status")
def run_stats(spark, d):
    return lifecycle.counters(incidents(spark, d), "status", "severity")


@query(f"WITH {I} SELECT id FROM incidents WHERE status = 'locked' AND ingested_at < TIMESTAMP '{AS_OF}' - INTERVAL 15 MINUTE")
def stale_locks(spark, d):
    return incidents(spark, d).where("status = 'locked'").where(F.col("ingested_at") < now() - F.expr("INTERVAL 15 MINUTES")).select("id")


@query(f"WITH {I} SELECT round(({AS_OF_MICROS} - max(t)) / 60000000.0, 6) AS age_minutes, ({AS_OF_MICROS} - max(t)) / 60000000.0 >= 45 AS allowed FROM incidents WHERE status = 'scored'")
def run_guard(spark, d):
    g = lifecycle.run_allowed(incidents(spark, d), "t", F.col("status") == "scored", AS_OF_MICROS)
    return g.select(r6("age_minutes", "age_minutes"), "allowed")


@query(f"WITH {I}, g AS (SELECT storyline, t, lag(t) OVER (PARTITION BY storyline ORDER BY t) AS since FROM incidents WHERE t IS NOT NULL) SELECT storyline, since, round((t - since) / CAST({H} AS DOUBLE), 6) AS gap_hours FROM g WHERE (t - since) / CAST({H} AS DOUBLE) > 24")
def staleness_gaps(spark, d):
    return lifecycle.gaps(incidents(spark, d).where("t is not null"), "t", 24, "storyline").select("storyline", "since", r6("gap_hours", "gap_hours"))


_ORD = "SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE "


@query(f"WITH a AS ({_ORD} o_orderkey % 2 = 0), b AS ({_ORD} o_orderkey % 3 = 0) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN a.s ELSE 'N' END AS s, CASE WHEN a.k IS NULL THEN 'insert' WHEN b.k IS NULL THEN 'keep' ELSE 'update' END AS _op FROM a FULL JOIN b ON a.k = b.k")
def czib_upsert(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return lifecycle.upsert(o.where("k % 2 = 0"), o.where("k % 3 = 0").withColumn("s", F.lit("N")), "k")


@query("WITH z AS (SELECT concat('Z', CAST(s_suppkey AS VARCHAR)) AS zone, s_suppkey % 3 AS k, s_suppkey % 4 <> 0 AS active FROM supplier), e AS (SELECT zone, unnest(CASE k WHEN 0 THEN ['AA'] WHEN 1 THEN ['AA', 'BB'] ELSE ['BB'] END) AS iso FROM z WHERE active) SELECT iso, string_agg(DISTINCT zone, ',' ORDER BY zone) AS zones FROM e GROUP BY iso")
def czib_by_country(spark, d):
    z = read(spark, d, "supplier").select(F.expr("concat('Z', CAST(s_suppkey AS STRING))").alias("zone"), F.expr("CASE s_suppkey % 3 WHEN 0 THEN 'Alphaland' WHEN 1 THEN 'Alphaland; Betaland' ELSE 'Betaland, Nowhere' END").alias("countries"), (F.col("s_suppkey") % 4 != 0).alias("active"))
    return lifecycle.zones_by_country(z, {"alphaland": "AA", "betaland": "BB"})


@query(f"WITH {I} SELECT country, count(*) AS rows, sha256(string_agg(concat('{{\"id\":', CAST(id AS VARCHAR), ',\"event_type\":\"', event_type, '\",\"severity\":', CAST(severity AS VARCHAR), '}}'), chr(10) ORDER BY id)) AS sha256 FROM incidents GROUP BY country")
def jsonl_manifest(spark, d):
    return lifecycle.manifest(incidents(spark, d), "country", "id", ["id", "event_type", "severity"])


@query(f"WITH {I} SELECT id, storyline FROM incidents WHERE ingested_at >= TIMESTAMP '2024-01-20 00:00:00' ORDER BY severity DESC NULLS LAST, id LIMIT 500")
def run_snapshot(spark, d):
    return incidents(spark, d).where("ingested_at >= TIMESTAMP_NTZ '2024-01-20 00:00:00'").orderBy(F.desc_nulls_last("severity"), "id").limit(500).select("id", "storyline")


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' GROUP BY event_type")
def telemetry_24h(spark, d):
    return lifecycle.metrics(read(spark, d, "events"), "event_type", F.expr("TIMESTAMP_NTZ '2024-01-29 00:00:00'"), "ts", "props", "$.k").withColumnRenamed("total", "k")


@query(f"WITH {I} SELECT id, sha256(concat(CAST(id AS VARCHAR), '#', storyline)) AS signature FROM incidents")
def signature(spark, d):
    return incidents(spark, d).select("id", F.sha2(F.concat_ws("#", F.col("id").cast("string"), "storyline"), 256).alias("signature"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) AND o_orderdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1999-01-01 00:00:00'")
def pending_reports(spark, d):
    o = read(spark, d, "orders").where("o_orderdate between TIMESTAMP_NTZ '1998-01-01 00:00:00' and TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    return o.join(read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


# ---- edges: feeds, models, fuzzy names, composites ----

from ..functions import fuzzy  # noqa: E402
from ..sources import feeds  # noqa: E402


@query(f"WITH {I} SELECT concat('f', CAST(id AS VARCHAR)) AS feed, title, concat('https://example.com/', CAST(id AS VARCHAR)) AS link, CASE WHEN id % 2 = 0 THEN '2024-01-05' ELSE '2024-01-06' END AS published FROM incidents WHERE title NOT LIKE '%&%'")
def parse_feed(spark, d):
    rss = "CASE WHEN id % 2 = 0 THEN concat('<rss><channel><item><title>', title, '</title><link>https://example.com/', CAST(id AS STRING), '</link><pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate></item></channel></rss>') ELSE concat('<feed><entry><title>', title, '</title><link href=\"https://example.com/', CAST(id AS STRING), '\"/><updated>2024-01-06T00:00:00Z</updated></entry></feed>') END"
    e = incidents(spark, d).select(F.expr("concat('f', CAST(id AS STRING))").alias("feed"), F.expr(rss).alias("xml"))
    return feeds.parse(e, "feed", "xml").select("feed", "title", "link", "published")


_BROKEN = "concat(CASE event_id % 3 WHEN 0 THEN '```json ' WHEN 1 THEN 'Answer: ' ELSE '' END, CASE WHEN event_id % 4 = 0 THEN concat('{\"k\":', CAST(event_id AS STRING), ',}') WHEN event_id % 4 = 1 THEN '{\"k\": ' ELSE concat('{\"k\":', CAST(event_id AS STRING), '} and so on') END)"


@query("SELECT event_id, CASE WHEN event_id % 4 <> 1 THEN concat('{\"k\":', CAST(event_id AS VARCHAR), '}') END AS json FROM events")
def json_repair(spark, d):
    return read(spark, d, "events").select("event_id", fuzzy.repaired_json(F.expr(_BROKEN)).alias("json"))


@query(None)
def seqmatch(spark, d):
    e = incidents(spark, d).select("id", text.norm_title("title").alias("a"))
    return e.join(e.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").select("id", r6(fuzzy.matcher_ratio("a", "b"), "ratio"))


@query("WITH q AS (SELECT c_custkey, c_custkey % 4 AS k, c_nationkey AS n FROM customer) SELECT c_custkey, concat('X', CAST(n AS VARCHAR)) AS code, CASE k WHEN 0 THEN 'code' WHEN 1 THEN 'alias' ELSE 'alias' END AS how FROM q WHERE k < 3")
def anchor_resolve(spark, d):
    a = read(spark, d, "nation").select(F.expr("concat('X', CAST(n_nationkey AS STRING))").alias("code"), F.expr("concat('Port of ', n_name)").alias("canonical_name"), F.expr("array(concat(n_name, ' Intl'))").alias("aliases"))
    asked = F.expr("CASE c_custkey % 4 WHEN 0 THEN concat('x', CAST(c_nationkey AS STRING)) WHEN 1 THEN concat('nation_', CAST(c_nationkey AS STRING), ' INTL') WHEN 2 THEN concat('PORT OF nation_', CAST(c_nationkey AS STRING)) ELSE 'qqq' END")
    return fuzzy.resolve(read(spark, d, "customer").select("c_custkey", asked.alias("name")), "c_custkey", "name", a).select("c_custkey", "code", "how")


@query(f"WITH {I} SELECT id, occurred_at > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY AND occurred_at < TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY AS sane FROM incidents WHERE occurred_at IS NOT NULL")
def time_bounds(spark, d):
    at = F.col("occurred_at")
    return incidents(spark, d).where(at.isNotNull()).select("id", ((at > now() - F.expr("INTERVAL 30 DAYS")) & (at < now() + F.expr("INTERVAL 1 DAY"))).alias("sane"))


@query(f"WITH {I} SELECT country, avg(severity) AS ti FROM incidents GROUP BY country ORDER BY ti DESC, country LIMIT 8")
def g1_fallback(spark, d):
    return forecast.fallback(incidents(spark, d), "country", "severity")


@query(f"""WITH {I}, g AS (SELECT storyline, count(*) AS n, max(t) AS last, sha256(concat(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id), '#', CAST(max(t) AS VARCHAR))) AS sig FROM incidents WHERE t IS NOT NULL AND severity >= 62 GROUP BY storyline HAVING count(*) >= 2)
SELECT storyline, n, CAST(substr(storyline, 3) AS INT) % 2 = 0 AS stale FROM g ORDER BY stale DESC, last DESC, n DESC, storyline LIMIT 10""")
def narrative_queue(spark, d):
    e = incidents(spark, d).where("t is not null and severity >= 62")
    told = reports.narrative_queue(e, "storyline", "id", "t", most=None).where("CAST(substr(storyline, 3) AS INT) % 2 = 1").select("storyline", F.col("signature").alias("held"))
    return reports.narrative_queue(e, "storyline", "id", "t", told).select("storyline", "n", "stale")


@query("SELECT page_id FROM pages WHERE regexp_replace(regexp_replace(url, '[#?].*$', ''), '/+$', '') IN (SELECT regexp_replace(regexp_replace(url, '[#?].*$', ''), '/+$', '') FROM pages WHERE page_id % 3 = 0)")
def url_allowlist(spark, d):
    p = read(spark, d, "pages").withColumn("u", F.regexp_replace(F.regexp_replace("url", "[#?].*$", ""), "/+$", ""))
    return p.join(p.where("page_id % 3 = 0").select("u").distinct(), "u", "left_semi").select("page_id")


@query(f"WITH {I} SELECT id, CASE WHEN severity < 30 OR (event_type = 'protest' AND severity < 40) THEN 'archived' ELSE 'classified' END AS status FROM (SELECT id, event_type, CASE WHEN {_FLIGHT} THEN greatest(severity, 40) ELSE severity END AS severity FROM incidents)")
def relevance_tiering(spark, d):
    e = incidents(spark, d)
    return e.select("id", lifecycle.relevance_status(F.col("severity"), F.col("event_type"), text.flight_disruption("title")).alias("status"))


@query(f"""WITH {I}, n AS (SELECT *, row_number() OVER (PARTITION BY storyline ORDER BY t DESC, id DESC) AS k FROM incidents WHERE t IS NOT NULL), w AS (SELECT *, list_distinct(list_filter(string_split(hint, ' '), lambda x: x NOT IN ('the','a','an','at','in','on','of','to','and','or','near','update'))) AS u FROM n WHERE k = 1),
p AS (SELECT a.id AS a_id, b.id AS b_id, len(list_intersect(a.u, b.u)) / CAST(len(list_distinct(list_concat(a.u, b.u))) AS DOUBLE) AS kin FROM w a JOIN w b ON a.country = b.country AND a.id <> b.id AND abs(a.t - b.t) <= {48 * H}),
r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY kin DESC, b_id) AS j FROM p WHERE kin >= 0.1) SELECT a_id, b_id, round(kin, 6) AS kin FROM r WHERE j <= 6""")
def adjudication_candidates(spark, d):
    e = linking.with_tokens(_newest(spark, d), "hint").select("id", "country", "t", "unigrams")
    return linking.adjudication_candidates(e, "id", "country").select("a_id", "b_id", r6("kin", "kin"))


@query(f"""WITH {I}, {_BOXES}, z AS (SELECT id, box_id, severity, row_number() OVER (PARTITION BY id ORDER BY CAST(country_iso <> box_country AS INT), (north - south) * (east - west), box_id) AS k FROM incidents JOIN boxes ON latitude BETWEEN south AND north AND longitude BETWEEN west AND east WHERE event_type = 'airspace_restriction' OR {_FLIGHT}),
c AS (SELECT box_id, id, severity, row_number() OVER (PARTITION BY box_id ORDER BY severity DESC, id) AS j FROM z WHERE k = 1) SELECT box_id, id, severity FROM c WHERE j = 1 ORDER BY severity DESC, id LIMIT 5""")
def airspace_cards(spark, d):
    e = incidents(spark, d)
    e = e.where((F.col("event_type") == "airspace_restriction") | text.flight_disruption("title"))
    boxes = read(spark, d, "nation").select(F.col("n_nationkey").alias("box_id"), F.expr("concat('N', CAST(n_nationkey AS STRING))").alias("box_country"), *(F.expr(f"CAST({x} AS DOUBLE)").alias(k) for k, x in {"south": "n_nationkey * 6 - 80", "north": "n_nationkey * 6 - 65", "west": "n_nationkey * 12 - 170", "east": "n_nationkey * 12 - 90"}.items()))
    at = linking.box_of(e.select("id", F.col("country_iso").alias("country"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")), boxes)
    first = scoring.latest_per(at.join(e.select("id", "severity"), "id"), "box_id", F.desc("severity"), F.asc("id"))
    return first.orderBy(F.desc("severity"), "id").limit(5).select("box_id", "id", "severity")


from . import more, further  # noqa: E402, F401  register their queries
