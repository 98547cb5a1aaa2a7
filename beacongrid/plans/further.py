"""Queries of anchors, storylines on every path, watchdogs, airspace and rules, each with its SQL where it has one."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import fuzzy, names, text
from ..operators import airspace, linking, rules, storylines
from ..params import AFRICA, BOILERPLATE, DIGEST_HEADERS, HOSTILE_ACT
from ..session import shared
from ..sources import feed_source
from ..streaming import watchdog
from .bindings import AS_OF_MICROS, incidents, read
from .queries import _FLIGHT, _HAV, _LAND, _PAIRS, _SPOT, _TOK, H, I, _located, query, r6

# ---- anchors by the likeness of whole words ----

_CODE = "concat(chr(CAST(65 + k // 676 % 26 AS INT)), chr(CAST(65 + k // 26 % 26 AS INT)), chr(CAST(65 + k % 26 AS INT)), CASE WHEN k % 7 = 0 THEN '0' ELSE '' END)"
_ASKED = "CASE p_partkey % 7 WHEN 0 THEN concat(p_name, ' Airport') WHEN 1 THEN substr(p_name, 1, length(p_name) - 1) WHEN 2 THEN concat('The ', p_name, ' ', lower(p_type), ' airfield') WHEN 3 THEN 'the City Airport' WHEN 4 THEN concat(p_type, ' ', p_name) WHEN 5 THEN concat(lower(p_type), p_name) ELSE concat(p_name, '-', p_type, 'e') END"
_TRI = "list_distinct(flatten(list_transform({w}, lambda x: list_transform(range(1, length(x) + 2), lambda i: substr(concat('  ', x, ' '), i, 3)))))"
_WORDS = "list_filter(regexp_split_to_array(regexp_replace(lower({x}), '" + BOILERPLATE + "', ' ', 'g'), '[^a-z0-9]+'), lambda w: w <> '')"


@query(f"""WITH a AS (SELECT p_name, p_type, min(p_partkey) AS k FROM part GROUP BY 1, 2), c AS (SELECT {_CODE} AS code, {_WORDS.format(x="concat(p_name, ' ', p_type, ' International Airport')")} AS w FROM a),
r AS (SELECT code, {_TRI.format(w="list_slice(w, i, j)")} AS y FROM c, unnest(range(1, len(w) + 1)) AS u(i), unnest(range(1, len(w) + 1)) AS v(j) WHERE i <= j AND length(code) = 3),
q AS (SELECT p_partkey, {_ASKED} AS name FROM part), d AS (SELECT DISTINCT name, {_WORDS.format(x="name")} AS w FROM q), x AS (SELECT name, {_TRI.format(w="w")} AS x FROM d WHERE len(w) > 0),
s AS (SELECT name, code, max(len(list_intersect(x, y)) / CAST(len(list_distinct(list_concat(x, y))) AS DOUBLE)) AS sim FROM x, r GROUP BY 1, 2),
o AS (SELECT name, code, sim, row_number() OVER (PARTITION BY name ORDER BY sim DESC, code DESC) AS k, lead(sim, 1, 0.0) OVER (PARTITION BY name ORDER BY sim DESC, code DESC) AS second FROM s)
SELECT p_partkey, code, round(sim, 6) AS similarity, round(0.5 + (sim - 0.5) / 0.5 * 0.1 + 1e-9, 2) AS confidence FROM q JOIN o USING (name) WHERE k = 1 AND sim >= 0.5 AND second / sim <= 0.9""")
def anchor_fuzzy(spark, d):
    p = read(spark, d, "part")
    code = _CODE.replace("//", "DIV")
    a = p.groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("k")).select(F.expr(code).alias("code"), F.expr("concat(p_name, ' ', p_type, ' International Airport')").alias("canonical_name"), F.array().cast("array<string>").alias("aliases"))
    return fuzzy.resolve(p.select("p_partkey", F.expr(_ASKED).alias("name")), "p_partkey", "name", a).where("how = 'fuzzy'").select("p_partkey", "code", r6("similarity", "similarity"), "confidence")


# ---- storylines on every path ----


@query(f"""WITH {I}, {_TOK}, {_PAIRS}, hd AS (SELECT storyline, u FROM nw WHERE k = 1 ORDER BY t DESC, id DESC LIMIT 200), am AS (SELECT coalesce(list(w), []) AS words FROM (SELECT w FROM (SELECT storyline, unnest(u) AS w FROM hd) GROUP BY w HAVING count(*) >= 3))
SELECT a_id, b_id, round(sim, 6) AS similarity FROM p, am WHERE gap <= {14 * 24 * H} AND ((sim > 0.4 AND len(list_filter(sh, lambda x: x <> 'sector')) > 0) OR (gap <= {72 * H} AND len(sh) >= 2 AND len(list_filter(sh, lambda x: x <> 'sector' AND NOT list_contains(words, x))) >= 1 AND con >= 0.5)
  OR (coalesce(same, false) AND (gap <= {72 * H} OR sim >= 0.2)) OR (NOT coalesce(same, false) AND coalesce(near, false) AND sim >= 0.2))""")
def storyline_pairs_telling(spark, d):
    e = _located(spark, d)
    return linking.linked_pairs(e, "id", storylines.ambient_words(e, "storyline")).select("a_id", "b_id", r6("similarity", "similarity"))


@query(None)
def storyline_assign_paths(spark, d):
    e = linking.with_tokens(incidents(spark, d).withColumn("country", F.expr(_LAND)), "hint").withColumn("place", F.expr(_SPOT))
    return storylines.assign_on_all_paths(e)


@query(f"""WITH {I}, {_TOK}, w AS (SELECT id, t, u, {_LAND} AS land, {_SPOT} AS spot, row_number() OVER (PARTITION BY storyline ORDER BY t DESC, id DESC) AS k FROM tk WHERE t IS NOT NULL),
p AS (SELECT a.id AS a_id, b.id AS b_id, CASE WHEN NOT coalesce(a.land = b.land, true) THEN 0.0 WHEN a.spot = b.spot THEN 1.0 WHEN a.land = b.land THEN len(list_intersect(a.u, b.u)) / CAST(len(list_distinct(list_concat(a.u, b.u))) AS DOUBLE) END AS kin FROM w a JOIN w b ON a.id <> b.id AND abs(a.t - b.t) <= {48 * H} WHERE a.k = 1 AND b.k = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY kin DESC, b_id) AS j FROM p WHERE kin >= 0.1) SELECT a_id, b_id, round(kin, 6) AS kin FROM r WHERE j <= 6""")
def adjudication_nets(spark, d):
    return linking.adjudication_candidates(_located(spark, d), "id", "country", place="place").select("a_id", "b_id", r6("kin", "kin"))


# ---- watchdog ----


@query(f"""WITH {I}, b AS (SELECT domain AS source, CAST(floor(t / 1000) AS BIGINT) AS s FROM incidents WHERE t IS NOT NULL AND severity >= 95 AND t <= {AS_OF_MICROS} GROUP BY 1, 2), g AS (SELECT source, s, coalesce(lead(s) OVER (PARTITION BY source ORDER BY s), {AS_OF_MICROS // 1000 + 1}) AS e FROM b)
SELECT source, s AS last_seen, unnest(range(s + 10800000, e, 7200000)) AS paged_at FROM g WHERE e > s + 10800000""")
def watchdog_pages(spark, d):
    beats = incidents(spark, d).where("t is not null and severity >= 95").select("domain", F.floor(F.col("t") / 1000).alias("at"))
    return watchdog.pages(beats, "domain", "at", AS_OF_MICROS // 1000)


# ---- registrable domains by rules ----

_RULES = ("com", "net", "org", "example.org", "*.example.net", "!ththth.example.net", "// not a rule", "")
_HOST = r"regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '')"


@query(f"""WITH h AS (SELECT page_id, {_HOST} AS host FROM pages), k(key, more) AS (VALUES ('com', 0), ('net', 0), ('org', 0), ('example.org', 0), ('example.net', 1), ('ththth.example.net', -1)),
p AS (SELECT DISTINCT host, string_split(host, '.') AS p FROM h), t AS (SELECT host, p, n, array_to_string(list_slice(p, len(p) - n + 1, len(p)), '.') AS key FROM p, unnest(range(1, 12)) AS u(n) WHERE n <= len(p)),
m AS (SELECT host, n + more AS labels, row_number() OVER (PARTITION BY host ORDER BY CAST(more = -1 AS INT) DESC, n + more DESC) AS k FROM t JOIN k USING (key) WHERE n + more <= len(p)),
o AS (SELECT p.host, p, coalesce(labels, 1) AS n FROM p LEFT JOIN m ON m.host = p.host AND k = 1)
SELECT page_id, array_to_string(list_slice(p, len(p) - n + 1, len(p)), '.') AS suffix, array_to_string(list_slice(p, len(p) - least(n + 1, len(p)) + 1, len(p)), '.') AS domain FROM h JOIN o USING (host)""")
def reg_domain_rules(spark, d):
    p = read(spark, d, "pages").select("page_id", text.host("url").alias("host"))
    rules = spark.createDataFrame([(r,) for r in _RULES], "rule string")
    return p.join(names.registrable_by(p, "host", rules), "host").select("page_id", "suffix", "domain")


# ---- reference tables and airspace ----

_BOX = {"south": "n_nationkey * 6 - 80", "north": "n_nationkey * 6 - 65", "west": "n_nationkey * 12 - 170", "east": "n_nationkey * 12 - 90"}
_BOX_SQL = ", ".join(f"CAST({x} AS DOUBLE) AS {k}" for k, x in _BOX.items())
_SEED = {
    "seeded": ("customer", "concat('C', CAST(c_custkey % 400 AS STRING))", "c_name", "CASE WHEN c_custkey % 31 = 0 THEN 'xx' ELSE concat('n', CAST(c_nationkey AS STRING)) END", "CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 95 ELSE c_nationkey * 6 - 80 + c_custkey % 18 END", "c_nationkey * 12 - 170 + c_custkey % 80"),
    "curated": ("supplier", "CASE WHEN s_suppkey % 13 = 0 THEN ' ' ELSE concat('c', CAST(s_suppkey * 3 AS STRING)) END", "s_name", "concat('N', CAST(s_nationkey AS STRING))", "s_nationkey * 6 - 80 + s_suppkey % 16", "s_nationkey * 12 - 170 + s_suppkey % 80"),
}


def _seed(kind: str) -> str:
    t, code, name, country, lat, lon = _SEED[kind]
    return f"SELECT {code} AS code, {name} AS name, {country} AS country, CAST({lat} AS DOUBLE) AS lat, CAST({lon} AS DOUBLE) AS lon"


@query(f"""WITH b AS (SELECT concat('N', CAST(n_nationkey AS STRING)) AS box_country, {_BOX_SQL} FROM nation), u AS ({_seed('curated')}, 'curated' AS origin, 0 AS trust FROM supplier UNION ALL {_seed('seeded')}, 'seeded', 1 FROM customer),
n AS (SELECT upper(trim(code)) AS code, name, upper(trim(country)) AS country, lat, lon, origin, trust FROM u),
f AS (SELECT n.*, CASE WHEN code = '' THEN 'no code' WHEN country = 'XX' THEN 'no country' WHEN lat IS NULL THEN 'no coordinates' WHEN lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180 THEN 'out of range'
  WHEN NOT (lat BETWEEN south AND north AND lon BETWEEN west AND east) THEN 'outside its country' END AS fault FROM n LEFT JOIN b ON box_country = country)
SELECT origin, code, name, coalesce(fault, CASE WHEN row_number() OVER (PARTITION BY code, fault IS NULL ORDER BY trust, name, lat, lon) > 1 THEN 'superseded' END) AS reason FROM f""")
def reference_merge(spark, d):
    boxes = read(spark, d, "nation").select(F.col("n_nationkey").alias("box_id"), F.expr("concat('N', CAST(n_nationkey AS STRING))").alias("box_country"), *(F.expr(f"CAST({x} AS DOUBLE)").alias(k) for k, x in _BOX.items()))
    rows = lambda kind: read(spark, d, _SEED[kind][0]).selectExpr(*(f"{'CAST(' if k in ('lat', 'lon') else ''}{x}{' AS DOUBLE)' if k in ('lat', 'lon') else ''} AS {k}" for k, x in zip(("code", "name", "country", "lat", "lon"), _SEED[kind][1:], strict=True)))
    return airspace.merged_reference([("curated", rows("curated")), ("seeded", rows("seeded"))], boxes).select("origin", "code", "name", "reason")


_FIR = f"SELECT concat('F', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS icao, n_nationkey AS k, {_BOX_SQL} FROM nation"
_CARD = ["id", "country_iso AS country", "concat('sector ', CAST(CAST(substr(storyline, 3) AS INT) % 6 AS STRING)) AS location", "severity", "CASE WHEN id % 3 > 0 THEN latitude END AS lat", "longitude AS lon", "event_type = 'airspace_restriction' AS aviation"]
_AIR = ["s_suppkey AS place_id", "concat('N', CAST(s_nationkey AS STRING)) AS country", "CAST(s_suppkey % 3 AS INT) AS tier", "CAST(s_suppkey * 37 % 140 - 70 AS DOUBLE) AS lat", "CAST(s_suppkey * 53 % 300 - 150 AS DOUBLE) AS lon"]


@query(f"""WITH {I}, f AS ({_FIR}), fc AS (SELECT icao, concat('N', CAST(k AS STRING)) AS country FROM f UNION ALL SELECT icao, concat('N', CAST((k + 1) % 25 AS STRING)) FROM f),
z AS (SELECT DISTINCT concat('N', CAST(s_nationkey AS STRING)) AS country FROM supplier WHERE s_nationkey % 6 = 0), x AS (SELECT icao, max(CAST(fc.country IN (SELECT country FROM z) AS INT)) AS shut FROM fc GROUP BY icao),
v AS (SELECT f.*, shut, concat(icao, CASE WHEN shut = 1 THEN '*' ELSE '' END) AS code FROM f JOIN x USING (icao)),
e AS (SELECT a.icao AS a, b.icao AS b FROM f a JOIN f b ON b.k = (a.k + 1) % 25 OR b.k = (a.k + 7) % 25), eb AS (SELECT DISTINCT * FROM (SELECT a, b FROM e UNION ALL SELECT b, a FROM e)),
ap AS (SELECT {', '.join(_AIR)} FROM supplier), c AS (SELECT {', '.join(_CARD)} FROM incidents WHERE event_type = 'airspace_restriction' OR {_FLIGHT}),
aa AS (SELECT id, icao FROM (SELECT id, icao, row_number() OVER (PARTITION BY id ORDER BY CAST(c.country <> fc.country AS INT), (north - south) * (east - west), icao) AS r FROM c JOIN f ON lat BETWEEN south AND north AND lon BETWEEN west AND east JOIN fc USING (icao)) WHERE r = 1),
g AS (SELECT id, place_id, tier, {_HAV} AS km FROM (SELECT c.id, place_id, tier, pow(sin(radians(ap.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(ap.lat)) * pow(sin(radians(ap.lon - c.lon) / 2), 2) AS h FROM c JOIN aa USING (id), ap)),
d AS (SELECT id, place_id, round(km, 0) AS km, row_number() OVER (PARTITION BY id ORDER BY km, tier, place_id) AS r FROM g WHERE km <= 500),
da AS (SELECT id, string_agg(concat(place_id, ':', CAST(km AS BIGINT)), ',' ORDER BY r) AS airports FROM d WHERE r <= 3 GROUP BY id),
nb AS (SELECT a, string_agg(code, ',' ORDER BY shut DESC, icao) AS n FROM eb JOIN v ON v.icao = b GROUP BY a),
cf AS (SELECT country, string_agg(code, ',' ORDER BY shut DESC, icao) AS firs, min(CASE WHEN shut = 1 THEN icao END) AS s, min(icao) AS m, max(shut) AS shut FROM fc JOIN v USING (icao) GROUP BY country),
cn AS (SELECT country, string_agg(code, ',' ORDER BY shut DESC, icao) AS n FROM (SELECT DISTINCT fc.country, b FROM fc JOIN eb ON fc.icao = a WHERE NOT EXISTS (SELECT 1 FROM fc o WHERE o.country = fc.country AND o.icao = b)) JOIN v ON v.icao = b GROUP BY country),
ca AS (SELECT country, string_agg(concat(place_id, ':'), ',' ORDER BY r) AS airports FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY tier, place_id) AS r FROM ap) WHERE r <= 3 GROUP BY country),
al AS (SELECT c.*, 'point' AS scope, v.icao AS icao, code AS firs, n, coalesce(airports, '') AS airports, true AS says FROM c JOIN aa USING (id) JOIN v USING (icao) LEFT JOIN nb ON nb.a = v.icao LEFT JOIN da ON da.id = c.id
  UNION ALL SELECT c.*, 'country', coalesce(s, m), firs, n, coalesce(airports, ''), aviation OR shut = 1 FROM c JOIN cf ON cf.country = c.country LEFT JOIN cn ON cn.country = c.country LEFT JOIN ca ON ca.country = c.country WHERE c.id NOT IN (SELECT id FROM aa)),
r AS (SELECT *, row_number() OVER w AS n1, first_value(scope) OVER w AS fs, first_value(location) OVER w AS fl, row_number() OVER (PARTITION BY country, icao, scope, location ORDER BY severity DESC NULLS LAST, id) AS k1 FROM al WHERE says WINDOW w AS (PARTITION BY country, icao ORDER BY severity DESC NULLS LAST, id)),
o AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY severity DESC NULLS LAST, id) AS place_rank FROM r WHERE CASE WHEN scope = 'country' THEN n1 = 1 ELSE k1 = 1 AND NOT (fs = 'country' AND fl = location) END)
SELECT country, CAST(place_rank AS INT) AS place_rank, id, scope, icao, firs, coalesce(n, '') AS neighbours, airports FROM o WHERE place_rank <= 5""")
def airspace_assessment(spark, d):
    n, s = read(spark, d, "nation"), read(spark, d, "supplier")
    iso = lambda k: F.concat(F.lit("N"), (k).cast("string"))
    k = F.col("n_nationkey")
    name = lambda x: F.concat(F.lit("F"), F.lpad(x.cast("string"), 2, "0"))
    firs = n.select(name(k).alias("icao"), F.array(iso(k), iso((k + 1) % 25)).alias("countries"), *(F.expr(f"CAST({x} AS DOUBLE)").alias(c) for c, x in _BOX.items()))
    borders = n.select(name(k).alias("a"), F.explode(F.array(name((k + 1) % 25), name((k + 7) % 25))).alias("b"))
    zones = s.where("s_nationkey % 6 = 0").select(iso(F.col("s_nationkey")).alias("country"), F.concat(F.lit("Z"), F.col("s_nationkey").cast("string")).alias("zone"), F.lit(None).cast("string").alias("valid_until"))
    e = incidents(spark, d)
    c = e.where((F.col("event_type") == "airspace_restriction") | text.flight_disruption("title")).selectExpr(*_CARD)
    got = airspace.cards(c, firs, borders, zones, s.selectExpr(*_AIR))
    codes = lambda a: F.coalesce(F.array_join(F.transform(a, lambda v: F.concat(v["icao"], F.when(v["free"], "").otherwise("*"))), ","), F.lit(""))
    ports = F.coalesce(F.array_join(F.transform("airports", lambda a: F.concat(a["place_id"].cast("string"), F.lit(":"), F.coalesce(a["km"].cast("string"), F.lit("")))), ","), F.lit(""))
    return got.select("country", "place_rank", "id", "scope", "icao", codes("firs").alias("firs"), codes("neighbours").alias("neighbours"), ports.alias("airports"))


# ---- feeds as a data source ----


@query(f"""WITH {I}, a AS (SELECT id, greatest(CASE WHEN id % 5 > 0 THEN id % 5 ELSE 0 END, CASE WHEN id % 4 = 2 THEN 3 ELSE 0 END) AS n FROM incidents)
SELECT concat('f', CAST(id AS VARCHAR)) AS feed, concat('https://example.com/', CAST(id AS VARCHAR), '#adv-202401', lpad(CAST(id % 31 + 1 AS VARCHAR), 2, '0')) AS link, CASE WHEN id % 3 = 0 THEN 'lenient' ELSE 'strict' END AS kind FROM a WHERE id % 11 > 0 AND id % 31 + 1 >= 24 AND id % 4 <> 0 AND (n >= 3 OR id % 4 = 1)
UNION ALL SELECT concat('f', CAST(id AS VARCHAR)), NULL, 'corrupt' FROM a WHERE id % 11 = 0""")
def advisory_feeds(spark, d):
    said = "concat('Advisory level ', CAST(id % 5 AS STRING), CASE id % 4 WHEN 0 THEN ', no change' WHEN 1 THEN ', raised' WHEN 2 THEN ', reconsider travel' ELSE '' END)"
    day = "concat('2024-01-', lpad(CAST(id % 31 + 1 AS STRING), 2, '0'), 'T00:00:00Z')"
    xml = f"CASE WHEN id % 11 = 0 THEN 'nothing here' ELSE concat('<rss><channel><item><title>', {said}, '</title><link>https://example.com/', CAST(id AS STRING), '</link><description>&lt;b&gt;text&lt;/b&gt;</description><pubDate>', {day}, '</pubDate></item>', CASE WHEN id % 3 = 0 THEN '<br>' ELSE '' END, '<item><title>Advisory level 4</title><link>https://example.com/undated</link></item></channel></rss>') END"
    path = f"{shared(spark)}/feeds-{uuid.uuid4().hex}"
    incidents(spark, d).select(F.to_json(F.struct(F.expr("concat('f', CAST(id AS STRING))").alias("feed"), F.expr(xml).alias("xml"))).alias("value")).write.text(path)
    got = feed_source.register(spark).read.format("landed_feeds").option("advisories", "true").option("as_of", "2024-01-31T00:00:00Z").option("lines", "true").load(path)
    return got.select("feed", "link", "kind")


# ---- rules after a classifier ----

_SAID = {
    "relevance": "CASE WHEN id % 19 = 0 THEN NULL ELSE CAST(id % 97 AS INT) END",
    "event_type": "CASE id % 9 WHEN 0 THEN 'noise' WHEN 1 THEN 'african_terrorism' WHEN 2 THEN 'made_up' WHEN 3 THEN NULL ELSE event_type END",
    "sub_type": "CASE id % 4 WHEN 0 THEN 'protest' WHEN 1 THEN 'nothing' END",
    "country_iso": "CASE id % 7 WHEN 0 THEN ' ng' WHEN 1 THEN 'usa' WHEN 2 THEN 'N1' WHEN 3 THEN '' WHEN 4 THEN 'EG' END",
    "report_kind": "CASE id % 6 WHEN 0 THEN 'Follow-up' WHEN 1 THEN ' Round_Up ' WHEN 2 THEN 'rumour' WHEN 3 THEN NULL ELSE report_kind END",
}
_TYPES = ("armed_conflict", "protest", "bomb_threat", "african_terrorism", "terrorism", "unclassified")


@query(f"""WITH {I}, s AS (SELECT id, title, {_FLIGHT} AS disrupted, {", ".join(f"{v} AS {k}" for k, v in _SAID.items())} FROM incidents),
a AS (SELECT *, coalesce(relevance, 50) AS rel, coalesce(event_type, 'unclassified') AS said, upper(trim(country_iso))[1:2] AS two FROM s),
b AS (SELECT *, disrupted AND rel < 40 AS saved, CASE WHEN disrupted AND rel < 40 THEN 40 ELSE rel END AS r, CASE WHEN disrupted AND rel < 40 AND said = 'noise' THEN 'unclassified' ELSE said END AS now, CASE WHEN regexp_full_match(two, '[A-Z][A-Z]') THEN two END AS iso FROM a),
c AS (SELECT *, r < 30 OR (now = 'noise' AND r < 40) AS gone, now NOT IN {_TYPES} AND now <> 'noise' AS unknown, now = 'african_terrorism' AND NOT coalesce(iso IN {AFRICA}, false) AS outside, regexp_replace(lower(coalesce(report_kind, '')), '[\\s_-]+', '', 'g') AS kind FROM b)
SELECT id, CASE WHEN gone THEN 'archived' ELSE 'classified' END AS status, CASE WHEN gone OR now = 'noise' OR unknown THEN 'unclassified' WHEN outside THEN 'terrorism' ELSE now END AS event_type, CASE WHEN NOT gone AND sub_type IN {_TYPES} THEN sub_type END AS sub_type,
  CASE WHEN NOT gone THEN iso END AS country_iso, CASE WHEN kind IN ('followup', 'roundup', 'commentary') THEN kind ELSE 'new_incident' END AS report_kind, CASE WHEN NOT gone THEN 0 WHEN regexp_matches(title, '{HOSTILE_ACT.replace("'", "''")}') THEN 1 END AS charge,
  CASE WHEN gone THEN 'archived' WHEN outside THEN 'outside_africa' WHEN unknown THEN 'unknown_type' WHEN now = 'noise' THEN 'noise' WHEN saved THEN 'disruption' ELSE 'kept' END AS rule FROM c""")
def decided_types(spark, d):
    e = incidents(spark, d)
    said = e.select("id", "title", text.flight_disruption("title").alias("disrupted"), *(F.expr(v).alias(k) for k, v in _SAID.items()))
    got = rules.decided(said, spark.createDataFrame([(c,) for c in _TYPES], "code string"))
    return got.select("id", "status", "event_type", "sub_type", "country_iso", "report_kind", "charge", "rule")


_TERMS = (("drone attack", "N1"), ("missile strike", "N2"), ("harbor", "N3"), ("near sector 1", "N4"), ("flight diverted", "N5"))


@query(f"WITH {I}, t(term, about) AS (VALUES {', '.join(map(str, _TERMS))}) SELECT DISTINCT id, about FROM incidents JOIN t ON contains(concat(' ', regexp_replace(lower(title), '[^a-z0-9_]+', ' ', 'g'), ' '), concat(' ', term, ' ')) AND country_iso IS DISTINCT FROM about")
def spillover_terms(spark, d):
    return rules.spillover_phrases(incidents(spark, d), spark.createDataFrame(_TERMS, "term string, about string"), "id", "country_iso", "title")


_H = [f"'{h}'" for h in DIGEST_HEADERS]
_DIGEST = f"concat('**', title, '**', chr(10), {_H[1]}, ':', chr(10), '- ', lower(country_iso), ' | ', hint, ' https://x.example/a', chr(10), '- ZZ | made up', chr(10), {_H[2]}, chr(10), CASE WHEN id % 3 = 0 THEN 'YOK' ELSE concat('- ', domain, ' — Kaynak: wire', chr(10), '...', chr(10), '• second') END, chr(10), {_H[4]}, chr(10), '- watch ', CAST(id AS STRING))"


@query(f"WITH {I} SELECT id, trim(title) AS overview, concat(upper(country_iso)[1:2], '=', hint) AS countries, CASE WHEN id % 3 = 0 THEN '' ELSE concat(domain, '/second') END AS aviation, concat('watch ', CAST(id AS VARCHAR)) AS watch, true AS valid FROM incidents")
def digest_parse(spark, d):
    e = incidents(spark, d).select("id", F.expr(_DIGEST).alias("x"), F.array(F.substring(F.upper("country_iso"), 1, 2)).alias("known"))
    g = e.select("id", rules.digest(F.col("x"), F.col("known")).alias("g"))
    land = F.array_join(F.transform("g.countries", lambda c: F.concat(c["iso"], F.lit("="), c["text"])), "/")
    return g.select("id", "g.overview", land.alias("countries"), F.array_join("g.aviation", "/").alias("aviation"), F.array_join("g.watch", "/").alias("watch"), "g.valid")


@query(f"""WITH {I}, l AS (SELECT country, sha256(concat('{{"id":', CAST(id AS VARCHAR), ',"event_type":"', event_type, '","severity":', CAST(severity AS VARCHAR), '}}')) AS h, count(*) AS n FROM incidents GROUP BY 1, 2),
a AS (SELECT country, substr(h, 1, 2) AS p, sum(n) AS n, sha256(string_agg(concat(h, ':', CAST(n AS VARCHAR)), ',' ORDER BY concat(h, ':', CAST(n AS VARCHAR)))) AS d FROM l GROUP BY 1, 2),
b AS (SELECT country, substr(p, 1, 1) AS p, sum(n) AS n, sha256(string_agg(concat(p, ':', d), ',' ORDER BY concat(p, ':', d))) AS d FROM a GROUP BY country, substr(p, 1, 1))
SELECT country, CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(concat(p, ':', d), ',' ORDER BY concat(p, ':', d))) AS root FROM b GROUP BY country""")
def merkle_manifest(spark, d):
    return rules.merkle_manifest(incidents(spark, d), "country", ["id", "event_type", "severity"])
