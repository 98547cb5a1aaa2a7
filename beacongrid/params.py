"""Thresholds of the operators. Every operator takes the part it needs as a parameter; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Results depend on them.
TIERS = ("CRITICAL", "ALERT", "WATCH")
FRESH = ("same_day", "previous_day")
NOT_NEWS = ("followup", "roundup", "commentary")


# Markers of prompts in scraped text, by regular expression, in any case.
INJECTIONS = (r"\[INST\]", r"<\|system\|>", r"<\|user\|>", r"<\|assistant\|>", "IGNORE PREVIOUS INSTRUCTIONS", "FORGET ALL PRIOR", "YOU ARE NOW", "SYSTEM OVERRIDE")

# Shapes of headlines that report on what is already known, as (kind, all of which must match, none of which may). The first kind that fits names it.
# The first two are labels: they are sought in the headline without its publisher. What excludes a kind is a pattern of its own, as the engine that checks the results has no lookahead.
AFTERMATH = (
    ("desk_label", (r"(?i)^[^:]{0,70}\b(latest|live|updates?|timeline|recap|roundup)\b(\s+(news|live|updates?|blog|coverage|briefing))*\s*:",), ()),
    ("war_diary", (r"(?i)^[^:]{0,50}\bday\s+\d[\d,]{0,6}\b[^:]{0,20}:",), ()),
    ("retrospective", (r"(?i)\b(one|two|three|four|five|\d+)\s+(week|month|year|day)s?\s+(later|after|since)\b",), ()),
    ("explainer", (r"(?i)\b(what we know|as it happened|key moments|explainer)\b",), ()),
    ("probe", (r"(?i)(expands? probe|probe into|investigation into|inquiry into)",), ()),
    ("arrest_for_earlier_incident", (r"(?i)\b(suspects?|men|man|woman|women|teen|teenager|youth|driver|student|person|individual|resident|worker|diver|soldier|two|three|four|five|six|seven|eight|nine|ten|\d{1,3})\b(\s+\S+){0,3}\s+\b(arrested|detained|in custody|taken into custody)\b(\s+\S+){0,3}\s+\b(in|over|after|following|for)\b(\s+\S+){0,8}?\s*\b(shooting|killing|murder|homicide|stabbing|bombing|blast|blasts|explosion|explosions|crash|assault|kidnapping|abduction|arson)\b|^(\w+\s+){0,2}arrests?\s+(made\s+)?(after|over|in connection with)\b",), ()),
    ("judicial", (r"(?i)\b(charged|sentenced|convicted|indicted|pleads? guilty|on trial)\b|\bcharges\s+(\w+[- ]){1,3}(over|with|in connection)\b",), ()),
    ("resolution", (r"(?i)(safely rescued|released hostage|freed after|reopens? after|to demolish)",), ()),
    ("post_mortem", (r"(?i)\b(autops(y|ies)|post-?mortem)\b",), ()),
    ("toll_revision", (r"(?i)\b(death|casualty|injury)\s+toll\b(\s+\S+){0,3}\s+(rises?|climbs?|reaches|jumps?|updated|revised|up\s+(to|by))\b|\btoll\s+(rises?|climbs?|jumps?)\s+to\b",), ()),
    ("remains_recovery", (r"(?i)\b(bodies|body|remains)\b(\s+of)?(\s+\S+){0,5}\s+\b(recovered|repatriated|identified|exhumed|handed over)\b",), ()),
    ("burial", (r"(?i)\b(funerals?|mourners|laid to rest|buried in|burial (of|for))\b",), (r"(?i)\b(attack|strike|bomb\w*|shell\w*|blast|fire|shooting|hits?|targets?|struck|kill\w*)\b(\s+\S+){0,3}\s+(on|at|of)?\s*(the\s+)?(funeral|mourners|procession)\b",)),
)
LABELS = ("desk_label", "war_diary")

# Causes of accidents, in the same form; event types that say nothing about the cause; what exempts a headline.
ACCIDENTS = (
    ("natural", (r"(?i)\b(earthquakes?|quakes?|aftershocks?|tsunami|volcanic|flood\w*|torrential|downpours?|landslides?|mudslides?|avalanche|wildfire\w*|bushfire\w*|typhoons?|hurricanes?|cyclones?|monsoon)\b",), ()),
    ("crowd_crush", (r"(?i)\b(stampede|crowd crush)\b",), ()),
    ("transport_accident", (r"(?i)\b(bus(es)?|coach|truck|lorry|cars?|van|minibus|train|tram|ferry|boat|vessel)\b", r"(?i)\b(crash\w*|collision|collided|overturn\w*|derail\w*|capsiz\w*|plunge[sd]?|veers? off|rolls? into|accident)\b"), ()),
    ("structural_collapse", (r"(?i)\b(tunnel|building|bridge|mine|scaffolding)\s+collapse\b",), ()),
    ("industrial", (r"(?i)\bgas leak\b",), ()),
)
ANY_CAUSE = ("mass_casualty_event", "civilian_casualties")
AVIATION_NEXUS = r"(?i)\b(airports?|airlines?|flights?|aircraft|planes?|airplanes?|helicopters?|airspace|runways?|aviation)\b"
HOSTILE_CONTEXT = r"(?i)\b(airstrikes?|strikes?|struck|attacks?|bomb\w*|shell\w*|shooting|shot|gunmen|gunman|missiles?|drones?|terror\w*|ambush|blast|ied|militants?|insurgents?|troops)\b"

# Headlines that assert a hostile act, in any case: acts as nouns, their verbs, weapons and actors with verbs, acts with a preposition or a verb of delivery, verbs with what is hit, ordnance, drones over a place.
HOSTILE_ACT = (
    r"(?i)\b(explosions?|bombings?|shelling|airstrikes?|air strikes?|missile strikes?|missile attacks?|drone attacks?|drone strikes?|gunfire|assassinat(ion|ed)|massacred?|ambush|suicide bomb(er)?|car bomb|truck bomb|improvised explosive"
    r"|terror(ist)?s? attacks?|artillery|mortar|kidnapped|abducted|attacked|bombed|shelled|stormed|detonated|hijacked|opened fire|shot dead|shot down"
    r"|(drones?|missiles?|rockets?|uavs?)\s+(target(ed|s)?|hit|struck|strike[sd]?)"
    r"|(drones?|missiles?|rockets?|uavs?|strikes?|shelling|bombardment|troops|forces|militants?|gunmen|rebels?|insurgents?|terrorists?|jets?|warplanes?|raids?)['’\"]?\s+([\w'’-]+\s+){0,3}(kills?|killed|injur(e|es|ed)|wounds?|wounded)"
    r"|(kills?|killed|injur(e|es|ed)|wounded)\s+([\w'’-]+\s+){0,2}(civilians?|people|residents?|children|women|worshippers|passengers|pilgrims)"
    r"|(down(s|ed)?|intercept(s|ed)?|shoot(s)? down)\s+([\w'’-]+\s+){0,3}(drones?|missiles?|aircraft|jets?|uavs?)"
    r"|(attacks?|strikes?|assaults?|offensives?|raids?|bombardments?)\s+(on|against)\b"
    r"|(launch(ed|es|ing)?|carr(y|ies|ied)\s+out|conduct(ed|s|ing)?|mount(ed|s|ing)?|unleash(ed|es|ing)?)\s+(the\s+|a\s+|an\s+|its\s+|their\s+|[\w'’-]+\s+){0,3}(attacks?|strikes?|raids?|offensives?|assaults?|bombardments?)"
    r"|(forces|troops|army|navy|air force|militants?|gunmen|rebels?|insurgents?|fighters?|jets?|warplanes?|artillery|militia|units?)\s+([\w'’-]+\s+){0,2}(hits?|struck|strikes?|target(ed|s)?|seiz(e|ed|es)|captur(e|ed|es)|overran|overrun|shell(ed|s)?|storm(ed|s)?|raid(ed|s)?)"
    r"|(hits?|struck|targeted)\s+([\w'’-]+\s+){0,3}(naval base|air ?base|military base|port|refinery|depot|terminal|substation|power (plant|station|grid)|pipeline|airport|barracks|checkpoint|convoy|warehouse)"
    r"|explosive (device|drone|belt)|drones? (spotted|sighted|flew) over)\b"
)

# Headers of a written digest, in order, and lines that say there is nothing.
DIGEST_HEADERS = ("GENEL DURUM DEĞERLENDİRMESİ", "ÜLKE DEĞERLENDİRMELERİ", "HAVACILIK OPERASYONLARINA ETKİ", "KRİTİK GELİŞMELER", "İZLEME VE BEKLENTİLER")
DIGEST_EMPTY = ("yok", "veri yok", "bulunmuyor", "-")

# Words that most names of airports have.
BOILERPLATE = r"\b(?:international|intl|airport|airfield|air\s?base|airbase|regional|municipal|the|capital|city)\b"

# Risk levels of a country, the highest first, and the severity from which an event is severe.
RISK = ("Kritik", "Yüksek", "Yükseltilmiş", "Normal")
SEVERE = 71


@dataclass(frozen=True)
class Tension:
    """Weights of the tension index; fixed values."""

    volume: float = 0.15
    diversity: float = 0.10
    severity_avg: float = 0.20
    severity_max: float = 0.15
    delta: float = 0.15
    recency: float = 0.10
    quality: float = 0.05
    cross_domain: float = 0.05
    critical: float = 0.05
    half_life_hours: float = 24.0
    undated_age_hours: float = 72.0


@dataclass(frozen=True)
class Tier:
    """One step of the alert ladder; fixed values."""

    name: str
    severity: int
    confidence: float
    located: bool = False
    located_or_fresh: bool = False
    fresh: bool = False


@dataclass(frozen=True)
class Alerts:
    """Fixed values."""

    ladder: tuple[Tier, ...] = (
        Tier("CRITICAL", 80, 0.62, located=True, fresh=True),
        Tier("ALERT", 65, 0.50, located_or_fresh=True),
        Tier("WATCH", 45, 0.40, fresh=True),
    )
    advisory_types: tuple[str, ...] = ("travel_advisory", "travel_ban")
    advisory_severity: int = 75
    severity_floor: int = 90
    corroboration_floor: int = 2
    suppression_hours: int = 4
    quiet_hours: int = 12
    stale_days: int = 30


@dataclass(frozen=True)
class Scoring:
    """Points and caps of severity, weights of confidence; fixed values."""

    base: int = 20
    proximity: int = 30
    restricted_zone: int = 20
    casualties: int = 20
    deaths: int = 3
    injuries: int = 10
    aviation: int = 15
    top: int = 100
    umbrella_cap: int = 50
    safety_cap: int = 40
    planned_cap: int = 40
    near: float = 0.6
    llm_weight: float = 0.4
    anchor_weight: float = 0.3
    diversity_weight: float = 0.3


@dataclass(frozen=True)
class Linking:
    """Thresholds and windows of storylines; fixed values."""

    jaccard: float = 0.4
    days: int = 14
    assist: float = 0.2
    assist_hours: int = 72
    containment: float = 0.5
    containment_hours: int = 72
    common_storylines: int = 3
    cluster: float = 0.40


@dataclass(frozen=True)
class Vocabulary:
    """Word lists as alternations of regular expressions; all may be replaced by the caller."""

    critical: str = "explosion|hostage|hijack|airstrike|massacre"
    keywords: str = "attack|blast|bomb|clash|drone|missile|protest|riot|shooting|strike"
    high_signal: str = "drone attack|car bomb|hostage taking|air strike"
    noise: str = "football|box office|celebrity|snowstorm|maintenance"
    retrospective: str = "years? after|anniversary of|looking back"
    military: str = "airstrike|missile|troops|drone"
    cancelling: str = "video game|movie"
    breaking: str = "breaking|urgent|just in"
    aviation: str = "airport|flight|airline|runway|airspace"
    disruption: str = "cancel(?:s|ed|led)?|divert(?:s|ed)?|ground(?:s|ed)?|clos(?:es|ed|ure)|suspend(?:s|ed)?"
    casualties: str = "killed|dead|kills|injured|wounded"
    injections: tuple[str, ...] = INJECTIONS
    stop_words: tuple[str, ...] = ("the", "a", "an", "at", "in", "on", "of", "to", "and", "or", "near", "update")
    shared_words: tuple[str, ...] = ("sector", "north", "south")
    credibility: dict[str, float] = field(default_factory=lambda: {"src0.example.com": 0.95, "src1.example.com": 0.85, "src2.example.com": 0.8, "src3.example.com": 0.7, "example.com": 0.65})
    unknown_credibility: float = 0.6


# Countries of Africa, by ISO code.
AFRICA = (
    "DZ", "AO", "BJ", "BW", "BF", "BI", "CM", "CV", "CF", "TD", "KM", "CD", "CG", "CI", "DJ", "EG", "GQ", "ER", "SZ", "ET", "GA", "GM", "GH", "GN", "GW", "KE", "LS", "LR", "LY", "MG", "MW", "ML", "MR", "MU", "MA", "MZ", "NA", "NE", "NG",
    "RW", "ST", "SN", "SC", "SL", "SO", "ZA", "SS", "SD", "TZ", "TG", "TN", "UG", "ZM", "ZW", "EH",
)

# Event types of safety alone, and of strategy; what a page says that only keeps robots out; labels of a day's precision.
SAFETY_ONLY = ("bird_strike", "engine_failure", "emergency_landing", "depressurization", "fire_on_board", "unruly_passenger", "runway_incursion")
STRATEGIC = ("travel_advisory", "travel_ban", "embassy_closure", "political_event", "general_strike", "evacuation", "humanitarian_crisis")
CHALLENGES = ("vercel security checkpoint", "just a moment", "checking your browser", "cf-browser-verification", "attention required", "captcha")
NO_DATE, UNVERIFIED = "tarih belirsiz", " (tarih doğrulanmadı — yayın tarihi teyit edilemedi)"
PRECISION = {"this_week": " (gün tahmini)", "approximate": " (yaklaşık)", "unknown": " (tarih kaynağın yayın tarihine dayalı)"}
