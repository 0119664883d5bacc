"""Every query of the core by name, and the SQL that checks it where SQL can say it.

Each query reads its whole tables. The SQL is written from the operators' descriptions and runs on another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelode.functions import extract as X
from pagelode.functions import text as T
from pagelode.functions import urls as U
from pagelode.operators import contacts as C
from pagelode.operators import facilities as A
from pagelode.operators import keyed as K
from pagelode.operators import rules as rules_
from pagelode.plans import cases, deliver, runs
from pagelode.plans.discover import candidate_sites
from pagelode.profile import (
    BRAND_STOP_WORDS, ENTITIES, FREE_MAIL_FINAL, FREE_MAIL_SEEN, GENERIC_TITLES, GUESS_NOTE, HONORIFICS, INDOOR, LISTING_HOSTS, MASTHEADS, NAME_KINDS, NAME_STOP_WORDS, NOT_A_PERSON, OUTDOOR, PAID, PUBLISHER_DOMAINS, RETAIL_SIGNALS,
    ROLE_LOCALS, SHARED_LOCALS, SPORTS, STREET_SUFFIXES, STREET_WORDS, TEXT_KINDS, VANITY_LABELS, VENUE_WORDS, WEAK_MASTHEADS,
)
from pagelode.sources import csvio
from pagelode.sources.stages import table

MASTER, CANDIDATES, PLACES, OUTREACH = "new_york_indoor_court_facilities", "ny_indoor_courts_reoon_verification_input", "ny_indoor_courts_locations", "n8n_indoor_courts_5_row_reference"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(cases.QUERIES)
ORACLES: dict[str, str] = dict(cases.ORACLES)


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def re2(p: str) -> str:
    return p.replace("'", "''")


HOST_SQL = """regexp_replace(lower(CASE WHEN regexp_matches({c}, '^(?i)https?:') THEN
 regexp_replace(regexp_extract({c}, '^(?i)https?:[/\\\\]*(?:[^/?#@\\\\]*@)?([^/?#\\\\]*)', 1), CASE WHEN regexp_matches({c}, '^(?i)http:') THEN ':(80)?$' ELSE ':(443)?$' END, '')
 ELSE {c} END), '^www\\.', '')""".replace("^(?i)", "(?i)^")
WEBSITE = "trim(coalesce(website, ''))"
HOST = HOST_SQL.format(c=WEBSITE)


def apex_sql(h: str) -> str:
    lead = f"(len(string_split(regexp_extract({h}, '^((?:(?:{'|'.join(VANITY_LABELS)})\\.)*)', 1), '.')) - 1)"
    n = f"len(string_split({h}, '.'))"
    least = f"(CASE WHEN regexp_matches({h}, '(^|\\.)(co\\.uk|org\\.uk|com\\.au|co\\.nz|ny\\.us)$') THEN 3 ELSE 2 END)"
    return f"array_to_string(list_slice(string_split({h}, '.'), greatest(least({lead}, {n} - {least}), 0) + 1, {n}), '.')"


QUERIES |= runs.QUERIES
ORACLES |= runs.sqls(HOST)

# ---------------------------------------------------------------- hosts and names


@query(f"SELECT facility_row_id, {HOST} AS host, regexp_replace(website, '(?i)^http://', 'https://') AS secure_url FROM {MASTER}")
def host_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", U.registrable_domain("website").alias("host"), U.prefer_https("website").alias("secure_url"))


@query(f"""SELECT facility_row_id, {apex_sql('h')} AS apex, array_to_string(list_slice(string_split(h, '.'), greatest(len(string_split(h, '.')) - 1, 1), len(string_split(h, '.'))), '.') AS last_two
FROM (SELECT facility_row_id, {HOST} AS h FROM {MASTER})""")
def apex_domain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", U.apex_domain("website").alias("apex"), U.last_two_labels(U.registrable_domain("website")).alias("last_two"))


@query(f"""SELECT facility_row_id, h AS host, regexp_matches(h, '{"|".join(w.replace(".", "[.]") for w in sorted(set(LISTING_HOSTS)))}') AS listing, regexp_matches(h, '(?i)\\.(gov|mil|ny\\.us)$') AS government
FROM (SELECT facility_row_id, {HOST} AS h FROM {MASTER})""")
def host_filter(spark: SparkSession, d: str) -> DataFrame:
    host = table(spark, d, MASTER).select("facility_row_id", U.registrable_domain("website").alias("host"))
    return host.withColumns({"listing": U.is_listing_host("host"), "government": U.is_government_host("host")})


@query(f"""SELECT facility_row_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(facility_name, '')), '[^a-z0-9]+', ' ', 'g'), '\\b({"|".join(NAME_STOP_WORDS)})\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS name_key FROM {MASTER}""")
def name_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", T.name_key("facility_name").alias("name_key"))


@query(f"""SELECT n AS typed, CASE WHEN n <> upper(n) AND n <> lower(n) THEN n ELSE array_to_string(list_transform(regexp_extract_all(lower(n), '[^\\s''’-]*[\\s''’-]|[^\\s''’-]+$'),
 lambda p: CASE WHEN regexp_matches(p, '^[a-z]') THEN upper(p[1]) || p[2:] ELSE p END), '') END AS shown
FROM (SELECT DISTINCT trim(decision_maker_full_name, ' ') AS n FROM {CANDIDATES} WHERE decision_maker_full_name IS NOT NULL)""")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, CANDIDATES).filter("decision_maker_full_name is not null").select(F.trim("decision_maker_full_name").alias("typed")).distinct()
    return names.select("typed", T.title_case("typed").alias("shown"))


CITY_BLANK = "[\\s\\x0b\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]+"


@query(f"""SELECT c AS typed, CASE WHEN regexp_matches(t, '(?i)^(nyc|new york city|n\\.?y\\.?c\\.?)$') THEN 'New York' WHEN t = upper(t) THEN
 array_to_string(list_transform(regexp_extract_all(lower(t), '[a-z0-9_]+|[^a-z0-9_]+'), lambda p: CASE WHEN regexp_matches(p, '^[a-z]') THEN upper(p[1]) || p[2:] ELSE p END), '') ELSE t END AS city
FROM (SELECT DISTINCT city AS c, regexp_replace(regexp_replace(city, '[.''’-]+$', ''), '^{CITY_BLANK}|{CITY_BLANK}$', '', 'g') AS t FROM {MASTER} WHERE city IS NOT NULL)""")
def city_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Every city, whatever its characters."""
    from pagelode.profile import NY

    rows = table(spark, d, MASTER).filter("city is not null").select(F.col("city").alias("typed")).distinct()
    return rows.select("typed", T.normalize_city("typed", NY.city_alias).alias("city"))


CP1252_SQL = "MAP {" + ", ".join(f"{cp}: '{b:02X}'" for cp, b in T.CP1252_HIGH.items()) + "}"


def repair_sql(c: str) -> str:
    """Text read as windows-1252 by mistake, turned back into its bytes; whatever does not decode stays."""
    data = f"array_to_string(list_transform(string_split({c}, ''), lambda ch: CASE WHEN unicode(ch) < 256 THEN format('{{:02X}}', unicode(ch)) ELSE coalesce({CP1252_SQL}[unicode(ch)], 'ZZ') END), '')"
    return f"(CASE WHEN regexp_matches({c}, '[ÂÃâ]') THEN coalesce(TRY(decode(unhex({data}))), {c}) ELSE {c} END)"


DASHES = "‐‑‒–—―−•·"


PLAINER = dict(zip(DASHES + "‘’“”\u00a0\u2007\u202f\u200b", "-" * len(DASHES) + "\x01\x01" + '""' + "    ", strict=True))
SEPARATORS_SQL = "translate({c}, '" + "".join(PLAINER) + "', '" + "".join(PLAINER.values()) + "')"


@query(f"SELECT facility_row_id, replace({SEPARATORS_SQL.format(c=repair_sql('facility_name'))}, chr(1), chr(39)) AS name, {repair_sql('decision_maker_last_name')} AS last FROM {MASTER}")
def mojibake_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, MASTER).select("facility_row_id", "facility_name", "decision_maker_last_name")
    return rows.select("facility_row_id", T.normalize_separators("facility_name").alias("name"), T.repair_mojibake("decision_maker_last_name").alias("last"))


ENTITY_SQL = "MAP {" + ", ".join(f"'{k}': '" + v.replace("'", "''") + "'" for k, v in ENTITIES.items()) + "}"


def decode_sql(c: str) -> str:
    code = "CASE WHEN starts_with(lower(p), '&#x') THEN CAST(TRY_CAST('0x' || p[4:-2] AS INT) AS INT) ELSE TRY_CAST(p[3:-2] AS INT) END"
    one = f"CASE WHEN starts_with(p, '&#') THEN coalesce(CASE WHEN {code} BETWEEN 1 AND 1114111 THEN chr({code}) END, p) WHEN starts_with(p, '&') AND length(p) > 1 THEN coalesce({ENTITY_SQL}[lower(p[2:-2])], p) ELSE p END"
    pieces = f"regexp_extract_all(coalesce({c}, ''), '&(?:#x[0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);|[^&]+|&')"
    return f"trim(regexp_replace(array_to_string(list_transform({pieces}, lambda p: {one}), ''), '[\\s\\x0B\\x{{a0}}\\x{{2007}}\\x{{202f}}\\x{{200b}}\\x{{3000}}\\x{{feff}}]+', ' ', 'g'), ' ')"


@query(f"SELECT doc_id, {decode_sql('text')} AS text FROM documents")
def entity_decode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.decode_entities("text").alias("text"))


BLOCKS_SQL = "(?i)<br\\s*/?>|</?(p|div|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|title|option|address|blockquote|dd|dt|dl|form)\\b[^>]*>"
HIDDEN_SQL = "(?is)" + "|".join(f"<{w}\\b.*?</{w}\\s*>" for w in ("script", "style", "noscript", "template")) + "|<!--.*?-->"


@query(f"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '{HIDDEN_SQL}', ' ', 'g'), '{BLOCKS_SQL}', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM documents)
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: {decode_sql("x")}), lambda x: x <> ''), chr(10)) AS text FROM c""")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.html_to_text("text").alias("text"))


@query(f"""WITH p AS (SELECT facility_row_id, regexp_replace(strip_accents(lower(coalesce(decision_maker_first_name, ''))), '[^a-z]', '', 'g') AS f,
 regexp_replace(strip_accents(lower(coalesce(decision_maker_last_name, ''))), '[^a-z]', '', 'g') AS l, regexp_replace(lower(coalesce(email_domain, '')), '^www\\.', '') AS dom FROM {MASTER}),
g AS (SELECT facility_row_id, unnest([struct_pack(r := 1, e := f || '@' || dom), struct_pack(r := 2, e := f || '.' || l || '@' || dom), struct_pack(r := 3, e := f || l || '@' || dom),
 struct_pack(r := 4, e := f[1] || l || '@' || dom), struct_pack(r := 5, e := f[1] || '.' || l || '@' || dom), struct_pack(r := 6, e := f || l[1] || '@' || dom)]) AS x FROM p WHERE f <> '' AND l <> '' AND dom <> '')
SELECT facility_row_id, x.r AS pattern_rank, x.e AS email FROM g""")
def guess_patterns(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, MASTER).select("facility_row_id", F.posexplode(X.guess_emails("decision_maker_first_name", "decision_maker_last_name", "email_domain")).alias("pos", "email"))
    return rows.filter("email <> ''").select("facility_row_id", (F.col("pos") + 1).alias("pattern_rank"), "email")


REDIRECTS = (
    (1, "https://www.bing.com/ck/a?!&&p=1&u=a1aHR0cHM6Ly9ycXVldC50ZXN0L2NvdXJ0cz9hPTE&ntb=1"), (2, "https://duckduckgo.com/l/?uddg=https%3A%2F%2Fclub.test%2Fx&rut=1"),
    (3, "https://r.search.yahoo.com/_ylt=1/RU=https%3a%2f%2fhall.test%2f/RK=2/RS=3"), (4, "https://www.bing.com/ck/a?u=a1%%%"), (5, "https://plain.test/a?b=c"), (6, "not a url"), (7, ""),
    (8, "https://duckduckgo.com/l/?uddg=javascript%3Aalert"),
)


@query("""SELECT * FROM (VALUES (1, 'https://rquet.test/courts?a=1'), (2, 'https://club.test/x'), (3, 'https://hall.test/'), (4, ''), (5, 'https://plain.test/a?b=c'), (6, ''), (7, ''), (8, '')) v(id, target)""")
def redirect_unwrap(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(REDIRECTS, "id int, url string").select("id", U.unwrap_redirect("url").alias("target"))


@query(f"SELECT facility_row_id, CASE WHEN regexp_matches(website, '(?i)^https?://') THEN website ELSE '' END AS target FROM {MASTER}")
def redirect_unwrap_all(spark: SparkSession, d: str) -> DataFrame:
    """Every website of the master, wrapped as a search engine wraps its hits."""
    rows = table(spark, d, MASTER).select("facility_row_id", F.concat(F.lit("https://duckduckgo.com/l/?uddg="), F.url_encode(F.coalesce("website", F.lit(""))), F.lit("&rut=1")).alias("url"))
    return rows.select("facility_row_id", U.unwrap_redirect("url").alias("target"))


# ---------------------------------------------------------------- facts from text


@query(f"""WITH u AS (SELECT facility_row_id, email_domain AS host, unnest(source_urls) AS href, unnest(range(1, len(source_urls) + 1)) AS pos FROM {MASTER} WHERE source_urls IS NOT NULL AND email_domain IS NOT NULL),
k AS (SELECT facility_row_id, regexp_replace(regexp_extract(href, '(?i)^(https?://[^?#]*)', 1), '/$', '') AS page, min(pos) AS pos FROM u
 WHERE regexp_replace(lower(regexp_extract(href, '(?i)^https?://([^/?#]*)', 1)), '^www\\.', '') = host AND regexp_matches(regexp_extract(href, '(?i)^https?://[^/?#]*([^?#]*)', 1) || ' ',
 '(?i)contact|about|staff|our[-\\s]?team|leadership|management|directory|who[-\\s]?we[-\\s]?are|meet[-\\s]?the|administration|membership|facilit|courts?|rentals?|programs?|athletics') GROUP BY 1, 2)
SELECT facility_row_id, page, row_number() OVER (PARTITION BY facility_row_id ORDER BY pos) AS place FROM k QUALIFY place <= 2""")
def subpage_pick(spark: SparkSession, d: str) -> DataFrame:
    links = F.transform("source_urls", lambda u: F.struct(u.alias("href"), F.lit("").alias("text")))
    rows = table(spark, d, MASTER).filter("source_urls is not null and email_domain is not null")
    rows = rows.select("facility_row_id", F.posexplode(X.pick_subpages(links, "email_domain", 2)).alias("pos", "page"))
    return rows.select("facility_row_id", "page", (F.col("pos") + 1).alias("place"))


EMAIL_SQL = "list_filter(list_distinct(list_transform(regexp_extract_all({c}, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}\\b'), lambda e: lower(e))), lambda e: NOT regexp_matches(e, '\\.(png|jpe?g|gif|svg|webp|css|js)$|^[0-9a-f]{{16,}}@|@(example|domain|yourdomain|email|sentry|sentry\\.io|wixpress|godaddy|squarespace|wix)\\.|^(no-?reply|donotreply|postmaster|abuse|webmaster)@'))"


@query(f"SELECT doc_id, unnest({EMAIL_SQL.format(c='text')}) AS email FROM documents WHERE text IS NOT NULL")
def email_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(X.emails("text")).alias("email"))


@query(f"""WITH e AS (SELECT facility_row_id, coalesce(email_domain, '') AS dom, lower(coalesce(facility_name, '')) AS nm, unnest(list_distinct(list_filter([lower(public_direct_email), lower(shared_facility_email)], lambda x: x IS NOT NULL))) AS email FROM {MASTER}),
h AS (SELECT *, CASE WHEN contains(email, '@') THEN split_part(email, '@', 2) ELSE '' END AS host, array_to_string(list_slice(string_split(dom, '.'), greatest(len(string_split(dom, '.')) - 1, 1), len(string_split(dom, '.'))), '.') AS apex,
 list_filter(list_concat(regexp_split_to_array(lower(regexp_replace(dom, '\\.[a-z.]+$', '')), '[^a-z]+'), regexp_split_to_array(nm, '[^a-z]+')), lambda w: length(w) >= 5 AND w NOT IN ('tennis', 'sports', 'court', 'courts', 'clubs', 'center', 'centre')) AS brands FROM e)
SELECT facility_row_id, email, replace(replace(replace(split_part(email, '@', 1), '.', ' '), '_', ' '), '-', ' ') IN ({quoted(SHARED_LOCALS)}) AS shared FROM h
WHERE host <> '' AND (host = dom OR host = apex OR suffix(host, '.' || apex) OR host IN ({quoted(FREE_MAIL_SEEN)}) OR len(list_filter(brands, lambda b: contains(regexp_replace(regexp_replace(host, '\\.[a-z.]+$', ''), '[^a-z]', '', 'g'), b))) > 0)""")
def email_classify(spark: SparkSession, d: str) -> DataFrame:
    both = F.array_distinct(F.filter(F.array(F.lower("public_direct_email"), F.lower("shared_facility_email")), lambda e: e.isNotNull()))
    rows = table(spark, d, MASTER).select("facility_row_id", X.classify_emails(both, "email_domain", "facility_name").alias("c"))
    tag = lambda arr, s: F.transform(arr, lambda e: F.struct(e.alias("email"), F.lit(s).alias("shared")))
    return rows.select("facility_row_id", F.explode(F.concat(tag(F.col("c.shared_all"), True), tag(F.col("c.direct"), False))).alias("x")).select("facility_row_id", "x.email", "x.shared")


@query(f"SELECT doc_id, unnest(list_filter([{quoted(SPORTS)}], lambda s: contains(lower(text), s))) AS sport FROM documents WHERE text IS NOT NULL")
def term_detect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(X.sports("text")).alias("sport"))


@query(f"""SELECT doc_id, regexp_matches(t, '(?i)\\b({re2(INDOOR)})\\b') AS indoor, regexp_matches(t, '(?i)\\b({re2(OUTDOOR)})\\b') AS outdoor, regexp_matches(t, '(?i)\\b(outdoor[-\\s]only)\\b') AS outdoor_only,
 regexp_matches(t, '(?i)\\b({re2(PAID)})\\b') AS paid FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def indoor_signals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.indoor_signals("text").alias("s"), X.looks_monetized("text").alias("paid")).select("doc_id", "s.*", "paid")


@query(f"""SELECT doc_id, {" + ".join(f"CAST(regexp_matches(t, '(?i)\\b({s})\\b') AS INT)" for s in RETAIL_SIGNALS + ("court time", "league", "lessons?", "members", "court"))} AS signals
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def signal_threshold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.signal_count("text", RETAIL_SIGNALS + ("court time", "league", "lessons?", "members", "court")).alias("signals"))


NUM = "(\\d{1,3}|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|fourteen|sixteen|twenty)"
COUNT_FORMS = (f"{NUM}\\s+(?:indoor\\s+)?(?:{'|'.join(SPORTS)})\\s+courts?\\b", f"{NUM}\\s+indoor\\s+courts?\\b", f"{NUM}\\s+courts?\\b", f"courts?\\s*[:–—-]\\s*{NUM}\\b")
WORD_VALUES = "MAP {'one': 1, 'two': 2, 'three': 3, 'four': 4, 'five': 5, 'six': 6, 'seven': 7, 'eight': 8, 'nine': 9, 'ten': 10, 'eleven': 11, 'twelve': 12, 'fourteen': 14, 'sixteen': 16, 'twenty': 20}"


@query(f"""WITH t AS (SELECT doc_id, regexp_replace(text, '[\\s\\x{{a0}}\\x{{feff}}]+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, {", ".join(f"lower(regexp_extract(t, '(?i){f}', 1)) AS r{i}" for i, f in enumerate(COUNT_FORMS))} FROM t),
n AS (SELECT doc_id, {", ".join(f"coalesce(try_cast(r{i} AS INT), {WORD_VALUES}[r{i}]) AS n{i}" for i in range(4))} FROM r)
SELECT doc_id, coalesce({", ".join(f"CASE WHEN n{i} BETWEEN 1 AND 200 THEN n{i} END" for i in range(4))}, 0) AS courts FROM n""")
def count_detect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.coalesce(X.court_count("text")["count"], F.lit(0)).alias("courts"))


def first_rule_sql(c: str, rules, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '(?i){re2(p)}') THEN '{label}'" for p, label in rules) + f" ELSE '{otherwise}' END"


@query(f"""SELECT facility_row_id, CASE WHEN a <> '' THEN a ELSE {first_rule_sql("n || chr(10)", TEXT_KINDS, "Unknown")} END AS kind
FROM (SELECT facility_row_id, n, {first_rule_sql("n", NAME_KINDS, "")} AS a FROM (SELECT facility_row_id, coalesce(facility_name, '') AS n FROM {MASTER}))""")
def type_rules(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", X.facility_kind("facility_name", F.lit("")).alias("kind"))


@query(f"""SELECT track_row_id, CASE WHEN a <> '' THEN a ELSE {first_rule_sql("n || chr(10) || substr(b, 1, 3000)", TEXT_KINDS, "Unknown")} END AS kind
FROM (SELECT track_row_id, n, b, {first_rule_sql("n", NAME_KINDS, "")} AS a FROM (SELECT track_row_id, coalesce(company_name, '') AS n, concat_ws(' ', primary_type, fit_notes) AS b FROM {OUTREACH}))""")
def type_rules_text(spark: SparkSession, d: str) -> DataFrame:
    """Kinds where the name gives none and the text around it has to."""
    return table(spark, d, OUTREACH).select("track_row_id", X.facility_kind("company_name", F.concat_ws(" ", "primary_type", "fit_notes")).alias("kind"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(h, '(?i)\\b(town|city|village|county) of\\b') THEN '\\b(town|city|village|county) of\\b' WHEN regexp_matches(h, '(?i)\\bparks? (and|&) rec(reation)?\\b') THEN '\\bparks? (and|&) rec(reation)?\\b'
 WHEN regexp_matches(h, '(?i)\\bdepartment of parks\\b') THEN '\\bdepartment of parks\\b' WHEN regexp_matches(h, '(?i)\\bmunicipal\\b') THEN '\\bmunicipal\\b' WHEN regexp_matches(h, '(?i)\\bhomeowners?,? association\\b') THEN '\\bhomeowners?,? association\\b'
 WHEN regexp_matches(h, '\\bHOA\\b') THEN '\\bHOA\\b' WHEN regexp_matches(h, '(?i)\\bapartment (homes|community|living)\\b') THEN '\\bapartment (homes|community|living)\\b'
 WHEN regexp_matches(h, '(?i)\\bresidences?\\b[^\\n\\r]*\\bamenit') THEN '\\bresidences?\\b.*\\bamenit' WHEN regexp_matches(h, '(?i)\\bpublic (park|courts?)\\b') THEN '\\bpublic (park|courts?)\\b'
 WHEN regexp_matches(h, '(?i)\\bfree (to the )?public\\b') THEN '\\bfree (to the )?public\\b' ELSE '' END AS excluded_by FROM (SELECT doc_id, coalesce(source, '') || chr(10) || substr(coalesce(text, ''), 1, 4000) AS h FROM documents)""")
def exclude_rule(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.excluded_by("source", "text").alias("excluded_by"))


@query(f"""WITH t AS (SELECT track_row_id, regexp_replace(coalesce(address, '') || ' ' || coalesce(phone, ''), '[\\s\\x{{a0}}\\x{{feff}}]+', ' ', 'g') AS t FROM {OUTREACH})
SELECT track_row_id, CASE WHEN regexp_matches(t, '(?i),\\s*(?:NY|New York)\\b') THEN 'address' WHEN regexp_matches(t, '\\bNY\\s+1\\d{{4}}\\b') THEN 'zip'
 WHEN regexp_matches(t, '\\(?(212|315|332|347|516|518|585|607|631|646|680|716|718|838|845|914|917|929|934)\\)?[)\\s.-]{{1,3}}\\d{{3}}[\\s.-]?\\d{{4}}') THEN 'phone' WHEN regexp_matches(t, '(?i)\\bNew York (?:State|City)\\b') THEN 'mention' ELSE '' END AS evidence FROM t""")
def location_evidence(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", F.coalesce("address", F.lit("")), F.coalesce("phone", F.lit("")))
    return table(spark, d, OUTREACH).select("track_row_id", X.location_evidence(text).alias("evidence"))


STREET_FORM = (
    f"(\\d{{1,6}}[A-Za-z]?\\s+[A-Za-z0-9.''`\\-\\s]{{2,40}}?(?:{'|'.join(STREET_SUFFIXES)})\\.?)(?:\\s*,?\\s*(?:Suite|Ste|Unit|Bldg|Building|Floor|Fl)\\.?\\s*[A-Za-z0-9_-]+)?"
    "\\s*,\\s*([A-Z][A-Za-z.''\\-]*(?:\\s+[A-Z][A-Za-z.''\\-]*){0,2})\\s*,\\s*(?:NY|New York)\\b\\s*(\\d{5})?"
)


@query(f"""WITH t AS (SELECT track_row_id, regexp_replace(address, '[\\s\\x{{a0}}\\x{{feff}}]+', ' ', 'g') AS t FROM {OUTREACH} WHERE address IS NOT NULL),
x AS (SELECT track_row_id, unnest(regexp_extract_all(t, '{STREET_FORM}', 1)) AS street, unnest(regexp_extract_all(t, '{STREET_FORM}', 2)) AS c, unnest(list_transform(regexp_extract_all(t, '{STREET_FORM}', 3), lambda z: coalesce(z, ''))) AS zip, unnest(range(1, len(regexp_extract_all(t, '{STREET_FORM}')) + 1)) AS pos FROM t),
n AS (SELECT track_row_id, pos, trim(regexp_replace(street, '\\s+', ' ', 'g'), ' ') AS street, trim(regexp_replace(trim(c, ' '), '[.''’-]+$', ''), ' ') AS c, zip FROM x),
k AS (SELECT *, CASE WHEN regexp_matches(c, '(?i)^(nyc|new york city|n\\.?y\\.?c\\.?)$') THEN 'New York' WHEN c = upper(c) THEN array_to_string(list_transform(regexp_extract_all(lower(c), '[a-z0-9_]+|[^a-z0-9_]+'), lambda p: upper(p[1]) || p[2:]), '') ELSE c END AS city FROM n)
SELECT track_row_id, street, city, zip FROM k WHERE length(city) BETWEEN 3 AND 28 AND NOT regexp_matches(city, '(?i)\\b({"|".join(STREET_WORDS)})\\b') AND length(street) <= 60
QUALIFY row_number() OVER (PARTITION BY track_row_id, lower(street) || '|' || zip ORDER BY pos) = 1""")
def address_detect(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, OUTREACH).select("track_row_id", F.explode(X.addresses("address")).alias("a"))
    return rows.select("track_row_id", "a.street", "a.city", "a.zip")


@query()
def city_detect(spark: SparkSession, d: str) -> DataFrame:
    from pagelode.plans.enrich import known_cities

    sites = table(spark, d, OUTREACH).select(F.col("track_row_id").alias("site"), F.col("address").alias("text"))
    return known_cities(sites, table(spark, d, "city_list").select(F.col("city_name").alias("place"))).select(F.col("site").alias("track_row_id"), "city")


@query()
def people_extract(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, OUTREACH).select("track_row_id", F.concat_ws("\n", F.concat_ws(" - ", "contact_name", "contact_title"), "contact_name").alias("text"))
    return rows.select("track_row_id", F.explode(X.people("text")).alias("p")).select("track_row_id", "p.*")


@query(f"""WITH r AS (SELECT facility_row_id, 'Home | ' || replace(replace(coalesce(facility_name, ''), '<', ''), '&amp;', '&') AS t FROM {MASTER}), s AS (SELECT facility_row_id, replace({SEPARATORS_SQL.format(c=repair_sql('t'))}, chr(1), chr(39)) AS s FROM r),
p AS (SELECT facility_row_id, list_filter(list_transform(string_split_regex({decode_sql('s')}, '\\s+[|–—-]\\s+'), lambda x: trim(x, ' ')), lambda x: x <> '') AS p FROM s)
SELECT facility_row_id, coalesce(list_filter(p, lambda x: NOT regexp_matches(x, '(?i){GENERIC_TITLES}'))[1], p[1], '') AS title FROM p""")
def page_title(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<html><head><title>Home | "), F.replace(F.replace(F.coalesce("facility_name", F.lit("")), F.lit("<"), F.lit("")), F.lit("&amp;"), F.lit("&")), F.lit("</title></head><body/></html>"))
    return table(spark, d, MASTER).select("facility_row_id", X.page_title(page).alias("title"))


@query(f"""WITH u AS (SELECT facility_row_id, regexp_extract(website, '^(https?://[^/?#]*)', 1) AS root, regexp_replace(regexp_replace(website, '[?#].*$', ''), '^https?://[^/]*', '') AS page, unnest(source_urls) AS u, unnest(range(0, len(source_urls))) AS pos FROM {MASTER} WHERE regexp_matches(website, '^https?://[^/]')),
h AS (SELECT *, regexp_replace(u, '^https?://[^/]*', '') AS path FROM u)
SELECT facility_row_id, pos, root || CASE WHEN path <> '' THEN path WHEN page = '' THEN '/' ELSE regexp_replace(page, '[^/]*$', '') END AS href, 'see page' AS text FROM h""")
def link_explode(spark: SparkSession, d: str) -> DataFrame:
    page = F.array_join(F.transform("source_urls", lambda u: F.concat(F.lit('<a class="x" href="'), F.regexp_replace(u, "^https?://[^/]*", ""), F.lit('">see <b>page</b></a>'))), "\n")
    rows = table(spark, d, MASTER).filter("source_urls is not null and website rlike '^https?://[^/]'").select("facility_row_id", F.posexplode(X.links(page, "website")).alias("pos", "l"))
    return rows.select("facility_row_id", "pos", "l.href", "l.text")


@query(f"""SELECT DISTINCT decision_maker_first_name AS first, decision_maker_last_name AS last, coalesce(regexp_matches(f, '^[A-Za-z][A-Za-z''’.-]*$') AND length(regexp_replace(f, '[^A-Za-z]', '', 'g')) >= 2 AND NOT regexp_matches(fb, '(?i)^({"|".join(HONORIFICS)})\\.?$')
 AND lower(fb) NOT IN ({quoted(NOT_A_PERSON)}) AND regexp_matches(l, '^[A-Za-z][A-Za-z''’.-]*$') AND length(regexp_replace(l, '[^A-Za-z]', '', 'g')) >= 2 AND NOT regexp_matches(lb, '(?i)^({"|".join(HONORIFICS)})\\.?$') AND lower(lb) NOT IN ({quoted(NOT_A_PERSON)}), false) AS confirmed
FROM (SELECT *, regexp_replace(f, '(?i)[''’]s$', '') AS fb, regexp_replace(l, '(?i)[''’]s$', '') AS lb FROM (SELECT decision_maker_first_name, decision_maker_last_name, trim(coalesce(decision_maker_first_name, ''), ' ') AS f, trim(coalesce(decision_maker_last_name, ''), ' ') AS l FROM {CANDIDATES}))""")
def name_confirmed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, CANDIDATES).select(F.col("decision_maker_first_name").alias("first"), F.col("decision_maker_last_name").alias("last")).distinct()
    return rows.withColumn("confirmed", X.name_is_confirmed("first", "last"))


@query(f"""WITH p AS (SELECT facility_row_id, lower(public_direct_email) AS e, regexp_replace(lower(decision_maker_first_name), '[^a-z]', '', 'g') AS f, regexp_replace(lower(decision_maker_last_name), '[^a-z]', '', 'g') AS l
 FROM {MASTER} WHERE decision_maker_first_name IS NOT NULL AND decision_maker_last_name IS NOT NULL AND public_direct_email IS NOT NULL), q AS (SELECT *, regexp_replace(split_part(e, '@', 1), '[^a-z]', '', 'g') AS lp FROM p)
SELECT facility_row_id, CASE WHEN lp <> '' AND (lp = f || l OR lp = l || f OR lp = f[1] || l OR lp = f || l[1] OR (length(l) >= 4 AND contains(lp, l)) OR (length(f) >= 4 AND lp = f)) THEN e ELSE '' END AS email FROM q""")
def email_match(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, MASTER).filter("decision_maker_first_name is not null and decision_maker_last_name is not null and public_direct_email is not null")
    one = F.array(F.struct(F.col("decision_maker_first_name").alias("first"), F.col("decision_maker_last_name").alias("last"), F.lit("").alias("title"), F.lit(0).alias("rank")))
    hit = X.match_emails_to_people(one, F.array(F.lower("public_direct_email")))
    return rows.select("facility_row_id", F.get(hit, F.lit(0))["email"].alias("email"))


@query(f"""SELECT facility_row_id, array_to_string(list_filter([secure, CASE WHEN 'https://www.' || dom <> secure AND dom <> '' THEN 'https://www.' || dom END, CASE WHEN w <> secure AND w <> 'https://www.' || dom THEN w END], lambda x: x IS NOT NULL AND x <> ''), ' ') AS attempts
FROM (SELECT facility_row_id, coalesce(website, '') AS w, regexp_replace(coalesce(website, ''), '(?i)^http://', 'https://') AS secure, coalesce(email_domain, '') AS dom FROM {MASTER})""")
def url_attempts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", F.array_join(U.attempts("website", "email_domain"), " ").alias("attempts"))


@query(f"""SELECT facility_row_id, concat_ws(' ', CASE WHEN coalesce(decision_maker_last_name, '') = '' THEN 'No person found.' END, CASE WHEN number_of_courts IS NULL THEN 'No count stated.' ELSE number_of_courts || ' counted.' END, research_notes) AS notes FROM {MASTER}""")
def notes_assembly(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("number_of_courts")
    told = X.notes((A.full("decision_maker_last_name") == "", F.lit("No person found.")), (n.isNull(), F.lit("No count stated.")), (n.isNotNull(), F.concat(n.cast("string"), F.lit(" counted."))), (F.col("research_notes").isNotNull(), F.col("research_notes")))
    return table(spark, d, MASTER).select("facility_row_id", told.alias("notes"))


# ---------------------------------------------------------------- reductions by key


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY rn) AS types FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type <> '') WHERE rn <= 12 GROUP BY user_id""")
def capped_collect(spark: SparkSession, d: str) -> DataFrame:
    return K.capped_collect(table(spark, d, "events"), "user_id", "event_id", ["event_type"]).select("user_id", F.array_join("event_type", ",").alias("types"))


@query("""WITH s AS (SELECT list_sort(list(DISTINCT event_type)) AS s FROM events), r AS (SELECT e.*, (list_position(s.s, event_type) - 1 - user_id % len(s.s) + len(s.s)) % len(s.s) AS r FROM events e, s)
SELECT event_id, user_id, event_type FROM r QUALIFY r = min(r) OVER (PARTITION BY user_id)""")
def engine_failover(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    kinds = K.bounded_values(events, "event_type")
    return K.first_source(events, "user_id", "event_type", kinds, F.col("user_id")).select("event_id", "user_id", "event_type")


@query(f"""WITH h AS (SELECT track_row_id AS o, {HOST} AS domain, company_name, fit_notes, batch_label FROM {OUTREACH}), k AS (SELECT * FROM h WHERE domain <> '' AND NOT regexp_matches(domain, '{"|".join(w.replace(".", "[.]") for w in sorted(set(LISTING_HOSTS)))}') AND NOT regexp_matches(domain, '(?i)\\.(gov|mil|ny\\.us)$'))
SELECT domain, 'https://' || domain AS url, array_to_string(list_slice(coalesce(list(company_name ORDER BY o) FILTER (company_name <> ''), []), 1, 12), ' | ') AS titles, array_to_string(list_slice(coalesce(list(fit_notes ORDER BY o) FILTER (fit_notes <> ''), []), 1, 12), ' | ') AS snippets,
 array_to_string(list_slice(coalesce(list(batch_label ORDER BY o) FILTER (batch_label <> ''), []), 1, 12), ' | ') AS queries FROM k GROUP BY domain""")
def site_discovery(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, OUTREACH).select(F.col("track_row_id").alias("ord"), F.col("website").alias("url"), F.col("company_name").alias("title"), F.col("fit_notes").alias("snippet"), F.col("batch_label").alias("query"))
    sites = candidate_sites(hits)
    return sites.select("domain", "url", *[F.array_join(c, " | ").alias(c) for c in ("titles", "snippets", "queries")])


@query(f"""SELECT facility_row_id, CASE WHEN NOT own THEN 'no site' WHEN courts IS NULL AND mails = 0 THEN 'bare' WHEN courts >= 10 OR mails >= 2 THEN 'rich' WHEN mails = 1 THEN 'reachable' ELSE 'counted' END AS class
FROM (SELECT facility_row_id, coalesce(email_domain, '') <> '' AS own, number_of_courts AS courts, CAST(coalesce(public_direct_email, '') <> '' AS INT) + CAST(coalesce(shared_facility_email, '') <> '' AS INT) AS mails FROM {MASTER})""")
def decision_list(spark: SparkSession, d: str) -> DataFrame:
    has = [A.full(c) != "" for c in ("public_direct_email", "shared_facility_email")]
    courts = F.col("number_of_courts")
    rules = [
        (A.full("email_domain") == "", F.lit("no site")), (courts.isNull() & ~rules_.at_least(has, 1), F.lit("bare")), ((courts >= 10) | rules_.at_least(has, 2), F.lit("rich")), (rules_.at_least(has, 1), F.lit("reachable")),
    ]
    return table(spark, d, MASTER).select("facility_row_id", rules_.decision_list(rules, F.lit("counted")).alias("class"))


@query("""SELECT c.city_id AS market_ord, t.title_id AS template_ord, 'find ' || title_name || ' in ' || city_name AS query FROM city_list c, title_list t""")
def fanout_cross(spark: SparkSession, d: str) -> DataFrame:
    markets = table(spark, d, "city_list").select(F.col("city_name").alias("market"), F.col("city_id").alias("market_ord"))
    templates = table(spark, d, "title_list").select(F.concat(F.lit("find "), "title_name", F.lit(" in {m}")).alias("template"), F.col("title_id").alias("template_ord"))
    return K.fan_out(markets, templates)


@query(f"SELECT DISTINCT facility_id, company_domain FROM {CANDIDATES} c WHERE facility_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {PLACES} p WHERE p.facility_id = c.facility_id)")
def resume_antijoin(spark: SparkSession, d: str) -> DataFrame:
    todo = table(spark, d, CANDIDATES).filter("facility_id is not null").select("facility_id", "company_domain").distinct()
    return K.not_done(todo, table(spark, d, PLACES).filter("facility_id is not null"), "facility_id")


@query("""SELECT o_custkey, o_orderkey, o_totalprice, first_order FROM (SELECT *, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_order, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(floor(o_totalprice / 10) AS BIGINT) DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def richest_row(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return K.richest_per_key(orders, F.col("o_custkey"), F.floor(F.col("o_totalprice") / 10), "o_orderkey")


@query(f"""SELECT candidate_row_id, candidate_email AS email, claimed_by FROM (SELECT candidate_row_id, lower(candidate_email) AS candidate_email, min(candidate_row_id) OVER (PARTITION BY lower(candidate_email)) AS claimed_by FROM {CANDIDATES} WHERE candidate_email IS NOT NULL)""")
def first_claim(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, CANDIDATES).select("candidate_row_id", F.lower("candidate_email").alias("email"))
    return K.first_claim(rows, "email", "candidate_row_id")


@query("""SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS o FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, o) = 1""")
def mode_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return K.first_mode(table(spark, d, "events"), "user_id", "event_type", "event_id")


@query(f"SELECT qualification_status, count(*) AS n FROM {MASTER} GROUP BY 1")
def status_tally(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).groupBy("qualification_status").agg(F.count("*").alias("n"))


@query(f"""WITH r AS (SELECT company_domain, lower(candidate_email) AS e, min(CASE WHEN regexp_matches(split_part(lower(candidate_email), '@', 1), '^({"|".join(sorted(ROLE_LOCALS, key=lambda w: (-len(w), w)))})\\b') THEN 0 WHEN regexp_matches(split_part(lower(candidate_email), '@', 1), '^[a-z]+[._-][a-z]+$') THEN 1
 WHEN regexp_matches(split_part(lower(candidate_email), '@', 1), '^[a-z]\\.?[a-z]{{3,}}$') THEN 2 ELSE 3 END) AS rank FROM {CANDIDATES} WHERE candidate_email IS NOT NULL AND company_domain IS NOT NULL GROUP BY 1, 2)
SELECT company_domain, e AS email, rank, row_number() OVER (PARTITION BY company_domain ORDER BY rank, e) AS place FROM r QUALIFY place <= 3""")
def candidate_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, CANDIDATES).filter("candidate_email is not null and company_domain is not null").select("company_domain", F.lower("candidate_email").alias("email")).distinct()
    rows = rows.withColumn("rank", C.unattributed_rank(F.col("email")))
    place = F.row_number().over(W.partitionBy("company_domain").orderBy("rank", "email"))
    return rows.withColumn("place", place).filter("place <= 3")


@query("""SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice, place FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place FROM lineitem) WHERE place <= 3""")
def topk_per_part(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(W.partitionBy("l_partkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"))
    return table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("place", place).filter("place <= 3")


# ---------------------------------------------------------------- the master and what goes out


def master(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).withColumn("ord", F.col("facility_row_id"))


STATUSES = ["Confirmed Indoor", "Indoor and Outdoor", "Needs Review"]
SCORE = "(CASE WHEN coalesce(public_direct_email, '') <> '' THEN 4 ELSE 0 END + CASE WHEN coalesce(shared_facility_email, '') <> '' THEN 2 ELSE 0 END + CASE WHEN coalesce(decision_maker_last_name, '') <> '' THEN 2 ELSE 0 END + CASE WHEN number_of_courts IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN coalesce(city, '') <> '' THEN 1 ELSE 0 END)"
SITE_OF = HOST_SQL.format(c="trim(CASE WHEN coalesce(email_domain, '') <> '' THEN email_domain ELSE coalesce(website, '') END)")
NAME_KEY = f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(facility_name, '')), '[^a-z0-9]+', ' ', 'g'), '\\b({'|'.join(NAME_STOP_WORDS)})\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH h AS (SELECT *, {SITE_OF} AS h FROM {MASTER}), a AS (SELECT *, {apex_sql('h')} AS apex, {SCORE} AS score, {NAME_KEY} AS nk FROM h),
k AS (SELECT *, CASE WHEN apex <> '' THEN 'd:' || apex ELSE 'd:' || coalesce(website, '') END AS k1 FROM a),
p1 AS (SELECT *, min(facility_row_id) OVER (PARTITION BY k1) AS ord2, row_number() OVER (PARTITION BY k1 ORDER BY score DESC, facility_row_id) AS rn FROM k),
p2 AS (SELECT *, CASE WHEN nk <> '' THEN 'n:' || nk || '|' || lower(coalesce(city, '')) ELSE 'w:' || coalesce(website, '') END AS k2 FROM p1 WHERE rn = 1),
p3 AS (SELECT *, min(ord2) OVER (PARTITION BY k2) AS ord3, row_number() OVER (PARTITION BY k2 ORDER BY score DESC, ord2) AS rn2 FROM p2)
SELECT facility_row_id, score, ord3 FROM p3 WHERE rn2 = 1""")
def two_key_dedup(spark: SparkSession, d: str) -> DataFrame:
    return A.collapse(master(spark, d)).select("facility_row_id", F.col("__score").alias("score"), "ord3")


@query(f"""WITH r AS (SELECT facility_row_id, lower(coalesce(public_direct_email, '')) AS mail, {NAME_KEY} AS nk, {SCORE} AS score FROM {MASTER}),
f AS (SELECT *, first_value(CASE WHEN nk <> '' THEN nk END IGNORE NULLS) OVER (PARTITION BY mail ORDER BY score DESC, facility_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM r)
SELECT facility_row_id, coalesce(mail <> '' AND prior = nk, false) AS blanked FROM f""")
def contact_blank(spark: SparkSession, d: str) -> DataFrame:
    rows = master(spark, d).withColumns({"__score": A.richness(), "ord3": F.col("ord"), "had": A.full("public_direct_email") != ""})
    return A.blank_repeated_contacts(rows).select("facility_row_id", (F.col("had") & F.col("public_direct_email").isNull()).alias("blanked"))


@query(f"""WITH h AS (SELECT *, {SITE_OF} AS h, CASE WHEN contains(public_direct_email, '@') THEN split_part(public_direct_email, '@', 2) ELSE '' END AS dh, CASE WHEN contains(shared_facility_email, '@') THEN split_part(shared_facility_email, '@', 2) ELSE '' END AS sh FROM {MASTER}), a AS (SELECT *, {apex_sql('h')} AS apex FROM h)
SELECT facility_row_id, CASE WHEN coalesce(dh, '') <> '' AND dh NOT IN ({quoted(FREE_MAIL_FINAL)}) THEN dh WHEN coalesce(sh, '') <> '' AND sh NOT IN ({quoted(FREE_MAIL_FINAL)}) THEN sh WHEN apex IN ({quoted(FREE_MAIL_FINAL)}) THEN '' ELSE apex END AS mail_domain FROM a""")
def mail_domain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", A.mail_domain().alias("mail_domain"))


@query()
def normalize_master(spark: SparkSession, d: str) -> DataFrame:
    cols = ["facility_row_id", "public_direct_email", "shared_facility_email", "email_domain", "research_notes", *[f"guessed_email_{i}" for i in range(1, 7)]]
    return A.normalize_rows(master(spark, d)).select(*cols)


PUBLISHER_SQL = " OR ".join(f"regexp_matches(apex, '(?i){re2(p)}')" for p in PUBLISHER_DOMAINS)


@query(f"""WITH h AS (SELECT facility_row_id, coalesce(facility_name, '') AS n, {SITE_OF} AS h FROM {MASTER}), a AS (SELECT *, {apex_sql('h')} AS apex FROM h)
SELECT facility_row_id, apex <> '' AND ({PUBLISHER_SQL} OR regexp_matches(n, '^\\d{{2,3}}\\.\\d') OR regexp_matches(n, '(?i){MASTHEADS}') OR (regexp_matches(n, '(?i){WEAK_MASTHEADS}') AND NOT regexp_matches(n, '(?i){VENUE_WORDS}'))) AS publisher FROM a""")
def publisher_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", T.let(A.site(), lambda x: X.looks_like_publisher("facility_name", x)).alias("publisher"))


HOST_OF = "CASE WHEN contains({e}, '@') THEN split_part({e}, '@', 2) ELSE '' END"
FREE = quoted(FREE_MAIL_FINAL)


def ours_sql(h: str) -> str:
    label = f"regexp_replace(regexp_replace({h}, '\\.[a-z.]+$', ''), '[^a-z]', '', 'g')"
    return f"({h} <> '' AND ({h} = apex OR suffix({h}, '.' || apex) OR suffix(apex, '.' || {h}) OR {h} IN ({FREE}) OR len(list_filter(words, lambda w: contains({label}, w))) > 0))"


NORMAL_SQL = f"""h AS (SELECT *, coalesce(facility_name, '') AS n, {SITE_OF} AS h FROM {MASTER}), a AS (SELECT *, {apex_sql('h')} AS apex, coalesce({HOST_OF.format(e="public_direct_email")}, '') AS dh,
 coalesce({HOST_OF.format(e="shared_facility_email")}, '') AS sh, list_filter(regexp_split_to_array(lower(n), '[^a-z]+'), lambda w: length(w) >= 5 AND w NOT IN ({quoted(BRAND_STOP_WORDS)})) AS words FROM h),
p AS (SELECT *, apex <> '' AND ({PUBLISHER_SQL} OR regexp_matches(n, '^\\d{{2,3}}\\.\\d') OR regexp_matches(n, '(?i){MASTHEADS}') OR (regexp_matches(n, '(?i){WEAK_MASTHEADS}') AND NOT regexp_matches(n, '(?i){VENUE_WORDS}'))) AS publisher,
 coalesce(public_direct_email, '') <> '' AND NOT {ours_sql("dh")} AS bad_d, coalesce(shared_facility_email, '') <> '' AND NOT {ours_sql("sh")} AS bad_s FROM a),
s AS (SELECT facility_row_id, publisher, facility_name, website, city, number_of_courts, qualification_status, decision_maker_first_name AS f0, decision_maker_last_name, apex, CASE WHEN bad_d THEN NULL ELSE public_direct_email END AS public_direct_email,
 CASE WHEN bad_s THEN NULL ELSE shared_facility_email END AS shared_facility_email, CASE WHEN bad_d THEN '' ELSE dh END AS dh, CASE WHEN bad_s THEN '' ELSE sh END AS sh,
 CASE WHEN bad_d OR bad_s THEN trim(coalesce(research_notes, '') || ' Third-party email removed (not on facility domain).', ' ') ELSE coalesce(research_notes, '') END AS notes FROM p),
m AS (SELECT *, CASE WHEN dh <> '' AND dh NOT IN ({FREE}) THEN dh WHEN sh <> '' AND sh NOT IN ({FREE}) THEN sh WHEN apex IN ({FREE}) THEN '' ELSE apex END AS mail,
 regexp_replace(strip_accents(lower(coalesce(f0, ''))), '[^a-z]', '', 'g') AS f, regexp_replace(strip_accents(lower(coalesce(decision_maker_last_name, ''))), '[^a-z]', '', 'g') AS l, trim(regexp_replace(replace(notes, '{GUESS_NOTE}', ''), '\\s+', ' ', 'g'), ' ') AS bare FROM s),
g AS (SELECT *, regexp_replace(lower(mail), '^www\\.', '') AS md, coalesce(f0, '') <> '' AND coalesce(decision_maker_last_name, '') <> '' AND mail <> '' AND coalesce(public_direct_email, '') = '' AND f <> '' AND l <> '' AS named FROM m),
z AS (SELECT facility_row_id, publisher, facility_name, website, city, number_of_courts, qualification_status, decision_maker_last_name, public_direct_email, shared_facility_email, nullif(mail, '') AS email_domain,
 nullif(CASE WHEN named THEN trim(bare || ' {GUESS_NOTE}', ' ') ELSE bare END, '') AS research_notes, CASE WHEN named THEN f || '@' || md END AS guessed_email_1, CASE WHEN named THEN f || '.' || l || '@' || md END AS guessed_email_2, CASE WHEN named THEN f || l || '@' || md END AS guessed_email_3,
 CASE WHEN named THEN f[1] || l || '@' || md END AS guessed_email_4, CASE WHEN named THEN f[1] || '.' || l || '@' || md END AS guessed_email_5, CASE WHEN named THEN f || l[1] || '@' || md END AS guessed_email_6 FROM g)"""
GUESSES = ", ".join(f"guessed_email_{i}" for i in range(1, 7))
ORACLES["normalize_master"] = f"WITH {NORMAL_SQL} SELECT facility_row_id, public_direct_email, shared_facility_email, email_domain, research_notes, {GUESSES} FROM z"


@query(f"""WITH {NORMAL_SQL}, h2 AS (SELECT *, {SITE_OF} AS h, {SCORE} AS score, {NAME_KEY} AS nk FROM z WHERE NOT publisher), a2 AS (SELECT *, {apex_sql('h')} AS apex FROM h2),
k AS (SELECT *, 'd:' || CASE WHEN apex <> '' THEN apex ELSE coalesce(website, '') END AS k1 FROM a2),
p1 AS (SELECT *, min(facility_row_id) OVER (PARTITION BY k1) AS ord2, row_number() OVER (PARTITION BY k1 ORDER BY score DESC, facility_row_id) AS rn FROM k),
p2 AS (SELECT *, CASE WHEN nk <> '' THEN 'n:' || nk || '|' || lower(coalesce(city, '')) ELSE 'w:' || coalesce(website, '') END AS k2 FROM p1 WHERE rn = 1),
p3 AS (SELECT *, min(ord2) OVER (PARTITION BY k2) AS ord3, row_number() OVER (PARTITION BY k2 ORDER BY score DESC, ord2) AS rn2 FROM p2),
f AS (SELECT *, first_value(CASE WHEN nk <> '' THEN nk END IGNORE NULLS) OVER (PARTITION BY lower(coalesce(public_direct_email, '')) ORDER BY score DESC, ord3 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM p3 WHERE rn2 = 1),
b AS (SELECT *, coalesce(public_direct_email, '') <> '' AND coalesce(prior = nk, false) AS again FROM f)
SELECT facility_row_id, facility_name, website, city, qualification_status, CASE WHEN again THEN NULL ELSE public_direct_email END AS public_direct_email, shared_facility_email, email_domain,
 CASE WHEN again THEN trim(coalesce(research_notes, '') || ' Duplicate contact removed.', ' ') ELSE research_notes END AS research_notes, {GUESSES} FROM b""")
def finalize_master(spark: SparkSession, d: str) -> DataFrame:
    cols = ["facility_row_id", "facility_name", "website", "city", "qualification_status", "public_direct_email", "shared_facility_email", "email_domain", "research_notes", *[f"guessed_email_{i}" for i in range(1, 7)]]
    return A.finalize(master(spark, d), STATUSES).select(*cols)


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS facility_no, format('SU-{:04d}', row_number() OVER (ORDER BY s_suppkey)) AS facility_id FROM supplier")
def numbered_ids(spark: SparkSession, d: str) -> DataFrame:
    return A.numbered(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", "SU").select("s_suppkey", "facility_no", "facility_id")


MOST_PEOPLE = 8  # people of a site that the contact pass works on, as the program it follows does


def places_of(spark: SparkSession, d: str) -> DataFrame:
    """Places of a website, numbered from 1; each stays a row of its own."""
    rows = table(spark, d, PLACES).select(F.col("website").alias("extras_website"), "location_row_id", F.col("branch_street").alias("street"), F.col("branch_city").alias("city"), F.col("branch_zip").alias("zip"))
    return K.ranked_per_key(rows, "extras_website", "location_row_id", "place_no").drop("location_row_id")


def extras(spark: SparkSession, d: str) -> DataFrame:
    """Contact-pass records per website, made of the candidate and location tables, with the numbers of their addresses and places.

    A facility sends out its best three unclaimed direct addresses and its first three shared ones, and no more than MOST_PEOPLE people
    can claim one each: so the lists need no more than the best MOST_PEOPLE + 3 and the first 3, however many a website has."""
    rows = table(spark, d, CANDIDATES).filter("website is not null")
    who = rows.filter("decision_maker_first_name is not null and decision_maker_last_name is not null").groupBy("website", "decision_maker_first_name", "decision_maker_last_name").agg(F.min("candidate_row_id").alias("o"), F.max("decision_maker_title").alias("title"))
    top = who.withColumn("r", F.row_number().over(W.partitionBy("website").orderBy("o"))).filter(F.col("r") <= MOST_PEOPLE)
    person = F.struct("o", F.col("decision_maker_first_name").alias("first"), F.col("decision_maker_last_name").alias("last"), "title", F.lit("").alias("email"))
    people = top.groupBy("website").agg(F.transform(F.array_sort(F.collect_list(person)), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["title"].alias("title"), s["email"].alias("email"))).alias("people"))
    mail = rows.filter("candidate_email <> '' and email_candidate_type in ('Published Direct', 'Published Shared')")
    mail = mail.groupBy("website", "email_candidate_type", F.lower("candidate_email").alias("email")).agg(F.min("candidate_row_id").alias("o"))
    direct = F.col("email_candidate_type") == "Published Direct"
    place = F.struct(F.when(direct, C.unattributed_rank(F.col("email"))).otherwise(0).alias("r"), F.when(direct, 0).otherwise(F.col("o")).alias("o"), "email")
    best = mail.withColumn("p", place).withColumn("n", F.row_number().over(W.partitionBy("website", "email_candidate_type").orderBy("p"))).filter(F.col("n") <= F.when(direct, MOST_PEOPLE + 3).otherwise(3))
    listed = lambda which: F.transform(F.array_sort(F.collect_list(F.when(which, F.col("p")))), lambda s: s["email"])
    mails = best.groupBy("website").agg(listed(direct).alias("direct_emails"), listed(~direct).alias("shared_emails"))
    counted = mail.groupBy("website").agg(F.count_if(direct).alias("n_direct"), F.count_distinct("email").alias("n_mails"))
    seats = table(spark, d, PLACES).filter("website is not null").groupBy("website").agg(F.count("*").alias("n_locations"))
    first = rows.groupBy("website").agg(F.min("candidate_row_id").alias("ord"))
    out = first.join(people, "website", "left").join(mails, "website", "left").join(counted, "website", "left").join(seats, "website", "left")
    return out.withColumn("extras_website", F.col("website"))


def facilities_with_extras(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    index = C.contact_index(extras(spark, d), C.size_of("people") + n("n_locations") + n("n_direct"))
    return C.with_contacts(A.numbered(master(spark, d), "ord", "NY"), index)


KEPT = ["Confirmed Indoor", "Indoor and Outdoor"]


def kept_facilities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(facilities that go out, facilities to review)."""
    return rules_.split_by(facilities_with_extras(spark, d), "qualification_status", KEPT, ["Needs Review"])


def confirmed_sql(first: str, last: str) -> str:
    t = lambda c: f"trim(coalesce({c}, ''), ' ')"
    bare = lambda c: f"regexp_replace({t(c)}, '(?i)[''’]s$', '')"
    ok = lambda c: f"regexp_matches({t(c)}, '^[A-Za-z][A-Za-z''’.-]*$') AND length(regexp_replace({t(c)}, '[^A-Za-z]', '', 'g')) >= 2 AND NOT regexp_matches({bare(c)}, '(?i)^({'|'.join(HONORIFICS)})\\.?$') AND lower({bare(c)}) NOT IN ({quoted(NOT_A_PERSON)})"
    return f"({ok(first)} AND {ok(last)})"


def shown_sql(n: str) -> str:
    n = f"trim(coalesce({n}, ''), ' ')"
    return f"""(CASE WHEN {n} <> upper({n}) AND {n} <> lower({n}) THEN {n} ELSE array_to_string(list_transform(regexp_extract_all(lower({n}), '[^\\s''’-]*[\\s''’-]|[^\\s''’-]+$'),
 lambda p: CASE WHEN regexp_matches(p, '^[a-z]') THEN upper(p[1]) || p[2:] ELSE p END), '') END)"""


LOCAL = "split_part({e}, '@', 1)"
RANK_SQL = f"""(CASE WHEN regexp_matches({LOCAL}, '^({"|".join(sorted(ROLE_LOCALS, key=lambda w: (-len(w), w)))})\\b') THEN 0 WHEN regexp_matches({LOCAL}, '^[a-z]+[._-][a-z]+$') THEN 1 WHEN regexp_matches({LOCAL}, '^[a-z]\\.?[a-z]{{{{3,}}}}$') THEN 2 ELSE 3 END)"""
PLAIN_SQL = "regexp_replace(strip_accents(lower(coalesce({c}, ''))), '[^a-z]', '', 'g')"
# the contact index, the people and the candidate addresses of every facility
INDEX_SQL = f"""pw AS (SELECT website, decision_maker_first_name AS f, decision_maker_last_name AS l, min(candidate_row_id) AS o, max(decision_maker_title) AS title FROM {CANDIDATES} WHERE website IS NOT NULL AND decision_maker_first_name IS NOT NULL AND decision_maker_last_name IS NOT NULL GROUP BY 1, 2, 3),
pk AS (SELECT * FROM pw QUALIFY row_number() OVER (PARTITION BY website ORDER BY o) <= 8),
mw AS (SELECT website, email_candidate_type AS kind, lower(candidate_email) AS e, min(candidate_row_id) AS o FROM {CANDIDATES} WHERE website IS NOT NULL AND candidate_email <> '' AND email_candidate_type IN ('Published Direct', 'Published Shared') GROUP BY 1, 2, 3),
lw AS (SELECT website, count(*) AS n FROM {PLACES} WHERE website IS NOT NULL GROUP BY 1),
ew AS (SELECT {HOST} AS host, website, min(candidate_row_id) AS o, coalesce((SELECT count(*) FROM pk WHERE pk.website = c.website), 0) + coalesce((SELECT count(*) FROM mw WHERE mw.website = c.website AND kind = 'Published Direct'), 0) + coalesce((SELECT max(n) FROM lw WHERE lw.website = c.website), 0) AS weight
 FROM {CANDIDATES} c WHERE website IS NOT NULL GROUP BY website),
ix AS (SELECT host, website AS w FROM ew WHERE host <> '' QUALIFY row_number() OVER (PARTITION BY host ORDER BY weight DESC, o) = 1),
mm AS (SELECT *, {HOST} AS host, row_number() OVER (ORDER BY facility_row_id) AS no FROM {MASTER}),
fa AS (SELECT mm.*, w, format('NY-{{:04d}}', no) AS facility_id, coalesce((SELECT max(n) FROM lw WHERE lw.website = w), 0) AS n_loc FROM mm LEFT JOIN ix ON mm.host = ix.host)"""


def candidate_sql(which: str) -> str:
    """The common table expressions of the candidates of the facilities that hold which: all of them as ca, with their owners as cl."""
    six = ["f || '@' || d", "f || '.' || l || '@' || d", "f || l || '@' || d", "f[1] || l || '@' || d", "f[1] || '.' || l || '@' || d", "f || l[1] || '@' || d"]
    return f"""{INDEX_SQL}, fq AS (SELECT * FROM fa WHERE {which}),
pf AS (SELECT no, pk.f, pk.l, coalesce(pk.title, '') AS title, '' AS email, row_number() OVER (PARTITION BY no ORDER BY o) AS pos FROM fq JOIN pk ON pk.website = fq.w WHERE {confirmed_sql("pk.f", "pk.l")}),
po AS (SELECT no, trim(decision_maker_first_name, ' ') AS f, trim(decision_maker_last_name, ' ') AS l, coalesce(decision_maker_title, '') AS title, lower(coalesce(public_direct_email, '')) AS email, 1 AS pos FROM fq WHERE no NOT IN (SELECT no FROM pf) AND {confirmed_sql("decision_maker_first_name", "decision_maker_last_name")}),
pp AS (SELECT * FROM pf UNION ALL SELECT * FROM po),
pg AS (SELECT no, pos, pp.f AS first, pp.l AS last, pp.title, {PLAIN_SQL.format(c="pp.f")} AS f, {PLAIN_SQL.format(c="pp.l")} AS l, regexp_replace(lower(trim(coalesce(email_domain, ''), ' ')), '^www\\.', '') AS d FROM pp JOIN fq USING (no) WHERE pp.email = ''),
pc AS (SELECT no, 1 AS a, pos AS b, 0 AS k, email, 'Published Direct' AS type, CAST(NULL AS INT) AS rank, true AS published, f AS first, l AS last, title FROM pp WHERE email <> ''
 UNION ALL SELECT no, 1, pos, r, lower(e), 'Guessed Pattern ' || r, r, false, first, last, title FROM ({" UNION ALL ".join(f"SELECT no, pos, {i + 1} AS r, {e} AS e, first, last, title FROM pg WHERE f <> '' AND l <> '' AND d <> ''" for i, e in enumerate(six))})),
d0 AS (SELECT no, e FROM fq JOIN mw ON mw.website = fq.w AND kind = 'Published Direct' UNION ALL SELECT no, lower(public_direct_email) FROM fq WHERE coalesce(public_direct_email, '') <> '' AND (w IS NULL OR w NOT IN (SELECT website FROM mw WHERE kind = 'Published Direct'))),
d1 AS (SELECT no, e, row_number() OVER (PARTITION BY no ORDER BY {RANK_SQL.format(e="e")}, e) AS n FROM d0 WHERE NOT EXISTS (SELECT 1 FROM pp WHERE pp.no = d0.no AND pp.email = e)),
s0 AS (SELECT no, e, o FROM fq JOIN mw ON mw.website = fq.w AND kind = 'Published Shared' UNION ALL SELECT no, lower(shared_facility_email), 0 FROM fq WHERE coalesce(shared_facility_email, '') <> '' AND (w IS NULL OR w NOT IN (SELECT website FROM mw WHERE kind = 'Published Shared'))),
s1 AS (SELECT no, e, row_number() OVER (PARTITION BY no ORDER BY o) AS n FROM s0),
ca AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY a, b, k) - 1 AS candidate_no FROM (SELECT * FROM pc UNION ALL SELECT no, 2, n, 0, e, 'Published Direct', NULL, true, NULL, NULL, NULL FROM d1 WHERE n <= 3 UNION ALL SELECT no, 3, n, 0, e, 'Published Shared', NULL, true, NULL, NULL, NULL FROM s1 WHERE n <= 3)),
cl AS (SELECT *, first_value(no) OVER (PARTITION BY email ORDER BY no, candidate_no) AS owner_no, row_number() OVER (PARTITION BY email ORDER BY no, candidate_no) = 1 AS won FROM ca)"""


@query(f"WITH {INDEX_SQL} SELECT facility_row_id, w IS NOT NULL AND w IN (SELECT website FROM mw) AS found FROM fa")
def contact_join(spark: SparkSession, d: str) -> DataFrame:
    return facilities_with_extras(spark, d).select("facility_row_id", F.col("direct_emails").isNotNull().alias("found"))


@query(f"""WITH {candidate_sql("true")} SELECT facility_id, candidate_no, email, type, rank, published, trim(concat_ws(' ', {shown_sql("first")}, {shown_sql("last")}), ' ') AS decision_maker_full_name, title FROM cl JOIN fa USING (no) WHERE won""")
def candidate_fanout(spark: SparkSession, d: str) -> DataFrame:
    won, _ = C.fan_out_candidates(facilities_with_extras(spark, d))
    return won.select("facility_id", "candidate_no", "email", "type", "rank", "published", "decision_maker_full_name", "title")


@query(f"""WITH {candidate_sql("true")} SELECT no AS facility_no, candidate_no, email, owner_no FROM cl WHERE NOT won""")
def candidate_repeats(spark: SparkSession, d: str) -> DataFrame:
    _, again = C.fan_out_candidates(facilities_with_extras(spark, d))
    return again.select("facility_no", "candidate_no", "email", "owner_no")


SEATS_SQL = f"""se AS (SELECT website, coalesce(branch_street, '') AS street, coalesce(branch_city, '') AS bcity, coalesce(branch_zip, '') AS zip, row_number() OVER (PARTITION BY website ORDER BY location_row_id) AS pos FROM {PLACES} WHERE website IS NOT NULL),
br AS (SELECT fa.*, coalesce(pos, 1) AS pos, coalesce(street, '') AS branch_street, CASE WHEN pos IS NULL THEN coalesce(city, '') ELSE bcity END AS branch_city, coalesce(zip, '') AS branch_zip,
 facility_id || '-' || CASE WHEN coalesce(pos, 1) <= 191 THEN chr(CAST(64 + coalesce(pos, 1) AS INT)) ELSE CAST(pos - 1 AS VARCHAR) END AS location_id, CASE WHEN n_loc > 1 THEN 'Yes' ELSE 'No' END AS is_multi_location, greatest(n_loc, 1) AS location_count FROM fa LEFT JOIN se ON se.website = fa.w)"""


@query(f"""WITH {INDEX_SQL}, {SEATS_SQL} SELECT facility_id, location_id, branch_street, branch_city, branch_zip, is_multi_location, location_count FROM br""")
def branch_explode(spark: SparkSession, d: str) -> DataFrame:
    """Every place of a website, however many: no list of them is capped."""
    return C.branches_of(facilities_with_extras(spark, d), places_of(spark, d)).select("facility_id", "location_id", "branch_street", "branch_city", "branch_zip", "is_multi_location", "location_count")


OWN_SQL = "len(list_distinct(list_filter([coalesce(public_direct_email, ''), coalesce(shared_facility_email, '')], lambda x: x <> '')))"
FOUND_SQL = f"(CASE WHEN w IN (SELECT website FROM mw) THEN (SELECT count(DISTINCT e) FROM mw WHERE mw.website = w) ELSE {OWN_SQL} END)"
FIRST_SQL = "(SELECT min_by({c}, pos) FROM pp WHERE pp.no = fq.no)"


@query(f"""WITH {candidate_sql("qualification_status = 'Needs Review'")} SELECT facility_id, facility_name, {shown_sql(FIRST_SQL.format(c="f"))} AS decision_maker_first_name, {shown_sql(FIRST_SQL.format(c="l"))} AS decision_maker_last_name, coalesce({FIRST_SQL.format(c="title")}, '') AS decision_maker_title, {FOUND_SQL} AS emails_found FROM fq""")
def review_projection(spark: SparkSession, d: str) -> DataFrame:
    p = F.get(C.people_for(), F.lit(0))
    _, rows = kept_facilities(spark, d)
    names = [T.title_case(p["first"]).alias("decision_maker_first_name"), T.title_case(p["last"]).alias("decision_maker_last_name"), F.coalesce(p["title"], F.lit("")).alias("decision_maker_title")]
    return rows.select("facility_id", "facility_name", *names, C.emails_found(F.col("n_mails")).alias("emails_found"))


@query(f"""WITH {candidate_sql("true")}, np AS (SELECT no, (SELECT count(*) FROM pp WHERE pp.no = fa.no) AS n, n_loc FROM fa)
SELECT count(*) FILTER (won AND type = 'Published Direct') AS direct, count(*) FILTER (won AND type = 'Published Shared') AS shared, count(*) FILTER (won AND starts_with(type, 'Guessed')) AS guessed, count(DISTINCT CASE WHEN won THEN no END) AS facilities_with_rows, count(*) FILTER (NOT won) AS repeats,
 (SELECT count(*) FROM np) AS facilities, (SELECT sum(n) FROM np) AS people, (SELECT count(*) FILTER (n > 1) FROM np) AS multi_person, (SELECT count(*) FILTER (n_loc > 1) FROM np) AS multi_site, (SELECT sum(greatest(n_loc, 1)) FROM np) AS branches,
 (SELECT count(*) FROM fa WHERE no NOT IN (SELECT no FROM ca)) AS no_email FROM cl""")
def run_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = facilities_with_extras(spark, d)
    return C.claim_stats(C.claimed_candidates(rows), rows, F.col("n_locations"))


def text_sql(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '')"


ARRAYS_SQL = {"sports_offered": "array_to_string(coalesce(sports_offered, []), '; ')", "source_urls": "array_to_string(coalesce(source_urls, []), ' | ')", "state": "coalesce(state_code, '')", "company_domain": "coalesce(email_domain, '')"}


def columns_sql(columns, **own: str) -> str:
    return ", ".join(f"{own.get(c) or ARRAYS_SQL.get(c) or text_sql(c)} AS {c}" for c in columns)


@query(f"SELECT facility_row_id, {columns_sql(deliver.MASTER_COLUMNS)} FROM {MASTER}")
def master_rows(spark: SparkSession, d: str) -> DataFrame:
    """The 24 columns of the master as they are written."""
    return deliver.master_rows(table(spark, d, MASTER), keep=["facility_row_id"])


NOTES_SQL = f"concat_ws('. ', CASE WHEN coalesce(qualification_status, '') <> '' THEN qualification_status END, CASE WHEN n_loc > 1 THEN 'Multi-location operator (' || n_loc || ' ' || coalesce(state_code, '') || ' branches; see locations CSV)' END, CASE WHEN published THEN '{deliver.PUBLISHED}' ELSE '{deliver.GUESSED}' END) || '.'"


@query(f"""WITH {candidate_sql(f"qualification_status IN ({quoted(KEPT)})")} SELECT {columns_sql(
    deliver.CANDIDATE_COLUMNS, decision_maker_first_name=shown_sql("first"), decision_maker_last_name=shown_sql("last"), decision_maker_full_name=f"trim(concat_ws(' ', {shown_sql('first')}, {shown_sql('last')}), ' ')", decision_maker_title=text_sql("title"),
    candidate_email="email", email_candidate_type="type", pattern_rank=text_sql("rank"), email_source_url="CASE WHEN published THEN coalesce(website, '') ELSE '' END", facility_source_urls=ARRAYS_SQL["source_urls"], qualification_notes=NOTES_SQL,
)} FROM cl JOIN fq USING (no) WHERE won""")
def candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    """The 20 columns of the addresses to verify, of the facilities that go out."""
    kept, _ = kept_facilities(spark, d)
    won, _ = C.fan_out_candidates(kept)
    return deliver.candidate_rows(won, F.col("n_locations"))


@query(f"""WITH {candidate_sql("qualification_status = 'Needs Review'")} SELECT {columns_sql(
    deliver.REVIEW_COLUMNS, indoor_evidence=f"'{deliver.EVIDENCE}'", decision_maker_first_name=shown_sql(FIRST_SQL.format(c="f")), decision_maker_last_name=shown_sql(FIRST_SQL.format(c="l")), decision_maker_title=f"coalesce({FIRST_SQL.format(c='title')}, '')",
    decision_maker_full_name=f"concat_ws(' ', nullif({shown_sql(FIRST_SQL.format(c='f'))}, ''), nullif({shown_sql(FIRST_SQL.format(c='l'))}, ''))", published_direct_email=text_sql("public_direct_email"), emails_found=f"CAST({FOUND_SQL} AS VARCHAR)",
)} FROM fq""")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    """The 28 columns of the facilities to review."""
    _, parked = kept_facilities(spark, d)
    return deliver.review_rows(parked, F.col("n_mails"))


@query(f"""WITH {INDEX_SQL}, {SEATS_SQL} SELECT {columns_sql(deliver.LOCATION_COLUMNS)} FROM br WHERE qualification_status IN ({quoted(KEPT)})""")
def location_rows(spark: SparkSession, d: str) -> DataFrame:
    """The 14 columns of the branches of the facilities that go out."""
    kept, _ = kept_facilities(spark, d)
    return deliver.location_rows(C.branches_of(deliver.location_sites(kept), places_of(spark, d)))


@query(f"""SELECT facility_row_id, CASE WHEN regexp_matches(g, '[",\\n\\r]') THEN '"' || replace(g, '"', '""') || '"' ELSE g END AS cell
FROM (SELECT facility_row_id, CASE WHEN regexp_matches(n, '^[=+@\\t\\r]') THEN '''' || n ELSE n END AS g FROM (SELECT facility_row_id, coalesce(research_notes, '') || coalesce(facility_name, '') AS n FROM {MASTER}))""")
def csv_guard(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, MASTER).select("facility_row_id", F.concat(F.coalesce("research_notes", F.lit("")), F.coalesce("facility_name", F.lit(""))).alias("n"))
    return csvio.to_csv_lines(rows, ["n"], keep=["facility_row_id"]).withColumnRenamed("line", "cell")


@query(f"""SELECT facility_row_id, array_to_string(coalesce(sports_offered, []), '; ') AS sports, array_to_string(coalesce(source_urls, []), ' | ') AS sources FROM {MASTER}""")
def csv_arrays(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MASTER).select("facility_row_id", csvio.joined("sports_offered", "; ").alias("sports"), csvio.joined("source_urls", " | ").alias("sources"))


@query(f"WITH {INDEX_SQL} SELECT facility_row_id, {FOUND_SQL} AS emails FROM fa")
def emails_found(spark: SparkSession, d: str) -> DataFrame:
    return facilities_with_extras(spark, d).select("facility_row_id", C.emails_found(F.col("n_mails")).alias("emails"))
