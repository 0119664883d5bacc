"""Queries whose inputs are written out: scalars that SQL can't say are held against the values they must give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import extract as X
from pagelode.functions import text as T
from pagelode.operators.facilities import finalize
from pagelode.operators.lineage import cut
from pagelode.plans.enrich import facility_rows, known_cities
from pagelode.sources.stages import page_faults

LINES = "\n"


def values_sql(rows: list[tuple], columns: str) -> str:
    """The rows as a VALUES list that another engine reads."""
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) v({columns})"


def numbered(rows) -> list[tuple]:
    return [(i + 1, *r) for i, r in enumerate(rows)]


TITLES = [
    ("<html><title>Home | Empire Racquet Club</title></html>", "Empire Racquet Club"), ('<meta property="og:site_name" content="Rye Fieldhouse"><title>Courts</title>', "Rye Fieldhouse"), ("<title>Welcome</title>", "Welcome"),
    ("<title>Oak &amp; Elm Club – Official Site</title>", "Oak & Elm Club"), ("", ""), ("<title>x</title>", ""), ('<meta content="Bay Sportsplex" name="og:title">', "Bay Sportsplex"), (None, ""), ("<TITLE lang=en>Official Site - Fort Hall</TITLE>", "Fort Hall"),
    ('<meta property="og:site_name" content="Home"><title>Delta Tennis | Home</title>', "Delta Tennis"), ("<title>CafÃ© Courts</title>", "Café Courts"),
]
LINKS = [
    ('<a href="../contact">Contact <b>us</b></a>', "https://a.test/x/contact", "Contact us"), ("<a class=c href=staff>Staff</a>", "https://a.test/x/y/staff", "Staff"), ("<A HREF='//b.test/q'>Q</A>", "https://b.test/q", "Q"),
    ('<a href="/p?a=1&amp;b=2">P &amp; Q</a>', "https://a.test/p?a=1&b=2", "P & Q"), ('<a href="#top"> T </a>', "https://a.test/x/y/z#top", "T"), ('<a href="mailto:x@y.test">m</a>', "mailto:x@y.test", "m"),
    ('<a href="./../../../../up/./there/">u</a>', "https://a.test/up/there/", "u"), ('<a href="https://c.test/k/../l">abs</a>', "https://c.test/k/../l", "abs"), ('<a href="?page=2">next</a>', "https://a.test/x/y/z?page=2", "next"),
]
PEOPLE = [
    ("Dana Whitfield, General Manager", "Dana Whitfield/General Manager"), ("Owner: Lee Oxley", "Lee Oxley/Owner"), (f"Jane Roe{LINES}Head of Operations", "Jane Roe/Head of Operations"), ("Tennis Director, Manager", ""), ("", ""), (None, ""),
    (f"Sam Poe - Manager{LINES}Ann Coe | Owner{LINES}Sam Poe, Founder", "Ann Coe/Owner; Sam Poe/Founder"), ("Contact Us - Owner", ""), ("J. Doe, Owner", ""), (f"Mary Ann O'Neil, CEO{LINES}mary o'neil, Manager", "Mary O'Neil/CEO"), ("Whitfield, Manager", ""),
]
MAILS = [
    ("Anna Whitfield;Bobby Whitfield", "whitfield@c.test;bobby@c.test", "whitfield@c.test;bobby@c.test"), ("Bobby Whitfield;Anna Whitfield", "whitfield@c.test;bobby@c.test", "whitfield@c.test;"), ("Ann Lee;Bob Lee", "alee@c.test;lee@c.test", "alee@c.test;"),
    ("Ann Lee", "", ""), ("Ann Lee;Ann Lee", "ann.lee@c.test;lee-ann@c.test", "ann.lee@c.test;lee-ann@c.test"), ("Robert Poe", "robertp@c.test", "robertp@c.test"), ("Robert Poe", "info@c.test;123@c.test", ""),
]
OWN_NAMES = [("Marlene Grey Hall", "Grey Hall;Ann Lee", "Ann Lee"), ("Quay Club", "Ann Lee;Quay Lee", "Ann Lee;Quay Lee"), ("", "Ann Lee", "Ann Lee"), (None, "Ann Lee", "Ann Lee"), ("ANN & LEE COURTS", "Ann Lee", "")]
OWN_MAILS = [
    ("Dana Grey", "info@c.test;dgrey@c.test", "dgrey@c.test"), ("Dana Grey", "dana@c.test", "dana@c.test"), ("Dana Grey", "danag@c.test;grey@c.test", "danag@c.test"), ("Dana Grey", "zed@c.test", ""), ("", "only@c.test", "only@c.test"),
    ("", "a@c.test;b@c.test", ""), ("Dana Grey", "", ""), ("", "", ""),
]
CITIES = [
    ("12 Oak St, Rochester, NY 14604", "Rochester"), ("Visit us at 9 Elm Avenue Saratoga Springs, NY 12866. Also Troy, NY", "Saratoga Springs"), ("Troy, NY and Albany, NY and Troy, New York", "Troy"), ("nothing here", None), ("1 Main St, Nowhere Hamlet, NY", "Nowhere Hamlet"),
    ("Nowhere Hamlet, NY; Nowhere Hamlet, NY; Troy, NY", "Troy"), ("NYC, NY 10001", "New York"), (None, None), ("7 Broadway, ALBANY, NY", "Albany"),
]
PLACES = ("rochester", "saratoga springs", "troy", "albany", "new york")
MARKUP = [
    ("<p>One</p><p>Two<br>Three</p>", f"One{LINES}Two{LINES}Three"), ("<script>var a = '<p>';</script><div>A &amp; B</div><style>p{}</style>", "A & B"), ("<!-- no --><li>x</li><li> y&nbsp;z </li>", f"x{LINES}y z"), ("plain", "plain"), (None, ""),
    ("a<b>b</b>c", "abc"), ("<td>1</td><tr><td>2</td></tr>", f"1{LINES}2"), ("&lt;p&gt; &#65;&#x42; &bogus; &amp;lt;", "<p> AB &bogus; &lt;"), ("<noscript>off</noscript>on", "on"),
]
DAMAGED = [("NÃºÃ±ez", "Núñez"), ("Caf", "Caf"), ("Ã", "Ã"), ("â€“ Courts", "– Courts"), ("naïve", "naïve"), ("Ãœber", "Über"), ("", ""), (None, None), ("Â«x»", "Â«x»"), ("O’Neil Ã©", "O’Neil Ã©")]


def _text(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(i + 1, r[0]) for i, r in enumerate(rows)], "case_no int, t string")


def _cases(rows: list[tuple], scalar) -> tuple:
    """(query, SQL) of a scalar over written texts."""
    sql = values_sql(numbered((r[1],) for r in rows), "case_no, value")
    return lambda spark, d: _text(spark, rows).select("case_no", scalar(F.col("t")).alias("value")), sql


def _people(t: Column) -> Column:
    return F.array_join(F.transform(X.people(t), lambda p: F.concat(p["first"], F.lit(" "), p["last"], F.lit("/"), p["title"])), "; ")


def _links(spark: SparkSession, d: str) -> DataFrame:
    rows = _text(spark, LINKS).select("case_no", F.explode(X.links("t", F.lit("https://a.test/x/y/z"))).alias("l"))
    return rows.select("case_no", F.col("l.href").alias("href"), F.col("l.text").alias("label"))


def _mails(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(i + 1, r[0], r[1]) for i, r in enumerate(MAILS)], "case_no int, who string, mail string")
    person = lambda w: F.struct(F.split_part(w, F.lit(" "), F.lit(1)).alias("first"), F.split_part(w, F.lit(" "), F.lit(2)).alias("last"), F.lit("").alias("title"), F.lit(0).alias("rank"))
    hit = X.match_emails_to_people(F.transform(F.split("who", ";"), person), F.filter(F.split("mail", ";"), lambda e: e != ""))
    return rows.select("case_no", F.array_join(F.transform(hit, lambda p: p["email"]), ";").alias("value"))


def _person(w: Column) -> Column:
    part = lambda n: F.split_part(w, F.lit(" "), F.lit(n))
    return F.struct(part(1).alias("first"), part(2).alias("last"))


def _listed(c: str) -> Column:
    return F.filter(F.split(c, ";"), lambda e: e != "")


def _own_names(spark: SparkSession, d: str) -> DataFrame:
    """Persons whose names are words of the facility's own."""
    rows = spark.createDataFrame([(i + 1, r[0], r[1]) for i, r in enumerate(OWN_NAMES)], "case_no int, name string, who string")
    kept = X.drop_name_artifacts(F.transform(_listed("who"), _person), "name")
    return rows.select("case_no", F.array_join(F.transform(kept, lambda p: F.concat(p["first"], F.lit(" "), p["last"])), ";").alias("value"))


def _own_mails(spark: SparkSession, d: str) -> DataFrame:
    """The address of the first person, or the only one where there is no person."""
    rows = spark.createDataFrame([(i + 1, r[0], r[1]) for i, r in enumerate(OWN_MAILS)], "case_no int, who string, mail string")
    return rows.select("case_no", X.own_direct_email(F.transform(_listed("who"), _person), _listed("mail")).alias("value"))


def _cities(spark: SparkSession, d: str) -> DataFrame:
    sites = _text(spark, CITIES).select(F.col("case_no").alias("site"), F.col("t").alias("text"))
    found = known_cities(sites, spark.createDataFrame([(p,) for p in PLACES], "place string"))
    return sites.join(found, "site", "left").select(F.col("site").alias("case_no"), F.col("city").alias("value"))


PAGES = [
    ("https://harborclub.test/", 200, """<html><head><title>Home | Harbor Racquet Club</title></head><body><p>Six indoor tennis courts and two outdoor courts. Memberships and court time.</p>
<a href="/blog/1">Blog</a><a href="blog/2">News</a><a href="/team">Our team</a><a href="contact-us">Write</a><p>12 Pier Street, Rochester, NY 14604</p></body></html>"""),
    ("https://harborclub.test/blog/1", 200, "<p>Owner: Wrong Person</p>"), ("https://harborclub.test/blog/2", 200, "<p>No news, mail nobody@harborclub.test</p>"),
    ("https://www.harborclub.test/contact-us?x=1", 200, "<p>info@harborclub.test or dgrey@harborclub.test</p>"), ("https://harborclub.test/team", 200, "<p>Dora Grey, General Manager</p><p>Ned Holm - Tennis Director</p>"),
    ("https://harborclub.test/courts", 500, "<p>broken</p>"), ("https://lakepark.test/", 200, "<p>Town of Lake outdoor-only courts.</p>"), ("https://solo.test/", 200, "<title>Solo Sportsplex</title><p>Indoor pickleball. Mia Ost, Owner</p>"), ("", 200, "<p>x</p>"), ("https://empty.test/", 404, None),
]
MASTER_PATH = [
    ("Harbor Racquet Club", "https://harborclub.test/", "Rochester", 6, "Dora Grey", "General Manager", "dgrey@harborclub.test", "info@harborclub.test", "", "harborclub.test",
     "NY location evidence: address. Paid access signals present (membership/rental/program).", "https://harborclub.test/ | https://harborclub.test/team | https://www.harborclub.test/contact-us?x=1"),
    ("Lake Park & Courts", "https://lakepark.test/", "", None, "", "", "", "", "", "lakepark.test", "No decision maker found on public pages. No court count stated by a reliable source; left blank.", "https://lakepark.test/"),
    ("Solo Sportsplex", "https://solo.test/", "", None, "Mia Ost", "Owner", "", "", "mia@solo.test", "solo.test", "No court count stated by a reliable source; left blank. Guessed emails are UNVERIFIED pattern permutations - not published addresses.", "https://solo.test/"),
]


def page_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *p) for i, p in enumerate(PAGES)], "ord long, url string, status int, html string")


def _path(spark: SparkSession, d: str) -> DataFrame:
    """Pages to the master: extraction, address cleaning, both dedups, contact blanking and the final order."""
    blurbs = spark.createDataFrame([("lakepark.test", "", "Lake Park &amp; Courts")], "site string, blurb string, title string")
    rows = facility_rows(page_rows(spark), spark.createDataFrame([(p,) for p in PLACES], "place string"), blurbs=blurbs)
    out = finalize(cut(rows), [])  # read many times; between runs it is a stage table
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    who = F.trim(F.concat_ws(" ", "decision_maker_first_name", "decision_maker_last_name"))
    return out.select(
        "facility_name", "website", blank("city").alias("city"), "number_of_courts", who.alias("who"), blank("decision_maker_title").alias("title"), blank("public_direct_email").alias("direct"), blank("shared_facility_email").alias("shared"),
        blank("guessed_email_1").alias("guess"), "email_domain", "research_notes", F.array_join("source_urls", " | ").alias("sources"),
    )


def _faults(spark: SparkSession, d: str) -> DataFrame:
    return page_faults(page_rows(spark))


QUERIES, ORACLES = {}, {}
for _name, (_query, _sql) in {
    "mojibake_cases": _cases(DAMAGED, T.repair_mojibake),
    "html_text_cases": _cases(MARKUP, T.html_to_text),
    "page_title_cases": _cases(TITLES, X.page_title),
    "people_cases": _cases(PEOPLE, _people),
    "link_cases": (_links, values_sql(numbered((r[1], r[2]) for r in LINKS), "case_no, href, label")),
    "email_match_cases": (_mails, values_sql(numbered((r[2],) for r in MAILS), "case_no, value")),
    "name_artifact_cases": (_own_names, values_sql(numbered((r[2],) for r in OWN_NAMES), "case_no, value")),
    "direct_email_cases": (_own_mails, values_sql(numbered((r[2],) for r in OWN_MAILS), "case_no, value")),
    "city_detect_cases": (_cities, values_sql(numbered((r[1],) for r in CITIES), "case_no, value")),
    "pages_to_master": (_path, values_sql(MASTER_PATH, "facility_name, website, city, number_of_courts, who, title, direct, shared, guess, email_domain, research_notes, sources")),
    "page_faults": (_faults, values_sql([("https://harborclub.test/courts", "status 500"), ("", "no host"), ("https://empty.test/", "status 404")], "url, fault")),
}.items():
    QUERIES[_name], ORACLES[_name] = _query, _sql
