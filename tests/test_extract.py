from pyspark.sql import functions as F

from pagelode.functions import extract as X
from pagelode.plans.enrich import facility_rows, known_cities

CLUB = """<html><head><title>Home | Harbor Racquet &amp; Fitness Club</title></head><body>
<h1>Harbor Racquet Club</h1><p>We run 8 indoor tennis courts and 4 indoor pickleball courts, 3 outdoor courts in summer. Membership from $40.</p>
<p>12 Quay St, Rochester, NY 14604</p><p>Robin Quayle — General Manager</p><p>Director of Operations: Sam Harrow</p>
<a href="/contact">Contact us</a> <a href="/staff/">Our staff</a> <a href="/staff">again</a> <a href="https://other.test/about">x</a>
<p>info@harborracquet.test or rquayle@harborracquet.test or reporter@paper.test</p></body></html>"""


def rows(x):
    return [tuple(r) for r in x]


def test_people(value):
    who = lambda t: rows(value(X.people("t"), t=t))
    assert who("Robin Quayle — General Manager\nDirector of Operations: Sam Harrow") == [("Robin", "Quayle", "General Manager", 6), ("Sam", "Harrow", "Director of Operations", 9)]
    assert who("Robin Quayle\nOwner") == [("Robin", "Quayle", "Owner", 0)]
    assert who("Robin Quayle, Manager, and Robin Quayle, Owner") == [("Robin", "Quayle", "Owner", 0)]
    assert who("Contact Our Manager") == who("Robin Q., Owner") == who("Varsity Basketball, Manager") == who(None) == []


def test_emails_are_matched_once(spark):
    df = spark.createDataFrame([([("Robin", "Quayle", "Owner", 0), ("Sam", "Quayle", "Manager", 24), ("Dana", "Ox", "Manager", 24)], ["rquayle@a.test", "info@a.test", "dana@a.test"])], "p array<struct<first:string,last:string,title:string,rank:int>>, e array<string>")
    out = df.select(X.match_emails_to_people(F.col("p"), F.col("e")).alias("x")).first().x
    assert [r.email for r in out] == ["rquayle@a.test", "", "dana@a.test"]


def test_emails_belong_to_the_site(spark):
    df = spark.createDataFrame([(["a@gmail.com", "info@club.test", "reporter@paper.test", "x@harborclub.test"],)], "e array<string>")
    c = df.select(X.classify_emails(F.col("e"), F.lit("club.test"), F.lit("Harbor Club")).alias("x")).first().x
    assert (c.shared, c.shared_all, c.direct) == ("info@club.test", ["info@club.test"], ["x@harborclub.test", "a@gmail.com"])


def test_email_pattern(value):
    assert value(X.emails("t"), t="é info@club.test, IMG@2x.png x@example.com no-reply@a.test INFO@club.test") == ["info@club.test"]
    assert value(X.emails("t"), t="文あmatthew@club.testまで") == ["matthew@club.test"]


def test_guesses(value):
    six = value(X.guess_emails("f", "l", "d"), f="Dana", l="O'Whit", d="www.Club.Test")
    assert six == ["dana@club.test", "dana.owhit@club.test", "danaowhit@club.test", "dowhit@club.test", "d.owhit@club.test", "danao@club.test"]
    assert value(X.guess_emails("f", "l", "d"), f="", l="x", d="y.test") == [""] * 6


def test_counts_and_kinds(value):
    assert value(X.court_count("t"), t="has 8 indoor tennis courts")["count"] == 8
    assert value(X.court_count("t"), t="Courts: twelve")["count"] == 12
    assert value(X.court_count("t"), t="500 courts")["count"] is None
    assert value(X.facility_kind("n", "t"), n="Empire Racquet & Fitness Club", t="health club") == "Racquet / Tennis Club"
    assert value(X.facility_kind("n", "t"), n="Empire", t="our gym") == "Health Club"
    assert value(X.excluded_by("n", "t"), n="x", t="Town of Y") == "\\b(town|city|village|county) of\\b"
    assert value(X.excluded_by("n", "t"), n="x", t="hoa rules") == ""
    assert value(X.looks_retail("t"), t="Add to cart. Free shipping. Size chart.") and not value(X.looks_retail("t"), t="checkout")
    s = value(X.indoor_signals("t"), t="Outdoor-only courts")
    assert (s.indoor, s.outdoor, s.outdoor_only) == (False, True, True)


def test_addresses_and_evidence(value):
    two = value(X.addresses("t"), t="1 Harlem River Dr, Bronx, NY 10453; 1 Harlem River Dr, Bronx, NY 10453 and 22 Oak Ave, Suite 4, Rye, NY")
    assert rows(two) == [("1 Harlem River Dr", "Bronx", "10453"), ("22 Oak Ave", "Rye", "")]
    assert value(X.addresses("t"), t="Serving Rochester, Pittsford and Webster, NY") == []
    ev = lambda t: value(X.location_evidence("t"), t=t)
    assert [ev("Rye, NY"), ev("NY 10580"), ev("(914) 555-0100"), ev("in New York State"), ev("Ohio"), ev(None)] == ["address", "zip", "phone", "mention", "", ""]


def test_titles_and_subpages(value, spark):
    assert value(X.page_title("t"), t=CLUB) == "Harbor Racquet & Fitness Club"
    assert value(X.page_title("t"), t='<meta property="og:site_name" content="Quay Club"><title>x</title>') == "Quay Club"
    assert value(X.page_title("t"), t=None) == ""
    found = value(X.pick_subpages(X.links("t", F.lit("https://www.harborracquet.test/")), F.lit("harborracquet.test")), t=CLUB)
    assert found == ["https://www.harborracquet.test/contact", "https://www.harborracquet.test/staff"]


def test_a_site_becomes_a_row(spark):
    pages = spark.createDataFrame([(1, "https://harborracquet.test/", 200, CLUB), (2, "https://harborracquet.test/gone", 404, "x"), (3, "https://bare.test/", 200, None)], "ord long, url string, status int, html string")
    places = spark.createDataFrame([("Rochester",)], "place string")
    out = {r.site: r for r in facility_rows(pages, places).collect()}
    r = out["harborracquet.test"]
    assert (r.facility_name, r.city, r.number_of_courts, r.facility_type) == ("Harbor Racquet & Fitness Club", "Rochester", 8, "Racquet / Tennis Club")
    assert (r.decision_maker_first_name, r.decision_maker_last_name, r.public_direct_email, r.shared_facility_email) == ("Robin", "Quayle", "rquayle@harborracquet.test", "info@harborracquet.test")
    assert r.indoor and r.outdoor and not r.outdoor_only and r.sports == ["pickleball", "tennis"] and [p.email for p in r.people] == ["rquayle@harborracquet.test", ""]
    assert out["bare.test"].facility_name == "bare.test" and out["bare.test"].locations == []


def test_city_prefers_known_places(spark):
    texts = [(1, "Greater Metro, NY and Pittsford, NY"), (2, "1 Harlem River Dr, Bronx, NY 10453"), (3, "on Main St, NY"), (4, "Our home is NYC, NY"), (5, None), (6, "Foo Town, NY. Foo Town, NY. Bar, NY")]
    sites = spark.createDataFrame(texts, "site int, text string")
    places = spark.createDataFrame([("pittsford",), ("bronx",), ("new york",)], "place string")
    assert {r.site: r.city for r in known_cities(sites, places).collect()} == {1: "Pittsford", 2: "Bronx", 4: "New York", 6: "Foo Town"}
