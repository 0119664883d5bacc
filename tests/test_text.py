from pyspark.sql import functions as F

from pagelode.functions import text as T
from pagelode.functions import urls as U
from pagelode.profile import NY


def test_mojibake_is_undone_only_where_it_round_trips(value):
    assert value(T.repair_mojibake("t"), t="Dana â€” GM") == "Dana — GM"
    assert value(T.repair_mojibake("t"), t="NÃºÃ±ez") == "Núñez"
    assert value(T.repair_mojibake("t"), t="Château â") == "Château â"
    assert value(T.repair_mojibake("t"), t=None) is None
    assert value(T.normalize_separators("t"), t="a – b “c” ‘d’ e") == "a - b \"c\" 'd' e"


def test_entities_are_read_once(value):
    assert value(T.decode_entities("t"), t="Racquet &amp; Fitness &#8212; &lt;b&gt; &nosuch; &#x41;") == "Racquet & Fitness — <b> &nosuch; A"
    assert value(T.decode_entities("t"), t="&amp;lt;") == "&lt;"
    assert value(T.decode_entities("t"), t="&#128512; &reg;") == "😀"
    assert value(T.decode_entities("t"), t=None) == ""


def test_names(value):
    assert value(T.name_key("t"), t="The Club at Rye, Inc.") == value(T.name_key("t"), t="at rye") == "at rye"
    assert value(T.title_case("t"), t="SHYE O'EVAN-LEE") == "Shye O'Evan-Lee"
    assert value(T.title_case("t"), t="McDonald") == "McDonald"
    assert value(T.normalize_city("t", NY.city_alias), t="BROOKLYN.") == "Brooklyn"
    assert value(T.normalize_city("t", NY.city_alias), t="NYC") == "New York"
    assert value(T.normalize_city("t", {}), t="NYC") == "Nyc"
    assert value(T.local_letters("t"), t="O'Núñez-Lee") == "onunezlee"


def test_html_to_text(value):
    page = "<html><head><script>x<1</script></head><body><p>One &amp; two</p><!-- no --><ul><li>three</li></ul></body></html>"
    assert value(T.html_to_text("t"), t=page) == "One & two\nthree"
    assert value(T.html_to_text("t"), t=None) == ""


def test_hosts(value):
    host = lambda u: value(U.registrable_domain("u"), u=u)
    assert host("https://www.Club.TEST:8080/x") == "club.test:8080"
    assert host("http://club.test:80") == host("https://user@club.test:443/?a") == host("https:/club.test") == "club.test"
    assert host("https://münchen.test/a|b") == "münchen.test"
    assert host("WWW.CLUB.TEST") == "club.test"
    assert host(None) == host("") == ""
    apex = lambda u: value(U.apex_domain("u"), u=u)
    assert apex("https://book.squash.test/x") == "squash.test"
    assert apex("https://shop.com") == "shop.com"
    assert apex("https://a.shared-host.test") == "a.shared-host.test"
    assert apex("https://m.co.uk") == "m.co.uk"
    assert apex("https://www2.my.club.ny.us") == "club.ny.us"
    assert value(U.last_two_labels("u"), u="a.b.c") == "b.c"
    assert value(U.is_listing_host("u"), u="www.yelp.test") and not value(U.is_listing_host("u"), u="club.test")
    assert value(U.is_government_host("u"), u="parks.ny.gov")


def test_links_are_made_absolute(value):
    go = lambda h: value(U.absolute_url(F.lit(h), F.lit("https://a.test/x/y?q")))
    assert [go(h) for h in ("https://b.test/", "//c.test/z", "/d", "e", "?f", "mailto:x@y.test")] == ["https://b.test/", "https://c.test/z", "https://a.test/d", "https://a.test/x/e", "https://a.test/x/y?f", "mailto:x@y.test"]


def test_cities_beyond_ascii_are_normalized(spark, tmp_path):
    from pagelode.plans.catalogue import QUERIES

    want = {
        "Brooklyn’": "Brooklyn", "SAINT‑JEAN": "Saint‑Jean", "L’ORÉAL": "L’OréAl", "ÉVREUX": "éVreux", "Núñez": "Núñez", "NYC’": "New York", "\u00a0Rye\u00a0": "Rye", "Rye": "Rye", "中城": "中城", "": "",
    }
    spark.createDataFrame([(c,) for c in [*want, "Rye", None]], "city string").write.parquet(f"{tmp_path}/new_york_indoor_court_facilities.parquet")
    assert {r.typed: r.city for r in QUERIES["city_normalize"](spark, str(tmp_path)).collect()} == want
