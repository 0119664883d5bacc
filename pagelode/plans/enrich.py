"""From pages to facility rows: one row per site with everything its pages say.

Which sites are kept is left to the caller: the signals are columns, and rules about them are data of the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import extract as X
from pagelode.functions.text import as_col, decode_entities, html_to_text
from pagelode.functions.urls import registrable_domain
from pagelode.profile import GUESS_NOTE, NY, Profile

MOST_SUBPAGES = 6  # pages besides the home page that are read, as the program it follows does
MOST_PEOPLE = 8
GUESSES = tuple(f"guessed_email_{i}" for i in range(1, 7))


def page_key(url: Column | str) -> Column:
    """What two addresses of one page share: host without www. and path, without scheme, query, fragment and last slash."""
    return F.regexp_replace(F.regexp_extract(F.coalesce(as_col(url), F.lit("")), "^(?i)https?://(?:www\\.)?([^?#]*)", 1), "/$", "")


def site_pages(pages: DataFrame, most: int = MOST_SUBPAGES) -> DataFrame:
    """pages(ord, url, status, html) -> the home page of every site (its first usable page) and the pages that its links promise to be about staff or contacts.

    place is 0 for the home page and the link's place for the others; of pages under one address the first counts."""
    usable = pages.filter(F.coalesce(F.col("status"), F.lit(200)) < 400).withColumn("site", registrable_domain("url")).filter("site <> ''").select("ord", "url", "html", "site")
    first = usable.groupBy("site").agg(F.min("ord").alias("ord"))
    home = usable.join(first.select("ord"), "ord")
    chosen = home.select("site", F.posexplode(X.pick_subpages(X.links("html", "url"), "site", most)).alias("n", "page")).select("site", page_key("page").alias("key"), (F.col("n") + 1).alias("place"))
    chosen = chosen.groupBy("site", "key").agg(F.min("place").alias("place"))
    others = usable.join(first.select("ord"), "ord", "left_anti").withColumn("key", page_key("url")).join(chosen, ["site", "key"])
    one = others.groupBy("site", "key").agg(F.min("ord").alias("ord")).select("ord")
    kept = home.withColumn("place", F.lit(0)).unionByName(others.join(one, "ord").drop("key"))
    return kept.withColumn("text", html_to_text("html"))


def site_corpus(pages: DataFrame) -> DataFrame:
    """One row per site: the text and markup of the pages that are read, in order, and their addresses."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce(F.col(c), F.lit("")).alias("v")))), lambda s: s["v"])
    return site_pages(pages).groupBy("site").agg(
        F.array_join(ordered("text"), "\n").alias("text"), F.array_join(ordered("html"), "\n").alias("html"), F.min_by("html", "place").alias("home_html"), F.min_by("url", "place").alias("website"),
        F.array_distinct(ordered("url")).alias("source_urls"), F.min("ord").alias("ord"),
    )


def known_cities(sites: DataFrame, gazetteer: DataFrame, profile: Profile = NY) -> DataFrame:
    """site, city: the place named most often before ', NY'; a place of the gazetteer beats others, the one seen first wins ties.

    gazetteer(place): names in any case. The longest tail of up to three words that is a place counts; else one to three capitalised words."""
    runs = sites.select("site", F.posexplode(X.city_runs("text", profile)).alias("pos", "run"))
    words = F.split("run", " ")
    tails = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.when(F.size(words) >= n, F.array_join(F.slice(words, F.size(words) - n + 1, n), " ")))
    each = runs.select("site", "pos", "run", F.posexplode(tails).alias("n", "tail")).filter("tail is not null").withColumn("key", F.lower(X.normalize_city("tail", profile.city_alias)))
    places = gazetteer.select(F.lower("place").alias("key")).distinct()
    hit = each.join(places, "key", "left_semi").groupBy("site", "pos").agg(F.max_by("tail", "n").alias("hit"))
    plain = F.regexp_replace("run", "^(?:(?![A-Z][a-zA-Z.'’-]*(?: |$))[^ ]+ ?)+", "")
    runs = runs.join(hit, ["site", "pos"], "left").withColumn("bare", F.when(plain.rlike("^[A-Z][a-zA-Z.'’-]*(?: [A-Z][a-zA-Z.'’-]*){0,2}$"), plain))
    named = runs.select("site", "pos", F.col("hit").isNotNull().alias("known"), X.normalize_city(F.coalesce("hit", "bare"), profile.city_alias).alias("city"))
    named = named.filter(F.length("city").between(3, 28) & ~F.col("city").rlike(X.STREET_WORD))
    counts = named.groupBy("site", "city").agg(F.max("known").alias("known"), F.count("*").alias("c"), F.min("pos").alias("first"))
    return counts.groupBy("site").agg(F.max(F.struct("known", "c", (-F.col("first")).alias("o"), "city")).alias("m")).select("site", F.col("m.city").alias("city"))


def no_verdict(rows: DataFrame) -> DataFrame:
    """Neither a status nor a reason: what a row is worth is the caller's to say."""
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("qualification_status", "indoor_court_status", "reason")})


def facility_rows(pages: DataFrame, gazetteer: DataFrame, profile: Profile = NY, blurbs: DataFrame | None = None, verdict: Callable[[DataFrame], DataFrame] = no_verdict) -> DataFrame:
    """One row per site of pages, in the shape that operators.facilities, operators.contacts and plans.deliver take.

    blurbs(site, blurb, title): search titles and snippets, which count for what is offered but not for where it is, and the first title,
    which is the name where the page gives none. verdict adds qualification_status, indoor_court_status and reason to rows that have
    indoor, outdoor, outdoor_only, monetized, retail, excluded_by, sports and location_evidence."""
    s = site_corpus(pages)
    s = s.join(blurbs, "site", "left") if blurbs is not None else s.withColumn("blurb", F.lit(""))
    s = s if "title" in s.columns else s.withColumn("title", F.lit(""))
    filled = lambda c: F.when(c != "", c)
    s = s.withColumns({"corpus": F.concat_ws("\n", "text", F.coalesce("blurb", F.lit(""))), "facility_name": F.coalesce(filled(X.page_title("home_html")), filled(decode_entities("title")), "site")})
    s = s.withColumns({
        "signals": X.indoor_signals("corpus"), "sports": X.sports("corpus", profile), "excluded_by": X.excluded_by("facility_name", "corpus"), "monetized": X.looks_monetized("corpus"),
        "retail": X.looks_retail("text"), "location_evidence": X.location_evidence("text", profile), "mail": X.classify_emails(X.emails("text", "html"), "site", "facility_name"),
        "found": X.drop_name_artifacts(X.people("text"), "facility_name"), "court": X.court_count("corpus", profile), "locations": X.addresses("text", profile),
    })
    s = verdict(s.select("*", "signals.indoor", "signals.outdoor", "signals.outdoor_only").drop("signals"))
    s = s.join(known_cities(s.select("site", "text"), gazetteer, profile), "site", "left")
    p = F.get("found", F.lit(0))
    s = s.withColumn("direct", X.own_direct_email(F.col("found"), F.col("mail.direct")))
    s = s.withColumn("guesses", F.when(p.isNotNull() & (F.col("direct") == ""), X.guess_emails(p["first"], p["last"], "site")).otherwise(F.array_repeat(F.lit(""), 6)))
    told = X.notes(
        (F.coalesce("reason", F.lit("")) != "", F.col("reason")), (F.col("location_evidence") != "", F.concat(F.lit(f"{profile.state} location evidence: "), "location_evidence", F.lit("."))),
        (p.isNull(), F.lit("No decision maker found on public pages.")), (F.get("guesses", F.lit(0)) != "", F.lit(GUESS_NOTE)), (F.col("court.count").isNull(), F.lit("No court count stated by a reliable source; left blank.")),
        (F.col("monetized"), F.lit("Paid access signals present (membership/rental/program).")),
    )
    return s.select(
        "ord", "site", "facility_name", "website", F.coalesce("city", F.lit("")).alias("city"), F.lit(profile.state).alias("state"), X.facility_kind("facility_name", "corpus").alias("facility_type"),
        "sports", F.col("sports").alias("sports_offered"), "indoor_court_status", F.col("court.count").alias("number_of_courts"), F.col("court.note").alias("court_count_notes"), p["first"].alias("decision_maker_first_name"), p["last"].alias("decision_maker_last_name"),
        p["title"].alias("decision_maker_title"), F.col("direct").alias("public_direct_email"), F.col("mail.shared").alias("shared_facility_email"), *[F.get("guesses", F.lit(i)).alias(c) for i, c in enumerate(GUESSES)],
        F.col("site").alias("email_domain"), "qualification_status", told.alias("research_notes"), "source_urls", "indoor", "outdoor", "outdoor_only", "monetized", "retail", "excluded_by", "location_evidence",
        X.match_emails_to_people(F.slice("found", 1, MOST_PEOPLE), F.col("mail.direct")).alias("people"), F.col("mail.direct").alias("direct_emails"), F.col("mail.shared_all").alias("shared_emails"), "locations",
    )
