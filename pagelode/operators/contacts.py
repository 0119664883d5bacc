"""From the master list to what goes out: people and addresses per facility, branches, and each address once.

A facility's extras are arrays: people (first, last, title, rank, email), direct_emails, shared_emails, locations
(street, city, zip). Null arrays mean that the contact pass knows nothing of the facility.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.extract import guess_emails, mail_local, name_is_confirmed
from pagelode.functions.text import let, title_case
from pagelode.functions.urls import registrable_domain
from pagelode.operators.facilities import full
from pagelode.operators.keyed import first_claim, richest_per_key
from pagelode.operators.skew import spread_left_join
from pagelode.profile import ROLE_LOCALS

PERSON = "struct<first:string,last:string,title:string,email:string>"
HOT = 64  # places of a website beyond which they are dealt to several tasks; every place comes out either way
CANDIDATE = "struct<email:string,type:string,rank:int,published:boolean,first:string,last:string,title:string>"


def size_of(c: str) -> Column:
    return F.greatest(F.size(F.coalesce(F.col(c), F.array())), F.lit(0))


def contact_index(contacts: DataFrame, weight: Column | None = None) -> DataFrame:
    """The fullest record per host of contacts(ord, website, people, direct_emails, shared_emails, locations); weight says how full a record is, if not the size of its lists."""
    rows = contacts.withColumn("host", registrable_domain("website")).filter("host <> ''")
    if weight is None:
        weight = size_of("people") + size_of("locations") + size_of("direct_emails")
    return richest_per_key(rows, F.col("host"), weight, "ord").drop("first_order")


def with_contacts(master: DataFrame, index: DataFrame) -> DataFrame:
    """Master rows with their host's extras; null where there are none. The index has one row a host, so rows do not multiply."""
    extras = index.drop(*[c for c in index.columns if c in master.columns and c != "host"], "ord")
    return master.withColumn("host", registrable_domain("website")).join(extras, "host", "left")


def people_for() -> Column:
    """array<PERSON>: the confirmed people of the contact pass, else the master's own if confirmed, else none."""
    kept = F.filter("people", lambda p: name_is_confirmed(p["first"], p["last"]))
    found = F.transform(kept, lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), F.coalesce(p["title"], F.lit("")).alias("title"), F.lower(F.coalesce(p["email"], F.lit(""))).alias("email")))
    found = F.coalesce(found, F.array().cast(f"array<{PERSON}>"))
    first, last = F.trim(full("decision_maker_first_name")), F.trim(full("decision_maker_last_name"))
    own = F.array(F.struct(first.alias("first"), last.alias("last"), full("decision_maker_title").alias("title"), F.lower(full("public_direct_email")).alias("email")))
    return F.when(F.size(found) > 0, found).when(name_is_confirmed(first, last), own).otherwise(F.array().cast(f"array<{PERSON}>"))


def unattributed_rank(e: Column) -> Column:
    """0 a role, 1 first.last, 2 jsmith, 3 anything else."""
    lp = F.lower(mail_local(e))
    role = "^(" + "|".join(sorted(ROLE_LOCALS, key=lambda w: (-len(w), w))) + ")(?![A-Za-z0-9_])"
    return F.when(lp.rlike(role), 0).when(lp.rlike("^[a-z]+[._-][a-z]+$"), 1).when(lp.rlike("^[a-z]\\.?[a-z]{3,}$"), 2).otherwise(3)


def candidates(most_direct: int = 3, most_shared: int = 3) -> Column:
    """array<CANDIDATE> of a facility: each person's own address or six guesses, then unclaimed direct addresses by rank, then shared boxes."""
    mails = lambda c, own: F.transform(F.filter(F.when(size_of(c) > 0, F.col(c)).otherwise(F.array(full(own))), lambda e: F.coalesce(e, F.lit("")) != ""), F.lower)

    def row(email: Column, kind: Column, rank: Column, published: bool, p: Column | None) -> Column:
        field = lambda c: (p[c] if p is not None else F.lit(None).cast("string")).alias(c)
        return F.struct(email.alias("email"), kind.alias("type"), rank.cast("int").alias("rank"), F.lit(published).alias("published"), field("first"), field("last"), field("title"))

    none = F.array().cast(f"array<{CANDIDATE}>")
    domain = F.lower(F.trim(full("email_domain")))

    def of_person(p: Column) -> Column:
        own = F.array(row(p["email"], F.lit("Published Direct"), F.lit(None), True, p))
        six = guess_emails(p["first"], p["last"], domain)
        guessed = F.filter(F.transform(six, lambda e, i: row(F.lower(e), F.concat(F.lit("Guessed Pattern "), (i + 1).cast("string")), i + 1, False, p)), lambda c: c["email"] != "")
        return F.when(p["email"] != "", own).when(domain != "", guessed).otherwise(none)

    def body(found: Column) -> Column:
        claimed = F.transform(found, lambda p: p["email"])
        free = F.filter(mails("direct_emails", "public_direct_email"), lambda e: ~F.array_contains(claimed, e))
        best = F.slice(F.array_sort(F.transform(free, lambda e: F.struct(unattributed_rank(e).alias("r"), e.alias("e")))), 1, most_direct)
        direct = F.transform(best, lambda s: row(s["e"], F.lit("Published Direct"), F.lit(None), True, None))
        shared = F.transform(F.slice(mails("shared_emails", "shared_facility_email"), 1, most_shared), lambda e: row(e, F.lit("Published Shared"), F.lit(None), True, None))
        return F.concat(F.flatten(F.transform(found, of_person)), direct, shared)

    return let(people_for(), body)


def claimed_candidates(facilities: DataFrame) -> DataFrame:
    """One row per address of facilities(facility_no, ...) with claim and claimed_by: the earlier facility that has the address owns it."""
    rows = facilities.select("*", F.posexplode(candidates()).alias("candidate_no", "c"))
    rows = rows.select("*", "c.*").drop("c").withColumn("claim", F.col("facility_no").cast("long") * 1_000_000 + F.col("candidate_no"))
    return first_claim(rows, "email", "claim")


def fan_out_candidates(facilities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, repeats): one row per address of facilities(facility_no, ...), and those that an earlier facility already claimed."""
    rows = claimed_candidates(facilities)
    names = {"decision_maker_first_name": title_case("first"), "decision_maker_last_name": title_case("last")}
    won = rows.filter("claim = claimed_by").withColumns(names).withColumn("decision_maker_full_name", F.trim(F.concat_ws(" ", "decision_maker_first_name", "decision_maker_last_name")))
    return won, rows.filter("claim <> claimed_by").withColumn("owner_no", F.floor(F.col("claimed_by") / 1_000_000))


def branch_letter(no: Column) -> Column:
    """Letter of a facility's branch by its place from 0: A, B, .. in code point order, the place itself past the Latin letters."""
    return F.when(no < 191, F.char(65 + no)).otherwise(no.cast("string"))


def branches(facilities: DataFrame) -> DataFrame:
    """One row per location of a facility, or one with the facility's city if there is none; the location id's letter goes by place."""
    one = F.array(F.struct(F.lit("").alias("street"), full("city").alias("city"), F.lit("").alias("zip")))
    rows = facilities.select("*", F.posexplode(F.when(size_of("locations") > 0, F.col("locations")).otherwise(one)).alias("branch_no", "branch"))
    return rows.withColumns({
        "location_id": F.concat(F.col("facility_id"), F.lit("-"), branch_letter(F.col("branch_no"))), "branch_street": F.col("branch.street"), "branch_city": F.col("branch.city"), "branch_zip": F.col("branch.zip"),
        "is_multi_location": F.when(size_of("locations") > 1, "Yes").otherwise("No"), "location_count": F.greatest(size_of("locations"), F.lit(1)),
    }).drop("branch")


def branches_of(facilities: DataFrame, places: DataFrame) -> DataFrame:
    """branches for locations that stand in a table of their own: places(extras_website, place_no from 1, street, city, zip), facilities with extras_website and n_locations.

    A website's places are never gathered in one row, and one with more than HOT of them is dealt to several tasks: a chain's branches are
    its facilities times its places. What is a facility's or a place's own is made before the two meet."""
    n = F.coalesce("n_locations", F.lit(0))
    sites = facilities.withColumns({"is_multi_location": F.when(n > 1, "Yes").otherwise("No"), "location_count": F.greatest(n, F.lit(1)).cast("int")})
    letter = branch_letter((F.col("place_no") - 1).cast("int")).alias("__letter")
    seats = places.select("extras_website", "place_no", letter, *[F.coalesce(c, F.lit("")).alias(f"branch_{c}") for c in ("street", "city", "zip")])
    rows = spread_left_join(sites, seats, "extras_website", "place_no", HOT)
    return rows.withColumns({
        "location_id": F.concat(F.col("facility_id"), F.lit("-"), F.coalesce("__letter", F.lit("A"))), "branch_street": F.coalesce("branch_street", F.lit("")),
        "branch_city": F.coalesce("branch_city", full("city")), "branch_zip": F.coalesce("branch_zip", F.lit("")),
    }).drop("__letter")


def emails_found(known: Column | None = None) -> Column:
    """Distinct addresses of a facility; the master's own count only where the contact pass gave no list at all. known: their number where it was counted elsewhere."""
    both = F.concat(F.coalesce(F.col("direct_emails"), F.array(full("public_direct_email"))), F.coalesce(F.col("shared_emails"), F.array(full("shared_facility_email"))))
    size = F.size(F.array_distinct(F.filter(both, lambda e: F.coalesce(e, F.lit("")) != "")))
    return size if known is None else F.coalesce(known.cast("int"), size)


def run_stats(won: DataFrame, repeats: DataFrame, facilities: DataFrame) -> DataFrame:
    cols = ["facility_no", "type", "claim", "claimed_by"]
    return claim_stats(won.select(cols).unionByName(repeats.select(cols)), facilities)


def claim_stats(claims: DataFrame, facilities: DataFrame, n_locations: Column | None = None) -> DataFrame:
    """One row of counts over a run: addresses by kind, facilities with none, people, branches, repeats. claims: all of claimed_candidates."""
    won = F.col("claim") == F.col("claimed_by")
    kinds = claims.agg(
        F.count_if(won & (F.col("type") == "Published Direct")).alias("direct"), F.count_if(won & (F.col("type") == "Published Shared")).alias("shared"),
        F.count_if(won & F.col("type").startswith("Guessed")).alias("guessed"), F.count_distinct(F.when(won, F.col("facility_no"))).alias("facilities_with_rows"), F.count_if(~won).alias("repeats"),
    )
    n, seats = F.size(people_for()), size_of("locations") if n_locations is None else F.coalesce(n_locations, F.lit(0))
    each = facilities.agg(
        F.count("*").alias("facilities"), F.coalesce(F.sum(n), F.lit(0)).alias("people"), F.count_if(n > 1).alias("multi_person"), F.count_if(seats > 1).alias("multi_site"),
        F.coalesce(F.sum(F.greatest(seats, F.lit(1))), F.lit(0)).alias("branches"), F.count_if(F.size(candidates()) == 0).alias("no_email"),
    )
    return kinds.join(each, F.lit(True))
