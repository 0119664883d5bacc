"""Facility and contact records in comparable form, and how alike two of them are."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import names
from pagelode.llm.common import table

MAX_CITIES = 50_000  # the list of cities goes to every worker; a longer one is refused
COMMON_SHARE = 0.004  # words in this share of the names are common ones; there can be no more than words per name / share
COMMON_LEAST = 20
FREE_SHARE, FREE_LEAST = 0.005, 8  # a mail domain with this share of the different mailboxes is nobody's own; there can be no more than 1 / share of them


def city_rows(spark: SparkSession, sf_dir: str) -> list[tuple[int, str]]:
    rows = [(r.city_id, r.city_name) for r in table(spark, sf_dir, "city_list").limit(MAX_CITIES + 1).collect() if r.city_id is not None and r.city_name]
    if len(rows) > MAX_CITIES:
        raise ValueError(f"more than {MAX_CITIES} cities; raise MAX_CITIES if the workers' memory allows it")
    return rows


def common_words(texts: DataFrame, col: str, share: float = COMMON_SHARE, least: int = COMMON_LEAST) -> list[str]:
    """Words in at least share of the texts: a list whose length the share bounds, whatever the size of the table."""
    n = texts.count()
    words = texts.select(F.explode(F.array_distinct(F.split(F.lower(F.col(col)), "[^a-zà-ÿ]+"))).alias("w")).filter("length(w) > 1")
    return [r.w for r in words.groupBy("w").count().filter(F.col("count") >= max(least, int(share * n))).select("w").collect()]


def free_mail(rows: DataFrame) -> list[str]:
    """Domains of rows(shared) whose shared mailboxes have many different names: a facility's own has a few (info, office), a mail service one for each customer. The share bounds the list."""
    mail = F.lower(F.trim("shared"))
    boxes = rows.select(F.regexp_extract(mail, "^([^@\\s]+)@", 1).alias("box"), F.regexp_extract(mail, "@([a-z0-9.-]+\\.[a-z]+)$", 1).alias("mail")).filter("box <> '' and mail <> ''").distinct()
    n = boxes.count()
    return sorted(r.mail for r in boxes.groupBy("mail").count().filter(F.col("count") >= max(FREE_LEAST, int(FREE_SHARE * n))).select("mail").collect())


FACILITY_SCHEMA = "id long, core string, kinds int, unit string, ncity int, ccity int, initials string, acro string, acro_town string, host string, slug string, given string, family string, email string, courts int, generic boolean, common boolean, short string"


def facility_records(rows: DataFrame, cities: list[tuple[int, str]], common: list[str], free: Sequence[str] = ()) -> DataFrame:
    """rows(id, name, website, city, email_domain, shared, direct, first, last, courts) in comparable form, one row each.

    kinds has a bit for each kind of KIND_WORDS; short is what an abbreviated name may stand for, '' if it is none.
    free: mail domains that are nobody's own, beside the public ones.

    Optional columns: address (a postal address that names the city) and person (a full name) where city and last are missing."""
    rows = rows.select("id", "name", "website", "city", "email_domain", "shared", "direct", "first", "last", "courts", *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("address", "person")])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = names.Lexicon(cities, common)
        shared_hosts = names.FREE_MAIL | set(free)
        read = names.memo(lambda s: names.parse_facility(s, lex))
        family_of = names.memo(lambda s: "".join(names.parse_person(s)[1]))
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                p = read(r.name or "")
                host, slug = names.parse_host(r.website, r.email_domain, (r.shared,), shared_hosts)
                p = names.complete(p, host, lex)
                place = names.words_of(names.plain(r.city))
                given, family = names.plain(r.first), family_of(r.last) if r.last else ""
                town = lex.city(place, whole=True)[0]
                if r.address:
                    town = lex.city(names.words_of(re.sub(r"\bnew york\b|\busa\b|\bn\.?y\b\.?", " ", names.plain(r.address))))[0]
                if r.person:
                    g, f = names.parse_person(r.person)
                    given, family = "".join(g), "".join(f)
                direct = names.plain(r.direct)
                generic = bool(p["core"]) and all(w in lex.common for w in p["core"])
                sq = "".join(p["core"])
                short = p["acro"] if not sq else sq if not p["kinds"] and len(p["core"]) == 1 and len(sq) <= 8 else ""
                out.append((
                    r.id, " ".join(p["core"]), sum(names.KIND_BIT[k] for k in set(p["kinds"])), p["unit"], p["city"], town, p["initials"], p["acro"], p["acro_town"], host, slug, given,
                    family if len(family) > 2 else "", direct if "@" in direct else "", None if pd.isna(r.courts) or not 1 <= r.courts <= 60 else int(r.courts), generic, bool(p["core"]) and p["core"][0] in lex.common,
                    short,
                ))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FACILITY_SCHEMA.split(", ")])

    return rows.mapInPandas(parse, FACILITY_SCHEMA)


def master_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "new_york_indoor_court_facilities").select(
        F.col("facility_row_id").alias("id"), "dup_group", F.col("facility_name").alias("name"), "website", "city", "email_domain", F.col("shared_facility_email").alias("shared"),
        F.col("public_direct_email").alias("direct"), F.col("decision_maker_first_name").alias("first"), F.col("decision_maker_last_name").alias("last"), F.col("number_of_courts").alias("courts"),
    )


def outreach_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.coalesce("contact_email", "work_email", "final_email")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "n8n_indoor_courts_5_row_reference").select(
        F.col("track_row_id").alias("id"), F.col("company_name").alias("name"), "website", none.alias("city"), F.regexp_extract(F.lower(F.trim(email)), "@(.+)$", 1).alias("email_domain"),
        none.alias("shared"), email.alias("direct"), none.alias("first"), none.alias("last"), F.lit(None).cast("int").alias("courts"), "address", F.col("contact_name").alias("person"),
    )


def grams(text: Column, n: int = 4) -> Column:
    """Distinct character n-grams of a text; a shorter text is its only gram."""
    last = F.length(text) - (n - 1)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(F.filter(cut, lambda g: g != ""))


def ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 where one is empty."""
    size = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 1 - F.levenshtein(a, b) / size).otherwise(0.0)


def facility_similarity(a: str, b: str) -> Column:
    """Similarity in 0..1 of two facility records under the prefixes a and b; 0 and less where a rule forbids the pair."""
    f = lambda p, c: F.col(f"{p}_{c}")
    have = lambda c: (f(a, c) != "") & (f(b, c) != "")
    same = lambda c: have(c) & (f(a, c) == f(b, c))
    both = lambda c: (f(a, c) > 0) & (f(b, c) > 0)
    sa, sb = (F.replace(f(p, "core"), F.lit(" ")) for p in (a, b))
    wa, wb = (F.substring_index(f(p, "core"), " ", 1) for p in (a, b))
    shorter = F.least(F.length(sa), F.length(sb))
    head = (shorter >= 5) & (F.startswith(sa, sb) | F.startswith(sb, sa)) & (f(a, "initials") == "") & (f(b, "initials") == "")
    # a name partly in initials: its first word and the first letter of the next word of the other
    part = lambda p, q: (f(p, "initials") != "") & (f(q, "initials") == "") & (ratio(wa, wb) >= 0.7) & ((f(p, "initials") == F.substring(f(q, "acro"), 2, 99)) | (f(p, "initials") == F.substring(f(q, "acro_town"), 2, 99))) & (f(p, "core") != "")
    whole = lambda p, q: (F.length(f(p, "short")) >= 2) & ((f(p, "short") == f(q, "acro")) | (f(p, "short") == f(q, "acro_town")))
    slug = lambda p, s: (F.length(f(p, "slug")) >= 6) & (F.startswith(s, f(p, "slug")) | F.startswith(f(p, "slug"), s)) & (F.length(s) >= 6)
    core = F.greatest(
        ratio(sa, sb), F.when(head, 0.9).otherwise(0.0), F.when(part(a, b) | part(b, a), 0.9).otherwise(0.0), F.when(whole(a, b) | whole(b, a), 0.8).otherwise(0.0),
        F.when(same("host") & ((f(a, "short") != "") | (f(b, "short") != "")), 0.85).otherwise(0.0),
        F.when(((f(a, "core") == "") & slug(a, sb)) | ((f(b, "core") == "") & slug(b, sa)), 0.9).otherwise(0.0),
    )
    half = lambda x, y: F.bit_count(x.bitwiseAND(y)) * 2 >= F.least(F.bit_count(x), F.bit_count(y))
    telling = sum(bit for k, bit in names.KIND_BIT.items() if k not in names.GENERIC)
    ka, kb = f(a, "kinds"), f(b, "kinds")
    ta, tb = ka.bitwiseAND(F.lit(telling)), kb.bitwiseAND(F.lit(telling))
    # kinds are what is left of a name that two facilities of one brand differ in; common ones say so too, they only agree for less
    kind = F.when((ka == 0) | (kb == 0), 0.0).when((ta != 0) & (tb != 0), F.when(half(ta, tb), 0.5).otherwise(-6.0)).when(half(ka, kb), 0.0).otherwise(-6.0)
    host = F.when(~have("host"), 0.0).when(f(a, "host") == f(b, "host"), 2.5).otherwise(-4.0)
    place = F.when(both("ncity"), F.when(f(a, "ncity") == f(b, "ncity"), 1.0).otherwise(-6.0)).otherwise(0.0)
    either = (f(a, "ccity") > 0) & ((f(a, "ccity") == f(b, "ccity")) | (f(a, "ccity") == f(b, "ncity"))) | (f(b, "ccity") > 0) & (f(b, "ccity") == f(a, "ncity"))
    town = F.when(either, 1.0).when(both("ccity") | ((f(a, "ccity") > 0) & (f(b, "ncity") > 0)) | ((f(b, "ccity") > 0) & (f(a, "ncity") > 0)), -1.2).otherwise(0.0)
    unit = F.when(have("unit"), F.when(f(a, "unit") == f(b, "unit"), 2.5).otherwise(-9.0)).when((f(a, "unit") != "") | (f(b, "unit") != ""), -1.0).otherwise(0.0)
    chain = F.when((f(a, "generic") | f(b, "generic")) & ~same("unit"), F.when(either & (same("family") | same("email")), 0.0).otherwise(-4.0)).otherwise(0.0)
    person = F.when(same("family"), 1.2).when(have("family"), -0.3).otherwise(0.0) + F.when(same("email"), 1.5).otherwise(0.0)
    courts = F.when(f(a, "courts") == f(b, "courts"), 0.5).when(f(a, "courts") != f(b, "courts"), -0.2).otherwise(0.0)
    # a host or a page name starts with the name it was made of

    def made_of(p: str, q: str, sq: Column) -> Column:
        fits = lambda x: F.levenshtein(F.substring(x, F.lit(1), F.least(F.length(x), F.length(sq))), F.substring(sq, F.lit(1), F.least(F.length(x), F.length(sq)))) <= 2
        full = f(q, "core").contains(" ") & ~f(q, "generic")
        by_host = F.when((f(p, "host") != "") & (f(q, "host") == "") & full, F.when(fits(f(p, "host")), 1.0).otherwise(-2.5)).otherwise(0.0)
        by_slug = F.when((F.length(f(p, "slug")) >= 9) & full, F.when(fits(f(p, "slug")), 0.5).otherwise(-2.0)).otherwise(0.0)
        return by_host + by_slug

    made = made_of(a, b, sb) + made_of(b, a, sa)
    # logistic in the fields; the core counts from a ratio of about 0.75 up
    z = 14.0 * (F.least(core, F.lit(0.95)) - 0.8) + kind + host + place + town + unit + chain + person + courts + made
    # branches told apart by number or by the city in their names are certain not to be one
    apart = (have("unit") & (f(a, "unit") != f(b, "unit"))) | (both("ncity") & (f(a, "ncity") != f(b, "ncity")))
    return F.when(apart, -1.0).otherwise(F.round(1 / (1 + F.exp(-z)), 4))
