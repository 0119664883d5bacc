"""From crawled facility rows to the master list: addresses cleaned, duplicates collapsed on two keys, contacts listed once.

Rows are flat and in lower snake case; '' and null both mean missing and come out as null. Every step needs a unique
order number column ord; results do not depend on partitioning. Other columns travel along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.extract import guess_emails, looks_like_publisher, mail_host
from pagelode.functions.text import let, name_key
from pagelode.functions.urls import apex_domain
from pagelode.operators.keyed import packed, packed_order, richest_per_key
from pagelode.operators.lineage import cut
from pagelode.profile import BRAND_STOP_WORDS, FREE_MAIL_FINAL, GUESS_NOTE

FOREIGN_NOTE = "Third-party email removed (not on facility domain)."
REPEATED_NOTE = "Duplicate contact removed."


def full(c: str) -> Column:
    """The text of a column, '' for null."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def blank(c: Column) -> Column:
    return F.when(c != "", c)


def site(row_domain: Column | None = None) -> Column:
    """Apex of the mail domain a row names, or of its website."""
    named = row_domain if row_domain is not None else full("email_domain")
    return apex_domain(F.when(named != "", named).otherwise(full("website")))


def richness(prefix: str = "") -> Column:
    """How much of a contact a row holds, 0 to 10."""
    has = lambda c, n: F.when(full(prefix + c) != "", n).otherwise(0)
    return has("public_direct_email", 4) + has("shared_facility_email", 2) + has("decision_maker_last_name", 2) + has("number_of_courts", 1) + has("city", 1)


def with_site(rows: DataFrame) -> DataFrame:
    """__site: the row's own host, worked out once for all the steps that ask for it."""
    return rows if "__site" in rows.columns else rows.withColumn("__site", site())


def without_publishers(rows: DataFrame) -> DataFrame:
    return with_site(rows).filter(~looks_like_publisher("facility_name", F.col("__site")))


def strip_foreign_emails(rows: DataFrame) -> DataFrame:
    """Addresses that are neither on the facility's hosts, nor on free mail, nor on a host with one of its name's words are blanked, with a note."""
    words = F.filter(F.split(F.lower(full("facility_name")), "[^a-z]+"), lambda w: (F.length(w) >= 5) & ~w.isin(*BRAND_STOP_WORDS))

    def ours(e: Column) -> Column:
        def body(x: Column) -> Column:
            host, apex = x["host"], x["apex"]
            label = F.regexp_replace(F.regexp_replace(host, "\\.[a-z.]+$", ""), "[^a-z]", "")
            kin = (host == apex) | F.endswith(host, F.concat(F.lit("."), apex)) | F.endswith(apex, F.concat(F.lit("."), host)) | host.isin(*FREE_MAIL_FINAL)
            return (host != "") & (kin | F.exists(words, lambda w: F.contains(label, w)))

        return let(F.struct(mail_host(e).alias("host"), F.col("__site").alias("apex")), body)

    rows = with_site(rows)
    bad = {c: (full(c) != "") & ~ours(full(c)) for c in ("public_direct_email", "shared_facility_email")}
    rows = rows.withColumns({f"__bad_{c}": x for c, x in bad.items()})
    gone = F.col("__bad_public_direct_email") | F.col("__bad_shared_facility_email")
    noted = F.trim(F.concat(full("research_notes"), F.lit(" " + FOREIGN_NOTE)))
    return rows.withColumns({
        "public_direct_email": F.when(~F.col("__bad_public_direct_email"), F.col("public_direct_email")), "shared_facility_email": F.when(~F.col("__bad_shared_facility_email"), F.col("shared_facility_email")),
        "research_notes": F.when(gone, noted).otherwise(F.col("research_notes")),
    }).drop("__bad_public_direct_email", "__bad_shared_facility_email")


def mail_domain(own: Column | None = None) -> Column:
    """own: the site's apex, where it is known already. Host of the first published address that is not free mail, else the site's apex unless that is; '' if neither."""
    good = lambda h: (h != "") & ~h.isin(*FREE_MAIL_FINAL)
    d, s, a = mail_host(full("public_direct_email")), mail_host(full("shared_facility_email")), site() if own is None else own
    return F.when(good(d), d).when(good(s), s).otherwise(let(a, lambda x: F.when(x.isin(*FREE_MAIL_FINAL), "").otherwise(x)))


def normalize_rows(rows: DataFrame) -> DataFrame:
    """Foreign addresses out, mail domain set, six guesses made anew where a person has no address, and the note about them kept true."""
    rows = strip_foreign_emails(rows).withColumn("email_domain", mail_domain(F.col("__site"))).drop("__site")
    named = (full("decision_maker_first_name") != "") & (full("decision_maker_last_name") != "") & (full("email_domain") != "") & (full("public_direct_email") == "")
    rows = rows.withColumn("__g", F.when(named, guess_emails("decision_maker_first_name", "decision_maker_last_name", "email_domain")).otherwise(F.array_repeat(F.lit(""), 6)))
    bare = F.trim(F.regexp_replace(F.replace(full("research_notes"), F.lit(GUESS_NOTE), F.lit("")), "\\s+", " "))
    notes = F.when(F.get("__g", F.lit(0)) != "", F.trim(F.concat(bare, F.lit(" " + GUESS_NOTE)))).otherwise(bare)
    return rows.withColumns({f"guessed_email_{i + 1}": blank(F.get("__g", F.lit(i))) for i in range(6)} | {"research_notes": blank(notes), "email_domain": blank(F.col("email_domain"))}).drop("__g")


def collapse(rows: DataFrame) -> DataFrame:
    """Richest row per site, then per name and city; ord3 is the place a surviving key had first."""
    site_key = let(site(), lambda d: F.concat(F.lit("d:"), F.when(d != "", d).otherwise(full("website"))))
    one = richest_per_key(rows.withColumn("__score", richness()), site_key, F.col("__score"), "ord", "ord2")
    name = let(name_key("facility_name"), lambda k: F.when(k != "", F.concat(F.lit("n:"), k, F.lit("|"), F.lower(full("city")))).otherwise(F.concat(F.lit("w:"), full("website"))))
    return richest_per_key(one, name, F.col("__score"), "ord2", "ord3")


def blank_repeated_contacts(rows: DataFrame) -> DataFrame:
    """A direct address listed for one facility name more than once stays with the richest row only."""
    rows = rows.withColumns({"__mail": F.lower(full("public_direct_email")), "__nk": name_key("facility_name"), "__p": packed("__score", "ord3")})
    owner = rows.filter("__mail <> '' and __nk <> ''").groupBy("__mail").agg(F.max("__p").alias("__top"))
    owner = owner.withColumn("ord3", packed_order(F.col("__top"))).join(rows.select("ord3", F.col("__nk").alias("__owner")), "ord3").select("__mail", "__top", "__owner")
    rows = rows.join(owner, "__mail", "left")
    again = F.coalesce((F.col("__mail") != "") & (F.col("__nk") == F.col("__owner")) & (F.col("__p") != F.col("__top")), F.lit(False))
    return rows.withColumns({"public_direct_email": F.when(~again, F.col("public_direct_email")), "research_notes": F.when(again, F.trim(F.concat(full("research_notes"), F.lit(" " + REPEATED_NOTE)))).otherwise(F.col("research_notes"))}).drop("__mail", "__nk", "__p", "__top", "__owner")


def in_final_order(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """By status in the order given, then by name as people sort names, then richest first."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in statuses]), F.coalesce(F.col("qualification_status"), F.lit(""))), F.lit(0)), F.lit(10))
    return rows.orderBy(place, F.expr("coalesce(facility_name, '') COLLATE UNICODE"), F.col("__score").desc(), "ord3")


def finalize(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """The whole path from crawled rows to the master list, in its final order."""
    done = blank_repeated_contacts(collapse(normalize_rows(without_publishers(rows))))
    return in_final_order(done, statuses).drop("__score", "ord2", "ord3")


def numbered(rows: DataFrame, order: str, prefix: Column | str) -> DataFrame:
    """facility_no 1, 2, .. by order and facility_id made of it, at least four digits wide.

    Numbers are dense and global without sorting everything in one task: the order keys are range-partitioned and each partition
    starts where the keys before it end. Only the keys, which must be unique, are written; the rows join their number."""
    # cut, because sampled range bounds may differ from one evaluation to the next
    spread = cut(rows.select(order).repartitionByRange(F.col(order)).sortWithinPartitions(order))
    spread = spread.withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id())
    spread = spread.withColumn("__in", F.col("__id") - F.shiftleft(F.col("__part").cast("long"), 33))
    sizes = spread.groupBy("__part").count().collect()  # one row a partition
    start, at = [], 0
    for r in sorted(sizes, key=lambda r: r["__part"]):
        start.append((r["__part"], at))
        at += r["count"]
    offsets = F.create_map(*[F.lit(x) for kv in start for x in kv]) if start else F.create_map(F.lit(0), F.lit(0))
    no = (F.try_element_at(offsets, F.col("__part")) + F.col("__in") + 1).cast("long")
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return rows.join(spread.select(order, no.alias("facility_no")), order).withColumn("facility_id", F.format_string("%s-%04d", p, "facility_no"))
