"""Best representative of each group of duplicate records (problem 2).

Method: skyline selection. Every record is a point of completeness, recency and trust; completeness counts the fields whose
value is undamaged and believed. A report of a reliable source is believed; one of another source only if it is later than
the last reliable report of the field and a second such report, or what the record's mail address or last name implies,
agrees with it. The records of a group that no other record dominates are its first layer, those that only records of the
first dominate the second, and so on. A field survives with the value of the first layer that has one, so a null is filled
from the successive layers; within a layer the lexicographic policy is recency, then trust, then support. A field that no
believed report fills takes the value with most support, then trust, then recency.

Groups of up to SMALL records get their layers in one row of arrays, larger ones are peeled a layer at a time by joins and
combinable aggregates, until no group is left that holds a field not yet filled: the layers are the same either way.

Records without a group give no row. Null, blank, placeholder and damaged values are incomplete. Null crawl times count
as the oldest, unknown sources as trust 0. Remaining ties go to the larger text in code point order. Empty tables give an
empty result; repeated rows count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm.canonical import CITY, city_entries, map_texts
from pagelode.llm.common import cut, plain, repair_fragments, table
from pagelode.functions.text import repair_mojibake, squash_spaces
from pagelode.operators.skew import salted_join

SMALL = 64  # records of a group whose layers are found in one row; larger groups are peeled
FIELDS = ("public_direct_email", "decision_maker_last_name", "number_of_courts", "city")


@dataclass(frozen=True)
class Policy:
    """What belongs to a kind of records and not to the method."""

    reliable_from: int = 80  # trust_score from which a source reports what it saw
    courts: tuple[int, int] = (1, 60)  # plausible counts; others are misread
    # what stands in a last-name field for no name, and mailboxes of nobody in particular
    no_name: tuple[str, ...] = ("(none listed)", "last name", "first name", "manager", "owner", "staff", "tbd", "unknown", "n/a", "na", "none", "null", "contact", "info", "see staff page")
    no_person: tuple[str, ...] = ("info", "noreply", "no-reply", "name", "support", "office", "frontdesk", "hello", "play", "courts", "contact", "mail", "admin", "front desk")


POLICY = Policy()


def own_domain(rows: DataFrame) -> DataFrame:
    """(dup_group, own): the host a group's mail goes to: named by its email_domain, else by its addresses and websites."""
    host = F.regexp_extract(F.lower(F.trim("website")), "^(?:https?:/{1,2})?(?:[^/@]*@)?(?:www\\.|m\\.|book\\.)?([a-z0-9.-]+\\.[a-z]+)", 1)
    mail = F.regexp_extract(F.lower(F.trim("public_direct_email")), "(?:@|\\[at\\])([a-z0-9-]+(?:\\.[a-z0-9-]+)+)$", 1)
    named = F.lower(F.trim("email_domain"))
    each = rows.select("dup_group", F.explode(F.array(F.struct(named.alias("d"), F.lit(1000).alias("w")), F.struct(host.alias("d"), F.lit(1).alias("w")), F.struct(mail.alias("d"), F.lit(1).alias("w")))).alias("x"))
    each = each.select("dup_group", "x.d", "x.w").filter("d is not null and d <> ''")
    per = each.groupBy("dup_group", "d").agg(F.sum("w").alias("w"))
    # a host that nobody names as his own and that several groups use belongs to none of them
    shared = per.groupBy("d").agg(F.max("w").alias("top"), F.count("*").alias("groups")).filter("top >= 1000 or groups = 1").select("d")
    return per.join(shared, "d").groupBy("dup_group").agg(F.max(F.struct("w", "d")).alias("b")).select("dup_group", F.col("b.d").alias("own"))


def reports(rows: DataFrame, trust: DataFrame, cities: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """(dup_group, row_id, records, at, trust, said): one row per different record, said the fields whose value is undamaged or can be repaired: array of (field, key, show)."""
    base = rows.select("facility_row_id",
        "dup_group", "website", "email_domain", "city", "number_of_courts", "court_count_notes", "decision_maker_last_name", "public_direct_email", "record_source",
        F.coalesce("crawled_at", F.lit(0).cast("timestamp")).alias("at"),
    )
    base = base.groupBy(*base.columns[1:]).agg(F.min("facility_row_id").alias("row_id"), F.count("*").alias("records"))
    trust = trust.groupBy("record_source").agg(F.max("trust_score").alias("trust"))
    base = base.join(trust, "record_source", "left").withColumn("trust", F.coalesce("trust", F.lit(0)))
    base = salted_join(base, own_domain(rows), "dup_group", "row_id", "left")
    texts = base.select(F.col("city").alias("text")).filter("trim(city) <> ''").distinct()
    named = cut(map_texts(texts, cities, CITY)).join(cities, "entry").select(F.col("text").alias("city"), F.col("name").alias("city_name"))
    base = salted_join(base, named, "city", "row_id", "left")

    mail = F.replace(F.replace(F.lower(squash_spaces("public_direct_email")), F.lit("[at]"), F.lit("@")), F.lit(","), F.lit("."))
    local, dom = F.substring_index(mail, "@", 1), F.regexp_extract(mail, "@(.*)$", 1)
    own = F.col("own")
    ok = mail.rlike("^[^@\\s]+@[^@\\s]*$") & ~local.isin(*policy.no_person) & F.when(own.isNotNull(), F.startswith(own, dom)).otherwise(dom.rlike("^[a-z0-9-]+(\\.[a-z0-9-]+)+$") & ~dom.contains("yourdomain"))
    email = F.when(ok, F.concat(local, F.lit("@"), F.coalesce(own, dom)))

    last = squash_spaces(repair_fragments(repair_mojibake("decision_maker_last_name")))
    low = F.lower(last)
    letters = F.regexp_replace(plain(low), "[^a-z]", "")
    last = F.when((F.length(letters) > 2) & ~low.isin(*policy.no_name), low)

    noted = F.expr("try_cast(regexp_extract(court_count_notes, '(-?[0-9]+)', 1) as int)")
    seen = F.coalesce(noted, "number_of_courts")
    courts = F.when(seen.between(*policy.courts), seen.cast("string"))

    value = lambda name, show, key: F.when(key.isNotNull(), F.struct(F.lit(name).alias("field"), key.alias("key"), show.alias("show")))
    each = F.array(
        value("public_direct_email", email, email), value("decision_maker_last_name", last, F.when(last.isNotNull(), letters)),
        value("number_of_courts", courts, courts), value("city", F.lower("city_name"), F.lower("city_name")),
    )
    return base.select("dup_group", "row_id", "records", "at", "trust", F.filter(each, lambda v: v.isNotNull()).alias("said"))


def support(said: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """(dup_group, field, key, last, late, n, show): of every value of said(dup_group, at, trust, field, key, show) how many reports give it, how many after the field's last reliable one, and its fullest spelling.

    late counts an agreement with the other field's likely value too: a last name with the address it shows in, and the reverse."""
    sure = F.col("trust") >= policy.reliable_from
    last = said.groupBy("dup_group", "field").agg(F.max(F.when(sure, F.struct("at", "key"))).alias("r"), F.max(F.struct("at", "key")).alias("l"))
    # the latest reliable value, or the latest at all, is what the other field is held against
    swap = F.when(F.col("field") == "public_direct_email", F.lit("decision_maker_last_name")).when(F.col("field") == "decision_maker_last_name", F.lit("public_direct_email"))
    hint = last.select("dup_group", swap.alias("field"), F.coalesce("r.key", "l.key").alias("text")).filter("field is not null")
    per = said.groupBy("dup_group", "field", "key", "at", "trust").agg(F.count("*").alias("n"), F.max(F.struct(F.length(F.encode("show", "utf-8")).alias("b"), "show")).alias("s"))
    per = per.join(last.select("dup_group", "field", F.col("r.at").alias("last")), ["dup_group", "field"])
    late = ~(F.col("trust") >= policy.reliable_from) & (F.col("last").isNull() | (F.col("at") > F.col("last")))
    per = per.groupBy("dup_group", "field", "key").agg(F.max("last").alias("last"), F.sum(F.when(late, F.col("n")).otherwise(0)).alias("late"), F.sum("n").alias("n"), F.max("s").alias("s"))
    per = per.join(hint, ["dup_group", "field"], "left")
    a, b = F.regexp_replace(F.substring_index("key", "@", 1), "[^a-z]", ""), F.regexp_replace(F.substring_index("text", "@", 1), "[^a-z]", "")
    fits = F.when(F.col("field") == "decision_maker_last_name", F.endswith(b, a)).otherwise(F.endswith(a, b) & (F.length(b) > 2))
    agrees = F.coalesce(fits, F.lit(False)).cast("int")
    return per.select("dup_group", "field", "key", "last", (F.col("late") + agrees).alias("late"), (F.col("n") + agrees).alias("n"), F.col("s.show").alias("show"))


def over(a: Column, b: Column) -> Column:
    """Whether the point a(full, at, trust) dominates b."""
    least = (a["full"] >= b["full"]) & (a["at"] >= b["at"]) & (a["trust"] >= b["trust"])
    return least & ((a["full"] > b["full"]) | (a["at"] > b["at"]) | (a["trust"] > b["trust"]))


POINT = ("full", "at", "trust")


def small_layers(points: DataFrame) -> DataFrame:
    """points(dup_group, row_id, full, at, trust, vals) with their layer, 1 for the undominated; a group's points in one row on the way."""

    def add(done: Column, p: Column) -> Column:
        above = F.array_max(F.transform(F.filter(done, lambda q: over(q, p)), lambda q: q["layer"]))
        row = F.struct(*[p[c].alias(c) for c in (*POINT, "row_id", "vals")], (F.coalesce(above, F.lit(0)) + 1).alias("layer"))
        return F.concat(done, F.array(row))

    kind = f"array<struct<full:int,at:timestamp,trust:int,row_id:bigint,vals:{points.schema['vals'].dataType.simpleString()},layer:int>>"
    one = points.groupBy("dup_group").agg(F.sort_array(F.collect_list(F.struct(*POINT, "row_id", "vals")), asc=False).alias("p"))  # whatever dominates comes first
    return one.select("dup_group", F.explode(F.aggregate("p", F.array().cast(kind), add)).alias("p")).select("dup_group", "p.*")


def peeled(points: DataFrame) -> DataFrame:
    """The same for groups of any size, as far as a layer still brings a field that the layers before lack."""
    rest, out, turn = points, None, 0
    while True:
        turn += 1
        # a cell's latest points are its only undominated ones; a group has as many cells as fields and trust scores allow
        cells = rest.groupBy("dup_group", "full", "trust").agg(F.max("at").alias("at"))
        sky = cells.groupBy("dup_group").agg(F.collect_list(F.struct(*POINT)).alias("c")).select("dup_group", F.explode(F.filter("c", lambda x: ~F.exists("c", lambda y: over(y, x)))).alias("x")).select("dup_group", "x.*")
        sky = cut(sky)
        top = rest.join(sky, ["dup_group", *POINT]).withColumn("layer", F.lit(turn))
        out = cut(top if out is None else out.unionByName(top))
        below = rest.join(sky, ["dup_group", *POINT], "left_anti")
        fields = lambda d: d.select("dup_group", F.explode("vals.field").alias("field")).distinct()
        wanting = fields(below).join(fields(out), ["dup_group", "field"], "left_anti").select("dup_group").distinct()
        rest = cut(below.join(wanting, "dup_group", "left_semi"))
        if rest.isEmpty():
            return out.select("dup_group", *POINT, "row_id", "vals", "layer")


def layered(points: DataFrame) -> DataFrame:
    """points(dup_group, row_id, full, at, trust, vals) with their layer. points is read twice: cut it first."""
    sizes = points.groupBy("dup_group").agg(F.count("*").alias("size"))
    big = cut(sizes.filter(F.col("size") > SMALL).select("dup_group"))
    if big.isEmpty():
        return small_layers(points)
    small = small_layers(points.join(big, "dup_group", "left_anti"))
    return small.unionByName(peeled(cut(points.join(big, "dup_group", "left_semi"))))


def skyline(rows: DataFrame, trust: DataFrame, cities: DataFrame, policy: Policy = POLICY) -> tuple[DataFrame, DataFrame]:
    """(records with their layer and believed values, support of every value)."""
    rec = cut(reports(rows, trust, cities, policy))
    said = rec.select("dup_group", "row_id", "at", "trust", F.explode("said").alias("v")).select("dup_group", "row_id", "at", "trust", "v.*")
    known = cut(support(said, policy).withColumn("k", F.xxhash64("dup_group", "field", "key")))
    held = salted_join(said.withColumn("k", F.xxhash64("dup_group", "field", "key")), known.select("k", "last", "late", "n"), "k", "row_id")
    late = (F.col("last").isNull() | (F.col("at") > F.col("last"))) & (F.col("late") >= 2)
    held = held.filter((F.col("trust") >= policy.reliable_from) | late).groupBy("row_id").agg(F.collect_list(F.struct("field", "n", "key")).alias("vals"))
    none = F.array().cast("array<struct<field:string,n:bigint,key:string>>")
    points = rec.select("dup_group", "row_id", "at", F.col("trust").cast("int").alias("trust")).join(held, "row_id", "left").withColumn("vals", F.coalesce("vals", none)).withColumn("full", F.size("vals"))
    return cut(layered(cut(points))), known


def _values(layers: DataFrame, known: DataFrame) -> DataFrame:
    """(dup_group, field, show): each field's value from the first layer that has it, by the policy; else the value with most support."""
    each = layers.select("dup_group", "layer", "at", "trust", F.explode("vals").alias("v"))
    first = each.groupBy("dup_group", F.col("v.field").alias("field")).agg(F.max(F.struct((-F.col("layer")).alias("up"), "at", "trust", "v.n", "v.key")).alias("b"))
    rest = known.groupBy("dup_group", "field").agg(F.max(F.struct("n", "key")).alias("r"))
    pick = rest.join(first, ["dup_group", "field"], "left").select("dup_group", "field", F.coalesce("b.key", "r.key").alias("key"))
    return pick.join(known.select("dup_group", "field", "key", "show"), ["dup_group", "field", "key"]).select("dup_group", "field", "show")


def winners(rows: DataFrame, trust: DataFrame, cities: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """(dup_group, field, show): the surviving value of each field of each group, in lower case."""
    return _values(*skyline(rows, trust, cities, policy))


def _held(name: str) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.col(name).cast("string"), "^[\\s\\u00a0]+|[\\s\\u00a0]+$", "")))


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "new_york_indoor_court_facilities").filter("dup_group is not null")
    return rows, table(spark, sf_dir, "record_sources").select("record_source", "trust_score"), city_entries(spark, sf_dir)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dup_group, field_name, facility_row_id: the smallest record that holds the surviving value of the field."""
    rows, trust, cities = _inputs(spark, sf_dir)
    won = winners(rows, trust, cities)
    held = rows.select("dup_group", "facility_row_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), _held(f).alias("show")) for f in FIELDS])).alias("v"))
    held = held.select("dup_group", "facility_row_id", F.col("v.field").alias("field"), F.col("v.show").alias("show")).filter("show is not null")
    held = held.groupBy("dup_group", "field", "show").agg(F.min("facility_row_id").alias("facility_row_id"))
    return held.join(won, ["dup_group", "field", "show"]).select("dup_group", F.col("field").alias("field_name"), "facility_row_id")


def survivors(rows: DataFrame, trust: DataFrame, cities: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """One record per group: the first layer's most trusted record (then the latest, then the fullest), how many records and how many undominated ones there are, and the fields as they survive."""
    layers, known = skyline(rows, trust, cities, policy)
    n = rows.groupBy("dup_group").agg(F.count("*").alias("records"))
    base = layers.filter("layer = 1").groupBy("dup_group").agg(F.max(F.struct("trust", "at", "full", (-F.col("row_id")).alias("neg"))).alias("b"), F.count("*").alias("undominated"))
    base = base.select("dup_group", (-F.col("b.neg")).alias("base_row_id"), "undominated")
    flat = _values(layers, known).groupBy("dup_group").agg(*[F.max(F.when(F.col("field") == f, F.col("show"))).alias(f) for f in FIELDS])
    return n.join(base, "dup_group").join(flat, "dup_group", "left").select("dup_group", "base_row_id", "records", "undominated", *FIELDS)


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(*_inputs(spark, sf_dir))
