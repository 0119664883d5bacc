"""Records of two tables without a common key matched, each match with a confidence (problem 5).

Method: the q-grams of every attribute are encoded as fixed bit vectors. Close vectors are found exactly by multi-index
Hamming hashing: a vector is cut into one piece more than the radius, so two vectors within the radius agree in at least
one piece; records meet on (context, piece) and the Hamming distance is checked on the spot. The vectors searched are those
of the name's first word, of the host and of the mail address; short names in letters meet by their letters and town. The
Dice scores of the attributes' vectors are added with weights, joined with an exact comparison of the fields into one
score, and that score is turned into a confidence by a monotone calibration on pairs of master rows whose identity is known,
one of the two stripped of what the other table lacks.

A facility's name may give its town; a group takes the town that any of its names gives. An outreach record stands at its
address, so a master record of another town by name is a branch elsewhere and no match; nor is one that lacks a town in its
name but stands in a town where such a branch was met, unless person or mail agree. Of a known group all rows match or none,
and an outreach record gets one group or rows without a group, whichever has more behind it.

Records without a name that can be read, a host or a listing page match nothing. Null fields count as unknown. Repeated
rows get their own pairs. Either table empty gives an empty result. The calibration looks at no more than FIT_ROWS
records of whole groups; bins without any known pair take their own middle as the rate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import let
from pagelode.llm.common import cut
from pagelode.llm.names import KIND_BIT
from pagelode.llm.facility import city_rows, common_words, facility_records, facility_similarity, free_mail, grams, master_rows, outreach_rows
from pagelode.operators.skew import salted_join, spread_join

# Index vectors count letters (q = 1): a transposition changes no bit, an insertion one, a substitution two.
LETTERS = "etaoinsrhldcumfpgwybvkxjqz"  # by frequency, dealt to the pieces in turn so that all are equally filled
PIECES, SLOT = 4, 14  # pieces of 14 bits: 7 letters, each counted up to 2
NEAR, ANYWHERE = 3, 1  # radius within a context, and without one
FIT_ROWS = 10_000  # labelled records used for the calibration: one half of their groups fits it, the other is held out
BINS = 20
WEIGHTS = {"core": 4.0, "kinds": 1.5, "host": 3.0, "family": 1.0, "email": 1.0}
DICE_SHARE = 0.4  # of the final score; the rest is the exact comparison of the fields
SURE = 0.5
HOT = 1_000  # a meeting point with more records is dealt to several tasks; no pair of it is left out


def bits(text: Column, q: int = 2) -> Column:
    """64-bit vector of the padded q-grams of a text: one bit per gram."""
    g = grams(F.concat(F.lit("_"), F.replace(text, F.lit(" "), F.lit("_")), F.lit("_")), q)
    one = F.lit(1).cast("long")
    return F.aggregate(g, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))


def letter_bits(text: Column) -> Column:
    """56-bit vector of the letters of a text, each counted up to two, in PIECES pieces of SLOT bits."""

    def add(acc: Column, k: Column) -> Column:
        n = F.length(text) - F.length(F.replace(text, F.substring(F.lit(LETTERS), k + 1, F.lit(1))))
        two = F.when(n >= 2, 3).when(n == 1, 1).otherwise(0).cast("long")
        return acc.bitwiseOR(F.call_function("shiftleft", two, (k % PIECES) * SLOT + F.floor(k / PIECES).cast("int") * 2))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(LETTERS) - 1)), F.lit(0).cast("long"), add)


def dice(a: Column, b: Column) -> Column:
    """2 |a and b| / (|a| + |b|) of two bit vectors; null where one is empty."""
    n = F.bit_count(a) + F.bit_count(b)
    return F.when((a != 0) & (b != 0), 2 * F.bit_count(a.bitwiseAND(b)) / n)


def encode(rec: DataFrame) -> DataFrame:
    """Bit vectors of the attributes and the contexts in which a record may meet others."""
    core = F.when(F.col("core") == "", F.col("slug")).otherwise(F.col("core"))
    first = F.when(F.col("generic"), core).otherwise(F.substring_index(core, " ", 1))
    empty = F.lit(0).cast("long")
    vec = lambda c: F.when(F.length(c) > 0, bits(c)).otherwise(empty)
    return rec.select(
        "*", let(F.coalesce(first, F.lit("")), letter_bits).alias("v_first"), vec(F.col("core")).alias("v_core"), F.col("kinds").bitwiseAND(F.lit(~(KIND_BIT["club"] | KIND_BIT["center"]))).cast("long").alias("v_kinds"),
        vec(F.col("host")).alias("v_host"), vec(F.col("family")).alias("v_family"), vec(F.substring_index("email", "@", 1)).alias("v_email"),
        let(F.col("host"), letter_bits).alias("l_host"), let(F.col("email"), letter_bits).alias("l_mail"),
    )


def meeting_keys(rec: DataFrame) -> DataFrame:
    """(id, k, v, r): the pieces of a record's vectors, by context; r is the radius within which v must agree.

    A chain, whose name is all common words, meets by branch number or city only."""
    none = F.array().cast("array<string>")
    towns = F.transform(F.array_distinct(F.filter(F.array("ncity", "ccity"), lambda c: c > 0)), lambda c: F.concat(F.lit("c"), c))
    unit = F.when(F.col("unit") != "", F.array(F.concat(F.lit("u"), F.col("unit")))).otherwise(none)
    noun = F.when(F.col("core").contains(" ") & ~F.col("generic"), F.array(F.concat(F.lit("n"), F.substring_index("core", " ", -1)))).otherwise(none)
    at = F.when(F.size(unit) > 0, unit).otherwise(towns)
    by_name = F.when(F.col("v_first") == 0, none).when(F.col("generic"), at).otherwise(F.concat(noun, towns))
    pieces = lambda v, r: [F.concat_ws(":", F.lit(i), F.shiftrightunsigned(v, i * (PIECES // (r + 1)) * SLOT).bitwiseAND(F.lit((1 << (PIECES // (r + 1)) * SLOT) - 1))) for i in range(r + 1)]
    within = lambda ctx, v, r: F.flatten(F.transform(ctx, lambda c: F.transform(F.array(*pieces(v, r)), lambda p: F.concat(c, F.lit("|"), p))))
    free = F.when((F.col("v_first") == 0) | F.col("common"), none).otherwise(F.array(F.lit("w")))
    by_host = F.when(F.col("host") == "", none).when(F.col("generic"), F.transform(at, lambda c: F.concat(F.lit("h"), c))).otherwise(F.array(F.lit("h")))
    by_mail = F.when(F.col("email") == "", none).otherwise(F.array(F.lit("m")))
    said = F.filter(F.array_distinct(F.array("acro", "acro_town", F.replace("core", F.lit(" ")))), lambda x: F.length(x).between(3, 8))
    acro = F.when(F.col("generic"), none).otherwise(F.flatten(F.transform(towns, lambda c: F.transform(said, lambda y: F.concat(F.lit("a"), y, c)))))
    search = [(by_name, "v_first", NEAR), (free, "v_first", ANYWHERE), (by_host, "l_host", ANYWHERE), (by_mail, "l_mail", ANYWHERE)]
    parts = [rec.select("id", F.explode(F.array_distinct(within(ctx, v, r))).alias("k"), F.col(v).alias("v"), F.lit(r).alias("r")) for ctx, v, r in search]
    parts.append(rec.select("id", F.explode(F.array_distinct(acro)).alias("k"), F.lit(0).cast("long").alias("v"), F.lit(0).alias("r")))
    return reduce(DataFrame.unionByName, parts).select("id", F.xxhash64("k").alias("k"), "v", "r")


def close_pairs(left: DataFrame, right: DataFrame, within: bool = False) -> DataFrame:
    """(a, b) of two sets of meeting keys whose vectors are within the radius, right's read from a table; within: both sets are the same, a < b."""
    a = left.select(F.col("id").alias("a"), "k", F.col("v").alias("va"), "r")
    b = right.select(F.col("id").alias("b"), "k", F.col("v").alias("vb"))
    hit = spread_join(a, b, "k", "b", HOT).filter(F.bit_count(F.col("va").bitwiseXOR(F.col("vb"))) <= F.col("r"))
    return (hit.filter("a < b") if within else hit).select("a", "b").distinct()


COLS = ["core", "short", "kinds", "unit", "ncity", "ccity", "initials", "acro", "acro_town", "host", "slug", "given", "family", "email", "courts", "generic", *[f"v_{c}" for c in WEIGHTS]]


def scored(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, score, away, town, person): pairs whose fields agree, with the final score.

    away: b is of another town by name; town: the town that b's name or, if it gives none, its city field says; person: a name or an address agrees."""
    side = lambda d, p: d.select(F.col("id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in COLS])
    both = pairs.join(side(left, "a"), "a").join(side(right, "b"), "b").withColumn("check", facility_similarity("a", "b")).filter(F.col("check") >= SURE)
    parts = {c: dice(F.col(f"a_v_{c}"), F.col(f"b_v_{c}")) for c in WEIGHTS}
    weight = sum(F.when(parts[c].isNotNull(), w).otherwise(0.0) for c, w in WEIGHTS.items())
    total = sum(F.coalesce(parts[c], F.lit(0.0)) * w for c, w in WEIGHTS.items())
    score = F.when(weight > 0, total / weight).otherwise(0.0) * DICE_SHARE + F.col("check") * (1 - DICE_SHARE)
    here = lambda c: (F.col(c) == F.col("a_ccity")) | (F.col(c) == F.col("a_ncity"))
    placed = (F.col("a_ccity") > 0) | (F.col("a_ncity") > 0)
    agree = lambda c: (F.col(f"a_{c}") != "") & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    town = F.when(F.col("b_ncity") > 0, F.col("b_ncity")).otherwise(F.col("b_ccity"))
    return both.select(
        "a", "b", score.alias("score"), (placed & (F.col("b_ncity") > 0) & ~here("b_ncity")).alias("away"), F.when(placed & ~here("b_ccity"), town).otherwise(0).alias("town"),
        (agree("family") | agree("email")).alias("person"),
    )


def at_home(pairs: DataFrame) -> DataFrame:
    """Pairs of scored that are no branch elsewhere: neither by name, nor by standing in the town of one that was met."""
    branch = pairs.filter("away").select("a", "town").distinct()
    return pairs.filter("not away").withColumn("town", F.when(~F.col("person") & (F.col("town") > 0), F.col("town"))).join(branch, ["a", "town"], "left_anti")


def bin_of(score: Column) -> Column:
    return F.least(F.floor(score * BINS), F.lit(BINS - 1)).cast("int")


def calibration(known: DataFrame) -> list[float]:
    """Match rate per score bin of known(score, same), made monotone by pooling neighbours; BINS numbers."""
    rows = {int(r.bin): (r.n, r.hits) for r in known.groupBy(bin_of(F.col("score")).alias("bin")).agg(F.count("*").alias("n"), F.sum(F.col("same").cast("int")).alias("hits")).collect()}
    pools: list[list[float]] = []  # hits, n, bins
    for b in range(BINS):
        n, hits = rows.get(b, (0, 0))
        pools.append([hits + 0.5 * ((b + 0.5) / BINS), n + 0.5, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return [h / n for h, n, k in pools for _ in range(int(k))]


def group_towns(rows: DataFrame) -> DataFrame:
    """dup_group, named, stood: of each group the town most of its names give (0 if none) and the town it most often stands in."""
    said = rows.filter("dup_group is not null").select("dup_group", F.explode(F.array(F.struct(F.lit(1).alias("by_name"), F.col("ncity").alias("town")), F.struct(F.lit(0).alias("by_name"), F.col("ccity").alias("town")))).alias("x"))
    n = said.filter("x.town > 0").groupBy("dup_group", "x.by_name", "x.town").agg(F.count("*").alias("n"))
    best = n.groupBy("dup_group").agg(F.max(F.when(F.col("by_name") == 1, F.struct("n", "town"))).alias("a"), F.max(F.when(F.col("by_name") == 0, F.struct("n", "town"))).alias("b"))
    return best.select("dup_group", F.coalesce("a.town", F.lit(0)).alias("named"), F.coalesce("b.town", F.lit(0)).alias("stood"))


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(outreach, master) records encoded; the master's with dup_group, named and stood."""
    cities = city_rows(spark, sf_dir)
    master, outreach = master_rows(spark, sf_dir), outreach_rows(spark, sf_dir)
    common, free = common_words(master, "name"), free_mail(master)
    right = cut(facility_records(master, cities, common, free).join(master.select("id", "dup_group"), "id"))
    right = salted_join(right, group_towns(right), "dup_group", "id", "left").fillna(0, ["named", "stood"])
    right = right.withColumn("ncity", F.when(F.col("ncity") > 0, F.col("ncity")).otherwise(F.col("named")))
    return encode(facility_records(outreach, cities, common, free)), cut(encode(right))


def stripped(right: DataFrame) -> DataFrame:
    """Records of a sample of whole groups as an outreach record would show them, under negative ids."""
    sample = right.filter("dup_group is not null").orderBy(F.xxhash64("dup_group"), "dup_group", "id").limit(FIT_ROWS)
    town = F.when(F.col("named") > 0, F.col("named")).otherwise(F.col("stood"))
    return sample.withColumns({"id": -F.col("id") - 1, "courts": F.lit(None).cast("int"), "ccity": town})


def scored_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, score) of all records of left, and of the stripped sample (a < 0), with the records of right; both go through one search."""
    cols = [c for c in left.columns if c in right.columns]
    both = cut(left.select(cols).unionByName(stripped(right).select(cols)))
    pairs = close_pairs(meeting_keys(both), cut(meeting_keys(right)))
    return cut(at_home(cut(scored(pairs, both, right))).select("a", "b", "score"))


def labelled(pairs: DataFrame, right: DataFrame) -> DataFrame:
    """(score, same, half) of the sample's pairs with grouped records."""
    groups = right.filter("dup_group is not null").select("id", "dup_group")
    known = pairs.filter("a < 0").withColumn("a", -F.col("a") - 1).filter("a <> b")
    known = known.join(groups.select(F.col("id").alias("a"), F.col("dup_group").alias("g_a")), "a").join(groups.select(F.col("id").alias("b"), F.col("dup_group").alias("g_b")), "b")
    return known.select("score", (F.col("g_a") == F.col("g_b")).alias("same"), F.pmod(F.xxhash64(F.lit("half"), "g_a"), F.lit(2)).alias("half"))


def confidence(score: Column, rates: list[float]) -> Column:
    return F.round(F.get(F.array(*[F.lit(float(r)) for r in rates]), bin_of(score)), 4)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track_row_id, facility_row_id, confidence of every pair over the threshold."""
    left, right = prepared(spark, sf_dir)
    pairs = scored_pairs(left, right)
    rates = calibration(labelled(pairs, right).filter("half = 0"))
    sure = pairs.filter("a >= 0").withColumn("confidence", confidence(F.col("score"), rates)).filter(F.col("confidence") >= SURE).select("a", "b", "confidence")
    # rows known to be one facility are matched together
    members = right.filter("dup_group is not null").select("id", "dup_group")
    told = cut(sure.join(members.withColumnRenamed("id", "b"), "b", "left"))
    votes = told.filter("dup_group is not null").groupBy("a", "dup_group").agg(F.max("confidence").alias("confidence"), F.sum("confidence").alias("mass"))
    best = votes.groupBy("a").agg(F.max(F.struct("mass", "confidence", "dup_group")).alias("t")).select("a", F.col("t.dup_group").alias("dup_group"), F.col("t.confidence").alias("confidence"), F.col("t.mass").alias("mass"))
    alone = told.filter("dup_group is null").select("a", "b", "confidence")
    weight = alone.groupBy("a").agg(F.sum("confidence").alias("alone"))
    grouped = best.join(weight, "a", "left").filter(F.coalesce("alone", F.lit(0.0)) <= F.col("mass")).select("a", "dup_group", "confidence")
    alone = alone.join(best.select("a", "mass"), "a", "left").join(weight, "a").filter(F.coalesce("mass", F.lit(0.0)) < F.col("alone")).select("a", "b", "confidence")
    return grouped.join(members, "dup_group").select("a", F.col("id").alias("b"), "confidence").unionByName(alone).select(F.col("a").alias("track_row_id"), F.col("b").alias("facility_row_id"), "confidence")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir).select("track_row_id", "facility_row_id")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir)


def p5_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """confidence, pairs, match_rate: how often pairs of held-out groups are true, by the confidence that the fitted half gives them."""
    left, right = prepared(spark, sf_dir)
    known = cut(labelled(scored_pairs(left.limit(0), right), right))
    rates = calibration(known.filter("half = 0"))
    held = known.filter("half = 1").withColumn("confidence", confidence(F.col("score"), rates))
    return held.groupBy("confidence").agg(F.count("*").alias("pairs"), F.round(F.avg(F.col("same").cast("double")), 4).alias("match_rate"))
