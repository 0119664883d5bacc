"""Postal addresses of one building, written differently (problem 3).

Method: addresses that agree in house number and in city or ZIP are compared word by word. What stands on one side for
what stands on the other is counted over all such pairs; pairs of words (or of two words) that occur together far more
often than their own frequency explains become rewrites. The addresses are
normalised with them and compared again, until no new rewrite appears. Two addresses are then one building if their street
words agree but for a typing error in a rare word or a missing street ending; words that are common in streets (endings,
directions) must agree, and so must the number. Two words that both stand in many places are two streets, however alike.

Suites, units and PO boxes do not count. Addresses without a house number match nothing. A missing city is taken from
the ZIP's usual city. Equal addresses are one node, so copies make no pairs before the last step. Null or blank fields
are unknown, empty tables give an empty result, repeated rows are paired.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import names
from pagelode.llm.common import cut, table
from pagelode.llm.facility import city_rows
from pagelode.operators.skew import spread_join

HOT = 1_000  # a meeting point with more addresses is dealt to several tasks; no pair of it is left out
SUPPORT, SUPPORT_SHARE = 3, 1e-4  # pairs of places that must show a rewrite; the share bounds the number of rewrites
CONFIDENCE = 0.25  # part of a word's differences that a rewrite must explain, for the rarer of its two sides
Z_LEAST = 4.0  # standard deviations above chance
KNOWN, KNOWN_SHARE = 4, 0.1  # places from which a word is a street's own name, and the least part of the commoner word's places
COMMON = 0.002  # words in this share of the addresses are common street words; there can be no more than words / share

UNIT = re.compile(r"\b(?:suite|ste|unit|bldg|building|floor|fl|apt|room|rm)\b\.?\s*#?\s*[0-9]+[a-z]?\b|\bp\.?\s?o\.?\s*box\s*[0-9]+|\bc/o front desk\b|\brear entrance\b|\b[a-z]+ plaza\b")
AREA = re.compile(r"\b(?:town|village|city|hamlet) ?of\b|\b(?:greater|downtown|upstate|area|usa)\b|/ ?upst\w*|- ?(?:east|west|north|south) side|\bnew york\b|\bn\.? ?y\b\.?")
SCHEMA = "id long, number string, words array<string>, city int, zip string"


def parse_address(street: str | None, city: str | None, zip_: str | None, lex: names.Lexicon) -> tuple[str, list[str], int, str]:
    """(number, street words, city id, ZIP) of an address in one or three fields; '' and 0 for what it lacks."""
    s = names.plain(re.sub(r"[\n|]+", " , ", street or ""))
    s = re.sub(r"\bny-? ?([0-9]{2,3})\b", r"route \1", s)
    code = re.sub(r"[^0-9]", "", names.plain(zip_))[:5]
    if m := re.search(r"\b([0-9]{5})(?:-[0-9]{4})?\b", s):
        code, s = code or m[1], s[: m.start()] + " , " + s[m.end() :]
    s = re.sub(r"\b([0-9]+) (st|nd|rd|th)\b(?! *[0-9])", r"\1\2", UNIT.sub(" ", s))
    s = AREA.sub(" ", s)
    s = re.sub(r"\bno\.? *(?=[0-9])", " ", s)
    marks = re.findall(r"#\s*[0-9]+[a-z]?\b", s)
    if len(marks) > 1:  # the first is the house number
        s = s[: s.rindex(marks[-1])] + s[s.rindex(marks[-1]) + len(marks[-1]) :]
    elif marks and re.search(r"(?<![#0-9a-z])[0-9]+(?:-[0-9]+)?(?![0-9a-z])(?! *(?:st|nd|rd|th)\b)", re.sub(r"#\s*[0-9]+[a-z]?\b", " ", s)) and not re.search(r"^\W*#\s*[0-9]+ +[a-z]+\W*[a-z. ]*(?:,|$)", s):
        s = re.sub(r"#\s*[0-9]+[a-z]?\b", " ", s)
    s = s.replace("#", " ")
    place = lex.city(names.words_of(AREA.sub(" ", names.plain(city))), whole=True)[0] if city else 0
    m = re.search(r"(?<![0-9a-z-])([0-9]+)(?:\s*-\s*[0-9]+)?(?![0-9a-z])", s)
    if not m:
        return "", [], place, code
    number, before, after = m[1].lstrip("0") or "0", s[: m.start()], s[m.end() :]
    after = re.sub(r"^[\s,.]+", "", after)
    parts = [p for p in re.split(r"\s*,\s*|\s-\s", after) if re.search("[a-z0-9]", p)]
    line, rest = (parts[0] if parts else ""), " ".join(parts[1:])
    words = [w for w in re.split(r"[^a-z0-9]+", line.replace("'", "")) if w]
    if not place:
        for text in (rest, before):
            if text and (place := lex.city(names.words_of(text), whole=True)[0]):
                break
    if len(words) > 2:
        at, used = lex.city([names.no_digits(w) for w in words[1:]])
        if at and (not place or at == place) and max(used) == len(words) - 2:
            place, words = place or at, [w for k, w in enumerate(words) if k - 1 not in used]
    return number, words, place, code


def parsed(rows: DataFrame, cities: list[tuple[int, str]]) -> DataFrame:
    """rows(id, street, city, zip) -> SCHEMA."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = names.Lexicon(cities)
        for pdf in batches:
            out = [(r.id, *parse_address(r.street, r.city, r.zip, lex)) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["id", "number", "words", "city", "zip"])

    return rows.select("id", "street", "city", "zip").mapInPandas(run, SCHEMA)


def rewrite(words: list[str], rules: dict[tuple[str, ...], tuple[str, ...]]) -> list[str]:
    """Two-word rewrites first, then single words."""
    out, k = [], 0
    while k < len(words):
        two = tuple(words[k : k + 2])
        if len(two) == 2 and two in rules:
            out.extend(rules[two])
            k += 2
        else:
            out.extend(rules.get((words[k],), (words[k],)))
            k += 1
    return out


def differences(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """Words of each side that the other lacks, counted, in order."""
    x, y = list(a), list(b)
    for w in a:
        if w in y:
            y.remove(w)
            x.remove(w)
    return x, y


def classes(rows: list[tuple[str, str, int]], mass: dict[str, int], total: int) -> dict[str, str]:
    """What each phrase of rows(p, q, n) stands for: classes of phrases merged by how often they stand for each other, named by their longest word.

    Two classes merge if their differences are a good part of all the differences of the rarer one and lie far above chance. Whole classes are held against each other, so that a word that stands for
    many things (a town left in the street) can't chain them together."""
    between: dict[str, dict[str, int]] = {}
    for p, q, n in rows:
        between.setdefault(p, {})[q] = between.setdefault(q, {})[p] = n
    size, members = {w: mass[w] for w in between}, {w: [w] for w in between}

    def fits(a: str, b: str) -> bool:
        n = between[a][b]
        rare = min((a, b), key=lambda w: (size[w], w))
        chance = size[a] * size[b] / (2 * total)
        return n / size[rare] >= CONFIDENCE and (n - chance) / math.sqrt(chance + 1) >= Z_LEAST

    heap = [(-n, p, q) for p, q, n in rows]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        if a not in between or b not in between or between[a].get(b) != -n or not fits(a, b):
            continue
        keep, drop = sorted((a, b), key=lambda w: (" " in w, -len(w), w))
        for w, m in between.pop(drop).items():
            del between[w][drop]
            if w != keep:
                between[keep][w] = between[w][keep] = between[keep].get(w, 0) + m
        size[keep] += size.pop(drop)
        members[keep] += members.pop(drop)
        # what was refused before may fit now that the two are one
        for w, m in between[keep].items():
            heapq.heappush(heap, (-m, *sorted((keep, w))))
    return {w: keep for keep, ws in members.items() for w in ws if w != keep}


def mine(diffs: DataFrame, mass: dict[str, int]) -> dict[tuple[str, ...], tuple[str, ...]]:
    """New rewrites shown by diffs(p, q, at), distinct: phrases of one or two words that stand for each other at a place.

    mass: how often a word differed before; once its own spellings are rewritten, what is left is no evidence by itself."""
    seen = cut(diffs.groupBy("p", "q").agg(F.count("*").alias("n")))
    total = seen.agg(F.sum("n")).collect()[0][0] or 0
    least = max(SUPPORT, math.ceil(SUPPORT_SHARE * total))
    side = seen.select(F.explode(F.array("p", "q")).alias("w"), "n").groupBy("w").agg(F.sum("n").alias("nw"))
    big = seen.filter((F.col("n") >= least) & ~F.concat("p", "q").rlike("[0-9]"))  # at most total / least rows
    big = big.join(side.select(F.col("w").alias("p"), F.col("nw").alias("np")), "p").join(side.select(F.col("w").alias("q"), F.col("nw").alias("nq")), "q")
    rows = big.collect()
    for r in rows:
        mass[r.p], mass[r.q] = max(mass.get(r.p, 0), r.np), max(mass.get(r.q, 0), r.nq)
    found = classes(sorted((r.p, r.q, r.n) for r in rows), mass, total)
    for w, keep in found.items():
        mass[keep] += mass[w]
    return {tuple(w.split(" ")): tuple(keep.split(" ")) for w, keep in found.items()}


def street_typos(a: list[str], b: list[str], common: set[str], ends: set[str]) -> list[tuple[str, str]] | None:
    """The word pairs in which two normalised streets differ by typing errors, but for a missing ending; None if they differ in more."""
    x, y = differences(a, b)
    if not (a and b):
        return None
    for p, q in ((x, y), (y, x)):
        if len(p) == len(q) + 1 and (lost := [w for w in p if w in ends]) and not any(w in ends for w in q):
            p.remove(lost[-1])
            break
    if len(x) != len(y):
        return None
    left, typos = list(y), []
    for w in x:
        best = min(left, key=lambda v: (distance(w, v), v))
        d, size = distance(w, best), max(len(w), len(best))
        if (w in common and best in common) or re.search("[0-9]", w + best) or not (d <= 1 and size >= 4 or d <= 2 and size >= 6 or d <= 3 and size >= 10):
            return None
        left.remove(best)
        typos.append((w, best))
    return typos


def same_street(a: list[str], b: list[str], common: set[str], ends: set[str]) -> bool:
    """Whether normalised street words differ in nothing but typing errors in rare words and a missing ending."""
    return street_typos(a, b, common, ends) is not None


def distance(a: str, b: str) -> int:
    """Edit distance in which swapped neighbours count once."""
    if abs(len(a) - len(b)) > 3:
        return 9
    two, one = None, list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        row = [i]
        for j, cb in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (ca != cb))
            if two and i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, one = one, row
    return one[-1]


def address_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    here = table(spark, sf_dir, "ny_indoor_courts_locations").select(F.col("location_row_id").alias("id"), F.col("branch_street").alias("street"), F.col("branch_city").alias("city"), F.col("branch_zip").alias("zip"))
    none = F.lit(None).cast("string")
    there = table(spark, sf_dir, "n8n_indoor_courts_5_row_reference").select(F.col("track_row_id").alias("id"), F.col("address").alias("street"), none.alias("city"), none.alias("zip"))
    return here.unionByName(there)


def buildings(rows: DataFrame, cities: list[tuple[int, str]]) -> tuple[DataFrame, DataFrame, dict]:
    """(members(id, node), pairs(a, b) of nodes that are one building, rewrites)."""
    rec = cut(parsed(rows, cities).filter("number <> '' and size(words) > 0"))
    usual = rec.filter("zip <> '' and city > 0").groupBy("zip", "city").count().groupBy("zip").agg(F.max(F.struct("count", "city")).alias("m")).select("zip", F.col("m.city").alias("usual"))
    rec = rec.join(usual, "zip", "left").withColumn("city", F.when(F.col("city") > 0, F.col("city")).otherwise(F.coalesce("usual", F.lit(0)))).drop("usual")
    keyed = rec.withColumn("k", F.struct("number", "words", "city", "zip"))
    heads = keyed.groupBy("k").agg(F.min("id").alias("node"))
    members = cut(keyed.select("id", "k").join(heads, "k").select("id", "node"))
    node = cut(heads.select("node", "k.*"))
    rules: dict[tuple[str, ...], tuple[str, ...]] = {}
    mass: dict[str, int] = {}
    while True:  # every round but the last finds a phrase that has no rewrite yet, and there are only so many
        streets = cut(normalised(node, rules))
        new = {k: v for k, v in mine(differing(streets), mass).items() if k not in rules}
        if not new:
            break
        rules = {k: tuple(rewrite(list(v), new)) for k, v in rules.items()} | new
    return members, one_building(streets), rules


def normalised(node: DataFrame, rules: dict) -> DataFrame:
    """node(node, number, words, city, zip) with its words rewritten."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(words=[rewrite(list(w), rules) for w in pdf["words"]])

    return node.select("node", "number", "words", "city", "zip").mapInPandas(run, "node long, number string, words array<string>, city int, zip string")


def meetings(streets: DataFrame) -> DataFrame:
    """(a, b, number, city, wa, wb, x, y): addresses that agree in number and in city or ZIP; x and y are the words that only one of them has."""
    at = F.filter(F.array(F.when(F.col("city") > 0, F.concat_ws("|", F.lit("c"), "city", "number")), F.when(F.col("zip") != "", F.concat_ws("|", F.lit("z"), "zip", "number"))), lambda x: x.isNotNull())
    spread = streets.select("node", "number", "words", "city", F.explode(at).alias("at"))
    a = spread.select(F.col("node").alias("a"), "number", "at", F.col("words").alias("wa"), "city")
    b = spread.select(F.col("node").alias("b"), "at", F.col("words").alias("wb"))
    pairs = spread_join(a, b, "at", "b", HOT).filter("a < b")
    return pairs.withColumns({"x": F.array_except("wa", "wb"), "y": F.array_except("wb", "wa")})


def differing(streets: DataFrame) -> DataFrame:
    """(p, q, at), distinct: what stands on one side for what stands on the other, where addresses agree in a word of their own; phrases as typed."""
    nx, ny = F.size("x"), F.size("y")
    pairs = meetings(streets).filter((nx > 0) & (ny > 0) & (nx <= 2) & (ny <= 2) & (nx + ny <= 3) & ((nx < F.size("wa")) | (ny < F.size("wb"))))
    p, q = F.array_join("x", " "), F.array_join("y", " ")
    spaced = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    inside = lambda words, phrase: F.contains(spaced(F.array_join(words, " ")), spaced(phrase))
    pairs = pairs.filter(inside("wa", p) & inside("wb", q))  # two words count as a phrase where they stand together
    return pairs.select(F.least(p, q).alias("p"), F.greatest(p, q).alias("q"), F.concat_ws("|", "number", "city").alias("at")).distinct()


def one_building(streets: DataFrame) -> DataFrame:
    """(a, b) of normalised addresses that are one building, distinct."""
    n = streets.count()
    word = streets.select("number", "city", F.explode(F.array_distinct("words")).alias("w"))
    common = {r.w for r in word.groupBy("w").count().filter(F.col("count") >= max(5, COMMON * n)).select("w").collect()}
    last = streets.select(F.element_at("words", -1).alias("last"))
    ends = {r["last"] for r in last.groupBy("last").count().filter(F.col("count") >= max(5, 5 * COMMON * n)).collect()} - {w for w in common if len(w) == 1} - {"north", "south", "east", "west"}
    pairs = cut(meetings(streets).filter((F.size("x") <= 4) & (F.abs(F.size("x") - F.size("y")) <= 1)).select("a", "b", "wa", "wb", "x", "y"))
    alike = pairs.filter((F.size("x") == 0) & (F.size("y") == 0)).filter(F.sort_array("wa") == F.sort_array("wb")).select("a", "b")
    # one word against one of another length class needs no second look
    near = (F.size("x") != 1) | (F.size("y") != 1) | (F.levenshtein(F.get("x", F.lit(0)), F.get("y", F.lit(0))) <= 6)
    rest = pairs.filter(near & ((F.size("x") > 0) | (F.size("y") > 0) | (F.sort_array("wa") != F.sort_array("wb")))).select("a", "b", "wa", "wb").distinct()

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            typos = [street_typos(list(x), list(y), common, ends) for x, y in zip(pdf["wa"], pdf["wb"], strict=True)]
            hit = [t is not None for t in typos]
            said = pd.Series([[w for pq in t for w in pq] for t in typos if t is not None], dtype=object)
            yield pdf.loc[hit, ["a", "b"]].reset_index(drop=True).assign(typos=said)

    found = cut(rest.mapInPandas(match, "a long, b long, typos array<string>"))  # the words of each pair one after the other
    sure = found.filter("size(typos) = 0").select("a", "b")
    typed = found.filter("size(typos) > 0").select("a", "b", "typos", F.explode(F.sequence(F.lit(0), F.size("typos") - 2, F.lit(2))).alias("k")).select("a", "b", F.get("typos", F.col("k")).alias("p"), F.get("typos", F.col("k") + 1).alias("q"))
    place = word.distinct().groupBy("w").agg(F.count("*").alias("n"))
    both = typed.join(place.select(F.col("w").alias("p"), F.col("n").alias("np")), "p").join(place.select(F.col("w").alias("q"), F.col("n").alias("nq")), "q")
    two = (F.least("np", "nq") >= KNOWN) & (F.least("np", "nq") >= KNOWN_SHARE * F.greatest("np", "nq"))
    typed = both.groupBy("a", "b").agg(F.max(two).alias("two")).filter("not two").select("a", "b")
    return alike.unionByName(sure).unionByName(typed).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """address_id_a, address_id_b: records of one building, within and across both tables, smaller id first."""
    members, pairs, _ = buildings(address_rows(spark, sf_dir), city_rows(spark, sf_dir))
    links = pairs.unionByName(members.select(F.col("node").alias("a"), F.col("node").alias("b")).distinct())
    a, b = members.select(F.col("id").alias("x"), F.col("node").alias("a")), members.select(F.col("id").alias("y"), F.col("node").alias("b"))
    both = links.join(a, "a").join(b, "b").filter("a <> b or x < y")
    return both.select(F.least("x", "y").alias("address_id_a"), F.greatest("x", "y").alias("address_id_b")).distinct()


def p3_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """typed, stands_for: the rewrites mined from both tables."""
    _, _, rules = buildings(address_rows(spark, sf_dir), city_rows(spark, sf_dir))
    return spark.createDataFrame([(" ".join(k), " ".join(v)) for k, v in sorted(rules.items())], "typed string, stands_for string")
