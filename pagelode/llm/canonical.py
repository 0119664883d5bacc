"""Free-entered values mapped to a canonical list (problem 4).

Method: every distinct token is repaired against the vocabulary of the list (edit distance by shared deletions,
truncations, consonant abbreviations, run-together words, initials of entries), then soft TF-IDF over the repaired
tokens ranks whole entries. All work is on distinct texts and distinct tokens; rows come in only for the last join.

Null or blank texts give no row. Texts that no entry fits get ref_id 0. Ties go to the smaller id. An empty list maps
every text to 0; repeated rows each get their row; other columns of the input are left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelode.llm.common import cut, deletions, letters_for_digits, plain, table


@dataclass(frozen=True)
class Rules:
    """What belongs to a kind of list and not to its entries."""

    rewrites: tuple[tuple[str, str], ...] = ()  # patterns of a typed text and what stands for them, in order
    stop: tuple[str, ...] = ("of", "and", "the")  # words that count neither in texts nor in entries
    synonyms: dict[str, str] = field(default_factory=dict)  # typed word: word of the list
    fillers: tuple[str, ...] = ()  # words around an entry that say nothing about it, for comparisons of two typed texts
    initials: bool = False  # entries of several words are known by their initials
    short_content: bool = False  # the word that tells entries apart may be abbreviated, not just mistyped or cut
    unknown: float = 0.8  # weight of a typed word without a reading, as a part of the highest
    cover: float = 0.5  # part of the text and of the entry that must be explained
    least: float = 0.62  # soft TF-IDF from which an entry fits
    broadcast_entries: int = 5_000  # lists up to so many entries are broadcast, longer ones joined by shuffle


CITY = Rules(
    rewrites=(
        ("\\b(town|village|city|hamlet|county|borough) ?of\\b", " "), ("\\b(greater|downtown|upstate|area)\\b", " "), ("/ ?upst\\w*\\W*$", " "),
        ("- ?(east|west|north|south) side", " "), ("\\bnew york\\b", " "), ("\\bn\\.? ?y\\b\\.?", " "), ("\\busa\\b", " "), ("\\b[0-9]+\\b", " "),
    ),
    synonyms={"ste": "saint"},
)
TITLE = Rules(
    rewrites=(
        ("\\b(whole club|main building|see staff page|since day one|full time|founding member)\\b", " "), ("\\bco-ordinator", "coordinator"),
        ("\\b(president|owner|founder) of the club\\b", "$1"), ("\\bclub (president|owner|founder)\\b", "$1"), ("\\bracquet sports\\b", "racquets"),
        ("\\b(part|joint)[- ]owner|\\bone of the owners", "co owner"), ("\\bchief operations\\b", "chief operating"), ("\\bpickle ball\\b", "pickleball"), ("\\bbuilding /", " "), ("^\\W*(mr|mrs|ms|mx|dr|prof)\\W*$", " "),
        ("\\b(interim|acting|our|title|since|operator|sole|ny)\\b", " "), ("\\b[0-9]+\\b", " "),
    ),
    synonyms={
        "pro": "professional", "prof": "professional", "deputy": "assistant", "racket": "racquets", "rackets": "racquets", "pb": "pickleball",
        "proprietor": "owner", "ops": "operations", "oper": "operations", "programme": "program", "supv": "supervisor", "finance": "financial",
        "athletics": "athletic", "member": "membership", "facilities": "facility", "mgt": "manager",
    },
    fillers=("our", "interim", "acting", "title", "since", "full", "time", "main", "building", "ny", "see", "staff", "page", "whole"),
    initials=True, short_content=True, unknown=1.0, cover=0.55,
)


def tokens(text: Column, rules: Rules) -> Column:
    """Distinct words of a text, in order, as the operator compares them."""
    c = F.regexp_replace(text, "(?<=[a-zé])(?=[A-Z][a-z])", " ")
    c = F.regexp_replace(plain(c), "[_|*]", " ")
    c = F.regexp_replace(c, "(?<=\\b[a-z])\\.(?=[a-z]\\b)", "")
    for pattern, put in rules.rewrites:
        c = F.regexp_replace(c, pattern, put)
    c = letters_for_digits(F.regexp_replace(c, "'", ""))
    return F.array_distinct(F.filter(F.split(c, "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*rules.stop, "")))


def _vocabulary(entries: DataFrame, n: int, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(entry, tok, idf) and what a typed word may stand for: (word, tok, part); part is null but for short forms, of which each tok is a part."""
    base = entries.select("entry", F.posexplode(tokens(F.col("name"), Rules())).alias("pos", "tok"))
    df = base.groupBy("tok").agg(F.count_distinct("entry").alias("df"))
    idf = df.select("tok", F.log(1 + F.lit(n) / F.col("df")).alias("idf"))
    parts = base.join(idf, "tok")
    whole = base.groupBy("entry").agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("w"))
    whole = whole.filter(F.size("w") > 1)
    alias = whole.select("entry", F.array_join(F.col("w.tok"), "").alias("word"), F.col("w.tok").alias("toks"))
    if rules.initials:
        short = F.array_join(F.transform("w.tok", lambda t: F.substring(t, 1, 1)), "")
        every = entries.select("entry", F.array_join(F.transform(tokens(F.col("name"), Rules(stop=())), lambda t: F.substring(t, 1, 1)), "").alias("all"))
        short = whole.join(every, "entry").select("entry", F.explode(F.array_distinct(F.array(short, "all"))).alias("word"), F.col("w.tok").alias("toks"))
        alias = alias.unionByName(short)
    # a short form that several entries share, or that is a word of the list, says nothing
    alias = alias.join(alias.groupBy("word").agg(F.count("*").alias("c")).filter("c = 1").select("word"), "word")
    alias = alias.join(idf.select(F.col("tok").alias("word")), "word", "left_anti")
    told = alias.select("word", "entry", F.explode("toks").alias("tok")).join(idf, "tok")
    told = told.withColumn("part", F.col("idf") ** 2 / F.sum(F.col("idf") ** 2).over(W.partitionBy("word")))
    words = idf.select(F.col("tok").alias("word"), "tok", F.lit(None).cast("double").alias("part")).unionByName(told.select("word", "tok", "part"))
    return parts, words


def leads(word: Column) -> Column:
    """What an abbreviation of a word may begin with: its first letter and one or two later ones in order, each combination once."""
    at = lambda i: F.substring(word, i, F.lit(1))
    rest = F.when(F.length(word) >= 2, F.sequence(F.lit(2), F.length(word))).otherwise(F.array().cast("array<int>"))
    three = F.flatten(F.transform(rest, lambda i: F.transform(F.filter(rest, lambda j: j > i), lambda j: F.concat(at(F.lit(1)), at(i), at(j)))))
    return F.array_distinct(F.concat(F.transform(rest, lambda i: F.concat(at(F.lit(1)), at(i))), three))


def _repairs(typed: DataFrame, words: DataFrame, rules: Rules, small: bool) -> DataFrame:
    """(token, tok, sim): what each distinct typed token may stand for in the list."""
    hint = F.broadcast if small else (lambda x: x)
    exact = typed.join(hint(words), typed.token == words.word).select("token", "tok", F.lit(1.0).alias("sim"), "part")
    known = words.select(F.col("word").alias("token")).distinct()
    syn = typed.filter(F.lit(False)).select("token", F.lit("").alias("tok"), F.lit(0.95).alias("sim"), F.lit(None).cast("double").alias("part"))
    if rules.synonyms:
        table_ = F.create_map(*[F.lit(x) for kv in rules.synonyms.items() for x in kv])
        syn = typed.select("token", F.try_element_at(table_, F.col("token")).alias("tok")).filter("tok is not null")
        syn = syn.join(hint(words.select("tok").distinct()), "tok", "left_semi").select("token", "tok", F.lit(0.95).alias("sim"), F.lit(None).cast("double").alias("part"))
    free = typed.join(hint(known), "token", "left_anti")
    depth = lambda c: F.when(F.length(c) >= 5, 2).when(F.length(c) >= 4, 1).otherwise(0)
    a = free.select("token", F.explode(deletions(F.col("token"), depth(F.col("token")))).alias("d")).select("token", F.col("d.v").alias("v"), F.col("d.n").alias("n"))
    b = words.select("word", "tok", "part", F.explode(deletions(F.col("word"), depth(F.col("word")))).alias("d")).select("word", "tok", "part", F.col("d.v").alias("v"), F.col("d.n").alias("m"))
    near = a.join(hint(b), "v").groupBy("token", "word", "tok", "part").agg(F.min(F.greatest("n", "m")).alias("d"))
    size = F.greatest(F.length("token"), F.length("word"))
    near = near.filter((F.col("d") <= 1) | (F.least(F.length("token"), F.length("word")) >= 5)).select("token", "tok", (1 - F.col("d") / size).alias("sim"), "part")
    # truncations: the token is a beginning of the word; abbreviations: its letters in order within the word, the first one first
    w = words.filter("part is null").select("word", "tok").filter(F.length("word") > 2)
    heads = w.select("word", "tok", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("token"))
    cut = free.join(hint(heads), "token").select("token", "word", "tok", F.lit(True).alias("head"))
    k = w.select("word", "tok", F.explode(leads(F.col("word"))).alias("k"))
    f = free.filter(F.length("token") >= 2).select("token", F.substring("token", 1, 3).alias("k"))
    share = F.length("token") / F.length("word")
    within = F.rlike(F.col("word"), F.concat(F.lit("^"), F.regexp_replace("token", "(.)", "$1.*")))
    thin = f.join(hint(k), "k").filter((F.length("token") < F.length("word")) & (share >= 0.25) & ~F.startswith(F.col("word"), F.col("token")) & within)
    cut = cut.unionByName(thin.select("token", "word", "tok", F.lit(False).alias("head")))
    head = F.col("head")
    long = F.length("token") >= 3
    cut = cut.select(
        "token", "tok", F.when(head & long, 0.95).when(head, 0.8).otherwise(0.8 + 0.15 * share).alias("sim"), F.lit(None).cast("double").alias("part"),
        (F.lit(rules.short_content) & (F.length("token") >= 2) | head & (F.length("token") >= 5)).alias("content"),
    )
    sure = lambda x: x.select("token", "tok", "sim", "part", F.lit(True).alias("content"))
    exact, syn, near = sure(exact), sure(syn), sure(near)
    return exact.unionByName(syn).unionByName(near).unionByName(cut).groupBy("token", "tok").agg(F.max("sim").alias("sim"), F.min(F.coalesce("part", F.lit(1.0))).alias("part"), F.max("content").alias("content"))


def map_texts(texts: DataFrame, entries: DataFrame, rules: Rules) -> DataFrame:
    """texts(text) distinct and not blank, entries(entry, name) -> (text, entry, score): the best entry, score under rules.least dropped."""
    n = entries.count()
    small = n <= rules.broadcast_entries
    hint = F.broadcast if small else (lambda x: x)
    parts, words = (cut(x) for x in _vocabulary(entries, n, rules))  # as small as the list, read many times
    # read many times below: without the cuts each reading would hold the long expression of tokens, and the driver plans it again
    said = cut(texts.select("text", F.explode(tokens(F.col("text"), rules)).alias("token")))
    rep = _repairs(cut(said.select("token").distinct()), words, rules, small)
    idf = parts.select("tok", "idf").distinct()
    rep = cut(rep.join(hint(idf), "tok"))
    top = float(math.log(1 + max(n, 1)))
    # weight of a typed word: of its best reading; rules.unknown of the highest where it has none
    weight = rep.groupBy("token").agg(F.max(F.struct(F.col("sim"), F.col("idf"))).alias("b")).select("token", F.col("b.idf").alias("wt"))
    said = said.join(weight, "token", "left").withColumn("wt", F.coalesce("wt", F.lit(top * rules.unknown)))
    norm = said.groupBy("text").agg(F.sum(F.col("wt") ** 2).alias("tt"))
    size = parts.groupBy("entry").agg(F.sum(F.col("idf") ** 2).alias("ee"), F.max("idf").alias("most"))
    hit = said.join(rep.select("token", "tok", "sim", "part", "content"), "token").join(hint(parts.select("entry", "tok", "idf")), "tok")
    cov_e = hit.groupBy("text", "entry", "tok").agg(F.max("sim").alias("s"), F.max("idf").alias("idf"), F.max(F.when(F.col("content"), F.col("idf"))).alias("told"))
    cov_e = cov_e.groupBy("text", "entry").agg(F.sum(F.col("idf") ** 2 * F.col("s")).alias("e"), F.max("told").alias("told"))
    whole, piece = F.max(F.when(F.col("part") == 1, F.col("sim"))), F.sum(F.when(F.col("part") < 1, F.col("sim") * F.col("part")))
    cov_t = hit.groupBy("text", "entry", "token").agg(F.greatest(whole, piece).alias("s"), F.max("wt").alias("wt"))
    cov_t = cov_t.groupBy("text", "entry").agg(F.sum(F.col("wt") ** 2 * F.col("s")).alias("t"))
    score = cov_e.join(cov_t, ["text", "entry"]).join(hint(size), "entry").join(norm, "text")
    score = score.withColumn("ce", F.col("e") / F.col("ee")).withColumn("ct", F.col("t") / F.col("tt"))
    # the word that tells the entry apart must be among the explained ones
    score = score.filter((F.col("told") >= F.col("most") - 1e-9) & (F.least("ce", "ct") >= rules.cover))
    score = score.withColumn("score", F.round(F.sqrt(F.col("ce") * F.col("ct")), 6)).filter(F.col("score") >= rules.least)
    best = score.groupBy("text").agg(F.max(F.struct("score", (-F.col("entry")).alias("neg"))).alias("b"))
    return best.select("text", (-F.col("b.neg")).alias("entry"), F.col("b.score").alias("score"))


def map_column(rows: DataFrame, id_col: str, col: str, entries: DataFrame, rules: Rules, salts: int = 16) -> DataFrame:
    """(id, ref_id, score) for each row whose text is not blank; one frequent text is spread over salts parts in the join."""
    live = rows.select(F.col(id_col).alias("id"), F.col(col).alias("text")).filter(F.length(F.trim(F.regexp_replace("text", "[\\s\\u00a0\\u200b]+", " "))) > 0)
    found = cut(map_texts(live.select("text").distinct(), entries, rules))  # a row a distinct text; keeps the last plan small
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    live = live.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return live.join(found, ["text", "salt"], "left").select("id", F.coalesce("entry", F.lit(0)).cast("long").alias("ref_id"), "score", "text")


def city_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "city_list").select(F.col("city_id").alias("entry"), F.col("city_name").alias("name")).filter("entry is not null and trim(name) <> ''")


def title_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "title_list").select(F.col("title_id").alias("entry"), F.col("title_name").alias("name")).filter("entry is not null and trim(name) <> ''")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """facility_row_id, field_name, ref_id for every city and title text of the master that is not blank; 0 if none fits."""
    rows = table(spark, sf_dir, "new_york_indoor_court_facilities")
    city = map_column(rows, "facility_row_id", "city", city_entries(spark, sf_dir), CITY)
    title = map_column(rows, "facility_row_id", "decision_maker_title", title_entries(spark, sf_dir), TITLE)
    out = city.select("id", F.lit("city").alias("field_name"), "ref_id").unionByName(title.select("id", F.lit("decision_maker_title").alias("field_name"), "ref_id"))
    return out.select(F.col("id").alias("facility_row_id"), "field_name", "ref_id")
