"""Shared pieces of the training-data operators."""

from __future__ import annotations

import pagelode.llm
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.text import fold_accents, let, repair_mojibake
from pagelode.operators.lineage import cut, discard

__all__ = ["cut", "deletions", "discard", "letters_for_digits", "plain", "repair_fragments", "table"]


# Functions run on workers travel with their code: no node but the driver needs this package.
cloudpickle.register_pickle_by_value(pagelode.llm)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Letters that a two-byte or three-byte UTF-8 sequence turns into when read as windows-1252, by rule.
def _fragments() -> list[tuple[str, str]]:
    out = []
    for ch in "–—‘’“”…•" + "".join(map(chr, range(0xC0, 0x100))):
        try:
            out.append((ch.encode("utf-8").decode("cp1252"), ch))
        except UnicodeDecodeError:
            continue
    return sorted(out, key=lambda p: -len(p[0]))


FRAGMENTS = _fragments()


def repair_fragments(c: Column | str) -> Column:
    """Like repair_mojibake, but also where only parts of the text are damaged."""

    def fixed(x: Column) -> Column:
        y = x
        for bad, good in FRAGMENTS:
            y = F.replace(y, F.lit(bad), F.lit(good))
        return F.when(x.rlike("[ÃâÂ]"), y).otherwise(x)

    return let(c, fixed)


def plain(c: Column | str) -> Column:
    """Damage repaired, marks off, lower case, one space between words; null stays null."""
    c = repair_fragments(repair_mojibake(c))
    c = F.regexp_replace(c, "&amp;", "&")
    c = F.regexp_replace(F.lower(fold_accents(c)), "[\\u2018\\u2019\\u0060\\u00b4]", "'")
    return F.trim(F.regexp_replace(c, "[\\s\\u00a0\\u200b\\u202f\\u2007\\u2009\\u3000]+", " "))


def letters_for_digits(c: Column) -> Column:
    """0 and 1 standing between letters become o and l."""
    c = F.regexp_replace(c, "(?<=[a-z])0(?=[a-z])|(?<=[a-z])0\\b(?<![0-9]0)|\\b0(?=[a-z]{2})", "o")
    return F.regexp_replace(c, "(?<=[a-z])1(?=[a-z])|\\b1(?=[a-z]{3})|(?<=[a-z]{3})1\\b", "l")


def deletions(c: Column, depth: Column) -> Column:
    """The word and what is left of it after up to depth (0-2) single deletions: array of struct(v, n)."""

    def once(w: Column) -> Column:
        return F.transform(
            F.when(F.length(w) > 0, F.sequence(F.lit(1), F.length(w))).otherwise(F.array().cast("array<int>")),
            lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))),
        )

    none = F.array().cast("array<string>")
    d1 = F.array_distinct(once(c))
    d2 = F.array_distinct(F.flatten(F.transform(d1, once)))
    tag = lambda arr, n: F.transform(arr, lambda v: F.struct(v.alias("v"), F.lit(n).alias("n")))
    return F.concat(
        tag(F.array(c), 0), tag(F.when(depth >= 1, d1).otherwise(none), 1), tag(F.when(depth >= 2, d2).otherwise(none), 2)
    )
