"""Keyed reductions whose ties go by an explicit order column, never by the order in which rows happen to arrive.

Each is one map-side combinable aggregate, followed where whole rows are wanted by a join on the winner's unique order
number: no group is ever gathered in one task, so a key with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelode.functions.text import as_col
from pagelode.operators.lineage import cut
from pagelode.operators.skew import bounded_broadcast

MOST_TEMPLATES = 100_000  # rows up to which a list of templates is broadcast
ORDERS = 1 << 44  # order numbers are below this; a score up to 2^18 and an order number fit one long


def packed(score: Column | str, order: Column | str) -> Column:
    """A score and, for equal scores, the smaller order number first, as one long that a hash aggregate can compare."""
    return F.coalesce(as_col(score), F.lit(0)).cast("long") * F.lit(ORDERS) + (F.lit(ORDERS - 1) - as_col(order).cast("long"))


def packed_order(p: Column) -> Column:
    return F.lit(ORDERS - 1) - F.pmod(p, F.lit(ORDERS))


def richest_per_key(df: DataFrame, key: Column, score: Column, order: str, first: str = "first_order") -> DataFrame:
    """The row of the highest score of every key, the smaller order number on ties, with the key's smallest order number as first.

    Null keys are a key of their own. order must be unique, not null and below 2^44."""
    best = df.select(key.alias("k"), packed(score, order).alias("p"), F.col(order).cast("long").alias("o")).groupBy("k").agg(F.max("p").alias("p"), F.min("o").alias(first))
    best = best.select(packed_order(F.col("p")).alias("__winner"), first)
    return df.join(best, df[order] == best["__winner"]).drop("__winner")


def first_claim(df: DataFrame, key: str, order: str) -> DataFrame:
    """Every row with claimed_by, the smallest order number that has its key; rows with claimed_by equal to their own order own the key."""
    owner = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("claimed_by"))
    return df.join(owner, key)


def capped_collect(df: DataFrame, key: str, order: str, columns: list[str], most: int = 12) -> DataFrame:
    """Per key one array per column: its first most non-empty values by order. Each array is capped by itself.

    The ranks are pruned before the shuffle, so at most most rows of a key and column leave any task."""
    long = df.select(key, F.col(order).alias("__o"), F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x"))
    long = long.select(key, "__o", "x.c", "x.v").filter("v is not null and v <> ''")
    top = long.withColumn("__r", F.row_number().over(W.partitionBy(key, "c").orderBy("__o", "v"))).filter(F.col("__r") <= most)
    lists = top.groupBy(key).agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("__o", "v")))), lambda s: s["v"]).alias(c) for c in columns])
    keys = df.select(key).distinct()
    return keys.join(lists, key, "left").select(key, *[F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c) for c in columns])


def first_mode(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Per key its most frequent value, the one seen first by order on ties; nulls do not count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("o"))
    return counts.groupBy(key).agg(F.max(F.struct("n", (-F.col("o")).alias("o"), value)).alias("m")).select(key, F.col(f"m.{value}").alias(value), F.col("m.n").alias("n"))


def first_source(hits: DataFrame, query: str, source: str, sources: list[str], offset: Column | int = 0) -> DataFrame:
    """The hits of a query's first source that has any, the sources being rotated by offset."""
    n = len(sources)
    at = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col(source)) - 1
    ranked = hits.withColumn("source_rank", F.pmod(at - (offset if isinstance(offset, Column) else F.lit(offset)), F.lit(n)).cast("int")).filter(at >= 0)
    least = ranked.groupBy(query).agg(F.min("source_rank").alias("source_rank"))
    return ranked.join(least, [query, "source_rank"])


def fan_out(markets: DataFrame, templates: DataFrame, extra: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """market(market, market_ord) by template(template, template_ord): the first {m} of a template replaced, market by market, extra queries last."""
    made = markets.join(bounded_broadcast(templates, MOST_TEMPLATES), F.lit(True), "inner")  # every pair is the result here
    at = F.instr("template", "{m}")
    query = F.when(at > 0, F.concat(F.substring(F.col("template"), F.lit(1), at - 1), F.col("market"), F.substring(F.col("template"), at + 3, F.length("template")))).otherwise(F.col("template"))
    out = made.select(F.col("market_ord").cast("long").alias("a"), F.col("template_ord").cast("long").alias("b"), query.alias("query"))
    if extra is not None:
        out = out.unionByName(extra.select(F.lit((1 << 62)).alias("a"), F.col("template_ord").cast("long").alias("b"), F.col("template").alias("query")))
    out = out.orderBy("a", "b")
    return (out.limit(limit) if limit > 0 else out).select("query", F.col("a").alias("market_ord"), F.col("b").alias("template_ord"))


def not_done(todo: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of todo whose key is not among those done: the resume step."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def ranked_per_key(df: DataFrame, key: str, order: str, rank: str) -> DataFrame:
    """Rows with their place 1, 2, .. within their key by order (unique), whatever part of the rows one key has; null keys are left out.

    The rows are range-partitioned by key and order, so a hot key lies in many partitions; each starts where those before it end."""
    spread = cut(df.filter(F.col(key).isNotNull()).repartitionByRange(key, order).sortWithinPartitions(key, order))
    spread = spread.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    part = spread.groupBy(key, "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))  # a key has no more of them than there are partitions
    before = F.coalesce(F.sum("__n").over(W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    part = part.select(key, "__part", "__first", before.alias("__before"))
    return spread.join(part, [key, "__part"]).withColumn(rank, (F.col("__id") - F.col("__first") + F.col("__before") + 1).cast("long")).drop("__part", "__id", "__first", "__before")


def bounded_values(df: DataFrame, column: str, most: int = 1_000) -> list:
    """Distinct values of a column that is known to have few, in order; more than most is an error."""
    rows = df.select(column).distinct().filter(F.col(column).isNotNull()).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(r[0] for r in rows)


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of every key with the largest order number: later entries of a list overwrite earlier ones."""
    best = df.groupBy(key).agg(F.max(order).alias("__o"))
    return df.join(best.select(F.col("__o").alias(order)), order)
