"""Sources combined to target weights (problem 7).

Method: capped water-filling. Each source is first given its target share of the total; sources that would have to be
repeated more often than allowed are clamped at that, and what they lack is given to the others in proportion to their
targets, until nothing is over its cap. A source's repeats are then a whole number of copies of every document and one
more copy of a seeded part of them, taken in the order of a hash until the part's tokens are reached.

Documents without a source or with one that has no target, and documents without tokens, are left out. Sources without
documents keep their row in the shares, with nothing in it. Null targets and repeats count as 0; if the targets do not sum
to 1 they are scaled. Repeated document rows are documents of their own. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelode.llm.common import cut, table
from pagelode.llm.tokens import count_tokens

SEED = 17
SLICES = 4096  # parts of a source by hash; only the one in which the seeded part ends is looked at row by row
MAX_SOURCES = 10_000


def water_fill(total: float, sizes: dict[str, float], targets: dict[str, float], caps: dict[str, float]) -> dict[str, float]:
    """Tokens given to each source: total by targets, none above size * cap, the excess shared among the rest."""
    most = {s: sizes.get(s, 0) * caps.get(s, 0) for s in targets}
    total = min(total, sum(most.values()))
    given = dict.fromkeys(targets, 0.0)
    free = {s for s, w in targets.items() if w > 0 and most[s] > 0}
    left = total
    while free and left > 0:
        weight = sum(targets[s] for s in free)
        over = {s for s in free if left * targets[s] / weight >= most[s]}
        if not over:
            for s in free:
                given[s] = left * targets[s] / weight
            break
        for s in over:
            given[s] = most[s]
        left -= sum(most[s] for s in over)
        free -= over
    return given


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens) of every document that can take part."""
    docs = table(spark, sf_dir, "documents").filter("source is not null")
    return count_tokens(docs, keep=("source",)).filter("n_tokens > 0")


def plan(docs: DataFrame, targets: DataFrame, total: float | None = None) -> list[tuple]:
    """(source, target_share, max_repeats, available, given) of every target; one row a source."""
    want = targets.limit(MAX_SOURCES + 1).collect()
    if len(want) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; the shares are worked out on the driver")
    names = [r.source for r in want if r.source is not None]
    sizes = {r.source: float(r.n) for r in docs.filter(F.col("source").isin(names)).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()} if names else {}
    scale = sum(r.target_share or 0.0 for r in want) or 1.0
    shares = {r.source: (r.target_share or 0.0) / scale for r in want if r.source is not None}
    caps = {r.source: float(r.max_repeats or 0) for r in want if r.source is not None}
    given = water_fill(total if total is not None else sum(sizes.values()), sizes, shares, caps)
    return [(s, shares[s], int(caps[s]), int(sizes.get(s, 0)), float(given[s])) for s in sorted(shares)]


def sample(docs: DataFrame, rows: list[tuple], seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, copies of every document that is in the mix."""
    spark = docs.sparkSession
    repeats = spark.createDataFrame([(s, int(g // n), g % n) for s, _, _, n, g in rows if n > 0], "source string, whole int, part double")
    docs = docs.join(F.broadcast(repeats), "source")  # one row a source, MAX_SOURCES at most
    mix = F.xxhash64(F.lit(seed), "doc_id", "source")
    docs = docs.withColumn("h", mix).withColumn("slice", F.pmod("h", F.lit(SLICES)).cast("int"))
    # tokens before each slice: SLICES rows a source, whatever its size
    slices = docs.groupBy("source", "slice").agg(F.sum("n_tokens").alias("n"), F.first("part").alias("part"))
    run = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = cut(slices.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0))))
    docs = docs.join(slices.select("source", "slice", "before", (F.col("before") + F.col("n")).alias("after")), ["source", "slice"])
    inner = docs.filter((F.col("before") < F.col("part")) & (F.col("after") > F.col("part")))
    line = W.partitionBy("source", "slice").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    inner = inner.withColumn("upto", F.col("before") + F.sum("n_tokens").over(line)).withColumn("more", (F.col("upto") - F.col("n_tokens") / 2 <= F.col("part")).cast("int"))
    outer = docs.filter((F.col("before") >= F.col("part")) | (F.col("after") <= F.col("part"))).withColumn("more", (F.col("after") <= F.col("part")).cast("int"))
    cols = ["doc_id", "source", "n_tokens", (F.col("whole") + F.col("more")).alias("copies")]
    return outer.select(cols).unionByName(inner.select(cols)).filter("copies > 0")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, copies: the documents of the mix and how often each is in it."""
    docs = cut(measured(spark, sf_dir))
    return sample(docs, plan(docs, table(spark, sf_dir, "mix_targets")))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: its target, what there is, what it was given and what it got."""
    docs = cut(measured(spark, sf_dir))
    rows = plan(docs, table(spark, sf_dir, "mix_targets"))
    got = sample(docs, rows).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    all_ = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available_tokens long, given_tokens double")
    out = all_.join(got, "source", "left").fillna(0, ["mixed_tokens", "copies", "most_copies"])
    whole = F.sum("mixed_tokens").over(W.partitionBy(F.lit(1)))
    return out.withColumn("actual_share", F.when(whole > 0, F.col("mixed_tokens") / whole).otherwise(0.0))
