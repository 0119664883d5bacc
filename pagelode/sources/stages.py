"""Stage tables, seed lists and search hits: the engine's inputs and what it keeps between runs.

Each stage is a Parquet table; a run reads what is new by an anti-join against what is done and appends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions.urls import registrable_domain
from pagelode.operators.keyed import last_per_key

HIT = "url string, title string, snippet string, engine string, query string, status int, ord long"
PAGE = "url string, status int, html string, ord long"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def check_inputs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, rows_found: whether every input is there and holds anything, before a long run starts."""
    found = []
    for p in paths:
        try:
            found.append((p, not spark.read.parquet(p).isEmpty()))
        except Exception:  # a missing input is a finding, not a failure
            found.append((p, False))
    return spark.createDataFrame(found, "path string, rows_found boolean")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """domain, url of a JSON list of URLs or {url: ..} objects; a domain's later entry overwrites its earlier ones."""
    text = spark.read.text(path, wholetext=True)
    items = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("ord", "item"))
    url = F.when(F.col("item").startswith("{"), F.get_json_object("item", "$.url")).otherwise(F.col("item"))
    seeds = items.select(F.col("ord").cast("long").alias("ord"), url.alias("url")).withColumn("domain", registrable_domain("url")).filter("domain <> ''")
    return last_per_key(seeds, "domain", "ord").select("domain", "url")


def usable_hits(hits: DataFrame) -> DataFrame:
    """Search hits of pages that answered, with a web address."""
    return hits.filter((F.coalesce(F.col("status"), F.lit(0)) < 400) & F.col("url").rlike("^https?:"))


def append_stage(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_stage(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stage's rows; none yet is an empty table of the schema."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def page_faults(pages: DataFrame) -> DataFrame:
    """url, fault of pages(url, status, html) that can't be used: a failed fetch, no address that names a host, no markup. The others go on without them."""
    fault = (
        F.when(F.coalesce(F.col("status"), F.lit(200)) >= 400, F.concat(F.lit("status "), F.col("status").cast("string"))).when(registrable_domain("url") == "", "no host")
        .when(F.trim(F.coalesce("html", F.lit(""))) == "", "no markup")
    )
    return pages.select("url", fault.alias("fault")).filter("fault is not null")


def answered_queries(hits: DataFrame) -> DataFrame:
    """Queries that gave any hit: one that came back empty is not done and is asked again."""
    return usable_hits(hits).filter(F.trim(F.coalesce("query", F.lit(""))) != "").select("query").distinct()
