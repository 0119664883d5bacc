"""From stored search hits to candidate sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.functions.urls import is_government_host, is_listing_host, registrable_domain, unwrap_redirect
from pagelode.operators.keyed import capped_collect, first_source
from pagelode.profile import NY, Profile
from pagelode.sources.stages import usable_hits


def answered(hits: DataFrame, engines: list[str], offset: int = 0) -> DataFrame:
    """Usable hits of each query's first engine that gave any, click-tracking links unwrapped."""
    unwrapped = usable_hits(hits.withColumn("url", unwrap_redirect("url")))
    return first_source(unwrapped, "query", "engine", engines, offset)


def candidate_sites(hits: DataFrame, profile: Profile = NY, most: int = 12) -> DataFrame:
    """hits(ord, url, title, snippet, query) -> domain, url, titles, snippets, queries: sites that are no listing or government host.

    Each list holds its first most values by order, blanks left out."""
    rows = hits.withColumn("domain", registrable_domain("url")).filter("domain <> ''")
    rows = rows.filter(~is_listing_host("domain") & ~is_government_host("domain", profile))
    lists = capped_collect(rows, "domain", "ord", ["title", "snippet", "query"], most)
    return lists.select("domain", F.concat(F.lit("https://"), "domain").alias("url"), F.col("title").alias("titles"), F.col("snippet").alias("snippets"), F.col("query").alias("queries"))
