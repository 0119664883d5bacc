"""Queries over what a run reads and keeps: seeds, search hits, stage tables, CSV files. What they write goes to the checkpoint folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import keyed as K
from pagelode.operators.lineage import ensure_checkpoint_dir
from pagelode.plans.cases import values_sql
from pagelode.plans.discover import answered, candidate_sites
from pagelode.profile import LISTING_HOSTS, NY_STATEWIDE, QUERY_TEMPLATES
from pagelode.sources import csvio
from pagelode.sources.stages import answered_queries, check_inputs, read_seeds, read_stage, table
from pagelode.streaming.incremental import refresh, stream_rows

MASTER, OUTREACH = "new_york_indoor_court_facilities", "n8n_indoor_courts_5_row_reference"
ENGINES = ["one", "two", "three"]


def scratch(spark: SparkSession) -> str:
    """A folder of its own that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/scratch-{uuid4().hex}"


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Master texts written as CSV and read again."""
    path, cols = scratch(spark), ["row_id", "facility_name", "city", "notes"]
    csvio.write_csv(table(spark, d, MASTER).select(F.col("facility_row_id").alias("row_id"), "facility_name", "city", F.concat_ws(", ", "research_notes", "facility_type").alias("notes")), path, cols)
    return csvio.read_csv(spark, path).select(*cols)


def seed_list(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    text = '["https://www.a.test/x", {"url": "http://b.test:8080/"}, {"url": "https://a.test/later"}, "", {"name": "none"}]'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return read_seeds(spark, path)


def inputs_checked(spark: SparkSession, d: str) -> DataFrame:
    found = check_inputs(spark, [f"{d}/documents.parquet", f"{d}/no_such_table.parquet"])
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "rows_found")


def resumed_run(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one state: the second works only what the first did not attempt, rows that failed among it."""
    state = scratch(spark)
    pages = table(spark, d, OUTREACH).select("track_row_id", "batch_label", F.length(F.coalesce("company_name", F.lit(""))).alias("size"))

    def work(turn: int):
        return lambda todo: todo.filter(F.col("track_row_id") % 5 != 0).select("track_row_id", "size", F.lit(turn).alias("run"))

    args = ("track_row_id long, size int, run int", "track_row_id long")
    refresh(spark, pages.filter("batch_label <= 'B005'"), state, "track_row_id", work(1), *args)
    return refresh(spark, pages, state, "track_row_id", work(2), *args)


def streamed_run(spark: SparkSession, d: str) -> DataFrame:
    """Pages that arrive in two batches of files, the second with those of the first again, worked as a stream: each once."""
    source, state = scratch(spark), scratch(spark)
    pages = table(spark, d, OUTREACH).select("track_row_id", "batch_label", F.length(F.coalesce("company_name", F.lit(""))).alias("size"))
    work = lambda batch: batch.filter(F.col("track_row_id") % 5 != 0).select("track_row_id", "size")
    for part in (pages.filter("batch_label <= 'B005'"), pages):
        part.write.mode("append").parquet(source)
        stream_rows(spark, source, pages.schema, state, work, "track_row_id").awaitTermination()
    return read_stage(spark, f"{state}/rows", "track_row_id long, size int")


def _hits(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("track_row_id")
    return table(spark, d, OUTREACH).select(
        n.alias("ord"), F.col("website").alias("url"), F.col("company_name").alias("title"), F.col("fit_notes").alias("snippet"), F.element_at(F.array(*[F.lit(e) for e in ENGINES]), (n % 3 + 1).cast("int")).alias("engine"),
        F.concat_ws(" ", "batch_label", "primary_type").alias("query"), F.when(n % 7 == 0, 404).otherwise(200).alias("status"),
    )


def discovery_path(spark: SparkSession, d: str) -> DataFrame:
    """Search hits to sites: usable hits of each query's first engine that gave any, listings left out, capped lists."""
    sites = candidate_sites(answered(_hits(spark, d), ENGINES))
    return sites.select("domain", "url", *[F.array_join(c, " | ").alias(c) for c in ("titles", "snippets", "queries")])


def queries_left(spark: SparkSession, d: str) -> DataFrame:
    """Queries to ask again: those whose hits were none or none usable."""
    hits = _hits(spark, d)
    return K.not_done(hits.select("query").distinct(), answered_queries(hits), "query")


def query_fanout(spark: SparkSession, d: str) -> DataFrame:
    """Every template for every town, then the statewide queries; the first 5,000 of them, as a limited run takes."""
    markets = table(spark, d, "city_list").select(F.concat("city_name", F.lit(" NY")).alias("market"), F.col("city_id").alias("market_ord"))
    listed = lambda xs: spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "template string, template_ord int")
    return K.fan_out(markets, listed(QUERY_TEMPLATES), listed(NY_STATEWIDE), 5_000)


def _guard(c: str) -> str:
    return f"(CASE WHEN regexp_matches(coalesce({c}, ''), '^[=+@\\t\\r]') THEN chr(39) ELSE '' END || coalesce({c}, ''))"


def sqls(host: str) -> dict[str, str]:
    """host: SQL of a website's host."""
    listing = "|".join(w.replace(".", "[.]") for w in sorted(set(LISTING_HOSTS)))
    hits = f"SELECT track_row_id AS o, website, company_name, fit_notes, concat_ws(' ', batch_label, primary_type) AS q, track_row_id % 3 AS e, track_row_id % 7 <> 0 AND coalesce(regexp_matches(website, '^https?:'), false) AS ok FROM {OUTREACH}"
    cap = lambda c: f"array_to_string(list_slice(coalesce(list({c} ORDER BY o) FILTER ({c} <> ''), []), 1, 12), ' | ')"
    return {
        "csv_round_trip": f"SELECT CAST(facility_row_id AS VARCHAR) AS row_id, {_guard('facility_name')} AS facility_name, {_guard('city')} AS city, {_guard('n')} AS notes FROM (SELECT *, concat_ws(', ', research_notes, facility_type) AS n FROM {MASTER})",
        "seed_list": values_sql([("a.test", "https://a.test/later"), ("b.test:8080", "http://b.test:8080/")], "domain, url"),
        "inputs_checked": "SELECT * FROM (VALUES ('documents.parquet', true), ('no_such_table.parquet', false)) v(name, rows_found)",
        "resumed_run": f"SELECT track_row_id, length(coalesce(company_name, '')) AS size, CASE WHEN batch_label <= 'B005' THEN 1 ELSE 2 END AS run FROM {OUTREACH} WHERE track_row_id % 5 <> 0",
        "streamed_run": f"SELECT track_row_id, length(coalesce(company_name, '')) AS size FROM {OUTREACH} WHERE track_row_id % 5 <> 0",
        "discovery_path": f"""WITH h AS ({hits}), u AS (SELECT * FROM h WHERE ok QUALIFY e = min(e) OVER (PARTITION BY q)), k AS (SELECT *, {host} AS domain FROM u)
SELECT domain, 'https://' || domain AS url, {cap("company_name")} AS titles, {cap("fit_notes")} AS snippets, {cap("q")} AS queries FROM k WHERE domain <> '' AND NOT regexp_matches(domain, '{listing}') AND NOT regexp_matches(domain, '(?i)\\.(gov|mil|ny\\.us)$') GROUP BY domain""",
        "queries_left": f"WITH h AS ({hits}) SELECT q AS query FROM h GROUP BY q HAVING NOT bool_or(ok AND trim(q, ' ') <> '')",
        "query_fanout": f"""WITH t AS ({values_sql([(x, i) for i, x in enumerate(QUERY_TEMPLATES)], "t, n")}), s AS ({values_sql([(x, i) for i, x in enumerate(NY_STATEWIDE)], "t, n")})
SELECT query, market_ord, template_ord FROM (SELECT replace(t, '{{m}}', city_name || ' NY') AS query, city_id AS market_ord, n AS template_ord FROM city_list, t UNION ALL SELECT t, 4611686018427387904, n FROM s) ORDER BY market_ord, template_ord LIMIT 5000""",
    }


QUERIES = {f.__name__: f for f in (csv_round_trip, seed_list, inputs_checked, resumed_run, streamed_run, discovery_path, queries_left, query_fanout)}
