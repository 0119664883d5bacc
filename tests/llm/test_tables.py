"""Every query of the subpackage on the smallest data, on empty tables, and on rows of nulls, repeats and clashing columns."""

import os

import pytest
from pyspark.sql import functions as F

from pagelode.llm import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
NAMES = (
    "new_york_indoor_court_facilities", "ny_indoor_courts_reoon_verification_input", "ny_indoor_courts_locations", "n8n_indoor_courts_5_row_reference", "documents", "city_list", "title_list",
    "record_sources", "mix_targets",
)
KEYS = {NAMES[0]: "facility_row_id", NAMES[1]: "candidate_row_id", NAMES[2]: "location_row_id", NAMES[3]: "track_row_id", "documents": "doc_id"}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for n in NAMES:
        spark.read.parquet(f"{DATA}/{n}.parquet").limit(0).write.parquet(f"{d}/{n}.parquet")
    return str(d)


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """The smallest data with every tenth row all null, every row twice under a new id, blanks for texts, and extra columns."""
    d = tmp_path_factory.mktemp("dirty")
    for n in NAMES:
        df = spark.read.parquet(f"{DATA}/{n}.parquet")
        if n in KEYS:
            k = KEYS[n]
            nulls = df.filter(F.col(k) % 10 == 0).select(*[(F.col(k) + 10_000_000).alias(k) if c == k else F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
            blank = df.filter(F.col(k) % 10 == 1).select(*[(F.col(k) + 20_000_000).alias(k) if c == k else (F.lit("  ").alias(c) if t == "string" else F.col(c)) for c, t in df.dtypes])
            df = df.unionByName(df.withColumn(k, F.col(k) + 30_000_000)).unionByName(nulls).unionByName(blank)
        df = df.withColumns({c: F.lit("x") for c in ("id", "node", "label", "text_", "a", "b", "k", "entry", "name", "key", "show", "n") if c not in df.columns})
        df.write.parquet(f"{d}/{n}.parquet")
    return str(d)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_on_the_smallest_data(spark, name):
    df = registry.QUERIES[name](spark, DATA)
    # so few addresses show no rewrite often enough
    assert (df.count() > 0 or name == "p3_rewrites") and len(df.columns) == len(set(df.columns))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_on_empty_tables(spark, empty, name):
    assert registry.QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_on_dirty_tables(spark, dirty, name):
    clean, out = registry.QUERIES[name](spark, DATA), registry.QUERIES[name](spark, dirty)
    assert out.columns == clean.columns and out.count() >= clean.count()
