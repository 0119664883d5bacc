import itertools

from pyspark.sql import functions as F

from pagelode.operators import rules as R
from pagelode.plans import discover as D


def test_decision_list_over_all_signals(spark):
    rows = list(itertools.product([True, False, None], repeat=3))
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    got = df.select("a", "b", "c", R.decision_list([(F.col("a") & F.col("b"), F.lit("both")), (F.col("c"), F.lit("c")), (F.col("a"), F.lit("a"))], F.lit("none")).alias("v"), R.at_least([F.col("a"), F.col("b"), F.col("c")], 2).alias("two")).collect()
    for r in got:
        assert r.v == ("both" if r.a and r.b else "c" if r.c else "a" if r.a else "none")
        assert r.two == (sum(bool(x) for x in (r.a, r.b, r.c)) >= 2)
    kept, parked = R.split_by(df.withColumn("s", F.lit("x")), "s", ["x"], ["y"])
    assert (kept.count(), parked.count()) == (27, 0) and df.select(R.decision_list([], F.lit(1)).alias("v")).first().v == 1


def test_hits_become_sites(spark):
    hits = [
        (1, "https://www.bing.com/ck/a?u=a1aHR0cHM6Ly9jbHViLnRlc3Qv", "Club", "s1", "bing", "q1", 200), (2, "https://club.test/x", "", "s2", "brave", "q2", 200), (3, "https://www.yelp.com/biz", "Y", "s", "brave", "q2", 200),
        (4, "https://parks.ny.gov", "P", "s", "brave", "q2", 200), (5, "https://late.test", "L", None, "bing", "q2", 200), (6, "https://gone.test", "G", "s", "brave", "q3", 429),
    ]
    df = spark.createDataFrame(hits, "ord long, url string, title string, snippet string, engine string, query string, status int")
    out = {r.domain: r for r in D.candidate_sites(D.answered(df, ["brave", "bing"])).collect()}
    assert set(out) == {"club.test"} and (out["club.test"].titles, out["club.test"].snippets, out["club.test"].queries) == (["Club"], ["s1", "s2"], ["q1", "q2"])
    assert D.candidate_sites(df.limit(0)).count() == 0
