import itertools
import random

import pytest
from pyspark.sql import functions as F

from pagelode.operators import contacts as C
from pagelode.operators import facilities as A
from pagelode.operators import keyed as K
from pagelode.operators.skew import bounded_broadcast, salted_join, spread_left_join

MASTER = (
    "ord long, facility_name string, website string, city string, email_domain string, public_direct_email string, shared_facility_email string, decision_maker_first_name string, "
    "decision_maker_last_name string, decision_maker_title string, number_of_courts int, qualification_status string, research_notes string"
)


def row(ord_, name="Quay Club", website="https://quay.test", city="Rye", domain="quay.test", direct=None, shared=None, first=None, last=None, courts=None, status="Needs Review", notes=None):
    return (ord_, name, website, city, domain, direct, shared, first, last, None, courts, status, notes)


def test_richest_row_and_first_place(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 5), (3, "a", 5), (4, None, 0), (5, "b", None)], "o long, k string, s int")
    out = {r.o: r.first_order for r in K.richest_per_key(df, F.col("k"), F.col("s"), "o").collect()}
    assert out == {2: 1, 4: 4, 5: 5}
    assert K.richest_per_key(df.limit(0), F.col("k"), F.col("s"), "o").count() == 0


def test_keyed_reductions(spark):
    df = spark.createDataFrame([(i, "k", f"v{i % 15}", None if i % 2 else "x") for i in range(40)], "o long, k string, a string, b string")
    r = K.capped_collect(df, "k", "o", ["a", "b"], 12).first()
    assert r.a == [f"v{i}" for i in range(12)] and r.b == ["x"] * 12
    assert K.first_mode(spark.createDataFrame([(1, "k", "b"), (2, "k", "a"), (3, "k", "a"), (4, "k", "b"), (5, "k", None)], "o long, k string, v string"), "k", "v", "o").first().v == "b"
    hits = spark.createDataFrame([("q", "bing", 1), ("q", "brave", 2), ("r", "brave", 3)], "q string, e string, n int")
    assert sorted(r.n for r in K.first_source(hits, "q", "e", ["startpage", "brave", "bing"]).collect()) == [2, 3]
    assert sorted(r.n for r in K.first_source(hits, "q", "e", ["startpage", "brave", "bing"], 2).collect()) == [1, 3]
    claim = K.first_claim(spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "o long, e string"), "e", "o")
    assert sorted((r.o, r.claimed_by) for r in claim.collect()) == [(1, 1), (2, 1)]


def test_fan_out_replaces_once_and_appends(spark):
    m = spark.createDataFrame([("Rye NY", 0), ("Troy NY", 1)], "market string, market_ord int")
    t = spark.createDataFrame([("a {m} {m}", 0), ("b", 1)], "template string, template_ord int")
    extra = spark.createDataFrame([("all", 0)], "template string, template_ord int")
    assert [r.query for r in K.fan_out(m, t, extra).collect()] == ["a Rye NY {m}", "b", "a Troy NY {m}", "b", "all"]
    assert [r.query for r in K.fan_out(m, t, extra, 2).collect()] == ["a Rye NY {m}", "b"]


def test_salted_join_keeps_rows(spark):
    many = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "i long, k string")
    few = spark.createDataFrame([("hot", 1), ("k0", 2)], "k string, v int")
    assert salted_join(many, few, "k", "i").count() == many.join(few, "k").count()
    assert salted_join(many, few, "k", "i", "left").count() == 300
    assert bounded_broadcast(few, 1).count() == 2


FILLERS = {"the", "a", "an", "inc", "llc", "ltd", "co", "corp", "company", "club", "center", "centre", "of", "and"}


def survivors(rows):
    """{ord: blanked} of the rows that both dedups leave, from sorted groups."""
    points = lambda r: 4 * bool(r[5]) + 2 * bool(r[6]) + 2 * bool(r[8]) + (r[10] is not None) + bool(r[3])
    name = lambda r: " ".join(w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in (r[1] or "").lower()).split() if w not in FILLERS)

    def best(items, key):
        """Of every group the fullest item, and the place where the group begins; items are (place, row)."""
        groups = itertools.groupby(sorted(items, key=lambda x: (key(x[1]), x[0])), key=lambda x: key(x[1]))
        return [(members[0][0], min(members, key=lambda x: (-points(x[1]), x[0]))[1]) for members in (list(g) for _, g in groups)]

    sites = best([(r[0], r) for r in rows], lambda r: r[4])
    named = best(sites, lambda r: (1, name(r), (r[3] or "").lower()) if name(r) else (0, r[2] or "", ""))
    ranked = sorted(named, key=lambda x: (-points(x[1]), x[0]))
    owner = {}
    for _, r in reversed(ranked):
        if r[5] and name(r):
            owner[r[5].lower()] = r
    return {r[0]: bool(r[5]) and r[5].lower() in owner and owner[r[5].lower()][0] != r[0] and name(owner[r[5].lower()]) == name(r) for _, r in named}


@pytest.mark.parametrize("seed", range(4))
def test_dedup_equals_sorted_groups_whatever_the_partitions(spark, seed):
    rnd = random.Random(seed)
    pick = lambda *x: rnd.choice(x)
    rows = [row(i, pick("Quay Club", "The Quay", "Ox", "", "the club"), pick("https://a.test", "https://b.test"), pick("Rye", "", "Troy"), f"d{rnd.randrange(9)}.test", pick(None, "x@m.test", "y@m.test"), pick(None, "info@m.test"), None, pick(None, "Lee"), pick(None, 3)) for i in range(60)]
    want = survivors(rows)
    for n in (1, 7):
        df = spark.createDataFrame(rows, MASTER).repartition(n).orderBy(F.rand(seed))
        out = A.blank_repeated_contacts(A.collapse(df))
        had = {r[0]: r[5] for r in rows}
        got = {r.ord: bool(had[r.ord]) and r.public_direct_email is None for r in out.collect()}
        assert got == want


def test_rows_are_normalised(spark):
    rows = [
        row(1, direct="reporter@paper.test", first="Dana", last="Lee"), row(2, direct="a@gmail.com", shared="info@quay.test"), row(3, name="Quay Club", domain="", website="https://book.quay.test/x", direct="x@quayclub.test"),
        row(4, domain="gmail.com", website="https://gmail.com", first="A", last="B"), row(5, direct="x@quay.test", notes="Guessed emails are UNVERIFIED pattern permutations - not published addresses. Keep."),
    ]
    out = {r.ord: r for r in A.normalize_rows(spark.createDataFrame(rows, MASTER)).collect()}
    assert out[1].public_direct_email is None and "Third-party email removed" in out[1].research_notes and out[1].guessed_email_2 == "dana.lee@quay.test" and out[1].research_notes.endswith("published addresses.")
    assert out[2].public_direct_email == "a@gmail.com" and out[2].email_domain == "quay.test"
    assert out[3].public_direct_email is None and out[3].email_domain == "quay.test"
    assert out[4].email_domain is None and out[4].guessed_email_1 is None
    assert out[5].research_notes == "Keep."


def test_publishers_are_dropped_and_order_is_by_status_and_name(spark):
    rows = [row(1, "b club", domain="b.test", status="Needs Review"), row(2, "A club", domain="a.test", status="Needs Review"), row(3, "Zed", domain="z.test", status="Confirmed Indoor"), row(4, "Daily News", domain="lohud.test"), row(5, "Jr Tennis Times", domain="t.test", status="Other"), row(6, "x", domain="wyrk.com")]
    out = A.finalize(spark.createDataFrame(rows, MASTER), ["Confirmed Indoor", "Indoor and Outdoor", "Needs Review"])
    assert [r.ord for r in out.collect()] == [3, 2, 1, 5]
    assert A.finalize(spark.createDataFrame([], MASTER), ["x"]).count() == 0


def test_numbering_is_dense(spark):
    df = spark.range(1000).withColumn("o", (F.col("id") * 37) % 1009).repartition(5)
    rows = sorted((r.o, r.facility_no, r.facility_id) for r in A.numbered(df, "o", "NY").collect())
    assert [n for _, n, _ in rows] == list(range(1, 1001)) and rows[0][2] == "NY-0001" and A.numbered(df.limit(0), "o", "NY").count() == 0


EXTRA = "people array<struct<first:string,last:string,title:string,rank:int,email:string>>, direct_emails array<string>, shared_emails array<string>, locations array<struct<street:string,city:string,zip:string>>"


def test_candidates_branches_and_claims(spark):
    one = (*row(1, first="Robin", last="Quayle"), 1, "NY-0001", [("Robin", "Quayle", "Owner", 0, "rq@quay.test"), ("Dr", "Ox", "x", 1, ""), ("Sam", "Harrow", None, 2, "")], ["zzz9@quay.test", "a.b@quay.test", "gm@quay.test", "jsmith@quay.test", "rq@quay.test"], ["info@quay.test"] * 5, [("1 Oak St", "Rye", "1"), ("2 Oak St", "Rye", "")])
    two = (*row(2, domain=None, direct="A.B@quay.test", shared="hello@x.test"), 2, "NY-0002", None, None, None, None)
    df = spark.createDataFrame([one, two], f"{MASTER}, facility_no long, facility_id string, {EXTRA}")
    won, again = C.fan_out_candidates(df)
    mine = [(r.email, r["type"]) for r in won.filter("facility_no = 1").orderBy("candidate_no").collect()]
    assert mine[0] == ("rq@quay.test", "Published Direct") and [t for _, t in mine[1:7]] == [f"Guessed Pattern {i}" for i in range(1, 7)]
    assert [e for e, _ in mine[7:]] == ["gm@quay.test", "a.b@quay.test", "jsmith@quay.test", "info@quay.test"]
    assert [(r.email, r["type"]) for r in won.filter("facility_no = 2").collect()] == [("hello@x.test", "Published Shared")]
    assert sorted((r.facility_no, r.email, r.owner_no) for r in again.collect()) == [(1, "info@quay.test", 1), (1, "info@quay.test", 1), (2, "a.b@quay.test", 1)]
    b = sorted((r.location_id, r.branch_city, r.is_multi_location, r.location_count) for r in C.branches(df).collect())
    assert b == [("NY-0001-A", "Rye", "Yes", 2), ("NY-0001-B", "Rye", "Yes", 2), ("NY-0002-A", "Rye", "No", 1)]
    stats = C.run_stats(won, again, df).first()
    assert (stats.facilities, stats.people, stats.multi_person, stats.branches, stats.guessed, stats.repeats) == (2, 2, 1, 3, 6, 3)
    assert [r.n for r in df.orderBy("ord").select(C.emails_found().alias("n")).collect()] == [6, 2]


def test_contact_index_keeps_the_fullest(spark):
    rows = [(1, "https://a.test", [], ["x"], [], []), (2, "http://www.a.test/", [("A", "B", "", 0, "")], ["x", "y"], [], []), (3, "", [], [], [], [])]
    idx = C.contact_index(spark.createDataFrame(rows, f"ord long, website string, {EXTRA}"))
    assert [(r.host, r.ord) for r in idx.collect()] == [("a.test", 2)]
    m = spark.createDataFrame([(1, "https://a.test/z"), (2, None)], "ord long, website string")
    assert sorted((r.ord, r.direct_emails) for r in C.with_contacts(m, idx).collect()) == [(1, ["x", "y"]), (2, None)]


def test_places_within_a_key_whatever_its_share(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None, "c"]), i) for i in rnd.sample(range(100_000), 2_000)]
    got = {(r.k, r.o): r.n for r in K.ranked_per_key(spark.createDataFrame(rows, "k string, o long").repartition(5), "k", "o", "n").collect()}
    want = {}
    for k in ("hot", "b", "c"):
        want |= {(k, o): n + 1 for n, o in enumerate(sorted(o for x, o in rows if x == k))}
    assert got == want
    assert K.ranked_per_key(spark.createDataFrame([], "k string, o long"), "k", "o", "n").count() == 0


def test_more_values_than_allowed_are_refused(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    assert K.bounded_values(df, "v", 2) == ["a", "b"]
    with pytest.raises(ValueError):
        K.bounded_values(df, "v", 1)


def test_every_branch_of_a_website_comes_out(spark):
    df = spark.createDataFrame([(1, "NY-0001", "Rye", "w", 13), (2, "NY-0002", "Troy", None, None), (3, "NY-0003", None, "none", None)], "o long, facility_id string, city string, extras_website string, n_locations long")
    places = spark.createDataFrame([("w", n, f"{n} Oak St", None, None) for n in range(1, 14)], "extras_website string, place_no long, street string, city string, zip string")
    rows = sorted((r.facility_id, r.location_id, r.branch_street, r.branch_city, r.is_multi_location, r.location_count) for r in C.branches_of(df, places).collect())
    assert len(rows) == 15 and [r[1] for r in rows if r[0] == "NY-0001"] == [f"NY-0001-{c}" for c in "ABCDEFGHIJKLM"] and {r[4:] for r in rows if r[0] == "NY-0001"} == {("Yes", 13)}
    assert rows[13:] == [("NY-0002", "NY-0002-A", "", "Troy", "No", 1), ("NY-0003", "NY-0003-A", "", "", "No", 1)]


def test_branches_of_a_chain_are_made_by_several_tasks(spark):
    df = spark.range(300).select(F.format_string("NY-%04d", "id").alias("facility_id"), F.lit("Rye").alias("city"), F.when(F.col("id") < 290, "w").alias("extras_website"), F.when(F.col("id") < 290, 400).cast("long").alias("n_locations"))
    places = spark.range(1, 401).select(F.lit("w").alias("extras_website"), F.col("id").alias("place_no"), F.format_string("%d Oak St", "id").alias("street"), F.lit(None).cast("string").alias("city"), F.lit("1").alias("zip"))
    rows = C.branches_of(df, places).select("facility_id", "location_id", "branch_street", "branch_city", "location_count", F.spark_partition_id().alias("p"))
    tasks = [r["count"] for r in rows.filter("location_count = 400").groupBy("p").count().collect()]
    assert sum(tasks) == 290 * 400 and len(tasks) > 1 and max(tasks) < 290 * 400 * 0.8
    assert rows.select("facility_id", "location_id", "branch_street").distinct().count() == 290 * 400 + 10 and rows.filter("location_count = 1 and branch_city = 'Rye' and location_id like '%-A'").count() == 10


def test_spread_left_join_keeps_every_row_once(spark):
    a = spark.createDataFrame([("hot", i) for i in range(7)] + [("b", 8), (None, 9), ("none", 10)], "k string, i long")
    b = spark.createDataFrame([("hot", n % 2) for n in range(50)] + [("b", 1), ("c", 2)], "k string, v long")  # two values for ten parts: most parts are empty
    key = lambda r: (r.k or "", r.i, -1 if r.v is None else r.v)
    assert sorted(map(key, spread_left_join(a, b, "k", "v", 5).collect())) == sorted(map(key, a.join(b, "k", "left").collect()))
