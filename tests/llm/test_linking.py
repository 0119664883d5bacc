import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from pagelode.llm import canonical, entities, names, variants
from pagelode.llm.facility import facility_records, facility_similarity, grams
from pagelode.llm.linkage import average_linkage
from pagelode.llm.variants import PERSON_COLS, parse_contacts, person_links, person_similarity, sparse_cosine
from pagelode.operators.lineage import cut, discard, setting
from pagelode.operators.skew import BY_PLACE, meeting_join

CITIES = [(1, "Rellabrook"), (2, "West Sorrervale"), (3, "Pennworth Landing"), (4, "Fennshaw Harbor")]


def linkage_model(links, least, unknown):
    """Average linkage one merge at a time."""
    group = {x: {x} for ab in links for x in ab}
    while True:
        best = None
        for p, q in itertools.combinations(sorted(group), 2):
            known = [links[tuple(sorted((x, y)))] for x in group[p] for y in group[q] if tuple(sorted((x, y))) in links]
            if known:
                size = len(group[p]) * len(group[q])
                m = (sum(known) + unknown * (size - len(known))) / size
                if m >= least and (best is None or m > best[0] + 1e-12):
                    best = (m, p, q)
        if best is None:
            return {x: min(g) for g in group.values() if len(g) > 1 for x in g}
        _, p, q = best
        group[p] |= group.pop(q)


@pytest.mark.parametrize("seed", range(3))
def test_linkage_equals_one_merge_at_a_time(spark, seed):
    rnd = random.Random(seed)
    links = {(a, b): round(rnd.uniform(-1, 1), 6) for a in range(14) for b in range(a + 1, 14) if rnd.random() < 0.4}
    df = spark.createDataFrame([(a, b, s) for (a, b), s in links.items()], "a long, b long, s double")
    got = {r.node: r.label for r in average_linkage(df, 0.35, 0.2).collect()}
    assert got == linkage_model(links, 0.35, 0.2)


def test_linkage_of_equally_similar_nodes_runs_to_the_end(spark):
    side = lambda c: spark.range(150).select(F.col("id").alias(c))
    clique = side("a").crossJoin(side("b")).filter("a < b").select("a", "b", F.lit(0.95).alias("s"))
    assert {r.node: r.label for r in average_linkage(clique, 0.5, 0.3).collect()} == dict.fromkeys(range(150), 0)


def test_linkage_of_nothing(spark):
    df = spark.createDataFrame([], "a long, b long, s double")
    assert average_linkage(df, 0.5, 0.3).count() == 0
    assert average_linkage(spark.createDataFrame([(1, 2, 0.1)], "a long, b long, s double"), 0.5, 0.3).count() == 0


def test_pairs_of_a_context_are_summed_up_where_they_meet(spark):
    rows = spark.range(400).select("id", (F.col("id") % 3).alias("c"), (F.col("id") % 7).alias("k"))
    with setting(spark, BY_PLACE, "false"):
        hit = meeting_join(rows.withColumnRenamed("id", "a"), rows.withColumnRenamed("id", "b"), "c", "k", "b", 20)
        got = hit.groupBy("a", "b", "c", "__part").count().select("a", "b", "count")
        pairs = sorted(tuple(r) for r in got.collect())
        plan = got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert pairs == [(a, b, 1) for a in range(400) for b in range(400) if (a - b) % 21 == 0]
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM") == 2  # no pair is shuffled


def test_sparse_cosine_equals_brute_force(spark):
    import math

    rnd = random.Random(3)
    words = {i: "".join(rnd.choice("abc") for _ in range(9)) for i in range(25)}
    df = spark.createDataFrame(list(words.items()), "node long, w string")
    post = df.select("node", F.lit("c").alias("ctx"), F.explode(grams(F.col("w"), 3)).alias("gram"))
    got = {(r.a, r.b): r.cos for r in sparse_cosine(post, 0.0).collect()}
    sets = {i: {w[k : k + 3] for k in range(7)} for i, w in words.items()}
    df_ = {g: sum(g in s for s in sets.values()) for s in sets.values() for g in s}
    w2 = {g: math.log(1 + 25 / n) ** 2 for g, n in df_.items()}
    norm = {i: math.sqrt(sum(w2[g] for g in s)) for i, s in sets.items()}
    for a, b in itertools.combinations(range(25), 2):
        want = sum(w2[g] for g in sets[a] & sets[b]) / (norm[a] * norm[b])
        assert abs(got.get((a, b), 0.0) - want) < 1e-4


def test_hamming_search_is_exact(spark):
    rnd = random.Random(5)
    base = ["iskerimond", "xanedaden", "havavetis", "brenubbask"]
    words = [w for w in base for _ in range(3)]
    words += ["".join(w[:i] + rnd.choice("abcdefgh") + w[i + 1 :]) for w in base for i in (1, 4, 7)]
    rows = [(i, w) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "id long, w string").select("id", entities.letter_bits(F.col("w")).alias("v"))
    piece = lambda i: F.concat_ws(":", F.lit(i), F.shiftrightunsigned("v", i * entities.SLOT).bitwiseAND(F.lit((1 << entities.SLOT) - 1)))
    keys = df.select("id", F.explode(F.array(*[piece(i) for i in range(entities.PIECES)])).alias("k"), "v", F.lit(entities.NEAR).alias("r"))
    got = {(r.a, r.b) for r in entities.close_pairs(keys, keys, within=True).collect()}
    v = {r.id: r.v for r in df.collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(v), 2) if (v[a] ^ v[b]).bit_count() <= entities.NEAR}


def test_calibration_is_monotone(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(s, rnd.random() < s) for s in (rnd.random() for _ in range(400))], "score double, same boolean")
    rates = entities.calibration(df)
    assert len(rates) == entities.BINS and rates == sorted(rates) and entities.calibration(df.limit(0)) == sorted(entities.calibration(df.limit(0)))


def test_names_are_taken_apart():
    lex = names.Lexicon(CITIES, ["bramble", "harbor", "courtline", "republic"])
    p = names.parse_facility("Caditotem Bramble Sqsh &amp; Fit. Cl. @ West Sorrervale – Official Site", lex)
    assert (p["core"], p["kinds"], p["city"]) == (["caditotem", "bramble"], ["club", "fitness", "squash"], 2)
    q = names.parse_facility("Court1ine Republic No. 0012, Inc", lex)
    assert (q["core"], q["unit"]) == (["courtline", "republic"], "12")
    assert names.parse_facility("LumarrojonHarbor", lex)["core"] == ["lumarrojon", "harbor"]
    assert names.parse_facility("Helolokar M.P.C.", lex)["initials"] == "mpc" and names.parse_facility("BCPH", lex)["initials"] == "bcph"
    assert names.parse_facility(None, lex)["core"] == [] and names.parse_facility("", lex)["acro"] == ""
    assert names.parse_person("El-Nedduwald, Leonard") == (["leonard"], ["el", "nedduwald"])
    assert names.parse_person("Mx. Coach Emeka Mendeworth, CCP") == (["emeka"], ["mendeworth"])
    assert names.parse_person("Soren Wilmar, Owner/Coach")[1] == ["wilmar"] and names.parse_person(None) == ([], [])
    assert names.parse_host("https://book.club.test/courts", None) == ("club", "") and names.parse_host("https://listing.test/abc", "x.test") == ("x", "abc")
    assert names.unmangle("NÃºÃ±ez – x") == "Núñez – x"


def facility_pairs(spark, rows):
    cols = "id long, name string, website string, city string, email_domain string, shared string, direct string, first string, last string, courts int"
    rec = facility_records(spark.createDataFrame(rows, cols), CITIES, ["bramble", "courtline", "republic"])
    a, b = rec.select(*[F.col(c).alias(f"a_{c}") for c in rec.columns]), rec.select(*[F.col(c).alias(f"b_{c}") for c in rec.columns])
    return {(r.a_id, r.b_id): r.s for r in a.join(b, F.col("a_id") < F.col("b_id")).select("a_id", "b_id", facility_similarity("a", "b").alias("s")).collect()}


def test_facilities_alike_and_apart(spark):
    n = (None,) * 5
    s = facility_pairs(spark, [
        (1, "Caditotem Bramble Squash & Fitness Club", "https://caditotembramble.test", "Rellabrook", *n, None), (2, "caditotem brambel sqsh fitn clb", None, "Relabrook", *n, None),
        (3, "Caditotem Bramble Community Sports Center", None, "Rellabrook", *n, None), (4, "Courtline Republic #0012", None, "Rellabrook", *n, None), (5, "Courtline Republic no. 13", None, "Rellabrook", *n, None),
        (6, "COURTLINE REPUBLIC UNIT 12", None, None, *n, None),
    ])
    assert s[1, 2] > 0.9 and s[1, 3] < 0.2 and s[4, 5] < 0 and s[4, 6] > 0.9 and s[1, 4] < 0.1


def test_a_host_of_many_records_keeps_its_pairs(spark, monkeypatch):
    # at a host over HOT: a record with a number, one with a city, and some with neither
    rows = [(1, "Caditotem Bramble Squash Club #12", None), (2, "Caditotem Bramble Squash Club", "Rellabrook"), (3, "Brenubbask Rovale", None), (4, "Lumarrojon", None), (5, "Xanedaden Rovale #7", None)]
    cols = "id long, name string, website string, city string, email_domain string, shared string, direct string, first string, last string, courts int"
    df = spark.createDataFrame([(i, n, "https://caditotembramble.test", c, *(None,) * 6) for i, n, c in rows], cols)
    every = set(itertools.combinations(range(1, 6), 2))
    for most in (1_000, 2):
        monkeypatch.setattr(variants, "HOT", most, raising=False)
        monkeypatch.setattr(entities, "HOT", most, raising=False)
        _, links = variants.facility_links(df, CITIES)
        assert {(r.a, r.b) for r in links.collect()} == every
    keys = entities.meeting_keys(entities.encode(facility_records(df, CITIES, []))).localCheckpoint()
    assert {(r.a, r.b) for r in entities.close_pairs(keys, keys, within=True).collect()} == every


def test_persons_alike_and_apart(spark):
    rows = [(1, "Emeka Corvurmere", "Owner", None), (2, "Corvurmere, Eneka", "Ownr", None), (3, "E. Corvurmere", "Owner", None), (4, "Dan Rennurnash", "Owner", None), (5, "Dana Rennurnash", "Fac. Mgr", None), (6, "Liz Ox-Rennurnash", None, "elizabeth.rennurnash@a.test"), (7, None, None, None)]
    rec = parse_contacts(spark.createDataFrame(rows, "contact_id long, name string, title string, email string"), ["emeka", "dan", "dana", "elizabeth"], ["Owner", "Facility Manager"])
    a, b = rec.select(*[F.col(c).alias(f"a_{c}") for c in rec.columns]), rec.select(*[F.col(c).alias(f"b_{c}") for c in rec.columns])
    s = {(r.a_contact_id, r.b_contact_id): r.s for r in a.join(b, F.col("a_contact_id") < F.col("b_contact_id")).select("a_contact_id", "b_contact_id", person_similarity("a", "b").alias("s")).collect()}
    assert s[1, 2] > 0.9 and s[1, 3] > 0.8 and s[4, 5] == 0 and s[1, 4] == 0
    assert len(PERSON_COLS) == 6 and {r.contact_id for r in rec.collect()} == set(range(1, 8))


def test_short_and_full_given_names_meet_at_different_places(spark):
    rows = [(1, "Bill Gunninwick", "a"), (2, "William Gunninwick", "b"), (3, "Katherine O'Marrolock", "c"), (4, "Kate O'Marrolock", "d"), (5, "Dan Gunninwick", "e")]
    df = spark.createDataFrame([(i, n, "x.test", p, None, None) for i, n, p in rows], "contact_id long, name string, company string, place string, title string, email string")
    _, links = person_links(df, ["Owner"])
    assert {(r.a, r.b): r.s for r in links.collect() if r.s > 0.5} == {(1, 2): 0.95, (3, 4): 0.95}


def test_short_forms_of_any_length_are_read(spark):
    entries = spark.createDataFrame([(1, "Representative of Superintendents"), (2, "Club Owner"), (3, "Administratrix")], "entry long, name string")
    typed = {"repr. of superintendts": 1, "Administratr": 3, "superintenden representativ": 1, "adminstrtrx": 3, "clb ownr": 2}
    got = {r.text: r.entry for r in canonical.map_texts(spark.createDataFrame([(t,) for t in typed], "text string"), entries, canonical.TITLE).collect()}
    assert got == typed


def test_leads_hold_every_abbreviation(spark):
    word = "operations"
    got = set(spark.range(1).select(canonical.leads(F.lit(word)).alias("k")).first().k)
    want = {word[0] + "".join(x) for n in (1, 2) for x in itertools.combinations(word[1:], n)}
    assert got == want


def test_texts_are_mapped_to_their_entry(spark):
    cities = spark.createDataFrame(CITIES, "entry long, name string")
    typed = {"Relabrook, NY": 1, "W. Sorrervale": 2, "Sorrervale, West": 2, "pennworth lndg": 3, "Town of Fennshaw Hbr": 4, "Main Street": None, "12199": None, "Kumquat City": None, "PennworthLanding": 3}
    got = {r.text: r.entry for r in canonical.map_texts(spark.createDataFrame([(t,) for t in typed], "text string"), cities, canonical.CITY).collect()}
    assert {t: got.get(t) for t in typed} == typed
    rows = spark.createDataFrame([(1, "Relabrook"), (2, None), (3, "  "), (4, "Relabrook"), (5, "???")], "i long, c string")
    assert sorted((r.id, r.ref_id) for r in canonical.map_column(rows, "i", "c", cities, canonical.CITY).collect()) == [(1, 1), (4, 1), (5, 0)]
    assert sorted((r.id, r.ref_id) for r in canonical.map_column(rows, "i", "c", cities.limit(0), canonical.CITY).collect()) == [(1, 0), (4, 0), (5, 0)]


def test_branches_elsewhere_are_no_match(spark):
    # pairs of scored: 1 is of another town by name, 2 stands in that town, 3 does too but its person agrees, 4 stands elsewhere without such a branch
    rows = [(9, 1, 0.9, True, 5, False), (9, 2, 0.9, False, 5, False), (9, 3, 0.9, False, 5, True), (9, 4, 0.9, False, 6, False), (8, 2, 0.9, False, 5, False), (9, 5, 0.9, False, 0, False)]
    df = spark.createDataFrame(rows, "a long, b long, score double, away boolean, town int, person boolean")
    assert {(r.a, r.b) for r in entities.at_home(df).collect()} == {(9, 3), (9, 4), (8, 2), (9, 5)}


def test_a_group_has_the_town_of_its_names(spark):
    rows = [(1, 7, 0, 5), (2, 7, 3, 0), (3, 7, 0, 5), (4, 8, 0, 2), (5, 8, 0, 0), (6, None, 4, 4)]
    got = {r.dup_group: (r.named, r.stood) for r in entities.group_towns(spark.createDataFrame(rows, "id long, dup_group long, ncity int, ccity int")).collect()}
    assert got == {7: (3, 5), 8: (0, 2)}


def test_mail_services_are_found_by_their_boxes(spark):
    from pagelode.llm.facility import free_mail

    rows = [(f"club{i}@service.test",) for i in range(20)] + [(f"{b}@own.test",) for b in ("info", "office", "hello")] * 20 + [(None,), ("",), ("no address",)]
    assert free_mail(spark.createDataFrame(rows, "shared string")) == ["service.test"]
    assert free_mail(spark.createDataFrame([], "shared string")) == []


def test_facilities_of_one_brand_and_different_kinds_are_apart(spark):
    n = (None,) * 5
    s = facility_pairs(spark, [
        (1, "Caditotem Bramble Indoor Sports Complex", None, "Rellabrook", *n, None), (2, "Caditotem Bramble Fieldhouse", None, "Rellabrook", *n, None), (3, "Caditotem Bramble Health and Racquet Club", None, "Rellabrook", *n, None),
        (4, "Caditotem Bramble Ind. Sports Cplx", None, "Rellabrook", *n, None), (5, "Caditotem Bramble", None, "Rellabrook", *n, None),
    ])
    assert s[1, 4] > 0.9 and max(s[1, 2], s[1, 3], s[2, 3], s[2, 4], s[3, 4]) < 0.2 and s[1, 5] > 0.5


def test_cut_leaves_no_shuffle_files_and_discard_no_rows(spark):
    import os

    files = lambda: {f for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for _, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_")}
    before = files()
    df = cut(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and df.count() == 10
    path = df._jdf.queryExecution().logical().rdd().getCheckpointFile().get().removeprefix("file:")
    assert os.path.isdir(path)
    discard(df)
    assert not os.path.exists(path)


def test_texts_are_split_into_tokens_once(spark):
    texts, cities = spark.createDataFrame([("Rellabrok",)], "text string"), spark.createDataFrame(CITIES, "entry long, name string")
    out = canonical.map_texts(texts, cities, canonical.CITY)
    assert "regexp_replace" not in out._jdf.queryExecution().analyzed().toString()  # the long expression is not planned with the result again
    assert [(r.text, r.entry) for r in out.collect()] == [("Rellabrok", 1)]
