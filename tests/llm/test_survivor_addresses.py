import random
from datetime import datetime as D

import pytest

from pagelode.llm import addresses as A
from pagelode.llm import names, survivor

CITIES = [(1, "Rellabrook"), (2, "Noltelock Harbor")]
FIELDS = (
    "facility_row_id long, dup_group long, website string, email_domain string, city string, number_of_courts int, court_count_notes string, decision_maker_last_name string, public_direct_email string, "
    "record_source string, crawled_at timestamp"
)


def test_the_surviving_values(spark):
    day = lambda m: D(2025, m, 1)
    rows = [
        (1, 7, None, "q.test", "Noltelock Harbor", 5, "our 5 courts", "Ox", "robin.ox@q.test", "site_crawl", day(1)), (2, 7, None, "q.test", "Relabrook", 2008, "our 6 courts", "Núñez", "sam.nunez@q.test", "site_crawl", day(3)),
        (3, 7, None, None, "rellabrook ", 6, None, "NÃºÃ±ez", "info@q.test", "contact_pass", day(5)), (4, 7, None, None, "Noltelock Harbor", 9, None, "Falk", "x@other.test", "web_directory", day(6)),
        (5, 8, None, None, None, None, None, None, None, None, None), (6, None, None, "q.test", "Rellabrook", 3, None, "A", "b@q.test", "site_crawl", day(1)),
        (9, 9, None, "z.test", None, None, None, "Oxley", None, "web_directory", day(1)), (8, 9, None, "z.test", None, None, None, "oxley", None, "user_submission", day(2)),
    ]
    df = spark.createDataFrame(rows, FIELDS)
    trust = spark.createDataFrame([("site_crawl", 80), ("contact_pass", 90), ("web_directory", 30)], "record_source string, trust_score int")
    cities = spark.createDataFrame(CITIES, "entry long, name string")
    won = {(r.dup_group, r.field): r.show for r in survivor.winners(df, trust, cities).collect()}
    assert won == {(7, "city"): "rellabrook", (7, "number_of_courts"): "6", (7, "decision_maker_last_name"): "núñez", (7, "public_direct_email"): "sam.nunez@q.test", (9, "decision_maker_last_name"): "oxley"}
    best = {r.dup_group: r for r in survivor.survivors(df, trust, cities).collect()}
    assert best[7].records == 4 and best[7].base_row_id == 3 and best[8].city is None
    assert survivor.winners(df.limit(0), trust, cities).count() == 0


def brute_layers(points):
    """Layer of every point by peeling what nothing left dominates."""
    over = lambda p, q: p != q and all(x >= y for x, y in zip(p, q, strict=True))
    rest, out, turn = dict(points), {}, 0
    while rest:
        turn += 1
        top = [i for i, p in rest.items() if not any(over(q, p) for q in rest.values())]
        out |= dict.fromkeys(top, turn)
        rest = {i: p for i, p in rest.items() if i not in top}
    return out


@pytest.mark.parametrize("small", [64, 3])
def test_layers_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(survivor, "SMALL", small)
    rnd, rows, i = random.Random(4), [], 0
    for g in range(25):
        for _ in range(rnd.randrange(1, 14)):
            i += 1
            fields = [f for f in "abcd" if rnd.random() < 0.4]
            rows.append((g, i, len(fields), D(2025, 1, rnd.randrange(1, 8)), rnd.choice([15, 30, 80, 90]), [(f, 1, f"{f}{i}") for f in fields]))
    df = spark.createDataFrame(rows, "dup_group long, row_id long, full int, at timestamp, trust int, vals array<struct<field:string,n:long,key:string>>")
    got = {r.row_id: r for r in survivor.layered(df).collect()}
    for g in range(25):
        mine = {r[1]: (r[2], r[3], r[4]) for r in rows if r[0] == g}
        want = brute_layers(mine)
        assert {k: got[k].layer for k in want if k in got} == {k: v for k, v in want.items() if k in got}
        # what a peeled group leaves out is below the first layer of every field
        for f in "abcd":
            holds = [r[1] for r in rows if r[0] == g and any(v[0] == f for v in r[5])]
            least = min((want[k] for k in holds), default=0)
            assert all(k in got for k in holds if want[k] == least)


def test_layers_of_nothing(spark):
    df = spark.createDataFrame([], "dup_group long, row_id long, full int, at timestamp, trust int, vals array<struct<field:string,n:long,key:string>>")
    assert survivor.layered(df).count() == 0


def test_addresses_are_read_in_any_order():
    lex = names.Lexicon(CITIES)
    read = lambda *x: A.parse_address(*x, lex)
    assert read("Suite 4, 12-16 E. Oak St.", "Town of Relabrook", "10038-1200") == ("12", ["e", "oak", "st"], 1, "10038")
    assert read("Rellabrook, NY 10038 - 12 E. Oak St.", None, None) == ("12", ["e", "oak", "st"], 1, "10038")
    assert read("#12 Oak St #4 Noltelock Harbor NY 10594", None, None) == ("12", ["oak", "st"], 2, "10594")
    assert read("2 98 th Avenue", None, None)[:2] == ("2", ["98th", "avenue"])
    assert read("1056 NY-299", "Rellabrook", None)[:3] == ("1056", ["route", "299"], 1)
    assert read("PO Box 17, Oak Plaza, 9 Oak St", None, None)[:2] == ("9", ["oak", "st"])
    assert read(None, None, None) == ("", [], 0, "") and read("no number", None, None)[0] == ""


def test_streets_are_compared(spark):
    common, ends = {"street", "avenue", "north"}, {"street", "avenue"}
    same = lambda a, b: A.same_street(a.split(), b.split(), common, ends)
    assert same("oakmere street", "oakmree street") and same("oakmere street", "oakmere") and same("north oakmere street", "oakmere street north")
    assert not same("oakmere street", "oakmere avenue") and not same("north oakmere street", "oakmere street") and not same("oakmere street", "elmcroft street") and not same("route 12", "route 13")
    assert A.distance("abcd", "abdc") == 1 and A.distance("", "ab") == 2


def test_rewrites_are_mined_and_end(spark):
    rows, i = [], 0
    for n in range(60):
        for form in ("{n} Oakmere{n} Street", "{n} Oakmere{n} St", "{n} Oakmere{n} Str."):
            i += 1
            rows.append((i, form.format(n=n), "Rellabrook", "10038"))
            rows.append((10_000 + i, form.format(n=n).replace("Street", "Avenue").replace("Str.", "Av.").replace("St", "Ave").replace("Oakmere", "Elmcroft"), "Rellabrook", "10038"))
    rows += [(900, "7 Oakmere7 Lane", "Rellabrook", "10038"), (901, None, None, None), (902, "5 Oakmere5 St", "Noltelock Harbor", "10594")]
    members, pairs, rules = A.buildings(spark.createDataFrame(rows, "id long, street string, city string, zip string"), CITIES)
    assert {k[0]: v[0] for k, v in rules.items()} == {"st": "street", "str": "street", "ave": "avenue", "av": "avenue"}
    node = {r.id: r.node for r in members.collect()}
    linked = {(r.a, r.b) for r in pairs.collect()}
    ends = {tuple(sorted((node[a], node[b]))) in linked for n in range(60) for a, b in ((3 * n + 1, 3 * n + 2), (3 * n + 2, 3 * n + 3))}
    assert ends == {True} and not any(900 in p or 902 in p for p in linked) and 901 not in node


def test_a_word_that_stands_for_many_chains_nothing():
    rows = [("ave", "avenue", 900), ("st", "street", 800), ("avenue", "town", 9), ("ave", "town", 8), ("street", "town", 9), ("st", "town", 8), ("lane", "town", 16), ("ln", "town", 8), ("lane", "ln", 700)]
    mass = {}
    for p, q, n in rows:
        mass[p], mass[q] = mass.get(p, 0) + n, mass.get(q, 0) + n
    found = A.classes(rows, mass, sum(n for *_, n in rows))
    kept = {w: found.get(w, w) for w in mass}
    assert (kept["ave"], kept["st"], kept["ln"]) == ("avenue", "street", "lane") and len({kept["avenue"], kept["street"], kept["lane"]}) == 3


def test_mining_runs_until_no_rewrite_is_new(spark, monkeypatch):
    # each round finds one phrase: more rounds than any fixed number of eight
    left = iter([{(f"w{k}",): ("word",)} for k in range(12)])
    monkeypatch.setattr(A, "mine", lambda diffs, mass: next(left, {}))
    df = spark.createDataFrame([(1, "7 Oak w3 w11", "Rellabrook", "10038"), (2, "7 Oak word word", "Rellabrook", "10038")], "id long, street string, city string, zip string")
    members, pairs, rules = A.buildings(df, CITIES)
    assert len(rules) == 12 and [(r.a, r.b) for r in pairs.collect()] == [(1, 2)]


def test_two_streets_of_like_names_stay_apart(spark):
    said = [(n, "Finchgate") for n in range(30)] + [(n, "Birchgate") for n in range(28, 58)] + [(7, "Finchgat")]
    rows = [(i, f"{n} {name} Street", "Rellabrook", "10038") for i, (n, name) in enumerate(said)]
    _, pairs, _ = A.buildings(spark.createDataFrame(rows, "id long, street string, city string, zip string"), CITIES)
    assert [tuple(sorted(said[x] for x in p)) for p in pairs.collect()] == [((7, "Finchgat"), (7, "Finchgate"))]
