"""Matching: the factors against exact marginals, records of every kind, crowds, edges."""

import itertools
import math

import pytest

from tamis.llm import matching as M

E_SCHEMA = "id string, name string, website_url string, country string, region string, core string, host string"
D_SCHEMA = "directory_id string, name string, aliases array<string>, website_url string, country string, region string, source_profile string, u double, e string"
ENTITIES = [
    ("e1", "Junsova Thistle Coffee", "https://junsovathistle.example/", "United States", "OR"), ("e2", "Falhova Linnet Coffee", "https://falhovalinnet.example", "US", None), ("e3", "Falhova Linnet Coffee Roasters", "https://falhovalinnet-kr.example", "South Korea", "Jeju"),
    ("e4", "Pinnacle & Holperosa Coffee", None, "Canada", "QC"), ("e5", "Kestostel Iron Coffee Co.", "http://www.kestostelironcoffee.example", "USA", "NC"), ("e6", "Wexkeva Poplar Kaffe", "https://tinyshops.example/shops/wexkeva-poplar", "Sweden", None),
    ("e7", "Coffee Roasters", None, None, None), ("e8", None, None, None, None),
]
DIRECTORY = [
    ("d1", "JUNSOVA THISTLE COFFEE ROASTERS LLC", None, "HTTPS://WWW.JUNSOVATHISTLE.EXAMPLE/", None, None, "a"), ("d2", "Jusova Thistle", None, None, "us", "OR", "a"), ("d3", "Falhova-Linnet Coffee", None, "https://drinkfalhovalinnet-kr.example", "KR", None, "a"),
    ("d4", "Falhova Linnet", None, "https://falhovalinnet.de.example/", "DE", None, "a"), ("d5", "Holperosa-Pinnacle", None, None, "CA", None, "b"), ("d6", "Haus Kestostel", None, "https://shop.kestostelironcoffee.example/all?x=1", None, None, "b"),
    ("d7", "wexkeva poplar", None, "tinyshops.example/wexkeva-poplar", "SE", None, "b"), ("d8", "Coffee Roasters", None, None, None, None, "a"), ("d9", None, None, None, None, None, None), ("d10", "Falhova Linnet", None, None, None, None, "c"),
    ("d11", "Nobody Knows Them", ["JunsovaThistle"], None, "US", "OR", "b"), (None, "Junsova Thistle", None, None, None, None, "a"), ("d1", "JUNSOVA THISTLE COFFEE ROASTERS LLC", None, "HTTPS://WWW.JUNSOVATHISTLE.EXAMPLE/", None, None, "a"),
]


def tables(spark, e=ENTITIES, d=DIRECTORY):
    return spark.createDataFrame([(*x, "x", "y") for x in e], E_SCHEMA), spark.createDataFrame([(*x, 1.0, "z") for x in d], D_SCHEMA)


def test_found(spark):
    many = [(f"s{i}", f"Firm{chr(97 + i)}quist Lot", f"https://tinyshops.example/shops/firm{chr(97 + i)}quist", "US", None) for i in range(2)]
    e, d = tables(spark, [*ENTITIES, *many])
    got = {(r["entity_id"], r["directory_id"]) for r in M.found(e, d).collect()}
    assert got == {("e1", "d1"), ("e1", "d2"), ("e1", "d11"), ("e3", "d3"), ("e4", "d5"), ("e5", "d6"), ("e6", "d7")}


def test_empty(spark):
    e, d = tables(spark)
    assert M.found(e.filter("false"), d).count() == 0 and M.found(e, d.filter("false")).count() == 0


def exact(pairs):
    """Marginals by enumeration of all assignments."""
    total, on = 0.0, dict.fromkeys(range(len(pairs)), 0.0)
    for x in itertools.product((0, 1), repeat=len(pairs)):
        w = math.exp(sum(p[3] for p, v in zip(pairs, x) if v))
        for d in {p[1] for p in pairs}:
            if sum(v for p, v in zip(pairs, x) if p[1] == d) > 1:
                w = 0
        for e in {(p[0], p[2]) for p in pairs}:
            n = sum(v for p, v in zip(pairs, x) if (p[0], p[2]) == e)
            w *= M.TWICE ** max(0, n - 1)
        total += w
        for i, v in enumerate(x):
            on[i] += w * v
    return {(p[0], p[1]): on[i] / total for i, p in enumerate(pairs)}


@pytest.mark.parametrize("pairs", [
    [("e1", "d1", "a", 1.0)], [("e1", "d1", "a", 2.0), ("e2", "d1", "a", 1.5)], [("e1", "d1", "a", 1.0), ("e1", "d2", "a", 0.5), ("e2", "d2", "a", 0.8)], [("e1", "d1", "a", 1.0), ("e1", "d2", "b", 1.0)],
    [("e1", "d1", "a", 25.0), ("e2", "d1", "a", 24.0), ("e2", "d2", "a", -3.0)],
])
def test_marginals_of_trees(spark, pairs):
    got = {(r["e"], r["d"]): r["confidence"] for r in M.propagate(spark.createDataFrame(pairs, "e string, d string, listed string, u double")).collect()}
    for k, v in exact(pairs).items():
        assert got[k] == pytest.approx(v, abs=0.03), k


def test_crowd(spark):
    # a name that very many bear gives no pair by itself, but with its place or site
    crowd = [(f"c{i}", "Bluebird Meadow Coffee", f"https://bluebird{i}.example" if i < 100 else None, "US" if i % 2 else "CA", f"R{i}") for i in range(120)]
    d = [("x1", "Bluebird Meadow", None, None, "US", "R7", "a"), ("x2", "Bluebird Meadow", None, "bluebird8.example", None, None, "a"), ("x3", "Bluebird Meadow", None, None, "US", None, "a"), ("x4", "Bluebird Meadow", None, None, None, None, "a")]
    e, dd = tables(spark, crowd, d)
    assert {(r["entity_id"], r["directory_id"]) for r in M.found(e, dd).collect()} == {("c7", "x1"), ("c8", "x2")}
    # the weight of those without a pair counts: many of the name in the same country, place unknown
    hidden = [(f"h{i}", "Bluebird Meadow Coffee", None, "US", None) for i in range(300)]
    e, dd = tables(spark, [*crowd, *hidden], d[:1])
    assert M.found(e, dd).count() == 0


def test_crowd_with_parts_missing(spark):
    # one of a crowd in the record's country, whose region either side leaves open; then one without a site, or of another name
    abroad = [(f"c{i}", "Bluebird Meadow Coffee", None, "CA" if i % 2 else "DE", f"R{i}") for i in range(59)]
    d = [("x1", "Bluebird Meadow", None, None, "US", None, "a"), ("x2", "Bluebird Meadow", None, "other.example", "FR", "Bretagne", "b"), ("x3", "Bluebird Meadow", None, None, "CA", None, "a")]
    sites = [(f"s{i}", "Bluebird Meadow", f"https://firm{i}.example", "FR", None) for i in range(60)]
    e, dd = tables(spark, [*abroad, ("us", "Bluebird Meadow", None, "US", "R7")], d)
    assert {(r["entity_id"], r["directory_id"]): round(r["confidence"], 2) for r in M.matched(e, dd).collect() if r["confidence"] > 0.5} == {("us", "x1"): 0.92}
    e, dd = tables(spark, [*abroad, *sites, ("bare", "Bluebird Meadow", None, "FR", "Bretagne")], d)
    assert {(r["entity_id"], r["directory_id"]) for r in M.found(e, dd).collect()} == {("bare", "x2")}


def test_keys():
    assert M.name_core("The Junsova's Thistle Coffee Co., Ltd. (online only)") == "junsovasthistle" and M.name_core("Coffee Roasters GmbH") == "" and M.name_core(None) == ""
    assert M.name_bag("Holperosa-Pinnacle") == M.name_bag("PINNACLE AND HOLPEROSA Café") and M.name_bag("One") == ""
    assert M.site("HTTPS://WWW.A.EXAMPLE./shops/x-y/?q=1") == ("a.example", "xy") and M.site(None) == ("", "") and M.site("http://[bad") == ("", "")
    assert M.host_core("shop.thefernwegroasters.example") == "fernweg"


def test_short_names_and_exact_ones(spark):
    e = [("sey", "Sey Coffee", None, "US", "New York"), ("ona", "ONA Coffee", None, "AU", None), ("ko", "콩", None, "KR", "Seoul"), ("blue", "Bluebird Coffee", None, "US", None)]
    e += [(f"b{i}", f"Bluebir{c} Coffee", None, "US", None) for i, c in enumerate("abcefghijk")]
    d = [("d1", "Sey Coffee", None, None, "US", "New York", "a"), ("d2", "Bluebird", None, None, "US", None, "a"), ("d3", "콩 커피", None, None, "KR", "Seoul", "a"), ("d4", "Some Name", ["ONA"], "ona.example", "AU", "ACT", "a")]
    ee, dd = tables(spark, e, d)
    assert {(r["entity_id"], r["directory_id"]) for r in M.found(ee, dd).collect()} == {("sey", "d1"), ("blue", "d2"), ("ko", "d3"), ("ona", "d4")}


def test_crowd_with_one_in_another_country(spark):
    e = [(f"c{i}", "Daily Grind", None, "US", None) for i in range(51)] + [("kr", "Daily Grind", None, "KR", None)]
    ee, dd = tables(spark, e, [("d1", "Daily Grind", None, None, "KR", None, "a")])
    assert [(r["entity_id"], r["directory_id"]) for r in M.found(ee, dd).collect()] == [("kr", "d1")]


def test_recall_on_altered_names(spark):
    import random

    r = random.Random(4)
    syl = ["ka", "ro", "ven", "til", "mor", "des", "lun", "pra", "gos", "bel", "hin", "wex", "fal", "nor"]
    names = sorted({"".join(r.choice(syl) for _ in range(4)) + " " + "".join(r.choice(syl) for _ in range(3)) for _ in range(400)})
    e = [(f"e{i}", f"{n.title()} Coffee", f"https://{n.replace(' ', '')}.example", r.choice(["US", "DE", "KR"]), None) for i, n in enumerate(names)]
    d = []
    for i, n in enumerate(names):
        k = r.randrange(len(n) - 1)
        spelled = r.choice([n, n[:k] + n[k + 1 :], n.upper(), " ".join(reversed(n.split())), "The " + n])
        d.append((f"d{i}", spelled + r.choice([" Roasters", "", " Kaffee"]), None, e[i][2] if r.random() < 0.4 else None, e[i][3] if r.random() < 0.8 else None, None, "a"))
    ee, dd = tables(spark, e, d)
    got = {(x["entity_id"], x["directory_id"]) for x in M.found(ee, dd).collect()}
    right = {(f"e{i}", f"d{i}") for i in range(len(names))}
    assert len(got & right) >= 0.95 * len(right) and len(got & right) >= 0.98 * len(got)


def test_weak_pairs_and_settling(spark):
    pairs = [("e1", "d1", "a", 3.0), ("e2", "d1", "a", -6.0), ("e3", "d1", "a", -9.0), ("e1", "d2", "a", 2.0), ("e4", "d2", "a", 2.5), ("e4", "d3", "a", 1.0)]
    got = {(r["e"], r["d"]): (r["confidence"], r["settled"]) for r in M.propagate(spark.createDataFrame(pairs, "e string, d string, listed string, u double")).collect()}
    for k, v in exact(pairs).items():
        assert got[k][0] == pytest.approx(v, abs=0.03) and got[k][1], k
