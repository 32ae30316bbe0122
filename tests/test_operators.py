"""Operators on tables: guards, ties, nulls, empty tables, clashing names, hot keys."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tamis.operators import adapters, audit, graph, importplan, joins, merge, robots, select


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def table(spark, schema, data):
    return spark.createDataFrame(data, schema)


def test_winner_and_first(spark):
    df = table(spark, "k string, v int, o0 int, row string", [("a", 1, 5, "x"), ("a", 3, 4, "y"), ("a", 3, 4, "z"), ("a", None, 9, "n"), (None, 2, 1, "q"), (None, 1, 1, "r")])
    assert rows(select.winner(df, ["k"], [F.col("v")])) == [("a", 3, 4, "z"), (None, 2, 1, "q")]
    assert rows(select.first_wins(df, ["k"], "v")) == [("a", 1, 5, "x"), (None, 1, 1, "r")]
    assert select.winner(df.filter("false"), ["k"], [F.col("v")]).count() == 0
    assert rows(select.top_per_group(df, ["k"], [F.desc("o0"), F.asc("row")], 2), "k", "row") == [("a", "n"), ("a", "x"), (None, "q"), (None, "r")]
    once = select.first_wins(df, ["k"], "v")
    assert rows(select.first_wins(once, ["k"], "v")) == rows(once)


def test_terms(spark):
    df = table(spark, "u string", [("/Cart/gift",), ("/gift",), ("/x",), (None,)])
    want = [("/Cart/gift", "cart"), ("/gift", "gift"), ("/x", None), (None, None)]
    assert rows(df.withColumn("matched", select.first_term(F.col("u"), ["cart", "gift"]))) == want
    terms = table(spark, "ord int, term string", [(2, "gift"), (1, "cart"), (3, None)])
    assert rows(select.first_term_of_table(df, "u", terms)) == want
    assert rows(select.first_term_of_table(df, "u", terms.filter("false")), "matched") == [(None,)] * 4


def test_modes_and_fills(spark):
    df = table(spark, "g int, s int, name string", [(1, 1, None), (1, 2, "bb"), (1, 3, "a"), (1, 4, "bb"), (1, 5, "a"), (2, 1, None), (3, 1, "c"), (3, 2, "b")])
    assert rows(select.mode_value(df, ["g"], "name")) == [(1, "a", 2), (3, "b", 1)]
    assert rows(select.first_non_null(df, ["g"], "s", ["name"])) == [(1, "bb"), (2, None), (3, "c")]


def test_slug_numbers(spark):
    df = table(spark, "i int, base string", [(1, "a"), (2, "A"), (3, "b"), (4, "a"), (5, "x" * 80), (6, "x" * 80)])
    used = table(spark, "slug string", [("b",), ("a-7",)])
    got = dict(rows(select.numbered_slugs(df, "base", "i", used), "i", "allocated"))
    assert got[3] == "b-2" and len({v.lower() for v in got.values()}) == 6 and all(len(v) <= 80 for v in got.values()) and not {"b", "a-7"} & set(got.values())
    assert rows(select.next_positions(table(spark, "p string, n int", [("a", 3)]), table(spark, "p string, i int", [("a", 1), ("a", 2), ("b", 9)]), ["p"], "n", "i"), "p", "i", "n") == [("a", 1, 4), ("a", 2, 5), ("b", 9, 0)]


def test_slug_rounds(spark):
    a, b = "y" * 79 + "a", "y" * 79 + "b"
    df = table(spark, "i int, base string", [(1, "x"), (2, "x"), (3, "x-2"), (4, a), (5, a), (6, b), (7, b), (8, "z-2"), (9, None)])
    got = dict(rows(select.numbered_slugs(df, "base", "i", table(spark, "slug string", [("z-2",)])), "i", "allocated"))
    assert got == {1: "x", 2: "x-3", 3: "x-2", 4: a, 5: "y" * 78 + "-2", 6: b, 7: "y" * 78 + "-3", 8: "z-2-2", 9: None}


def test_backoff(spark):
    df = table(spark, "attempt int", [(1,), (2,), (3,), (4,)])
    assert rows(select.backoff_schedule(df, "attempt", 100)) == [(1, 100, 100), (2, 200, 300), (3, 400, 700), (4, 800, 1500)]
    assert rows(select.backoff_schedule(df, "attempt", 100, 2.0, 300)) == [(1, 100, 100), (2, 200, 300), (3, 300, 600), (4, 300, 900)]


def test_partners(spark):
    left = table(spark, "i int, h string", [(1, "a"), (2, "b"), (3, None), (4, "c")])
    right = table(spark, "h string, e string", [("a", "e1"), ("b", "e2"), ("b", "e3"), (None, "e4")])
    assert rows(joins.unique_partner(left, right, ["h"]), "i", "e", "partners") == [(1, "e1", 1), (2, None, 2), (3, None, 0), (4, None, 0)]
    assert rows(joins.null_safe_partner(left, right, [("h", "h")], "e"), "i", "partner", "ambiguous") == [(1, "e1", False), (2, "e2", True), (3, "e4", False), (4, None, False)]
    assert rows(joins.match_kind(left, right.withColumnRenamed("e", "id"), "h", "id"), "i", "kind", "matched") == [(1, "match", "e1"), (2, "ambiguous", None), (3, "create", None), (4, "create", None)]
    new, old = joins.unknown_only(left, right, ["h"])
    assert rows(new, "i") == [(3,), (4,)] and rows(old, "i") == [(1,), (2,)]


def test_cascade(spark):
    r = table(spark, "d string", [("1",), ("2",), ("3",), ("4",)])
    first = table(spark, "d string, candidate string", [("1", "a"), ("2", "a"), ("2", "b"), ("1", "a")])
    second = table(spark, "d string, candidate string", [("1", "z"), ("3", "c")])
    assert rows(joins.cascade(r, "d", [("one", first), ("two", second)])) == [("1", "one", "match", "a"), ("2", "one", "conflict", None), ("3", "two", "match", "c"), ("4", "none", "create", None)]


@pytest.mark.parametrize("seed", range(3))
def test_near_pairs_against_brute_force(spark, seed):
    r = random.Random(seed)
    pts = [(i, r.uniform(-1, 1), r.uniform(-1, 1)) for i in range(120)] + [(500, None, 0.0), (501, 0.1, 0.1), (502, 0.1, 0.1)]
    df = table(spark, "p int, x double, y double", pts)
    got = {(a, b) for a, b in rows(joins.near_pairs(df, df, "p", "p", "x", "y", 0.1))}
    good = [p for p in pts if p[1] is not None]
    assert got == {(a[0], b[0]) for a, b in itertools.product(good, good) if abs(a[1] - b[1]) < 0.1 and abs(a[2] - b[2]) < 0.1}


def test_hosts_and_conflicts(spark):
    h = table(spark, "host string", [("a.example",), ("m.a.example",), ("x.m.a.example",), ("a.example",), (None,), ("example",)])
    assert rows(joins.child_hosts(h)) == [("a.example", "example"), ("m.a.example", "a.example"), ("x.m.a.example", "m.a.example")]
    i = table(spark, "id string, host string, name_key string", [("1", "a.example", "n"), ("2", "b.example", "k"), ("3", "m.a.example", "z"), ("4", "q.example", "q"), ("5", None, None)])
    e = table(spark, "id string, host string, name_key string", [("e", "a.example", "k"), ("f", None, None)])
    assert rows(joins.conflicts(i, e, "id", "host", "name_key"), "id", "reason") == [("1", "same_host"), ("2", "same_name"), ("3", "related_host")]


def test_sets(spark):
    a = table(spark, "x int, y string", [(1, "a"), (1, "a"), (2, None)])
    b = table(spark, "x int, y string", [(1, "a"), (2, None), (3, "c")])
    assert rows(joins.same_multiset(a, b)) == [(1, 1)] and rows(joins.same_multiset(a, a)) == [(0, 0)] and rows(joins.same_multiset(a.filter("false"), a.filter("false"))) == [(0, 0)]
    assert rows(joins.difference(a, b, ["x"])) == [(3, "new")]


def at(minute):
    return datetime.datetime(2026, 1, 1, 0, minute)


OBS = "k string, state string, price int, at timestamp"


def test_merge(spark):
    stored = table(spark, OBS, [("a", "in", 1, at(5)), ("b", "in", 2, at(5)), ("c", "in", 3, None), ("d", "in", 4, at(5)), (None, "in", 0, at(1))])
    batch = table(spark, OBS, [("a", "out", 9, at(4)), ("b", "in", None, at(6)), ("c", "out", 3, at(1)), ("e", "in", 7, at(2)), ("e", "out", 7, at(3)), ("d", "out", 4, at(5)), (None, "out", 0, at(2))])
    new, events = merge.merge(stored, batch, ["k"], "at", ["state", "price"], ["price"])
    assert rows(new) == sorted([("a", "in", 1, at(5)), ("b", "in", 2, at(6)), ("c", "out", 3, at(1)), ("d", "out", 4, at(5)), ("e", "out", 7, at(3)), (None, "out", 0, at(2))], key=repr)
    assert rows(events, "k", "change") == [("c", "update"), ("d", "update"), ("e", "insert"), (None, "update")]
    again, none = merge.merge(new, batch, ["k"], "at", ["state", "price"], ["price"])
    assert rows(again) == rows(new) and none.count() == 0
    assert rows(merge.merge(stored.filter("false"), batch.filter("false"), ["k"], "at", ["state"])[0]) == []


def test_merge_order_does_not_matter(spark):
    r = random.Random(3)
    obs = [(r.choice("abc"), r.choice(["in", "out"]), r.randint(1, 5), at(i)) for i in range(24)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(obs)
        t = table(spark, OBS, obs[:0])
        for i in range(0, 24, 8):
            t = merge.merge(t, table(spark, OBS, obs[i : i + 8]), ["k"], "at", ["state", "price"])[0]
        want = want or rows(t)
        assert rows(t) == want


def test_guards(spark):
    o = table(spark, "k string, n int, at timestamp", [("a", 1, at(3)), ("a", 2, at(2)), ("a", 3, at(3)), ("a", 4, None), ("a", 5, at(1)), ("b", 1, at(1))])
    assert rows(merge.accepted_in_order(o, ["k"], "n", "at"), "k", "n", "stale") == [("a", 1, False), ("a", 2, True), ("a", 3, False), ("a", 4, False), ("a", 5, True), ("b", 1, False)]
    s = table(spark, "k string, state string, at timestamp", [("a", "in", at(1)), ("b", "in", at(9)), ("c", "in", None), ("d", "in", at(1))])
    assert rows(merge.retire_unseen(s, s.filter("k = 'a'"), ["k"], "at", F.lit(at(5))), "k", "state") == [("a", "in"), ("b", "in"), ("c", "removed"), ("d", "removed")]
    c = table(spark, "k string, n int, v string", [("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, None), ("a", 5, "x")])
    assert rows(merge.change_log(c, ["k"], ["n"], ["v"]), "n") == [(1,), (3,), (5,)]


def test_states(spark):
    df = table(spark, "g int, s string, f boolean", [(1, "in_stock", True), (1, "unknown", None), (2, "sold_out", False), (2, "sold_out", False), (3, "sold_out", False), (3, "unknown", None)])
    assert rows(df.groupBy("g").agg(merge.state_of_parts(F.col("s")).alias("s"), merge.tristate(F.col("f")).alias("f"))) == [(1, "in_stock", True), (2, "sold_out", False), (3, "unknown", None)]


def test_patches(spark):
    t = table(spark, "k int, a string, b string", [(1, None, "x"), (2, "y", None), (3, None, None)])
    p = table(spark, "k int, a string, b string", [(1, "new", "other"), (2, "y", "z")])
    filled, clash = merge.fill_nulls(t, p, ["k"], ["a", "b"])
    assert rows(filled) == [(1, "new", "x"), (2, "y", "z"), (3, None, None)] and rows(clash) == [(1, "b")]
    plan = table(spark, "k int, field string, before string, after string", [(1, "b", "x", "X"), (1, "a", "q", "w"), (2, "a", "n", "y"), (9, "a", "", ""), (2, "k", "2", "3"), (3, "a", None, "v")])
    assert rows(merge.guarded_patch(t, plan, "k", ["a", "b"])) == [(1, "a", "drift"), (1, "b", "apply"), (2, "a", "applied"), (2, "k", "forbidden"), (3, "a", "apply"), (9, "a", "missing")]
    over = table(spark, "a string, b string", [('{"x":1,"y":{"z":1}}', '{"y":{"w":2},"v":null}'), (None, '{"a":1}'), ('{"a":1}', None)])
    import json

    got = [json.loads(r[0]) for r in over.select(merge.overlay_json(F.col("a"), F.col("b"))).collect()]
    assert got[0]["x"] == 1 and got[0]["y"] == {"w": 2} and got[1] == {"a": 1} == got[2]


def test_rules(spark):
    df = table(spark, "k int, v int", [(1, 1), (1, -1), (2, None), (None, 3), (None, 4)])
    assert rows(merge.violations(df, {"positive": F.col("v") > 0, "small": F.col("v") < 3})) == [("positive", 1), ("small", 2)]
    assert rows(merge.violations(df.filter("false"), {"positive": F.col("v") > 0})) == [("positive", 0)]
    assert rows(merge.duplicate_keys(df, ["k"])) == [(1, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_components_against_brute_force(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100, i) for i in range(101, 160)] + [(200 + i, 201 + i) for i in range(30)] + [(400, 400), (None, 3)]
    got = dict(rows(graph.components(table(spark, "a int, b int", edges))))
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert graph.components(table(spark, "a int, b int", [])).count() == 0


def test_reach_and_roots(spark):
    e = table(spark, "src string, dst string", [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "e"), (None, "x"), ("q", "r")])
    start = table(spark, "node string", [("a",), ("a",), (None,)])
    assert rows(graph.reach(e, start), "node", "depth") == [("a", 0), ("b", 1), ("c", 2), ("d", 2), ("e", 3)]
    assert rows(graph.reach(e, start, blocked=table(spark, "node string", [("b",)])), "node") == [("a",), ("b",)]
    assert rows(graph.reach(e, start, limit=3), "node") == [("a",), ("b",), ("c",)] and graph.reach(e, start, depth=1).count() == 2
    links = table(spark, "node int, parent int", [(i, i - 1) for i in range(2, 40)] + [(100, 101), (101, 102), (102, 101), (5, 4)])
    got = {n: (root, steps, cyc) for n, root, steps, cyc in rows(graph.roots(links), "node", "root", "steps", "cyclic")}
    assert got[39] == (1, 38, False) and got[2] == (1, 1, False) and got[100] == got[102] == (None, None, True)
    checks = dict(rows(graph.integrity(table(spark, "id int", [(1,), (1,), (2,), (None,)]), table(spark, "p int", [(1,), (7,), (None,)]), "id", "p", table(spark, "node int, parent int", [(1, 2), (2, 1), (5, 9)]))))
    assert checks == {"duplicate_key": 1, "orphan": 1, "missing_target": 1, "cycle": 2}


def test_audit(spark):
    df = table(spark, "s string, page int, item int, total int", [("a", 1, 1, 3), ("a", 1, 2, 3), ("a", 2, 3, 3), ("b", 1, 1, 2), ("b", 3, 2, 2), ("c", 1, 1, 5), ("d", 1, 1, None)])
    assert rows(audit.pages_complete(df, ["s"], "page", "item", "total"), "s", "complete") == [("a", True), ("b", False), ("c", False), ("d", False)]
    assert rows(audit.counters(df.filter("false"), {"x": F.col("page") > 1}, {"d": F.col("s")})) == [(0, 0, 0)]
    q = audit.quantiles(table(spark, "g int, v double", [(1, float(i)) for i in range(101)]), ["g"], "v", {"p50": 0.5, "p95": 0.95})
    assert rows(q) == [(1, 50.0, 95.0)]


ROBOTS = "User-agent: *\r\nDisallow: /private # x\nAllow: /private/open\nDisallow: /*.pdf$\n\nUser-agent: Tamis\nUser-agent: b\nDisallow: /\nAllow: /ok\n"


def test_robots(spark):
    paths = table(spark, "host string, path string", [("a", p) for p in ("/private", "/private/open/1", "/x.pdf", "/x.pdf?1", "/y")] + [("none", "/private")])
    texts = table(spark, "host string, text string", [("a", ROBOTS), ("b", None)])
    assert rows(robots.allowed(paths, texts, "other"), "host", "path", "allowed") == [("a", "/private", False), ("a", "/private/open/1", True), ("a", "/x.pdf", False), ("a", "/x.pdf?1", True), ("a", "/y", True), ("none", "/private", True)]
    assert [r[1] for r in rows(robots.allowed(paths.filter("host = 'a'"), texts, "my-tamis-bot"), "path", "allowed")] == [False] * 5
    assert dict(rows(robots.allowed(paths.filter("host = 'a'"), texts, "other", wildcards=False), "path", "allowed"))["/x.pdf"] is True


def test_import_plan(spark):
    r = table(spark, "seq int, record_id string, name string, website_url string, city string", [
        (1, "1", "New Firm", "https://new.example", "x"), (2, "2", "Known", "https://www.known.example/", "Oslo"), (3, "3", "Known", "https://elsewhere.example", None), (4, "4", "", "https://bad.example", None), (5, "5", "No Site", None, None),
        (6, "6", "Twin", "https://t1.example", None), (7, "7", "twin", "https://t2.example", None), (8, "8", "Other name", "https://new2.example", None), (9, "9", "Different", "https://new2.example", None), (10, "10", "Sub", "https://m.known.example", None), (11, "11", "Full", "https://full.example", "y"),
    ])
    e = table(spark, "id string, host string, name_key string, city string", [("e1", "known.example", "known", None), ("e2", "full.example", "full", "z")])
    p = importplan.plan(importplan.normalised(r, "s"), e, ["city"])
    got = {x[0]: x[1:] for x in rows(p, "record_id", "action", "reason", "entity_id", "fields")}
    assert got == {"1": ("create", None, None, ""), "2": ("enrich", None, "e1", "city"), "3": ("conflict", "same_name", None, ""), "4": ("reject", "length", None, ""), "5": ("reject", "no_website", None, ""), "6": ("conflict", "same_name_in_input", None, ""), "7": ("conflict", "same_name_in_input", None, ""), "8": ("conflict", "names_differ", None, ""), "10": ("conflict", "related_host", None, ""), "11": ("unchanged", None, "e2", "")}
    seal = importplan.seal(p)
    now = F.lit(at(30))
    assert importplan.usable(p, seal, F.lit(at(10)), now) and not importplan.usable(p.limit(3), seal, F.lit(at(10)), now) and not importplan.usable(p, seal, F.lit(at(40)), now)


def test_adapters(spark):
    bodies = [
        (1, "shopify", '{"product":{"id":1,"title":"K","variants":[{"id":11,"title":"250 g","sku":"a","price":"12.50","grams":250},{"id":12,"title":"1 kg","price":"x","available":true}]}}'),
        (2, "woocommerce", '[{"id":5,"name":"W","sku":"w","is_in_stock":true,"prices":{"price":"1250","currency_code":"EUR","currency_minor_unit":2}},{"id":6,"name":"V","prices":{"price":"900","currency_code":"JPY","currency_minor_unit":0,"price_range":{"min_amount":"900","max_amount":"1200"}}}]'),
        (3, "squarespace", '{"item":{"id":"s","title":"S","variants":[{"id":"v","sku":"q","price":2000,"salePrice":1500,"onSale":true,"unlimited":false,"qtyInStock":0,"optionValues":[{"value":"250 g"},{"value":"Filter"}]}]}}'),
        (4, "square", '{"product":{"id":"p","name":"Q"},"skus":{"data":[{"id":"z","name":"One","price":{"amount":1800,"currency":"USD"},"sold_out":true,"sellable":true}]}}'),
        (5, "indexed", '[{"product":1},{"id":2,"title":3,"variants":4},77,"N",[5],{"id":6,"title":3,"price":7},88,"9.00"]'), (6, "shopify", "{broken"), (7, "unheard of", "{}"), (8, "shopify", None), (9, "woocommerce", "{}"),
    ]
    df = table(spark, "page_id int, kind string, body string", bodies)
    got = [(r["page_id"], r["product_id"], r["variant_id"], None if r["price"] is None else float(r["price"]), r["currency"], r["available"]) for r in adapters.offers(df).orderBy("page_id", "variant_id").collect()]
    assert got == [(1, "1", "11", 12.5, None, None), (1, "1", "12", None, None, True), (2, "5", "5", 12.5, "EUR", True), (2, "6", "6", None, "JPY", None), (3, "s", "v", 15.0, None, False), (4, "p", "z", 18.0, "USD", False), (5, "77", "88", 9.0, None, None)]
    prices = adapters.shopify(df.filter("page_id = 1"))
    stock = table(spark, "page_id int, product_id string, variant_id string, available boolean", [(1, "1", "11", False), (1, "1", "12", True)])
    assert {r["variant_id"]: (r["available"], r["complete"]) for r in adapters.with_stock(prices, stock).collect()} == {"11": (False, True), "12": (True, True)}
    assert {r["variant_id"]: (r["available"], r["complete"]) for r in adapters.with_stock(prices, stock.limit(1)).collect()} == {"11": (False, False), "12": (True, False)}
