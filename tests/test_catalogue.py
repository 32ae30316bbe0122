"""Saving a catalogue: identities, variants, stock, pages, owners; nulls, repeated rows and empty tables."""

import datetime

from pyspark.sql import functions as F

from tamis.operators import catalogue as C


def day(n):
    return datetime.datetime(2026, 1, n)


def test_identity(spark):
    stored = spark.createDataFrame([("1", "a", "k1", "u1"), ("2", "a", None, "u2"), ("3", "b", "k3", "u3"), ("4", "a", "k4", "u4"), ("5", "a", "k4", "u4")], "id string, entity_id string, source_key string, source_url string")
    rows = [
        (None, "a", "k1", "x", "key", "1", None), ("2", "a", "k9", "u2", "adopted", "2", None), ("2", "a", "k9", "other", None, None, "other_url"), ("3", "a", "k9", "u3", None, None, "other_owner"), ("3", "b", "k9", "u3", None, None, "other_key"), ("8", "a", "k9", "u", None, None, "missing"),
        (None, "a", "k9", "u", "new", None, None), (None, "a", "k4", "u", None, None, "several"), (None, None, None, None, "new", None, None),
    ]
    df = spark.createDataFrame([(*r[:4], i) for i, r in enumerate(rows)], "id string, entity_id string, source_key string, source_url string, i int")
    got = {r["i"]: (r["how"], r["product_id"], r["problem"]) for r in C.resolve_identity(df, stored).collect()}
    assert got == {i: r[4:] for i, r in enumerate(rows)}
    assert C.resolve_identity(df.filter("false"), stored).count() == 0 and C.resolve_identity(df, stored.filter("false")).count() == len(rows)


def test_variants(spark):
    schema = "id string, product_id string, source_key string, variant_name string, weight_g int, size string"
    stored = spark.createDataFrame([("v1", "p", "s1", "250g", 250, "x"), ("v2", "p", None, "1kg", None, "x"), ("v3", "p", None, "Big", 9, "x"), ("v4", "p", None, "Big", 9, "x")], schema)
    rows = [("p", "s1", "250g", 250), ("p", "s2", "1kg", None), ("p", "s3", "Big", 9), ("p", "s5", "New", 1), ("p", "s6", "A", 1), ("p", "s6", "B", 1), (None, None, None, None)]
    got = C.adopt_variants(spark.createDataFrame(rows, "product_id string, source_key string, variant_name string, weight_g int"), stored)
    assert sorted(((r["source_key"], r["variant_name"], r["variant_id"], r["how"], r["problem"]) for r in got.collect()), key=repr) == sorted([
        ("s1", "250g", "v1", "key", None), ("s2", "1kg", "v2", "adopted", None), ("s3", "Big", None, None, "several"), ("s5", "New", None, "new", None), ("s6", "A", None, None, "repeated_key"), ("s6", "B", None, None, "repeated_key"), (None, None, None, "new", None),
    ], key=repr)


def test_stock(spark):
    v = spark.createDataFrame([("p", 1, "in_stock", day(5)), ("p", 2, "in_stock", day(9)), ("q", 1, "sold_out", None), ("r", 1, "in_stock", day(1))], "product_id string, merchant_id int, state string, checked_at timestamp")
    checks = spark.createDataFrame([("p", 1, "sold_out", day(4)), ("p", None, "removed", day(7)), ("q", 1, "in_stock", day(2)), ("q", 1, "sold_out", day(1)), ("z", 1, "in_stock", day(3)), ("r", 1, "in_stock", day(2))], "product_id string, merchant_id int, state string, checked_at timestamp")
    new, events, unknown = C.refresh_stock(v, checks, spark.createDataFrame([("p",), ("q",), ("r",)], "product_id string"))
    assert sorted((r[0], r[1], r[2], r[3]) for r in new.collect()) == [("p", 1, "removed", day(7)), ("p", 2, "in_stock", day(9)), ("q", 1, "in_stock", day(2)), ("r", 1, "in_stock", day(2))]
    assert sorted((r["product_id"], r["changed"]) for r in events.collect()) == [("p", 1), ("q", 1)] and [r["product_id"] for r in unknown.collect()] == ["z"]
    flag, seen = C.seen_at(F.lit("sold_out"), F.lit(day(5)), F.lit(day(2)))
    assert spark.range(1).select(flag, seen).first()[:] == (False, day(2))


def test_pages(spark):
    known = spark.createDataFrame([("u", "done", 3, day(2), day(3)), ("w", "done", 1, day(1), day(1))], "url string, status string, times_seen int, first_seen_at timestamp, last_seen_at timestamp")
    seen = spark.createDataFrame([("u", day(4)), ("u", day(5)), ("x", day(6))], "url string, at timestamp")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(C.see_pages(known, seen, ["url"], "at")) == [("u", "done", 4, day(2), day(5)), ("w", "done", 1, day(1), day(1)), ("x", "new", 1, day(6), day(6))]
    assert [r[1] for r in rows(C.see_pages(known, seen, ["url"], "at", "skip"))] == ["skip", "done", "skip"]
    pages = spark.createDataFrame([("u", "b", day(1), day(5), day(1), 2, "old"), ("u", "a", None, day(9), day(2), None, "none"), ("u", "c", day(3), day(3), day(3), 4, "new"), ("v", "d", None, None, None, None, None)], "url string, id string, classified timestamp, seen timestamp, first timestamp, times int, kind string")
    assert rows(C.merge_pages(pages, ["url"], "classified", "seen", "first", "times", "id", ["kind"])) == [("u", "c", "new", 6, day(1), day(9), ["a", "b"]), ("v", "d", None, 0, None, None, [])]


def test_owners(spark):
    places = spark.createDataFrame([("e", 3, 1.0, 1.0, False), ("e", 2, 1.0, 1.0, True), ("e", 1, None, 1.0, True), ("f", 9, None, None, None), ("f", 8, None, None, None)], "owner string, id int, lat double, lng double, main boolean")
    assert sorted(tuple(r) for r in C.primary_location(places, "owner", F.lit(None).cast("boolean"), "main", "id").collect()) == [("e", 2), ("f", 8)]
    media = spark.createDataFrame([("w", "m1", 0), ("a1", "m2", 3), ("a2", "m2", 1), ("a2", "m3", 2)], "product_id string, media_asset_id string, sort_order int")
    aliases = spark.createDataFrame([("a1", "bare"), ("a2", "bare"), ("a1", "w")], "alias_id string, winner_id string")
    assert sorted(tuple(r) for r in C.carried_media(media, aliases).collect()) == [("bare", "m2", 1), ("bare", "m3", 2)]
    assert C.not_preserved(media.union(media), media, ["product_id"]).count() == 4 and C.not_preserved(media, media.union(media), ["product_id"]).count() == 0
    people = spark.createDataFrame([("n", 2, "late", ["b", None]), ("n", 1, " ", ["a", "b"]), ("n", 3, "x", None), (None, 1, None, None)], "name string, seq int, phone string, links array<string>")
    assert sorted(((r[0], r[1], r[2]) for r in C.merge_contacts(people, ["name"], "seq", ["phone"], ["links"]).collect()), key=repr)[0] == ("n", "late", ["a", "b", None])


def test_unions_and_counts(spark):
    one, two = (spark.createDataFrame(r, "url string, seq int") for r in ([("a", 2), ("a", 1), (None, 1)], [("a", 0), ("b", 5)]))
    assert sorted(((r["url"], r["seq"], r["origin"]) for r in C.union_first_wins([one, two], ["url"], "seq").collect()), key=repr) == [("a", 1, 0), ("b", 5, 1), (None, 1, 0)]
    prices = spark.createDataFrame([("p", 100), ("q", 100), ("r", 5)], "k string, minor_units int")
    market = spark.createDataFrame([("p", 100, "EUR"), ("p", 100, "EUR"), ("q", 100, "EUR"), ("q", 100, "USD"), ("r", 6, "EUR"), ("p", 100, None)], "k string, minor_units int, currency string")
    assert {r["k"]: r["market_currency"] for r in C.agreeing_market(prices, market, ["k"]).collect()} == {"p": "EUR", "q": None, "r": None}
    df = spark.createDataFrame([("e", "ok"), ("e", None), ("e", "odd")], "e string, s string")
    assert C.outcomes(df, ["e"], F.col("s"), ["ok", "bad"]).first()[:] == ("e", 3, 1, 0, 2)
    places = [r["place"] for r in C.seeded_order(prices, ["k"], 1).collect()]
    assert len(set(places)) == 3 and places == [r["place"] for r in C.seeded_order(prices, ["k"], 1).collect()] != [r["place"] for r in C.seeded_order(prices, ["k"], 2).collect()]
