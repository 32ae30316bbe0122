"""Scalar functions: goldens and edges."""

import datetime
import hashlib
import json
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamis.functions import http, jsonx, keys, money, page, processing, text, url, values
from tamis.operators import availability


def one(spark, make, *values):
    """Results of a column function for rows of one or more string columns."""
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    n = len(rows[0])
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(n)))
    return [r[0] for r in df.select("i", make(*[F.col(f"c{k}") for k in range(n)]).alias("r")).orderBy("i").select("r").collect()]


def test_slugs(spark):
    assert one(spark, text.slug, "Café  Nº 1 & Söhne", "---", None, "A" * 40) == ["caf-n-1-s-hne", "", None, "a" * 30]
    assert one(spark, lambda c: text.slug(c, 80, "coffee"), "!!", None, "Ok") == ["coffee", "coffee", "ok"]
    assert one(spark, text.folded_slug, "Café & Söhne", "コーヒー") == ["cafe-and-sohne", "item"]


def test_names(spark):
    assert one(spark, text.strict_name_key, "Ｊａｎ & Co., Ltd.", "!!", None) == ["jan and co ltd", None, None]
    assert one(spark, text.name_problem, "Good Name", "x", None, "see www.a.b", "a@b.org x", "--", "N/A", "a\x01b", "y" * 161) == [None, "length", "length", "url_or_email", "url_or_email", "no_letter", "placeholder", "control_characters", "length"]
    assert one(spark, text.clean, "  a \t b ", "   ", None) == ["a b", None, None]
    assert one(spark, text.present, "x", " ", "NULL", "n/a", None) == [True, False, False, False, False]
    assert one(spark, text.same_tokens, ("Kenya AA - Kiambu", "kiambu, kenya aa"), ("a b", "a"), (None, "a")) == [True, False, None]
    assert one(spark, text.numeric_tokens, "1,5 kg 2x10", "none", None) == [["1.5", "10", "2"], [], None]
    assert one(spark, text.has_foreign_script, "abc", "日本", "한국", None) == [False, True, True, None]
    assert one(spark, text.elevation_m, "1950", "1950masl", "1950 m", "about 1950", None, "999999") == [1950, 1950, 1950, None, None, None]


def test_titles_and_tags(spark):
    assert one(spark, lambda t, o: text.display_title(t, o), ("KENYA: KIAMBU AA SL28", "Kenya"), ("Kenya", "Kenya"), ("Single Origin - Peru - Sol", "Peru"), ("a.b", None)) == ["Kiambu AA SL28", "Kenya", "Sol", "a.b"]
    assert one(spark, text.strip_tags, "<p>A &amp; B<br>c</p><script>x<y</script><!-- z -->", None, "") == ["A & B\nc", None, ""]


def test_retry_after(spark):
    now = F.lit(datetime.datetime(2026, 1, 1, 0, 0, 0))
    assert one(spark, lambda c: text.retry_after_seconds(c, now), "120", "Thu, 01 Jan 2026 00:01:30 GMT", "Wed, 31 Dec 2025 00:00:00 GMT", "soon", None) == [120, 90, 0, None, None]


def test_urls(spark):
    u = "HTTPS://WWW.Shop.Example:8080/A b|c/?x=1&utm_source=y&ref=z#top"
    assert one(spark, url.normalise, u, "https://a.example", "nonsense", None, "ftp://x.y/") == ["https://www.shop.example:8080/A b|c?x=1&utm_source=y&ref=z", "https://a.example", None, None, None]
    assert one(spark, url.canonical, u, "http://www.a.example//p//?b=2&a=1&gclid=3") == ["https://shop.example/A b|c?x=1", "http://a.example//p?a=1&b=2"]
    assert one(spark, url.canonical_host, u, "https://www.a.example./", "https://user:pw@h.example/", "", None) == ["shop.example", "a.example", "h.example", None, None]
    assert sorted(one(spark, url.variants, "https://a.example/x")[0]) == sorted(f"{s}://{h}/x{e}" for s in ("http", "https") for h in ("a.example", "www.a.example") for e in ("", "/"))
    assert len(one(spark, url.variants, "http://www.a.example/")[0]) == 4 and one(spark, url.variants, "x") == [None]
    assert one(spark, url.after_host, "https://a.example/P?Q=R#S", "Free Text") == ["/p?q=r#s", "free text"]
    assert one(spark, url.parent_host, "m.a.example", "a.example", "example") == ["a.example", None, None]
    assert one(spark, lambda c: url.allowed(c, ["a.example"]), "https://a.example/x", "http://a.example/x", "https://a.example/%2563art/1", "https://u@a.example/x", "https://a.example:444/x", "https://b.example/", None) == [True, False, False, False, False, False, False]
    assert one(spark, url.shared_site_kind, "instagram.com", "m.facebook.com", "notfacebook.com", None) == ["social", "social", None, None]
    assert one(spark, url.link_kind, "https://a.example/products/x", "https://a.example/collections/all", "https://a.example/about") == ["product", "listing", None]
    assert one(spark, url.private_ip, "::1", "fe80::1", "2606:4700::1111", "::ffff:10.0.0.1", "8.8.8.8", "x", None) == [True, True, False, True, False, True, True]


def test_keys(spark):
    want = hashlib.sha256(json.dumps(["a/é", None, "x"], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    assert one(spark, lambda a, b: keys.stable_key(a, b, "x"), ("a/é", None)) == [want]
    got = one(spark, lambda a: keys.stable_uuid(a), *[f"v{i}" for i in range(40)])
    for i, g in enumerate(got):
        h = bytearray(bytes.fromhex(hashlib.sha256(json.dumps([f"v{i}"]).encode()).hexdigest())[:16])
        h[6], h[8] = (h[6] & 15) | 80, (h[8] & 63) | 128
        assert g == str(uuid.UUID(bytes=bytes(h)))
    assert one(spark, lambda a, b: keys.source_key(a, b), ("s", None)) == [hashlib.sha256(b"s\0").hexdigest()[:24]]
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    f = lambda df: keys.multiset_fingerprint(df).first()[:]
    assert f(a) == f(a.orderBy(F.desc("k"))) and f(a) != f(a.distinct()) and f(a.filter("false"))[0] == 0
    assert keys.ordered_fingerprint(a, "k").first()["rows"] == 3


MONEY = [
    (("€12,50", None, None), (12.5, "EUR", 1250, None)), (("1 234,50 Kč", None, "cs"), (1234.5, "CZK", 123450, None)), (("1'234.50 CHF", None, None), (1234.5, "CHF", 123450, None)), (("12.50", "usd", None), (12.5, "USD", 1250, None)), (("¥1,200", "JPY", None), (None, "JPY", None, "locale_required")),
    (("￦12,000", "KRW", "ko-KR"), (12000, "KRW", 12000, None)), (("$12", None, None), (12, None, None, "unknown_currency")), (("12", "dollars", None), (None, None, None, "conflicting_or_invalid_currency")), (("1,23,456.00", "INR", None), (None, "INR", None, "invalid_grouping")), (("twelve", "USD", None), (None, "USD", None, "missing_amount")),
    (("12 TTC", "EUR", None), (12, "EUR", 1200, None)), (("1 23 EUR", None, None), (None, "EUR", None, "invalid_grouping")), (("30000000", "EUR", None), (None, "EUR", None, "amount_overflow")), ((None, None, None), (None, None, None, "missing_or_range_price")),
]


def test_money(spark):
    got = one(spark, lambda *c: money.amount(*c), *[m[0] for m in MONEY])
    for (given_, want), r in zip(MONEY, got):
        assert (None if r["amount"] is None else float(r["amount"]), r["currency"], r["minor_units"], r["reason"]) == want, given_


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.sampled_from([None, "EUR", "x", ""]), st.sampled_from([None, "de", "en-US", "?"])), min_size=1, max_size=30))
def test_money_never_fails(spark, rows):
    clean = [tuple(None if v is None else v.replace("\x00", "").encode("utf-8", "ignore").decode() for v in r) for r in rows]
    assert all(r is not None for r in one(spark, lambda *c: money.amount(*c), *clean))


def test_json(spark):
    assert one(spark, jsonx.canonical, '{"b":1,"a":[2, 3]}', "{bad", None) == ['{"a":[2,3],"b":1}', None, None]
    assert one(spark, jsonx.deep_merge, ('{"a":{"x":1},"b":null}', '{"a":{"x":2,"y":3},"b":4}'), (None, '{"a":1}')) == ['{"a":{"x":1,"y":3},"b":4}', '{"a":1}']
    assert one(spark, jsonx.resolve_indexed, '[{"a":1,"b":2},"x",[3,0],7]', "[]", "{}", None) == ['{"a":"x","b":[7,null]}', None, None, None]
    assert one(spark, lambda c: jsonx.script_literal(c, "stock"), 'var stock = {"a": [1, "}"]}; x', "stock = ; stock: [1]", "none", None) == ['{"a":[1,"}"]}', "[1]", None, None]


HTML = """<html><head><title> A  shop </title><link rel="canonical" href="/c"><meta property="og:type" content="product"></head><body><h1>Kenya <b>AA</b></h1>
<p>Sweet &amp; long</p><script>var x = '<p>no</p>'</script><a href="/x">More</a><img src="i.png">
<script type="application/ld+json">{"@graph":[{"@type":"Product","name":"Kenya AA","sku":"k","offers":[{"price":12.5,"priceCurrency":"EUR","availability":"https://schema.org/InStock","url":"/p?variant=77"}]}]}</script></body></html>"""
GROUP = """<script type="application/ld+json">{"@type":"ProductGroup","name":"G","productGroupID":"9","hasVariant":[{"@type":"Product","name":"250 g","sku":"a","offers":{"price":"9","priceCurrency":"EUR","availability":"http://schema.org/SoldOut"}},{"@type":"Product","name":"1 kg","sku":"b","offers":{"price":"30"}}]}</script>"""


def test_page(spark):
    p = one(spark, page.page, HTML, None, "", "<p>broken <b", GROUP)
    assert p[0]["title"] == "A shop" and p[0]["h1"] == ["Kenya AA"] and p[0]["text"] == "Kenya AA\nSweet & long\nMore" and p[0]["links"][0]["href"] == "/x" and p[0]["images"] == ["i.png"] and p[0]["canonical"] == "/c" and p[0]["meta"]["og:type"] == "product"
    assert p[1] is None and p[2]["text"] == "" and p[3]["text"].startswith("broken")
    s = one(spark, lambda c: page.structured_product(page.page(c)["json_ld"]), HTML, GROUP, "", None, HTML + GROUP)
    assert s[0]["name"] == "Kenya AA" and s[0]["offers"][0][:] == ("77", "k", "Kenya AA", "12.5", "EUR", "InStock", "/p?variant=77")
    assert [o["sku"] for o in s[1]["offers"]] == ["a", "b"]
    for empty in s[2:]:
        assert empty is None or empty["name"] is None
    assert one(spark, page.schema_availability, "https://schema.org/InStock", "SoldOut/", "PreOrder", None) == ["in_stock", "sold_out", "unknown", "unknown"]


def test_processing(spark):
    t = ["Washed, then dried", "Not washed, but natural", "Maybe anaerobic?", "Without lactic fermentation, aerobic", "not only washed", "Neither, not washed or natural", None, "Anaeróbico natural", "honey rather than washed"]
    assert one(spark, processing.methods, *t) == [["washed"], ["natural"], [], ["aerobic"], ["washed"], [], [], ["natural", "anaerobic"], ["honey"]]
    assert one(spark, processing.coferment, "Fully washed, never co-fermented.", "Co‑fermented with mango.", "Can it be co-fermented?", "Unlike coferments, dry.", "Cofermented. This lot is not co-fermented.", None) == [False, True, None, None, None, None]
    assert one(spark, processing.labelled, "x\nProcess - Washed\ny", "Process:\n\nHoney", "Processing\n: \nDry", "Process:\nOrigin: X", "Processing this lot takes days", None) == ["Washed", "Honey", "Dry", None, None, None]
    f = one(
        spark, lambda a, b, c: processing.facts(a, b, c), ("Kenya natural", "Washed", "Notes of honey and natural sweetness"), ("Kenya natural", None, "Process: Honey"), (None, None, None), ("Double Anaerobic Lot", None, None), ("Non-anaerobic Lot", None, None),
        ("Lot 7", "unknown", "Co-fermented with mango and passion fruit.\nNotes: rose."), ("Natural High Espresso", None, None),
    )
    assert [x["process"] for x in f] == ["Washed", "Honey", None, "Anaerobic", None, None, None] and [x["methods"] for x in f] == [["washed"], ["honey"], [], ["anaerobic"], [], [], []]
    assert [x["source"] for x in f] == ["attribute", "label", None, "title", None, None, None] and f[5]["ingredients"] == ["mango", "passion fruit"] and f[5]["claims"][0]["source"] == "description"
    g = one(spark, lambda a, b, c: processing.facts(F.lit("Lot"), F.lit(None).cast("string"), a, F.split(b, ","), c, F.split(b, ",")), ("Not co-fermented.", "natural,washed", "yes"), (None, "honey", "No"), (None, None, "perhaps"))
    assert [(x["is_coferment"], x["conflict"], x["process"]) for x in g] == [(None, True, "natural / washed"), (False, False, "honey"), (None, False, None)]


def test_prices_in_hundredths(spark):
    t = ["7,50€", "18,20€ TTC", "€9.00", "AUD 45.00", "2.350,00 Kč", "USD 3,450.00", "14 500,00 Kč", "CHF 2’250.50", "30000 CLP", "0", "21474836.47", "21474836.48", "10-12", "from $9.00", "3 bags $9.00", "$9 per 250g", "5% off", "2.345", "2,345", "1,2,3", "-3.00", "(3.00)", "3e2", "", None]
    assert one(spark, values.price_cents, *t) == [750, 1820, 900, 4500, 235000, 345000, 1450000, 225050, 3000000, 0, 2147483647] + [None] * 14
    assert one(spark, lambda c: values.amount_cents(c.cast("double")), "8.99", "-1", "NaN", "Infinity", None) == [899, None, None, None, None]


def test_label_weights(spark):
    t = ["200g", "2kg / Whole", "Moon (350g) / filter", "340gr", "2,5 kg", "12 oz", "1lb", "0.25 kilogram", "500 Gramm / fein", "원두200g", "2 x 200g", "200g / 1kg", "200–400g", "-200g", "200", None, "2.000g", "200g x 2", "3 bags of 200g", "200 Grammatik", "0 g", "2147483648 g"]
    assert one(spark, values.weight_grams, *t) == [200, 2000, 350, 340, 2500, 340, 454, 250, 500, 200] + [None] * 12
    t = ["250g - 12/10", "250gm", "2 kilos", "12 oz (340g)", "340 g / 12 oz", "8oz / 340g", "1kg (4 x 250g vac sealed pouches)", "1kg (3 x 250g vac sealed pouches)", None, ""]
    assert one(spark, values.label_weight, *t) == [250, 250, 2000, 340, 340, None, 1000, None, None, None]


def test_tasting_notes(spark):
    n = one(spark, lambda c: values.tasting_notes(F.split(c, r"\|")), "Blueberries|hint of rose| Candied  plum|Chocolat noir", None)
    assert [tuple(x)[1:] for x in n[0]] == [("blueberry", ["fruit", "berry"], "mapped"), (None, [], "uncertain"), (None, [], "unmapped"), ("dark chocolate", ["sweet", "chocolate"], "mapped")] and n[1] is None
    assert one(spark, values.note_list, "a, b;c|d", None) == [["a", " b", "c", "d"], None]


def test_availability(spark):
    schema = "status int, heading string, url string, final string, native array<struct<id: bigint, title: string, available: boolean>>, offers array<struct<source_id: string, sku: string, name: string, availability: string, url: string>>, controls array<struct<text: string, disabled: boolean>>, tags array<string>"
    u = "https://a.example/products/x"
    rows = [
        (404, None, u, u, [(1, "s", True)], None, None, None), (429, None, u, u, None, None, None, None), (200, "Page not found", u, u, None, None, None, None), (200, "X", u, "https://a.example/", None, None, None, None), (200, "X", u, u, [(1, "s", False), (2, "m", None)], None, None, None),
        (200, "X", u, u, [(1, "s", False), (2, "m", True)], None, None, ["Pre-Order"]), (None, None, u, None, [(1, "s", False)], None, None, None), (200, "X", u, u, None, [(None, None, "s", "https://schema.org/OutOfStock", u + "?variant=7"), (None, "k", "o", "InStock", "/products/y")], None, None),
        (200, "X", u, u, None, None, [("Add to cart", False)], None), (200, "X", u, u, None, None, [("Add to cart", True), ("Share", False)], None), (200, "X", u, u, [], None, [("Share", False)], None), (None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = df.select(availability.decision(F.col("status"), F.col("heading"), F.col("url"), F.col("final"), F.col("native"), F.col("offers"), F.col("controls"), availability.preorder(F.col("tags"))).alias("a")).collect()
    assert [(r.a["state"], r.a["reason"]) for r in got] == [
        ("removed", "product_http_removed"), ("unknown", "incomplete_fetch"), ("removed", "product_soft_404"), ("removed", "product_redirected_away"), ("unknown", "shop_exact_variants"), ("unknown", "primary_product_preorder"), ("sold_out", "shop_exact_variants"),
        ("sold_out", "product_scoped_structured_data"), ("in_stock", "primary_product_controls"), ("unknown", "primary_product_controls"), ("unknown", "product_stock_evidence_missing"), ("unknown", "product_stock_evidence_missing"),
    ]
    assert [tuple(v) for v in got[7].a["variants"]] == [("7", "s", "sold_out")] and got[0].a["is_available"] is False and got[8].a["is_available"] and got[1].a["is_available"] is None


@pytest.mark.parametrize("name", ["slug", "clean", "strict_name_key", "strip_tags", "name_problem"])
def test_long_texts(spark, name):
    assert len(one(spark, getattr(text, name), "word & " * 100_000)) == 1


def test_failures(spark):
    got = one(spark, lambda s, c, m: http.failure_kind(s.cast("int"), c, m), ("403", None, None), ("404", None, None), ("503", "ENOTFOUND", None), (None, "ENOTFOUND", None), (None, None, "bad SSL"), ("0", None, "timeout of 3"), ("200", None, "odd"), (None, None, None), ("310", None, "too many redirects"))
    assert got == ["blocked", "stale_or_missing_url", "transient_http", "dns", "tls_certificate", "timeout", "unknown", "network", "redirect_loop"]
    assert one(spark, lambda s: http.retryable(s.cast("int")), "403", "404", "500", None) == [True, False, True, True]


def test_page_signs(spark):
    assert one(spark, page.platform, "<script src=//cdn.Shopify.com>", "wp-content", "squarespace", "x", None) == ["shopify", "woocommerce", "custom", "custom", "unknown"]
    a, b, c = one(spark, page.semantic_hash, ("Kenya", "Sweet  and\nlong"), ("KENYA ", "sweet and long"), ("Kenya", None))
    assert a == b != c
    got = one(spark, lambda h: page.primary_image(F.lit(None).cast("string"), page.page(h)["meta"], page.page(h)["images"]), '<img src="logo.png"><img src="bag.jpg">', '<meta property="og:image" content="og.jpg"><img src="bag.jpg">', "<p>")
    assert got == ["bag.jpg", "og.jpg", None]
    many = "<h1>All</h1>" + "".join(f'<a href="/products/p{i}">p</a>' for i in range(15)) + "x" * 60
    assert one(spark, lambda h: page.listing_guard(page.page(h)["h1"], page.page(h)["links"], page.page(h)["text"]), many, "<p>x</p>", "<p>" + "long " * 20) == ["listing", "empty_shell", None]
    parts = one(spark, lambda i, t: page.text_parts(i, title=t, note=F.lit(" ")), ("1", "Hallo"), ("2", None))
    assert [(p["field"], p["text"]) for p in parts[0]] == [("title", "Hallo")] and parts[1] == []
