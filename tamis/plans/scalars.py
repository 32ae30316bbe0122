"""Queries on names, titles, keys, markup and other scalar values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import http, jsonx, keys, money, page, processing, text, url
from tamis.operators import adapters, merge, robots
from tamis.session import table


def x17_slugs(spark, d):
    p = table(spark, d, "products")
    return p.select("id", text.slug(F.col("name")).alias("slug30"), text.slug(F.col("name"), 80, "coffee").alias("slug80"), text.slug(F.col("name"), 110, "coffee").alias("slug110"))


def x17_folded_slug(spark, d):
    return table(spark, d, "entities").select("id", text.folded_slug(F.col("name"), 80, "roaster").alias("slug"))


def x18_strict_name_key(spark, d):
    return table(spark, d, "roaster_directory").select("directory_id", text.strict_name_key(F.col("name"), False).alias("name_key"))


def x20_clean(spark, d):
    return table(spark, d, "products").select("id", text.clean(F.col("name")).alias("name"))


def x21_name_problem(spark, d):
    return table(spark, d, "documents").select("doc_id", text.name_problem(F.col("title")).alias("problem"))


def f27_present(spark, d):
    return table(spark, d, "documents").select("doc_id", text.present(F.col("lang")).alias("labelled"), text.null_words(F.col("lang")).alias("lang"), text.first_value(F.col("title"), F.col("url"), F.col("source")).alias("first"))


def x27_stable_key(spark, d):
    p = table(spark, d, "products")
    return p.select("id", keys.stable_key(F.col("entity_id"), "url", F.col("source_url")).alias("key"), keys.stable_uuid(F.col("entity_id"), F.col("slug")).alias("uuid"))


def x50_same_tokens(spark, d):
    p = table(spark, d, "products")
    return p.select("id", text.same_tokens(F.col("name"), F.replace("slug", F.lit("-"), F.lit(" "))).alias("same"))


def x57_numeric_tokens(spark, d):
    v = table(spark, d, "product_variants").select("title").distinct()
    return v.select("title", F.array_join(text.numeric_tokens(F.col("title")), " ").alias("numbers"))


def x57_foreign_script(spark, d):
    return table(spark, d, "documents").select("doc_id", text.has_foreign_script(F.col("text")).alias("foreign"))


def x62_strip_tags(spark, d):
    return table(spark, d, "captured_pages").select("page_id", F.length(text.strip_tags(F.coalesce("html", "primary_html"))).alias("letters"))


def x67_elevation(spark, d):
    p = table(spark, d, "products")
    return p.select("id", text.elevation_m(F.get_json_object("metadata", "$.elevation")).alias("elevation_m"), F.get_json_object("metadata", "$.variety").alias("variety"))


def x09_display_title(spark, d):
    p = table(spark, d, "products")
    return p.select("id", text.display_title(F.col("name"), F.get_json_object("metadata", "$.country_of_origin")).alias("title"))


def x36_page_facts(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", page.page(F.coalesce("html", "primary_html")).alias("p"))
    return p.select("page_id", F.col("p.title").alias("title"), F.get("p.h1", 0).alias("h1"), F.length("p.text").alias("letters"), F.size("p.links").alias("links"), F.size("p.json_ld").alias("json_ld"))


def x37_structured_product(spark, d):
    return adapters.json_ld(table(spark, d, "captured_pages")).select("page_id", "title", "variant_id", "price", "currency", "available")


def x51_platform(spark, d):
    return table(spark, d, "captured_pages").select("page_id", page.platform(F.coalesce("html", "primary_html")).alias("platform"))


def x45_semantic_hash(spark, d):
    p = table(spark, d, "products")
    return p.select("id", page.semantic_hash(F.col("name"), F.col("description_raw")).alias("hash"))


def f21_listing_guard(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", page.page(F.coalesce("html", "primary_html")).alias("p"))
    return p.select("page_id", page.listing_guard(F.col("p.h1"), F.col("p.links"), F.col("p.text")).alias("reason"))


def f23_failure_kind(spark, d):
    p = table(spark, d, "captured_pages")
    return p.groupBy(http.failure_kind(F.col("status"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("kind"), http.retryable(F.col("status")).alias("retryable")).agg(F.count("*").alias("pages"))


def x58_text_parts(spark, d):
    p = table(spark, d, "products")
    return p.select(F.explode(page.text_parts(F.col("id"), name=F.col("name"), description=F.col("description_raw"))).alias("x")).select("x.field", F.length("x.text").alias("letters"), "x.hash")


def x33_processing(spark, d):
    p = table(spark, d, "products")
    f = p.select("id", processing.facts(F.col("name"), F.get_json_object("metadata", "$.process"), F.col("description_raw")).alias("f"))
    return f.select("id", F.col("f.process").alias("process"), F.array_join("f.methods", ",").alias("methods"), F.col("f.is_coferment").alias("is_coferment"))


def x53_signal_ladder(spark, d):
    t = F.lower(F.coalesce("text", F.lit("")))
    has = lambda p: t.rlike(p)
    strong = sum((F.when(has(p), 1).otherwise(0) for p in STRONG), F.lit(0))
    weak = sum((F.when(has(p), 1).otherwise(0) for p in WEAK), F.lit(0))
    kind = F.when(has(CLOSED), "closed").when(strong >= 1, "maker").when(weak >= 2, "likely").otherwise("unclear")
    return table(spark, d, "documents").select("doc_id", strong.alias("strong"), weak.alias("weak"), kind.alias("kind"))


STRONG = ["we roast", "roasted to order", "our roast", "wir rösten", "nous torréfions", "tostamos"]
WEAK = ["coffee", "espresso", "filter", "beans", "brew"]
CLOSED = "permanently closed|out of business"


def u04_overlay_json(spark, d):
    """The new object's fields over the stored ones, field by field: what merge.overlay_json does."""
    p = table(spark, d, "products")
    o = merge.overlay_json(F.col("metadata"), F.lit('{"variety":"seen","audit":"new"}'))
    return p.select("id", F.get_json_object(o, "$.variety").alias("variety"), F.get_json_object(o, "$.audit").alias("audit"), F.get_json_object(o, "$.country_of_origin").alias("country"))


def x59_deep_merge(spark, d):
    """Metadata merged into an object of its own, level by level."""
    p = table(spark, d, "products")
    m = jsonx.deep_merge(F.lit('{"audit":{"seen":true,"by":"a"}}'), F.coalesce("metadata", F.lit('{"audit":{"by":"b"}}')))
    return p.select("id", F.get_json_object(m, "$.audit.seen").alias("seen"), F.get_json_object(m, "$.audit.by").alias("by"), F.get_json_object(m, "$.variety").alias("variety"))


def x01_money_parse(spark, d):
    df = spark.createDataFrame(MONEY, "raw string, currency string, locale string")
    a = df.select("raw", money.amount(F.col("raw"), F.col("currency"), F.col("locale")).alias("a"))
    return a.select("raw", F.col("a.amount").cast("double").alias("amount"), F.col("a.currency").alias("currency"), F.col("a.minor_units").alias("minor_units"), F.col("a.reason").alias("reason"))


#: raw, currency, locale
MONEY = [("€12,50", None, None), ("1.234,56 EUR", None, None), ("$10", None, None), ("US$1,234.50", None, None), ("12.500", "EUR", None), ("12.500", "EUR", "de-DE"), ("25000", "KRW", None), ("10-12", "EUR", None), ("from 10 EUR", None, None), ("", "EUR", None), ("10.555", "KWD", "en-US"), ("10.55", "JPY", None), ("EUR 10 GBP", None, None), ("99999999999", "USD", None)]


def f15_private_ip(spark, d):
    df = spark.createDataFrame([(x,) for x in ADDRESSES], "ip string")
    return df.select("ip", url.private_ipv4(F.col("ip")).alias("private"))


ADDRESSES = ["10.0.0.1", "8.8.8.8", "172.16.3.4", "172.32.0.1", "192.168.1.1", "192.0.2.1", "198.51.100.7", "203.0.113.9", "203.1.1.1", "100.64.0.1", "100.128.0.1", "224.0.0.1", "169.254.1.1", "1.2.3", "256.1.1.1"]


def f16_robots(spark, d):
    paths = table(spark, d, "captured_pages").select(F.regexp_extract("url", "^[^:]+://([^/?#]+)", 1).alias("host"), F.regexp_extract("url", "^[^:]+://[^/?#]+(.*)$", 1).alias("path")).distinct()
    texts = paths.select("host").distinct().withColumn("text", F.lit(ROBOTS))
    return robots.allowed(paths, texts, "tamis-bot").select("host", "path", "allowed")


ROBOTS = "User-agent: *\nDisallow: /products/\nAllow: /products/*-a\n\nUser-agent: other\nDisallow: /\n"

QUERIES = {f.__name__: f for f in (x17_slugs, x17_folded_slug, x18_strict_name_key, x20_clean, x21_name_problem, f27_present, x27_stable_key, x50_same_tokens, x57_numeric_tokens, x57_foreign_script, x62_strip_tags, x67_elevation, x09_display_title, x36_page_facts, x37_structured_product, x51_platform, x45_semantic_hash, f21_listing_guard, f23_failure_kind, x58_text_parts, x33_processing, x53_signal_ladder, u04_overlay_json, x59_deep_merge, x01_money_parse, f15_private_ip, f16_robots)}

_DASH = "regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_COUNT = lambda ps: " + ".join(f"case when contains(t, '{p}') then 1 else 0 end" for p in ps)
SQL = {
    "x17_slugs": f"select id, left({_DASH.format(c='name')}, 30) as slug30, coalesce(nullif(left({_DASH.format(c='name')}, 80), ''), 'coffee') as slug80, coalesce(nullif(left({_DASH.format(c='name')}, 110), ''), 'coffee') as slug110 from products",
    "x17_folded_slug": "select id, coalesce(nullif(left(" + _DASH.format(c="replace(strip_accents(name), '&', ' and ')") + ", 80), ''), 'roaster') as slug from entities",
    "x18_strict_name_key": r"select directory_id, nullif(trim(regexp_replace(regexp_replace(replace(lower(name), '&', ' and '), '[\p{P}\p{S}]+', ' ', 'g'), '[\s\x{00A0}]+', ' ', 'g')), '') as name_key from roaster_directory",
    "x20_clean": r"select id, nullif(trim(regexp_replace(name, '[\s\x{00A0}]+', ' ', 'g')), '') as name from products",
    "x21_name_problem": r"with c as (select doc_id, coalesce(title, '') as raw, coalesce(nullif(trim(regexp_replace(title, '[\s\x{00A0}]+', ' ', 'g')), ''), '') as t from documents) select doc_id, case when regexp_matches(raw, '[\x00-\x1f\x7f]') then 'control_characters' when length(t) < 2 or length(t) > 160 then 'length' when regexp_matches(t, '(?i)https?://|www\.|@[^ ]+\.[a-z]{2,}') then 'url_or_email' when not regexp_matches(t, '[\p{L}\p{N}]') then 'no_letter' when lower(t) in ('unknown', 'n/a', 'na', 'none', 'null', 'untitled', 'test') then 'placeholder' end as problem from c",
    "f27_present": "select doc_id, coalesce(lower(trim(lang)) not in ('', 'null', 'unknown', 'n/a'), false) as labelled, case when trim(lang) not in ('null', 'NULL') then lang end as lang, coalesce(nullif(title, ''), nullif(url, ''), nullif(source, '')) as first from documents",
    "x27_stable_key": """with k as (select id, sha256(cast(to_json([entity_id, 'url', source_url]) as varchar)) as key, sha256(cast(to_json([entity_id, slug]) as varchar)) as h from products)
        select id, key, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || case h[17:17] when '0' then '8' when '4' then '8' when '8' then '8' when 'c' then '8' when '1' then '9' when '5' then '9' when '9' then '9' when 'd' then '9' when '2' then 'a' when '6' then 'a' when 'a' then 'a' when 'e' then 'a' else 'b' end || h[18:20] || '-' || h[21:32] as uuid from k""",
    "x50_same_tokens": r"select id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(name), '[^\p{L}\p{N}]+'), lambda x: x <> ''))) = list_sort(list_distinct(list_filter(regexp_split_to_array(lower(replace(slug, '-', ' ')), '[^\p{L}\p{N}]+'), lambda x: x <> ''))) as same from products",
    "x57_numeric_tokens": "select distinct title, array_to_string(list_sort(list_transform(regexp_extract_all(title, '[0-9]+(?:[.,][0-9]+)*'), lambda x: replace(x, ',', '.'))), ' ') as numbers from product_variants",
    "x57_foreign_script": r"select doc_id, regexp_matches(text, '[\p{Hangul}\p{Han}\p{Hiragana}\p{Katakana}\p{Cyrillic}\p{Thai}\p{Arabic}]') as foreign from documents",
    "x67_elevation": "select id, case when regexp_matches(trim(e), '(?i)^[0-9]{1,5}(\\s*(m|masl))?$') then cast(regexp_extract(e, '([0-9]+)', 1) as int) end as elevation_m, json_extract_string(metadata, '$.variety') as variety from (select *, json_extract_string(metadata, '$.elevation') as e from products)",
    "x51_platform": "select page_id, case when h is null then 'unknown' when contains(h, 'shopify') then 'shopify' when contains(h, 'woocommerce') or contains(h, 'wp-content') then 'woocommerce' else 'custom' end as platform from (select page_id, lower(coalesce(html, primary_html)) as h from captured_pages)",
    "f23_failure_kind": "select case when s = 403 then 'blocked' when s = 404 then 'stale_or_missing_url' when s = 429 then 'rate_limited' when s in (402, 409) then 'http_state' when s >= 500 then 'transient_http' when s = 0 then 'network' else 'unknown' end as kind, s in (0, 403, 429) or s >= 500 as retryable, count(*) as pages from (select coalesce(status, 0) as s from captured_pages) group by 1, 2",
    "x53_signal_ladder": f"with s as (select doc_id, lower(coalesce(text, '')) as t from documents), c as (select doc_id, {_COUNT(STRONG)} as strong, {_COUNT(WEAK)} as weak, regexp_matches(t, '{CLOSED}') as closed from s) select doc_id, strong, weak, case when closed then 'closed' when strong >= 1 then 'maker' when weak >= 2 then 'likely' else 'unclear' end as kind from c",
    "x01_money_parse": """select * from (values ('€12,50', 12.5::double, 'EUR', 1250, null), ('1.234,56 EUR', 1234.56, 'EUR', 123456, null), ('$10', 10, null, null, 'unknown_currency'), ('US$1,234.50', 1234.5, 'USD', 123450, null), ('12.500', null, 'EUR', null, 'locale_required'), ('12.500', 12500, 'EUR', 1250000, null), ('25000', 25000, 'KRW', 25000, null),
        ('10-12', null, 'EUR', null, 'missing_or_range_price'), ('from 10 EUR', null, 'EUR', null, 'price_prose'), ('', null, 'EUR', null, 'missing_or_range_price'), ('10.555', 10.555, 'KWD', 10555, null), ('10.55', null, 'JPY', null, 'currency_precision'), ('EUR 10 GBP', null, null, null, 'conflicting_or_invalid_currency'), ('99999999999', null, 'USD', null, 'amount_overflow')) t(raw, amount, currency, minor_units, reason)""",
    "f15_private_ip": "select * from (values ('10.0.0.1', true), ('8.8.8.8', false), ('172.16.3.4', true), ('172.32.0.1', false), ('192.168.1.1', true), ('192.0.2.1', true), ('198.51.100.7', true), ('203.0.113.9', true), ('203.1.1.1', false), ('100.64.0.1', true), ('100.128.0.1', false), ('224.0.0.1', true), ('169.254.1.1', true), ('1.2.3', true), ('256.1.1.1', true)) t(ip, private)",
    "f16_robots": "select distinct regexp_extract(url, '^[^:]+://([^/?#]+)', 1) as host, regexp_extract(url, '^[^:]+://[^/?#]+(.*)$', 1) as path, not (regexp_extract(url, '^[^:]+://[^/?#]+(.*)$', 1) like '/products/%' and not regexp_matches(regexp_extract(url, '^[^:]+://[^/?#]+(.*)$', 1), '^/products/.*-a')) as allowed from captured_pages",
    "u04_overlay_json": "select id, 'seen' as variety, 'new' as audit, json_extract_string(metadata, '$.country_of_origin') as country from products",
    "x59_deep_merge": "select id, 'true' as seen, 'a' as by, json_extract_string(metadata, '$.variety') as variety from products",
    "x45_semantic_hash": r"select id, sha256(cast(to_json([lower(trim(regexp_replace(coalesce(name, ''), '\s+', ' ', 'g'))), lower(trim(regexp_replace(coalesce(description_raw, ''), '\s+', ' ', 'g')))]) as varchar)) as hash from products",
    "x58_text_parts": "select field, length(v) as letters, sha256(cast(to_json([id, field, v]) as varchar)) as hash from (select id, 'name' as field, name as v from products union all select id, 'description', description_raw from products) where trim(v) <> ''",
    "x62_strip_tags": r"""with a as (select page_id, regexp_replace(coalesce(html, primary_html), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g') as t from captured_pages), b as (select page_id, regexp_replace(regexp_replace(t, '(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr)>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g') as t from a),
        c as (select page_id, replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&amp;', '&') as t from b)
        select page_id, length(regexp_replace(regexp_replace(regexp_replace(t, '[ \t\x{00A0}]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g')) as letters from c""",
    "x09_display_title": rf"""with o as (select id, trim(name) as t, trim(json_extract_string(metadata, '$.country_of_origin')) as o from products), r as (select id, t, case when o <> '' then trim(regexp_replace(t, '(?i)^(?:single origin\s*[:—–-]\s*)?\Q' || o || '\E\s*[:|—–-]\s*', '')) end as r from o),
        k as (select id, coalesce(nullif(r, ''), t) as t from r)
        select id, case when t = upper(t) and regexp_matches(t, '\p{{L}}') then array_to_string(list_transform(regexp_extract_all(t, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), lambda w: case when regexp_matches(w, '^(?:{text.GRADES})$') then w else upper(w[1:1]) || lower(w[2:]) end), '') else t end as title from k""",
}
