"""Queries that join tables with guards, priorities and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions.text import strict_name_key
from tamis.functions.url import canonical_host
from tamis.operators import importplan, joins
from tamis.plans.urls import _sql_host
from tamis.session import table


def _entities(spark, d):
    e = table(spark, d, "entities")
    return e.select("id", "name", "country", "region", canonical_host(F.col("website_url")).alias("host"), strict_name_key(F.col("name"), False).alias("name_key"))


def _directory(spark, d):
    r = table(spark, d, "roaster_directory")
    return r.select("directory_id", "name", "country", "region", canonical_host(F.col("website_url")).alias("host"), strict_name_key(F.col("name"), False).alias("name_key"))


def j01_products_of_entities(spark, d):
    p, e = table(spark, d, "products"), table(spark, d, "entities")
    return p.join(e.select(F.col("id").alias("entity_id"), "roaster_tier"), "entity_id").groupBy("roaster_tier").agg(F.count("*").alias("products"), F.count_distinct("entity_id").alias("firms"))


def j03_without_recent(spark, d):
    e, p = table(spark, d, "entities").select("id"), table(spark, d, "captured_pages").select(F.col("entity_id").alias("id"), "fetched_at")
    since = F.lit("2026-03-01").cast("timestamp")
    return joins.without_recent(e, p.filter("id is not null"), "id", "fetched_at", since)


def j06_unique_pairing(spark, d):
    r = _directory(spark, d).select("directory_id", "host")
    e = _entities(spark, d).filter("host is not null").select("host", F.col("id").alias("entity_id"))
    return joins.unique_partner(r, e, ["host"]).select("directory_id", "entity_id", "partners")


def j09_null_safe_adopt(spark, d):
    r = _directory(spark, d).select("directory_id", "country", "region")
    e = _entities(spark, d).select("id", F.col("country").alias("c"), F.col("region").alias("r"))
    return joins.null_safe_partner(r, e.select(F.col("id"), "c", "r"), [("country", "c"), ("region", "r")], "id").select("directory_id", "partner", "candidates", "ambiguous")


def j10_stored_matches(spark, d):
    v = table(spark, d, "product_variants")
    obs = v.filter("availability = 'in_stock'").select("id", F.unix_micros("checked_at").alias("at"))
    stored = v.select("id", F.unix_micros("checked_at").alias("checked_us"), "price_cents").distinct()
    return joins.stored_matches(obs, stored, ["id"], "at", "checked_us").groupBy("id").agg(F.count("*").alias("rows"))


def j11_match_kind(spark, d):
    return joins.match_kind(_directory(spark, d).select("directory_id", "host"), _entities(spark, d).select("id", "host"), "host", "id").select("directory_id", "kind", "matched")


def j12_identity_cascade(spark, d):
    r, e = _directory(spark, d), _entities(spark, d)
    by_host = r.join(e.select("host", F.col("id").alias("candidate")), "host").select("directory_id", "candidate")
    by_place = r.join(e.select("name_key", "country", "region", F.col("id").alias("candidate")), ["name_key", "country", "region"]).select("directory_id", "candidate")
    by_name = r.join(e.select("name_key", F.col("id").alias("candidate")), "name_key").select("directory_id", "candidate")
    return joins.cascade(r, "directory_id", [("host", by_host), ("name_and_place", by_place), ("name", by_name)])


def j13_geo_grid(spark, d):
    s = table(spark, d, "store_locations").select("store_id", "lat", "lng").filter("lat is not null and lng is not null")
    return joins.near_pairs(s, s, "store_id", "store_id", "lat", "lng", 0.05).filter("store_id_a < store_id_b")


def j16_conflicts(spark, d):
    return joins.conflicts(_directory(spark, d), _entities(spark, d), "directory_id", "host", "name_key", "id").select("directory_id", "reason")


def j21_inventory_difference(spark, d):
    p = table(spark, d, "products").select(F.col("id").alias("product_id"))
    v = table(spark, d, "product_variants").select("product_id")
    return joins.difference(p, v, ["product_id"])


def t04_multiset_equal(spark, d):
    v = table(spark, d, "product_variants").select("source", "title", "currency")
    return joins.same_multiset(v, v.distinct())


def w06_monotonic_check(spark, d):
    v = table(spark, d, "product_variants").select("source", "id", F.unix_micros("checked_at").alias("checked_us"), F.unix_micros("ingested_at").alias("ingested_us")).distinct()
    return joins.order_violations(v, ["id"], "ingested_us", "checked_us").select("id", "checked_us", "previous")


def g_group_sizes(spark, d):
    return joins.count_over(table(spark, d, "store_locations").select("store_id", "country", "city"), ["country", "city"]).select("store_id", F.coalesce("group_size", F.lit(0)).alias("group_size"))


def e2_import_actions(spark, d):
    r = table(spark, d, "roaster_directory").select(F.crc32("directory_id").alias("seq"), F.col("directory_id").alias("record_id"), "name", "website_url", "country", "region")
    return importplan.action_counts(importplan.plan(importplan.normalised(r, "directory", False), _entities(spark, d), ["country", "region"]))


QUERIES = {f.__name__: f for f in (j01_products_of_entities, j03_without_recent, j06_unique_pairing, j09_null_safe_adopt, j10_stored_matches, j11_match_kind, j12_identity_cascade, j13_geo_grid, j16_conflicts, j21_inventory_difference, t04_multiset_equal, w06_monotonic_check, e2_import_actions)}

_KEY = r"nullif(trim(regexp_replace(regexp_replace(replace(lower(name), '&', ' and '), '[\p{P}\p{S}]+', ' ', 'g'), '[\s\x{00A0}]+', ' ', 'g')), '')"
_E = f"e as (select id, country, region, {_sql_host('website_url')} as host, {_KEY} as name_key from entities)"
_R = f"r as (select directory_id, country, region, {_sql_host('website_url')} as host, {_KEY} as name_key from roaster_directory)"
_TAIL = r"nullif(regexp_extract({c}, '^[^.]+\.(.+)$', 1), '')"
SQL = {
    "j01_products_of_entities": "select roaster_tier, count(*) as products, count(distinct entity_id) as firms from products p join entities e on p.entity_id = e.id group by roaster_tier",
    "j03_without_recent": "select id from entities e where not exists (select 1 from captured_pages p where p.entity_id = e.id and (fetched_at >= timestamp '2026-03-01' or fetched_at is null))",
    "j06_unique_pairing": f"with {_E}, {_R}, k as (select host, count(*) as n, min(id) as id from e where host is not null group by host) select directory_id, case when n = 1 then id end as entity_id, coalesce(n, 0) as partners from r left join k using (host)",
    "j09_null_safe_adopt": "with k as (select country, region, count(*) as n, min(id) as id from entities group by country, region) select directory_id, k.id as partner, coalesce(n, 0) as candidates, coalesce(n, 0) > 1 as ambiguous from roaster_directory r left join k on r.country is not distinct from k.country and r.region is not distinct from k.region",
    "j10_stored_matches": "with o as (select id, max(epoch_us(checked_at)) as last_us from product_variants where availability = 'in_stock' group by id), s as (select distinct id, epoch_us(checked_at) as c, price_cents from product_variants) select s.id, count(*) as rows from s join o using (id) where c is null or c <= last_us group by s.id",
    "j11_match_kind": f"with {_E}, {_R}, k as (select host, count(*) as n, min(id) as id from e where host is not null group by host) select directory_id, case when n is null then 'create' when n = 1 then 'match' else 'ambiguous' end as kind, case when n = 1 then id end as matched from r left join k using (host)",
    "j12_identity_cascade": f"with {_E}, {_R}, c as (select directory_id, 1 as p, 'host' as rule, e.id from r join e using (host) union all select directory_id, 2, 'name_and_place', e.id from r join e on r.name_key = e.name_key and r.country = e.country and r.region = e.region union all select directory_id, 3, 'name', e.id from r join e on r.name_key = e.name_key), f as (select directory_id, p, rule, count(distinct id) as n, min(id) as id from c group by 1, 2, 3 qualify row_number() over (partition by directory_id order by p) = 1) select r.directory_id, coalesce(rule, 'none') as rule, case when n is null then 'create' when n = 1 then 'match' else 'conflict' end as kind, case when n = 1 then f.id end as matched from r left join f using (directory_id)",
    "j13_geo_grid": "select a.store_id as store_id_a, b.store_id as store_id_b from store_locations a join store_locations b on abs(a.lat - b.lat) < 0.05 and abs(a.lng - b.lng) < 0.05 and a.store_id < b.store_id",
    "j16_conflicts": f"with {_E}, {_R}, c as (select directory_id, 1 as p, 'same_host' as reason from r join e using (host) union all select directory_id, 2, 'same_name' from r join e on r.name_key = e.name_key union all select directory_id, 3, 'related_host' from r join e on r.host = {_TAIL.format(c='e.host')} or {_TAIL.format(c='r.host')} = e.host) select directory_id, arg_min(reason, p) as reason from c group by directory_id",
    "j21_inventory_difference": "select coalesce(p.id, v.product_id) as product_id, case when v.product_id is null then 'gone' else 'new' end as side from products p full join (select distinct product_id from product_variants) v on p.id = v.product_id where p.id is null or v.product_id is null",
    "t04_multiset_equal": "select (select count(*) from product_variants) - (select count(*) from (select distinct source, title, currency from product_variants)) as missing, cast(0 as bigint) as extra",
    "w06_monotonic_check": "select id, checked_us, previous from (select id, checked_us, lag(checked_us) over (partition by id order by ingested_us) as previous from (select distinct source, id, epoch_us(checked_at) as checked_us, epoch_us(ingested_at) as ingested_us from product_variants)) where checked_us < previous",
}
