"""Queries that save a catalogue: values as written, availability, identities, variants, pages, mergers of owners."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import values as V
from tamis.functions.money import _WIDE
from tamis.operators import availability as A
from tamis.operators import catalogue as C
from tamis.session import table

#: Rows up to here are what is stored, later ones what comes in.
CUT = "2026-03-01 00:00:00"


def x03_price_cents(spark, d):
    """Prices of the variants written in three ways and read again."""
    v = table(spark, d, "product_variants").select("price_cents", "currency").distinct()
    whole, rest = F.floor(F.col("price_cents") / 100).cast("bigint"), F.lpad((F.col("price_cents") % 100).cast("string"), 2, "0")
    groups = F.translate(F.format_number(whole, 0), ",", ".")
    return v.select("price_cents", "currency", V.price_cents(F.concat("currency", F.lit(" "), whole, F.lit("."), rest)).alias("plain"), V.price_cents(F.concat(groups, F.lit(","), rest, F.lit(" €"))).alias("grouped"), V.price_cents(F.concat(F.lit("from $"), whole)).alias("prose"))


def x04_weight_grams(spark, d):
    t = table(spark, d, "product_variants").select("title").distinct()
    return t.select("title", V.weight_grams(F.col("title")).alias("grams"))


def x10_tasting_notes(spark, d):
    """How often each note stands in product names, word by word."""
    p = table(spark, d, "products").select(F.explode(V.tasting_notes(F.split(F.lower("name"), " "))).alias("n"))
    return p.groupBy(F.col("n.source").alias("source"), F.col("n.canonical").alias("canonical"), F.array_join("n.categories", " ").alias("categories"), F.col("n.status").alias("status")).agg(F.count("*").alias("times"))


def x40_availability(spark, d):
    """State of every page's product by its status, heading and where it led."""
    p = table(spark, d, "captured_pages")
    heading = F.regexp_replace(F.regexp_extract(F.coalesce("html", "primary_html"), r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", "")
    native = F.lit(None).cast("array<struct<id: bigint, title: string, available: boolean>>")
    offers = F.lit(None).cast("array<struct<source_id: string, sku: string, name: string, availability: string, url: string>>")
    controls = F.lit(None).cast("array<struct<text: string, disabled: boolean>>")
    got = p.select("page_id", A.decision(F.col("status"), heading, F.col("url"), F.col("final_url"), native, offers, controls).alias("a"))
    return got.select("page_id", "a.state", "a.reason", "a.is_available")


def x40_variants(spark, d):
    """State of every product by its variants as they were last seen."""
    v = table(spark, d, "product_variants").groupBy("product_id", "id").agg(F.max(F.struct("checked_at", "ingested_at", "availability")).alias("l"))
    v = v.groupBy("product_id").agg(F.collect_set("l.availability").alias("states"))
    return v.select("product_id", A.state_of(F.col("states")).alias("state"), A.is_available(A.state_of(F.col("states"))).alias("is_available"))


def u01_identity(spark, d):
    p = table(spark, d, "products")
    key = F.concat_ws("/", "entity_id", "slug")
    stored = p.select("id", "entity_id", F.when(F.col("description_raw").isNotNull(), key).alias("source_key"), "source_url")
    incoming = p.select("id", F.when(F.col("is_available").isNotNull(), F.col("entity_id")).otherwise("someone else").alias("entity_id"), key.alias("source_key"), F.when(F.col("is_active"), F.col("source_url")).otherwise(F.concat("source_url", F.lit("?x=1"))).alias("source_url"))
    return C.resolve_identity(incoming, stored).select("id", "product_id", "how", "problem")


def u05_projection(spark, d):
    v = table(spark, d, "product_variants").groupBy("id").agg(F.max(F.struct("checked_at", "availability")).alias("l"), F.min("checked_at").alias("before"))
    flag, seen = C.seen_at(F.col("l.availability"), F.col("l.checked_at"), F.col("before"))
    return v.select("id", flag.alias("is_available"), F.unix_micros(seen).alias("last_seen_us"))


def u06_adopt_variants(spark, d):
    v = table(spark, d, "product_variants")
    key = F.col("merchant_variant_id").cast("string")
    stored = v.groupBy("id", "product_id").agg(F.min("title").alias("variant_name"), F.max("weight_g").alias("weight_g"), F.max(F.when(F.col("grams").isNotNull(), key)).alias("source_key"))
    incoming = v.groupBy("product_id", key.alias("source_key")).agg(F.min("title").alias("variant_name"), F.max("weight_g").alias("weight_g"))
    return C.adopt_variants(incoming, stored).select("product_id", "source_key", "variant_id", "how", "problem")


def _stock(spark, d):
    v = table(spark, d, "product_variants").select("product_id", F.col("merchant_variant_id").alias("merchant_id"), F.col("availability").alias("state"), "checked_at", "ingested_at")
    cut = F.lit(CUT).cast("timestamp")
    stored = v.filter(F.col("ingested_at") < cut).groupBy("product_id", "merchant_id").agg(F.max(F.struct("checked_at", "state")).alias("l")).select("product_id", "merchant_id", "l.state", "l.checked_at")
    gone = table(spark, d, "products").filter("not is_active").select(F.col("id").alias("product_id"), F.lit(None).cast("bigint").alias("merchant_id"), F.lit("removed").alias("state"), F.col("last_seen_at").alias("checked_at"))
    checks = v.filter(F.col("ingested_at") >= cut).select("product_id", "merchant_id", "state", "checked_at").unionByName(gone)
    return stored, checks, table(spark, d, "products").filter("description_raw is not null").select(F.col("id").alias("product_id"))


def u13_refresh_events(spark, d):
    events = C.refresh_stock(*_stock(spark, d))[1]
    return events.select("product_id", "changed", F.unix_micros("observed_at").alias("observed_us"))


def u14_unknown_products(spark, d):
    return C.refresh_stock(*_stock(spark, d))[2].groupBy("product_id").agg(F.count("*").alias("checks"))


def s12_known_pages(spark, d):
    p = table(spark, d, "captured_pages")
    cut = F.lit(CUT).cast("timestamp")
    known = p.filter(F.col("fetched_at") < cut).groupBy("entity_id", "url").agg(F.lit("classified").alias("status"), F.count("*").cast("int").alias("times_seen"), F.min("fetched_at").alias("first_seen_at"), F.max("fetched_at").alias("last_seen_at"))
    out = C.see_pages(known, p.filter(F.col("fetched_at") >= cut), ["entity_id", "url"], "fetched_at")
    return out.select("entity_id", "url", "status", "times_seen", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("last_seen_at").alias("last_us"))


def s13_skipped_pages(spark, d):
    p = table(spark, d, "captured_pages")
    known = p.groupBy("entity_id", "url").agg(F.lit("new").alias("status"), F.lit(1).alias("times_seen"), F.min("fetched_at").alias("first_seen_at"), F.max("fetched_at").alias("last_seen_at"))
    return C.see_pages(known, p.filter("status >= 400"), ["entity_id", "url"], "fetched_at", "skip").groupBy("status").agg(F.count("*").alias("pages"), F.sum("times_seen").alias("times_seen"))


def a15_merged_pages(spark, d):
    p = table(spark, d, "captured_pages").select("entity_id", "url", "page_id", "status", F.lit(1).alias("times_seen"), "fetched_at", F.when(F.col("status") == 200, F.col("fetched_at")).alias("classified_at"), F.col("fetched_at").alias("first_seen_at"))
    m = C.merge_pages(p, ["entity_id", "url"], "classified_at", "fetched_at", "first_seen_at", "times_seen", "page_id", ["status"])
    return m.select("entity_id", "url", "page_id", "status", "times_seen", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("fetched_at").alias("last_us"), F.size("merged_ids").alias("merged"))


def w03_primary_location(spark, d):
    return C.primary_location(table(spark, d, "store_locations").filter("entity_id is not null"), "entity_id", F.col("region").isNotNull(), "is_primary", "store_id")


def j19_carried_media(spark, d):
    p = table(spark, d, "products")
    media = table(spark, d, "product_variants").filter("weight_g is not null").groupBy("product_id", F.col("title").alias("media_asset_id")).agg(F.min("price_cents").alias("sort_order"))
    first = p.groupBy("entity_id", "product_type").agg(F.min("id").alias("winner_id"))
    aliases = p.join(first, ["entity_id", "product_type"]).filter("id <> winner_id").select(F.col("id").alias("alias_id"), "winner_id")
    return C.carried_media(media, aliases)


def t03_not_preserved(spark, d):
    p = table(spark, d, "products")
    return C.not_preserved(p, p.filter("is_active"), ["product_type", "source"])


def a13_contacts(spark, d):
    r = table(spark, d, "roaster_directory").withColumn("name_key", F.lower("name"))
    m = C.merge_contacts(r, ["name_key"], "directory_id", ["website_url", "region"], ["aliases"])
    return m.select("name_key", "website_url", "region", F.array_join("aliases", "|").alias("aliases"))


def t01_union(spark, d):
    p = table(spark, d, "captured_pages")
    parts = [p.select(F.col(c).alias("url"), F.col("page_id").alias("seq")) for c in ("url", "final_url")]
    return C.union_first_wins(parts, ["url"], "seq").select("url", "seq", "origin")


def j07_market(spark, d):
    v = table(spark, d, "product_variants")
    prices = v.groupBy("product_id").agg(F.max("price_cents").alias("minor_units"))
    market = v.select("product_id", F.col("price_cents").alias("minor_units"), "currency")
    return C.agreeing_market(prices, market, ["product_id"])


def a04_outcomes(spark, d):
    s = F.col("status")
    kind = F.when(s.between(200, 299), "visited").when(s.isin(404, 410), "gone").when(s.isin(403, 429), "deferred").when(s >= 500, "failed")
    return C.outcomes(table(spark, d, "captured_pages"), ["entity_id"], kind, ["visited", "gone", "deferred", "failed"])


def a07_phases(spark, d):
    e = table(spark, d, "entities").join(table(spark, d, "captured_pages").groupBy(F.col("entity_id").alias("id")).agg(F.max("status").alias("worst")), "id", "left")
    kind = F.when(F.col("worst") < 300, "successful").when(F.col("worst") >= 300, "failed")
    return C.outcomes(e, ["roaster_tier"], kind, ["successful", "failed"])


def o02_seeded_order(spark, d):
    return C.seeded_order(table(spark, d, "entities").select("id"), ["id"], 7)


_QUERIES = (
    x03_price_cents, x04_weight_grams, x10_tasting_notes, x40_availability, x40_variants, u01_identity, u05_projection, u06_adopt_variants, u13_refresh_events, u14_unknown_products, s12_known_pages,
    s13_skipped_pages, a15_merged_pages, w03_primary_location, j19_carried_media, t03_not_preserved, a13_contacts, t01_union, j07_market, a04_outcomes, a07_phases, o02_seeded_order,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_UNITS = V._UNIT
_FACTORS = " ".join(f"when '{w}' then {k!r}::decimal(13,9)" for k, ws in V.GRAMS.items() for w in ws.split())
_NOTE_ROWS = ", ".join(f"('{n.replace('_', ' ')}', '{k}')" for k, ns in V.NOTES.items() for n in ns.split())
_SAME_ROWS = ", ".join(f"('{a}', '{b}')" for a, b in V.SAME_NOTE.items())
_STORED = f"(select product_id, merchant_variant_id as merchant_id, max(checked_at) as checked_at, arg_max(availability, (checked_at, availability)) as state from product_variants where ingested_at < timestamptz '{CUT}+00' group by 1, 2)"
_CHECKS = f"(select product_id, merchant_variant_id as merchant_id, availability as state, checked_at from product_variants where ingested_at >= timestamptz '{CUT}+00' union all select id, null, 'removed', last_seen_at from products where not is_active)"

SQL = {
    "x03_price_cents": "select distinct price_cents, currency, case when currency is not null then price_cents::bigint end as plain, price_cents::bigint as grouped, null::bigint as prose from product_variants",
    "x04_weight_grams": rf"""with t as (select distinct title, lower(translate(title, '{_WIDE[0]}', '{_WIDE[1]}')) as t from product_variants),
        m as (select *, regexp_extract_all(regexp_replace(t, '([^a-z0-9_.,])', '\1\1', 'g'), '(?:^|[^0-9.,a-z_])([0-9]+(?:[.,][0-9]{{1,3}})?)\s*(?:{_UNITS})(?:[^a-z0-9_]|$)', 1) as f,
              regexp_extract_all(regexp_replace(t, '([^a-z0-9_.,])', '\1\1', 'g'), '(?:^|[^0-9.,a-z_])(?:[0-9]+(?:[.,][0-9]{{1,3}})?)\s*({_UNITS})(?:[^a-z0-9_]|$)', 1) as u from t),
        g as (select title, case when len(f) = 1 and not regexp_matches(f[1], '[.,][0-9]{{3}}$') and not regexp_matches(t, '[0-9]\s*[x×]\s*[0-9]|[x×]\s*[0-9]|[0-9]\s*(bags?|packs?|packets?)\b|[-–—−]')
              then floor(try_cast(replace(f[1], ',', '.') as decimal(18,3)) * (case u[1] {_FACTORS} end) + 0.5)::bigint end as grams from m)
        select title, case when grams between 1 and 2147483647 then grams end as grams from g""",
    "x10_tasting_notes": rf"""with w as (select unnest(string_split(lower(name), ' ')) as w from products), k as (select w, trim(w) as source, coalesce(s.b, regexp_replace(trim(w), '\s+', ' ', 'g')) as name from w left join (values {_SAME_ROWS}) s(a, b) on s.a = trim(w)),
        n as (select source, regexp_matches(w, '(?i)\?|maybe|hint of|reminiscent|like\b') as doubt, name, f.kind from k left join (values {_NOTE_ROWS}) f(note, kind) on f.note = k.name)
        select source, case when not doubt and kind is not null then name end as canonical, case when not doubt and kind is not null then kind else '' end as categories, case when doubt then 'uncertain' when kind is not null then 'mapped' else 'unmapped' end as status, count(*) as times from n group by all""",
    "x40_availability": r"""with p as (select page_id, status, trim(regexp_replace(regexp_extract(coalesce(html, primary_html), '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')) as h, lower(regexp_extract(url, '^[^:]+://([^/?#:]+)', 1)) as h1, lower(regexp_extract(final_url, '^[^:]+://([^/?#:]+)', 1)) as h2,
            regexp_extract(url, '^[^:]+://[^/?#]+([^?#]*)', 1) as p1, regexp_extract(final_url, '^[^:]+://[^/?#]+([^?#]*)', 1) as p2 from captured_pages),
        r as (select page_id, case when status in (404, 410) then 'product_http_removed' when status <> 200 then 'incomplete_fetch' when status = 200 and regexp_matches(h, '(?i)^(page not found|404(\s*[-–:]?\s*not found)?|product not found)$') then 'product_soft_404'
              when h1 = h2 and regexp_matches(p1, '(?i)/products?/') and not regexp_matches(p2, '(?i)/products?/') then 'product_redirected_away' else 'product_stock_evidence_missing' end as reason from p)
        select page_id, case when reason in ('product_http_removed', 'product_soft_404', 'product_redirected_away') then 'removed' else 'unknown' end as state, reason, case when reason in ('product_http_removed', 'product_soft_404', 'product_redirected_away') then false end as is_available from r""",
    "x40_variants": """with l as (select product_id, id, arg_max(availability, (checked_at, ingested_at, availability)) as s from product_variants group by 1, 2), p as (select product_id, bool_or(s = 'in_stock') as any_in, bool_and(s = 'sold_out') as all_out from l group by 1)
        select product_id, case when any_in then 'in_stock' when all_out then 'sold_out' else 'unknown' end as state, case when any_in then true when all_out then false end as is_available from p""",
    "u01_identity": """with s as (select id, entity_id, case when description_raw is not null then concat_ws('/', entity_id, slug) end as source_key, source_url from products),
        i as (select id, case when is_available is not null then entity_id else 'someone else' end as entity_id, concat_ws('/', entity_id, slug) as source_key, case when is_active then source_url else source_url || '?x=1' end as source_url from products),
        j as (select i.*, k.key_id, k.n, o.id as of_id, o.entity_id as of_owner, o.source_key as of_key, o.source_url as of_url from i left join (select entity_id, source_key, min(id) as key_id, count(*) as n from s where source_key is not null group by 1, 2) k using (entity_id, source_key) left join s o on o.id = i.id),
        p as (select *, case when key_id is not null then case when n > 1 then 'several' end when id is not null and of_id is null then 'missing' when of_owner is distinct from entity_id then 'other_owner' when of_key is not null and of_key <> source_key then 'other_key' when of_key is null and of_url is distinct from source_url then 'other_url' end as problem from j)
        select id, case when problem is null then coalesce(key_id, id) end as product_id, case when problem is null then case when key_id is not null then 'key' else 'adopted' end end as how, problem from p""",
    "u05_projection": "with l as (select id, max(checked_at) as t, arg_max(availability, (checked_at, availability)) as s, min(checked_at) as b from product_variants group by 1) select id, case when s = 'in_stock' then true when s in ('sold_out', 'removed') then false end as is_available, epoch_us(case when s = 'in_stock' then t else b end) as last_seen_us from l",
    "u06_adopt_variants": """with s as (select id, product_id, min(title) as vn, max(weight_g) as w, max(case when grams is not null then merchant_variant_id::varchar end) as k from product_variants group by 1, 2),
        i as (select product_id, merchant_variant_id::varchar as source_key, min(title) as vn, max(weight_g) as w from product_variants group by 1, 2),
        j as (select i.*, (select min(id) from s where s.product_id = i.product_id and s.k = i.source_key) as kid, l.lid, l.n from i left join (select product_id, vn, w, min(id) as lid, count(*) as n from s where k is null group by 1, 2, 3) l on l.product_id = i.product_id and l.vn is not distinct from i.vn and l.w is not distinct from i.w)
        select product_id, source_key, case when kid is null and n > 1 then null else coalesce(kid, lid) end as variant_id, case when kid is not null then 'key' when n > 1 then null when lid is not null then 'adopted' else 'new' end as how, case when kid is null and n > 1 then 'several' end as problem from j""",
    "u13_refresh_events": f"""with k as (select c.* from {_CHECKS} c where product_id in (select id from products where description_raw is not null)),
        own as (select product_id, merchant_id, max(checked_at) as t, arg_max(state, (checked_at, state)) as s from k where merchant_id is not null group by 1, 2), gone as (select product_id, max(checked_at) as t from k where merchant_id is null group by 1),
        j as (select v.*, case when own.t >= v.checked_at then own.t end as ot, own.s as os, case when gone.t >= v.checked_at then gone.t end as gt from {_STORED} v left join own using (product_id, merchant_id) left join gone using (product_id)),
        n as (select product_id, state, case when ot is null and gt is null then state when gt is null or ot > gt or (ot = gt and os > 'removed') then os else 'removed' end as now, coalesce(greatest(ot, gt), checked_at) as t from j)
        select product_id, count(*) as changed, epoch_us(max(t)) as observed_us from n where now is distinct from state group by 1""",
    "u14_unknown_products": f"select product_id, count(*) as checks from {_CHECKS} c where product_id not in (select id from products where description_raw is not null) group by 1",
    "s12_known_pages": f"""with p as (select entity_id, url, fetched_at, fetched_at < timestamptz '{CUT}+00' as old from captured_pages)
        select entity_id, url, case when bool_or(old) then 'classified' else 'new' end as status, (count(*) filter (old) + max(case when old then 0 else 1 end))::int as times_seen, epoch_us(min(fetched_at)) as first_us, epoch_us(max(fetched_at)) as last_us from p group by 1, 2""",
    "s13_skipped_pages": "with p as (select entity_id, url, bool_or(coalesce(status >= 400, false)) as bad from captured_pages group by 1, 2) select case when bad then 'skip' else 'new' end as status, count(*) as pages, sum(case when bad then 2 else 1 end)::bigint as times_seen from p group by 1",
    "a15_merged_pages": """with p as (select *, row_number() over (partition by entity_id, url order by case when status = 200 then fetched_at end desc nulls last, fetched_at desc nulls last, page_id) as r from captured_pages)
        select entity_id, url, max(page_id) filter (r = 1) as page_id, max(status) filter (r = 1) as status, count(*) as times_seen, epoch_us(min(fetched_at)) as first_us, epoch_us(max(fetched_at)) as last_us, (count(distinct page_id) - 1)::int as merged from p group by 1, 2""",
    "w03_primary_location": "select entity_id, store_id from (select *, row_number() over (partition by entity_id order by (lat is not null and lng is not null) desc, (region is not null) desc, coalesce(is_primary, false) desc, store_id) as r from store_locations where entity_id is not null) where r = 1",
    "j19_carried_media": """with m as (select product_id, title as a, min(price_cents) as o from product_variants where weight_g is not null group by 1, 2), f as (select entity_id, product_type, min(id) as w from products group by 1, 2), al as (select p.id as alias_id, f.w as winner_id from products p join f on f.entity_id = p.entity_id and f.product_type = p.product_type where p.id <> f.w)
        select winner_id as product_id, a as media_asset_id, min(o) as sort_order from al join m on m.product_id = al.alias_id where winner_id not in (select product_id from m where product_id is not null) group by 1, 2""",
    "t03_not_preserved": "select product_type, source from products except all select product_type, source from products where is_active",
    "a13_contacts": """select lower(name) as name_key, arg_min(nullif(trim(website_url), ''), directory_id) filter (nullif(trim(website_url), '') is not null) as website_url, arg_min(nullif(trim(region), ''), directory_id) filter (nullif(trim(region), '') is not null) as region,
        coalesce(array_to_string(list_sort(list_distinct(flatten(list(coalesce(aliases, []::varchar[]))))), '|'), '') as aliases from roaster_directory group by 1""",
    "t01_union": "select url, seq, origin::int as origin from (select *, row_number() over (partition by url order by origin, seq) as r from (select url, page_id as seq, 0 as origin from captured_pages union all select final_url, page_id, 1 from captured_pages)) where r = 1",
    "j07_market": "with p as (select product_id, max(price_cents) as minor_units from product_variants group by 1) select p.product_id, p.minor_units, (select case when min(currency) = max(currency) then min(currency) end from product_variants v where v.product_id = p.product_id and v.price_cents = p.minor_units) as market_currency from p",
    "a04_outcomes": "select entity_id, count(*) as total, count(*) filter (status between 200 and 299) as visited, count(*) filter (status in (404, 410)) as gone, count(*) filter (status in (403, 429)) as deferred, count(*) filter (status >= 500) as failed, count(*) filter (not coalesce(status between 200 and 299 or status in (404, 410, 403, 429) or status >= 500, false)) as other from captured_pages group by 1",
    "a07_phases": "with w as (select entity_id as id, max(status) as worst from captured_pages group by 1) select roaster_tier, count(*) as total, count(*) filter (worst < 300) as successful, count(*) filter (worst >= 300) as failed, count(*) filter (worst is null) as other from entities left join w using (id) group by 1",
    "o02_seeded_order": "select id, md5('7|' || coalesce(id, '')) as place from entities",
}
