"""Queries that merge observations and guard against late ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions.url import canonical_host
from tamis.operators import merge as M
from tamis.operators.select import latest, winner
from tamis.plans.urls import _sql_host
from tamis.session import table

#: The observations up to here are the stored table, those after it the batch.
CUT = "2026-03-01 00:00:00"


def _observations(spark, d):
    v = table(spark, d, "product_variants")
    return v.select("id", "price_cents", "availability", F.unix_micros("checked_at").alias("checked_us"), F.unix_micros("ingested_at").alias("ingested_us"))


def _halves(spark, d):
    v = _observations(spark, d)
    cut = F.unix_micros(F.lit(CUT).cast("timestamp"))
    stored = winner(v.filter(F.col("ingested_us") < cut).drop("ingested_us"), ["id"], [F.col("checked_us")])
    return stored, v.filter(F.col("ingested_us") >= cut).drop("ingested_us")


def u02_stale_guard(spark, d):
    v = _observations(spark, d).distinct()
    v = v.withColumn("arrival", F.struct("ingested_us", "checked_us", "price_cents", "availability"))
    return M.accepted_in_order(v, ["id"], "arrival", "checked_us").groupBy("stale").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("variants"))


def u03_merge_state(spark, d):
    stored, batch = _halves(spark, d)
    return M.merge(stored, batch, ["id"], "checked_us", ["price_cents", "availability"], ["price_cents"])[0]


def u12_merge_events(spark, d):
    stored, batch = _halves(spark, d)
    return M.merge(stored, batch, ["id"], "checked_us", ["price_cents", "availability"], ["price_cents"])[1].select("id", "change", F.col("observed_at").alias("observed_us"))


def u08_change_log(spark, d):
    v = _observations(spark, d).distinct()
    return M.change_log(v, ["id"], ["checked_us", "ingested_us", "price_cents", "availability"], ["price_cents", "availability"]).select("id", "checked_us", "price_cents", "availability")


def u10_retire_unseen(spark, d):
    p = table(spark, d, "products").select("id", F.when(F.col("is_available"), "in_stock").otherwise("unknown").alias("state"), F.unix_micros("last_seen_at").alias("seen_us"))
    seen = table(spark, d, "product_variants").filter("availability = 'in_stock'").select(F.col("product_id").alias("id"))
    return M.retire_unseen(p, seen, ["id"], "seen_us", F.unix_micros(F.lit(CUT).cast("timestamp")))


def a05_state_rollup(spark, d):
    v = latest(_observations(spark, d).join(table(spark, d, "product_variants").select("id", "product_id").distinct(), "id"), ["id", "product_id"], "checked_us", "ingested_us")
    return v.groupBy("product_id").agg(M.state_of_parts(F.coalesce("availability", F.lit("unknown"))).alias("state"))


def a06_tristate_rollup(spark, d):
    return table(spark, d, "products").groupBy("entity_id").agg(M.tristate(F.col("is_available")).alias("available"))


def u16_violations(spark, d):
    p = table(spark, d, "products")
    return M.violations(p, {"seen_in_order": F.col("first_seen_at") <= F.col("last_seen_at"), "named": F.length(F.trim("name")) > 0, "typed": F.col("product_type").isin("coffee", "merch", "equipment"), "known_reason": F.col("is_available") | F.col("availability_reason").isNotNull()})


def u17_duplicate_keys(spark, d):
    v = table(spark, d, "product_variants")
    return M.duplicate_keys(v, ["product_id", "title"], F.col("grams").isNull())


def u20_fill_nulls(spark, d):
    e = table(spark, d, "entities").select("id", "region", "roaster_tier", canonical_host(F.col("website_url")).alias("host"))
    r = table(spark, d, "roaster_directory").select(canonical_host(F.col("website_url")).alias("host"), "region", F.col("tier").alias("roaster_tier")).filter("host is not null")
    patch = r.groupBy("host").agg(F.min("region").alias("region"), F.min("roaster_tier").alias("roaster_tier"))
    return M.fill_nulls(e, patch, ["host"], ["region", "roaster_tier"])[0].select("id", "region", "roaster_tier")


QUERIES = {f.__name__: f for f in (u02_stale_guard, u03_merge_state, u12_merge_events, u08_change_log, u10_retire_unseen, a05_state_rollup, a06_tristate_rollup, u16_violations, u17_duplicate_keys, u20_fill_nulls)}

_OBS = "o as (select distinct id, price_cents, availability, epoch_us(checked_at) as checked_us, epoch_us(ingested_at) as ingested_us from product_variants)"
_BEST = "row_number() over (partition by id order by checked_us desc nulls last, {ties} desc nulls last) = 1"
_HALVES = f"""{_OBS}, cut as (select epoch_us(timestamp '{CUT}') as c),
    s as (select id, price_cents, availability, checked_us from o, cut where ingested_us < c qualify row_number() over (partition by id order by checked_us desc nulls last, price_cents desc nulls last, availability desc nulls last) = 1),
    b as (select id, price_cents, availability, checked_us from o, cut where ingested_us >= c qualify row_number() over (partition by id order by checked_us desc nulls last, price_cents desc nulls last, availability desc nulls last) = 1),
    j as (select coalesce(s.id, b.id) as id, s.id is not null as has_s, b.id is not null and not (s.id is not null and coalesce(b.checked_us < s.checked_us, false)) as take, s.price_cents as sp, s.availability as sa, s.checked_us as sc, b.price_cents as bp, b.availability as ba, b.checked_us as bc from s full join b on s.id = b.id),
    m as (select id, has_s, take, bc, sp, sa, case when take then coalesce(bp, sp) else sp end as price_cents, case when take then ba else sa end as availability, case when take then bc else sc end as checked_us from j)"""
SQL = {
    "u02_stale_guard": f"with {_OBS}, m as (select id, coalesce(checked_us < max(checked_us) over (partition by id order by ingested_us nulls first, checked_us nulls first, price_cents nulls first, availability nulls first rows between unbounded preceding and 1 preceding), false) as stale from o) select stale, count(*) as rows, count(distinct id) as variants from m group by stale",
    "u03_merge_state": f"with {_HALVES} select id, price_cents, availability, checked_us from m",
    "u12_merge_events": f"with {_HALVES} select id, case when not has_s then 'insert' else 'update' end as change, bc as observed_us from m where not has_s or (take and (price_cents is distinct from sp or availability is distinct from sa))",
    "u08_change_log": f"with {_OBS}, l as (select *, lag(price_cents) over w as pp, lag(availability) over w as pa, row_number() over w as n from o window w as (partition by id order by checked_us nulls first, ingested_us nulls first, price_cents nulls first, availability nulls first)) select id, checked_us, price_cents, availability from l where n = 1 or price_cents is distinct from pp or availability is distinct from pa",
    "u10_retire_unseen": f"with seen as (select distinct product_id from product_variants where availability = 'in_stock'), p as (select id, case when is_available then 'in_stock' else 'unknown' end as state, epoch_us(last_seen_at) as s, id not in (select product_id from seen where product_id is not null) and not coalesce(epoch_us(timestamp '{CUT}') < epoch_us(last_seen_at), false) as gone from products) select id, case when gone then 'removed' else state end as state, case when gone then epoch_us(timestamp '{CUT}') else s end as seen_us from p",
    "a05_state_rollup": f"with {_OBS}, i as (select distinct id, product_id from product_variants), l as (select id, product_id, availability from o join i using (id) qualify row_number() over (partition by id, product_id order by checked_us desc nulls last, ingested_us desc nulls last, price_cents desc nulls last, availability desc nulls last) = 1) select product_id, case when bool_or(coalesce(availability, 'unknown') = 'in_stock') then 'in_stock' when bool_and(coalesce(availability, 'unknown') = 'sold_out') then 'sold_out' else 'unknown' end as state from l group by product_id",
    "a06_tristate_rollup": "select entity_id, case when bool_or(coalesce(is_available, false)) then true when bool_and(coalesce(not is_available, false)) then false end as available from products group by entity_id",
    "u16_violations": "select 'seen_in_order' as rule, count(*) filter (not (first_seen_at <= last_seen_at)) as broken from products union all select 'named', count(*) filter (not (length(trim(name)) > 0)) from products union all select 'typed', count(*) filter (not (product_type in ('coffee', 'merch', 'equipment'))) from products union all select 'known_reason', count(*) filter (not (is_available or availability_reason is not null)) from products",
    "u17_duplicate_keys": "select product_id, title, count(*) as n from product_variants where grams is null and product_id is not null and title is not null group by 1, 2 having count(*) > 1",
    "u20_fill_nulls": f"with r as (select {_sql_host('website_url')} as host, min(region) as region, min(tier) as tier from roaster_directory group by 1) select e.id, coalesce(e.region, r.region) as region, coalesce(e.roaster_tier, r.tier) as roaster_tier from (select *, {_sql_host('website_url')} as host from entities) e left join r on e.host = r.host",
}
