"""Queries that pick, rank and number rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions.text import slug
from tamis.operators import select
from tamis.session import table

PLATFORMS = ["shopify", "woocommerce", "square", "squarespace", "native"]


def w01_winner(spark, d):
    v = table(spark, d, "product_variants").select("product_id", "id", "price_cents", F.unix_micros("checked_at").alias("checked_us"))
    w = select.winner(v, ["product_id"], [F.col("price_cents").isNotNull(), F.col("checked_us")])
    return w.select("product_id", F.col("checked_us"), F.col("price_cents").isNotNull().alias("priced"))


def w02_top3(spark, d):
    c = table(spark, d, "customer")
    return select.top_per_group(c.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3)


def a20_latest_observation(spark, d):
    v = table(spark, d, "product_variants").select("id", F.unix_micros("checked_at").alias("checked_us"), F.unix_micros("ingested_at").alias("ingested_us"), "price_cents", "availability")
    return select.latest(v, ["id"], "checked_us", "ingested_us").distinct()


def a20_latest_status(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    return select.latest(e, ["user_id"], "ts", "event_id").groupBy("event_type").agg(F.count("*").alias("users"))


def a12_mode_name(spark, d):
    return select.mode_value(table(spark, d, "products"), ["source"], "product_type")


def a11_first_non_null(spark, d):
    return select.first_non_null(table(spark, d, "documents"), ["source"], "doc_id", ["title", "lang", "url"])


def w04_slug_suffix(spark, d):
    p = table(spark, d, "products").select("id", slug(F.col("name"), 80, "item").alias("base"))
    return select.numbered_slugs(p, "base", "id").select("id", "allocated")


def w05_positions(spark, d):
    """Positions of variants that came in late, after those that were there."""
    v = table(spark, d, "product_variants").groupBy("product_id", "id").agg(F.min("ingested_at").alias("since"))
    cut = F.lit("2026-03-01 00:00:00").cast("timestamp")
    old = v.filter(F.col("since") < cut).groupBy("product_id").agg(F.count("*").alias("n")).select("product_id", (F.col("n") - 1).alias("position"))
    return select.next_positions(old, v.filter(F.col("since") >= cut), ["product_id"], "position", "id").select("product_id", "id", "position")


def w08_backoff(spark, d):
    n = table(spark, d, "lineitem").select(F.col("l_linenumber").alias("attempt")).distinct()
    return select.backoff_schedule(n, "attempt", 250, 2.0, 4000)


def o01_rank_order(spark, d):
    f = table(spark, d, "feeds").groupBy("platform").agg(F.count("*").alias("feeds"))
    return f.select("platform", "feeds", select.rank_order(F.col("platform"), PLATFORMS).alias("place"))


def o03_latest_pages(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", F.unix_micros("fetched_at").alias("fetched_us"))
    return p.orderBy(F.desc("fetched_us"), F.desc("page_id")).limit(100)


QUERIES = {f.__name__: f for f in (w01_winner, w02_top3, a20_latest_observation, a20_latest_status, a12_mode_name, a11_first_non_null, w04_slug_suffix, w08_backoff, w05_positions, o01_rank_order, o03_latest_pages)}

_SLUG = "coalesce(nullif(left(regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), ''), 'item')"
SQL = {
    "w01_winner": "select product_id, checked_us, priced from (select product_id, epoch_us(checked_at) as checked_us, price_cents is not null as priced, row_number() over (partition by product_id order by price_cents is not null desc, epoch_us(checked_at) desc nulls last) as rn from product_variants) where rn = 1",
    "w02_top3": "select c_nationkey, c_custkey, c_acctbal from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as rn from customer) where rn <= 3",
    "a20_latest_observation": "select distinct id, epoch_us(checked_at) as checked_us, epoch_us(ingested_at) as ingested_us, price_cents, availability from (select *, row_number() over (partition by id order by epoch_us(checked_at) desc nulls last, epoch_us(ingested_at) desc nulls last, price_cents desc nulls last, availability desc nulls last) as rn from product_variants) where rn = 1",
    "a20_latest_status": "select event_type, count(*) as users from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1 group by event_type",
    "a12_mode_name": "select source, product_type, n from (select source, product_type, count(*) as n, row_number() over (partition by source order by count(*) desc, length(product_type), product_type) as rn from products where product_type is not null group by source, product_type) where rn = 1",
    "a11_first_non_null": "select source, arg_min(title, doc_id) filter (title is not null) as title, arg_min(lang, doc_id) filter (lang is not null) as lang, arg_min(url, doc_id) filter (url is not null) as url from documents group by source",
    "w04_slug_suffix": f"select id, case when n = 1 then base else left(base, 80 - length('-' || n)) || '-' || n end as allocated from (select id, base, row_number() over (partition by lower(base) order by id) as n from (select id, {_SLUG} as base from products))",
    "w08_backoff": "with a as (select distinct l_linenumber as attempt from lineitem) select attempt, cast(least(4000, 250 * pow(2, attempt - 1)) as bigint) as wait_ms, (select cast(sum(least(4000, 250 * pow(2, i - 1))) as bigint) from unnest(range(1, attempt + 1)) t(i)) as due_ms from a",
    "o01_rank_order": "select platform, count(*) as feeds, coalesce(nullif(list_position(['shopify', 'woocommerce', 'square', 'squarespace', 'native'], platform), 0), 6) as place from feeds group by platform",
    "o03_latest_pages": "select page_id, epoch_us(fetched_at) as fetched_us from captured_pages order by fetched_at desc, page_id desc limit 100",
    "w05_positions": "with v as (select product_id, id, min(ingested_at) >= timestamptz '2026-03-01 00:00:00+00' as late from product_variants group by 1, 2), o as (select product_id, count(*) as n from v where not late group by 1) select product_id, id, coalesce(n, 0) - 1 + row_number() over (partition by product_id order by id) as position from v left join o using (product_id) where late",
}
