"""Queries that count and compare whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import keys
from tamis.functions.text import present
from tamis.operators import audit, graph
from tamis.session import table


def a08_audit_counters(spark, d):
    t = table(spark, d, "documents")
    return audit.counters(t, {"no_label": ~present(F.col("lang")), "no_text": F.length(F.trim(F.coalesce("text", F.lit("")))) == 0, "short_text": F.length("text") < 60, "stale_length": F.length("text") != F.col("n_chars"), "titled": F.col("title").isNotNull()}, {"sources": F.col("source"), "kinds": F.col("kind")})


def a09_source_summary(spark, d):
    v = table(spark, d, "product_variants")
    return audit.counters(v, {"with_grams": F.col("grams") > 0, "with_weight": F.col("weight") > 0, "with_unit": present(F.col("weight_unit")), "priced": F.col("price_cents").isNotNull()}, {"variants": F.col("id"), "currencies": F.col("currency")}, ["source"])


def a10_completeness(spark, d):
    n = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    total = n.groupBy("l_orderkey").agg(F.count("*").alias("total"))
    return audit.pages_complete(n.join(total, "l_orderkey"), ["l_orderkey"], "l_linenumber", "l_partkey", "total")


def a02_usage_rollup(spark, d):
    e = table(spark, d, "events").select("user_id", F.lit(1).cast("bigint").alias("calls"), (F.col("event_type") == "error").cast("bigint").alias("errors"), F.when(F.col("event_type") == "view", 1).cast("bigint").alias("views"))
    return audit.usage(e, ["user_id"], ["calls", "errors"], "errors", "views")


def a23_percentiles(spark, d):
    q = audit.quantiles(table(spark, d, "events"), ["event_type"], "value", {"median": 0.5, "p95": 0.95})
    return q.select("event_type", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"))


def a17_duplicate_sources(spark, d):
    p = table(spark, d, "products")
    return p.filter("source_url is not null").groupBy("entity_id", "source_url").agg(F.count("*").alias("n")).filter("n > 1")


def a18_table_fingerprint(spark, d):
    return keys.ordered_fingerprint(table(spark, d, "nation"), "n_nationkey", "n_nationkey", "n_name", "n_regionkey")


def a19_multiset_fingerprint(spark, d):
    return keys.multiset_fingerprint(table(spark, d, "feeds"), "source", "platform", "country", "currency", "export_note")


def a22_token_cost(spark, d):
    n = table(spark, d, "products").agg(F.count("*").alias("items"))
    return n.select("items", audit.token_cost(F.col("items"), 1300.0, 500.0, 0.25, 2.0).alias("usd"))


def g03_components(spark, d):
    v = table(spark, d, "products").filter("source_url is not null")
    edges = v.select(F.concat(F.lit("p"), "id").alias("a"), F.concat(F.lit("u"), "source_url").alias("b")).union(v.select(F.concat(F.lit("p"), "id"), F.concat(F.lit("s"), "entity_id", F.lit("/"), "slug")))
    return graph.components(edges).filter("node like 'p%'")


def g04_roots(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.floor(F.col("c_custkey") / 2).cast("bigint").alias("parent")).filter("parent >= 1 and node > 1")
    return graph.roots(c)


def g01_reach(spark, d):
    p = table(spark, d, "captured_pages").filter("html is not null")
    host, path = F.regexp_extract("final_url", "^[^:]+://([^/?#]+)", 1), F.regexp_extract("final_url", "^[^:]+://[^/?#]+([^?#]*)", 1)
    src = F.concat(host, path)
    e = p.select(src.alias("src"), host.alias("h"), F.explode(F.regexp_extract_all("html", F.lit('<a href="(/[^"#?]*)"'))).alias("href")).select("src", F.concat("h", "href").alias("dst"))
    home = e.filter("dst like '%/home'").select(F.col("dst").alias("node"))
    return graph.reach(e.union(e.select("dst", "src")), home, depth=2).groupBy("depth").agg(F.count("*").alias("nodes"))


def g07_integrity(spark, d):
    p, v = table(spark, d, "products"), table(spark, d, "product_variants")
    return graph.integrity(p, v, "id", "product_id")


QUERIES = {f.__name__: f for f in (a08_audit_counters, a09_source_summary, a10_completeness, a02_usage_rollup, a23_percentiles, a17_duplicate_sources, a18_table_fingerprint, a19_multiset_fingerprint, a22_token_cost, g03_components, g04_roots, g01_reach, g07_integrity)}

_PRESENT = "coalesce(lower(trim({c})) not in ('', 'null', 'unknown', 'n/a'), false)"
SQL = {
    "a08_audit_counters": f"select count(*) as rows, count(*) filter (not {_PRESENT.format(c='lang')}) as no_label, count(*) filter (length(trim(coalesce(text, ''), ' ')) = 0) as no_text, count(*) filter (length(text) < 60) as short_text, count(*) filter (length(text) <> n_chars) as stale_length, count(*) filter (title is not null) as titled, count(distinct source) as sources, count(distinct kind) as kinds from documents",
    "a09_source_summary": f"select source, count(*) as rows, count(*) filter (grams > 0) as with_grams, count(*) filter (weight > 0) as with_weight, count(*) filter ({_PRESENT.format(c='weight_unit')}) as with_unit, count(*) filter (price_cents is not null) as priced, count(distinct id) as variants, count(distinct currency) as currencies from product_variants group by source",
    "a10_completeness": "select l_orderkey, count(distinct l_partkey) as items, count(distinct l_linenumber) as pages, coalesce(count(distinct l_partkey) = count(*) and min(l_linenumber) = 1 and max(l_linenumber) = count(distinct l_linenumber), false) as complete from lineitem group by l_orderkey",
    "a02_usage_rollup": "select user_id, count(*) as calls, count(*) filter (event_type = 'error') as errors, greatest(0, count(*) filter (event_type = 'error') - count(*) filter (event_type = 'view')) as unreported from events group by user_id",
    "a23_percentiles": "select event_type, round(quantile_cont(value, 0.5), 6) as median, round(quantile_cont(value, 0.95), 6) as p95 from events group by event_type",
    "a17_duplicate_sources": "select entity_id, source_url, count(*) as n from products where source_url is not null group by 1, 2 having count(*) > 1",
    "a18_table_fingerprint": "select count(*) as rows, sha256(string_agg(h, chr(10) order by n_nationkey)) as fingerprint from (select n_nationkey, sha256(cast(to_json([n_nationkey::varchar, n_name, n_regionkey::varchar]) as varchar)) as h from nation)",
    "a22_token_cost": "select count(*) as items, round(count(*) * (1300.0 * 0.25 + 500.0 * 2.0) / 1e6 * 1.25, 4) as usd from products",
    "g03_components": """with recursive v as (select 'p' || id as p, 'u' || source_url as u, 's' || entity_id || '/' || slug as s from products where source_url is not null),
        e as (select p as a, u as b from v union select p, s from v), b as (select a, b from e union select b, a from e),
        r(node, seen) as (select a, a from b union select r.node, b.b from r join b on r.seen = b.a)
        select node, min(seen) as component from r where node like 'p%' group by node""",
    "g04_roots": "select c_custkey as node, cast(1 as bigint) as root, cast(floor(log2(c_custkey)) as bigint) as steps, false as cyclic from customer where c_custkey > 1",
    "g01_reach": """with e as (select regexp_extract(final_url, '^[^:]+://([^/?#]+)', 1) as h, regexp_extract(final_url, '^[^:]+://[^/?#]+([^?#]*)', 1) as p, unnest(regexp_extract_all(html, '<a href="(/[^"#?]*)"', 1)) as href from captured_pages where html is not null),
        x as (select distinct h || p as src, h || href as dst from e), b as (select src, dst from x union select dst, src from x),
        l0 as (select distinct dst as node from x where dst like '%/home'), l1 as (select distinct b.dst as node from l0 join b on b.src = l0.node where b.dst not in (select node from l0)),
        l2 as (select distinct b.dst as node from l1 join b on b.src = l1.node where b.dst not in (select node from l0) and b.dst not in (select node from l1))
        select * from (select 0 as depth, count(*) as nodes from l0 union all select 1, count(*) from l1 union all select 2, count(*) from l2) where nodes > 0""",
    "g07_integrity": "select 'duplicate_key' as check, count(*) as broken from (select id from products where id is not null group by id having count(*) > 1) union all select 'orphan', count(*) from product_variants where product_id is not null and product_id not in (select id from products where id is not null)",
    "a19_multiset_fingerprint": "with r as (select sha256(cast(to_json([source, platform, country, currency, export_note]) as varchar)) as h from feeds) select count(*) as rows, sha256(concat_ws(',', " + ", ".join(f"sum(cast('0x' || substring(h, {1 + 8 * i}, 8) as bigint))::varchar" for i in range(8)) + ")) as fingerprint from r",
}
