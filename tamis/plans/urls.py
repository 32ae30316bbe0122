"""Queries on the URLs of pages, firms and directory records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import url as U
from tamis.operators import audit, joins, select
from tamis.session import table

TERMS = ["/cart", "gift", "ref=", "subscription", "decaf", "costa-rica"]

_HOST = r"(?i)^\s*https?://(?:[^/?#@\s]*@)?([^/?#:\s]+)(?::[0-9]+)?[^?#]*(?:\?[^#]*)?(?:#.*)?\s*$"


def _sql_host(col: str) -> str:
    """SQL of canonical_host."""
    return f"nullif(regexp_replace(lower(regexp_extract({col}, '{_HOST}', 1)), '\\.$|^www\\.', '', 'g'), '')"


_PATH = r"regexp_extract({c}, '^[^:]+://[^/?#]+([^?#]*)', 1)"


def _sql_canonical(c: str) -> str:
    path = f"regexp_replace({_PATH.format(c=c)}, '/+$', '')"
    given = f"list_filter(string_split(regexp_extract({c}, '\\?([^#]*)', 1), '&'), lambda x: x <> '' and not regexp_matches(lower(split_part(x, '=', 1)), '^(utm_.*|fbclid|gclid|ref)$'))"
    query = f"array_to_string(list_sort({given}), '&')"
    return f"case when {_sql_host(c)} is not null then lower(regexp_extract({c}, '^\\s*([A-Za-z]+)', 1)) || '://' || {_sql_host(c)} || case when {path} = '' then '/' else {path} end || case when coalesce({query}, '') <> '' then '?' || {query} else '' end end"


def x12_normalize_url(spark, d):
    p = table(spark, d, "captured_pages")
    return p.select("page_id", U.normalise(F.col("final_url")).alias("norm_url"))


def x11_canonical_url(spark, d):
    return table(spark, d, "captured_pages").select("page_id", U.canonical(F.col("final_url")).alias("canonical_url"))


def x15_canonical_host(spark, d):
    return table(spark, d, "roaster_directory").select("directory_id", U.canonical_host(F.col("website_url")).alias("host"))


def x14_url_variants(spark, d):
    e = table(spark, d, "entities")
    return e.select("id", F.explode(U.variants(F.col("website_url"))).alias("variant"))


def f01_blacklist_first_match(spark, d):
    p = table(spark, d, "captured_pages")
    return p.select("page_id", select.first_term(U.after_host(F.col("final_url")), TERMS).alias("matched_term"))


def f17_shared_site_kind(spark, d):
    e = table(spark, d, "roaster_directory")
    return e.select("directory_id", U.shared_site_kind(U.canonical_host(F.col("website_url")), SITES).alias("kind"))


SITES = {"beanmarket.example": "marketplace", "linkcup.example": "link_page", "tinyshops.example": "site_builder", "roasthall.example": "marketplace"}


def f19_link_kind(spark, d):
    p = table(spark, d, "documents").filter("url is not null")
    return p.select("doc_id", U.link_kind(F.col("url")).alias("link_kind"))


def t01_first_wins_dedup(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", "fetched_at", U.canonical(F.col("url")).alias("canonical_url"))
    return select.first_wins(p, ["canonical_url"], "page_id").select("page_id", "canonical_url")


def a01_url_stats(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", "status", U.canonical_host(F.col("url")).alias("host"), U.canonical(F.col("url")).alias("u"), select.first_term(U.after_host(F.col("final_url")), TERMS).alias("term"))
    return audit.counters(p, {"blacklisted": F.col("term").isNotNull(), "failed": F.col("status") != 200}, {"distinct_urls": F.col("u")}, ["host"])


def a14_shared_host(spark, d):
    e = table(spark, d, "entities").select(U.canonical_host(F.col("website_url")).alias("host"))
    return audit.shared(e, "host")


def j15_child_hosts(spark, d):
    hosts = table(spark, d, "entities").select(U.canonical_host(F.col("website_url")).alias("host")).union(table(spark, d, "roaster_directory").select(U.canonical_host(F.col("website_url"))))
    return joins.child_hosts(hosts)


def f03_known_split(spark, d):
    p = table(spark, d, "captured_pages").select("page_id", U.canonical(F.col("url")).alias("u"))
    known = table(spark, d, "products").select(U.canonical(F.col("source_url")).alias("u")).filter("u is not null")
    new, old = joins.unknown_only(p, known, ["u"])
    return new.select("page_id", F.lit("new").alias("side")).union(old.select("page_id", F.lit("known")))


QUERIES = {f.__name__: f for f in (x12_normalize_url, x11_canonical_url, x15_canonical_host, x14_url_variants, f01_blacklist_first_match, f17_shared_site_kind, f19_link_kind, t01_first_wins_dedup, a01_url_stats, a14_shared_host, j15_child_hosts, f03_known_split)}

_TERM = "case " + " ".join(f"when contains(lower(regexp_extract(final_url, '^[^:]+://[^/?#]+(.*)$', 1)), '{t}') then '{t}'" for t in TERMS) + " end"
_KIND = "case " + " ".join(f"when host = '{h}' or host like '%.{h}' then '{k}'" for h, k in SITES.items()) + " end"
SQL = {
    "x12_normalize_url": f"select page_id, lower(regexp_extract(final_url, '^([A-Za-z]+://[^/?#]+)', 1)) || regexp_replace(case when {_PATH.format(c='final_url')} = '' then '/' else {_PATH.format(c='final_url')} end, '/$', '') || regexp_extract(final_url, '(\\?[^#]*)', 1) as norm_url from captured_pages",
    "x11_canonical_url": f"select page_id, {_sql_canonical('final_url')} as canonical_url from captured_pages",
    "x15_canonical_host": f"select directory_id, {_sql_host('website_url')} as host from roaster_directory",
    "x14_url_variants": f"""with h as (select id, lower(regexp_extract(website_url, '^([A-Za-z]+)://', 1)) as s, lower(regexp_extract(website_url, '{_HOST}', 1)) as h,
        case when {_PATH.format(c='website_url')} = '' then '/' else {_PATH.format(c='website_url')} end as p from entities where {_sql_host('website_url')} is not null),
        ss as (select id, p, h, unnest(['http', 'https']) as s from h),
        hh as (select id, p, s, unnest([h, case when h like 'www.%' then h[5:] else 'www.' || h end]) as h from ss),
        pp as (select id, s, h, unnest(case when p = '/' then ['/'] else [p, case when p like '%/' then p[:-2] else p || '/' end] end) as p from hh)
        select distinct id, s || '://' || h || p as variant from pp""",
    "f01_blacklist_first_match": f"select page_id, {_TERM} as matched_term from captured_pages",
    "f17_shared_site_kind": f"select directory_id, {_KIND} as kind from (select directory_id, {_sql_host('website_url')} as host from roaster_directory)",
    "f19_link_kind": f"select doc_id, case when regexp_matches(lower({_PATH.format(c='url')}), '/(?:products?|item|p)/[^/]+/?$') then 'product' when regexp_matches(lower({_PATH.format(c='url')}), '/(?:collections?|shop|store|menu|category|catalog)(?:/|$)') then 'listing' end as link_kind from documents where url is not null",
    "t01_first_wins_dedup": f"select min(page_id) as page_id, canonical_url from (select page_id, {_sql_canonical('url')} as canonical_url from captured_pages) group by canonical_url",
    "a01_url_stats": f"select {_sql_host('url')} as host, count(*) as rows, count(*) filter ({_TERM} is not null) as blacklisted, count(*) filter (status <> 200) as failed, count(distinct {_sql_canonical('url')}) as distinct_urls from captured_pages group by 1",
    "a14_shared_host": f"select host, count(*) as n from (select {_sql_host('website_url')} as host from entities) where host is not null group by host having count(*) >= 2",
    "j15_child_hosts": f"with h as (select distinct host from (select {_sql_host('website_url')} as host from entities union all select {_sql_host('website_url')} from roaster_directory) where host is not null) select a.host as child, b.host as parent from h a join h b on regexp_extract(a.host, '^[^.]+\\.(.+)$', 1) = b.host",
    "f03_known_split": f"with k as (select distinct {_sql_canonical('source_url')} as u from products where source_url is not null) select page_id, case when {_sql_canonical('url')} in (select u from k where u is not null) then 'known' else 'new' end as side from captured_pages",
}
