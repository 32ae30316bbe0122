"""Whether a product can be had, by what its own page, variants and controls say; page-wide words never count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions import url
from tamis.functions.page import schema_availability

#: Headings that stand for a missing product, and words on a product's own buttons.
MISSING = r"(?i)^(?:page not found|404(?:\s*[-–:]?\s*not found)?|product not found)$"
SOLD_OUT, BUY = r"(?i)sold\s*out|out\s*of\s*stock", r"(?i)add\s*to\s*(?:cart|bag)|buy\s*now"
PRODUCT_PATH = r"(?i)/products?/"
#: Parameters that don't tell one product from another.
NO_IDENTITY = r"^(utm_.*|fbclid|gclid|ref|variant)$"


def state_of(states: Column) -> Column:
    """in_stock if any of an array of states is, sold_out if there are some and all are, else unknown."""
    return F.when(F.array_contains(states, "in_stock"), "in_stock").when((F.size(states) > 0) & F.forall(states, lambda x: F.coalesce(x == "sold_out", F.lit(False))), "sold_out").otherwise("unknown")


def same_product(a: Column, b: Column) -> Column:
    """Whether two URLs are one product's; false where either is no URL."""
    return F.coalesce(url.canonical(a, NO_IDENTITY) == url.canonical(b, NO_IDENTITY), F.lit(False))


def offer_variant(offer: Column, source_url: Column) -> Column:
    """The variant that an offer (struct with url, sku and source_id) of a product's structured data names, if it is its own.

    A SKU or identifier goes before the selector in the offer's URL, which must name one variant.
    """
    of = offer["url"]
    selected = F.regexp_extract_all(of, F.lit(r"[?&]variant=([1-9][0-9]{0,39})(?=&|#|$)"), 1)
    foreign = of.isNotNull() & (of != "") & ~same_product(F.when(of.startswith("/"), F.concat(F.regexp_extract(source_url, r"^([^:]+://[^/?#]+)", 1), of)).otherwise(of), source_url)
    own = F.coalesce(F.nullif(offer["sku"], F.lit("")), F.nullif(offer["source_id"], F.lit("")), F.when(F.size(selected) == 1, F.get(selected, 0)))
    return F.when(~foreign, own)


def controls_state(controls: Column) -> Column:
    """State by the buttons (array<struct<text, disabled>>) of a product's own form; null where none of them tells.

    A disabled button to buy tells nothing of stock.
    """
    told = F.array_compact(F.transform(controls, lambda c: F.when(c["text"].rlike(SOLD_OUT), "sold_out").when(c["text"].rlike(BUY), F.when(c["disabled"], "unknown").otherwise("in_stock"))))
    return F.when(F.size(told) > 0, state_of(told))


def preorder(tags: Column) -> Column:
    """Whether one of a product's tags says that it can only be ordered in advance."""
    return F.coalesce(F.exists(tags, lambda t: F.trim(t).rlike(r"(?i)^pre[-\s]?order$")), F.lit(False))


def decision(status: Column, heading: Column, source_url: Column, final_url: Column, native: Column, offers: Column, controls: Column, advance: Column | None = None) -> Column:
    """struct<state, reason, is_available, variants> by the first of these that tells.

    A status of removal; any other but 200; a heading of a missing page; a redirect within the host away from products; the
    shop's own variants (array<struct<id, title, available>>), unknown where they can only be ordered in advance; offers of
    structured data (array<struct<source_id, sku, name, availability, url>>); the product's own buttons. Null states of a
    variant are unknown. Without a status nothing is concluded from it.
    """
    host = lambda u: url.part(u, "host")
    away = (host(source_url) == host(final_url)) & url.part(source_url, "path").rlike(PRODUCT_PATH) & ~F.coalesce(url.part(final_url, "path"), F.lit("/")).rlike(PRODUCT_PATH)
    no = F.lit(False) if advance is None else advance
    row = lambda i, title, state: F.struct(i.cast("string").alias("source_id"), title.alias("title"), state.alias("state"))
    own = F.transform(native, lambda v: row(v["id"], v["title"], F.when(no, "unknown").when(v["available"], "in_stock").when(~v["available"], "sold_out").otherwise("unknown")))
    mine = F.filter(offers, lambda o: o.isNotNull() & (o["url"].isNull() | (o["url"] == "") | same_product(F.when(o["url"].startswith("/"), F.concat(F.regexp_extract(source_url, r"^([^:]+://[^/?#]+)", 1), o["url"])).otherwise(o["url"]), source_url)))
    told = F.transform(mine, lambda o: row(offer_variant(o, source_url), o["name"], schema_availability(o["availability"])))
    button = controls_state(controls)
    reason = (
        F.when(status.isin(404, 410), "product_http_removed").when(status != 200, "incomplete_fetch").when((status == 200) & F.trim(heading).rlike(MISSING), "product_soft_404").when(away, "product_redirected_away")
        .when(F.size(native) > 0, F.when(no, "primary_product_preorder").otherwise("shop_exact_variants")).when(offers.isNotNull(), "product_scoped_structured_data").when(button.isNotNull(), "primary_product_controls").otherwise("product_stock_evidence_missing")
    )
    none = F.array().cast("array<struct<source_id: string, title: string, state: string>>")
    bound = F.transform(F.array(F.struct(reason.alias("reason"), F.coalesce(own, none).alias("own"), F.coalesce(told, none).alias("told"), button.alias("button"))), _stated)
    return F.element_at(bound, 1)


def _stated(b: Column) -> Column:
    variants = F.when(b["reason"].isin("shop_exact_variants", "primary_product_preorder"), b["own"]).when(b["reason"] == "product_scoped_structured_data", b["told"]).otherwise(F.filter(b["own"], lambda _: F.lit(False)))
    parts = state_of(F.transform(variants, lambda v: v["state"]))
    state = F.when(b["reason"].isin("product_http_removed", "product_soft_404", "product_redirected_away"), "removed").when(b["reason"] == "primary_product_controls", b["button"]).when(F.size(variants) > 0, parts).otherwise("unknown")
    return F.struct(state.alias("state"), b["reason"].alias("reason"), is_available(state).alias("is_available"), variants.alias("variants"))


def is_available(state: Column) -> Column:
    """True in stock, false sold out or removed, else null."""
    return F.when(state == "in_stock", True).when(state.isin("sold_out", "removed"), False)
