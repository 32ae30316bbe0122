"""Facts out of a page's HTML, read once into a struct, and out of its structured data."""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE = "title string, canonical string, h1 array<string>, text string, links array<struct<href: string, text: string>>, images array<string>, json_ld array<string>, meta map<string, string>"
_PARTS = ["title", "canonical", "h1", "text", "links", "images", "json_ld", "meta"]
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "br", "table", "ul", "ol", "header", "footer", "main", "nav", "aside", "form", "blockquote", "dt", "dd"}


class _Page(HTMLParser):
    """Collects a page's parts; text of scripts, styles and templates is left out of the visible text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.h1, self.links, self.images, self.json_ld, self.meta, self.canonical = None, [], [], [], [], {}, None
        self.text: list[str] = []
        self.hidden, self.script, self.buffer, self.open_h1, self.open_a, self.in_title = 0, None, [], None, None, False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in ("script", "style", "template", "noscript"):
            self.hidden += 1
            if tag == "script" and a.get("type", "").strip().lower() == "application/ld+json":
                self.script, self.buffer = "ld", []
        elif tag == "title" and self.title is None:
            self.in_title, self.title = True, ""
        elif tag == "h1":
            self.open_h1 = []
        elif tag == "a" and a.get("href"):
            self.open_a = (a["href"], [])
        elif tag == "img" and a.get("src"):
            self.images.append(a["src"])
        elif tag == "link" and "canonical" in a.get("rel", "").lower().split() and a.get("href"):
            self.canonical = self.canonical or a["href"]
        elif tag == "meta" and (a.get("property") or a.get("name")):
            self.meta.setdefault((a.get("property") or a.get("name")).lower(), a.get("content", ""))
        if tag in _BLOCK:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "template", "noscript"):
            self.hidden = max(0, self.hidden - 1)
            if self.script:
                self.json_ld.append("".join(self.buffer).strip())
                self.script = None
        elif tag == "title":
            self.in_title = False
        elif tag == "h1" and self.open_h1 is not None:
            self.h1.append(" ".join("".join(self.open_h1).split()))
            self.open_h1 = None
        elif tag == "a" and self.open_a:
            self.links.append((self.open_a[0], " ".join("".join(self.open_a[1]).split())))
            self.open_a = None
        if tag in _BLOCK:
            self.text.append("\n")

    def handle_data(self, data):
        if self.script:
            self.buffer.append(data)
        elif self.in_title:
            self.title += data
        elif not self.hidden:
            self.text.append(data)
            if self.open_h1 is not None:
                self.open_h1.append(data)
            if self.open_a:
                self.open_a[1].append(data)


def _read(html: str | None):
    if not isinstance(html, str):
        return None
    p = _Page()
    try:
        p.feed(html)
        p.close()
    except Exception:  # whatever could be read of a broken page counts
        pass
    lines = [" ".join(x.split()) for x in "".join(p.text).split("\n")]
    return {"title": " ".join(p.title.split()) if p.title else None, "canonical": p.canonical, "h1": p.h1, "text": "\n".join(x for x in lines if x), "links": [{"href": h, "text": t} for h, t in p.links], "images": p.images, "json_ld": p.json_ld, "meta": p.meta}


def page(html: Column) -> Column:
    """A struct of a page's parts; null for null, empty parts for an empty page."""

    def run(s: pd.Series) -> pd.DataFrame:
        rows = [_read(x) for x in s]
        return pd.DataFrame([r or dict.fromkeys(_PARTS) for r in rows], columns=_PARTS, index=s.index)

    return F.when(html.isNotNull(), F.pandas_udf(run, PAGE)(html))


OFFER = "struct<source_id: string, sku: string, name: string, price: string, currency: string, availability: string, url: string>"
PRODUCT = f"name string, description string, sku string, product_id string, url string, image string, brand string, offers array<{OFFER}>"
_FIELDS = ["name", "description", "sku", "product_id", "url", "image", "brand", "offers"]


def _nodes(value, depth=0):
    if depth > 8:
        return
    if isinstance(value, list):
        for x in value:
            yield from _nodes(x, depth + 1)
    elif isinstance(value, dict):
        yield value
        for k in ("@graph", "mainEntity", "mainEntityOfPage", "itemListElement", "item"):
            if k in value:
                yield from _nodes(value[k], depth + 1)


def _is(node: dict, kind: str) -> bool:
    t = node.get("@type")
    return kind in ([t] if isinstance(t, str) else t if isinstance(t, list) else [])


def _text(v) -> str | None:
    if isinstance(v, list):
        v = v[0] if v else None
    if isinstance(v, dict):
        v = v.get("name") or v.get("url") or v.get("@id") or v.get("value")
    return None if v is None or isinstance(v, bool) else str(v)


def _offers(node: dict, name: str | None) -> list[dict]:
    given = node.get("offers")
    out = []
    for o in given if isinstance(given, list) else [given] if isinstance(given, dict) else []:
        if not isinstance(o, dict):
            continue
        if isinstance(o.get("offers"), list):
            out += _offers(o, name)
            continue
        spec = o.get("priceSpecification")
        spec = spec[0] if isinstance(spec, list) and spec else spec if isinstance(spec, dict) else {}
        price = o.get("price", spec.get("price") if isinstance(spec, dict) else None)
        url = _text(o.get("url"))
        variant = url.split("variant=")[1].split("&")[0].split("#")[0] if url and "variant=" in url else None
        state = _text(o.get("availability"))
        out.append({"source_id": variant or _text(node.get("productID")), "sku": _text(o.get("sku") or node.get("sku")), "name": _text(o.get("name")) or name, "price": None if price is None else str(price), "currency": _text(o.get("priceCurrency") or (spec.get("priceCurrency") if isinstance(spec, dict) else None)), "availability": state.rstrip("/").rsplit("/", 1)[-1] if state else None, "url": url})
    return out


def _product(texts, names: set[str] | None = None):
    found = []
    for t in texts if texts is not None else []:
        try:
            data = json.loads(t)
        except (TypeError, ValueError, RecursionError):
            continue
        for n in _nodes(data):
            if _is(n, "ProductGroup"):
                parts = [v for v in n.get("hasVariant") or [] if isinstance(v, dict)]
                found.append((n, [o for v in parts for o in _offers(v, _text(v.get("name")))] or _offers(n, None)))
            elif _is(n, "Product"):
                found.append((n, _offers(n, _text(n.get("name")))))
    if len(found) != 1:
        return None
    n, offers = found[0]
    return {"name": _text(n.get("name")), "description": _text(n.get("description")), "sku": _text(n.get("sku")), "product_id": _text(n.get("productID") or n.get("productGroupID")), "url": _text(n.get("url") or n.get("@id")), "image": _text(n.get("image")), "brand": _text(n.get("brand")), "offers": offers}


def structured_product(json_ld: Column) -> Column:
    """The one product, or group of variants, that a page's JSON-LD texts tell of; null for none and for several."""

    def run(s: pd.Series) -> pd.DataFrame:
        rows = [_product(x) for x in s]
        return pd.DataFrame([r or dict.fromkeys(_FIELDS) for r in rows], columns=_FIELDS, index=s.index)

    got = F.pandas_udf(run, PRODUCT)(json_ld)
    return got


def schema_availability(value: Column) -> Column:
    """in_stock, sold_out or unknown for the last word of a schema.org availability; a pre-order tells nothing of stock."""
    v = F.lower(F.element_at(F.split(F.regexp_replace(value, "/+$", ""), "/"), -1))
    return F.when(v.isin("instock", "limitedavailability", "onlineonly", "instoreonly"), "in_stock").when(v.isin("outofstock", "soldout", "discontinued"), "sold_out").otherwise("unknown")


#: Words in a page's source that tell the shop system it runs on, in order.
PLATFORMS = {"shopify": "shopify", "woocommerce": "woocommerce", "wp-content": "woocommerce", "squarespace": "custom"}


def platform(html: Column) -> Column:
    """The shop system of a page by the first word that it holds; custom for others, unknown for null."""
    h = F.lower(html)
    out = F.lit("custom")
    for word, kind in reversed(list(PLATFORMS.items())):
        out = F.when(h.contains(word), kind).otherwise(out)
    return F.coalesce(F.when(html.isNotNull(), out), F.lit("unknown"))


def semantic_hash(name: Column, text: Column) -> Column:
    """Hash that stays the same while a page's name and visible words do, whatever becomes of blanks and case."""
    plain = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))
    return F.sha2(F.to_json(F.array(plain(name), plain(text))), 256)


def primary_image(structured: Column, meta: Column, images: Column) -> Column:
    """A page's product image: the structured data's, the one named for sharing, or the first that is no logo or icon."""
    picture = F.filter(images, lambda x: ~F.lower(x).rlike(r"logo|icon|sprite|placeholder|\.svg|^data:"))
    return F.coalesce(F.nullif(structured, F.lit("")), F.nullif(F.try_element_at(meta, F.lit("og:image")), F.lit("")), F.get(picture, 0))


def listing_guard(h1: Column, links: Column, text: Column) -> Column:
    """Why a page is no product page: listing (many product links), empty_shell (hardly a word), or null."""
    many = F.size(F.filter(links, lambda x: x["href"].rlike(r"/products?/[^/]+/?$"))) >= 12
    return F.when(F.coalesce(many & (F.size(h1) <= 1), F.lit(False)), "listing").when(F.length(F.coalesce(text, F.lit(""))) < 40, "empty_shell")


def text_parts(id_col: Column, **fields: Column) -> Column:
    """Array of (field, text, hash) of the fields that say something, for translation or review."""
    parts = [F.when(F.trim(v) != "", F.struct(F.lit(k).alias("field"), v.alias("text"), F.sha2(F.to_json(F.array(id_col.cast("string"), F.lit(k), v)), 256).alias("hash"))) for k, v in fields.items()]
    return F.array_compact(F.array(*parts))
