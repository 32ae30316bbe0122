"""Products and offers out of captured payloads of shop platforms, in one schema, by ``from_json``.

Input: rows with a page_id and a JSON body. Output: page_id, product_id, title, variant_id, variant_title, sku, price,
currency, available, weight, weight_unit. Prices are decimals as the platform means them; what a payload doesn't say is null.
A body that isn't of the platform's shape has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.jsonx import resolve_indexed
from tamis.functions.page import page, schema_availability, structured_product

COLUMNS = ("product_id", "title", "variant_id", "variant_title", "sku", "price", "currency", "available", "weight", "weight_unit")
_VARIANT = "struct<id: string, title: string, sku: string, price: string, available: boolean, grams: double, weight: double, weight_unit: string>"


def _out(df: DataFrame, **cols: Column) -> DataFrame:
    kinds = {"price": "decimal(18,3)", "available": "boolean", "weight": "double"}
    return df.select("page_id", *[cols.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in COLUMNS])


def _decimal(text: Column) -> Column:
    return F.regexp_replace(text, ",", ".").try_cast("decimal(18,3)")


def _scaled(minor: Column, digits: Column) -> Column:
    """Minor units as a decimal; digits from 0 to 3."""
    return (minor.try_cast("decimal(18,0)") / F.element_at(F.array(*[F.lit(10**i) for i in range(4)]), F.least(F.greatest(digits, F.lit(0)), F.lit(3)) + 1)).cast("decimal(18,3)")


def shopify(payloads: DataFrame, body: str = "body") -> DataFrame:
    """product.json, or a list of products."""
    one = f"struct<id: string, title: string, variants: array<{_VARIANT}>>"
    j = F.from_json(body, f"struct<product: {one}, products: array<{one}>>")
    p = payloads.select("page_id", F.explode(F.array_compact(F.concat(F.array(j["product"]), F.coalesce(j["products"], F.array().cast(f"array<{one}>"))))).alias("p"))
    v = p.select("page_id", "p.id", "p.title", F.explode("p.variants").alias("v"))
    return _out(v, product_id=F.col("id"), title=F.col("title"), variant_id=F.col("v.id"), variant_title=F.col("v.title"), sku=F.col("v.sku"), price=_decimal(F.col("v.price")), available=F.col("v.available"), weight=F.coalesce("v.weight", "v.grams"), weight_unit=F.coalesce("v.weight_unit", F.when(F.col("v.grams").isNotNull(), "g")))


def with_stock(prices: DataFrame, stock: DataFrame) -> DataFrame:
    """Offers of one payload with the stock of another (page_id, product_id, variant_id, available).

    ``complete`` tells whether both name the same variants of a product; without it, what is missing stays unknown.
    """
    s = stock.select("page_id", "product_id", "variant_id", F.col("available").alias("_stock")).dropDuplicates(["page_id", "product_id", "variant_id"])
    keys = ["page_id", "product_id"]
    n = prices.groupBy(*keys).agg(F.count_distinct("variant_id").alias("_np")).join(s.groupBy(*keys).agg(F.count_distinct("variant_id").alias("_ns")), keys, "left")
    both = prices.join(s, [*keys, "variant_id"], "left")
    m = both.groupBy(*keys).agg(F.count_distinct(F.when(F.col("_stock").isNotNull(), F.col("variant_id"))).alias("_nm"))
    out = both.withColumn("available", F.coalesce("_stock", "available")).join(n, keys).join(m, keys)
    return out.withColumn("complete", F.coalesce((F.col("_np") == F.col("_ns")) & (F.col("_nm") == F.col("_np")), F.lit(False))).drop("_stock", "_np", "_ns", "_nm")


def woocommerce(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Store API products: prices in minor units; a price range gives no price."""
    one = "struct<id: string, name: string, sku: string, is_in_stock: boolean, prices: struct<price: string, currency_code: string, currency_minor_unit: int, price_range: struct<min_amount: string, max_amount: string>>>"
    j = F.coalesce(F.from_json(body, f"array<{one}>"), F.array(F.from_json(body, one)))
    p = payloads.select("page_id", F.explode(j).alias("p")).filter("p.id is not null")
    price = F.when(F.col("p.prices.price_range.min_amount").isNull() | (F.col("p.prices.price_range.min_amount") == F.col("p.prices.price_range.max_amount")), _scaled(F.col("p.prices.price"), F.col("p.prices.currency_minor_unit")))
    return _out(p, product_id=F.col("p.id"), title=F.col("p.name"), variant_id=F.col("p.id"), variant_title=F.lit("default"), sku=F.col("p.sku"), price=price, currency=F.col("p.prices.currency_code"), available=F.col("p.is_in_stock"))


def squarespace(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Items with variants priced in cents; the sale price counts while a variant is on sale."""
    v = "struct<id: string, sku: string, price: double, salePrice: double, onSale: boolean, unlimited: boolean, qtyInStock: int, weight: double, optionValues: array<struct<value: string>>>"
    j = F.from_json(body, f"struct<item: struct<id: string, title: string, variants: array<{v}>>>")
    p = payloads.select("page_id", j["item"].alias("i")).filter("i.id is not null").select("page_id", "i.id", "i.title", F.explode("i.variants").alias("v"))
    cents = F.when(F.col("v.onSale"), F.col("v.salePrice")).otherwise(F.col("v.price"))
    return _out(p, product_id=F.col("id"), title=F.col("title"), variant_id=F.col("v.id"), variant_title=F.array_join(F.transform("v.optionValues", lambda x: x["value"]), " / "), sku=F.col("v.sku"), price=(cents / 100).cast("decimal(18,3)"), available=F.col("v.unlimited") | (F.col("v.qtyInStock") > 0), weight=F.col("v.weight"))


def square(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Item variations: sold out beats sellable, and what can't be sold isn't available."""
    s = "struct<id: string, name: string, sku: string, price: struct<amount: bigint, currency: string>, sold_out: boolean, sellable: boolean>"
    j = F.from_json(body, f"struct<product: struct<id: string, name: string>, skus: struct<data: array<{s}>>>")
    p = payloads.select("page_id", j.alias("j")).filter("j.product.id is not null").select("page_id", "j.product.id", "j.product.name", F.explode("j.skus.data").alias("s"))
    available = F.when(F.col("s.sold_out"), False).when(F.col("s.sellable").isNotNull(), F.col("s.sellable"))
    return _out(p, product_id=F.col("id"), title=F.col("name"), variant_id=F.col("s.id"), variant_title=F.col("s.name"), sku=F.col("s.sku"), price=_scaled(F.col("s.price.amount").cast("string"), F.when(F.col("s.price.currency").isin("JPY", "KRW", "CLP", "VND"), 0).otherwise(2)), currency=F.col("s.price.currency"), available=available)


def indexed(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Pages that hold their data as an indexed table: it is resolved and then read like a product payload."""
    return shopify(payloads.select("page_id", resolve_indexed(F.col(body)).alias("body")))


def json_ld(pages: DataFrame, html: str = "html") -> DataFrame:
    """Offers of a page's structured data, variants of a product group included."""
    p = pages.select("page_id", structured_product(page(F.col(html))["json_ld"]).alias("p")).filter("p.name is not null").select("page_id", "p.product_id", F.col("p.name").alias("title"), F.explode_outer("p.offers").alias("o"))
    stock = schema_availability(F.col("o.availability"))
    return _out(p, product_id=F.col("product_id"), title=F.col("title"), variant_id=F.coalesce("o.source_id", "o.sku"), variant_title=F.col("o.name"), sku=F.col("o.sku"), price=_decimal(F.col("o.price")), currency=F.col("o.currency"), available=F.when(stock == "in_stock", True).when(stock == "sold_out", False))


READERS = {"shopify": shopify, "woocommerce": woocommerce, "squarespace": squarespace, "square": square, "indexed": indexed}


def offers(payloads: DataFrame) -> DataFrame:
    """Offers of payloads (page_id, kind, body) of several platforms; each kind is read by its reader, others have no row."""
    out = None
    for kind, read in READERS.items():
        part = read(payloads.filter(F.col("kind") == kind).select("page_id", "body"))
        out = part if out is None else out.unionByName(part)
    return out
