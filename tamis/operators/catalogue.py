"""Saving a catalogue: whose record an observation is, what its variants become, which pages are known, what mergers of owners leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.operators.availability import is_available
from tamis.operators.merge import is_stale
from tamis.operators.select import winner


def resolve_identity(incoming: DataFrame, stored: DataFrame, owner: str = "entity_id", key: str = "source_key", id_col: str = "id", url: str = "source_url") -> DataFrame:
    """``incoming`` with product_id, how (key, adopted, new) and problem.

    An observation is the stored record with its owner and source key. Else, if it names an id, that record is adopted: it must
    be of the same owner, and must have no other key; without a key its URL must be the observation's. problem says which of
    these fails (missing, other_owner, other_key, other_url, several), and product_id is null then. Null keys match nothing;
    repeated observations are each resolved.
    """
    s = stored.select(F.col(owner).alias("s_owner"), F.col(key).alias("s_key"), F.col(id_col).alias("s_id"), F.col(url).alias("s_url"))
    by_key = s.filter("s_key is not null").groupBy("s_owner", "s_key").agg(F.min("s_id").alias("key_id"), F.count("*").alias("key_n"))
    by_id = s.filter("s_id is not null").groupBy("s_id").agg(F.min(F.struct("s_owner", "s_key", "s_url")).alias("of"))
    got = incoming.join(by_key, (F.col(owner) == F.col("s_owner")) & (F.col(key) == F.col("s_key")), "left").drop("s_owner", "s_key").join(by_id, F.col(id_col) == F.col("s_id"), "left")
    found, asked, known = F.col("key_id").isNotNull(), F.col(id_col).isNotNull(), F.col("of").isNotNull()
    problem = (
        F.when(found, F.when(F.col("key_n") > 1, "several")).when(asked & ~known, "missing").when(known & ~F.col("of.s_owner").eqNullSafe(F.col(owner)), "other_owner")
        .when(known & F.col("of.s_key").isNotNull() & ~F.col("of.s_key").eqNullSafe(F.col(key)), "other_key").when(known & F.col("of.s_key").isNull() & ~F.col("of.s_url").eqNullSafe(F.col(url)), "other_url")
    )
    how = F.when(problem.isNull(), F.when(found, "key").when(known, "adopted").otherwise("new"))
    return got.select(*incoming.columns, F.when(problem.isNull(), F.coalesce("key_id", F.when(known, F.col(id_col)))).alias("product_id"), how.alias("how"), problem.alias("problem"))


def seen_at(state: Column, checked: Column, before: Column) -> tuple[Column, Column]:
    """(is_available, last seen): the flag of a state, and the time that only moves on when something is in stock."""
    return is_available(state), F.when(state == "in_stock", F.greatest(before, checked)).otherwise(before)


def adopt_variants(incoming: DataFrame, stored: DataFrame, product: str = "product_id", key: str = "source_key", name: str = "variant_name", weight: str = "weight_g", id_col: str = "id") -> DataFrame:
    """``incoming`` with variant_id, how (key, adopted, new) and problem (repeated_key, several).

    A variant is the stored one with its product and key, else the one stored without a key that has its name and weight, null
    weights being equal; if several have them, that is a problem. So is a key that occurs twice among a product's variants.
    """
    s = stored.select(F.col(product).alias("s_product"), F.col(key).alias("s_key"), F.col(name).alias("s_name"), F.col(weight).alias("s_weight"), F.col(id_col).alias("s_id"))
    by_key = s.filter("s_key is not null").groupBy("s_product", "s_key").agg(F.min("s_id").alias("key_id"))
    legacy = s.filter("s_key is null").groupBy(F.col("s_product").alias("l_product"), "s_name", "s_weight").agg(F.min("s_id").alias("legacy_id"), F.count("*").alias("legacy_n"))
    twice = incoming.filter(F.col(key).isNotNull()).groupBy(F.col(product).alias("t_product"), F.col(key).alias("t_key")).agg(F.count("*").alias("times"))
    got = incoming.join(by_key, (F.col(product) == F.col("s_product")) & (F.col(key) == F.col("s_key")), "left")
    got = got.join(legacy, (F.col(product) == F.col("l_product")) & F.col(name).eqNullSafe(F.col("s_name")) & F.col(weight).eqNullSafe(F.col("s_weight")), "left")
    got = got.join(twice, (F.col(product) == F.col("t_product")) & (F.col(key) == F.col("t_key")), "left")
    problem = F.when(F.col("times") > 1, "repeated_key").when(F.col("key_id").isNull() & (F.col("legacy_n") > 1), "several")
    how = F.when(problem.isNull(), F.when(F.col("key_id").isNotNull(), "key").when(F.col("legacy_id").isNotNull(), "adopted").otherwise("new"))
    return got.select(*incoming.columns, F.when(problem.isNull(), F.coalesce("key_id", "legacy_id")).alias("variant_id"), how.alias("how"), problem.alias("problem"))


def refresh_stock(variants: DataFrame, checks: DataFrame, products: DataFrame, time: str = "checked_at", state: str = "state") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(variants, events, unknown) after checks of stock alone: (product_id, merchant_id, state, time), merchant_id null for a whole product.

    A check older than a variant's own time changes nothing there, though the variant was seen. A product that is removed takes
    with it all its variants that aren't newer. Of several checks the latest counts. An event is a product whose variants changed
    in state. Checks of products that aren't known are in ``unknown`` and change nothing.
    """
    known = checks.join(products.select("product_id").distinct(), "product_id", "left_semi")
    unknown = checks.join(products.select("product_id").distinct(), "product_id", "left_anti")
    best = lambda df, keys: df.groupBy(*keys).agg(F.max(F.struct(F.col(time), F.col(state))).alias("c"))
    own = best(known.filter("merchant_id is not null"), ["product_id", "merchant_id"]).withColumnRenamed("c", "own")
    gone = best(known.filter((F.col("merchant_id").isNull()) & (F.col(state) == "removed")), ["product_id"]).withColumnRenamed("c", "gone")
    j = variants.join(own, ["product_id", "merchant_id"], "left").join(gone, "product_id", "left")
    fresh = lambda c: F.when(F.col(c).isNotNull() & ~is_stale(F.col(c)[time], F.col(time)), F.col(c))
    told = F.greatest(fresh("own"), fresh("gone"))
    out = j.withColumn("told", told).withColumn("was", F.col(state))
    out = out.withColumns({state: F.coalesce(F.col("told")[state], F.col(state)), time: F.coalesce(F.col("told")[time], F.col(time))})
    events = out.filter(~F.col("was").eqNullSafe(F.col(state))).groupBy("product_id").agg(F.count("*").alias("changed"), F.max(time).alias("observed_at"))
    return out.select(*variants.columns), events, unknown


def see_pages(known: DataFrame, seen: DataFrame, keys: list[str], time: str, set_status: str | None = None) -> DataFrame:
    """Known pages (keys, status, times_seen, first_seen_at, last_seen_at) after a visit that saw ``seen`` (keys, time).

    Each page counts once a visit, however often it was linked. A ``set_status`` (such as skip for what a blacklist names) is
    given to new and known pages alike; else known ones keep theirs and new ones are new.
    """
    one = seen.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    j = known.join(one, keys, "full")
    new = F.col("times_seen").isNull()
    here = F.col("_last").isNotNull()
    status = F.when(here & F.lit(set_status is not None), F.lit(set_status)).when(new, "new").otherwise(F.col("status"))
    return j.select(
        *keys, status.alias("status"), (F.coalesce("times_seen", F.lit(0)) + here.cast("int")).alias("times_seen"),
        F.least("first_seen_at", "_first").alias("first_seen_at"), F.greatest("last_seen_at", "_last").alias("last_seen_at"),
    )


def merge_pages(pages: DataFrame, keys: list[str], classified: str, seen: str, first: str, times: str, id_col: str, carry: list[str]) -> DataFrame:
    """One row for each of ``keys``: the winner's ``carry`` columns and id, the sum of times seen, the first and last time, and the ids of the others.

    The winner was classified last, then seen last, then has the least id; unknown times come last.
    """
    order = F.struct(F.coalesce(F.unix_micros(classified), F.lit(-(2**62))).alias("c"), F.coalesce(F.unix_micros(seen), F.lit(-(2**62))).alias("s"))
    best = pages.withColumn("_o", order).groupBy(*keys).agg(F.max("_o").alias("_top"))
    tops = pages.withColumn("_o", order).join(best, keys).filter("_o = _top").groupBy(*keys).agg(F.min(F.struct(F.col(id_col), *carry)).alias("_w"))
    sums = pages.groupBy(*keys).agg(F.sum(F.coalesce(times, F.lit(0))).alias(times), F.min(first).alias(first), F.max(seen).alias(seen), F.array_sort(F.collect_set(id_col)).alias("_ids"))
    j = sums.join(tops, keys)
    return j.select(*keys, F.col("_w")[id_col].alias(id_col), *[F.col("_w")[c].alias(c) for c in carry], times, first, seen, F.array_except("_ids", F.array(F.col("_w")[id_col])).alias("merged_ids"))


def primary_location(locations: DataFrame, owner: str, canonical: Column, primary: str, id_col: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Each owner's first place: one with coordinates before others, of the canonical owner, marked as primary, of least id."""
    flags = [F.col(lat).isNotNull() & F.col(lng).isNotNull(), F.coalesce(canonical, F.lit(False)), F.coalesce(primary, F.lit(False))]
    rank = sum((F.when(f, 2 ** (2 - i)).otherwise(0) for i, f in enumerate(flags)), F.lit(0))
    ranked = locations.withColumn("_r", rank)
    best = ranked.groupBy(owner).agg(F.max("_r").alias("_best"))
    return ranked.join(best, owner).filter("_r = _best").groupBy(owner).agg(F.min(id_col).alias(id_col))


def carried_media(media: DataFrame, aliases: DataFrame, product: str = "product_id", asset: str = "media_asset_id", order: str = "sort_order") -> DataFrame:
    """(product, asset, order) that winners without pictures take from their aliases (alias_id, winner_id), each picture once, in its first place."""
    bare = aliases.join(media.select(F.col(product).alias("winner_id")).distinct(), "winner_id", "left_anti")
    return bare.join(media, bare["alias_id"] == media[product]).groupBy(F.col("winner_id").alias(product), F.col(asset)).agg(F.min(order).alias(order))


def not_preserved(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``before``, repetitions included, that ``after`` hasn't; none if what was there is still there. Rows may be added."""
    return before.select(*columns).exceptAll(after.select(*columns))


def merge_contacts(records: DataFrame, keys: list[str], sequence: str, single: list[str], many: list[str]) -> DataFrame:
    """One contact for each key: of ``single`` columns the first that isn't null or blank, of ``many`` (arrays) all distinct values in order."""
    firsts = [F.min(F.when(F.trim(c) != "", F.struct(F.col(sequence), F.trim(c).alias("v")))).getField("v").alias(c) for c in single]
    sets = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(c), F.array().cast("array<string>")))))).alias(c) for c in many]
    return records.groupBy(*keys).agg(*firsts, *sets)


def union_first_wins(parts: list[DataFrame], keys: list[str], sequence: str) -> DataFrame:
    """All rows of several sources, the first source's first row for each key; with ``origin``, its place in the list."""
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("origin", F.lit(i))
        every = p if every is None else every.unionByName(p, allowMissingColumns=True)
    return winner(every, keys, [-F.col("origin"), -F.col(sequence)])


def agreeing_market(prices: DataFrame, market: DataFrame, keys: list[str], minor: str = "minor_units", currency: str = "currency") -> DataFrame:
    """``prices`` with the currency of the market rows that have the same minor units for the key, if those all name one currency."""
    one = market.filter(F.col(currency).isNotNull()).groupBy(*keys, minor).agg(F.min(currency).alias("_low"), F.max(currency).alias("_high"))
    return prices.join(one, [*keys, minor], "left").withColumn("market_currency", F.when(F.col("_low") == F.col("_high"), F.col("_low"))).drop("_low", "_high")


def outcomes(df: DataFrame, by: list[str], outcome: Column, kinds: list[str]) -> DataFrame:
    """Rows of each group, and how many had each outcome; others are counted in other."""
    counts = [F.count(F.when(outcome == k, 1)).alias(k) for k in kinds]
    return df.groupBy(*by).agg(F.count("*").alias("total"), *counts, F.count(F.when(outcome.isNull() | ~outcome.isin(*kinds), 1)).alias("other"))


def seeded_order(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """``df`` with ``place``: a number that orders rows at random, the same for the same seed and keys, without a window over all rows."""
    return df.withColumn("place", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])))
