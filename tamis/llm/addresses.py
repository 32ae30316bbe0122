"""Records of the same place, by a gazetteer that the records themselves make up.

Parsed forms are counted into a gazetteer: towns of a country, postal codes of towns, streets of towns. Rare spellings that lie
one slip from a much more frequent one are clustered with it by joins on keys with one letter left out: towns within a country,
rare ones also with each other where they share their postal codes, and streets within a town, where the country bears the town's counts out and no house numbers of
its own in the town speak for the spelling. Every form is then resolved by a beam search: hypotheses on the town, then on the
street in each of them, are scored against the gazetteer and only the best few go on. Records with the same street identifier,
number and unit are the same place.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.llm.addressparse import parse
from tamis.session import checkpoint

#: Hypotheses that go on after each step; times by which a spelling must be more frequent than one that is taken for its slip.
BEAM, RATIO = 4, 4
_FIELDS = ("country", "city", "city_in_line", "region", "postal", "street", "kind", "direction", "number", "unit")


def parsed(stores: DataFrame) -> DataFrame:
    """store_id and the parts of its address."""

    def run(batches):
        for pdf in batches:
            cols = [[x if isinstance(x, str) else None for x in pdf[c]] for c in ("address1", "address2", "city", "region", "postal_code", "country")]
            out = pd.DataFrame([tuple(parse(*r)) for r in zip(*cols)], columns=list(_FIELDS))
            out.insert(0, "store_id", pdf["store_id"].to_numpy())
            yield out

    schema = "store_id bigint, " + ", ".join(f"{c} string" for c in _FIELDS)
    return stores.select("store_id", "address1", "address2", "city", "region", "postal_code", "country").filter("store_id is not null").mapInPandas(run, schema)


def slips(word: Column) -> Column:
    """A word and all it becomes by leaving out one letter; two words one slip apart share one of them."""
    n = F.length(word)
    return F.array_distinct(F.concat(F.array(word), F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))))


def one_slip(a: Column, b: Column) -> Column:
    """Whether two words differ by one letter more, less or other, or by two neighbours changed over (given a common slip)."""
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (F.levenshtein(a, b) == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))))


def spelling_clusters(words: DataFrame, within: list[str], word: str, count: str = "n", least: int = 4, ratio: float = RATIO) -> DataFrame:
    """within..., word, head, head_n: rows for spellings that are a slip of one more frequent by ``ratio``, one row for each such head."""
    w = words.filter(F.length(word) >= least).select(*within, F.col(word).alias("w"), F.col(count).alias("n"))
    keyed = w.withColumn("slip", F.explode(slips(F.col("w"))))
    heads = keyed.filter(F.col("n") >= ratio).select(*within, "slip", F.col("w").alias("head"), F.col("n").alias("head_n"))
    pairs = keyed.join(heads, [*within, "slip"]).filter((F.col("w") != F.col("head")) & ((F.col("head_n") > F.col("n")) | F.lit(ratio == 0)) & (F.col("head_n") >= ratio * F.col("n")) & one_slip(F.col("w"), F.col("head")))
    return pairs.select(*within, F.col("w").alias(word), "head", "head_n").distinct()


def coded_spellings(forms: DataFrame, towns: DataFrame) -> DataFrame:
    """country, city, head: town spellings one slip from one that is as frequent or more and has their postal codes.

    However rare both are. Half of a spelling's records with a code must have codes of the head, so that one wrong code doesn't
    join two towns; of equally frequent spellings the last in order is the head.
    """
    codes = forms.filter("city != '' and postal != '' and country is not null").groupBy("country", "postal", "city").agg(F.sum("n").alias("m"))
    keyed = codes.filter(F.length("city") >= 4).join(towns, ["country", "city"]).withColumn("slip", F.explode(slips(F.col("city"))))
    heads = keyed.select("country", "postal", "slip", F.col("city").alias("head"), F.col("n").alias("head_n"))
    near = keyed.join(heads, ["country", "postal", "slip"]).filter(((F.col("head_n") > F.col("n")) | ((F.col("head_n") == F.col("n")) & (F.col("head") > F.col("city")))) & one_slip(F.col("city"), F.col("head")))
    shared = near.select("country", "postal", "city", "head", "m").distinct().groupBy("country", "city", "head").agg(F.sum("m").alias("shared"))
    return shared.join(codes.groupBy("country", "city").agg(F.sum("m").alias("all")), ["country", "city"]).filter(2 * F.col("shared") >= F.col("all")).select("country", "city", "head")


def roots(heads: DataFrame) -> DataFrame:
    """country, city, head, coded: every spelling with the heads that are no slips themselves, reached from head to head."""
    done, going = None, checkpoint(heads.groupBy("country", "city", "head").agg(F.max("coded").alias("coded")))
    step = going.select("country", F.col("city").alias("head"), F.col("head").alias("next"), F.col("coded").alias("next_coded"))
    # a head is more frequent or later in order than its slips, so every path ends
    while True:
        far = going.join(step, ["country", "head"], "left")
        ends = far.filter("next is null").select("country", "city", "head", "coded")
        done = ends if done is None else done.unionByName(ends)
        going = checkpoint(far.filter("next is not null").groupBy("country", "city", F.col("next").alias("head")).agg(F.max(F.col("coded") & F.col("next_coded")).alias("coded")))
        if going.isEmpty():
            return done.groupBy("country", "city", "head").agg(F.max("coded").alias("coded"))


def _best(df: DataFrame, key: str, score: str, keep: int, *ties: str) -> DataFrame:
    """The ``keep`` best rows of each form; forms are distinct, so a group is the few hypotheses of one."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), *ties))).filter(F.col("rn") <= keep).drop("rn")


def resolve(records: DataFrame) -> DataFrame:
    """form fields..., place: each distinct form of ``parsed`` records that can be placed, with its place's key."""
    forms = checkpoint(records.filter("street != '' and number != ''").groupBy(*_FIELDS).agg(F.count("*").alias("n")).withColumn("form", F.xxhash64(*_FIELDS)))

    # the gazetteer's towns: spellings within a country, each with its heads
    towns = forms.filter("city != '' and country is not null").groupBy("country", "city").agg(F.sum("n").alias("n"))
    town_heads = spelling_clusters(towns, ["country"], "city").select("country", "city", "head", F.lit(False).alias("coded")).unionByName(coded_spellings(forms, towns).withColumn("coded", F.lit(True)))
    town_heads = checkpoint(roots(town_heads)).join(towns.select("country", F.col("city").alias("head"), F.col("n").alias("head_n")), ["country", "head"])
    spelled = checkpoint(
        towns.join(town_heads.select("country", "city").distinct(), ["country", "city"], "left_anti").select("country", "city", F.col("city").alias("town"), F.col("n").alias("town_n"), F.lit(0.0).alias("cost"), F.lit(True).alias("sure"))
        .unionByName(town_heads.select("country", "city", F.col("head").alias("town"), F.col("head_n").alias("town_n"), F.lit(1.0).alias("cost"), (F.col("coded") & (F.count("*").over(Window.partitionBy("country", "city")) == 1)).alias("sure")))
    )
    # postal codes of towns, those of a spelling that a code joined to a single head included
    homes = forms.filter("postal != '' and city != '' and country is not null").join(spelled.filter("sure"), ["country", "city"]).groupBy("country", "postal", "town").agg(F.sum("n").alias("m"))

    # first step of the beam: the town. A form without a country tries all countries
    f = forms.select("form", "country", "city", "city_in_line", "postal", "region")
    named = f.withColumn("said", F.explode(F.array_distinct(F.array("city", "city_in_line")))).filter("said != ''")
    by_name = named.join(spelled.withColumnsRenamed({"country": "c", "city": "said"}), "said").filter("country is null or country = c").select("form", F.col("c").alias("home"), "town", (F.lit(3.0) - F.col("cost") - F.when(F.col("town_n") < 3, 1.0).otherwise(0.0) - F.when(F.col("said") == F.col("city"), 0.0).otherwise(0.5)).alias("s"))
    support = (F.lit(1.5) + F.least(F.log2("m"), F.lit(4.0)) / 8).alias("code_s")
    told = homes.select(F.col("country").alias("home"), "postal", "town", support)
    by_name = by_name.join(f.select("form", "postal"), "form").join(told, ["home", "postal", "town"], "left").select("form", "home", "town", (F.col("s") + F.coalesce("code_s", F.lit(0.0))).alias("s"))
    # of a code that very many towns claim, only the first few can be in a beam without being named
    first = homes.withColumn("rn", F.row_number().over(Window.partitionBy("country", "postal").orderBy(F.desc("m"), "town"))).filter(F.col("rn") <= BEAM)
    by_code = f.filter("postal != ''").join(first.withColumnsRenamed({"country": "c"}), "postal").filter("country is null or country = c").select("form", F.col("c").alias("home"), "town", support.alias("s"))
    towns_tried = by_name.unionByName(by_code).groupBy("form", "home", "town").agg(F.max("s").alias("town_score"))
    towns_tried = checkpoint(_best(towns_tried, "form", "town_score", BEAM, "home", "town"))

    # the gazetteer's streets, counted where the town is beyond doubt
    top = checkpoint(_best(towns_tried, "form", "town_score", 1, "home", "town"))
    # short "str" means one kind in German towns and another elsewhere; the form alone may not tell
    kind = F.when(F.col("home").isin("DE", "AT", "CH") & (F.col("kind") == "street"), F.lit("strasse")).otherwise(F.col("kind"))
    streets = checkpoint(forms.join(top, "form").withColumn("kind", kind).groupBy("home", "town", "street", "kind", "direction").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("town_score") >= 2, F.col("n")).otherwise(0)).alias("n")))
    names = checkpoint(streets.groupBy("home", "street").agg(F.sum("all").alias("n")))
    # a town's spellings: one is clustered with another of the same town that more of its records have, if the country knows the
    # other far better too. In a town that hasn't the frequent name a rare one is a street of its own
    asked = towns_tried.join(forms.select("form", "street", "n"), "form").join(top.select("form", "home", "town", F.lit(1).alias("is_top")), ["form", "home", "town"], "left")
    in_town = checkpoint(asked.groupBy("home", "town", "street").agg(F.sum(F.when(F.col("is_top") == 1, F.col("n")).otherwise(0)).alias("n")))
    near = spelling_clusters(in_town, ["home", "town"], "street", ratio=1).select("home", "town", "street", "head")
    support = lambda c, n: names.select("home", F.col("street").alias(c), F.col("n").alias(n))
    # or as many of its records, if the other stands at the very number and postal code and the spelling nowhere else in the country
    doors = checkpoint(forms.filter("postal != ''").join(top, "form").groupBy("home", "town", "number", "postal", "street").agg(F.sum("n").alias("n")))
    once = names.join(doors.select("home", "town", "number", "postal", "street", F.col("n").alias("here")), ["home", "street"]).filter("n = here").select("home", "town", "street")
    twin = spelling_clusters(doors, ["home", "town", "number", "postal"], "street", ratio=0).select("home", "town", "street", "head").join(once, ["home", "town", "street"], "left_semi")
    near = near.unionByName(twin).join(support("street", "own_n"), ["home", "street"]).join(support("head", "head_n"), ["home", "head"])
    name_heads = checkpoint(near.filter(F.col("head_n") >= RATIO * F.col("own_n")).select("home", "town", "street", "head").distinct())
    # but where records of a town carry it at two or more numbers that none of its heads has there, the name stands as well: a slip
    # is made in records of a place, whose other records mostly have its right name
    numbers = checkpoint(forms.join(top.filter("town_score >= 2"), "form").select("home", "town", "street", "number").distinct())
    theirs = numbers.withColumnRenamed("street", "head").withColumn("had", F.lit(1))
    stands = numbers.join(name_heads, ["home", "town", "street"]).join(theirs, ["home", "town", "head", "number"], "left")
    stands = stands.groupBy("home", "town", "street", "number").agg(F.max("had").alias("had")).filter("had is null").groupBy("home", "town", "street").agg(F.count("*").alias("own")).filter("own > 1").drop("own")
    slipping = name_heads.select("home", "town", "street").distinct().join(stands, ["home", "town", "street"], "left_anti")

    # second step: the street in each town
    g = forms.select("form", "street", "kind", "direction", "number")
    tried = towns_tried.join(g, "form").withColumn("kind", kind)
    exact = tried.join(slipping, ["home", "town", "street"], "left_anti").withColumns({"name": F.col("street"), "slip_cost": F.lit(0.0)})
    slipped = tried.join(name_heads, ["home", "town", "street"]).withColumns({"name": F.col("head"), "slip_cost": F.lit(1.0)}).drop("head")
    hypotheses = exact.unionByName(slipped)
    known = streets.filter("n > 0").select("home", "town", F.col("street").alias("name"), "kind", "direction", F.col("n").alias("known"))
    scored = hypotheses.join(known, ["home", "town", "name", "kind", "direction"], "left")
    scored = scored.withColumn("score", F.col("town_score") - F.col("slip_cost") + F.when(F.col("known").isNull(), -1.0).otherwise(F.least(F.log2(F.col("known") + 1), F.lit(4.0)) / 4))
    chosen = _best(scored, "form", "score", 1, "home", "town", "name")
    # towns without a gazetteer entry of their own keep what they say
    lost = forms.join(chosen.select("form"), "form", "left_anti").filter("city != '' or postal != ''").select("form", F.coalesce("country", F.lit("")).alias("home"), F.when(F.col("city") != "", F.col("city")).otherwise(F.concat(F.lit("#"), "postal")).alias("town"), F.col("street").alias("name"))
    both = chosen.select("form", "home", "town", "name").unionByName(lost)
    placed = forms.join(both, "form").withColumn("kind", kind).withColumn("place", F.concat_ws("|", "home", "town", "name", "kind", "direction", "number", "unit"))

    # forms with neither town nor postal code: the one place of that street, number and unit in its country and region, if only one
    nowhere = forms.filter("city = '' and postal = '' and city_in_line = ''").join(placed.select("form"), "form", "left_anti")
    somewhere = placed.groupBy("place", "home", "name", "kind", "direction", "number", "unit", "region").agg(F.sum("n").alias("m"))
    fits = nowhere.select("form", "country", F.col("region").alias("own_region"), F.col("street").alias("name"), "kind", "direction", "number", "unit").join(somewhere, ["name", "kind", "direction", "number", "unit"])
    fits = fits.filter("(country is null or country = home) and (own_region = '' or own_region = region)").groupBy("form").agg(F.countDistinct("place").alias("k"), F.min("place").alias("place")).filter("k = 1")
    return placed.select("form", "place").unionByName(fits.select("form", "place"))


def places(stores: DataFrame) -> DataFrame:
    """store_id, place of the records that can be placed.

    Null, empty and unreadable addresses, and those without a street or number, have no place. Records with null store_id are
    left out. Only the address columns and store_id are read.
    """
    records = checkpoint(parsed(stores).withColumn("form", F.xxhash64(*_FIELDS)))
    return records.select("store_id", "form").join(resolve(records.drop("form")), "form").select("store_id", "place")


def same_place(stores: DataFrame) -> DataFrame:
    """store_id_a, store_id_b: all pairs of different store_id of one place, smaller id first."""
    p = checkpoint(places(stores).distinct())
    a, b = p.select("place", F.col("store_id").alias("store_id_a")), p.select("place", F.col("store_id").alias("store_id_b"))
    return a.join(b, "place").filter("store_id_a < store_id_b").select("store_id_a", "store_id_b").distinct()
