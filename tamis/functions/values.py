"""Prices in hundredths, weights on labels and tasting notes, from what merchants write.

All refuse rather than guess: ranges, prose and ambiguous figures are null. Texts of null are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.money import AFFIX, _WIDE

MOST = 2_147_483_647
#: Grams of a unit, by the words for it.
GRAMS = {
    1000.0: "kilogramm kilogram kilograms kg", 1.0: "gramm gram grams gr g", 28.349523125: "ounce ounces oz", 453.59237: "pound pounds lb lbs",
}
_UNIT = "|".join(sorted((w for ws in GRAMS.values() for w in ws.split()), key=len, reverse=True))
_AMOUNT = rf"(?<![0-9.,a-z_])([0-9]+(?:[.,][0-9]{{1,3}})?)\s*({_UNIT})(?![a-z0-9_])"
_SEVERAL = r"[0-9]\s*[x×]\s*[0-9]|[x×]\s*[0-9]|[0-9]\s*(?:bags?|packs?|packets?)\b|[-–—−]"

#: Families of tastes, the notes of each, and other words for a note.
NOTES = {
    "fruit berry": "blueberry strawberry raspberry blackberry", "fruit citrus": "lemon lime orange grapefruit", "fruit stone-fruit": "peach apricot cherry",
    "fruit pome-fruit": "apple pear", "fruit tropical": "pineapple mango", "sweet chocolate": "chocolate dark_chocolate milk_chocolate cocoa", "sweet sugar": "caramel honey brown_sugar",
    "sweet spice": "vanilla", "nut almond": "almond", "nut hazelnut": "hazelnut", "nut walnut": "walnut", "floral white-flower": "jasmine", "floral rose": "rose",
}
SAME_NOTE = {"blueberries": "blueberry", "strawberries": "strawberry", "raspberries": "raspberry", "blackberries": "blackberry", "cacao": "cocoa", "chocolat noir": "dark chocolate", "dark choc": "dark chocolate", "milk choc": "milk chocolate", "caramelo": "caramel"}


def _pairs(table: dict) -> Column:
    return F.create_map(*[F.lit(x) if isinstance(x, str) else x for kv in table.items() for x in kv])


def price_cents(raw: Column) -> Column:
    """Hundredths of the written amount, whatever its currency; null for ranges, prose, irregular groups and too large amounts.

    A single separator needs one or two digits behind it, for three could be a group.
    """
    t = F.trim(F.translate(raw, *_WIDE))
    number = r"[0-9](?:[0-9.,'’\s]*[0-9])?"
    flank = AFFIX.removeprefix("(?i)")
    n = F.regexp_extract(t, f"({number})", 1)
    shapes = r"^(?:[0-9]+|[0-9]+[.,][0-9]{1,2}|[0-9]{1,3}(?:[\s'’][0-9]{3})+(?:[.,][0-9]{1,2})?|[0-9]{1,3}(?:,[0-9]{3})+\.[0-9]{1,2}|[0-9]{1,3}(?:\.[0-9]{3})+,[0-9]{1,2})$"
    behind = F.regexp_extract(n, r"[.,]([0-9]{1,2})$", 1)
    whole = F.regexp_replace(F.regexp_replace(n, r"[.,][0-9]{1,2}$", ""), r"[^0-9]", "")
    cents = F.concat(whole, F.rpad(behind, 2, "0")).try_cast("decimal(38,0)")
    fine = ~t.rlike("[-–—−+%/]") & t.rlike(rf"^{flank}\s*{number}\s*{flank}$") & n.rlike(shapes) & (F.length(whole) <= 30) & (cents <= MOST)
    return F.when(fine, cents.cast("bigint"))


def amount_cents(value: Column) -> Column:
    """Hundredths of a number, halves up; null for negative, infinite and too large ones."""
    cents = F.floor(value.cast("double") * 100 + 0.5)
    return F.when((value >= 0) & ~F.isnan(value.cast("double")) & (cents <= MOST), cents.cast("bigint"))


def weight_grams(label: Column) -> Column:
    """Whole grams, halves up, of the one weight in a label; null for several, multiples, ranges, three decimals and zero."""
    t = F.lower(F.translate(label, *_WIDE))
    figures, words = F.regexp_extract_all(t, F.lit(_AMOUNT), 1), F.regexp_extract_all(t, F.lit(_AMOUNT), 2)
    one = F.get(figures, 0)
    factor = F.try_element_at(_pairs({w: F.lit(k).cast("decimal(13,9)") for k, ws in GRAMS.items() for w in ws.split()}), F.get(words, 0))
    grams = F.floor(F.replace(one, F.lit(","), F.lit(".")).try_cast("decimal(18,3)") * factor + F.lit(0.5).cast("decimal(2,1)"))
    fine = (F.size(figures) == 1) & ~t.rlike(_SEVERAL) & ~one.rlike(r"[.,][0-9]{3}$") & (grams > 0) & (grams <= MOST)
    return F.when(fine, grams.cast("bigint"))


def label_weight(label: Column) -> Column:
    """``weight_grams`` of a size label, for which a roast date at its end, gm and kilos are read as well.

    So are a total with the pouches that make it up, if they do, and two units for one weight, if they agree within 2 g or a
    fiftieth; the metric figure counts.
    """
    t = F.regexp_replace(label, r"\s*-\s*[0-9]{1,2}/[0-9]{1,2}\s*$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)([0-9])\s*gm\b", "$1g"), r"(?i)([0-9]+(?:\.[0-9]+)?)\s*kilos?\b", "$1 kg")
    num, metric, other = r"([0-9]+(?:\.[0-9]+)?)\s*", "(kg|g)", "(oz|lbs?)"
    part = lambda p, *at: weight_grams(F.concat(*[F.regexp_extract(t, p, i) for i in at]))
    pouches = rf"(?i)^\s*{num}{metric}\s*\(\s*([0-9]+)\s*[x×]\s*{num}{metric}\s+vac\s*seal(?:ed)?\s+pouch(?:es)?\s*\)\s*$"
    count = F.regexp_extract(t, pouches, 3).try_cast("int")
    total = F.when(count.between(1, 1000) & (part(pouches, 1, 2) == count * part(pouches, 4, 5)), part(pouches, 1, 2))
    both = []
    for first, second in ((other, metric), (metric, other)):
        for joint in (r"\(\s*{}\s*\)", r"/\s*{}"):
            p = rf"(?i)^\s*{num}{first}\s*" + joint.format(num + second) + r"\s*$"
            m, o = (part(p, 3, 4), part(p, 1, 2)) if second == metric else (part(p, 1, 2), part(p, 3, 4))
            both.append(F.when(F.abs(o - m) <= F.greatest(F.lit(2.0), m * 0.02), m))
    return F.coalesce(weight_grams(t), total, *both)


def tasting_notes(words: Column) -> Column:
    """array<struct<source, canonical, categories, status>> of a list of notes, every one of which stays in its own words.

    status is uncertain for what is only likened, mapped for a known note, else unmapped; null for null.
    """
    family = _pairs({n.replace("_", " "): F.split(F.lit(k), " ") for k, ns in NOTES.items() for n in ns.split()})
    same = _pairs(SAME_NOTE)

    def note(w: Column) -> Column:
        key = F.regexp_replace(F.lower(F.trim(w)), r"\s+", " ")
        name = F.coalesce(F.try_element_at(same, key), key)
        doubt = w.rlike(r"(?i)\?|maybe|hint of|reminiscent|like\b")
        known = F.when(~doubt, F.try_element_at(family, name))
        status = F.when(doubt, "uncertain").when(known.isNotNull(), "mapped").otherwise("unmapped")
        return F.struct(F.trim(w).alias("source"), F.when(known.isNotNull(), name).alias("canonical"), F.coalesce(known, F.array().cast("array<string>")).alias("categories"), status.alias("status"))

    return F.transform(words, note)


def note_list(text: Column) -> Column:
    """The notes of a text, set off by commas, semicolons or bars."""
    return F.split(text, r"[,;|]")
