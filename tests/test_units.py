"""Quantities in different units: goldens of titles and notes, and the edges every operator has to stand."""

import pytest

from tamis.operators.units import net_quantities, source_units

FEEDS = [
    ("kilo", "Ohne Angabe sind alle Gewichte in Kilogramm."), ("ounce", "The column called grams was mapped from an ounce field years ago."), ("gross", "grams is what the courier is billed for, box and filling included."),
    ("default", "Default parcel weight is filled in for every variant."), ("silent", None), ("milli", "grams: lab export, values are milligrams."), ("korean", "단위가 없으면 중량은 그램입니다."), ("empty", ""),
]
VARIANTS = "id string, source string, title string, grams int, weight double, weight_unit string, note string"


@pytest.fixture(scope="module")
def feeds(spark):
    return spark.createDataFrame(FEEDS, "source string, export_note string")


def net(spark, feeds, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], VARIANTS)
    return {r["id"]: r["net"] for r in net_quantities(df, feeds).collect()}


def test_source_units(feeds):
    got = {r["source"]: (r["weight_unit_default"], r["plain_unit"], r["plain_ok"]) for r in source_units(feeds).collect()}
    assert got == {"kilo": ("kg", "g", True), "ounce": (None, "oz", True), "gross": (None, "g", False), "default": (None, "g", False), "silent": (None, "g", True), "milli": (None, "mg", True), "korean": ("g", "g", True), "empty": (None, "g", True)}


TITLES = {
    "250g": 250, "Whole Bean / 12 oz": 340, "1 200 g": 1200, "1.200 g": 1200, "0,5 kg": 500, ".5 lb bag": 227, "½ kg": 500, "2½ lb": 1134, "2 1/2 lbs": 1134, "1/2 lb": 227, "Half-Pound": 227, "a pound": 454, "twelve ounce": 340,
    "mezzo chilo": 500, "un demi-kilo": 500, "ein halbes Kilo": 500, "cuarto de kilo": 250, "2 chili": 2000, "３００グラム": 300, "1㎏": 1000, "180그램 / 홀빈": 180, "1.5킬로": 1500, "(1-lb (454g)) French Press": 454, "12oz / 340 g": 340,
    "170 g – 6 oz.": 170, "8.8 oz (250g)(roast date 3/4)": 250, "Lot 160 - 750 g": 750, "9/16 Burundi SL28 2060m 0.5kg bag, OTL 4/3 - $41": 500, "350 g ~ 36 cups": 350, "1 lb (16 oz)": 454, "1 kg (1000 g)": 1000, "10OZ": 283, "250g/8.8oz": 250,
}
NOT = ["6 x 340 gr", "350 g. x 4", "2×250g", "200g (4-pack)", "5 bags of 75g", "Set of 6, 300g each", "250g + 500g", "250g + 250g", "100 Gr. - 400gr", "100-250 g", "2 oz. or 180 g", "250 g / 1 kg", "330 ml", "8 fl oz", "1 L concentrate", "10 capsules", "6 cans", "Box of 12 drip bags", "12oz / 500 g"]


def test_titles(spark, feeds):
    got = net(spark, feeds, [(t, "silent", t, None, None, None) for t in TITLES])
    assert got == TITLES


def test_titles_without_one_quantity(spark, feeds):
    assert net(spark, feeds, [(t, "silent", t, 100, 100.0, "g") for t in NOT]) == {}


def test_fields(spark, feeds):
    rows = [
        ("unit", "silent", "default", None, 0.25, "KG"), ("unit2", "silent", None, None, 8.0, "oz."), ("feed", "kilo", "x", None, 0.34, ""), ("feed2", "korean", "x", None, 500.0, None), ("nounit", "silent", "x", None, 5.0, None),
        ("plain", "silent", "x", 250, None, None), ("plain2", "ounce", "x", 12, None, None), ("plain3", "milli", "x", 250000, 0.0, None), ("gross", "gross", "x", 300, None, None), ("default", "default", "x", 125, None, None),
        ("fallback", "silent", "x", 200, 5.0, None), ("zero", "silent", "x", 0, 0.0, "g"), ("volume", "silent", "x", 100, 250.0, "ml"), ("title", "silent", "250 g", 999, 9.0, "kg"), ("nofeed", "unheard of", "x", 40, None, None), ("half", "silent", "x", None, 0.0005, "kg"), ("tiny", "silent", "x", None, 0.0004, "kg"),
    ]
    assert net(spark, feeds, rows) == {"unit": 250, "unit2": 227, "feed": 340, "feed2": 500, "plain": 250, "plain2": 340, "plain3": 250, "fallback": 200, "title": 250, "half": 1}


def test_edges(spark, feeds):
    assert net(spark, feeds, []) == {}
    rows = [(None, "silent", "250 g", 1, 1.0, "g"), ("a", None, None, None, None, None), ("b", "silent", "250 g", 3, None, None), ("b", "silent", "250 g", 3, None, None), ("c", "silent", "250g " + "x" * 200_000, None, None, None), ("d", "silent", "", None, None, "")]
    assert net(spark, feeds, rows) == {"b": 250, "c": 250}
    # extra columns with names that the operator uses inside don't matter
    df = spark.createDataFrame([("a", "silent", "2 lb", 1, 1.0, "g", 1, 2, 3, 4)], "id string, source string, title string, grams int, weight double, weight_unit string, k int, t int, m int, refused int")
    assert [tuple(r) for r in net_quantities(df, feeds).collect()] == [("a", 907)]
    assert net_quantities(df, feeds.filter("false")).count() == 1
