"""Addresses: parsing of notations, slips of letters, gazetteer, pairs, edges."""

import random

import pytest

from tamis.llm import addresses as A
from tamis.llm.addressparse import parse

SCHEMA = "store_id bigint, address1 string, address2 string, city string, region string, postal_code string, country string, form string, n int"
SAME = [
    [("1099 Magnolia Boulevard S", None, "Aldfield", None, "16199", "United States"), ("1099 South Magnolia Blvd.", None, "ALDFIELD", "CO", "16199-1234", "us"), ("S Magnolia Boul, 1099, Aldfield", "Ground Floor", None, None, "16199", None)],
    [("Eichendorff-Allee 361", None, "Aldhausen", "HH", "08453", "Germany"), ("361 eichendorffallee", "1. OG", "Aldhausen", None, None, "Deutschland")],
    [("Mühlenstraße 12b", None, "Aldhausen", None, "08453", "DE"), ("muehlenstr. 12 B", None, "Aldhausen", None, "08453", "GER")],
    [("C/ de la Constancia 601", None, "Aldaleda", None, "04804", "Spain"), ("601 Calle Constancia", "local bajo", "Aldaleda", "Murcia", None, "España")],
    [("N° 91 av. de la Gare", None, "Aldigny", None, "FR-04809", "France"), ("91 Avenue de la Gare", None, "Aldigny", None, "4809", "FR")],
    [("301 St. Aldwyn's Rd", None, "Aldbury", "Kent", "QB1 9AP", "UK"), ("301, Saint Aldwyn Road", None, "Aldbury", None, "qb19ap", "England")],
    [("181 Twelfth Str", "Suite 7", "Aldville", "TX", "38740", "USA"), ("Ste 7, 181 12th Street", None, "Aldville", None, "38740", "U.S.A."), ("181 12TH ST #7", None, "Aldville", "TX", None, "US")],
]
OTHER = [
    ("1101 South Magnolia Boulevard", None, "Aldfield", "CO", "16199", "US"), ("1099 North Magnolia Boulevard", None, "Aldfield", "CO", "16199", "US"), ("1099 South Magnolia Avenue", None, "Aldfield", "CO", "16199", "US"), ("1099 South Magnolia Boulevard", None, "Pellfield", "CO", "71633", "US"),
    ("Mühlenstraße 12", None, "Aldhausen", None, "08453", "DE"), ("181 12th Street", "Suite 8", "Aldville", "TX", "38740", "US"), ("181 12th Street", None, "Aldville", "TX", "38740", "US"), (None, None, "Aldville", None, None, "US"), ("", "", "", "", "", ""), ("rue sans numéro", None, "Aldigny", None, None, "FR"), ("x" * 5000, None, None, None, None, None),
]


def pairs(spark, rows):
    df = spark.createDataFrame([(i, *r, "x", 1) for i, r in rows], SCHEMA)
    return {(r[0], r[1]) for r in A.same_place(df).collect()}


def test_same_and_other(spark):
    rows, want, i = [], set(), 0
    for group in SAME:
        ids = list(range(i, i + len(group)))
        rows += zip(ids, group)
        want |= {(a, b) for a in ids for b in ids if a < b}
        i += len(group)
    rows += list(enumerate(OTHER, 1000))
    assert pairs(spark, rows) == want


def test_slips(spark):
    # frequent spellings of a street and a town, and one slip of each
    many = [(i, (f"{i} Brewster Road", None, "Elkville", "TX", "38100", "US")) for i in range(1, 30)]
    slips = [(101, ("7 Brewtser Rd", None, "Elkville", "TX", "38100", "US")), (102, ("8 Brewster Rd.", None, "Elkvillle", "TX", "38100", "US")), (103, ("9 brewste road", None, None, None, "38100", "US"))]
    assert pairs(spark, many + slips) == {(7, 101), (8, 102), (9, 103)}


def test_slips_of_rare_towns(spark):
    # one record each: a common postal code joins the spellings, also over a third one, but not without it
    rows = [(1, ("499 Mt Belden Avenue W", None, "Driftwood", "MN", "38957", "US")), (2, ("499 W MT BELDEN AV", None, "DRIRTWOOD", "MN", "38957", "US")), (3, ("499 W Mt Belden Ave", None, "Drirtwod", None, "38957", "US"))]
    other = [(4, ("43 Rue des Forges", None, "Ormskosiac", None, "90532", "FR")), (5, ("43 Rue des Forges", None, "Ormskossac", None, "90611", "FR"))]
    assert pairs(spark, rows + other) == {(1, 2), (1, 3), (2, 3)}


def test_a_wrong_code_joins_no_towns(spark):
    # two towns one slip apart stay two, though one record has the other's code; a code of one slip only still leads to its town
    rows = [(i, (f"{i % 10} Brewster Road", None, town, "TX", code, "US")) for i, (town, code) in enumerate([("Elkham", "38100")] * 10 + [("Elkhan", "47200")] * 8)]
    rows += [(18, ("8 Brewster Road", None, "Elkhan", "TX", "38100", "US")), (20, ("3 Oak Road", None, "Driftwood", None, "51000", "US")), (21, ("3 Oak Road", None, "Drifwood", None, "51000", "US")), (22, ("4 Oak Road", None, "Drifwood", None, "52000", "US")), (23, ("4 Oak Road", None, None, None, "52000", "US"))]
    assert pairs(spark, rows) == {(20, 21), (22, 23)}


def test_streets_one_slip_apart(spark):
    # Hill Road is frequent in the country, but Mill Road has numbers of its own in Elkville; that of Aldfield is a slip, though made twice
    rows = [(i, (f"{i} Hill Road", None, "Aldfield", "TX", "16199", "US")) for i in range(1, 20)] + [(i, ("7 Mill Road", None, "Aldfield", "TX", "16199", "US")) for i in (20, 21)]
    rows += [(30, ("12 Hill Road", None, "Elkville", "TX", "38100", "US")), (31, ("12 Mill Road", None, "Elkville", "TX", "38100", "US"))] + [(i, (f"{i} Mill Rd", None, "Elkville", "TX", "38100", "US")) for i in (32, 33)]
    assert pairs(spark, rows) == {(7, 20), (7, 21), (20, 21)}


def test_hot_place_and_repeats(spark):
    rows = [(i, ("5 Main Street", None, "Elkville", "TX", "38100", "US")) for i in range(40)] + [(3, ("5 Main Street", None, "Elkville", "TX", "38100", "US")), (None, ("5 Main Street", None, "Elkville", "TX", "38100", "US"))]
    assert pairs(spark, rows) == {(a, b) for a in range(40) for b in range(a + 1, 40)}


def test_empty(spark):
    assert pairs(spark, []) == set()


@pytest.mark.parametrize("line, country, want", [
    ("433 A Chandler St", "GB", ("chandler", "street", "", "433a")), ("601C E 12TH AV", "US", ("12th", "avenue", "e", "601c")), ("S. Exchange Ave, 4717", "US", ("exchange", "avenue", "s", "4717")), ("259 Quayside La", "UK", ("quayside", "lane", "", "259")),
    ("weinbergpl. 301", "Germany", ("weinberg", "place", "", "301")), ("Twenty-First Ave 12", "US", ("21th", "avenue", "", "12")), ("12 West Street", "US", ("west", "street", "", "12")), ("Avda. Sta. Ubalda 709", "ES", ("santaubalda", "avenue", "", "709")),
    ("12 St. Orin St", "US", ("saintorin", "street", "", "12")), ("4 Dr. Amsel Dr", "US", ("doctoramsel", "drive", "", "4")),
])
def test_parts(line, country, want):
    p = parse(line, None, "X", None, None, country)
    assert (p.street, p.kind, p.direction, p.number) == want


def test_rare_streets_beside_frequent_ones_stand(spark):
    # a street that is frequent in the country one letter from a rare one, each once in a town, at one number
    rows = [(i, f"Hallerstrasse {i}", None, "Neustadt", None, None, "DE") for i in range(1, 25)]
    rows += [(101, "Hillerstrasse 90", None, "Kassel", None, None, "DE"), (102, "Hallerstrasse 90", None, "Kassel", None, None, "DE"), (103, "Hillerstr. 90", None, "Kassel", None, None, "Germany")]
    df = spark.createDataFrame(rows, "store_id bigint, address1 string, address2 string, city string, region string, postal_code string, country string")
    assert {tuple(r) for r in A.same_place(df).collect()} == {(101, 103)}


def test_precision_holds_as_data_grow(spark):
    # towns that have two true streets one letter apart, in ever more of them: none of them may join, however frequent the one is
    r = random.Random(2)
    for towns in (4, 80):
        rows, n = [], 0
        for t in range(towns):
            town = "".join(r.choice("bdfgklmnprst") + r.choice("aeiou") for _ in range(6)).title()
            for street, numbers in (("Miller Road", range(1, 9)), ("Tiller Road", (11, 13) if t % 2 else (5,))):
                for no in numbers:
                    n += 1
                    rows.append((n, f"{no} {street}", None, town, "OR", f"{97000 + t}", "US"))
        df = spark.createDataFrame(rows, "store_id bigint, address1 string, address2 string, city string, region string, postal_code string, country string")
        got = A.same_place(df).count()
        # of a lone number that both streets have, a slip can't be told from a street; that is one pair in every other town at most
        assert got <= towns // 2, (towns, got)
