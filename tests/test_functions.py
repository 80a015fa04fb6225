"""Text, number and coordinate functions on known cases."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placeweave.functions import boilerplate as B
from placeweave.functions import geo as G
from placeweave.functions import geocoder, numbers, phrases
from placeweave.functions import keys as K
from placeweave.functions.similarity import jaro


def run(spark, function, *values, kind="string"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    names = [f"c{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} {kind}" for n in names))
    return [r["v"] for r in df.select("i", function(*map(F.col, names)).alias("v")).orderBy("i").collect()]


CASES = [
    (B.tidy, "@ASP Harbour Parade", "Harbour Parade"),
    (B.tidy, "the site of Kiln Hill, Ashby", "Kiln Hill, Ashby"),
    (B.tidy, "and 27 Cooper Row (); Truro", "27 Cooper Row; Truro"),
    (B.tidy, "being a Boathouse on Quay Road, Bude", "a Boathouse on Quay Road, Bude"),
    (B.tidy, "east of Linden Grove, Wells", "Linden Grove, Wells"),
    (B.tidy, "7 Castle Terrace and", "7 Castle Terrace"),
    (B.tidy, "Gatehouse, Priory Walk", "Gatehouse, Priory Walk"),
    (K.street_name, "41 Larch Crescent, Derby", "Larch Crescent"),
    (K.street_name, "9, Tannery Road, Hull", "Tannery Road"),
    (K.street_name, "3 (Both halves) Barley Road", "Barley Road"),
    (K.street_name, "Heron Lodge, Marsh Lane", None),
    (K.street_name, "77 Quarry Road Quarry Road and pump house Quarry Road", "Quarry Road"),
    (K.buried_street, "Meadow beside Tinker Lane, south of Pear Street", "Pear Street"),
    (K.building_name, "Flat 9, 22 Orchard Road", None),
    (K.flat_base, "Flat 12, Mariner Court,  8 Wharf Road", "MARINER COURT, 8 WHARF ROAD"),
    (K.flat_base, "6 Weir Fold, Settle", None),
]


@pytest.mark.parametrize(("function", "text", "want"), CASES)
def test_text(spark, function, text, want):
    assert run(spark, function, text, None)[0] == want


def test_keys(spark):
    assert run(spark, K.match_key, ("52 Rowan Close, Derby", "DE1 9ZZ"), ("52 Rowan Close", None), ("Heron", "DE1 9ZZ")) == ["DE19ZZ|52", None, None]
    assert run(spark, K.building_key, ("Heron Lodge, Marsh Lane, Ely", "CB7 0QQ"), ("Flat 9, 22 Orchard Road", "CB7 1QQ"), ("22 Orchard Road", "CB7 1QQ")) == ["CB70QQ|HERON LODGE", None, None]
    assert run(spark, K.street_number_key, ("41", "Larch Crescent", "Derby"), ("1", None, "x")) == ["DERBY|LARCH CRESCENT|41", None]
    assert run(spark, lambda c: K.osm_tag(c, "addr:street"), '"k"=>"v","addr:street"=>"Fen Causeway"', '"k"=>"v"', None) == ["Fen Causeway", None, None]
    assert run(spark, K.is_substation, "Old Sub Station, Wharf Road", "9 Tannery Road, Hull", None) == [True, False, False]
    assert run(spark, K.is_valid_postcode, " DE1 9ZZ ", "DE1 9ZZ x", "", None) == [True, False, False, False]


def test_boilerplate_tags(spark):
    clean = lambda f, t: run(spark, f, t, None)[0]
    out = clean(B.clean_mines, "all mines and minerals as excepted filed at the Registry 18 Tannery Road, Hull")
    assert "@MNS" in out and "18 Tannery Road, Hull" in out
    two = "The mines filed at the Registry being 6A Wharf Road, Goole the minerals deed dated 1"
    assert "6A Wharf Road" in clean(B.clean_mines, two)
    assert "@ASP" in clean(B.clean_airspace, "The airspace above 30 Quay Road, Bude")
    assert "@FTS" in clean(B.clean_flats, "the fifth floor being 61 Parade, Truro")
    assert "@ASP" in clean(B.clean_roof_basement, "the north-facing roof, 2 Castle Terrace")
    assert clean(B.clean_roof_basement, "Roof Gardens, 15 Quay Road") == "Roof Gardens, 15 Quay Road"
    assert clean(B.clean_spelling, "Sub Station, Wharf Road") == "substation, Wharf Road"
    assert clean(B.clean_boilerplate, "x") == "x"


def test_geocodability(spark):
    long = "the rights of the easement in and over and under all of the land and of the buildings and to the use of it as is on the filed plan"
    rows = [("@MNS", None), ("Properties at 8 Larch Crescent", None), ("44", None), ("44", "DE1 9ZZ"), ("9 Tannery Road, Hull", None), (long, None), ("", None), (None, None), ("abc", None)]
    assert run(spark, K.geocodability, *rows) == ["residual_tag", "multi_property_list", "bare_number_no_postcode", "ok", "ok", "legalese", "empty", "empty", "too_short"]


NUMBERS = {
    "20 to 26 (even) Larch Crescent": ["20 Larch Crescent", "22 Larch Crescent", "24 Larch Crescent", "26 Larch Crescent"],
    "7 to 11 (Odd) Quay Road": ["7 Quay Road", "9 Quay Road", "11 Quay Road"],
    "B2-00417, Heron B Block, Marsh Lane, Ely": ["B2-00417, Heron B Block, Marsh Lane, Ely"],
    "3-9000 Wharf Road": ["3-9000 Wharf Road"],
    "58a and 58b Barley Road, Goole": ["58a Barley Road, Goole", "58b Barley Road, Goole"],
    "2, 4 and 8 Weir Fold and 13 Kiln Hill": ["2 Weir Fold", "4 Weir Fold", "8 Weir Fold", "13 Kiln Hill"],
    "Unit 6, 31 Tannery Road": ["Unit 6, 31 Tannery Road"],
    "9 Castle Terrace": ["9 Castle Terrace"],
}


@pytest.mark.parametrize(("text", "want"), NUMBERS.items())
def test_split_numbers(text, want):
    assert [" ".join(x.split()) for x in numbers.split_numbers(text)] == want


def test_expand_numbers():
    assert numbers.expand_numbers([("20", False, False, ""), ("26", True, True, "(EVN)")]) == ["20", "22", "24", "26"]
    assert numbers.expand_numbers([("3", False, False, ""), ("9000", True, False, "")]) is None
    assert numbers.expand_numbers([("40", False, False, ""), ("43", True, True, "(EVN)")]) == ["40", "43"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0123456789 abcdeEvenOddincluso-(),&", max_size=40))
def test_split_numbers_never_raises(text):
    out = numbers.try_split(text)
    assert out is None or len(out) <= 700 * (len(text) + 1)


def test_phrases(spark):
    clean = phrases.phrase_cleaner([("being part of", None), ("part of", "x"), ("east of", "f"), (None, None)])
    texts = ["BEING PART OF 9 Quay Road dated 6 June 1988", "east of Bude", None, "land £3,400 numbered 2 on the filed plan"]
    assert run(spark, clean, *texts) == ["9 Quay Road", "east of Bude", None, "land"]
    assert run(spark, phrases.matching_phrases(["quay", "quay road", "bude"]), "9 quay road", "x", None) == ["quay road", None, None]


def test_jaro_equals_the_database(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("ABCDE ") for _ in range(rng.randrange(1, 12))), "".join(rng.choice("ABCDE ") for _ in range(rng.randrange(1, 12)))) for _ in range(400)]
    db = duckdb.connect()
    for a, b in pairs + [("QUAY ROAD", "QUAY RD")]:
        assert jaro(a, b) == pytest.approx(db.execute("SELECT jaro_similarity(?, ?)", [a, b]).fetchall()[0][0], abs=1e-9)
        assert 0 <= jaro(a, b) <= 1


def test_coordinates():
    lat, lon = math.radians(52 + 39 / 60 + 27.2531 / 3600), math.radians(1 + 43 / 60 + 4.5177 / 3600)
    east, north = G.project(lat, lon)
    assert (round(float(east), 3), round(float(north), 3)) == (651409.903, 313177.270)
    x, y = np.array([430000.0, 530000.0]), np.array([433000.0, 180000.0])
    la, lo = G.to_degrees(x, y)
    back = G.to_grid(la, lo)
    assert np.allclose(back[0], x, atol=1e-3) and np.allclose(back[1], y, atol=1e-3)
    assert abs(la[1] - 51.503) < 0.01 and abs(lo[1] + 0.128) < 0.01


def test_geocoder_answers(spark):
    answer = '{"batchItems":[{"features":[{"properties":{"type":"Address","confidence":"High","matchCodes":["Good","Up"],"address":{"addressLine":"9 Quay Road","adminDistricts":[{"shortName":"ENG"},{"name":"Bude"}]}},"geometry":{"coordinates":[-4.5,50.8]}}]},{"error":{"code":"x"}},{"features":[]}]}'
    found = run(spark, geocoder.parse_answer, answer)[0]
    assert found[1] is None and found[2] is None
    assert (found[0]["latitude"], found[0]["longitude"], found[0]["adminDistrict"], found[0]["adminDistrict2"], found[0]["matchCodes"]) == (50.8, -4.5, "ENG", "Bude", "Good,Up")
    assert run(spark, lambda a: geocoder.batch_item(a, F.lit(None).cast("string"), F.lit("")), "9 Quay Road")[0] == '{"addressLine":"9 Quay Road","countryRegion":"GB"}'
    url = spark.range(1).select(geocoder.build_url("http://x/y", {"q": "a b", "n": None, "k": 3}).alias("u")).first()["u"]
    assert url == "http://x/y?q=a+b&k=3"
