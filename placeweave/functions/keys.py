"""Postcodes, names and match keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A postcode anywhere in a text, and as the whole text.
POSTCODE = r"\b(?:[A-Za-z][A-HJ-Ya-hj-y]?[0-9][0-9A-Za-z]? ?[0-9][A-Za-z]{2}|[Gg][Ii][Rr] ?0[Aa]{2})\b"
WHOLE_POSTCODE = r"^(?:[A-Za-z][A-HJ-Ya-hj-y]?[0-9][0-9A-Za-z]? ?[0-9][A-Za-z]{2}|[Gg][Ii][Rr] ?0[Aa]{2})$"
#: Words that begin no building's name.
GENERIC_WORDS = [
    "FLAT", "FLATS", "UNIT", "UNITS", "APARTMENT", "APARTMENTS", "PLOT", "LAND", "GARAGE", "GARAGES", "STORE", "STORES",
    "SUITE", "ROOM", "ROOMS", "PART", "SITE", "REAR", "FIRST", "SECOND", "THIRD", "GROUND", "BASEMENT", "THE SITE", "CAR",
    "PARKING", "AIRSPACE",
]
#: Words that end a street's name.
ROAD_SUFFIXES = [
    "Road", "Close", "Lane", "Street", "Drive", "Avenue", "Way", "Court", "Place", "Gardens", "Crescent", "Grove", "Hill",
    "Park", "Terrace", "Green", "Walk", "View", "Mews", "Bridge", "Rise", "Square",
]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squish(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def count_postcodes(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(POSTCODE))


def first_postcode(c: Column | str) -> Column:
    return F.regexp_substr(col(c), F.lit(POSTCODE))


def is_valid_postcode(c: Column | str) -> Column:
    return F.coalesce(F.trim(col(c)).rlike(WHOLE_POSTCODE), F.lit(False))


def normalise_postcode(c: Column | str) -> Column:
    return empty_to_null(F.upper(F.regexp_replace(col(c), "[^A-Za-z0-9]", "")))


def normalise_name(c: Column | str) -> Column:
    return empty_to_null(squish(F.regexp_replace(F.upper(col(c)), "[^A-Z0-9 ]", " ")))


def house_number(address: Column | str) -> Column:
    """The number that an address begins with, and its letter."""
    return F.upper(F.regexp_substr(col(address), F.lit(r"^[0-9]+[A-Za-z]?\b")))


def first_segment(address: Column | str) -> Column:
    return F.regexp_substr(col(address), F.lit("^[^,]+"))


def street_name(address: Column | str) -> Column:
    """The street after a leading house number; null without a number or for under four letters.

    Brackets after the number go, a phrase that repeats itself at once is kept once, and a first
    segment that is only the number gives way to the second.
    """
    number = r"^\s*[0-9]+[A-Za-z]?\b"
    segment = first_segment(address)
    street = F.regexp_replace(segment, number + r"[\s,]*", "")
    street = squish(F.regexp_replace(street, r"^\([^()]*\)\s*", ""))
    street = F.regexp_replace(street, r"^(.*?)\s+\1\b.*$", "$1")
    second = squish(empty_to_null(F.regexp_extract(col(address), r"^[^,]+,\s*([^,]+)", 1)))
    street = F.when(street == "", second).otherwise(street)
    return F.when(segment.rlike(number) & (F.length(street) >= 4), street)


def building_name(address: Column | str) -> Column:
    """The leading segment if it can name a building: four letters, no leading digit or generic word."""
    segment = first_segment(address)
    name = normalise_name(segment)
    word = F.regexp_substr(name, F.lit("^[A-Z0-9]+"))
    good = (F.length(name) >= 4) & ~name.rlike("^[0-9]") & ~word.isin(GENERIC_WORDS)
    return F.when(good, squish(segment))


def buried_street(address: Column | str) -> Column:
    """The last capitalised phrase that ends in a street word, wherever it stands."""
    words = r"[A-Z][A-Za-z'-]*(?:\s+[A-Z][A-Za-z'-]*){0,4}\s+(?:" + "|".join(ROAD_SUFFIXES) + r")\b"
    return F.try_element_at(F.regexp_extract_all(col(address), F.lit(words), F.lit(0)), F.lit(-1))


def match_key(address: Column | str, postcode: Column | str) -> Column:
    """POSTCODE|NUMBER; null if either part is."""
    return F.concat(normalise_postcode(postcode), F.lit("|"), house_number(address))


def building_key(address: Column | str, postcode: Column | str) -> Column:
    return F.concat(normalise_postcode(postcode), F.lit("|"), normalise_name(building_name(address)))


def street_number_key(number: Column | str, street: Column | str, district: Column | str) -> Column:
    return F.concat(normalise_name(district), F.lit("|"), normalise_name(street), F.lit("|"), F.upper(col(number)))


def osm_tag(tags: Column | str, key: str) -> Column:
    """A value of a ``"key"=>"value"`` list; null if missing or empty."""
    return empty_to_null(F.regexp_extract(col(tags), f'"{key}"=>"([^"]*)"', 1))


def is_substation(address: Column | str) -> Column:
    return F.coalesce(col(address).rlike(r"(?i)\bsub[- ]?stations?\b"), F.lit(False))


def flat_base(address: Column | str) -> Column:
    """The building that a numbered flat is in, upper case; null unless its name says it is one."""
    text = F.coalesce(col(address), F.lit(""))
    base = F.regexp_replace(text, r"(?i)^\s*(?:flats?|apartments?|apt|unit)?\s*,?\s*[0-9]+[a-z]?\s*(?:,\s*|\s+)", "")
    first = F.upper(F.trim(F.regexp_replace(base, ",.*$", "")))
    building = r"\b(HOUSE|COURT|LODGE|TOWERS?|MANSIONS?|HEIGHTS|POINT|HALL|APARTMENTS|BUILDINGS?|BLOCK|CHAMBERS)$"
    return F.when((base != text) & (base != "") & first.rlike(building), F.upper(squish(base)))


#: Signs of a legal description rather than an address.
LEGALESE = (
    "filed at the registry|filed plan|registered under title|title number|deed dated|acts? (of )?(18|19|20)[0-9]{2}|"
    "perpetuity|easement|rentcharge|rent charge"
)
STOP_WORDS = r"\b(the|of|and|to|as|is|for|in|by|with|on|or|any|all|such|so|much)\b"


def geocodability(address: Column | str, postcode: Column | str) -> Column:
    """"ok", or why an address is not worth a geocoder's call; the most specific reason wins."""
    text = F.coalesce(col(address), F.lit(""))
    located = F.coalesce(col(postcode) != "", F.lit(False))
    words = F.regexp_count(text, F.lit(r"\S+"))
    stops = F.regexp_count(text, F.lit("(?i)" + STOP_WORDS))
    bare = F.trim(text).rlike("^[0-9]+[A-Za-z]?$") | ~text.rlike("[A-Za-z]")
    return (
        F.when(text == "", "empty")
        .when(text.rlike("@[A-Za-z]+"), "residual_tag")
        .when(bare & ~located, "bare_number_no_postcode")
        .when((F.length(text) < 5) & ~located, "too_short")
        .when(text.rlike(r"(?i)^Properties at\b"), "multi_property_list")
        .when(text.rlike("(?i)" + LEGALESE) & (F.length(text) > 90), "legalese")
        .when((words > 8) & (stops / F.greatest(words, F.lit(1)) > 0.45), "legalese")
        .otherwise("ok")
    )
