"""Legal boilerplate in property descriptions, replaced by tags; as Column expressions.

The order of ``clean_boilerplate`` is part of the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import col, squish


def one_of(words: list[str]) -> str:
    """Alternatives in the given order."""
    return "(?:" + "|".join(words) + ")"


def longest_first(words: list[str]) -> str:
    """A word-bounded choice that prefers longer phrases."""
    return r"\b" + one_of(sorted(dict.fromkeys(words), key=lambda w: -len(w))) + r"\b"


def swap(c: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(c, "(?i)" + pattern, by)


#: How descriptions of air space begin and end.
AIRSPACE_START = ["the airspace", "airspace", "being the air space", "the air space", "air space", "Being airspace"]
AIRSPACE_END = ["being", "being roof", "roof of", "foor of", "the roof", "surface of", "roof surface", "above", "over"]
#: How descriptions of mines and minerals begin and end.
MINES_START = [
    "all and singular the mines", "all and singular and such of the mines", "all and every the mines",
    "all and all manner of mines", "all and singular the stone and underground mines", "all beds",
    "all carboniferous minerals", "all clay", "all coal iron", "all gypsum and", "all gypsum within", "all iron stone",
    "all Ironstone and", "all lead", "all manner of mines", "all metal ores", "all metallic minerals", "all metals ores",
    "all minerals", "all mines", "all other Mines", "all quarries", "all Royal Mines", "all sand", "all slate",
    "all stone", "All such clay", "all such ironstone", "all such mines", "all surface clay", "all that gypsum",
    "all the mines", "all the Royal Mines", "all those mines", "all those sand", "all those ungotten", "all Tin",
    "all waste material", "an Easement", "any mines", "and to be opened", "as to such parts", "Being the sratum",
    "gypsum and anhydrite", "in all mines", "Ironstone and", "mines and minerals", "minerals and mineral", "mines beds",
    "mines minerals", "Mines of", "mines quarries", "mines seams", "mines, minerals", "minerals lying below",
    "of the land tinted", "of using so", "of using the", "Royal mines", "sand gravel", "sand, gravel", "shown and",
    "shown by a red", "shown by red", "shown edged with red", "so much of the", "stratum of", "the beds seams",
    "The Freehold", "the gypsum", "the lead", "the mine", "the minerals", "the mines", "the ore mines",
    "the Royal Mines", "the strata of", "the stratrum of", "using the subsoil", "clay slate stone",
    "evaporites including",
]
MINES_END = [
    "filed at the Registry", "construction thereof", "marked X on the filed plan", "marked Y on the filed plan",
    "deed dated", "registered under Title", "the level of",
]
#: Compass words, longer forms before the words they begin with.
COMPASS = [
    "northerly", "easterly", "southerly", "westerly", "northern", "eastern", "southern", "western", "northeast",
    "southeast", "northwest", "southwest", "northeastern", "southeastern", "northwestern", "southwestern", "north-east",
    "south-east", "north-west", "south-west", "north east", "south east", "north west", "south west", "north-eastern",
    "south-eastern", "north-western", "south-western", "north eastern", "south eastern", "north western",
    "south western", "north", "east", "south", "west",
]
COMPASS_END = ["of", "side of", "sides of", "corner of", "junction of", "side", "boundary of"]


def clean_airspace(c: Column) -> Column:
    return swap(c, rf"\b{one_of(AIRSPACE_START)}\b.{{0,150}}?\b{one_of(AIRSPACE_END)}\b", "@ASP")


def clean_mines(c: Column) -> Column:
    return swap(c, rf"\b{one_of(MINES_START)}\b.{{0,300}}?\b{one_of(MINES_END)}\b", "@MNS")


def clean_compass(c: Column) -> Column:
    way, end = one_of(COMPASS), one_of(COMPASS_END)
    c = swap(c, f"(?:the|on) {way} {end}", "@COMPASS")
    return swap(c, f"(?:the|on) {way}(?: and | side and | ){way} {end}", "@COMPASS")


#: Misspellings and variants, each with the form that replaces them.
SPELLINGS = [
    (r"\b(?:adjoing|adjoingin|adjoinining|adjoinng|adjoning|ajoining)\b", "adjoining"),
    (r"\bsituate\b", "situated"),
    (r"\b(?:the |an? )?electricity sub[- ]?stations?\b|\b(?:the |an? )?sub[- ]?stations?\b", "substation"),
    (r"\b(?:airpsace|aorspace|airpace)\b", "airspace"),
]


def clean_spelling(c: Column) -> Column:
    for pattern, form in SPELLINGS:
        c = swap(c, pattern, form)
    return c


#: The parts of phrases for land, what goes with it, and where it lies.
LAND_LEAD = ["", "the", "a", "being", "and adjoining"]
LAND_KIND = ["", "garden", "front garden", "glebe", "highway", "amenity", "strip of"]
EXTRAS = [
    "and building", "and buildings", "and barn", "and barns", "and flat", "and flats", "and apartment", "and apartments",
    "and apartment block", "and premises", "and properties", "and property", "and garage", "and garages", "and parking",
    "and car parking", "and car parking spaces", "and parking spaces", "and factory", "and factory buildings",
    "and footpaths", "and foreshore", "and houses", "and open spaces", "and part of building", "and part of",
    "farm house and buildings", "and farm house",
]
POSITIONS = [
    "lying", "lying to", "lying at", "lying between", "lying on", "at", "to the rear of", "on", "on the",
    "on the side of", "on the site of", "at the back", "at the back of", "at the corner of", "at the junction of",
    "associated with", "adjacent to", "adjoining", "adoining on", "abbuting", "abbuting on", "abbuting the", "fronting",
    "forming", "forming part of", "forming the site of", "forming the forecourt of", "forming the forecourts of",
    "forming the roadway", "formerly known as", "formerly part of", "formerly the site of", "known as", "part of",
    "situated at", "situated on", "site of", "side of", "either side of", "and the",
]


def clean_land(c: Column) -> Column:
    land = [" ".join(f"{a} {b} land".split()) for b in LAND_KIND for a in LAND_LEAD]
    for words, tag in ((land, "@LND"), (EXTRAS, "@EXTRA"), (POSITIONS, "@POS")):
        c = swap(c, longest_first(words), tag)
    return c


def clean_roof_basement(c: Column) -> Column:
    way = "(?:north|south|east|west|north[- ]?(?:east|west)|south[- ]?(?:east|west))"
    end = r"(?:\s*,)?(?:\s+\b(?:of|being)\b)?"
    c = swap(c, rf"\bthe\s+(?:{way}[- ]facing\s+)?roof\b(?:\s+(?:space|void|area|level|terrace))?{end}", "@ASP")
    return swap(c, rf"\bthe\s+basement\b(?:\s+(?:area|level|flat|floor))?{end}", "@ASP")


#: The parts of phrases for floors and flats.
FLOORS = [
    "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "eight", "ninth", "tenth", "eleventh",
    "twelfth", "thirteenth", "fourteenth", "1st", "2nd", "3rd", "4th", "5th", "6th", "7th", "8th", "9th", "10th",
    "11th", "12th", "13th", "14th", "ground", "basement", "mezzanine", "lower ground", "sub-basement", "top",
]
FLAT_KINDS = [
    "premises", "room?", "unit?", "suite?", "office?", "flats?", "apartments?", "storage pod?", "store pods?", "shops?",
    "shop and rear yard", "basement?",
]
FLAT_LEAD = ["lower ground", "ground", "the flat", "the", "a"]
FLAT_END = ["being", "floors", "floors being", "floor being", "of"]


def clean_flats(c: Column) -> Column:
    lead = f"(?:{longest_first(FLAT_LEAD)})?"
    floor, join = longest_first(FLOORS), longest_first(["to", "and"])
    kinds = [f"floor {k}" for k in FLAT_KINDS]
    end = longest_first(FLAT_END + kinds + [f"{k} being" for k in kinds])
    kind, short = longest_first(FLAT_KINDS), longest_first(FLAT_END)
    for pattern in (
        f"{lead} {join} {floor} {end}",
        f"{lead} {floor} {join} {floor} {end}",
        f"{lead} {floor} {end}",
        f"^(?:{lead} )?{floor} {join} {floor} {end}",
        f"^(?:the )?{floor} floor {kind}(?: {short})?",
        rf"^(?:the )?{floor} floor(?: level| flats?)?,?(?: \b(?:of|being|offices?|hallways?|garages?)\b)?",
        f"^(?:the )?{kind} is {floor} floor",
    ):
        c = swap(c, pattern, "@FTS")
    return c


def clean_boilerplate(c: Column | str, long_phrases=None, phrases=None) -> Column:
    """All steps in their order; ``long_phrases`` and ``phrases`` are Column functions (see ``phrases``)."""
    c = col(c)
    for step in (
        long_phrases, clean_mines, clean_spelling, clean_compass, clean_land, clean_flats, clean_roof_basement,
        clean_airspace, phrases,
    ):
        c = step(c) if step else c
    return c


def tidy(c: Column | str) -> Column:
    """An address without tags, empty or stray brackets, runs of commas, and words left over at its ends."""
    c = F.regexp_replace(col(c), "@[A-Za-z]+", " ")
    c = F.regexp_replace(c, r"\(\s*\)", " ")
    uneven = F.regexp_count(c, F.lit(r"\(")) != F.regexp_count(c, F.lit(r"\)"))
    c = F.when(uneven, F.regexp_replace(c, r"^[\s,;]*\(+|\)+[\s,;]*$", "")).otherwise(c)
    c = F.regexp_replace(c, r"\s*[,;]\s*(?=[,;])", "")
    glue = (
        r"(?i)^[\s\p{P}]*((and|of|at|on|to|off|being|adjoining|adjacent to|the site of|site of|the rear of|rear of|land at|"
        r"forming|formerly|(the |on the )?(north|south|east|west)([ -](east|west))?(ern)?( side| end| corner)? of)\b[\s\p{P}]*)+"
    )
    for _ in range(3):
        c = F.regexp_replace(c, glue, "")
    c = F.regexp_replace(c, r"(?i)([\s\p{P}]+\b(and|of|at|on|being|to|the)\b)+[\s\p{P}]*$", "")
    c = squish(F.regexp_replace(c, r"\s+([,;.])", "$1"))
    c = F.regexp_replace(c, r"^[\p{Punct}\s]+", "")
    return F.regexp_replace(c, r"[,;\s]+$", "")
