"""Districts by their published names, regions, samples around a place, and what joins older results to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import geo as G
from . import spatial

#: Parts of boundary names that the title register leaves out.
DROPPED = [" (B)", " BORO", " DISTRICT", " LONDON"]
#: Boundary names, without those parts, that the title register writes in another way.
RENAMED = {
    "ABERTAWE - SWANSEA": "SWANSEA",
    "BLAENAU GWENT - BLAENAU GWENT": "BLAENAU GWENT",
    "BRO MORGANNWG - THE VALE OF GLAMORGAN": "THE VALE OF GLAMORGAN",
    "CAERDYDD - CARDIFF": "CARDIFF",
    "CAERFFILI - CAERPHILLY": "CAERPHILLY",
    "CITY AND COUNTY OF THE CITY OF": "CITY OF LONDON",
    "CASTELL-NEDD PORT TALBOT - NEATH PORT TALBOT": "NEATH PORT TALBOT",
    "CITY OF LEICESTER": "LEICESTER",
    "CITY OF PORTSMOUTH": "PORTSMOUTH",
    "CITY OF SOUTHAMPTON": "SOUTHAMPTON",
    "CITY OF STOKE-ON-TRENT": "STOKE-ON-TRENT",
    "CITY OF WOLVERHAMPTON": "WOLVERHAMPTON",
    "THE CITY OF BRIGHTON AND HOVE": "BRIGHTON AND HOVE",
    "CONWY - CONWY": "CONWY",
    "GWYNEDD - GWYNEDD": "GWYNEDD",
    "CASNEWYDD - NEWPORT": "NEWPORT",
    "MERTHYR TUDFUL - MERTHYR TYDFIL": "MERTHYR TYDFIL",
    "POWYS - POWYS": "POWYS",
    "PEN-Y-BONT AR OGWR - BRIDGEND": "BRIDGEND",
    "SIR BENFRO - PEMBROKESHIRE": "PEMBROKESHIRE",
    "COUNTY OF HEREFORDSHIRE": "HEREFORDSHIRE",
    "SIR GAERFYRDDIN - CARMARTHENSHIRE": "CARMARTHENSHIRE",
    "SIR FYNWY - MONMOUTHSHIRE": "MONMOUTHSHIRE",
    "WRECSAM - WREXHAM": "WREXHAM",
    "SIR DDINBYCH - DENBIGHSHIRE": "DENBIGHSHIRE",
    "SIR Y FFLINT - FLINTSHIRE": "FLINTSHIRE",
    "RHONDDA CYNON TAF - RHONDDA CYNON TAF": "RHONDDA CYNON TAFF",
    "SIR YNYS MON - ISLE OF ANGLESEY": "ISLE OF ANGLESEY",
    "ST. HELENS": "ST HELENS",
    "ST. ALBANS": "ST ALBANS",
    "TORFAEN - TORFAEN": "TORFAEN",
    "SIR CEREDIGION - CEREDIGION": "CEREDIGION",
    "TELFORD AND WREKIN": "WREKIN",
}
#: Districts that became one authority.
MERGED = {
    "NORTH NORTHAMPTONSHIRE": ["CORBY", "EAST NORTHAMPTONSHIRE", "KETTERING", "WELLINGBOROUGH"],
    "WEST NORTHAMPTONSHIRE": ["DAVENTRY", "NORTHAMPTON", "SOUTH NORTHAMPTONSHIRE"],
}
#: Classes of road that no property stands on.
WITHOUT_PROPERTIES = ["Motorway", "Motorway, Collapsed Dual Carriageway", "Guided Busway Carriageway", "Shared Use Carriageway"]
#: Kinds of unit that a collaborator's addresses name; others are left out.
UNITS = ["apartment", "flat", "suite", "unit", "units", "room", "penthouse"]
#: Compass words and misspellings folded in older land descriptions, in this order, whatever their case.
FOLDS = [
    ("northern", "north"), ("southern", "south"), ("eastern", "east"), ("western", "west"),
    ("northly", "north"), ("southernly", "south"), ("easterly", "east"), ("westerly", "west"),
    ("north-east", "northeast"), ("south-east", "southeast"), ("north-west", "northwest"), ("south-west", "southwest"),
    ("north east", "northeast"), ("south east", "southeast"), ("north west", "northwest"), ("south west", "southwest"),
    (r"\badjoing\b", "adjoining"), (r"\badjoingin\b", "adjoining"), (r"\badjoinining\b", "adjoining"), (r"\bADJOINNG\b", "adjoining"),
    (r"\badjoning\b", "adjoining"), (r"\bajoining\b", "adjoining"),
]


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def canonical_district(name: Column | str) -> Column:
    """A boundary's name as the title register writes it."""
    out = F.upper(F.col(name) if isinstance(name, str) else name)
    for part in DROPPED:
        out = F.replace(out, F.lit(part), F.lit(""))
    return F.coalesce(F.try_element_at(_map(RENAMED), out), out)


def current_districts(bounds: DataFrame) -> DataFrame:
    """Boundaries (name, edges) under their canonical names, merged districts as one.

    The edges that merged neighbours share occur twice and cancel in the even-odd rule, so a
    merged district's edges are simply those of its parts; a name has a few parts at most.
    """
    home = _map({part: whole for whole, parts in MERGED.items() for part in parts})
    name = canonical_district("name")
    rows = bounds.select(F.coalesce(F.try_element_at(home, name), name).alias("name"), "edges")
    return rows.groupBy("name").agg(F.flatten(F.collect_list("edges")).alias("edges"))


def outer_box(bounds: DataFrame, margin: float = 1000.0) -> DataFrame:
    """The box around all boundaries (edges) and a margin: a hint for a geocoder."""
    low = lambda a, b: F.min(F.array_min(F.transform("edges", lambda e: F.least(e[a], e[b])))) - margin
    high = lambda a, b: F.max(F.array_max(F.transform("edges", lambda e: F.greatest(e[a], e[b])))) + margin
    return bounds.agg(low("x1", "x2").alias("x0"), low("y1", "y2").alias("y0"), high("x1", "x2").alias("x1"), high("y1", "y2").alias("y1"))


def in_region(points: DataFrame, bounds: DataFrame, names: list[str], point_id: str) -> DataFrame:
    """The rows of ``points`` (x, y) that lie in one of the named boundaries (name, edges)."""
    hits = spatial.points_in_polygons(points, bounds.filter(F.col("name").isin(names)), point_id, "name", 5000.0)
    return points.join(hits.select(F.col("point").alias(point_id)).distinct(), point_id, "left_semi")


def around(points: DataFrame, x: float, y: float, radius: float = 3000.0) -> DataFrame:
    """The rows of ``points`` (x, y) within a radius of a place, with their distance; a box reaches the scan as filters."""
    d = F.sqrt((F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y))
    box = F.col("x").between(x - radius, x + radius) & F.col("y").between(y - radius, y + radius)
    return points.filter(box).withColumn("distance", d).filter(F.col("distance") <= radius)


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in an order: examples for a report."""
    return df.orderBy(*order).limit(n)


def excludes_properties(classification: Column | str) -> Column:
    return F.coalesce((F.col(classification) if isinstance(classification, str) else classification).isin(WITHOUT_PROPERTIES), F.lit(False))


def address_status(df: DataFrame) -> DataFrame:
    """``df`` with address_status, the source of the real or else the inferred address, and has_address."""
    status = F.coalesce("best_address_source", "infill_address_source", F.lit("no_address"))
    return df.withColumns({"address_status": status, "has_address": status != "no_address"})


def failed_titles(register: DataFrame, results: DataFrame) -> DataFrame:
    """Titles of the register that have no result."""
    return register.join(results.select("Title Number").distinct(), "Title Number", "left_anti")


def with_owners(results: DataFrame, *registers: tuple[DataFrame, str | None]) -> DataFrame:
    """Results with their title's ownership, from registers with the country of those that do not tell it."""
    columns = ["Title Number", "Tenure", "Property Address", "Proprietor Name (1)", "Company Registration No. (1)", "Proprietorship Category (1)"]
    owners = None
    for register, country in registers:
        own = F.lit(country) if country else F.col("`Country Incorporated (1)`")
        rows = register.select(*[F.col(f"`{c}`") for c in columns], own.alias("Country"))
        owners = rows if owners is None else owners.unionByName(rows)
    return results.join(owners, "Title Number", "left")


def fold_compass(text: Column | str) -> Column:
    """Older land descriptions with one spelling of compass words and of "adjoining"."""
    out = F.col(text) if isinstance(text, str) else text
    for pattern, by in FOLDS:
        out = F.regexp_replace(out, f"(?i){pattern}", by)
    return out


def collaborator_address(unit_id: str = "unit_id", unit_type: str = "unit_type", building: str = "building_name", number: str = "street_number", street: str = "street_name") -> Column:
    """One line from the parts of a collaborator's table; a part that is null counts as empty."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    unit = F.when(F.col(unit_type).isin(UNITS), F.concat(F.col(unit_type), F.lit(" "), part(unit_id), F.lit(", "))).otherwise("")
    return F.concat(unit, part(building), F.lit(" "), part(number), F.lit(" "), part(street), F.lit(" "))


def runs(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Runs of equal values along an order: by, run (from 1), value, first, last, n.  A null equals a null."""
    w = W.partitionBy(by).orderBy(order)
    new = F.when(F.lag(order).over(w).isNotNull() & F.col(value).eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    rows = df.withColumn("__new", new).withColumn("run", F.sum("__new").over(w))
    return rows.groupBy(by, "run").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def past_results(df: DataFrame) -> DataFrame:
    """Graded results of an earlier round in today's columns."""
    names = {
        "Title.Number": "Title Number", "Property.Address": "old_property_address", "addressLine.x": "old_address_line", "formattedAddress": "formattedAddress",
        "locality": "locality", "postalCode.y": "postalCode", "confidence": "confidence", "entityType": "entityType", "matchCodes": "matchCodes",
        "longitude": "longitude", "latitude": "latitude",
    }
    out = df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])
    return out.withColumn("old_address_line", F.trim(F.regexp_replace("old_address_line", r"\s+", " ")))


def line_segments(df: DataFrame, id_column: str) -> DataFrame:
    """A row per straight piece of each line (points: x, y, and any height, which is dropped): id, x1, y1, x2, y2."""
    return df.filter(F.size("points") > 1).select(F.col(id_column), F.explode(G.edges(F.col("points"))).alias("s")).select(id_column, "s.*")
