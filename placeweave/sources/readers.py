"""Readers with explicit schemas and guards; every path may be any that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import normalise_postcode, osm_tag
from ..operators.relational import first_per_key, require_columns

CCOD = [
    "Title Number", "Tenure", "Property Address", "District", "County", "Region", "Postcode", "Proprietor Name (1)",
    "Company Registration No. (1)", "Proprietorship Category (1)",
]
OCOD = [*CCOD, "Country Incorporated (1)"]
PRICE_PAID = (
    "transactionid string, price double, date timestamp, postcode string, property_type string, new_build string, freehold string, "
    "address1 string, address2 string, address3 string, address4 string, town string, la string, county string, record_status string, "
    "transaction_category string"
)
ROAD_TYPES = ["motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "pedestrian", "road"]
SENTINEL = 1_000_000


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, escape='"', multiLine=False)


def titles(spark: SparkSession, path: str, columns: list[str] = CCOD) -> DataFrame:
    """A register of titles: its columns by name, no rows without a title, one row per title."""
    df = require_columns(_csv(spark, path), columns, path).filter(F.col("`Title Number`").isNotNull())
    return first_per_key(df, ["Title Number"], *[F.col(f"`{c}`").asc_nulls_last() for c in columns[1:]])


def overseas_titles(spark: SparkSession, path: str) -> DataFrame:
    return titles(spark, path, OCOD)


def price_paid(spark: SparkSession, path: str) -> DataFrame:
    """Headerless files of sales; a transaction once."""
    df = spark.read.csv(path, header=False, schema=PRICE_PAID, escape='"')
    return first_per_key(df.filter("transactionid is not null"), ["transactionid"], F.col("date").desc_nulls_last(), F.col("price"))


def sale_links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="transactionid string, uprn long, parentuprn long, usrn long")


def releases(spark: SparkSession, path: str) -> DataFrame:
    """Monthly files of properties; the month comes from the file's name (…yyyyMM.csv)."""
    df = require_columns(_csv(spark, path).withColumn("date", F.to_date(F.regexp_extract(F.input_file_name(), r"(\d{6})\.csv", 1), "yyyyMM")),
                         ["UPRN", "X_COORDINATE", "Y_COORDINATE", "LATITUDE", "LONGITUDE", "date"], path)
    return df.withColumns({"UPRN": F.col("UPRN").try_cast("long"), **{c: F.col(c).try_cast("double") for c in ("X_COORDINATE", "Y_COORDINATE", "LATITUDE", "LONGITUDE")}})


def uprn_usrn(spark: SparkSession, path: str) -> DataFrame:
    df = require_columns(_csv(spark, path), ["IDENTIFIER_1", "IDENTIFIER_2"], path)
    return df.select(F.col("IDENTIFIER_1").try_cast("long").alias("UPRN"), F.col("IDENTIFIER_2").try_cast("long").alias("USRN")).distinct()


def road_lines(spark: SparkSession, path: str) -> DataFrame:
    """Named roads of the kinds that addresses lie on; both conditions reach the Parquet scan."""
    return spark.read.parquet(path).filter(F.col("name").isNotNull() & F.col("highway").isin(ROAD_TYPES))


def building_addresses(spark: SparkSession, path: str) -> DataFrame:
    """Buildings with address tags; the name falls back to the house's name."""
    df = spark.read.parquet(path).filter(F.col("other_tags").contains("addr:"))
    return osm_address_columns(df)


def osm_address_columns(df: DataFrame) -> DataFrame:
    tag = lambda k: osm_tag("other_tags", k)
    return df.withColumns({
        "osm_housenumber": tag("addr:housenumber"), "osm_street": tag("addr:street"), "osm_postcode": normalise_postcode(tag("addr:postcode")),
        "osm_city": tag("addr:city"), "osm_building_name": F.coalesce(F.col("name"), tag("addr:housename")),
    })


def osm_uprn_tags(polygons: DataFrame, points: DataFrame) -> DataFrame:
    """Objects that carry a property number, polygons before points; one per property.

    Both frames: osm_id, other_tags, x, y (a polygon's point inside it).
    """
    both = polygons.withColumn("osm_geom_type", F.lit("polygon")).unionByName(points.withColumn("osm_geom_type", F.lit("point")))
    rows = both.filter(F.col("other_tags").contains("ref:gb:uprn")).withColumn("UPRN", osm_tag("other_tags", "ref:gb:uprn").try_cast("long"))
    rows = rows.filter("UPRN is not null")
    tag = lambda k: osm_tag("other_tags", k)
    rows = rows.withColumns({"osm_housenumber": tag("addr:housenumber"), "osm_street": tag("addr:street"), "osm_postcode": tag("addr:postcode")})
    return first_per_key(rows, ["UPRN"], F.col("osm_geom_type") == "point", F.col("osm_id"))


def substations(df: DataFrame) -> DataFrame:
    """Objects tagged as substations, with ref and operator."""
    rows = df.filter(F.col("other_tags").contains('"power"=>"substation"'))
    return rows.withColumns({"ref": osm_tag("other_tags", "ref"), "operator": osm_tag("other_tags", "operator")})


def nsul(spark: SparkSession, path: str) -> DataFrame:
    """Regional files without Scotland's; the authority's column has the year in its name; one row per property."""
    df = _csv(spark, path).filter(~F.input_file_name().rlike(r"_SC\.csv"))
    lad = [c for c in df.columns if c.upper().startswith("LAD") and c.upper().endswith("CD")]
    if len(lad) != 1:
        raise ValueError(f"one LADyyCD column expected, found {lad}")
    require_columns(df, ["UPRN", "PCDS"], path)
    rows = df.select(F.col("UPRN").try_cast("long").alias("UPRN"), normalise_postcode("PCDS").alias("postcode"), F.col(lad[0]).alias("lad_code"))
    return first_per_key(rows.filter("UPRN is not null"), ["UPRN"], F.col("postcode").asc_nulls_last(), F.col("lad_code"))


def lad_names(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path)
    return df.select(F.col(f"`{df.columns[0]}`").alias("lad_code"), F.col(f"`{df.columns[1]}`").alias("lad_name"))


def display_certificates(df: DataFrame) -> DataFrame:
    """The newest display certificate of each property: (UPRN, ADDRESS1, INSPECTION_DATE, ...)."""
    rows = df.filter("UPRN is not null").withColumns({"addr": F.col("ADDRESS1"), "year": F.year("INSPECTION_DATE")})
    return first_per_key(rows, ["UPRN"], F.col("year").desc_nulls_last(), F.col("addr").asc_nulls_last())


def venues(*layers: DataFrame) -> DataFrame:
    """Cultural venues of all layers; a number that is a multiple of a million stands for none."""
    from functools import reduce

    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)
    uprn = F.col("os_addressbase_uprn").cast("string").try_cast("long")
    rows = rows.withColumn("UPRN", F.when(uprn % SENTINEL != 0, uprn)).filter("UPRN is not null")
    return first_per_key(rows, ["UPRN"], F.col("address1").asc_nulls_last(), F.col("address3").asc_nulls_last())


def schools(df: DataFrame) -> DataFrame:
    """Open schools with a place and property; coordinates on the grid, and in degrees."""
    from ..functions.geo import degrees_point

    rows = df.filter(F.col("`EstablishmentStatus (name)`").isin("Open", "Open, but proposed to close"))
    rows = rows.withColumns({"UPRN": F.col("UPRN").cast("string").try_cast("long"), "X_COORDINATE": F.col("Easting").try_cast("double"), "Y_COORDINATE": F.col("Northing").try_cast("double")})
    rows = rows.filter("UPRN is not null and X_COORDINATE is not null and Street is not null").withColumns({"addr": F.col("Street"), "postcode": normalise_postcode("Postcode")})
    rows = first_per_key(rows, ["UPRN"], F.col("addr"), F.col("postcode").asc_nulls_last())
    return rows.withColumn("p", degrees_point("X_COORDINATE", "Y_COORDINATE")).withColumns({"LATITUDE": F.col("p.lat"), "LONGITUDE": F.col("p.lon")}).drop("p")


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of another store; Spark's error if it is not there."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def boundaries(spark: SparkSession, path: str, *properties: str) -> DataFrame:
    """Features of a GeoJSON file: the named properties, and the edges of all rings."""
    from ..functions.geo import edges

    point = "array<array<array<array<double>>>>"
    schema = f"features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    df = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    polygon = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("f.geometry.coordinates", point)
    rings = F.when(F.col("f.geometry.type") == "Polygon", polygon).otherwise(F.flatten(multi))
    df = df.select(*[F.col("f.properties")[p].alias(p) for p in properties], rings.alias("rings"))
    lines = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return df.withColumn("edges", F.flatten(F.transform(lines, edges))).drop("rings")


#: The longest phrase list that is read: its terms pass through the driver.
MOST_TERMS = 100_000


def removal_list(spark: SparkSession, path: str) -> list[tuple[str | None, str | None]]:
    """A phrase list (term, flag); one beyond ``MOST_TERMS`` is refused, not cut."""
    rows = spark.read.csv(path, header=True, schema="term string, flag string").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} phrases in {path}")
    return [tuple(r) for r in rows]


def place_names(df: DataFrame, kinds: list[str], column: str = "place") -> DataFrame:
    """Distinct names of the given kinds, sorted."""
    return df.filter(F.col(column).isin(kinds) & F.col("name").isNotNull()).select("name").distinct().orderBy("name")


def work_list(todo: DataFrame, done: DataFrame, n: int = 1) -> DataFrame:
    """The first names of what is not done yet (name)."""
    return todo.select("name").distinct().join(done.select("name").distinct(), "name", "left_anti").orderBy("name").limit(n)


def street_lines(spark: SparkSession, path: str) -> DataFrame:
    """Street centre lines as Parquet (usrn, points): USRN and its straight pieces; heights are dropped."""
    from ..operators.regions import line_segments

    return line_segments(spark.read.parquet(path).select(F.col("usrn").try_cast("long").alias("USRN"), "points").filter("USRN is not null"), "USRN")


def open_map_roads(spark: SparkSession, path: str) -> DataFrame:
    """Roads of the open map: five columns of the table, pieces of lines without heights."""
    from ..operators.regions import line_segments

    roads = spark.read.parquet(path).select("id", "classification", "distinctive_name", "road_number", "points")
    return line_segments(roads, "id").join(roads.drop("points"), "id")


def past_results(spark: SparkSession, root: str) -> DataFrame:
    """The usable grades of an earlier round's results; the failed and wrong ones are not read."""
    from ..operators import regions

    return regions.past_results(spark.read.parquet(f"{root.rstrip('/')}/bing_geocoded_{{good,medium,low}}*"))


def vintages(spark: SparkSession, paths: dict[int, str], *properties: str) -> DataFrame:
    """Boundaries of several years under one schema, with their year; nothing is read before it is needed."""
    from ..operators.relational import union_all

    return union_all(*[boundaries(spark, path, *properties).withColumn("year", F.lit(year)) for year, path in paths.items()])


def parcels_xml(spark: SparkSession, path: str, row: str = "PREDEFINED") -> DataFrame:
    """Parcels of authorities' GML files: la (the file's name), INSPIREID, edges; the reader is Spark's own."""
    from ..functions.geo import edges

    schema = "INSPIREID long, GEOMETRY struct<Polygon:struct<exterior:struct<LinearRing:struct<posList:string>>>>"
    df = spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", "true").schema(schema).load(path)
    numbers = F.transform(F.split(F.trim("GEOMETRY.Polygon.exterior.LinearRing.posList"), r"\s+"), lambda x: x.try_cast("double"))
    ring = F.transform(F.sequence(F.lit(0), F.floor(F.size("n") / 2).cast("int") - 1), lambda i: F.struct(F.get("n", 2 * i).alias("x"), F.get("n", 2 * i + 1).alias("y")))
    rows = df.filter("INSPIREID is not null and GEOMETRY is not null").withColumn("n", numbers).filter("size(n) >= 6")
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.gml", 1).alias("la"), "INSPIREID", edges(ring).alias("edges")).dropDuplicates(["la", "INSPIREID"])
