"""Sales: property links, addresses shared between sales, classes, medians and today's values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import squish
from . import spatial
from .relational import first_per_key, union_all

ADDRESS = ["postcode", "property_type", "address1", "address2", "address3", "address4", "town", "la", "county"]
BASE_YEAR, NEW_SINCE = 2025, "2020-06-01"


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Join where nulls equal nulls; the right side's key columns go."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in columns})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in columns])
    return left.join(renamed, on, how).drop(*[f"__r_{c}" for c in columns])


def link_sales(sales: DataFrame, links: DataFrame) -> DataFrame:
    """Sales with uprn, parentuprn and usrn: by the link table, else from another sale of the same address."""
    joined = sales.join(links, "transactionid", "left")
    have = joined.filter("uprn is not null")
    known = first_per_key(have.select(*ADDRESS, "uprn", "parentuprn", "usrn"), ADDRESS, F.col("uprn"))
    lack = joined.filter("uprn is null").drop("uprn", "parentuprn", "usrn")
    return have.unionByName(_null_safe(lack, known, ADDRESS))


def _line(*columns: str) -> Column:
    return squish(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))


def register_lines(register: DataFrame, *columns: str, postcode: str = "postcode") -> DataFrame:
    """(line, postcode, uprn) of an energy register, the newest of a line."""
    line = F.replace(F.upper(_line(*columns)), F.lit(","), F.lit(""))
    rows = register.select(line.alias("line"), F.col(postcode).alias("postcode"), F.col("UPRN").alias("uprn"), "year")
    return first_per_key(rows, ["line", "postcode"], F.col("year").desc_nulls_last(), F.col("uprn")).drop("year")


def match_registers(sales: DataFrame, domestic: DataFrame, nondomestic: DataFrame) -> DataFrame:
    """Sales without a property by the registers' address lines: three and four parts, homes first."""
    tables = [
        register_lines(domestic, "addr", "ADDRESS2", "ADDRESS3", postcode="POSTCODE"),
        register_lines(nondomestic, "adr1", "adr2", "adr3"),
    ]
    rows = sales.withColumns({"__short": _line("address1", "address2", "address3"), "__long": _line("address1", "address2", "address3", "address4")})
    rows = rows.withColumn("__uprn0", F.col("uprn"))
    names = ["__uprn0"]
    for t in tables:
        for kind in ("__short", "__long"):
            name = f"__uprn{len(names)}"
            table = t.select(F.col("line").alias(kind), "postcode", F.col("uprn").alias(name)).filter(F.col(name).isNotNull())
            rows = _null_safe(rows, table, [kind, "postcode"])
            names.append(name)
    return rows.withColumn("uprn", F.coalesce(*names)).drop("__short", "__long", *names)


def add_places(sales: DataFrame, uprns: DataFrame, areas: DataFrame, postcode_area: DataFrame) -> DataFrame:
    """Sales with coordinates and LSOA21CD: by the property's place (an area each, if several), else by postcode."""
    inside = spatial.points_in_polygons(uprns, areas, "UPRN", "LSOA21CD", 2000.0).select(F.col("point").alias("uprn"), F.col("polygon").alias("__area"))
    at = uprns.select(F.col("UPRN").alias("uprn"), "x", "y", "LATITUDE", "LONGITUDE")
    rows = sales.join(at, "uprn", "left").join(inside, "uprn", "left")
    code = postcode_area.select(F.col("pcds").alias("postcode"), F.col("lsoa21cd").alias("__code"))
    rows = rows.join(code, "postcode", "left")
    return rows.withColumn("LSOA21CD", F.when(F.col("uprn").isNotNull(), F.col("__area")).otherwise(F.col("__code"))).drop("__area", "__code")


def medians(sales: DataFrame) -> DataFrame:
    """(area, year, property_type, price_median, transactions); type O stands for all types together."""
    rows = sales.filter("LAD25CD is not null").withColumn("year", F.year("date"))
    measure = [F.median("price").alias("price_median"), F.count("*").alias("transactions")]
    by_type = rows.filter("property_type <> 'O' and property_type is not null").groupBy("LAD25CD", "year", "property_type").agg(*measure)
    every = rows.groupBy("LAD25CD", "year").agg(*measure).withColumn("property_type", F.lit("O"))
    return by_type.unionByName(every)


def growth(median_prices: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """Medians with the base year's median over theirs; null without either or for a median of 0."""
    base = median_prices.filter(F.col("year") == base_year).select("LAD25CD", "property_type", F.col("price_median").alias("__base"))
    joined = median_prices.join(base, ["LAD25CD", "property_type"], "left")
    return joined.withColumn("growth_multiple", F.when(F.col("price_median") > 0, F.col("__base") / F.col("price_median"))).drop("__base")


def nowcast(sales: DataFrame, areas: DataFrame, base_year: int = BASE_YEAR) -> DataFrame:
    """The latest sale of each property with its price brought to the base year, to the nearest thousand."""
    rows = sales.join(areas.select("LSOA21CD", "LAD25CD").dropDuplicates(["LSOA21CD"]), "LSOA21CD", "left")
    rates = growth(medians(rows), base_year).select("LAD25CD", "year", "property_type", "growth_multiple")
    latest = first_per_key(rows.filter("uprn is not null"), ["uprn"], F.col("date").desc_nulls_last(), F.col("transactionid")).withColumn("year", F.year("date"))
    out = latest.join(rates, ["LAD25CD", "year", "property_type"], "left")
    return out.withColumn("price_2025", F.bround(F.col("price") * F.col("growth_multiple") / 1000) * 1000)


def lifecycle(releases: DataFrame) -> DataFrame:
    """First and last release of each property, and its last coordinates."""
    place = F.struct("X_COORDINATE", "Y_COORDINATE", "LATITUDE", "LONGITUDE")
    out = releases.groupBy("UPRN").agg(F.min("date").alias("date_first"), F.max("date").alias("date_last"), F.max_by(place, "date").alias("p"))
    return out.select("UPRN", "date_first", "date_last", "p.*")


def classify(uprns: DataFrame, nowcasts: DataFrame, domestic: DataFrame, nondomestic: DataFrame) -> DataFrame:
    """Properties with class, exists, newbuild and their sale's price; from registers and sales."""
    flag = lambda d, c, name: d.select(F.col(c).alias("UPRN")).filter("UPRN is not null").distinct().withColumn(name, F.lit(True))
    out = uprns
    for table, column, name in (
        (domestic, "UPRN", "e"), (nondomestic, "UPRN", "n"),
        (nowcasts.filter("property_type <> 'O'"), "uprn", "l"), (nowcasts.filter("property_type = 'O'"), "uprn", "m"),
    ):
        out = out.join(flag(table, column, f"__{name}"), "UPRN", "left")
    e, n, l, m = (F.coalesce(f"__{x}", F.lit(False)) for x in "enlm")
    kind = (
        F.when(~e & ~n & ~l & ~m, "unknown").when((e | l) & ~(n | m), "domestic").when((n | m) & ~(e | l), "non-domestic")
        .when(e & n & ~m & ~l, "ambiguous epc").when(~e & ~n & m & l, "ambiguous lr").otherwise("ambiguous other")
    )
    out = out.withColumn("class", kind).drop("__e", "__n", "__l", "__m")
    last = uprns.agg(F.max("date_last")).first()[0]  # one value
    out = out.withColumns({"exists": F.col("date_last") == F.lit(last), "newbuild": F.col("date_first") > F.lit(NEW_SINCE).cast("date")})
    sale = nowcasts.select(F.col("uprn").alias("UPRN"), "price", "price_2025", F.to_date("date").alias("date"), "property_type")
    out = out.join(sale, "UPRN", "left")
    return out.withColumn("price_2025", F.when(F.col("exists"), F.col("price_2025")))


def combine_rematch(sales: DataFrame, rematched: DataFrame, uprns: DataFrame, areas: DataFrame) -> DataFrame:
    """All sales once: those matched at first, and the others with what the second pass found."""
    have = sales.filter("uprn is not null")
    places = spatial.points_in_polygons(uprns, areas, "UPRN", "LSOA21CD", 2000.0).select(F.col("point").alias("uprn"), F.col("polygon").alias("__a"))
    new = rematched.join(uprns.select(F.col("UPRN").alias("uprn"), F.col("LATITUDE").alias("__lat"), F.col("LONGITUDE").alias("__lon")), "uprn", "left").join(places, "uprn", "left")
    if "LSOA21CD" in sales.columns:
        new = new.withColumn("LSOA21CD", F.when(F.col("uprn").isNotNull(), F.col("__a")).otherwise(F.col("LSOA21CD")))
    new = new.withColumns({"LATITUDE": F.col("__lat"), "LONGITUDE": F.col("__lon")}).drop("__lat", "__lon", "__a")
    return union_all(have, new)
