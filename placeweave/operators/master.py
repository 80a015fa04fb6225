"""The published tables: every property with all that is known, the map extract, and all results in one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import first_per_key, require_columns, union_all

#: Domestic energy bands.
BANDS = ["A", "B", "C", "D", "E", "F", "G"]


def domestic_rating(df: DataFrame, column: str = "cur_rate") -> DataFrame:
    """``df`` with epc_dom_rating: the band, null for anything else; an error if the column was renamed."""
    require_columns(df, [column], "domestic register")
    band = F.upper(F.trim(F.col(column).cast("string")))
    return df.withColumn("epc_dom_rating", F.when(band.isin(BANDS), band))


def nondomestic_rating(df: DataFrame, column: str = "rating") -> DataFrame:
    """``df`` with epc_nondom_asset_rating: the number, else null; an error if the column was renamed."""
    require_columns(df, [column], "non-domestic register")
    return df.withColumn("epc_nondom_asset_rating", F.expr(f"try_cast(`{column}` AS double)"))


def _one(df: DataFrame, *order: Column) -> DataFrame:
    rows = df.filter("UPRN is not null")
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != "UPRN" and not dict(df.dtypes)[c].startswith(("map", "struct", "array"))]
    return first_per_key(rows, ["UPRN"], *order, *rest)


def all_addresses(uprns: DataFrame, classes: DataFrame, places: DataFrame, domestic: DataFrame, nondomestic: DataFrame, dec: DataFrame,
                  sales: DataFrame, known: DataFrame, infill: DataFrame, uprn_usrn: DataFrame, names: DataFrame, parcels: DataFrame,
                  nowcasts: DataFrame | None = None) -> DataFrame:
    """One row per property, every source side by side; each right side has one row per UPRN, so all
    joins share one partitioning by it."""
    out = uprns.select("UPRN", "date_first", "date_last", "X_COORDINATE", "Y_COORDINATE", "LATITUDE", "LONGITUDE")
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    sold = sales.filter("uprn is not null").select(
        F.col("uprn").alias("UPRN"), F.col("date").alias("pp_date"), *[F.col(f"address{i}").alias(f"pp_address{i}") for i in range(1, 5)],
        F.col("town").alias("pp_town"), F.col("la").alias("pp_district"), F.col("county").alias("pp_county"), F.col("postcode").alias("pp_postcode"))
    if nowcasts is not None:
        value = nowcasts.filter("uprn is not null").select(F.col("uprn").alias("UPRN"), F.col("price").alias("pp_price"), F.col("price_2025").alias("current_value_2025"))
    else:
        value = out.limit(0).select("UPRN", F.lit(None).cast("double").alias("pp_price"), F.lit(None).cast("double").alias("current_value_2025"))
    streets = uprn_usrn.join(names.select("USRN", F.col("street").alias("usrn_street"), F.col("street_confidence").alias("usrn_street_confidence")), "USRN", "left")
    for table in (
        _one(classes.select("UPRN", "class", "exists", "newbuild")),
        _one(places.select("UPRN", F.col("postcode").alias("postcode_nsul"), F.col("district").alias("district_nsul"))),
        _one(domestic_rating(domestic).filter(has("addr")).select(
            "UPRN", F.col("addr").alias("epc_dom_address1"), F.col("ADDRESS2").alias("epc_dom_address2"), F.col("ADDRESS3").alias("epc_dom_address3"),
            F.col("POSTCODE").alias("epc_dom_postcode"), F.col("year").alias("epc_dom_year"), "epc_dom_rating"), F.col("epc_dom_year").desc_nulls_last()),
        _one(nondomestic_rating(nondomestic).filter(has("adr1")).select(
            "UPRN", F.col("adr1").alias("epc_nondom_address1"), F.col("adr2").alias("epc_nondom_address2"), F.col("adr3").alias("epc_nondom_address3"),
            F.col("postcode").alias("epc_nondom_postcode"), F.col("year").alias("epc_nondom_year"), "epc_nondom_asset_rating"), F.col("epc_nondom_year").desc_nulls_last()),
        _one(dec.select("UPRN", F.col("addr").alias("dec_address"), F.col("year").alias("dec_year"))),
        _one(sold, F.col("pp_date").desc_nulls_last()),
        _one(value),
        _one(known.select("UPRN", F.col("addr").alias("best_address"), F.col("postcode").alias("best_postcode"), F.col("house_number").alias("best_house_number"),
                          F.col("street").alias("best_street"), F.col("address_source").alias("best_address_source"))),
        _one(infill.select("UPRN", *[F.col(c).alias(f"infill_{c}") for c in (
            "house_number", "street", "postcode", "building_name", "district", "address_source", "number_guessed", "street_confidence")])),
        _one(streets, F.col("usrn_street").isNull()),
        _one(parcels.select("UPRN", F.col("INSPIREID").alias("inspire_id"), F.col("n_uprn").alias("inspire_n_uprn"), F.col("single_uprn_parcel").alias("inspire_single_uprn_parcel"))),
    ):
        out = out.join(table, "UPRN", "left")
    return out


def display_address(df: DataFrame) -> DataFrame:
    """``df`` with address and address_source: the best of four kinds."""
    full = F.when(F.col("infill_street").isNotNull(), F.concat_ws(" ", "infill_house_number", "infill_street"))
    infill = F.concat(F.lit("infill_"), F.col("infill_address_source"))
    return df.withColumns({
        "address": F.coalesce("best_address", full, "infill_building_name", "usrn_street"),
        "address_source": F.when(F.col("best_address").isNotNull(), F.col("best_address_source")).when(full.isNotNull(), infill)
        .when(F.col("infill_building_name").isNotNull(), infill).when(F.col("usrn_street").isNotNull(), "usrn_street_name_only"),
    })


def map_extract(df: DataFrame) -> DataFrame:
    """The columns of the public map, for properties with coordinates."""
    d = display_address(df).filter("LONGITUDE is not null and LATITUDE is not null")
    return d.select(
        "UPRN", "LONGITUDE", "LATITUDE", "address", "address_source", "class", F.col("epc_dom_rating").alias("epc_rating"),
        F.col("epc_nondom_asset_rating").alias("epc_asset_rating"), F.col("current_value_2025").alias("current_value"),
        F.col("pp_price").alias("last_sale_price"), F.col("pp_date").cast("string").alias("last_sale_date"),
        F.coalesce("district_nsul", "infill_district").alias("district"),
        F.coalesce("postcode_nsul", "best_postcode", "infill_postcode").alias("postcode"), "exists")


RESULT = {
    "title_number": "Title Number", "dataset": "dataset", "category": "category", "property_address": "Property Address",
    "address_line": "AddressLine", "district": "District", "postcode": "PostalCode", "proprietor_name": "Proprietor Name (1)",
    "company_registration_no": "Company Registration No. (1)", "proprietorship_category": "Proprietorship Category (1)",
    "country_incorporated": "Country Incorporated (1)", "uprn": "uprn", "latitude": "latitude", "longitude": "longitude",
    "match_quality": "match_quality", "source": "source",
}


def result_columns(df: DataFrame) -> DataFrame:
    """Results in one schema; a column that a table lacks is null."""
    kind = {"latitude": "double", "longitude": "double"}
    return df.select(*[
        (F.col(f"`{old}`") if old in df.columns else F.lit(None)).cast(kind.get(new, "string")).alias(new) for new, old in RESULT.items()
    ])


def combine_final(carried: DataFrame, matched: DataFrame, geocoded: DataFrame, parcels: DataFrame | None = None) -> DataFrame:
    """Carried forward, matched and geocoded rows, with the parcel of their property."""
    cf = carried.withColumns({"uprn": F.lit(None).cast("string"), "match_quality": F.col("confidence")})
    fm = matched.withColumns({"uprn": F.col("UPRN").cast("string"), "latitude": F.col("LATITUDE"), "longitude": F.col("LONGITUDE")})
    gc = geocoded.withColumns({"uprn": F.col("UPRN").cast("string"), "match_quality": F.col("confidence")})
    out = union_all(*map(result_columns, (cf, fm, gc)))
    if parcels is None:
        return out.withColumns({"INSPIREID": F.lit(None).cast("string"), "n_uprn": F.lit(None).cast("long"), "single_uprn_parcel": F.lit(None).cast("boolean")})
    p = parcels.select(F.col("UPRN").cast("string").alias("uprn"), "INSPIREID", "n_uprn", "single_uprn_parcel")
    return out.join(p, "uprn", "left")


#: Lower ends of the map's classes of value and of asset rating.
VALUE_STOPS = [0, 150_000, 300_000, 600_000, 1_200_000]
RATING_STOPS = [0, 26, 51, 76, 101, 126, 151]


def step_class(value: Column | str, stops: list[int]) -> Column:
    """The number of the last stop that a value reaches; null below the first."""
    value = F.col(value) if isinstance(value, str) else value
    out = F.when(value >= stops[-1], len(stops) - 1)
    for i in range(len(stops) - 2, -1, -1):
        out = out.when(value >= stops[i], i)
    return out


def grade_result(entity: Column, confidence: Column, same_authority: Column) -> Column:
    """good, medium, low, wrongla or nola."""
    precise = entity.isin("Address", "PointAddress", "RoadIntersection")
    return (
        F.when(same_authority.isNull(), "nola").when(~same_authority, "wrongla")
        .when(precise & (confidence == "High"), "good").when(confidence.isin("High", "Medium"), "medium").otherwise("low")
    )
