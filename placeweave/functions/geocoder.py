"""Requests to and answers from batch geocoders, as pure functions and Column expressions; no calls are made here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import col

FEATURE = (
    "struct<properties:struct<type:string,confidence:string,matchCodes:array<string>,"
    "address:struct<addressLine:string,formattedAddress:string,locality:string,postalCode:string,adminDistricts:array<struct<shortName:string,name:string>>>>,"
    "geometry:struct<coordinates:array<double>>,error:struct<code:string,message:string>>"
)
ANSWER = f"struct<batchItems:array<struct<features:array<{FEATURE}>,error:struct<code:string,message:string>>>>"


def build_url(base: str, query: dict[str, str | int | None]) -> Column:
    """Base, and the encoded parameters that are not null."""
    parts = [F.concat(F.lit(f"{k}="), F.url_encode(F.lit(str(v)))) for k, v in query.items() if v is not None]
    return F.concat(F.lit(base), F.lit("?"), F.array_join(F.array(*parts), "&")) if parts else F.lit(base)


def batch_item(line: Column | str, postcode: Column | str, district: Column | str, country: str = "GB") -> Column:
    """One request as JSON; null and empty parts are left out."""
    part = lambda c: F.nullif(F.trim(col(c)), F.lit(""))
    return F.to_json(F.struct(part(line).alias("addressLine"), part(postcode).alias("postalCode"), part(district).alias("locality"), F.lit(country).alias("countryRegion")))


def parse_answer(json: Column | str) -> Column:
    """The items of an answer in order, as structs; an item with an error or without a feature is null."""
    items = F.from_json(col(json), ANSWER)["batchItems"]
    return F.transform(items, lambda i: F.when(i["error"].isNull() & (F.size(F.coalesce(i["features"], F.array().cast(f"array<{FEATURE}>"))) > 0), feature(F.get(i["features"], F.lit(0)))))


def feature(f: Column) -> Column:
    """A feature's columns; its coordinates are longitude, latitude."""
    p = f["properties"]
    district = lambda i: F.coalesce(F.get(p["address"]["adminDistricts"], F.lit(i))["shortName"], F.get(p["address"]["adminDistricts"], F.lit(i))["name"])
    return F.struct(
        p["address"]["addressLine"].alias("addressLine"), district(0).alias("adminDistrict"), district(1).alias("adminDistrict2"),
        p["address"]["formattedAddress"].alias("formattedAddress"), p["address"]["locality"].alias("locality"), p["address"]["postalCode"].alias("postalCode"),
        F.get(f["geometry"]["coordinates"], F.lit(1)).alias("latitude"), F.get(f["geometry"]["coordinates"], F.lit(0)).alias("longitude"),
        p["confidence"].alias("confidence"), p["type"].alias("entityType"), F.array_join(p["matchCodes"], ",").alias("matchCodes"))


def service_time(text: Column | str) -> Column:
    """``/Date(milliseconds)/`` as a timestamp."""
    return F.timestamp_millis(F.expr("try_cast(null as bigint)") if text is None else F.regexp_extract(col(text), r"/Date\((-?\d+)", 1).try_cast("bigint"))
