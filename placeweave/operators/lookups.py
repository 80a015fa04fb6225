"""Lookups that map a key to a property, and the cascade that tries them in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import keys as K
from .relational import lookup_dedupe, majority, once_only, union_all

PLACE = ["UPRN", "LATITUDE", "LONGITUDE"]


def _keyed(df: DataFrame, key: Column, source: Column | str, *more: Column) -> DataFrame:
    source = F.lit(source) if isinstance(source, str) else source
    return df.select(key.alias("key"), *PLACE, source.alias("match_source"), *more)


def epc_lookup(domestic: DataFrame, nondomestic: DataFrame, dec: DataFrame | None = None, mode: str = "strict") -> DataFrame:
    parts = [
        _keyed(domestic, K.match_key("addr", "POSTCODE"), "epc_dom"),
        _keyed(nondomestic, K.match_key("adr1", "postcode"), "epc_nondom"),
    ]
    if dec is not None:
        parts.append(_keyed(dec, K.match_key("addr", "postcode"), "dec"))
    return lookup_dedupe(union_all(*parts), mode)


def price_paid_lookup(sales: DataFrame, mode: str = "strict") -> DataFrame:
    rows = sales.filter("uprn is not null").withColumn("UPRN", F.col("uprn"))
    return lookup_dedupe(_keyed(rows, K.match_key("address1", "postcode"), "price_paid"), mode)


def building_lookup(domestic: DataFrame, nondomestic: DataFrame, sales: DataFrame, dec: DataFrame | None = None, mode: str = "strict") -> DataFrame:
    sold = sales.filter("uprn is not null").withColumn("UPRN", F.col("uprn"))
    parts = [
        _keyed(domestic, K.building_key("addr", "POSTCODE"), "epc_dom_building"),
        _keyed(nondomestic, K.building_key("adr1", "postcode"), "epc_nondom_building"),
        _keyed(sold, K.building_key("address1", "postcode"), "price_paid_building"),
    ]
    if dec is not None:
        parts.append(_keyed(dec, K.building_key("addr", "postcode"), "dec_building"))
    return lookup_dedupe(union_all(*parts), mode)


def street_lookup(known: DataFrame, postcode_district: DataFrame, mode: str = "strict") -> DataFrame:
    rows = known.filter("house_number is not null and street is not null").join(postcode_district.select("postcode", "district"), "postcode", "left")
    key = K.street_number_key("house_number", "street", "district")
    return lookup_dedupe(_keyed(rows, key, F.concat("address_source", F.lit("_street"))), mode)


def infill_lookup(infill: DataFrame, mode: str = "strict") -> DataFrame:
    """Inferred addresses under two kinds of key; a repeated key of either kind is dropped."""
    quality = F.when(F.col("number_guessed"), "guess").when(F.col("address_source") == "osm_building", "medium").otherwise("low")
    by_code = F.concat(K.normalise_postcode("postcode"), F.lit("|"), F.upper("house_number"))
    by_street = K.street_number_key("house_number", "street", "district")
    rows = infill.filter("house_number is not null").withColumn("__key", F.explode(F.array(by_code, by_street)))
    out = _keyed(rows, F.col("__key"), F.concat(F.lit("infill_"), F.col("address_source")), quality.alias("match_quality"))
    return lookup_dedupe(out, mode)


def postcode_singletons(places: DataFrame, uprns: DataFrame) -> DataFrame:
    """Postcodes with a single property."""
    one = places.filter("postcode is not null").groupBy("postcode").agg(F.count("*").alias("n"), F.min("UPRN").alias("UPRN")).filter("n = 1")
    found = one.join(uprns.select(*PLACE), "UPRN")
    return _keyed(found, K.normalise_postcode("postcode"), "postcode_singleton")


def substation_lookup(sub: DataFrame, places: DataFrame, uprn_usrn: DataFrame, names: DataFrame) -> DataFrame:
    """Substations by street, and by district where a district has just one."""
    sub = sub.select(*PLACE).join(places.select("UPRN", "district"), "UPRN", "left")
    streets = sub.join(uprn_usrn, "UPRN").join(names.select("USRN", "street"), "USRN")
    streets = streets.filter("district is not null and street is not null")
    by_street = F.concat(K.normalise_name("district"), F.lit("|"), K.normalise_name("street"))
    singles = once_only(sub.filter("district is not null"), ["district"])
    both = union_all(
        _keyed(streets, by_street, "substation_street", F.lit("medium").alias("match_quality")),
        _keyed(singles, K.normalise_name("district"), "substation_district_singleton", F.lit("low").alias("match_quality")),
    )
    return lookup_dedupe(both)


def postcode_district(*addresses: DataFrame) -> DataFrame:
    """The district that most addresses of a postcode have; from frames of (postcode, district)."""
    rows = union_all(*[a.select("postcode", "district") for a in addresses]).filter("postcode is not null")
    return majority(rows, ["postcode"], "district").select("postcode", "district")


def street_ambiguity(streets: DataFrame) -> DataFrame:
    """In how many districts a street's name occurs."""
    rows = streets.withColumn("street", K.normalise_name("street")).filter("street is not null")
    return rows.groupBy("street").agg(F.countDistinct("district").alias("n_district"))


def lad_district(nsul: DataFrame, postcode_districts: DataFrame, names: DataFrame) -> DataFrame:
    """The district's name for each authority code: by majority of its postcodes, else its official name."""
    votes = nsul.filter("lad_code is not null").join(postcode_districts.select("postcode", "district"), "postcode")
    best = majority(votes, ["lad_code"], "district").select("lad_code", F.col("district").alias("__voted"))
    codes = nsul.select("lad_code").filter("lad_code is not null").distinct()
    joined = codes.join(best, "lad_code", "left").join(names.select("lad_code", "lad_name"), "lad_code", "left")
    return joined.select("lad_code", F.coalesce("__voted", K.normalise_name("lad_name")).alias("district"))


def uprn_places(nsul: DataFrame, districts: DataFrame) -> DataFrame:
    return nsul.join(districts, "lad_code", "left").select("UPRN", "postcode", "district")


# -- the cascade

#: Order, key, lookup and quality (None: the lookup's own) of the stages.
STAGES = [
    ("number", "epc", "high"),
    ("number", "price_paid", "high"),
    ("building", "building", "high"),
    ("street", "street", "medium"),
    ("substation", "substation", None),
    ("substation_district", "substation", None),
    ("number", "infill", None),
    ("street", "infill", None),
    ("postcode", "postcode_singleton", "medium"),
    ("postcode_segment", "street_postcode_boundary", "street"),
    ("postcode_segment", "street_centroid_postcode", "street"),
    ("district_segment", "street_centroid", "street"),
    ("postcode_buried", "street_postcode_boundary", "street"),
    ("postcode_buried", "street_centroid_postcode", "street"),
    ("district_buried", "street_centroid", "street"),
]
#: Source names of the lookups of places without a property of their own.
CENTROIDS = {
    "street_postcode_boundary": "usrn_street_postcode_boundary",
    "street_centroid_postcode": "usrn_street_centroid_postcode",
    "street_centroid": "usrn_street_centroid",
}


def stage_keys() -> dict[str, Column]:
    line, code, district = F.col("AddressLine"), K.normalise_postcode("PostalCode"), K.normalise_name("District")
    segment, buried = K.normalise_name(K.first_segment(line)), K.normalise_name(K.buried_street(line))
    numberless = K.house_number(line).isNull()
    substation = K.is_substation(line)
    bar = F.lit("|")
    return {
        "number": K.match_key(line, "PostalCode"),
        "building": K.building_key(line, "PostalCode"),
        "street": K.street_number_key(K.house_number(line), K.street_name(line), "District"),
        "substation": F.when(substation, F.concat(district, bar, segment)),
        "substation_district": F.when(substation, district),
        "postcode": code,
        "postcode_segment": F.when(numberless, F.concat(code, bar, segment)),
        "district_segment": F.when(numberless, F.concat(district, bar, segment)),
        "postcode_buried": F.when(numberless, F.concat(code, bar, buried)),
        "district_buried": F.when(numberless, F.concat(district, bar, buried)),
    }


def cascade(titles: DataFrame, lookups: dict[str, DataFrame | None], row_id: str = "row_id") -> DataFrame:
    """``titles`` with UPRN, LATITUDE, LONGITUDE, match_quality and source of the first stage that hits.

    All stages run as one join: each row gives its keys by kind, the lookups become one table of
    (kind, key) with their stages, and the smallest stage that is found wins.  Lookups have each key once, so
    this equals trying the stages one after the other.  The narrow pairs are shuffled, not the titles;
    rows that nothing matches have nulls.  ``row_id`` names a unique column.
    """
    used = [(i, key, name, quality) for i, (key, name, quality) in enumerate(STAGES) if lookups.get(name) is not None]
    if not used:
        return titles.withColumns({c: F.lit(None).cast(t) for c, t in (
            ("UPRN", "long"), ("LATITUDE", "double"), ("LONGITUDE", "double"), ("match_quality", "string"), ("source", "string"))})
    tables = []
    for i, key, name, quality in used:
        table = lookups[name]
        if name in CENTROIDS:
            source = CENTROIDS[name] + ("_buried" if key.endswith("buried") else "")
            table = table.select("key", F.lit(None).cast("long").alias("UPRN"), "LATITUDE", "LONGITUDE", F.lit(source).alias("match_source"))
        own = F.lit(quality) if quality else F.col("match_quality")
        tables.append(table.select(F.lit(key).alias("kind"), "key", F.struct(
            F.lit(i).alias("stage"), F.col("UPRN").cast("long").alias("UPRN"), "LATITUDE", "LONGITUDE",
            own.alias("match_quality"), F.concat("match_source", F.lit("_match")).alias("source")).alias("hit")))
    lookup = union_all(*tables)
    # Each kind of key is worked out once, though several stages ask for it.
    columns = stage_keys()
    kinds = dict.fromkeys(key for _, key, _, _ in used)
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), columns[k].alias("key")) for k in kinds]), lambda p: p["key"].isNotNull())
    wanted = titles.select(F.col(row_id).alias("__row"), F.explode(pairs).alias("p")).select("__row", "p.kind", "p.key")
    best = wanted.join(lookup, ["kind", "key"]).groupBy("__row").agg(F.min_by("hit", "hit.stage").alias("hit"))
    return titles.join(best, titles[row_id] == best["__row"], "left").select(
        *[F.col(f"`{c}`") for c in titles.columns], "hit.UPRN", "hit.LATITUDE", "hit.LONGITUDE", "hit.match_quality", "hit.source")


def match_stage(rows: DataFrame, key: Column, lookup: DataFrame, quality: str | None = None) -> DataFrame:
    """One stage: ``rows`` with the lookup's columns, null where nothing matches."""
    own = F.lit(quality).alias("match_quality") if quality else F.col("match_quality")
    table = lookup.select(F.col("key").alias("__key"), *PLACE, "match_source", own)
    return rows.withColumn("__key", key).join(table, "__key", "left").drop("__key")


def flag_ambiguous(df: DataFrame, ambiguity: DataFrame, least: int = 3) -> DataFrame:
    """``df`` with ambiguous: no postcode, and a street whose name several districts share."""
    street = K.normalise_name(K.street_name("AddressLine"))
    joined = df.withColumn("__street", street).join(ambiguity.withColumnRenamed("street", "__street"), "__street", "left")
    no_code = ~F.coalesce(F.col("PostalCode") != "", F.lit(False))
    return joined.withColumn("ambiguous", no_code & F.coalesce(F.col("n_district") >= least, F.lit(False))).drop("__street", "n_district")
