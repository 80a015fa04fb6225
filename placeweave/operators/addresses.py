"""The address database: known addresses, street names, and what can be inferred for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import geo as G
from ..functions import keys as K
from . import spatial
from .relational import first_per_key, majority, once_only, union_all

#: Sources of addresses, best first.
SOURCES = ["epc_dom", "epc_nondom", "price_paid", "osm_uprn_tag", "education", "cultural", "dec"]
SHARE = 0.6
#: House numbers apart, metres along and across the street, metres from its line.
GAP, ALONG, ACROSS, FROM_LINE = 4, 150.0, 12.0, 75.0


def known_addresses(*sources: tuple[str, DataFrame]) -> DataFrame:
    """One address per UPRN from frames of (UPRN, addr, postcode, LATITUDE, LONGITUDE, X_COORDINATE, Y_COORDINATE),
    named by source; the better source wins, then the smaller address."""
    rank = F.element_at(F.create_map(*[x for i, s in enumerate(SOURCES) for x in (F.lit(s), F.lit(i))]), F.col("address_source"))
    rows = union_all(*[f.withColumn("address_source", F.lit(name)) for name, f in sources])
    rows = rows.filter("UPRN is not null and addr is not null and addr <> ''").withColumn("__rank", rank)
    best = first_per_key(rows, ["UPRN"], F.col("__rank"), F.col("addr"), F.col("postcode").asc_nulls_last()).drop("__rank")
    best = best.withColumns({"house_number": K.house_number("addr"), "street": K.street_name("addr")})
    # Coordinates that are only given in degrees.
    xy = G.grid_point("LATITUDE", "LONGITUDE")
    best = best.withColumn("__xy", F.when(F.col("X_COORDINATE").isNull() & F.col("LATITUDE").isNotNull(), xy))
    return best.withColumns({"X_COORDINATE": F.coalesce("X_COORDINATE", "__xy.x"), "Y_COORDINATE": F.coalesce("Y_COORDINATE", "__xy.y")}).drop("__xy")


def osm_addresses(tags: DataFrame) -> DataFrame:
    """Tagged objects with number and street as addresses."""
    rows = tags.filter("osm_housenumber is not null and osm_street is not null")
    return rows.withColumn("addr", F.concat("osm_housenumber", F.lit(" "), "osm_street"))


def with_postcodes(df: DataFrame, nsul: DataFrame) -> DataFrame:
    """Missing postcodes from the property register."""
    codes = first_per_key(nsul.select("UPRN", F.col("postcode").alias("__p")).filter("UPRN is not null"), ["UPRN"], F.col("__p").asc_nulls_last())
    own = F.col("postcode") if "postcode" in df.columns else F.lit(None).cast("string")
    return df.join(codes, "UPRN", "left").withColumn("postcode", F.coalesce(own, "__p")).drop("__p")


def augment_known(known: DataFrame, geocodes: DataFrame, uprns: DataFrame, radius: float = 10.0) -> DataFrame:
    """``known`` with addresses of older geocodes (addr, postcode, x, y) that lie within the radius of a property
    without an address, and not nearer to one that has one; a property with two different lines gets none."""
    have = uprns.join(known.select("UPRN"), "UPRN", "left_semi").select("UPRN", "x", "y")
    lack = uprns.join(known.select("UPRN"), "UPRN", "left_anti").select("UPRN", "x", "y")
    g = geocodes.withColumn("gid", F.xxhash64("addr", "postcode", "x", "y"))
    near = spatial.nearest(g, lack, "gid", "UPRN", (radius,)).select(F.col("point").alias("gid"), F.col("target").alias("UPRN"), "d")
    rival = spatial.nearest(g, have, "gid", "UPRN", (radius,)).select(F.col("point").alias("gid"), F.col("d").alias("d2"))
    hits = near.join(rival, "gid", "left").filter("d2 is null or d <= d2").join(g.select("gid", "addr", "postcode"), "gid")
    lines = once_only(hits.select("UPRN", "addr", "postcode").distinct(), ["UPRN"])
    new = lines.join(uprns.select("UPRN", "LATITUDE", "LONGITUDE", F.col("x").alias("X_COORDINATE"), F.col("y").alias("Y_COORDINATE")), "UPRN")
    new = new.withColumns({"address_source": F.lit("geocoded_2022"), "house_number": K.house_number("addr"), "street": K.street_name("addr")})
    return union_all(known, new)


def street_names(uprn_usrn: DataFrame, known: DataFrame, postcode_district: DataFrame, oml: DataFrame | None = None,
                 osm: DataFrame | None = None, places: DataFrame | None = None, authorities: DataFrame | None = None) -> DataFrame:
    """A name for each street from its properties' addresses, by majority; then from maps where there is none.

    ``oml`` as of ``link_oml``; ``osm``: (USRN, street) as of ``name_usrns``; ``places``: (UPRN, district);
    ``authorities``: (USRN, district).
    """
    rows = known.filter("street is not null").select("UPRN", K.normalise_name("street").alias("street"), "postcode").join(uprn_usrn, "UPRN")
    rows = rows.filter("street is not null")
    name = majority(rows, ["USRN"], "street", "street_n", "named").withColumn("street_agreement", F.col("street_n") / F.col("named"))
    code = majority(rows, ["USRN"], "postcode").select("USRN", "postcode")
    own = name.drop("named").join(code, "USRN", "left").join(postcode_district.select("postcode", "district"), "postcode", "left")
    own = own.filter(F.col("street_agreement") >= SHARE).withColumn("street_confidence", F.when(
        (F.col("street_n") >= 3) & (F.col("street_agreement") >= 0.8), "high").when(F.col("street_n") >= 2, "medium").otherwise("low"))
    out = own
    if oml is not None:
        more = oml.filter(F.col("street_agreement") >= SHARE).filter("street is not null").join(out.select("USRN"), "USRN", "left_anti")
        out = union_all(out, more.select("USRN", "street", "street_n", "street_agreement", F.lit("oml_road").alias("street_confidence")))
    if osm is not None:
        more = osm.join(out.select("USRN"), "USRN", "left_anti").select("USRN", "street", F.lit("osm_road").alias("street_confidence"))
        out = union_all(out, more)
    if places is not None:
        votes = uprn_usrn.join(places.select("UPRN", F.col("district").alias("d1")), "UPRN")
        best = majority(votes, ["USRN"], "d1").select("USRN", "d1")
        out = out.join(best, "USRN", "left").withColumn("district", F.coalesce("district", "d1")).drop("d1")
    if authorities is not None:
        out = out.join(authorities.select("USRN", F.col("district").alias("d2")), "USRN", "left").withColumn("district", F.coalesce("district", "d2")).drop("d2")
    facts = ["oml_classification", "oml_class_agreement", "oml_road_number"]
    if oml is not None:
        return out.join(oml.select("USRN", *facts), "USRN", "left")
    return out.withColumns({c: F.lit(None).cast("double" if c.endswith("agreement") else "string") for c in facts})


def gap_streets(known: DataFrame) -> DataFrame:
    """Streets where two consecutive numbers of one parity differ by the gap."""
    w = W.partitionBy("USRN", "parity").orderBy("num")
    nums = known.withColumn("num", _number()).filter("num is not null").select("USRN", "num", F.pmod("num", F.lit(2)).alias("parity")).distinct()
    return nums.withColumn("gap", F.col("num") - F.lag("num").over(w)).filter(F.col("gap") == GAP).select("USRN").distinct()


def _number():
    return F.expr("try_cast(regexp_replace(house_number, '[A-Za-z]', '') AS bigint)")


def gap_guesses(unknown: DataFrame, known: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Numbers for properties that alone stand in a gap: (UPRN, USRN, house_number, postcode, guess_between).

    ``unknown``: UPRN, USRN, X, Y.  ``known``: also house_number and postcode.  Along each street's main
    axis, between neighbours four apart with one postcode, the only unknown property on their side
    takes the number between.  A property guessed twice, or far from the street's line, gets none.
    """
    streets = gap_streets(known).join(unknown.select("USRN").distinct(), "USRN", "left_semi")
    kn = known.withColumn("num", _number()).filter("num is not null and X is not null").join(streets, "USRN", "left_semi")
    un = unknown.filter("X is not null").join(streets, "USRN", "left_semi")
    both = kn.select("USRN", "X", "Y").unionByName(un.select("USRN", "X", "Y"))
    axis = both.groupBy("USRN").agg(
        F.avg("X").alias("mx"), F.avg("Y").alias("my"),
        (F.lit(0.5) * F.atan2(2 * F.covar_samp("X", "Y"), F.var_samp("X") - F.var_samp("Y"))).alias("turn"))
    along = (F.col("X") - F.col("mx")) * F.cos("turn") + (F.col("Y") - F.col("my")) * F.sin("turn")
    across = (F.col("Y") - F.col("my")) * F.cos("turn") - (F.col("X") - F.col("mx")) * F.sin("turn")
    kn, un = (d.join(axis, "USRN").withColumns({"t": along, "s": across}) for d in (kn, un))
    w = W.partitionBy("USRN", F.pmod("num", F.lit(2))).orderBy("num", "UPRN")
    nxt = {f"{c}2": F.lead(c).over(w) for c in ("num", "t", "s", "postcode")}
    gaps = kn.withColumns(nxt).filter((F.col("num2") - F.col("num") == GAP) & (F.abs(F.col("t2") - F.col("t")) <= ALONG) & (F.col("postcode") == F.col("postcode2")))
    gaps = gaps.select("USRN", "num", "num2", "postcode", F.least("t", "t2").alias("lo"), F.greatest("t", "t2").alias("hi"), ((F.col("s") + F.col("s2")) / 2).alias("side"))
    hits = gaps.join(un.select("USRN", "UPRN", "X", "Y", "t", "s"), "USRN").filter(
        (F.col("t") > F.col("lo")) & (F.col("t") < F.col("hi")) & (F.abs(F.col("s") - F.col("side")) < ACROSS))
    lone = once_only(once_only(hits, ["USRN", "num", "num2"]), ["UPRN"])
    out = lone.select("UPRN", "USRN", (F.col("num") + 2).cast("string").alias("house_number"), "postcode",
                      F.concat_ws("-", F.col("num").cast("string"), F.col("num2").cast("string")).alias("guess_between"), "X", "Y")
    if lines is not None:
        d = F.min(G.segment_distance(*map(F.col, ("X", "Y", "x1", "y1", "x2", "y2")))).alias("d")
        far = out.join(lines, "USRN").groupBy("UPRN").agg(d).filter(F.col("d") >= FROM_LINE)
        out = out.join(far, "UPRN", "left_anti")
    return out.drop("X", "Y")


def infill(candidates: DataFrame, buildings: DataFrame, uprn_usrn: DataFrame, names: DataFrame, guesses: DataFrame,
           postcode_district: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """What is inferred for properties without an address: from buildings, else a street's name and a guessed number."""
    osm = buildings.select(
        "UPRN", F.upper("osm_housenumber").alias("house_number"), K.normalise_name("osm_street").alias("street"), F.col("osm_postcode").alias("postcode"),
        F.when(F.col("osm_postcode").isNotNull(), "osm").alias("postcode_source"), F.col("osm_building_name").alias("building_name"),
        K.normalise_name("osm_city").alias("osm_city"), F.lit("osm_building").alias("address_source"), F.lit("osm").alias("number_source"),
        F.lit(False).alias("number_guessed"), F.lit(None).cast("string").alias("guess_between"), F.lit("high").alias("street_confidence"))
    on_street = candidates.select("UPRN").join(uprn_usrn, "UPRN").join(names.select("USRN", "street", "street_confidence", F.col("district").alias("usrn_district")), "USRN")
    on_street = first_per_key(on_street, ["UPRN"], F.col("USRN"))
    g = guesses.select("UPRN", "house_number", "postcode", "guess_between")
    rest = on_street.join(osm.select("UPRN"), "UPRN", "left_anti").join(g, "UPRN", "left")
    hit = F.col("guess_between").isNotNull()
    rest = rest.select("UPRN", "house_number", "street", "postcode", F.when(hit, "gap_neighbours").alias("postcode_source"), F.lit("usrn_street").alias("address_source"),
                       F.when(hit, "gap_guess").alias("number_source"), hit.alias("number_guessed"), "guess_between", "street_confidence")
    out = union_all(osm, rest).join(postcode_district.select("postcode", "district"), "postcode", "left")
    out = out.join(on_street.select("UPRN", "usrn_district"), "UPRN", "left")
    out = out.withColumn("district", F.coalesce("district", "usrn_district", "osm_city")).drop("usrn_district")
    out = apply_places(out, places) if places is not None else out
    return out.join(candidates.select("UPRN", "LATITUDE", "LONGITUDE"), "UPRN", "left")


def apply_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The register's postcode and district win; a guessed number whose postcode they contradict is withdrawn."""
    joined = rows.join(places.select("UPRN", F.col("postcode").alias("__p"), F.col("district").alias("__d")), "UPRN", "left")
    clash = F.coalesce(F.col("number_guessed") & (F.col("postcode") != F.col("__p")), F.lit(False))
    null = F.lit(None).cast("string")
    return joined.withColumns({
        "house_number": F.when(clash, null).otherwise(F.col("house_number")), "number_source": F.when(clash, null).otherwise(F.col("number_source")),
        "guess_between": F.when(clash, null).otherwise(F.col("guess_between")), "number_guessed": F.when(clash, F.lit(False)).otherwise(F.col("number_guessed")),
        "postcode": F.coalesce("__p", "postcode"), "postcode_source": F.when(F.col("__p").isNotNull(), "nsul").otherwise(F.col("postcode_source")),
        "district": F.coalesce("__d", "district"),
    }).drop("__p", "__d")


def street_centroids(names: DataFrame, middles: DataFrame, by: str = "district") -> DataFrame:
    """(key, LATITUDE, LONGITUDE, n_usrn): where streets of one name in a district (or postcode) are, if close together."""
    rows = names.filter(F.col(by).isNotNull()).select("USRN", "street", by).join(middles.select("USRN", "x", "y"), "USRN")
    out = spatial.centroids(rows, by, "street", most=1500.0 if by == "district" else None)
    at = G.degrees_point("x", "y")
    return out.withColumn("p", at).select(F.concat(by, F.lit("|"), "street").alias("key"), F.col("p.lat").alias("LATITUDE"), F.col("p.lon").alias("LONGITUDE"), "n_usrn")
