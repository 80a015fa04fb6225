"""Queries over the synthetic registers, one per operator or group of them, and their SQL.

Each entry runs the operator itself; its SQL is written on its own, for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boilerplate as B
from ..functions import geo as G
from ..functions import keys as K
from ..functions.numbers import split_numbers_udf
from ..operators import addresses, audits, fuzzy, geocode_queue, lookups, master, prices, spatial, titles
from ..operators import relational as R
from ..sources import readers, sinks
from .views import VIEWS, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(views: str = "", sql: str | None = None):
    """Register a function of (spark, the named views) under its own name."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tables = [spark.read.parquet(f"{sf_dir}/{n}.parquet") if n not in VIEWS else view(spark, sf_dir, n) for n in views.split()]
            return f(spark, *tables)

        QUERIES[f.__name__] = run
        if sql is not None:
            own = " ".join(n for n in views.split() if n in VIEWS)
            ORACLE_SQL[f.__name__] = with_views(own, sql) if own else sql
        return f

    return add


# -- SQL of keys

def s_pc(x: str) -> str:
    return f"nullif(upper(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')), '')"


def s_name(x: str) -> str:
    return f"nullif(trim(regexp_replace(regexp_replace(upper({x}), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), '')"


def s_seg(x: str) -> str:
    return f"nullif(regexp_extract({x}, '^[^,]+'), '')"


def s_num(x: str) -> str:
    return f"upper(nullif(regexp_extract({x}, '^[0-9]+[A-Za-z]?\\b'), ''))"


def s_street(x: str) -> str:
    """Without the collapse of repeated phrases, which needs a back-reference and does not occur here."""
    rest = f"trim(regexp_replace(regexp_replace(regexp_replace({s_seg(x)}, '^\\s*[0-9]+[A-Za-z]?\\b[\\s,]*', ''), '^\\([^()]*\\)\\s*', ''), '\\s+', ' ', 'g'))"
    second = f"trim(nullif(regexp_extract({x}, '^[^,]+,\\s*([^,]+)', 1), ''))"
    best = f"CASE WHEN {rest} = '' THEN {second} ELSE {rest} END"
    return f"CASE WHEN regexp_matches({s_seg(x)}, '^\\s*[0-9]+[A-Za-z]?\\b') AND length({best}) >= 4 THEN {best} END"


def s_building(x: str) -> str:
    words = ", ".join(f"'{w}'" for w in K.GENERIC_WORDS)
    n = s_name(s_seg(x))
    return f"CASE WHEN length({n}) >= 4 AND NOT regexp_matches({n}, '^[0-9]') AND regexp_extract({n}, '^[A-Z0-9]+') NOT IN ({words}) THEN trim(regexp_replace({s_seg(x)}, '\\s+', ' ', 'g')) END"


def s_key(a: str, p: str) -> str:
    return f"({s_pc(p)} || '|' || {s_num(a)})"


def s_bkey(a: str, p: str) -> str:
    return f"({s_pc(p)} || '|' || {s_name(s_building(a))})"


def s_skey(n: str, s: str, d: str) -> str:
    return f"({s_name(d)} || '|' || {s_name(s)} || '|' || upper({n}))"


def s_valid(x: str) -> str:
    return f"coalesce(regexp_matches(trim({x}), '{K.WHOLE_POSTCODE}'), false)"


# -- text

@query("titles", f"""SELECT row_id, {s_pc('postcode')} AS d2, {s_name('district')} AS d3, {s_num('address_line')} AS d4, {s_key('address_line', 'postcode')} AS d5,
  {s_street('address_line')} AS d6, {s_building('address_line')} AS d7, {s_bkey('address_line', 'postcode')} AS d8,
  {s_skey(s_num('address_line'), s_street('address_line'), 'district')} AS d9, {s_valid('postcode')} AS c7,
  regexp_matches(address_line, '(?i)\\bsub[- ]?stations?\\b') AS c6 FROM titles""")
def d2_d9_keys(spark, t):
    line = "address_line"
    return t.select(
        "row_id", K.normalise_postcode("postcode").alias("d2"), K.normalise_name("district").alias("d3"), K.house_number(line).alias("d4"),
        K.match_key(line, "postcode").alias("d5"), K.street_name(line).alias("d6"), K.building_name(line).alias("d7"), K.building_key(line, "postcode").alias("d8"),
        K.street_number_key(K.house_number(line), K.street_name(line), "district").alias("d9"), K.is_valid_postcode("postcode").alias("c7"), K.is_substation(line).alias("c6"))


_SUFFIX = "|".join(K.ROAD_SUFFIXES)


@query("titles", f"""SELECT row_id, list_last(regexp_extract_all(address_line, '[A-Z][A-Za-z''-]*(?:\\s+[A-Z][A-Za-z''-]*){{0,4}}\\s+(?:{_SUFFIX})\\b')) AS street FROM titles""")
def d10_buried_street(spark, t):
    return t.select("row_id", K.buried_street("address_line").alias("street"))


_CLEAN = {"d12": B.clean_airspace, "d13": B.clean_mines, "d14": B.clean_compass, "d15": B.clean_spelling, "d16": B.clean_land, "d17": B.clean_roof_basement, "d18": B.clean_flats}


#: What becomes of the twelve kinds of text in ``legal``, written down by hand: {kind: {step: text}}.
_LEGAL = {
    0: {"d12": "@ASP 12 High Street, London", "tidy": "12 High Street, London"},
    1: {"d13": "@MNS 12 High Street, Leeds", "d16": "all mines and minerals as excepted filed @POS the Registry 12 High Street, Leeds", "tidy": "12 High Street, Leeds"},
    2: {"d14": "land on @COMPASS Weeland Road", "d16": "@LND @POS north @POS Weeland Road", "tidy": "Weeland Road"},
    3: {"d15": "Land adjoining substation, Field Lane", "d16": "@LND adjoing the Sub-Station, Field Lane", "tidy": "substation, Field Lane"},
    4: {"d18": "@FTS 4 Foo Street", "tidy": "4 Foo Street"},
    5: {"d17": "@ASP 55 Prospect Terrace", "tidy": "55 Prospect Terrace"},
    6: {"d16": "@LND @EXTRA @POS the rear of 3 Mill Lane", "tidy": "3 Mill Lane"},
    7: {"d18": "@FTS 55 Broadway, London", "tidy": "55 Broadway, London"},
    8: {"d14": "glebe land on @COMPASS Church Lane", "d16": "@LND @POS north and east sides of Church Lane", "tidy": "Church Lane"},
    9: {"d18": "@FTS 9 Station Road", "tidy": "9 Station Road"},
    10: {"d17": "@ASP 7 Park View", "tidy": "7 Park View"},
}


def _legal(step: str) -> str:
    known = "".join(f" WHEN {kind} THEN '{said[step]} ' || CAST(id % 30 AS VARCHAR)" for kind, said in _LEGAL.items() if step in said)
    return f"CASE id % 12{known} ELSE text END"


@query("legal", f"SELECT id, {', '.join(f'{_legal(n)} AS {n}' for n in _CLEAN)} FROM legal")
def d12_d18_boilerplate(spark, t):
    return t.select("id", *[f(F.col("text")).alias(n) for n, f in _CLEAN.items()])


@query("legal", f"SELECT id, {_legal('tidy')} AS tidy FROM legal")
def d11_d24_tidy(spark, t):
    return t.select("id", B.tidy(B.clean_boilerplate("text")).alias("tidy"))


@query("titles", """SELECT row_id, CASE WHEN address_line = '' THEN 'empty' WHEN regexp_matches(address_line, '@[A-Za-z]+') THEN 'residual_tag'
  WHEN (regexp_matches(trim(address_line), '^[0-9]+[A-Za-z]?$') OR NOT regexp_matches(address_line, '[A-Za-z]')) AND postcode IS NULL THEN 'bare_number_no_postcode'
  WHEN length(address_line) < 5 AND postcode IS NULL THEN 'too_short' WHEN regexp_matches(address_line, '(?i)^Properties at\\b') THEN 'multi_property_list'
  WHEN regexp_matches(address_line, '(?i)filed plan|title number|deed dated|easement') AND length(address_line) > 90 THEN 'legalese'
  WHEN len(regexp_extract_all(address_line, '\\S+')) > 8 AND len(regexp_extract_all(address_line, '(?i)\\b(the|of|and|to|as|is|for|in|by|with|on|or|any|all|such|so|much)\\b'))
     / len(regexp_extract_all(address_line, '\\S+')) > 0.45 THEN 'legalese' ELSE 'ok' END AS reason FROM titles""")
def c8_geocodability(spark, t):
    return t.select("row_id", K.geocodability("address_line", "postcode").alias("reason"))


@query("orders", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'CONSTANTINE HOUSE, 14 BOULEVARD DRIVE' END AS base FROM orders")
def d25_flat_base(spark, o):
    text = F.concat(F.lit("Flat "), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, " Constantine House,  14 Boulevard Drive").otherwise(", Mill Fold"))
    return o.select("o_orderkey", K.flat_base(text).alias("base"))


@query("orders", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Ridge Way' END AS street, CAST(o_orderkey AS VARCHAR) AS number FROM orders""")
def d20_osm_tag(spark, o):
    tags = F.concat(F.lit('"addr:housenumber"=>"'), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, '","addr:street"=>"Ridge Way"').otherwise('"'))
    return o.select("o_orderkey", K.osm_tag(tags, "addr:street").alias("street"), K.osm_tag(tags, "addr:housenumber").alias("number"))


@query("titles")
def e1_split_numbers(spark, t):
    text = F.concat(F.col("row_id") % 90 + 1, F.lit(" to "), F.col("row_id") % 90 + 9, F.element_at(F.array(*map(F.lit, (" (even) ", " (odd) ", " ", " inclusive "))), (F.col("row_id") % 4 + 1).cast("int")), F.lit("Example Street"))
    return t.select("row_id", F.explode(split_numbers_udf(text)).alias("address"))


def _register(t: DataFrame) -> DataFrame:
    return t.withColumnsRenamed({"title_number": "Title Number", "tenure": "Tenure", "property_address": "Property Address", "district": "District", "postcode": "Postcode"}).drop("address_line")


_TWO = "len(regexp_extract_all(property_address, '\\b[A-Z][A-HJ-Y]?[0-9]{1,2} [0-9][A-Z]{2}\\b')) = 2"


@query("titles", f"""SELECT row_id, split_part(property_address, ' (', 1) AS AddressLine, regexp_extract(property_address, '\\(([^()]*)\\)', 1) AS PostalCode FROM titles WHERE {_TWO}
  UNION ALL SELECT row_id, regexp_extract(property_address, '\\) and (2 [^(]*) \\(', 1), 'AB1 1CD' FROM titles WHERE {_TWO}""")
def e4_split_multi_postcode(spark, t):
    rows = titles.split_multi_postcode(
        _register(t).withColumn("n", K.count_postcodes(F.col("`Property Address`"))).filter("n >= 2"))
    return rows.select("row_id", "AddressLine", "PostalCode")


# -- titles

@query("new_titles old_titles", """SELECT n.title_number, n.property_address, CASE WHEN o.property_address IS NULL THEN 'new' WHEN o.property_address = n.property_address THEN 'unchanged'
  ELSE 'changed' END AS diff_status FROM new_titles n LEFT JOIN old_titles o USING (title_number)""")
def c1_diff_titles(spark, new, old):
    names = {"title_number": "Title Number", "property_address": "Property Address"}
    return titles.diff_titles(new.withColumnsRenamed(names), old.withColumnsRenamed(names)).select(
        F.col("`Title Number`").alias("title_number"), F.col("`Property Address`").alias("property_address"), "diff_status")


_N_PC = f"len(regexp_extract_all(property_address, '{K.POSTCODE}'))"


@query("titles", f"""WITH f AS (SELECT *, {_N_PC} AS n_postcode, regexp_matches(property_address, '(?i)\\bland\\b') AS land,
   CASE WHEN postcode IS NOT NULL THEN replace(replace(property_address, postcode, ''), '()', '') END AS bare FROM titles WHERE tenure = 'Freehold')
  SELECT row_id, CAST(n_postcode AS BIGINT) AS n_postcode, land, CASE WHEN postcode IS NULL THEN CASE WHEN land THEN 'nopc_land' ELSE 'nopc' END WHEN land THEN 'land_pc' WHEN n_postcode >= 2 THEN 'multi_postcode'
   WHEN length(bare) > 54 THEN 'simple_long' ELSE 'simple_short' END AS category,
   CASE WHEN postcode IS NOT NULL AND NOT land AND n_postcode < 2 THEN bare END AS address_line FROM f""")
def c2_categorise_freehold(spark, t):
    out = titles.categorise_freehold(_register(t))
    return out.select("row_id", F.col("n_postcode").cast("long").alias("n_postcode"), "land", "category", F.col("AddressLine").alias("address_line"))


@query("titles", f"""SELECT row_id, category, CAST({_N_PC} AS BIGINT) AS n_postcode FROM (SELECT *, 'leasehold' AS category FROM titles WHERE tenure = 'Leasehold'
  UNION ALL SELECT *, 'overseas' FROM titles)""")
def c3_c4_categorise(spark, t):
    r = _register(t)
    return R.union_all(titles.categorise_leasehold(r), titles.categorise_overseas(r)).select("row_id", "category", F.col("n_postcode").cast("long").alias("n_postcode"))


@query("titles", """SELECT row_id, CASE WHEN NOT regexp_matches(property_address, '(?i)substation|sub-station|sub station|part of') THEN 'simple'
  WHEN regexp_matches(property_address, '(?i)\\bsub[- ]?stations?\\b') THEN 'substation' ELSE 'other_complex' END AS kind FROM titles""")
def c5_nopc_kind(spark, t):
    return t.select("row_id", titles.nopc_kind("property_address").alias("kind"))


def _split(t: DataFrame) -> DataFrame:
    r = _register(t).withColumn("orig_row_id", F.col("row_id"))
    return R.union_all(titles.categorise_freehold(r), titles.categorise_leasehold(r))


@query("titles")
def e7_split_addresses(spark, t):
    return titles.build_split_addresses(_split(t)).select("orig_row_id", "category", "AddressLine", "AddressLine_tagged", "PostalCode", "parse_ok")


@query("new_titles old_titles", """WITH s AS (SELECT n.title_number, n.property_address, n.property_address = o.property_address AS same FROM new_titles n LEFT JOIN old_titles o USING (title_number)),
  c AS (SELECT title_number FROM s WHERE same AND CAST(substr(title_number, 2) AS BIGINT) % 2 = 0)
  SELECT title_number, 'carried' AS branch FROM c UNION ALL SELECT title_number, 'needed' FROM s WHERE title_number NOT IN (SELECT title_number FROM c)""")
def f2_carry_forward(spark, new, old):
    names = {"title_number": "Title Number", "property_address": "Property Address"}
    diff = titles.diff_titles(new.withColumnsRenamed(names), old.withColumnsRenamed(names)).withColumn("AddressLine", F.col("`Property Address`"))
    results = old.filter(F.substring("title_number", 2, 20).cast("long") % 2 == 0).select(
        F.col("title_number").alias("Title Number"), F.col("property_address").alias("old_property_address"), F.col("property_address").alias("old_address_line"), F.lit(51.0).alias("latitude"))
    carried, needed = titles.carry_forward(diff, results)
    pick = lambda d, b: d.select(F.col("`Title Number`").alias("title_number"), F.lit(b).alias("branch"))
    return pick(carried, "carried").unionByName(pick(needed, "needed"))


# -- lookups and the cascade

@query("epc_dom", f"SELECT * FROM (SELECT {s_key('addr', 'POSTCODE')} AS key, UPRN FROM epc_dom) QUALIFY count(*) OVER (PARTITION BY key) = 1 AND key IS NOT NULL")
def h1_lookup_dedupe(spark, e):
    return R.lookup_dedupe(e.select(K.match_key("addr", "POSTCODE").alias("key"), "UPRN"))


_ONCE = "key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY key) = 1"
_EPC = f"""epc AS (SELECT * FROM (SELECT {s_key('addr', 'POSTCODE')} AS key, UPRN, LATITUDE, LONGITUDE, 'epc_dom' AS src FROM epc_dom
   UNION ALL SELECT {s_key('adr1', 'postcode')}, UPRN, LATITUDE, LONGITUDE, 'epc_nondom' FROM epc_nondom) WHERE {_ONCE})"""
_SOLD = "(SELECT address1, sales.postcode, uprns.UPRN, LATITUDE, LONGITUDE FROM sales JOIN uprns ON sales.uprn = uprns.UPRN) sold"
_PP = f"""pp AS (SELECT * FROM (SELECT {s_key('address1', 'postcode')} AS key, UPRN, LATITUDE, LONGITUDE, 'price_paid' AS src FROM {_SOLD}) WHERE {_ONCE})"""
_BL = f"""bl AS (SELECT * FROM (SELECT {s_bkey('addr', 'POSTCODE')} AS key, UPRN, LATITUDE, LONGITUDE, 'epc_dom_building' AS src FROM epc_dom
   UNION ALL SELECT {s_bkey('adr1', 'postcode')}, UPRN, LATITUDE, LONGITUDE, 'epc_nondom_building' FROM epc_nondom
   UNION ALL SELECT {s_bkey('address1', 'postcode')}, UPRN, LATITUDE, LONGITUDE, 'price_paid_building' FROM {_SOLD}) WHERE {_ONCE})"""
_PD = """pd AS (SELECT postcode, district FROM (SELECT postcode, district, count(*) AS n FROM uprns GROUP BY postcode, district) QUALIFY row_number() OVER (PARTITION BY postcode ORDER BY n DESC, district) = 1)"""
_ST = f"""st AS (SELECT key, UPRN, LATITUDE, LONGITUDE, src FROM (SELECT {s_skey('house_number', 'street', 'district')} AS key, UPRN, LATITUDE, LONGITUDE, address_source || '_street' AS src FROM known LEFT JOIN pd USING (postcode)) WHERE {_ONCE})"""
_IF = f"""inf AS (SELECT key, UPRN, LATITUDE, LONGITUDE, 'infill_' || address_source AS src, CASE WHEN number_guessed THEN 'guess' WHEN address_source = 'osm_building' THEN 'medium' ELSE 'low' END AS q FROM
   (SELECT {s_pc('postcode')} || '|' || upper(house_number) AS key, * FROM infill WHERE house_number IS NOT NULL UNION ALL SELECT {s_skey('house_number', 'street', 'district')}, * FROM infill WHERE house_number IS NOT NULL)
   WHERE {_ONCE})"""
_PS = f"""ps AS (SELECT key, UPRN, LATITUDE, LONGITUDE, 'postcode_singleton' AS src FROM (SELECT {s_pc('postcode')} AS key, min(UPRN) AS UPRN FROM nsul GROUP BY postcode HAVING count(*) = 1) JOIN (SELECT UPRN, LATITUDE, LONGITUDE FROM uprns) USING (UPRN))"""
_SS = f"""sd AS (SELECT s.UPRN, s.LATITUDE, s.LONGITUDE, {s_name('district')} AS d FROM substations s JOIN (SELECT UPRN, district FROM uprns) USING (UPRN)),
  sub AS (SELECT * FROM (SELECT d || '|' || {s_name('street')} AS key, UPRN, LATITUDE, LONGITUDE, 'substation_street' AS src, 'medium' AS q FROM sd JOIN uprn_usrn USING (UPRN) JOIN usrn_streets USING (USRN)
   UNION ALL SELECT d, UPRN, LATITUDE, LONGITUDE, 'substation_district_singleton', 'low' FROM (SELECT * FROM sd QUALIFY count(*) OVER (PARTITION BY d) = 1)) WHERE {_ONCE})"""
_BURIED = f"list_last(regexp_extract_all(address_line, '[A-Z][A-Za-z''-]*(?:\\s+[A-Z][A-Za-z''-]*){{0,4}}\\s+(?:{'|'.join(K.ROAD_SUFFIXES)})\\b'))"
_HITS = [
    ("epc", "num", "'high'", "src"), ("pp", "num", "'high'", "src"), ("bl", "bld", "'high'", "src"), ("st", "str", "'medium'", "src"),
    ("sub", "CASE WHEN ss THEN d || '|' || seg END", "t.q", "src"), ("sub", "CASE WHEN ss THEN d END", "t.q", "src"),
    ("inf", "num", "t.q", "src"), ("inf", "str", "t.q", "src"), ("ps", "pc", "'medium'", "src"),
    ("boundary_points", "CASE WHEN num0 IS NULL THEN pc || '|' || seg END", "'street'", "'usrn_street_postcode_boundary'"),
    ("postcode_middles", "CASE WHEN num0 IS NULL THEN pc || '|' || seg END", "'street'", "'usrn_street_centroid_postcode'"),
    ("street_middles", "CASE WHEN num0 IS NULL THEN d || '|' || seg END", "'street'", "'usrn_street_centroid'"),
    ("boundary_points", "CASE WHEN num0 IS NULL THEN pc || '|' || bur END", "'street'", "'usrn_street_postcode_boundary_buried'"),
    ("postcode_middles", "CASE WHEN num0 IS NULL THEN pc || '|' || bur END", "'street'", "'usrn_street_centroid_postcode_buried'"),
    ("street_middles", "CASE WHEN num0 IS NULL THEN d || '|' || bur END", "'street'", "'usrn_street_centroid_buried'"),
]
_CASCADE = f"""k AS (SELECT row_id, {s_key('address_line', 'postcode')} AS num, {s_bkey('address_line', 'postcode')} AS bld, {s_num('address_line')} AS num0,
     {s_skey(s_num('address_line'), s_street('address_line'), 'district')} AS str, {s_pc('postcode')} AS pc, {s_name('district')} AS d, {s_name(s_seg('address_line'))} AS seg,
     {s_name(_BURIED)} AS bur, regexp_matches(address_line, '(?i)\\bsub[- ]?stations?\\b') AS ss FROM titles),
  h AS ({' UNION ALL '.join(f"SELECT row_id, {i} AS stage, {'NULL' if t.endswith(('middles', 'points')) else 't.UPRN'} AS UPRN, t.LATITUDE, t.LONGITUDE, {q} AS q, {src} || '_match' AS src FROM k JOIN {t} t ON t.key = {key}" for i, (t, key, q, src) in enumerate(_HITS))})
  SELECT k.row_id, h.UPRN, h.LATITUDE, h.LONGITUDE, h.q AS match_quality, h.src AS source FROM k LEFT JOIN (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY stage) = 1) h ON h.row_id = k.row_id"""
_CASCADE_VIEWS = "titles epc_dom epc_nondom sales known infill nsul uprns substations uprn_usrn usrn_streets boundary_points postcode_middles street_middles"


def _lookups(dom, non, sales, known, infill, nsul, uprns, substations=None, uprn_usrn=None, usrn_streets=None, boundary=None, by_postcode=None, by_district=None) -> dict[str, DataFrame]:
    sold = sales.join(uprns.select(F.col("UPRN").alias("uprn"), "LATITUDE", "LONGITUDE"), "uprn")
    found = {
        "epc": lookups.epc_lookup(dom, non), "price_paid": lookups.price_paid_lookup(sold), "building": lookups.building_lookup(dom, non, sold),
        "street": lookups.street_lookup(known, lookups.postcode_district(uprns)), "infill": lookups.infill_lookup(infill),
        "postcode_singleton": lookups.postcode_singletons(nsul, uprns),
        "substation": substations and lookups.substation_lookup(substations, uprns.select("UPRN", "district"), uprn_usrn, usrn_streets),
        "street_postcode_boundary": boundary, "street_centroid_postcode": by_postcode, "street_centroid": by_district,
    }
    return {name: table for name, table in found.items() if table is not None}


def _asked(t: DataFrame) -> DataFrame:
    return t.select("row_id", F.col("title_number").alias("Title Number"), F.col("address_line").alias("AddressLine"), F.col("postcode").alias("PostalCode"), F.col("district").alias("District"))


@query(_CASCADE_VIEWS, f"WITH {_EPC}, {_PP}, {_BL}, {_PD}, {_ST}, {_IF}, {_PS}, {_SS}, {_CASCADE}")
def f17_cascade(spark, t, *tables):
    """All fifteen stages."""
    return lookups.cascade(_asked(t), _lookups(*tables)).select("row_id", "UPRN", "LATITUDE", "LONGITUDE", "match_quality", "source")


@query("substations uprns uprn_usrn usrn_streets", f"WITH {_SS} SELECT key, UPRN, src AS match_source, q AS match_quality FROM sub")
def l7_substations(spark, s, u, usrn, names):
    return lookups.substation_lookup(s, u.select("UPRN", "district"), usrn, names).select("key", "UPRN", "match_source", "match_quality")


@query("titles epc_dom epc_nondom", f"""WITH {_EPC} SELECT row_id, UPRN, CASE WHEN UPRN IS NOT NULL THEN 'high' END AS match_quality FROM titles LEFT JOIN epc ON epc.key = {s_key('address_line', 'postcode')}""")
def f16_match_stage(spark, t, dom, non):
    out = lookups.match_stage(_asked(t), K.match_key("AddressLine", "PostalCode"), lookups.epc_lookup(dom, non), "high")
    return out.select("row_id", "UPRN", F.when(F.col("UPRN").isNotNull(), F.col("match_quality")).alias("match_quality"))


@query("sales", f"SELECT key, UPRN FROM (SELECT {s_key('address1', 'postcode')} AS key, uprn AS UPRN FROM sales WHERE uprn IS NOT NULL) GROUP BY key, UPRN HAVING key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY key) = 1")
def l2_price_paid_by_uprn(spark, s):
    return lookups.price_paid_lookup(s.withColumns({"LATITUDE": F.lit(0.0), "LONGITUDE": F.lit(0.0)}), "by_uprn").select("key", "UPRN")


@query("infill", f"WITH {_IF} SELECT key, UPRN, src AS match_source, q AS match_quality FROM inf")
def l5_infill_lookup(spark, i):
    return lookups.infill_lookup(i).select("key", "UPRN", "match_source", "match_quality")


@query("nsul uprns", f"WITH {_PS} SELECT key, UPRN, LATITUDE FROM ps")
def l6_g8_postcode_singletons(spark, n, u):
    return lookups.postcode_singletons(n, u).select("key", "UPRN", "LATITUDE")


@query("uprns", f"WITH {_PD} SELECT postcode, district FROM pd")
def g5_postcode_district(spark, u):
    return lookups.postcode_district(u)


@query("known uprn_usrn uprns", """WITH s AS (SELECT upper(street) AS street, district FROM known JOIN uprns USING (UPRN)) SELECT street, count(DISTINCT district) AS n_district FROM s GROUP BY street""")
def g6_street_ambiguity(spark, k, uu, u):
    return lookups.street_ambiguity(k.join(u.select("UPRN", "district"), "UPRN"))


@query("titles known uprns", f"""WITH a AS (SELECT upper(street) AS street, count(DISTINCT uprns.district) AS n FROM known JOIN uprns USING (UPRN) GROUP BY 1)
  SELECT row_id, postcode IS NULL AND coalesce(n >= 3, false) AS ambiguous FROM titles LEFT JOIN a ON a.street = {s_name(s_street('address_line'))}""")
def c10_ambiguous_street(spark, t, k, u):
    return lookups.flag_ambiguous(_asked(t), lookups.street_ambiguity(k.join(u.select("UPRN", "district"), "UPRN"))).select("row_id", "ambiguous")


@query("nsul uprns lad_names", f"""WITH {_PD}, v AS (SELECT lad_code, district, count(*) AS n FROM nsul JOIN pd USING (postcode) GROUP BY lad_code, district QUALIFY row_number() OVER (PARTITION BY lad_code ORDER BY n DESC, district) = 1)
  SELECT UPRN, nsul.postcode, coalesce(v.district, lad_name) AS district FROM nsul LEFT JOIN v USING (lad_code) LEFT JOIN lad_names USING (lad_code)""")
def f13_f14_places(spark, n, u, names):
    return lookups.uprn_places(n, lookups.lad_district(n, lookups.postcode_district(u), names))


# -- similarity

_KN = f"lk AS (SELECT UPRN, {s_name('street')} AS txt, upper(house_number) AS num, {s_pc('known.postcode')} AS pc, {s_name('district')} AS dist FROM known LEFT JOIN uprns_d USING (UPRN))"


@query("sales known", f"""WITH q AS (SELECT transactionid AS id, {s_pc('postcode')} AS pc, upper(address1) AS num, {s_name('address3')} AS txt FROM sales WHERE uprn IS NULL),
  l AS (SELECT UPRN, {s_pc('postcode')} AS pc, upper(house_number) AS num, {s_name('street')} AS txt FROM known),
  p AS (SELECT q.id, l.UPRN, jaro_similarity(q.txt, l.txt) AS s, count(*) OVER (PARTITION BY q.id) AS n FROM q JOIN l USING (pc, num))
  SELECT id, UPRN, round(s, 6) AS score FROM p WHERE (s >= 0.9 OR n = 1) AND n <= 500 QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, UPRN) = 1""")
def k1_match_block(spark, s, k):
    rows = s.filter("uprn is null").select(F.col("transactionid").alias("row_id"), K.normalise_postcode("postcode").alias("block"), F.upper("address1").alias("number"), K.normalise_name("address3").alias("text"))
    table = k.select("UPRN", "LATITUDE", "LONGITUDE", K.normalise_postcode("postcode").alias("block"), F.upper("house_number").alias("number"), K.normalise_name("street").alias("text"))
    return fuzzy.match_block(rows, table, trust_single=True).select(F.col("row_id").alias("id"), "UPRN", F.round("score", 6).alias("score"))


_LOOKUP = f"""l AS (SELECT UPRN, {s_pc('postcode')} AS pc, upper(house_number) AS num, {s_name('street')} AS txt, NULL AS d FROM known
   UNION ALL SELECT UPRN, {s_pc('postcode')}, upper(house_number), coalesce({s_name('street')}, {s_name('building_name')}), {s_name('district')} FROM infill),
  l2 AS (SELECT l.UPRN, pc, num, txt, coalesce({s_name('p.district')}, l.d) AS d FROM l LEFT JOIN uprns p ON l.UPRN = p.UPRN)"""


@query("sales known infill uprns nsul", f"""WITH {_LOOKUP},
  q AS (SELECT transactionid AS id, {s_pc('postcode')} AS pc, {s_num('address1')} AS num, {s_name('address3')} AS txt, {s_name('la')} AS d FROM sales WHERE uprn IS NULL),
  a AS (SELECT q.id, l2.UPRN, jaro_similarity(q.txt, l2.txt) AS s, count(*) OVER (PARTITION BY q.id) AS n FROM q JOIN l2 USING (pc, num)),
  b1 AS (SELECT id, UPRN, s FROM a WHERE (s >= 0.9 OR n = 1) AND n <= 500 QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, UPRN) = 1),
  b AS (SELECT q.id, l2.UPRN, jaro_similarity(q.txt, l2.txt) AS s, count(*) OVER (PARTITION BY q.id) AS n FROM q JOIN l2 USING (d, num) WHERE q.id NOT IN (SELECT id FROM b1)),
  b2 AS (SELECT id, UPRN, s FROM b WHERE s >= 0.9 AND n <= 500 QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, UPRN) = 1),
  best AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2), {_PS}
  SELECT q.id, coalesce(best.UPRN, ps.UPRN) AS uprn, CASE WHEN best.id IS NOT NULL THEN CASE WHEN s >= 0.999 THEN 'high' ELSE 'fuzzy' END WHEN ps.key IS NOT NULL THEN 'medium' END AS match_quality
  FROM q LEFT JOIN best USING (id) LEFT JOIN ps ON ps.key = q.pc""")
def k4_rematch_sales(spark, s, k, i, u, n):
    table = fuzzy.fuzzy_lookup(k, i, u)
    return fuzzy.rematch_sales(s, table, lookups.postcode_singletons(n, u)).select(F.col("transactionid").alias("id"), "uprn", "match_quality")


@query("titles known infill uprns")
def k3_match_fuzzy(spark, t, k, i, u):
    table = fuzzy.fuzzy_lookup(k, i, u).join(u.select("UPRN", "x", "y"), "UPRN", "left")
    places = u.groupBy(K.normalise_postcode("postcode").alias("postcode")).agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return fuzzy.match_fuzzy(_asked(t), table, places).select("row_id", "UPRN", "fuzzy_score", "fuzzy_block")


@query("known infill uprns", f"WITH {_LOOKUP} SELECT UPRN, pc AS postcode, num AS house_number, txt AS street_norm, d AS district FROM l2")
def f15_fuzzy_lookup(spark, k, i, u):
    return fuzzy.fuzzy_lookup(k, i, u).select("UPRN", "postcode", "house_number", "street_norm", "district")


# -- aggregations, sales and classes

@query("releases", """SELECT UPRN, CAST(min(date) AS VARCHAR) AS date_first, CAST(max(date) AS VARCHAR) AS date_last, arg_max(X_COORDINATE, date) AS x, arg_max(LATITUDE, date) AS lat FROM releases GROUP BY UPRN""")
def g1_lifecycle(spark, r):
    return prices.lifecycle(r).select("UPRN", F.col("date_first").cast("string").alias("date_first"), F.col("date_last").cast("string").alias("date_last"), F.col("X_COORDINATE").alias("x"), F.col("LATITUDE").alias("lat"))


_SALES_AREA = "sa AS (SELECT s.*, LAD25CD, CAST(year(date) AS INT) AS y FROM sales s LEFT JOIN (SELECT LSOA21CD, min(LAD25CD) AS LAD25CD FROM areas GROUP BY 1) a USING (LSOA21CD))"
_MED = f"""{_SALES_AREA}, m AS (SELECT LAD25CD, y, property_type, median(price) AS pm, count(*) AS n FROM sa WHERE LAD25CD IS NOT NULL AND property_type <> 'O' GROUP BY ALL
   UNION ALL SELECT LAD25CD, y, 'O', median(price), count(*) FROM sa WHERE LAD25CD IS NOT NULL GROUP BY ALL)"""
_BASE_YEAR = 1997


@query("sales areas", f"WITH {_MED} SELECT LAD25CD, y AS year, property_type, round(pm, 4) AS price_median, n AS transactions FROM m")
def g2_medians(spark, s, a):
    rows = s.join(a.groupBy("LSOA21CD").agg(F.min("LAD25CD").alias("LAD25CD")), "LSOA21CD", "left")
    return prices.medians(rows).withColumn("price_median", F.round("price_median", 4))


@query("sales areas", f"""WITH {_MED}, g AS (SELECT m.LAD25CD, m.y, m.property_type, CASE WHEN m.pm > 0 THEN b.pm / m.pm END AS g FROM m LEFT JOIN m b ON b.LAD25CD = m.LAD25CD AND b.property_type = m.property_type AND b.y = {_BASE_YEAR}),
  l AS (SELECT * FROM sa WHERE uprn IS NOT NULL QUALIFY row_number() OVER (PARTITION BY uprn ORDER BY date DESC NULLS LAST, transactionid) = 1)
  SELECT uprn, transactionid, price, round_even(price * g / 1000, 0) * 1000 AS price_2025 FROM l LEFT JOIN g USING (LAD25CD, y, property_type)""")
def g3_nowcast(spark, s, a):
    one = a.groupBy("LSOA21CD").agg(F.min("LAD25CD").alias("LAD25CD"))
    return prices.nowcast(s, one, _BASE_YEAR).select("uprn", "transactionid", "price", "price_2025")


@query("uprns epc_dom epc_nondom sales areas", f"""WITH {_SALES_AREA}, l AS (SELECT uprn, property_type FROM sa WHERE uprn IS NOT NULL QUALIFY row_number() OVER (PARTITION BY uprn ORDER BY date DESC NULLS LAST, transactionid) = 1),
  f AS (SELECT UPRN, UPRN IN (SELECT UPRN FROM epc_dom) AS e, UPRN IN (SELECT UPRN FROM epc_nondom) AS n, UPRN IN (SELECT uprn FROM l WHERE property_type <> 'O') AS s, UPRN IN (SELECT uprn FROM l WHERE property_type = 'O') AS o FROM uprns)
  SELECT UPRN, CASE WHEN NOT e AND NOT n AND NOT s AND NOT o THEN 'unknown' WHEN (e OR s) AND NOT (n OR o) THEN 'domestic' WHEN (n OR o) AND NOT (e OR s) THEN 'non-domestic'
   WHEN e AND n AND NOT s AND NOT o THEN 'ambiguous epc' WHEN NOT e AND NOT n AND s AND o THEN 'ambiguous lr' ELSE 'ambiguous other' END AS class,
   UPRN % 10 = 9 AS "exists", UPRN % 2 = 1 AS newbuild FROM f""")
def c11_classify(spark, u, dom, non, s, a):
    now = prices.nowcast(s, a.groupBy("LSOA21CD").agg(F.min("LAD25CD").alias("LAD25CD")), _BASE_YEAR)
    dated = u.withColumns({
        "date_first": F.when(F.col("UPRN") % 2 == 1, F.lit("2021-01-01")).otherwise(F.lit("2019-01-01")).cast("date"),
        "date_last": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("UPRN") % 10).cast("int"))})
    return prices.classify(dated, now, dom, non).select("UPRN", "class", "exists", "newbuild")


_ADDR = "postcode, property_type, address1, address3, la"


@query("sales", f"""WITH k AS (SELECT {_ADDR}, min(uprn) AS u FROM sales WHERE uprn IS NOT NULL GROUP BY ALL)
  SELECT s.transactionid, coalesce(s.uprn, k.u) AS uprn FROM sales s LEFT JOIN k ON s.postcode IS NOT DISTINCT FROM k.postcode AND s.property_type = k.property_type AND s.address1 = k.address1 AND s.address3 = k.address3 AND s.la = k.la""")
def f3_f4_link_sales(spark, s):
    links = s.filter("uprn is not null").select("transactionid", "uprn", F.lit(None).cast("long").alias("parentuprn"), F.lit(None).cast("long").alias("usrn"))
    return prices.link_sales(s.drop("uprn"), links).select("transactionid", "uprn")


@query("sales epc_dom epc_nondom", """WITH d AS (SELECT replace(upper(addr), ',', '') AS line, POSTCODE AS pc, UPRN FROM epc_dom QUALIFY row_number() OVER (PARTITION BY line, pc ORDER BY year DESC, UPRN) = 1),
  n AS (SELECT replace(upper(adr1), ',', '') AS line, postcode AS pc, UPRN FROM epc_nondom QUALIFY row_number() OVER (PARTITION BY line, pc ORDER BY year DESC, UPRN) = 1)
  SELECT s.transactionid, coalesce(s.uprn, d.UPRN, n.UPRN) AS uprn FROM (SELECT *, upper(address1 || ' ' || address3) AS line FROM sales) s
  LEFT JOIN d ON d.line = s.line AND d.pc = s.postcode LEFT JOIN n ON n.line = s.line AND n.pc = s.postcode""")
def f5_match_registers(spark, s, dom, non):
    return prices.match_registers(s.withColumn("address3", F.upper("address3")), dom, non).select("transactionid", "uprn")


@query("sales", "SELECT property_type, la, count(*) AS n FROM sales GROUP BY ALL")
def g16_summary_counts(spark, s):
    return audits.summary_counts(s, "property_type", "la")


@query("queue_log", "SELECT count(*) AS n, min(ts) AS first FROM queue_log WHERE date_trunc('month', ts) = (SELECT date_trunc('month', max(ts)) FROM queue_log)")
def g18_month_usage(spark, q):
    last = q.agg(F.max(F.date_trunc("month", "ts"))).first()[0]
    return q.filter(F.date_trunc("month", "ts") == F.lit(last)).agg(F.count("*").alias("n"), F.min("ts").alias("first"))


@query("documents")
def g19_frequent_ngrams(spark, d):
    return audits.frequent_ngrams(d, "text", 3, 100, 6)


@query("queue_log", "SELECT queue_key, status, ts FROM queue_log QUALIFY row_number() OVER (PARTITION BY queue_key ORDER BY ts DESC, event_id, status) = 1")
def q_latest_state(spark, q):
    return geocode_queue.latest_state(q).select("queue_key", "status", "ts")


_G9 = f"""{_PD}, v AS (SELECT USRN, {s_name('street')} AS street, postcode FROM known JOIN uprn_usrn USING (UPRN)),
  s AS (SELECT USRN, street, count(*) AS n, sum(count(*)) OVER (PARTITION BY USRN) AS total FROM v GROUP BY USRN, street QUALIFY row_number() OVER (PARTITION BY USRN ORDER BY n DESC, street) = 1),
  c AS (SELECT USRN, postcode, count(*) AS n FROM v GROUP BY USRN, postcode QUALIFY row_number() OVER (PARTITION BY USRN ORDER BY n DESC, postcode) = 1),
  g9 AS (SELECT USRN, s.street, s.n AS street_n, round(s.n / total, 6) AS street_agreement, c.postcode, pd.district,
    CASE WHEN s.n >= 3 AND s.n / total >= 0.8 THEN 'high' WHEN s.n >= 2 THEN 'medium' ELSE 'low' END AS street_confidence
  FROM s JOIN c USING (USRN) LEFT JOIN pd ON pd.postcode = c.postcode WHERE s.n / total >= 0.6)"""


@query("known uprn_usrn uprns", f"WITH {_G9} SELECT * FROM g9")
def g9_street_names(spark, k, uu, u):
    out = addresses.street_names(uu, k, lookups.postcode_district(u))
    return out.select("USRN", "street", "street_n", F.round("street_agreement", 6).alias("street_agreement"), "postcode", "district", "street_confidence")


_SOURCES = [("epc_dom", "SELECT UPRN, addr, POSTCODE AS postcode FROM epc_dom"), ("epc_nondom", "SELECT UPRN, adr1, postcode FROM epc_nondom"), ("price_paid", "SELECT UPRN, addr, postcode FROM known")]


@query("epc_dom epc_nondom known", f"""WITH a AS ({' UNION ALL '.join(f"SELECT *, {i} AS r, '{n}' AS address_source FROM ({q})" for i, (n, q) in enumerate(_SOURCES))})
  SELECT UPRN, addr, postcode, address_source FROM a QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY r, addr, postcode) = 1""")
def p1_h3_known_addresses(spark, dom, non, k):
    xy = {"X_COORDINATE": F.lit(1.0), "Y_COORDINATE": F.lit(2.0)}
    frames = (("epc_dom", dom.withColumnRenamed("POSTCODE", "postcode")), ("epc_nondom", non.withColumnRenamed("adr1", "addr")), ("price_paid", k))
    out = addresses.known_addresses(*[(n, f.withColumns(xy).select("UPRN", "addr", "postcode", "LATITUDE", "LONGITUDE", *xy)) for n, f in frames])
    return out.select("UPRN", "addr", "postcode", "address_source")


@query("infill nsul", """SELECT i.UPRN, CASE WHEN c THEN NULL ELSE house_number END AS house_number, number_guessed AND NOT c AS number_guessed, coalesce(np, postcode) AS postcode, coalesce(nd, district) AS district
  FROM (SELECT infill.*, n.postcode AS np, n.lad_code AS nd, number_guessed AND coalesce(infill.postcode <> n.postcode, false) AS c FROM infill LEFT JOIN (SELECT UPRN, CASE WHEN UPRN % 5 = 0 THEN 'ZZ1 1ZZ' ELSE postcode END AS postcode, lad_code FROM nsul) n USING (UPRN)) i""")
def p4_apply_places(spark, i, n):
    places = n.select("UPRN", F.when(F.col("UPRN") % 5 == 0, "ZZ1 1ZZ").otherwise(F.col("postcode")).alias("postcode"), F.col("lad_code").alias("district"))
    return addresses.apply_places(i, places).select("UPRN", "house_number", "number_guessed", "postcode", "district")


@query("uprns known", "SELECT UPRN FROM uprns WHERE UPRN NOT IN (SELECT UPRN FROM known)")
def f12_infill_candidates(spark, u, k):
    return u.join(k.select("UPRN"), "UPRN", "left_anti").select("UPRN")


@query("nsul uprns", "SELECT UPRN FROM nsul INTERSECT SELECT UPRN FROM uprns WHERE x > 402000")
def n4_intersect(spark, n, u):
    return n.select("UPRN").join(u.filter("x > 402000").select("UPRN"), "UPRN", "left_semi").distinct()


@query("epc_dom epc_nondom", "SELECT UPRN, addr, NULL::VARCHAR AS rating FROM epc_dom UNION ALL SELECT UPRN, NULL, rating FROM epc_nondom")
def n1_union_by_name(spark, a, b):
    return R.union_all(a.select("UPRN", "addr"), b.select("UPRN", "rating")).select("UPRN", "addr", "rating")


# -- space

def _square(s: DataFrame) -> DataFrame:
    p = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    x, y, X, Y = F.col("x0"), F.col("y0"), F.col("x0") + F.col("side"), F.col("y0") + F.col("side")
    return s.withColumn("edges", F.array(p(x, y, X, y), p(X, y, X, Y), p(X, Y, x, Y), p(x, Y, x, y)))


_IN = "u.x >= s.x0 AND u.x < s.x0 + side AND u.y >= s.y0 AND u.y < s.y0 + side"


@query("uprns squares", f"SELECT u.UPRN AS point, s.id AS polygon FROM uprns u JOIN squares s ON {_IN}")
def j4_points_in_polygons(spark, u, s):
    return spatial.points_in_polygons(u, _square(s), "UPRN", "id")


@query("uprns squares", f"WITH h AS (SELECT u.UPRN, s.id AS INSPIREID FROM uprns u JOIN squares s ON {_IN}) SELECT UPRN, INSPIREID, count(*) OVER (PARTITION BY INSPIREID) AS n_uprn, count(*) OVER (PARTITION BY INSPIREID) = 1 AS single_uprn_parcel FROM h")
def j9_uprn_parcels(spark, u, s):
    return spatial.uprn_parcels(u, _square(s).withColumnRenamed("id", "INSPIREID"))


@query("uprns squares", f"WITH h AS (SELECT u.UPRN, s.id FROM uprns u JOIN squares s ON {_IN} WHERE s.id % 4 <> 0 QUALIFY count(*) OVER (PARTITION BY u.UPRN) = 1) SELECT UPRN, id AS osm_id, CAST(id AS VARCHAR) AS osm_housenumber FROM h")
def j5_infill_osm(spark, u, s):
    b = _square(s).select(F.col("id").alias("osm_id"), "edges", F.when(F.col("id") % 4 != 0, F.col("id").cast("string")).alias("osm_housenumber"))
    return spatial.infill_osm(u, b).select("UPRN", "osm_id", "osm_housenumber")


@query("geocodes squares", "SELECT u.id AS USRN, min(s.name) AS district FROM geocodes u JOIN squares s ON " + _IN + " GROUP BY u.id")
def j6_usrn_districts(spark, g, s):
    return spatial.usrn_districts(g.select(F.col("id").alias("USRN"), "x", "y"), _square(s))


@query("geocodes uprns", """SELECT g.id, CASE WHEN d <= 50 THEN t END AS UPRN, round(d, 4) AS uprn_distance_m, CASE WHEN d <= 50 THEN 'azure_geocoded_uprn_snap' ELSE 'azure_geocoded' END AS source FROM geocodes g JOIN
  (SELECT g.id, u.UPRN AS t, sqrt((g.x - u.x) ** 2 + (g.y - u.y) ** 2) AS d FROM geocodes g, uprns u QUALIFY row_number() OVER (PARTITION BY g.id ORDER BY d, u.UPRN) = 1) n USING (id)""")
def j2_snap(spark, g, u):
    return spatial.snap(g, u, row_id="id").select("id", "UPRN", F.round("uprn_distance_m", 4).alias("uprn_distance_m"), "source")


@query("geocodes uprns", """SELECT g.id AS point, u.UPRN AS target, round(sqrt((g.x - u.x) ** 2 + (g.y - u.y) ** 2), 4) AS d FROM geocodes g, uprns u WHERE (g.x - u.x) ** 2 + (g.y - u.y) ** 2 <= 750 ** 2
  QUALIFY row_number() OVER (PARTITION BY g.id ORDER BY sqrt((g.x - u.x) ** 2 + (g.y - u.y) ** 2), u.UPRN) <= 300""")
def j3_k_nearest(spark, g, u):
    return spatial.k_nearest(g, u, 750.0, 300, "id", "UPRN").select("point", "target", F.round("d", 4).alias("d"))


_SEG_D = "(SELECT g.id AS p, r.id AS s, r.name, g.x - (r.x1 + t * (r.x2 - r.x1)) AS dx, g.y - (r.y1 + t * (r.y2 - r.y1)) AS dy FROM (SELECT g.*, r.*, greatest(0, least(1, ((g.x - x1) * (x2 - x1) + (g.y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM geocodes g, roads r))"


@query("geocodes roads", """WITH c AS (SELECT g.id AS p, r.name, g.x, g.y, x1, y1, x2, y2, greatest(0, least(1, ((g.x - x1) * (x2 - x1) + (g.y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM geocodes g, roads r),
  d AS (SELECT p, name, sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2) AS d FROM c)
  SELECT p AS USRN, upper(name) AS street FROM d WHERE d <= 15 QUALIFY row_number() OVER (PARTITION BY p ORDER BY d, name) = 1""")
def j7_name_usrns(spark, g, r):
    return spatial.name_usrns(g.select(F.col("id").alias("USRN"), "x", "y"), r)


@query("roads", """WITH l AS (SELECT *, CAST(greatest(round_even(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) / 25, 0), 1) AS BIGINT) AS n FROM roads)
  SELECT id, round(x1 + (k - 0.5) / n * (x2 - x1), 4) AS x, round(y1 + (k - 0.5) / n * (y2 - y1), 4) AS y FROM l, range(1, 100000) r(k) WHERE k <= n""")
def e8_sample_line_points(spark, r):
    line = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    points = spatial.sample_line_points(r.select(F.col("id").alias("USRN"), line.alias("line")))
    return points.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("roads", """WITH l AS (SELECT *, CAST(greatest(round_even(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) / 25, 0), 1) AS BIGINT) AS n FROM roads),
  p AS (SELECT id AS USRN, k, x1 + 3 + (k - 0.5) / n * (x2 - x1) AS x, y1 + (k - 0.5) / n * (y2 - y1) AS y FROM l, range(1, 100000) r(k) WHERE k <= n),
  t AS (SELECT p.*, r.name, r.id, r.x1, r.y1, r.x2, r.y2, greatest(0, least(1, ((x - r.x1) * (r.x2 - r.x1) + (y - r.y1) * (r.y2 - r.y1)) / ((r.x2 - r.x1) ** 2 + (r.y2 - r.y1) ** 2))) AS t FROM p, roads r),
  v AS (SELECT USRN, upper(name) AS street FROM t WHERE sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2) <= 15
    QUALIFY row_number() OVER (PARTITION BY USRN, k ORDER BY sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2), id) = 1),
  s AS (SELECT USRN, street, count(*) AS n, sum(count(*)) OVER (PARTITION BY USRN) AS total FROM v GROUP BY USRN, street QUALIFY row_number() OVER (PARTITION BY USRN ORDER BY n DESC, street) = 1)
  SELECT USRN, 'Local Road' AS oml_classification, 1.0::DOUBLE AS oml_class_agreement, street, n AS street_n, round(n / total, 6) AS street_agreement, NULL AS oml_road_number FROM s""")
def j8_link_oml(spark, r):
    line = F.array(F.struct((F.col("x1") + 3).alias("x"), F.col("y1").alias("y")), F.struct((F.col("x2") + 3).alias("x"), F.col("y2").alias("y")))
    roads = r.withColumns({"classification": F.lit("Local Road"), "distinctive_name": F.col("name"), "road_number": F.lit(None).cast("string")})
    out = spatial.link_oml(r.select(F.col("id").alias("USRN"), line.alias("line")), roads)
    return out.withColumn("street_agreement", F.round("street_agreement", 6))


@query("geocodes squares uprns", f"""WITH i AS (SELECT u.UPRN, s.id AS osm_id FROM uprns u JOIN squares s ON {_IN} QUALIFY count(*) OVER (PARTITION BY u.UPRN) = 1),
  n AS (SELECT g.id + 100 AS osm_id, u.UPRN FROM geocodes g JOIN uprns u ON (g.x - u.x) ** 2 + (g.y - u.y) ** 2 <= 400 QUALIFY count(*) OVER (PARTITION BY g.id) = 1),
  m AS (SELECT osm_id, UPRN FROM n QUALIFY count(*) OVER (PARTITION BY UPRN) = 1)
  SELECT UPRN, osm_id FROM i UNION ALL SELECT UPRN, osm_id FROM m""")
def j10_substation_uprns(spark, g, s, u):
    return spatial.substation_uprns(g.select((F.col("id") + 100).alias("osm_id"), "x", "y"), _square(s).withColumnRenamed("id", "osm_id"), u)


@query("squares", "SELECT id, side * side AS area, 4 * side AS perimeter FROM squares")
def j17_area_length(spark, s):
    q = _square(s)
    return q.select("id", G.area(F.col("edges")).alias("area"), G.length(F.col("edges")).alias("perimeter"))


@query("squares", "SELECT 'la' AS la, id * 2 AS id, 2 AS n, CAST(160 AS DOUBLE) AS area, 6 AS edges FROM squares")
def j12_merge_parcels(spark, s):
    half = lambda x, w, k: s.select(F.lit("la").alias("la"), (F.col("id") * 2 + k).alias("id"), x.alias("x0"), F.col("y0"), w.alias("w"))
    both = half(F.lit(500.0) - 100, F.lit(100.0), 0).unionByName(half(F.lit(500.0), F.lit(60.0), 1))
    p = lambda a, b, c, d: F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2"))
    x, y, X, Y = F.col("x0"), F.col("id").cast("long") - F.col("id") % 2 + F.lit(0.5), F.col("x0") + F.col("w"), F.col("id") - F.col("id") % 2 + F.lit(1.5)
    return spatial.merge_grid_parcels(both.withColumn("edges", F.array(p(x, y, X, y), p(X, y, X, Y), p(X, Y, x, Y), p(x, Y, x, y)))).select("la", "id", "n", "area", F.size("edges").alias("edges"))


@query("roads squares", """WITH t AS (SELECT s.name || '|' || upper(r.name) AS key, r.id, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy, greatest(0, (x0 - x1) / (x2 - x1), (y0 - y1) / (y2 - y1)) AS a,
    least(1, (x0 + side - x1) / (x2 - x1), (y0 + side - y1) / (y2 - y1)) AS b FROM roads r, squares s),
  p AS (SELECT key, id AS USRN, x1 + (a + b) / 2 * dx AS x, y1 + (a + b) / 2 * dy AS y FROM t WHERE a < b),
  m AS (SELECT key, avg(x) AS mx, avg(y) AS my, count(DISTINCT USRN) AS n_usrn FROM p GROUP BY key)
  SELECT key, round(x, 4) AS x, round(y, 4) AS y, n_usrn, 2024::BIGINT AS last_seen_year FROM p JOIN m USING (key)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY round((x - mx) ** 2 + (y - my) ** 2, 6), x, y) = 1""")
def j14_streets_in_postcodes(spark, r, s):
    out = spatial.streets_in_postcodes(r.select(F.col("id").cast("long").alias("USRN"), F.upper("name").alias("street"), "x1", "y1", "x2", "y2"),
                                       _square(s).select(F.col("name").alias("postcode"), F.lit(2024).alias("year"), "edges"))
    return out.select("key", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "n_usrn", F.col("last_seen_year").cast("long").alias("last_seen_year"))


@query("geocodes", """WITH p AS (SELECT CAST(id % 7 AS VARCHAR) AS key, id % 5 AS USRN, 2015 + 5 * (id % 2) AS year, x, y FROM geocodes), n AS (SELECT * FROM p QUALIFY year = max(year) OVER (PARTITION BY key)),
  m AS (SELECT key, avg(x) AS mx, avg(y) AS my, count(DISTINCT USRN) AS n_usrn FROM n GROUP BY key)
  SELECT key, x, y, n_usrn, CAST(year AS BIGINT) AS last_seen_year FROM n JOIN m USING (key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY round((x - mx) ** 2 + (y - my) ** 2, 6), x, y) = 1""")
def g12_newest_medoid(spark, g):
    p = g.select((F.col("id") % 7).cast("string").alias("key"), (F.col("id") % 5).alias("USRN"), (2015 + 5 * (F.col("id") % 2)).alias("year"), "x", "y")
    return spatial.newest_medoid(p).withColumn("last_seen_year", F.col("last_seen_year").cast("long"))


@query("geocodes", """WITH g AS (SELECT CAST(id % 20 AS VARCHAR) AS key, x, y FROM geocodes), w AS (SELECT a.key, max(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS d FROM g a JOIN g b ON a.key = b.key GROUP BY a.key)
  SELECT g.key, round(avg(x), 6) AS x, round(avg(y), 6) AS y, count(*) AS n_usrn FROM g JOIN w ON w.key = g.key AND w.d < 4500 GROUP BY g.key""")
def g13_centroids(spark, g):
    return spatial.centroids(g.withColumn("key", (F.col("id") % 20).cast("string")), "key", most=4500.0).select("key", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "n_usrn")


@query("uprns", """SELECT UPRN, list_sum([((CAST(floor(x / 1000) AS BIGINT) >> CAST(i AS INT)) & 1) * CAST(4 ** i AS BIGINT) + ((CAST(floor(y / 1000) AS BIGINT) >> CAST(i AS INT)) & 1) * CAST(2 * 4 ** i AS BIGINT) FOR i IN range(16)])::BIGINT AS code FROM uprns""")
def d46_morton(spark, u):
    return u.select("UPRN", G.morton(F.col("x"), F.col("y")).alias("code"))


@query("uprns", "SELECT UPRN, floor(x / 500) * 500 AS lo, ceil(y / 500) * 500 AS hi, CAST(UPRN % 2 AS BIGINT) AS parity FROM uprns")
def d44_d47_math(spark, u):
    return u.select("UPRN", G.snap_down(F.col("x")).cast("double").alias("lo"), G.snap_up(F.col("y")).cast("double").alias("hi"), F.pmod("UPRN", F.lit(2)).alias("parity"))


@query("unnumbered numbered", """WITH n AS (SELECT *, CAST(house_number AS BIGINT) AS num FROM numbered), g AS (SELECT USRN, num, X, Y, lead(num) OVER w AS num2, lead(X) OVER w AS X2, lead(Y) OVER w AS Y2 FROM n WINDOW w AS (PARTITION BY USRN, num % 2 ORDER BY num)),
  h AS (SELECT u.UPRN, g.USRN, num, num2 FROM g JOIN unnumbered u USING (USRN) WHERE num2 - num = 4 AND u.X > g.X AND u.X < g.X2 AND abs(u.Y - (g.Y + g.Y2) / 2) < 12 QUALIFY count(*) OVER (PARTITION BY g.USRN, num) = 1)
  SELECT UPRN, USRN, CAST(num + 2 AS VARCHAR) AS house_number, num || '-' || num2 AS guess_between FROM h QUALIFY count(*) OVER (PARTITION BY UPRN) = 1""")
def h9_gap_guesses(spark, u, n):
    # The streets run along x here, so the SQL needs no axis; the operator finds it.
    return addresses.gap_guesses(u, n).select("UPRN", "USRN", "house_number", "guess_between")


@query("numbered", "SELECT DISTINCT USRN FROM (SELECT USRN, CAST(house_number AS BIGINT) - lag(CAST(house_number AS BIGINT)) OVER (PARTITION BY USRN ORDER BY CAST(house_number AS BIGINT)) AS d FROM numbered) WHERE d = 4")
def g11_gap_streets(spark, n):
    return addresses.gap_streets(n)


# -- published tables

_MASTER_COLUMNS = ["UPRN", "class", "epc_dom_rating", "epc_nondom_asset_rating", "best_address", "infill_street", "usrn_street", "inspire_id", "postcode_nsul"]


def _master(spark, u, dom, non, s, k, i, uu, n, sq) -> DataFrame:
    dated = u.withColumns({"date_first": F.lit("2020-01-01").cast("date"), "date_last": F.lit("2024-01-01").cast("date"), "X_COORDINATE": F.col("x"), "Y_COORDINATE": F.col("y")})
    classes = u.select("UPRN", F.when(F.col("UPRN") % 2 == 0, "domestic").otherwise("unknown").alias("class"), F.lit(True).alias("exists"), F.lit(False).alias("newbuild"))
    places = n.select("UPRN", "postcode", F.col("lad_code").alias("district"))
    names = addresses.street_names(uu, k, lookups.postcode_district(u))
    dec = dom.filter("UPRN % 30 = 0").select("UPRN", "addr", "year")
    parcels = spatial.uprn_parcels(u, _square(sq).withColumnRenamed("id", "INSPIREID"))
    return master.all_addresses(dated, classes, places, dom, non, dec, s, k, i, uu, names, parcels)


_MASTER_VIEWS = "uprns epc_dom epc_nondom sales known infill uprn_usrn nsul squares"


@query(_MASTER_VIEWS, f"""SELECT u.UPRN, CASE WHEN u.UPRN % 2 = 0 THEN 'domestic' ELSE 'unknown' END AS class,
   CASE WHEN upper(trim(cur_rate)) IN ('A','B','C','D','E','F','G') THEN upper(trim(cur_rate)) END AS epc_dom_rating, TRY_CAST(rating AS DOUBLE) AS epc_nondom_asset_rating,
   known.addr AS best_address, infill.street AS infill_street, nsul.postcode AS postcode_nsul, s.id AS inspire_id,
   CAST((SELECT max(date) FROM sales WHERE sales.uprn = u.UPRN) AS VARCHAR) AS pp_date
  FROM uprns u LEFT JOIN epc_dom d ON d.UPRN = u.UPRN LEFT JOIN epc_nondom e ON e.UPRN = u.UPRN LEFT JOIN known ON known.UPRN = u.UPRN LEFT JOIN infill ON infill.UPRN = u.UPRN LEFT JOIN nsul ON nsul.UPRN = u.UPRN LEFT JOIN squares s ON {_IN}""")
def f21_all_addresses(spark, *t):
    return _master(spark, *t).select("UPRN", "class", "epc_dom_rating", "epc_nondom_asset_rating", "best_address", "infill_street", "postcode_nsul", "inspire_id", F.col("pp_date").cast("string").alias("pp_date"))


@query(_MASTER_VIEWS, f"""WITH {_G9}, x AS (SELECT UPRN, min(USRN) AS USRN FROM uprn_usrn JOIN g9 USING (USRN) GROUP BY UPRN)
  SELECT u.UPRN, u.LONGITUDE, u.LATITUDE, coalesce(k.addr, CASE WHEN i.street IS NOT NULL THEN concat_ws(' ', i.house_number, i.street) END, i.building_name, g9.street) AS address,
    CASE WHEN u.UPRN % 2 = 0 THEN 'domestic' ELSE 'unknown' END AS class, coalesce(n.lad_code, i.district) AS district, coalesce(n.postcode, k.postcode, i.postcode) AS postcode
  FROM uprns u LEFT JOIN known k ON k.UPRN = u.UPRN LEFT JOIN infill i ON i.UPRN = u.UPRN LEFT JOIN nsul n ON n.UPRN = u.UPRN LEFT JOIN x ON x.UPRN = u.UPRN LEFT JOIN g9 ON g9.USRN = x.USRN""")
def c14_c15_map_extract(spark, *t):
    out = master.map_extract(_master(spark, *t))
    return out.select("UPRN", "LONGITUDE", "LATITUDE", "address", "class", "district", "postcode")


@query(_MASTER_VIEWS, f"""WITH m AS (SELECT k.addr, k.street, k.house_number, i.UPRN IS NOT NULL AND i.street IS NOT NULL AS inferred, i.house_number AS ih, coalesce(k.postcode, i.postcode, n.postcode) AS postcode
    FROM uprns u LEFT JOIN known k ON k.UPRN = u.UPRN LEFT JOIN infill i ON i.UPRN = u.UPRN LEFT JOIN nsul n ON n.UPRN = u.UPRN),
  c AS (SELECT count(*) AS n_uprn, count(addr) AS n_real_address, count(*) FILTER (addr IS NOT NULL OR inferred) AS n_addressed_any, count(*) FILTER (street IS NOT NULL OR inferred) AS n_with_street,
    count(*) FILTER (house_number IS NOT NULL OR ih IS NOT NULL) AS n_with_house_number, count(postcode) AS n_with_postcode, count(*) FILTER ({s_valid('postcode')}) AS n_postcode_valid FROM m)
  SELECT *, {', '.join(f'round_even(n_{x} / greatest(n_uprn, 1), 4) AS pct_{x}' for x in ('real_address', 'addressed_any', 'with_street', 'with_house_number', 'with_postcode'))},
    round_even((n_with_postcode - n_postcode_valid) / greatest(n_with_postcode, 1), 4) AS pct_postcode_malformed, n_uprn - n_addressed_any AS n_unaddressed FROM c""")
def m6_master_audit(spark, *t):
    return audits.master_audit(_master(spark, *t))


@query("epc_dom epc_nondom", """SELECT UPRN, CASE WHEN upper(cur_rate) IN ('A','B','C','D','E','F','G') THEN upper(cur_rate) END AS band, NULL::DOUBLE AS asset, NULL::BIGINT AS step FROM epc_dom
  UNION ALL SELECT UPRN, NULL, CAST(rating AS DOUBLE), CASE WHEN CAST(rating AS INT) >= 151 THEN 6 WHEN CAST(rating AS INT) >= 126 THEN 5 WHEN CAST(rating AS INT) >= 101 THEN 4 WHEN CAST(rating AS INT) >= 76 THEN 3 WHEN CAST(rating AS INT) >= 51 THEN 2 WHEN CAST(rating AS INT) >= 26 THEN 1 ELSE 0 END FROM epc_nondom""")
def c12_c13_c18_ratings(spark, d, n):
    a = master.domestic_rating(d).select("UPRN", F.col("epc_dom_rating").alias("band"))
    b = master.nondomestic_rating(n).select("UPRN", F.col("epc_nondom_asset_rating").alias("asset"))
    b = b.withColumn("step", master.step_class("asset", master.RATING_STOPS).cast("long"))
    return R.union_all(a, b).select("UPRN", "band", "asset", "step")


@query("titles geocodes uprns", """WITH n AS (SELECT g.id, u.UPRN, sqrt((g.x - u.x) ** 2 + (g.y - u.y) ** 2) AS d FROM geocodes g, uprns u QUALIFY row_number() OVER (PARTITION BY g.id ORDER BY d, u.UPRN) = 1)
  SELECT title_number, address_line, district, postcode, CASE WHEN row_id % 2 <> 0 THEN CAST(row_id AS VARCHAR) END AS uprn, CASE WHEN row_id % 2 = 0 THEN 51.0 ELSE 52.0 END::DOUBLE AS latitude, 0.0::DOUBLE AS longitude,
    CASE WHEN row_id % 2 = 0 THEN 'High' ELSE 'high' END AS match_quality, CASE WHEN row_id % 2 = 0 THEN 'carried_forward_2022' ELSE 'epc_match' END AS source FROM titles
  UNION ALL SELECT 'T' || id, NULL, NULL, NULL, CASE WHEN d <= 50 THEN CAST(UPRN AS VARCHAR) END, 53.0, 0.0, 'Medium', CASE WHEN d <= 50 THEN 'azure_geocoded_uprn_snap' ELSE 'azure_geocoded' END FROM n""")
def p8_combine_final(spark, t, g, u):
    carried = _asked(t).filter("row_id % 2 = 0").withColumns({"confidence": F.lit("High"), "latitude": F.lit(51.0), "longitude": F.lit(0.0), "source": F.lit("carried_forward_2022")})
    matched = _asked(t).filter("row_id % 2 <> 0").withColumns({"UPRN": F.col("row_id"), "LATITUDE": F.lit(52.0), "LONGITUDE": F.lit(0.0), "match_quality": F.lit("high"), "source": F.lit("epc_match")})
    geocoded = spatial.snap(g, u, row_id="id").withColumns({"Title Number": F.concat(F.lit("T"), F.col("id")), "confidence": F.lit("Medium"), "latitude": F.lit(53.0), "longitude": F.lit(0.0)})
    out = master.combine_final(carried, matched, geocoded)
    # The other columns of the common schema are null in all three tables here.
    return out.select("title_number", "address_line", "district", "postcode", "uprn", "latitude", "longitude", "match_quality", "source")


# -- audits

_COV = f"count(*) AS n_rows, count(house_number) AS n_house_number, count(street) AS n_street, count(postcode) AS n_postcode, count(*) FILTER ({s_valid('postcode')}) AS n_postcode_valid"


@query("known", f"SELECT coalesce(address_source, 'TOTAL') AS stage, {_COV} FROM known GROUP BY ROLLUP (address_source)")
def m1_known_audit(spark, k):
    return audits.known_audit(k).select("stage", "n_rows", "n_house_number", "n_street", "n_postcode", "n_postcode_valid")


@query("infill", f"SELECT 'infill' AS stage, {_COV}, round_even(count(house_number) / count(*), 4) AS pct_house_number FROM infill")
def m2_coverage(spark, i):
    return audits.coverage(i, "infill").select("stage", "n_rows", "n_house_number", "n_street", "n_postcode", "n_postcode_valid", "pct_house_number")


@query("infill uprns known", "SELECT (SELECT count(*) FROM uprns WHERE UPRN NOT IN (SELECT UPRN FROM known)) AS n_candidates, count(DISTINCT UPRN) AS n_gained_any_info FROM infill")
def m5_infill_audit(spark, i, u, k):
    return audits.infill_audit(u.join(k, "UPRN", "left_anti"), i).select(F.col("n_candidates").cast("long").alias("n_candidates"), F.col("n_gained_any_info").cast("long").alias("n_gained_any_info"))


@query("uprn_usrn known uprns", f"""WITH {_G9}, t AS (SELECT count(DISTINCT USRN) AS n FROM uprn_usrn)
  SELECT t.n AS n_usrn_total, count(USRN) AS n_usrn_named, round_even(count(USRN) / greatest(t.n, 1), 4) AS pct_usrn_named, count(district) AS n_usrn_with_district,
    round_even(count(district) / greatest(count(USRN), 1), 4) AS pct_usrn_with_district, count(postcode) AS n_usrn_with_postcode, count(*) FILTER ({s_valid('postcode')}) AS n_usrn_postcode_valid FROM g9, t GROUP BY t.n""")
def m4_street_name_audit(spark, uu, k, u):
    out = audits.street_name_audit(uu, addresses.street_names(uu, k, lookups.postcode_district(u)))
    return out.withColumn("n_usrn_total", F.col("n_usrn_total").cast("long"))


@query("sales", """SELECT coalesce(CAST(y AS VARCHAR), 'TOTAL') AS year, count(*) AS n, count(uprn) AS n_matched_initial, count(*) FILTER (uprn IS NULL AND price > 50000) AS n_matched_rematch,
   round_even(count(uprn) / count(*), 4) AS pct_matched_initial FROM (SELECT *, year(date) AS y FROM sales) GROUP BY ROLLUP (y)""")
def m8_sales_audit(spark, s):
    again = s.filter("uprn is null and price > 50000").withColumn("match_source", F.lit("x"))
    return audits.sales_audit(s, again).select("year", "n", "n_matched_initial", "n_matched_rematch", "pct_matched_initial")


@query("titles known infill uprns")
def m7_fuzzy_audit(spark, t, k, i, u):
    table = fuzzy.fuzzy_lookup(k, i, u).join(u.select("UPRN", "x", "y"), "UPRN", "left")
    places = u.groupBy(K.normalise_postcode("postcode").alias("postcode")).agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return audits.fuzzy_audit(fuzzy.match_fuzzy(_asked(t), table, places))


@query("titles")
def m9_split_audit(spark, t):
    rows = _split(t)
    return audits.split_audit(rows, titles.build_split_addresses(rows))["quality"]


# -- the queue

@query("titles", f"""SELECT row_id, 'T' || row_id || '||' || address_line AS queue_key, CASE WHEN length(address_line) < 5 AND postcode IS NULL THEN 'too_short' ELSE 'ok' END AS queue_reason, 'pending' AS status FROM titles""")
def q_a_build_queue(spark, t):
    return geocode_queue.build_queue(_asked(t)).select("row_id", "queue_key", "queue_reason", "status")


@query("orders", """WITH q AS (SELECT o_orderkey AS k, o_custkey % 200 AS g FROM orders), s AS (SELECT *, count(*) OVER (PARTITION BY g) AS n, first_value(k) OVER (PARTITION BY g ORDER BY k) AS rep FROM q)
  SELECT k, CASE WHEN n >= 3 AND k <> rep THEN 'deferred_flat' ELSE 'pending' END AS status, CASE WHEN n >= 3 THEN n END AS flat_group_n FROM s""")
def q_b_assign_flats(spark, o):
    rows = o.select(F.col("o_orderkey").alias("k"), F.lit("T1").alias("Title Number"), F.concat(F.lit("Flat "), F.col("o_orderkey"), F.lit(" Building "), F.col("o_custkey") % 200, F.lit(" House")).alias("AddressLine"),
                    F.lit("AB1 1CD").alias("PostalCode"), F.lit("X").alias("District"))
    return geocode_queue.build_queue(rows).select("k", "status", F.col("flat_group_n").cast("long").alias("flat_group_n"))


@query("titles", "SELECT row_id, 'T' || row_id || '||' || address_line AS queue_key FROM titles ORDER BY (postcode IS NOT NULL) DESC, queue_key LIMIT 100")
def h7_next_batch(spark, t):
    return geocode_queue.next_batch(geocode_queue.build_queue(_asked(t)), 100).select("row_id", "queue_key")


@query("titles", """WITH q AS (SELECT postcode, 'T' || row_id || '||' || address_line AS queue_key, length(address_line) < 5 AND postcode IS NULL AS short FROM titles),
  s AS (SELECT queue_key FROM q WHERE NOT short ORDER BY postcode IS NULL, queue_key LIMIT 300)
  SELECT CASE WHEN s.queue_key IS NULL THEN 'pending' WHEN length(s.queue_key) % 3 <> 0 THEN 'done' ELSE 'failed' END AS status, count(*) AS n FROM q LEFT JOIN s USING (queue_key) GROUP BY ALL""")
def q_c_run_batch(spark, t):
    import pandas as pd

    def stub(rows: pd.DataFrame) -> pd.DataFrame:
        hit = rows[rows["queue_key"].str.len() % 3 != 0]
        return pd.DataFrame({"queue_key": hit["queue_key"], "addressLine": hit["AddressLine"], "adminDistrict": hit["District"], "formattedAddress": hit["AddressLine"],
                             "latitude": 52.0, "longitude": -1.0, "confidence": "High", "entityType": "Address", "matchCodes": "Good"})

    queue, _ = geocode_queue.run_batch(geocode_queue.build_queue(_asked(t)), stub, 300, sinks.work_dir(spark, "geocoded"), "first", confirm=True)
    return queue.groupBy("status").agg(F.count("*").alias("n"))


@query("orders", "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS batch FROM orders")
def b10_batches(spark, o):
    return sinks.batches(o.select("o_orderkey"), 1000, "o_orderkey")


@query("uprns", """SELECT '{"type":"Feature","properties":{"UPRN":' || UPRN || ',"district":"' || district || '"},"geometry":{"type":"Point","coordinates":[' || round_even(LONGITUDE, 6) || ',' || round_even(LATITUDE, 6) || ']}}' AS value FROM uprns""")
def b5_geojson_lines(spark, u):
    return sinks.geojson_lines(u.select("UPRN", "LONGITUDE", "LATITUDE", "district"))


@query("uprns")
def j1_coordinates(spark, u):
    return u.withColumn("p", G.degrees_point("x", "y")).withColumn("q", G.grid_point("p.lat", "p.lon")).select("UPRN", (F.abs(F.col("q.x") - F.col("x")) < 0.01).alias("x_back"), (F.abs(F.col("q.y") - F.col("y")) < 0.01).alias("y_back"))
