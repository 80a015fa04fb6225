"""More queries over the synthetic registers: regions, samples, readers' columns, composed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G
from ..functions import geocoder, numbers, phrases
from ..functions import keys as K
from ..operators import addresses, audits, geocode_queue, lookups, prices, regions, spatial
from ..operators import relational as R
from ..sources import readers
from .queries import _IN, _PD, _asked, _square, query, s_name, s_num, s_pc

# -- regions

_CLASSES = ", ".join(f"'{c}'" for c in ("Motorway", "Motorway, Collapsed Dual Carriageway", "Guided Busway Carriageway", "Shared Use Carriageway"))


@query("road_classes", f"SELECT id, coalesce(nullif(classification, '') IN ({_CLASSES}), false) AS excluded FROM road_classes")
def c9_excludes_properties(spark, r):
    return r.select("id", regions.excludes_properties(F.nullif("classification", F.lit(""))).alias("excluded"))


@query("uprns known infill", """SELECT u.UPRN, CASE WHEN k.UPRN IS NOT NULL THEN k.address_source WHEN i.UPRN IS NOT NULL THEN i.address_source ELSE 'no_address' END AS address_status,
  k.UPRN IS NOT NULL OR i.UPRN IS NOT NULL AS has_address FROM uprns u LEFT JOIN known k ON k.UPRN = u.UPRN LEFT JOIN infill i ON i.UPRN = u.UPRN""")
def c20_address_status(spark, u, k, i):
    rows = u.select("UPRN").join(k.select("UPRN", F.col("address_source").alias("best_address_source")), "UPRN", "left")
    rows = rows.join(i.select("UPRN", F.col("address_source").alias("infill_address_source")), "UPRN", "left")
    return regions.address_status(rows).select("UPRN", "address_status", "has_address")


@query("district_names", """SELECT id, CASE n WHEN 'CAERDYDD - CARDIFF' THEN 'CARDIFF' WHEN 'ST. HELENS' THEN 'ST HELENS' WHEN 'CITY OF LEICESTER' THEN 'LEICESTER' WHEN 'POWYS - POWYS' THEN 'POWYS' ELSE n END AS name
  FROM (SELECT id, replace(replace(upper(name), ' (B)', ''), ' DISTRICT', '') AS n FROM district_names)""")
def c21_canonical_district(spark, d):
    return d.select("id", regions.canonical_district("name").alias("name"))


@query("district_names squares", """WITH d AS (SELECT id, CASE n WHEN 'CAERDYDD - CARDIFF' THEN 'CARDIFF' WHEN 'ST. HELENS' THEN 'ST HELENS' WHEN 'CITY OF LEICESTER' THEN 'LEICESTER' WHEN 'POWYS - POWYS' THEN 'POWYS'
    WHEN 'KETTERING' THEN 'NORTH NORTHAMPTONSHIRE' WHEN 'CORBY' THEN 'NORTH NORTHAMPTONSHIRE' WHEN 'NORTHAMPTON' THEN 'WEST NORTHAMPTONSHIRE' ELSE n END AS name
  FROM (SELECT id, replace(replace(upper(name), ' (B)', ''), ' DISTRICT', '') AS n FROM district_names))
  SELECT d.name, 4 * count(*) AS edges, round(sum(side * side), 3) AS area FROM d JOIN squares s ON s.id = d.id + 1 GROUP BY d.name""")
def c21_current_districts(spark, d, s):
    bounds = _square(s).select((F.col("id") - 1).alias("id"), "edges").join(d, "id")
    out = regions.current_districts(bounds)
    # Squares lie side by side without common edges, so that the areas of a merged district's parts add up.
    return out.select("name", F.size("edges").cast("long").alias("edges"), F.round(G.area(F.col("edges")), 3).alias("area"))


@query("squares", "SELECT min(x0) - 1000 AS x0, min(y0) - 1000 AS y0, max(x0 + side) + 1000 AS x1, max(y0 + side) + 1000 AS y1 FROM squares")
def j16_outer_box(spark, s):
    return regions.outer_box(_square(s))


@query("uprns squares", f"SELECT DISTINCT u.UPRN FROM uprns u JOIN squares s ON {_IN} WHERE s.name IN ('E3', 'E7', 'E12')")
def j18_in_region(spark, u, s):
    return regions.in_region(u, _square(s), ["E3", "E7", "E12"], "UPRN").select("UPRN")


@query("uprns", "SELECT UPRN, round(sqrt((x - 402500) ** 2 + (y - 302500) ** 2), 4) AS distance FROM uprns WHERE sqrt((x - 402500) ** 2 + (y - 302500) ** 2) <= 3000")
def j19_around(spark, u):
    return regions.around(u, 402500.0, 302500.0).select("UPRN", F.round("distance", 4).alias("distance"))


@query("titles", "SELECT row_id, address_line FROM titles ORDER BY length(address_line) DESC, row_id LIMIT 50")
def h12_head(spark, t):
    return regions.head(t.select("row_id", "address_line"), 50, F.length("address_line").desc(), "row_id")


@query("new_titles old_titles", "SELECT title_number FROM new_titles WHERE title_number NOT IN (SELECT title_number FROM old_titles)")
def f26_failed_titles(spark, new, old):
    name = {"title_number": "Title Number"}
    return regions.failed_titles(new.withColumnsRenamed(name), old.withColumnsRenamed(name)).select(F.col("`Title Number`").alias("title_number"))


@query("titles old_titles", """SELECT o.title_number, t.tenure, CASE WHEN t.tenure = 'Freehold' THEN 'UK' WHEN t.tenure = 'Leasehold' THEN t.district END AS country
  FROM old_titles o LEFT JOIN titles t USING (title_number)""")
def f27_with_owners(spark, t, old):
    full = t.select(F.col("title_number").alias("Title Number"), F.col("tenure").alias("Tenure"), F.col("property_address").alias("Property Address"), F.lit("x").alias("Proprietor Name (1)"),
                    F.lit("1").alias("Company Registration No. (1)"), F.lit("y").alias("Proprietorship Category (1)"), F.col("district").alias("Country Incorporated (1)"))
    both = (full.filter("Tenure = 'Freehold'"), "UK"), (full.filter("Tenure = 'Leasehold'"), None)
    out = regions.with_owners(old.select(F.col("title_number").alias("Title Number")), *both)
    return out.select(F.col("`Title Number`").alias("title_number"), F.col("Tenure").alias("tenure"), F.col("Country").alias("country"))


@query("unit_rows", """SELECT id, CASE WHEN unit_type IN ('flat', 'suite', 'unit') THEN unit_type || ' ' || coalesce(unit_id, '') || ', ' ELSE '' END || coalesce(building_name, '') || ' ' || street_number || ' ' || street_name || ' ' AS line FROM unit_rows""")
def d31_collaborator_address(spark, r):
    return r.select("id", regions.collaborator_address().alias("line"))


def _folded(x: str) -> str:
    for a, b in (("northern", "north"), ("eastern", "east"), ("northly", "north"), ("westerly", "west"), ("south-east", "southeast"), ("south west", "southwest"), ("\\badjoing\\b", "adjoining"), ("\\bajoining\\b", "adjoining")):
        x = f"regexp_replace({x}, '(?i){a}', '{b}', 'g')"
    return x


@query("compass", f"SELECT id, {_folded('text')} AS text FROM compass")
def d32_fold_compass(spark, c):
    return c.select("id", regions.fold_compass("text").alias("text"))


@query("queue_log", """WITH m AS (SELECT queue_key, event_id, status, CASE WHEN lag(status) OVER w = status THEN 0 ELSE 1 END AS new FROM queue_log WINDOW w AS (PARTITION BY queue_key ORDER BY event_id)),
  r AS (SELECT *, sum(new) OVER (PARTITION BY queue_key ORDER BY event_id) AS run FROM m) SELECT queue_key, CAST(run AS BIGINT) AS run, min(status) AS status, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r GROUP BY queue_key, run""")
def d54_runs(spark, q):
    return regions.runs(q, "queue_key", "event_id", "status")


@query("roads", "SELECT id AS USRN, x1, y1, (x1 + x2) / 2 AS x2, (y1 + y2) / 2 AS y2 FROM roads UNION ALL SELECT id, (x1 + x2) / 2, (y1 + y2) / 2, x2, y2 FROM roads")
def a7_line_segments(spark, r):
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"), F.lit(7.0).alias("z"))
    mid = p((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2)
    return regions.line_segments(r.select(F.col("id").alias("USRN"), F.array(p(F.col("x1"), F.col("y1")), mid, p(F.col("x2"), F.col("y2"))).alias("points")), "USRN")


# -- readers' columns

_TAGS = """tags AS (SELECT c_custkey AS osm_id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '"ref:gb:uprn"=>"' || CAST(c_custkey % 900 AS VARCHAR) || '",' END || '"addr:housenumber"=>"' || CAST(c_custkey % 50 AS VARCHAR) || '"'
  || CASE WHEN c_custkey % 3 = 0 THEN ',"addr:street"=>"Fen Causeway"' ELSE '' END AS other_tags, c_custkey % 2 = 0 AS point FROM customer)"""


def _tags(c: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return c.select(k.alias("osm_id"), F.concat(
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit('"ref:gb:uprn"=>"'), (k % 900).cast("string"), F.lit('",'))), F.lit('"addr:housenumber"=>"'), (k % 50).cast("string"), F.lit('"'),
        F.when(k % 3 == 0, ',"addr:street"=>"Fen Causeway"').otherwise("")).alias("other_tags"), (k % 2 == 0).alias("point"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))


@query("customer", f"""WITH {_TAGS} SELECT * FROM (SELECT CAST(regexp_extract(other_tags, '"ref:gb:uprn"=>"([^"]*)"', 1) AS BIGINT) AS UPRN, osm_id, regexp_extract(other_tags, '"addr:housenumber"=>"([^"]*)"', 1) AS osm_housenumber,
   CASE WHEN other_tags LIKE '%addr:street%' THEN 'Fen Causeway' END AS osm_street, CASE WHEN point THEN 'point' ELSE 'polygon' END AS osm_geom_type FROM tags WHERE other_tags LIKE '%ref:gb:uprn%')
   QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY osm_geom_type = 'point', osm_id) = 1""")
def a10_osm_uprn_tags(spark, c):
    t = _tags(c)
    out = readers.osm_uprn_tags(t.filter("not point").drop("point"), t.filter("point").drop("point"))
    return out.select("UPRN", "osm_id", "osm_housenumber", "osm_street", "osm_geom_type")


@query("customer uprns", f"""WITH {_TAGS}, t AS (SELECT * FROM (SELECT CAST(regexp_extract(other_tags, '"ref:gb:uprn"=>"([^"]*)"', 1) AS BIGINT) AS UPRN, point, osm_id, other_tags LIKE '%addr:street%' AS full_ FROM tags WHERE other_tags LIKE '%ref:gb:uprn%')
   QUALIFY row_number() OVER (PARTITION BY UPRN ORDER BY point, osm_id) = 1), n AS (SELECT count(*) AS n FROM uprns)
   SELECT n.n AS n_uprn_total, count(*) AS n_osm_tagged, round_even(count(*) / greatest(n.n, 1), 4) AS pct_osm_tagged, count(*) FILTER (NOT point) AS n_osm_polygon, count(*) FILTER (point) AS n_osm_point,
   count(*) FILTER (full_) AS n_osm_with_address, round_even(count(*) FILTER (full_) / greatest(count(*), 1), 4) AS pct_osm_with_address FROM t, n GROUP BY n.n""")
def m3_osm_tag_audit(spark, c, u):
    t = _tags(c)
    out = audits.osm_tag_audit(readers.osm_uprn_tags(t.filter("not point").drop("point"), t.filter("point").drop("point")), u)
    return out.withColumn("n_uprn_total", F.col("n_uprn_total").cast("long"))


@query("customer", f"""WITH {_TAGS} SELECT osm_id, regexp_extract(other_tags, '"addr:housenumber"=>"([^"]*)"', 1) AS osm_housenumber, regexp_extract(other_tags, '"addr:housenumber"=>"([^"]*)"', 1) || ' Fen Causeway' AS addr
   FROM tags WHERE other_tags LIKE '%addr:street%'""")
def p5_osm_addresses(spark, c):
    return addresses.osm_addresses(readers.osm_address_columns(_tags(c).withColumn("name", F.lit(None).cast("string")))).select("osm_id", "osm_housenumber", "addr")


@query("known nsul", """SELECT k.UPRN, coalesce(CASE WHEN k.UPRN % 2 = 0 THEN k.postcode END, n.postcode) AS postcode FROM known k LEFT JOIN nsul n ON n.UPRN = k.UPRN""")
def f9_with_postcodes(spark, k, n):
    return addresses.with_postcodes(k.select("UPRN", F.when(F.col("UPRN") % 2 == 0, F.col("postcode")).alias("postcode")), n)


# -- text

_PHRASES = ["high", "high street", "church", "mill lane", "substation"]


@query("titles", """SELECT row_id, CASE WHEN t LIKE '%high street%' THEN 'high street' WHEN t LIKE '%substation%' AND t LIKE '%church%' THEN 'church|substation' WHEN t LIKE '%substation%' AND t LIKE '%mill lane%' THEN 'mill lane|substation'
   WHEN t LIKE '%substation%' THEN 'substation' WHEN t LIKE '%mill lane%' THEN 'mill lane' WHEN t LIKE '%church%' THEN 'church' END AS found
   FROM (SELECT row_id, lower(address_line) AS t FROM titles WHERE NOT (lower(address_line) LIKE '%high street%' AND lower(address_line) LIKE '%substation%')
   UNION ALL SELECT row_id, 'x' FROM titles WHERE false) UNION ALL SELECT row_id, 'high street|substation' FROM titles WHERE lower(address_line) LIKE '%high street%' AND lower(address_line) LIKE '%substation%'""")
def d28_matching_phrases(spark, t):
    return t.select("row_id", phrases.matching_phrases(_PHRASES)(F.lower("address_line")).alias("found"))


@query("titles", """SELECT row_id, trim(regexp_replace(regexp_replace(address_line, '(?i)\\bthe paddock north of\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM titles""")
def d19_phrase_cleaner(spark, t):
    return t.select("row_id", phrases.phrase_cleaner([("the paddock north of", None)])(F.col("address_line")).alias("text"))


@query("titles", """SELECT row_id, '{"addressLine":"' || address_line || '"' || CASE WHEN postcode IS NOT NULL THEN ',"postalCode":"' || postcode || '"' ELSE '' END || ',"locality":"' || district || '","countryRegion":"GB"}' AS item FROM titles""")
def d49_batch_item(spark, t):
    return t.select("row_id", geocoder.batch_item("address_line", "postcode", "district").alias("item"))


@query("uprns", """SELECT UPRN, 'Address' AS entity, 'High' AS confidence, round(LATITUDE, 6) AS latitude, round(LONGITUDE, 6) AS longitude, 'Good,Up' AS codes FROM uprns WHERE UPRN % 3 <> 0
   UNION ALL SELECT UPRN, NULL, NULL, NULL, NULL, NULL FROM uprns WHERE UPRN % 3 = 0""")
def d50_parse_answer(spark, u):
    hit = F.concat(F.lit('{"batchItems":[{"features":[{"properties":{"type":"Address","confidence":"High","matchCodes":["Good","Up"]},"geometry":{"coordinates":['), F.col("LONGITUDE").cast("string"), F.lit(","),
                   F.col("LATITUDE").cast("string"), F.lit("]}}]}]}"))
    miss = F.lit('{"batchItems":[{"error":{"code":"none"}}]}')
    item = F.get(geocoder.parse_answer(F.when(F.col("UPRN") % 3 == 0, miss).otherwise(hit)), F.lit(0))
    return u.select("UPRN", item.alias("i")).select("UPRN", F.col("i.entityType").alias("entity"), "i.confidence", F.round("i.latitude", 6).alias("latitude"), F.round("i.longitude", 6).alias("longitude"), F.col("i.matchCodes").alias("codes"))


@query("orders", "SELECT o_orderkey, 'http://host/v1?key=a+b&top=3' AS url, epoch_ms(o_orderkey * 1000) AS at FROM orders")
def d30_requests(spark, o):
    text = F.concat(F.lit("/Date("), (F.col("o_orderkey") * 1000).cast("string"), F.lit(")/"))
    return o.select("o_orderkey", geocoder.build_url("http://host/v1", {"key": "a b", "none": None, "top": 3}).alias("url"), geocoder.service_time(text).cast("timestamp_ntz").alias("at"))


# -- composed tables

@query("uprns squares sales", f"""WITH a AS (SELECT u.UPRN, s.name FROM uprns u JOIN squares s ON {_IN})
  SELECT s.transactionid, s.uprn, round(u.LATITUDE, 6) AS lat, CASE WHEN s.uprn IS NOT NULL THEN a.name ELSE 'P' || right(s.postcode, 3) END AS area
  FROM sales s LEFT JOIN uprns u ON u.UPRN = s.uprn LEFT JOIN a ON a.UPRN = s.uprn""")
def f6_f7_add_places(spark, u, sq, s):
    codes = u.select("postcode").distinct().select(F.col("postcode").alias("pcds"), F.concat(F.lit("P"), F.substring("postcode", -3, 3)).alias("lsoa21cd"))
    out = prices.add_places(s.drop("LSOA21CD"), u, _square(sq).withColumnRenamed("name", "LSOA21CD"), codes)
    return out.select("transactionid", "uprn", F.round("LATITUDE", 6).alias("lat"), F.col("LSOA21CD").alias("area"))


@query("uprns squares sales", f"""WITH a AS (SELECT u.UPRN, s.name FROM uprns u JOIN squares s ON {_IN}), n AS (SELECT transactionid, CASE WHEN price > 50000 THEN u.UPRN END AS uprn, s.LSOA21CD
    FROM sales s LEFT JOIN (SELECT postcode, min(UPRN) AS UPRN FROM uprns GROUP BY postcode) u USING (postcode) WHERE s.uprn IS NULL)
  SELECT transactionid, uprn, NULL AS lat, LSOA21CD AS area FROM sales WHERE uprn IS NOT NULL
  UNION ALL SELECT n.transactionid, n.uprn, round(u.LATITUDE, 6), CASE WHEN n.uprn IS NOT NULL THEN a.name ELSE n.LSOA21CD END FROM n LEFT JOIN uprns u ON u.UPRN = n.uprn LEFT JOIN a ON a.UPRN = n.uprn""")
def f24_combine_rematch(spark, u, sq, s):
    first = u.groupBy("postcode").agg(F.min("UPRN").alias("__u"))
    again = s.filter("uprn is null").join(first, "postcode", "left").withColumn("uprn", F.when(F.col("price") > 50000, F.col("__u"))).drop("__u")
    none = {c: F.lit(None).cast("double") for c in ("LATITUDE", "LONGITUDE")}
    out = prices.combine_rematch(s.withColumns(none), again.withColumns(none), u, _square(sq).withColumnRenamed("name", "LSOA21CD"))
    return out.select("transactionid", "uprn", F.round("LATITUDE", 6).alias("lat"), F.col("LSOA21CD").alias("area"))


@query("uprns known geocodes", """WITH g AS (SELECT 'A' || (id % 4) || ' Kiln Hill' AS addr, x, y, id FROM geocodes), h AS (SELECT * FROM uprns WHERE UPRN IN (SELECT UPRN FROM known)), l AS (SELECT * FROM uprns WHERE UPRN NOT IN (SELECT UPRN FROM known)),
  n AS (SELECT g.id, g.addr, l.UPRN, sqrt((g.x - l.x) ** 2 + (g.y - l.y) ** 2) AS d FROM g, l WHERE sqrt((g.x - l.x) ** 2 + (g.y - l.y) ** 2) <= 10 QUALIFY row_number() OVER (PARTITION BY g.id ORDER BY d, l.UPRN) = 1),
  r AS (SELECT g.id, min(sqrt((g.x - h.x) ** 2 + (g.y - h.y) ** 2)) AS d FROM g, h WHERE sqrt((g.x - h.x) ** 2 + (g.y - h.y) ** 2) <= 10 GROUP BY g.id),
  k AS (SELECT DISTINCT n.UPRN, n.addr FROM n LEFT JOIN r USING (id) WHERE r.d IS NULL OR n.d <= r.d)
  SELECT UPRN, addr, 'geocoded_2022' AS address_source FROM k QUALIFY count(*) OVER (PARTITION BY UPRN) = 1 UNION ALL SELECT UPRN, addr, address_source FROM known""")
def j11_augment_known(spark, u, k, g):
    past = g.select(F.concat(F.lit("A"), F.col("id") % 4, F.lit(" Kiln Hill")).alias("addr"), F.lit("AB1 1CD").alias("postcode"), "x", "y")
    return addresses.augment_known(k, past, u).select("UPRN", "addr", "address_source")


@query("titles substations uprns", f"""WITH m AS (SELECT row_id, regexp_matches(address_line, '(?i)\\bsub[- ]?stations?\\b') AS s FROM titles), n AS (SELECT count(*) AS n FROM substations)
  SELECT count(*) FILTER (s) AS n_substation_titles_seen, n.n AS n_osm_substation_points, 0 AS n_osm_substation_polygons, n.n AS n_substation_uprns, count(*) FILTER (s AND row_id % 2 = 0) AS n_substation_titles_matched,
  round_even(count(*) FILTER (s AND row_id % 2 = 0) / greatest(count(*) FILTER (s), 1), 4) AS match_rate FROM m, n GROUP BY n.n""")
def m10_substation_audit(spark, t, s, u):
    asked = _asked(t)
    source = F.when(K.is_substation("AddressLine") & (F.col("row_id") % 2 == 0), "substation_street_match")
    out = audits.substation_audit(s, s.limit(0), s, asked, asked.withColumn("source", source))
    return out.select("n_substation_titles_seen", *[F.col(c).cast("long").alias(c) for c in ("n_osm_substation_points", "n_osm_substation_polygons", "n_substation_uprns", "n_substation_titles_matched")], "match_rate")


@query("known uprn_usrn uprns nsul infill", f"""WITH {_PD}, v AS (SELECT USRN, {s_name('street')} AS street FROM known JOIN uprn_usrn USING (UPRN)),
  s AS (SELECT USRN, street, count(*) AS n, sum(count(*)) OVER (PARTITION BY USRN) AS total FROM v GROUP BY USRN, street QUALIFY row_number() OVER (PARTITION BY USRN ORDER BY n DESC, street) = 1),
  c AS (SELECT UPRN FROM uprns WHERE UPRN NOT IN (SELECT UPRN FROM known))
  SELECT c.UPRN, s.street, n.postcode AS postcode, n.lad_code AS district, 'usrn_street' AS address_source FROM c JOIN uprn_usrn USING (UPRN) JOIN s ON s.USRN = uprn_usrn.USRN AND s.n / s.total >= 0.6
  LEFT JOIN nsul n ON n.UPRN = c.UPRN""")
def p3_uprn_infill(spark, k, uu, u, n, i):
    """The composed table, without buildings and guesses; the register's place stands where it has one."""
    candidates = u.join(k.select("UPRN"), "UPRN", "left_anti")
    district = lookups.postcode_district(u)
    names = addresses.street_names(uu, k, district)
    null = F.lit(None).cast("string")
    buildings = candidates.limit(0).select("UPRN", *[null.alias(c) for c in ("osm_housenumber", "osm_street", "osm_postcode", "osm_building_name", "osm_city")])
    guesses = candidates.limit(0).select("UPRN", null.alias("house_number"), null.alias("postcode"), null.alias("guess_between"))
    places = n.select("UPRN", "postcode", F.col("lad_code").alias("district"))
    out = addresses.infill(candidates, buildings, uu, names.withColumn("district", null), guesses, district, places)
    return out.select("UPRN", "street", "postcode", "district", "address_source")


@query("sales epc_dom epc_nondom uprns squares", f"""WITH a AS (SELECT u.UPRN, s.name FROM uprns u JOIN squares s ON {_IN}),
  k AS (SELECT postcode, property_type, address1, address3, la, min(uprn) AS u FROM sales WHERE uprn IS NOT NULL GROUP BY ALL),
  l AS (SELECT s.transactionid, s.postcode, s.address1, s.address3, coalesce(s.uprn, k.u) AS uprn FROM sales s LEFT JOIN k ON s.postcode IS NOT DISTINCT FROM k.postcode AND s.property_type = k.property_type AND s.address1 = k.address1 AND s.address3 = k.address3 AND s.la = k.la),
  d AS (SELECT replace(upper(addr), ',', '') AS line, POSTCODE AS pc, UPRN FROM epc_dom QUALIFY row_number() OVER (PARTITION BY line, pc ORDER BY year DESC, UPRN) = 1),
  n AS (SELECT replace(upper(adr1), ',', '') AS line, postcode AS pc, UPRN FROM epc_nondom QUALIFY row_number() OVER (PARTITION BY line, pc ORDER BY year DESC, UPRN) = 1),
  f AS (SELECT l.transactionid, l.postcode, coalesce(l.uprn, d.UPRN, n.UPRN) AS uprn FROM (SELECT *, upper(address1 || ' ' || address3) AS line FROM l) l LEFT JOIN d ON d.line = l.line AND d.pc = l.postcode LEFT JOIN n ON n.line = l.line AND n.pc = l.postcode)
  SELECT f.transactionid, f.uprn, round(u.LATITUDE, 6) AS lat, CASE WHEN f.uprn IS NOT NULL THEN a.name ELSE 'P' || right(f.postcode, 3) END AS area FROM f LEFT JOIN uprns u ON u.UPRN = f.uprn LEFT JOIN a ON a.UPRN = f.uprn""")
def p6_sales_with_places(spark, s, dom, non, u, sq):
    """Sales linked by identifier and address, matched to the registers, and placed."""
    links = s.filter("uprn is not null").select("transactionid", "uprn", F.lit(None).cast("long").alias("parentuprn"), F.lit(None).cast("long").alias("usrn"))
    linked = prices.link_sales(s.drop("uprn", "LSOA21CD"), links)
    found = prices.match_registers(linked.withColumn("address3", F.upper("address3")), dom, non)
    codes = u.select("postcode").distinct().select(F.col("postcode").alias("pcds"), F.concat(F.lit("P"), F.substring("postcode", -3, 3)).alias("lsoa21cd"))
    out = prices.add_places(found, u, _square(sq).withColumnRenamed("name", "LSOA21CD"), codes)
    return out.select("transactionid", "uprn", F.round("LATITUDE", 6).alias("lat"), F.col("LSOA21CD").alias("area"))


@query("uprn_usrn uprns", f"""WITH p AS (SELECT USRN, CASE WHEN USRN % 3 = 0 THEN 'KILN HILL' ELSE 'QUAY ROAD' END AS street, 'D' || (USRN % 4) AS district, avg(x) / 4 + USRN * 12 AS x, avg(y) / 4 AS y FROM uprn_usrn JOIN (SELECT UPRN, x, y FROM uprns) USING (UPRN) GROUP BY USRN),
  w AS (SELECT a.district, a.street, max(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS d FROM p a JOIN p b USING (district, street) GROUP BY ALL)
  SELECT p.district || '|' || p.street AS key, count(*) AS n_usrn FROM p JOIN w USING (district, street) WHERE w.d < 1500 GROUP BY ALL""")
def g14_street_centroids(spark, uu, u):
    middles = uu.join(u.select("UPRN", "x", "y"), "UPRN").groupBy("USRN").agg((F.avg("x") / 4 + F.col("USRN") * 12).alias("x"), (F.avg("y") / 4).alias("y"))
    names = middles.select("USRN", F.when(F.col("USRN") % 3 == 0, "KILN HILL").otherwise("QUAY ROAD").alias("street"), F.concat(F.lit("D"), F.col("USRN") % 4).alias("district"))
    return addresses.street_centroids(names, middles).select("key", F.col("n_usrn").cast("long").alias("n_usrn"))


@query("orders uprns", """WITH q AS (SELECT o_orderkey AS k, o_custkey % 200 AS g FROM orders), s AS (SELECT *, count(*) OVER (PARTITION BY g) AS n, first_value(k) OVER (PARTITION BY g ORDER BY k) AS rep FROM q)
  SELECT k, CASE WHEN n >= 3 AND k <> rep THEN 'inferred' WHEN n >= 3 THEN 'done' ELSE 'pending' END AS status FROM s""")
def q_e_infer_flats(spark, o, u):
    """Every representative was placed on one stack of properties that is high enough for its group."""
    rows = o.select(F.col("o_orderkey").alias("k"), F.lit("T1").alias("Title Number"), F.concat(F.lit("Flat "), F.col("o_orderkey"), F.lit(" Building "), F.col("o_custkey") % 200, F.lit(" House")).alias("AddressLine"),
                    F.lit("AB1 1CD").alias("PostalCode"), F.lit("X").alias("District"))
    queue = geocode_queue.build_queue(rows)
    queue = queue.withColumn("status", F.when((F.col("status") == "pending") & (F.col("queue_key") == F.col("flat_rep_key")), "done").otherwise(F.col("status")))
    results = queue.filter("status = 'done'").select("queue_key", F.lit(53.0).alias("latitude"), F.lit(400000.0).alias("x"), F.lit(300000.0).alias("y"))
    stack = u.select(F.lit(400001.0).alias("x"), F.lit(300000.0).alias("y"))
    return geocode_queue.infer_flats(queue, results, stack)[0].select("k", "status")


