"""Synthetic registers derived from the driver's tables, in SQL that Spark and DuckDB both run.

The tables hold no addresses, so titles, properties, registers, sales and maps are made from their keys
with integer arithmetic; every view is one statement over the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def pick(words: str, n: str) -> str:
    """The n-th of the words between bars, counted around."""
    k = words.count("|") + 1
    return f"split_part('{words}', '|', CAST({n} % {k} + 1 AS INT))"


STREETS = "Acacia Avenue|Fir Tree Gardens|High Street|Somerset Road|Lowedges Road|Mill Lane|Station Road|Church Lane|Park View|Victoria Street|Old Hall Drive"
TYPOS = "Acacia Avenu|Fir Tree Garden|High Streat|Somerset Rd|Lowedges Rd|Mill Lanes|Staton Road|Church Lan|Park Veiw|Victoria St|Old Hall Dr"


def number(c: str) -> str:
    return f"CAST({c} % 120 + 1 AS STRING)"


def postcode(c: str) -> str:
    return f"('AB' || CAST({c} % 19 + 1 AS STRING) || ' ' || CAST({c} % 9 + 1 AS STRING) || 'CD')"


def lone_postcode(c: str) -> str:
    """The same, but some properties have a postcode of their own."""
    return f"CASE WHEN {c} % 17 = 0 THEN 'ZZ' || CAST({c} AS STRING) || ' 9ZZ' ELSE {postcode(c)} END"


def street(c: str, words: str = STREETS) -> str:
    return pick(words, c)


_PLACED = "SELECT c_custkey AS c, n_name AS d FROM customer JOIN nation ON c_nationkey = n_nationkey"
_X, _Y = "CAST(400000 + (c_custkey * 37) % 5003 AS DOUBLE)", "CAST(300000 + (c_custkey * 91) % 4999 AS DOUBLE)"
_LAT, _LON = "(CAST(c_custkey % 1000 AS DOUBLE) / 1000 + 52)", "(CAST(c_custkey % 700 AS DOUBLE) / 1000 - 1)"

VIEWS: dict[str, str] = {
    # One title per order; every fifth has no postcode, some describe land, buildings or substations.
    "titles": f"""
      SELECT k AS row_id, 'T' || CAST(k AS STRING) AS title_number, tenure, d AS district, pc AS postcode,
        CASE WHEN k % 13 = 0 THEN 'substation, ' || st || ', ' || d
             WHEN k % 11 = 0 THEN 'Rose Cottage ' || CAST(c % 40 AS STRING) || ', ' || st || ', ' || d
             WHEN k % 9 = 0 THEN 'the paddock north of ' || st || ', ' || d
             WHEN k % 8 = 0 THEN st || ', ' || d
             ELSE no || ' ' || st || ', ' || d END AS address_line,
        CASE WHEN k % 7 = 0 THEN 'land adjoining ' WHEN k % 17 = 0 THEN 'part of ' ELSE '' END
          || no || ' ' || CASE WHEN k % 3 = 0 THEN st || ' and the rear of the former brewery site known as the Maltings' ELSE st END || ', ' || d
          || CASE WHEN pc IS NULL THEN '' ELSE ' (' || pc || ')' END
          || CASE WHEN k % 10 = 1 AND pc IS NOT NULL THEN ' and 2 ' || st || ' (AB1 1CD)' ELSE '' END AS property_address
      FROM (SELECT o_orderkey AS k, c, d, {number('c')} AS no, {street('c')} AS st,
              CASE WHEN o_orderkey % 4 = 3 THEN 'Leasehold' ELSE 'Freehold' END AS tenure,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {lone_postcode('c')} END AS pc
            FROM orders JOIN ({_PLACED}) AS placed ON o_custkey = c) AS t""",
    "old_titles": f"""
      SELECT 'T' || CAST(o_orderkey AS STRING) AS title_number,
        {number('o_custkey')} || ' ' || {street('o_custkey')} || CASE WHEN o_orderkey % 3 = 0 THEN ' (old)' ELSE '' END AS property_address
      FROM orders WHERE o_orderkey % 7 <> 0""",
    "new_titles": f"""
      SELECT 'T' || CAST(o_orderkey AS STRING) AS title_number,
        {number('o_custkey')} || ' ' || {street('o_custkey')} AS property_address FROM orders""",
    "uprns": f"""
      SELECT c_custkey AS UPRN, {_X} AS x, {_Y} AS y, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE, n_name AS district,
        {postcode('c_custkey')} AS postcode FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "epc_dom": f"""
      SELECT c_custkey AS UPRN, {number('c_custkey')} || ', ' || {street('c_custkey')} AS addr, CAST(NULL AS STRING) AS ADDRESS2,
        CAST(NULL AS STRING) AS ADDRESS3, {postcode('c_custkey')} AS POSTCODE, CAST(2010 + c_custkey % 12 AS INT) AS year,
        {pick('A|B|C|INVALID!|d|E', 'c_custkey')} AS cur_rate, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE
      FROM customer WHERE c_custkey % 3 = 0""",
    "epc_nondom": f"""
      SELECT c_custkey AS UPRN, CASE WHEN c_custkey % 2 = 0 THEN 'Rose Cottage ' || CAST(c_custkey % 40 AS STRING) || ', ' || {street('c_custkey')}
          ELSE {number('c_custkey')} || ' ' || {street('c_custkey')} END AS adr1,
        CAST(NULL AS STRING) AS adr2, CAST(NULL AS STRING) AS adr3, {postcode('c_custkey')} AS postcode, CAST(2012 + c_custkey % 9 AS INT) AS year,
        CAST(c_custkey % 160 AS STRING) AS rating, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE
      FROM customer WHERE c_custkey % 7 = 1""",
    # One sale per line of an order; the property is the customer's for some, unknown for the others.
    "sales": f"""
      SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS transactionid, l_extendedprice AS price,
        CAST(l_shipdate AS DATE) AS date, {postcode('o_custkey')} AS postcode,
        {pick('D|S|T|F|O', 'l_partkey')} AS property_type, {number('o_custkey')} AS address1, CAST(NULL AS STRING) AS address2,
        CASE WHEN l_linenumber = 1 THEN {street('o_custkey')} ELSE {street('o_custkey', TYPOS)} END AS address3, CAST(NULL AS STRING) AS address4,
        'TOWN' AS town, n_name AS la, 'COUNTY' AS county,
        CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN o_custkey END AS uprn,
        'E' || CAST(o_custkey % 50 AS STRING) AS LSOA21CD
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "areas": "SELECT 'E' || CAST(r_regionkey * 10 + n_nationkey AS STRING) AS LSOA21CD, 'L' || CAST(n_regionkey AS STRING) AS LAD25CD FROM nation JOIN region ON n_regionkey = r_regionkey",
    "known": f"""
      SELECT c_custkey AS UPRN, {number('c_custkey')} || ' ' || {street('c_custkey')} AS addr, {postcode('c_custkey')} AS postcode, {number('c_custkey')} AS house_number,
        CASE WHEN c_custkey % 10 = 0 THEN {street('c_custkey', TYPOS)} ELSE {street('c_custkey')} END AS street,
        {pick('epc_dom|price_paid|dec', 'c_custkey')} AS address_source, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE, {_X} AS x, {_Y} AS y
      FROM customer WHERE c_custkey % 4 <> 0""",
    "uprn_usrn": "SELECT c_custkey AS UPRN, c_custkey % 11 + 11 * (c_nationkey % 5) AS USRN FROM customer",
    "nsul": f"SELECT c_custkey AS UPRN, {lone_postcode('c_custkey')} AS postcode, 'E0' || CAST(c_nationkey AS STRING) AS lad_code FROM customer WHERE c_custkey % 6 <> 5",
    # Places of streets, by district and by postcode, and where they cross a postcode's boundary.
    "street_middles": f"""
      SELECT upper(n_name) || '|' || upper({street('c_custkey')}) AS key, max({_LAT}) AS LATITUDE, min({_LON}) AS LONGITUDE, CAST(count(*) AS INT) AS n_usrn
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, {street('c_custkey')} HAVING count(*) % 3 <> 0""",
    "postcode_middles": f"""
      SELECT replace({postcode('c_custkey')}, ' ', '') || '|' || upper({street('c_custkey')}) AS key, max({_LAT}) AS LATITUDE, min({_LON}) AS LONGITUDE, CAST(count(*) AS INT) AS n_usrn
      FROM customer WHERE c_custkey % 3 <> 0 GROUP BY {postcode('c_custkey')}, {street('c_custkey')}""",
    "boundary_points": f"""
      SELECT replace({postcode('c_custkey')}, ' ', '') || '|' || upper({street('c_custkey')}) AS key, max({_LAT}) AS LATITUDE, min({_LON}) AS LONGITUDE, CAST(count(*) AS INT) AS n_usrn
      FROM customer WHERE c_custkey % 4 = 1 GROUP BY {postcode('c_custkey')}, {street('c_custkey')}""",
    # Some districts have one substation, some more; a few streets are named after theirs.
    "substations": f"""
      SELECT c_custkey AS UPRN, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE FROM customer WHERE c_custkey % 67 = 3""",
    "usrn_streets": f"SELECT c_custkey % 11 + 11 * (c_nationkey % 5) AS USRN, max(CASE WHEN c_custkey % 11 = 3 THEN 'substation' ELSE {street('c_custkey')} END) AS street FROM customer GROUP BY c_custkey % 11 + 11 * (c_nationkey % 5)",
    "road_classes": f"SELECT p_partkey AS id, {pick('Motorway|A Road|Guided Busway Carriageway|Local Road|Motorway, Collapsed Dual Carriageway||Shared Use Carriageway', 'p_partkey')} AS classification FROM part",
    "district_names": f"""
      SELECT n_nationkey AS id, {pick('Caerdydd - Cardiff|St. Helens|City of Leicester|Kettering|Northampton|Powys - Powys|Corby', 'n_nationkey')}
        || {pick('| (B)| District|', 'n_nationkey')} AS name FROM nation""",
    "unit_rows": f"""
      SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 9 AS STRING) END AS unit_id, {pick('flat|office|suite|unit', 's_suppkey')} AS unit_type,
        CASE WHEN s_suppkey % 3 = 0 THEN 'Quay House' END AS building_name, {number('s_suppkey')} AS street_number, {street('s_suppkey')} AS street_name FROM supplier""",
    "compass": """
      SELECT o_orderkey AS id, CASE CAST(o_orderkey % 6 AS INT) WHEN 0 THEN 'Land on the Northern side of' WHEN 1 THEN 'land adjoing the south-east corner of'
        WHEN 2 THEN 'the WESTERLY part, ajoining' WHEN 3 THEN 'south west of' WHEN 4 THEN 'northly and eastern of' ELSE 'at' END || ' ' || CAST(o_orderkey % 30 AS STRING) AS text FROM orders""",
    "lad_names": "SELECT 'E0' || CAST(n_nationkey AS STRING) AS lad_code, n_name AS lad_name FROM nation",
    "releases": f"""
      SELECT l_partkey AS UPRN, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(max(l_quantity) AS DOUBLE) AS X_COORDINATE, CAST(min(l_quantity) AS DOUBLE) AS Y_COORDINATE,
        CAST(max(l_discount) AS DOUBLE) AS LATITUDE, CAST(min(l_tax) AS DOUBLE) AS LONGITUDE FROM lineitem GROUP BY l_partkey, date_trunc('month', l_shipdate)""",
    # Squares of the plane, as four edges; ids are 1 to 25.
    "squares": """
      SELECT n_nationkey + 1 AS id, 'E' || CAST(n_nationkey AS STRING) AS name, CAST(400000 + (n_nationkey % 5) * 900 AS DOUBLE) AS x0,
        CAST(300000 + CAST(floor(n_nationkey / 5) AS INT) * 900 AS DOUBLE) AS y0, CAST(800 AS DOUBLE) AS side FROM nation""",
    # Straight roads across it.
    "roads": f"""
      SELECT n_nationkey AS id, {pick(STREETS, 'n_nationkey')} AS name, CAST(400000 + n_nationkey * 190 AS DOUBLE) AS x1, CAST(300000 AS DOUBLE) AS y1,
        CAST(400000 + n_nationkey * 190 + 400 AS DOUBLE) AS x2, CAST(304900 AS DOUBLE) AS y2 FROM nation""",
    # What was geocoded: points off the properties.
    "geocodes": """
      SELECT s_suppkey AS id, CAST(400000 + (s_suppkey * 137) % 5003 AS DOUBLE) + 0.5 AS x, CAST(300000 + (s_suppkey * 291) % 4999 AS DOUBLE) + 0.25 AS y FROM supplier""",
    # Even houses along a street, four numbers apart, with some that lack a number between them.
    "numbered": """
      SELECT s_suppkey AS UPRN, CAST(floor(s_suppkey / 20) AS BIGINT) AS USRN, CAST(2 + (s_suppkey % 20) * 4 AS STRING) AS house_number, 'AB11CD' AS postcode,
        CAST((s_suppkey % 20) * 20 AS DOUBLE) AS X, CAST(5 + (s_suppkey % 20) * 0.01 AS DOUBLE) AS Y FROM supplier""",
    "unnumbered": """
      SELECT 1000000 + s_suppkey AS UPRN, CAST(floor(s_suppkey / 20) AS BIGINT) AS USRN, CAST((s_suppkey % 20) * 20 + 10 AS DOUBLE) AS X,
        CAST(CASE WHEN s_suppkey % 5 = 0 THEN 40 ELSE 6 END AS DOUBLE) AS Y FROM supplier WHERE s_suppkey % 3 <> 0""",
    "infill": f"""
      SELECT c_custkey AS UPRN, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {number('c_custkey')} END AS house_number, upper({street('c_custkey')}) AS street, {postcode('c_custkey')} AS postcode,
        CASE WHEN c_custkey % 12 = 0 THEN 'ROSE COTTAGE ' || CAST(c_custkey % 40 AS STRING) END AS building_name, n_name AS district,
        CASE WHEN c_custkey % 8 = 0 THEN 'osm_building' ELSE 'usrn_street' END AS address_source, c_custkey % 16 = 4 AS number_guessed,
        CASE WHEN c_custkey % 16 = 4 THEN 'gap_guess' END AS number_source, CASE WHEN c_custkey % 16 = 4 THEN '1-5' END AS guess_between,
        'gap_neighbours' AS postcode_source, 'low' AS street_confidence, {_LAT} AS LATITUDE, {_LON} AS LONGITUDE
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 = 0""",
    "legal": """
      SELECT o_orderkey AS id, CASE CAST(o_orderkey % 12 AS INT)
        WHEN 0 THEN 'The airspace above 12 High Street, London' WHEN 1 THEN 'all mines and minerals as excepted filed at the Registry 12 High Street, Leeds'
        WHEN 2 THEN 'land on the north side of Weeland Road' WHEN 3 THEN 'Land adjoing the Sub-Station, Field Lane'
        WHEN 4 THEN 'the first floor flat being 4 Foo Street' WHEN 5 THEN 'the south-facing roof, 55 Prospect Terrace'
        WHEN 6 THEN 'Garden land and buildings lying to the rear of 3 Mill Lane' WHEN 7 THEN 'the eighth floor being 55 Broadway, London'
        WHEN 8 THEN 'glebe land on the north and east sides of Church Lane' WHEN 9 THEN 'ground floor premises 9 Station Road'
        WHEN 10 THEN 'the basement, 7 Park View' ELSE '10 Victoria Street' END || ' ' || CAST(o_orderkey % 30 AS STRING) AS text
      FROM orders""",
    "queue_log": "SELECT event_id, user_id AS queue_key, event_type AS status, ts FROM events",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for t in BASE:
        if t in VIEWS[name]:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(VIEWS[name])


def with_views(names: str, sql: str) -> str:
    """SQL for DuckDB that sees the named views (blank-separated)."""
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    sql = sql.strip()
    return f"WITH {parts}, {sql[5:]}" if sql[:5].upper() == "WITH " else f"WITH {parts} {sql}"
