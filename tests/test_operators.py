"""Operators on small cases and against slower, plainer forms."""

import datetime as dt
import math
import random
import tempfile
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from placeweave.functions import geo as G
from placeweave.operators import addresses, audits, fuzzy, geocode_queue, lookups, master, relational, spatial, titles
from placeweave.plans import queries as plans
from placeweave.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def test_registry_and_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["d2_d9_keys", "c2_categorise_freehold", "f17_cascade", "g9_street_names", "j4_points_in_polygons", "h9_gap_guesses", "k1_match_block"])
def test_queries_run(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_guard():
    class Frame:
        columns = ["a"]

    with pytest.raises(ValueError, match="lacks"):
        relational.require_columns(Frame(), ["a", "b"])


def test_cascade_equals_one_stage_after_another(spark):
    from placeweave.plans.views import view

    t = plans._asked(view(spark, SF, "titles")).cache()
    tables = plans._lookups(*[view(spark, SF, n) for n in ("epc_dom", "epc_nondom", "sales", "known", "infill", "nsul", "uprns")])
    key = lambda c: spark.createDataFrame([(c, 51.0, -1.0, 1)], "key string, LATITUDE double, LONGITUDE double, n_usrn int")
    tables |= {"street_centroid": key("FRANCE|HIGH STREET"), "street_centroid_postcode": key("AB11CD|MILL LANE"), "substation": tables["infill"].limit(0)}
    kinds = lookups.stage_keys()
    rows = t.select("row_id", *[c.alias(k) for k, c in kinds.items()]).collect()
    found = {name: {r["key"]: r for r in table.collect()} for name, table in tables.items()}
    want = {}
    for r in rows:
        want[r["row_id"]] = (None,) * 5
        for kind, name, quality in lookups.STAGES:
            hit = found.get(name, {}).get(r[kind])
            if hit is not None and r[kind] is not None:
                centroid = lookups.CENTROIDS.get(name)
                source = centroid + "_buried" * kind.endswith("buried") if centroid else hit["match_source"]
                want[r["row_id"]] = (None if centroid else hit["UPRN"], hit["LATITUDE"], hit["LONGITUDE"], quality or hit["match_quality"], source + "_match")
                break
    got = {r["row_id"]: tuple(r)[1:] for r in lookups.cascade(t, tables).select("row_id", "UPRN", "LATITUDE", "LONGITUDE", "match_quality", "source").collect()}
    assert got == want and sum(v[4] is not None for v in want.values()) > 0


def test_buried_street_stage(spark):
    t = spark.createDataFrame([(1, "the paddock north of Foo Street", None, "Leeds")], "row_id long, AddressLine string, PostalCode string, District string")
    c = spark.createDataFrame([("LEEDS|FOO STREET", 53.0, -1.0, 1)], "key string, LATITUDE double, LONGITUDE double, n_usrn int")
    r = lookups.cascade(t, {"street_centroid": c}).first()
    assert r["match_quality"] == "street" and "buried" in r["source"] and r["UPRN"] is None


LOOKUP = "UPRN long, LATITUDE double, LONGITUDE double, street_norm string, building_norm string, house_number string, postcode string, district string"
ASK = "row_id long, AddressLine string, PostalCode string, District string"


def _fuzzy(spark, row, table, places=None):
    rows = spark.createDataFrame([(1, *row)], ASK)
    if places is not None:
        table = spark.createDataFrame([(*r, x, y) for r, (x, y) in table], LOOKUP + ", x double, y double")
        places = spark.createDataFrame(places, "postcode string, x double, y double")
    else:
        table = spark.createDataFrame(table, LOOKUP)
    return fuzzy.match_fuzzy(rows, table, places).first()


def test_fuzzy_blocks(spark):
    at = (53.0, -1.0)
    typo = _fuzzy(spark, ("101 Somerset Rd, Huddersfield", "HD1 1AA", None), [(101, *at, "SOMERSET ROAD", None, "101", "HD11AA", None), (102, *at, "OTHER ROAD", None, "101", "HD11AA", None)])
    assert typo["UPRN"] is None or typo["UPRN"] == 101
    sole = _fuzzy(spark, ("101 Somerset Rd", "HD1 1AA", None), [(202, *at, "COMPLETELY DIFFERENT LANE", None, "101", "HD11AA", None)])
    assert sole["UPRN"] == 202 and sole["fuzzy_block"] == "postcode"
    other = _fuzzy(spark, ("101 Somerset Rd", "HD1 1AA", None), [(103, *at, "SOMERSET ROAD", None, "103", "HD11AA", None)])
    assert other["UPRN"] is None
    district = _fuzzy(spark, ("348 Lowedges Road, Sheffield", None, "SHEFFIELD"), [(401, *at, "LOWEDGES ROAD", None, "348", None, "SHEFFIELD"), (402, *at, "BIRCH CLOSE", None, "348", None, "SHEFFIELD")])
    assert district["UPRN"] == 401 and district["fuzzy_block"] == "district"
    assert _fuzzy(spark, ("Land at Fake Street, Town", None, "X"), [(1, *at, "FAKE STREET", None, "1", None, "X")])["UPRN"] is None
    named = _fuzzy(spark, ("Ivy Cottage, Ackton Lane", "WF7 6HP", None), [(701, *at, None, "IVY COTTAGE", None, "WF76HP", None)])
    assert named["UPRN"] == 701 and named["fuzzy_block"] == "building_name"
    wrong = _fuzzy(spark, ("15 Benomley Crescent, Huddersfield", "HD5 8LU", "KIRKLEES"), [(801, *at, "BENOMLEY CRESCENT", None, "15", "HD58LT", "KIRKLEES")])
    assert wrong["UPRN"] == 801 and wrong["fuzzy_block"] == "postcode_mismatch_district"
    near = _fuzzy(spark, ("15 Benomley Crescent, Huddersfield", "HD5 8LU", None), [((901, *at, "BENOMLEY CRESCENT", None, "15", "HD58LT", None), (100.0, 100.0))], [("HD58LU", 300.0, 100.0)])
    assert near["UPRN"] == 901 and near["fuzzy_block"] == "postcode_geographic"


def test_big_blocks_are_not_guessed(spark):
    at = (53.0, -1.0)
    table = spark.createDataFrame([(i, *at, "P", "1", f"STREET {i}") for i in range(10)] + [(600, *at, "P", "1", "ZEBRA LANE")], "UPRN long, LATITUDE double, LONGITUDE double, block string, number string, text string")
    ask = lambda t: spark.createDataFrame([(1, "P", "1", t)], "row_id long, block string, number string, text string")
    assert fuzzy.match_block(ask("STREET 4"), table, max_block=5).count() == 0
    assert fuzzy.match_block(ask("ZEBRA LAN"), table, max_block=5).first()["UPRN"] == 600


def test_gap_guesses(spark):
    known = [(1, 100, "22", "LS61RN", 0.0, 5.0), (2, 100, "26", "LS61RN", 20.0, 5.0), (3, 100, "21", "LS61RN", 10.0, -20.0)]
    k = spark.createDataFrame(known, "UPRN long, USRN long, house_number string, postcode string, X double, Y double")
    ask = lambda rows: spark.createDataFrame(rows, "UPRN long, USRN long, X double, Y double")
    found = addresses.gap_guesses(ask([(9, 100, 10.0, 6.0), (10, 100, 300.0, 5.0)]), k).collect()
    assert [(r["UPRN"], r["house_number"], r["postcode"]) for r in found] == [(9, "24", "LS61RN")]
    assert addresses.gap_guesses(ask([(11, 100, 10.0, -21.0)]), k).count() == 0
    assert addresses.gap_guesses(ask([(12, 100, 8.0, 6.0), (13, 100, 12.0, 6.0)]), k).count() == 0


def square(spark, x, y, side, name, what="name"):
    p = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return {what: name, "edges": [dict(zip(("x1", "y1", "x2", "y2"), (float(a), float(b), float(c), float(d)))) for (a, b), (c, d) in zip(p, p[1:])]}


EDGES = "edges array<struct<x1:double,y1:double,x2:double,y2:double>>"


def test_snap(spark):
    uprns = spark.createDataFrame([(101, 430000.0, 433000.0), (102, 430100.0, 433000.0), (103, 430300.0, 433000.0)], "UPRN long, x double, y double")
    rows = spark.createDataFrame([("A", 430095.0, 433003.0, None), ("B", 430000.2, 433000.1, "A"), ("C", 900000.0, 433000.0, None)], "queue_key string, x double, y double, inferred_from string")
    got = {r["queue_key"]: r for r in spatial.snap(rows, uprns).collect()}
    assert got["A"]["UPRN"] == 102 and got["A"]["source"] == "azure_geocoded_uprn_snap"
    assert got["B"]["UPRN"] == 101 and got["B"]["uprn_distance_m"] < 1 and got["B"]["source"] == "azure_geocoded_flat_inferred"
    assert got["C"]["UPRN"] is None and got["C"]["source"] == "azure_geocoded"
    assert spatial.snap(rows.limit(0), uprns).count() == 0


def test_k_nearest_equals_brute_force(spark):
    rng = random.Random(3)
    spots = [(i, rng.choice([400000.0, 400700.0]) + rng.choice([0, 1, 30]) * rng.random(), 300000.0 + rng.choice([0, 5, 900]) * rng.random()) for i in range(1500)]
    spots += [(2000 + i, 400350.0, 300100.0) for i in range(40)] + [(3000, None, 1.0), (3001, float("nan"), 300000.0)]
    asked = [(i, 399900.0 + 1000 * rng.random(), 299900.0 + 1000 * rng.random()) for i in range(60)]
    asked += [(100, 400350.0, 300100.0), (101, 0.0, 0.0), (102, None, 300000.0), (103, 400001.0, 300001.0), (103, 400001.0, 300001.0), (None, 400700.0, 300002.0)]
    points, targets = (spark.createDataFrame(r, f"{n} long, x double, y double") for r, n in ((asked, "id"), (spots, "UPRN")))
    want = []
    for key in {a[0] for a in asked}:
        near = [(math.sqrt((x - u) ** 2 + (y - v) ** 2), t) for i, x, y in asked if i == key and x is not None for t, u, v in spots if u is not None and u == u]
        want += [(str(key), t, r + 1) for r, (d, t) in enumerate(sorted(n for n in near if n[0] <= 750)[:25])]
    got = spatial.k_nearest(points, targets, 750.0, 25, "id", "UPRN")
    assert sorted((str(r["point"]), r["target"], r["rank"]) for r in got.collect()) == sorted(want)


def test_k_nearest_of_dense_targets(spark):
    """No more pairs are made than a few times k for each point, however many targets the radius holds."""
    targets = spark.range(40000).select(F.col("id").alias("UPRN"), (F.col("id") % 200).cast("double").alias("x"), F.floor(F.col("id") / 200).cast("double").alias("y"))
    points = spark.range(20).select("id", (F.col("id") * 10 + 0.5).alias("x"), (F.col("id") * 9 + 0.25).alias("y"))
    got = spatial.k_nearest(points, targets, 300.0, 10, "id", "UPRN")
    got.collect()
    plan, joined = got._jdf.queryExecution().executedPlan(), []

    def visit(node):
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joined.append(node.metrics().apply("numOutputRows").value())
        inner = [node.children().apply(i) for i in range(node.children().size())]
        for name in ("executedPlan", "plan"):
            if "AdaptiveSparkPlan" in node.nodeName() and name == "executedPlan" or "QueryStage" in node.nodeName() and name == "plan":
                inner.append(getattr(node, name)())
        for n in inner:
            visit(n)

    visit(plan)
    assert got.count() == 200 and joined and max(joined) < 20 * 400


def test_k_nearest_broadcasts_no_exploded_rows(spark):
    """Tables with small files make many rows of cells, which must not be sent through the driver."""
    targets = spark.range(4000).select(F.col("id").alias("UPRN"), (F.col("id") % 200).cast("double").alias("x"), F.floor(F.col("id") / 200).cast("double").alias("y"))
    points = spark.range(20).select("id", (F.col("id") * 10 + 0.5).alias("x"), (F.col("id") + 0.25).alias("y"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1k")
    try:
        assert spatial.k_nearest(points, targets, 300.0, 10, "id", "UPRN").count() == 200
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_substations(spark):
    nodes = spark.createDataFrame([(1, 100.0, 100.0), (2, 200.0, 200.0)], "osm_id long, x double, y double")
    compounds = spark.createDataFrame([square(spark, 0, 0, 10, 9, "osm_id")], "osm_id long, " + EDGES)
    uprns = spark.createDataFrame([(10, 5.0, 5.0), (20, 105.0, 100.0), (21, 205.0, 200.0), (22, 206.0, 200.0)], "UPRN long, x double, y double")
    assert sorted(r["UPRN"] for r in spatial.substation_uprns(nodes, compounds, uprns).collect()) == [10, 20]


def test_streets_in_postcodes(spark):
    lines = spark.createDataFrame([(7, "FOO STREET", 10.0, 50.0, 90.0, 50.0)], "USRN long, street string, x1 double, y1 double, x2 double, y2 double")
    polys = [{"postcode": p, "year": y, **{"edges": square(spark, x, 0, 50, "")["edges"]}} for p, y, x in (("A", 2024, 0), ("B", 2024, 50), ("A", 2015, 0))]
    p = [(0, 0), (50, 0), (50, 100), (0, 100), (0, 0)]
    for d in polys:
        off = 50 if d["postcode"] == "B" else 0
        d["edges"] = [dict(zip(("x1", "y1", "x2", "y2"), (float(a + off), float(b), float(c + off), float(e)))) for (a, b), (c, e) in zip(p, p[1:])]
    got = {r["key"]: r for r in spatial.streets_in_postcodes(lines, spark.createDataFrame(polys, "postcode string, year int, " + EDGES)).collect()}
    assert set(got) == {"A|FOO STREET", "B|FOO STREET"} and got["A|FOO STREET"]["x"] == 30 and got["B|FOO STREET"]["x"] == 70 and got["A|FOO STREET"]["last_seen_year"] == 2024


def test_lines_and_parcels(spark):
    line = spark.createDataFrame([(900, [(0.0, 0.0), (100.0, 0.0)]), (901, [(0.0, 50.0), (8.0, 50.0)])], "USRN long, line array<struct<x:double,y:double>>")
    pts = spatial.sample_line_points(line).collect()
    assert sorted(r["x"] for r in pts if r["id"] == 900) == [12.5, 37.5, 62.5, 87.5] and [r["x"] for r in pts if r["id"] == 901] == [4.0]
    out = plans.QUERIES["j12_merge_parcels"](spark, SF).collect()
    assert len(out) == 25 and all(r["n"] == 2 and r["area"] == 160 and r["edges"] == 6 for r in out)


def test_queue_lifecycle(spark, tmp_path):
    rows = [("T1", f"Flat {i}, Kings Court", "LS1 1AA", "LEEDS") for i in range(1, 6)] + [("T2", "12 Unique Close, Leeds", None, "LEEDS"), ("T3", "@MNS", None, None)]
    un = spark.createDataFrame(rows, "`Title Number` string, AddressLine string, PostalCode string, District string")
    q = geocode_queue.build_queue(un)
    status = {r["queue_key"]: r["status"] for r in q.collect()}
    assert status["T1||Flat 1, Kings Court"] == "pending" and status["T1||Flat 2, Kings Court"] == "deferred_flat" and status["T3||@MNS"] == "not_geocodable"
    again = geocode_queue.assign_flats(q)
    assert {r["queue_key"]: r["status"] for r in again.collect()} == status
    with pytest.raises(PermissionError):
        geocode_queue.run_batch(q, lambda d: d, 5, str(tmp_path), "a")
    with pytest.raises(PermissionError):
        geocode_queue.run_batch(q, lambda d: d, 5, str(tmp_path), "a", confirm=True, used=4999)

    calls = []

    def stub(d):
        calls.extend(d["queue_key"])
        if len(calls) == 1:
            raise geocode_queue.GeocoderError("busy")
        return pd.DataFrame({"queue_key": d["queue_key"], "addressLine": "", "adminDistrict": "", "formattedAddress": "", "latitude": 53.0, "longitude": -1.0, "confidence": "High", "entityType": "Address", "matchCodes": ""})

    failed, none = geocode_queue.run_batch(q, stub, 1, str(tmp_path), "a", confirm=True)
    assert none.count() == 0 and failed.filter("status = 'failed'").count() == 1
    done, results = geocode_queue.run_batch(q, stub, 2, str(tmp_path), "b", confirm=True, today=dt.date(2026, 1, 2), chunk=1)
    for _ in range(2):  # each row is sent once, however often the tables are read and the batch is run again
        assert done.count() == q.count() and results.count() == 2 and len(calls) == 3
        done, results = geocode_queue.run_batch(q, stub, 2, str(tmp_path), "b", confirm=True, today=dt.date(2026, 1, 2), chunk=1)
    with pytest.raises(KeyError):
        geocode_queue.run_batch(q, lambda d: d[["no such column"]], 2, str(tmp_path), "c", confirm=True)
    assert {r["status"] for r in done.filter("attempts = 1").collect()} == {"done"}
    placed = results.withColumns({"x": F.lit(10.0), "y": F.lit(20.0)})
    stack = lambda n: spark.createDataFrame([(i, 11.0, 20.0) for i in range(n)], "UPRN long, x double, y double")
    inferred, new = geocode_queue.infer_flats(done, placed, stack(5))
    assert new.count() == 4 and inferred.filter("status = 'inferred'").count() == 4
    released, none = geocode_queue.infer_flats(done, placed, stack(3))
    assert none.count() == 0 and released.filter("status = 'pending' and flat_check = 'failed'").count() == 4
    merged = geocode_queue.build_queue(un.filter("`Title Number` <> 'T2'"), done)
    assert merged.filter("status = 'done'").count() == 2
    root = str(tmp_path / "q")
    sinks.write_version(done, root, 1)
    sinks.write_version(merged, root, 2)
    assert sinks.latest_version(spark, root) == 2 and sinks.read_latest(spark, root).count() == merged.count()


def test_readers(spark, tmp_path):
    cols = readers.CCOD
    rows = [["T1", "Freehold", "1 Foo Road (LS1 1AA)", "LEEDS", "W", "R", "LS1 1AA", "P", "1", "C"]] * 2 + [["", "Freehold", "x", "", "", "", "", "", "", ""]]
    pd.DataFrame(rows, columns=cols).to_csv(tmp_path / "ccod.csv", index=False)
    assert readers.titles(spark, str(tmp_path / "ccod.csv")).count() == 1
    pd.DataFrame(rows, columns=[*cols[:-1], "Other"]).to_csv(tmp_path / "bad.csv", index=False)
    with pytest.raises(ValueError):
        readers.titles(spark, str(tmp_path / "bad.csv"))
    pd.DataFrame({"UPRN": [1], "X_COORDINATE": [1.0], "Y_COORDINATE": [2.0], "LATITUDE": [3.0], "LONGITUDE": [4.0]}).to_csv(tmp_path / "r_202406.csv", index=False)
    assert readers.releases(spark, str(tmp_path / "r_202406.csv")).first()["date"] == dt.date(2024, 6, 1)
    (tmp_path / "b.json").write_text('{"features":[{"properties":{"name":"Leeds"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    r = readers.boundaries(spark, str(tmp_path / "b.json"), "name").first()
    assert r["name"] == "Leeds" and len(r["edges"]) == 3


def test_streaming_latest(spark, tmp_path):
    from placeweave.streaming import status

    src = str(tmp_path / "log")
    for i, rows in enumerate(([("a", "pending", 1), ("b", "pending", 1)], [("a", "done", 2)])):
        spark.createDataFrame(rows, "queue_key string, status string, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(src)
    log = status.read_log(spark, src, "queue_key string, status string, ts timestamp", 1)
    q = log.writeStream.foreachBatch(status.upsert_latest(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = sinks.read_latest(spark, str(tmp_path / "out"))
    assert {r["queue_key"]: r["status"] for r in last.collect()} == {"a": "done", "b": "pending"}


def test_ratings_and_display(spark):
    d = spark.createDataFrame([(1, "C"), (2, "INVALID!"), (3, "a")], "UPRN long, cur_rate string")
    assert [r["epc_dom_rating"] for r in master.domestic_rating(d).orderBy("UPRN").collect()] == ["C", None, "A"]
    with pytest.raises(ValueError):
        master.domestic_rating(d.withColumnRenamed("cur_rate", "rate"))
    assert plans.QUERIES["c14_c15_map_extract"](spark, SF).filter("address is not null").count() > 0


def test_batches(spark):
    out = sinks.batches(spark.range(0, 1000, 1, 7).withColumn("id", 999 - F.col("id")), 300, "id").groupBy("batch").agg(F.count("*").alias("n"), F.min("id").alias("lo")).collect()
    assert sorted((r["batch"], r["n"], r["lo"]) for r in out) == [(0, 300, 0), (1, 300, 300), (2, 300, 600), (3, 100, 900)]


def test_batches_where_splitters_are_sampled(spark):
    # As with more rows, the ranges stay apart.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 300000, 1, 2).select((F.col("id") * 7919 % 300007).alias("id"), F.lit("x").alias("own column"))
    try:
        out = sinks.batches(rows, 1000, "id").groupBy("batch").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("batch").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["batch"] for r in out] == list(range(300)) and {r["n"] for r in out} == {1000}
    assert all(a["hi"] < b["lo"] for a, b in zip(out, out[1:]))
    assert sinks.batches(rows.limit(0), 10, "id").count() == 0


def test_carry_forward_and_split(spark):
    out = plans.QUERIES["e7_split_addresses"](spark, SF)
    assert out.filter("parse_ok and AddressLine like '%@%'").count() == 0 and out.filter("not parse_ok").filter("category <> 'nopc_complex'").count() == 0
    rows = spark.createDataFrame([("1 Foo Road (LS1 1AA) and 2 Bar Lane (LS2 2BB), rear",)], "`Property Address` string")
    got = [(r["AddressLine"], r["PostalCode"]) for r in titles.split_multi_postcode(rows).collect()]
    assert [g[1] for g in got] == ["LS1 1AA", "LS2 2BB"] and got[1][0].startswith("2 Bar Lane")


def test_frequent_ngrams_of_all_lengths(spark):
    rng = random.Random(19)
    passage = [f"w{i}" for i in range(110)]
    texts = [[rng.choice("abc") for _ in range(rng.randrange(30))] + passage[: rng.choice([2, 5, 9, 40, 110])] + [rng.choice("xyz")] for _ in range(80)]
    n = Counter(tuple(t[p : p + k]) for t in texts for k in range(3, 101) for p in range(len(t) - k + 1))
    n = {r: c for r, c in n.items() if c >= 6}
    same = {inner for r, c in n.items() for inner in (r[1:], r[:-1]) if n.get(inner) == c}
    got = audits.frequent_ngrams(spark.createDataFrame([(" ".join(t),) for t in texts] + [(None,), ("",)], "text string")).collect()
    assert sorted(map(tuple, got)) == sorted((" ".join(r), c) for r, c in n.items() if r not in same)
    assert max(len(r["term"].split()) for r in got) == 100


def test_frequent_ngrams_write_little_of_what_is_rare(spark, tmp_path, monkeypatch):
    rng = random.Random(20)
    odd = ["a", "a\x01", "a\x01b", "ab", "é", "\u00a0", "b"]
    texts = [[rng.choice(odd) for _ in range(rng.randrange(9))] + ["p", "q"] * rng.randrange(9) for _ in range(60)] + [["r", "s", "t", "u"]] * 7
    texts += [[f"{rng.random():.12f}" for _ in range(300)] for _ in range(400)]
    rows = spark.createDataFrame([("\n".join(t) + " \t",) for t in texts], "text string").repartition(7)
    n = Counter(tuple(t[p : p + k]) for t in texts for k in range(2, 13) for p in range(len(t) - k + 1))
    n = {r: c for r, c in n.items() if c >= 5}
    same = {inner for r, c in n.items() for inner in (r[1:], r[:-1]) if n.get(inner) == c}
    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    top = Path((spark.conf.get("spark.checkpoint.dir", None) or f"file://{tmp_path}").removeprefix("file://"))
    size = lambda: sum(f.stat().st_size for f in top.rglob("*.parquet"))
    before = size()
    got = audits.frequent_ngrams(rows, "text", 2, 12, 5).collect()
    assert sorted(map(tuple, got)) == sorted((" ".join(r), c) for r, c in n.items() if r not in same)
    assert size() - before < sum(len(" ".join(t)) for t in texts) / 10


def test_snap_keeps_any_distance(spark):
    rng = random.Random(2)
    at = lambda i, lo, hi: (i, rng.uniform(lo, hi), rng.uniform(lo, hi))
    homes = [at(i, 400_000.0, 440_000.0) for i in range(300)]
    rows = [at(i, -300_000.0, 900_000.0) for i in range(40)] + [at(40, 419_000.0, 421_000.0)]
    got = spatial.snap(spark.createDataFrame(rows, "id long, x double, y double"), spark.createDataFrame(homes, "UPRN long, x double, y double"), row_id="id")
    least = {i: min(((x - a) ** 2 + (y - b) ** 2) ** 0.5 for _, a, b in homes) for i, x, y in rows}
    assert {r["id"]: r["uprn_distance_m"] for r in got.collect()} == pytest.approx(least)


def test_combine_final_takes_every_title(spark):
    from placeweave.plans.views import view

    titles_in = {r[0] for r in view(spark, SF, "titles").select("title_number").collect()}
    got = plans.QUERIES["p8_combine_final"](spark, SF).filter("source in ('carried_forward_2022', 'epc_match')")
    assert {r[0] for r in got.select("title_number").collect()} == titles_in


def test_fuzzy_audit_gets_places(spark, monkeypatch):
    given = []
    empty = spark.createDataFrame([], "fuzzy_block string, fuzzy_score double")
    monkeypatch.setattr(fuzzy, "match_fuzzy", lambda rows, table, places=None: given.append(places) or empty)
    plans.QUERIES["m7_fuzzy_audit"](spark, SF)
    assert given[0] is not None and given[0].filter("x is not null and y is not null").count() > 0


def test_diameters_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(f"k{i % 7}", float(rng.randrange(50)), float(rng.randrange(50))) for i in range(400)] + [("one", 1.0, 2.0), ("two", 0.0, 0.0), ("two", 3.0, 4.0), ("line", 0.0, 0.0), ("line", 1.0, 1.0), ("line", 2.0, 2.0)]
    got = {r["key"]: r["d"] for r in spatial.diameters(spark.createDataFrame(rows, "key string, x double, y double"), ["key"], parts=3).collect()}
    for key in {k for k, _, _ in rows}:
        points = [(x, y) for k, x, y in rows if k == key]
        assert got[key] == pytest.approx(max(((a - c) ** 2 + (b - d) ** 2) ** 0.5 for a, b in points for c, d in points))
