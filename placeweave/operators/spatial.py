"""Spatial joins: equal cells first, the exact test after.

Every join is an equi-join on grid cells, so Spark can shuffle, sort and split it like any other;
what a cell brings together is then tested exactly.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import geo as G
from ..sources.sinks import work_dir
from .relational import first_per_key, majority, once_only


def _around(x: Column, y: Column, size: float) -> Column:
    """The cell of a point and its eight neighbours."""
    cx, cy = G.cell(x, size), G.cell(y, size)
    return F.explode(F.array(*[F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))


def _box(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """The cells that a box touches."""
    xs, ys = F.sequence(G.cell(x0, size), G.cell(x1, size)), F.sequence(G.cell(y0, size), G.cell(y1, size))
    return F.explode(F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("cx"), j.alias("cy"))))))


def within(points: DataFrame, targets: DataFrame, radius: float, point_id: str = "id", target_id: str = "UPRN") -> DataFrame:
    """(point, target, d) for all targets within a radius; both sides have x and y."""
    p = points.select(F.col(point_id).alias("point"), F.col("x").alias("px"), F.col("y").alias("py"))
    t = targets.select(F.col(target_id).alias("target"), "x", "y").filter("x is not null and y is not null")
    left = p.filter("px is not null and py is not null").withColumn("c", _around(F.col("px"), F.col("py"), radius))
    right = t.withColumns({"cx": G.cell(F.col("x"), radius), "cy": G.cell(F.col("y"), radius)})
    joined = left.select("point", "px", "py", "c.cx", "c.cy").join(right, ["cx", "cy"])
    d = G.distance(F.col("px"), F.col("py"), F.col("x"), F.col("y"))
    return joined.withColumn("d", d).filter(F.col("d") <= radius).select("point", "target", "d")


def nearest(points: DataFrame, targets: DataFrame, point_id: str = "id", target_id: str = "UPRN", rings: tuple[float, ...] = (50, 500, 5000), beyond: bool = False) -> DataFrame:
    """(point, target, d) with the nearest target, ties to the smallest; none past the last ring unless ``beyond``.

    The rings widen for the points that found nothing, so dense places never meet the wide cells.
    """
    left, found = points.select(point_id, "x", "y"), None
    for radius in rings:
        hits = within(left, targets, radius, point_id, target_id).groupBy("point").agg(F.min(F.struct("d", "target")).alias("m"))
        hits = hits.select("point", "m.target", "m.d")
        found = hits if found is None else found.unionByName(hits)
        left = left.join(hits.select(F.col("point").alias(point_id)), point_id, "left_anti")
    return found.unionByName(_farthest(left, targets, rings[-1], point_id, target_id)) if beyond else found


def _farthest(points: DataFrame, targets: DataFrame, size: float, point_id: str, target_id: str) -> DataFrame:
    """The nearest target of points far from all: only cells that can hold it are opened."""
    t = targets.select(F.col(target_id).alias("target"), "x", "y").filter("x is not null and y is not null")
    t = t.withColumns({"cx": G.cell(F.col("x"), size), "cy": G.cell(F.col("y"), size)})
    p = points.select(F.col(point_id).alias("point"), F.col("x").alias("px"), F.col("y").alias("py")).filter("px is not null and py is not null")
    # As many boxes as the targets' cells, whatever the number of targets.
    boxes = t.groupBy("cx", "cy").agg(F.min("x").alias("x0"), F.max("x").alias("x9"), F.min("y").alias("y0"), F.max("y").alias("y9"))
    zero = F.lit(0.0)
    pairs = p.crossJoin(boxes).select(
        "point", "px", "py", "cx", "cy",
        F.hypot(F.greatest(F.col("x0") - F.col("px"), zero, F.col("px") - F.col("x9")), F.greatest(F.col("y0") - F.col("py"), zero, F.col("py") - F.col("y9"))).alias("least"),
        F.hypot(F.greatest(F.col("px") - F.col("x0"), F.col("x9") - F.col("px")), F.greatest(F.col("py") - F.col("y0"), F.col("y9") - F.col("py"))).alias("most"),
    )
    bound = pairs.groupBy("point").agg((F.min("most") * (1 + 1e-9)).alias("bound"))
    near = pairs.join(bound, "point").filter(F.col("least") <= F.col("bound")).select("point", "px", "py", "cx", "cy")
    d = G.distance(F.col("px"), F.col("py"), F.col("x"), F.col("y"))
    hits = near.join(t, ["cx", "cy"]).groupBy("point").agg(F.min(F.struct(d.alias("d"), "target")).alias("m"))
    return hits.select("point", "m.target", "m.d")


def snap(results: DataFrame, uprns: DataFrame, cutoff: float = 50.0, row_id: str = "queue_key") -> DataFrame:
    """Geocoded rows with the nearest UPRN if within the cutoff, the distance, and a source that says so.

    ``results`` has x and y and may have inferred_from; ``uprns`` has UPRN, x and y.
    """
    near = nearest(results, uprns, row_id, "UPRN", (cutoff, 10 * cutoff, 100 * cutoff), beyond=True)
    out = results.join(near.withColumnRenamed("point", row_id), row_id, "left")
    close = F.coalesce(F.col("d") <= cutoff, F.lit(False))
    inferred = F.col("inferred_from").isNotNull() if "inferred_from" in results.columns else F.lit(False)
    source = F.when(inferred, "azure_geocoded_flat_inferred").when(close, "azure_geocoded_uprn_snap").otherwise("azure_geocoded")
    return out.withColumns({"UPRN": F.when(close, F.col("target")), "uprn_distance_m": F.col("d"), "source": source}).drop("target", "d")


def points_in_polygons(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, size: float = 500.0) -> DataFrame:
    """(point, polygon) for every polygon that holds a point; ``polygons`` has edges."""
    least = lambda f: F.array_min(F.transform("edges", f))
    most = lambda f: F.array_max(F.transform("edges", f))
    boxed = polygons.select(
        F.col(polygon_id).alias("polygon"), "edges",
        least(lambda e: F.least(e["x1"], e["x2"])).alias("x0"), least(lambda e: F.least(e["y1"], e["y2"])).alias("y0"),
        most(lambda e: F.greatest(e["x1"], e["x2"])).alias("x9"), most(lambda e: F.greatest(e["y1"], e["y2"])).alias("y9"),
    ).filter(F.size("edges") > 0)
    cells = boxed.withColumn("c", _box(F.col("x0"), F.col("y0"), F.col("x9"), F.col("y9"), size)).select("*", "c.cx", "c.cy").drop("c")
    p = points.select(F.col(point_id).alias("point"), "x", "y").filter("x is not null and y is not null")
    p = p.withColumns({"cx": G.cell(F.col("x"), size), "cy": G.cell(F.col("y"), size)})
    hit = (F.col("x").between(F.col("x0"), F.col("x9"))) & F.col("y").between(F.col("y0"), F.col("y9"))
    return p.join(cells, ["cx", "cy"]).filter(hit & G.inside(F.col("x"), F.col("y"), F.col("edges"))).select("point", "polygon")


def nearest_segment(points: DataFrame, segments: DataFrame, radius: float, point_id: str, segment_id: str) -> DataFrame:
    """(point, segment, d): the nearest segment (x1, y1, x2, y2) within a radius, ties to the smallest id."""
    r = F.lit(float(radius))
    box = _box(F.least("x1", "x2") - r, F.least("y1", "y2") - r, F.greatest("x1", "x2") + r, F.greatest("y1", "y2") + r, 10 * radius)
    s = segments.select(F.col(segment_id).alias("segment"), "x1", "y1", "x2", "y2", box.alias("c")).select("*", "c.cx", "c.cy").drop("c")
    p = points.select(F.col(point_id).alias("point"), "x", "y").filter("x is not null and y is not null")
    p = p.withColumns({"cx": G.cell(F.col("x"), 10 * radius), "cy": G.cell(F.col("y"), 10 * radius)})
    d = G.segment_distance(*map(F.col, ("x", "y", "x1", "y1", "x2", "y2")))
    hits = p.join(s, ["cx", "cy"]).withColumn("d", d).filter(F.col("d") <= radius)
    return hits.groupBy("point").agg(F.min(F.struct("d", "segment")).alias("m")).select("point", "m.segment", "m.d")


#: Halvings of the radius down to the finest cells in which targets are counted.
FINEST = 8


def k_nearest(points: DataFrame, targets: DataFrame, radius: float, k: int, point_id: str, target_id: str) -> DataFrame:
    """The k nearest targets within a radius, ties to the smallest id.

    Targets are counted in cells of the radius, its half, quarter and so on.  Of the five by five cells around a
    point, those whose far corners are nearest and which hold k targets bound the distance of its k-th; only
    cells within that bound are opened.  Where the radius holds fewer than k, the radius is the bound.
    """
    spark = points.sparkSession
    usable = lambda *cs: reduce(Column.__and__, [F.col(c).isNotNull() & (F.abs(c) < float("inf")) for c in cs])
    t = targets.select(F.col(target_id).alias("target"), "x", "y").filter(usable("x", "y"))
    p = points.select(F.col(point_id).alias("point"), F.col("x").alias("px"), F.col("y").alias("py")).filter(usable("px", "py"))
    sizes = [radius / 2**i for i in range(FINEST + 1)]
    at = lambda x, y: F.array(*[F.struct(F.lit(i).alias("level"), G.cell(F.col(x), s).alias("cx"), G.cell(F.col(y), s).alias("cy")) for i, s in enumerate(sizes)])
    size = lambda level: F.lit(float(radius)) / F.pow(F.lit(2.0), level)
    near = lambda v, c, s: F.greatest(c * s - v, v - (c + 1) * s, F.lit(0.0))
    far = lambda v, c, s: F.greatest(F.abs(c * s - v), F.abs((c + 1) * s - v))

    counts = t.select(F.explode(at("x", "y")).alias("c")).groupBy("c.level", "c.cx", "c.cy").agg(F.count("*").alias("n"))
    places = p.groupBy("point", "px", "py").agg(F.count("*").alias("copies"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)])
    asked = places.select("*", F.explode(at("px", "py")).alias("c")).select("point", "px", "py", "copies", "c.level", "c", F.explode(steps).alias("o"))
    asked = asked.select("point", "px", "py", "copies", "level", (F.col("c.cx") + F.col("o.i")).alias("cx"), (F.col("c.cy") + F.col("o.j")).alias("cy"))
    corner = F.hypot(far(F.col("px"), F.col("cx"), size(F.col("level"))), far(F.col("py"), F.col("cy"), size(F.col("level"))))
    # A table's size is estimated from its files, which are small beside the rows that explode makes of them: never broadcast those.
    held = asked.join(counts.hint("merge"), ["level", "cx", "cy"]).groupBy("point", "px", "py", "copies", "level").agg(F.sort_array(F.collect_list(F.struct(corner.alias("d"), "n"))).alias("cells"))
    # The first far corner by which k targets are counted; null where the cells hold fewer.
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d"))
    reached = F.aggregate("cells", state, lambda a, c: F.struct(
        (a["n"] + c["n"]).alias("n"), F.coalesce(a["d"], F.when(a["n"] + c["n"] >= k, c["d"])).alias("d")))["d"]
    bounds = held.select("point", "px", "py", "copies", reached.alias("d")).groupBy("point", "px", "py", "copies").agg(F.min("d").alias("d"))
    # Places without a target in any of these cells have none within the radius.  The bound is a little wider than the corners, whose cells are rounded.
    bound = F.least(F.coalesce(F.col("d") * (1 + 1e-6), F.lit(float(radius))), F.lit(float(radius)))
    level = F.least(F.greatest(F.floor(F.log2(F.lit(float(radius)) / F.col("bound"))) + 1, F.lit(0)), F.lit(FINEST)).cast("int")
    bounded = bounds.select("point", "px", "py", "copies", bound.alias("bound"))
    path = work_dir(spark, "nearest")
    bounded.withColumn("level", level).write.parquet(path)
    bounded = spark.read.parquet(path)
    levels = sorted(r[0] for r in bounded.select("level").distinct().collect())

    s, b = size(F.col("level")), F.col("bound")
    span = lambda v: F.sequence(F.floor((v - b * (1 + 1e-6)) / s), F.floor((v + b * (1 + 1e-6)) / s))
    cells = F.flatten(F.transform(span(F.col("px")), lambda i: F.transform(span(F.col("py")), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))
    open_ = bounded.withColumn("copy", F.explode(F.expr("sequence(1, cast(copies as int))"))).withColumn("c", F.explode(cells)).select("point", "px", "py", "bound", "level", "c.cx", "c.cy")
    open_ = open_.filter(F.hypot(near(F.col("px"), F.col("cx"), s), near(F.col("py"), F.col("cy"), s)) <= b * (1 + 1e-6))
    some = F.filter(at("x", "y"), lambda c: c["level"].isin(levels))
    kept = t.withColumn("c", F.explode(some)).select("target", "x", "y", "c.level", "c.cx", "c.cy")
    d = G.distance(F.col("px"), F.col("py"), F.col("x"), F.col("y"))
    found = open_.join(kept.hint("merge"), ["level", "cx", "cy"]).withColumn("d", d).filter(F.col("d") <= b).select("point", "target", "d")
    w = W.partitionBy("point").orderBy("d", "target")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def sample_line_points(lines: DataFrame, line_id: str = "USRN", spacing: float = 25.0) -> DataFrame:
    """(id, x, y): points along each part (``line``) at even distances, its middle if it is too short for one."""
    rows = lines.select(F.col(line_id).alias("id"), G.edges(F.col("line")).alias("e")).filter(F.size("e") > 0)
    size = F.transform("e", lambda s: G.distance(s["x1"], s["y1"], s["x2"], s["y2"]))
    rows = rows.withColumn("len", size).withColumn("total", F.aggregate("len", F.lit(0.0), lambda a, v: a + v))
    rows = rows.withColumn("n", F.greatest(F.bround(F.col("total") / spacing).cast("int"), F.lit(1)))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("at", (F.col("k") - 0.5) / F.col("n") * F.col("total"))
    part = F.explode(F.arrays_zip(F.col("e"), F.col("len"), F.transform("len", lambda v, i: F.aggregate(F.slice("len", F.lit(1), i), F.lit(0.0), lambda a, z: a + z)).alias("before")))
    rows = rows.select("id", "k", "at", F.monotonically_increasing_id().alias("row"), part.alias("p"))
    hit = rows.filter((F.col("at") >= F.col("p.before")) & (F.col("at") <= F.col("p.before") + F.col("p.len")))
    hit = hit.withColumn("t", F.coalesce(F.try_divide(F.col("at") - F.col("p.before"), F.col("p.len")), F.lit(0.0)))
    x = F.col("p.e.x1") + F.col("t") * (F.col("p.e.x2") - F.col("p.e.x1"))
    y = F.col("p.e.y1") + F.col("t") * (F.col("p.e.y2") - F.col("p.e.y1"))
    return hit.select("id", x.alias("x"), y.alias("y")).distinct()


def name_usrns(streets: DataFrame, roads: DataFrame, exclude: DataFrame | None = None, cutoff: float = 15.0) -> DataFrame:
    """(USRN, street): the name of the nearest road to a street's middle (x, y), within the cutoff.

    ``roads`` has name and x1, y1, x2, y2, one row per segment.
    """
    if exclude is not None:
        streets = streets.join(exclude.select("USRN"), "USRN", "left_anti")
    hits = nearest_segment(streets, roads.filter("name is not null"), cutoff, "USRN", "name")
    from ..functions.keys import normalise_name

    return hits.select(F.col("point").alias("USRN"), normalise_name("segment").alias("street")).filter("street is not null")


def link_oml(lines: DataFrame, roads: DataFrame, cutoff: float = 15.0, spacing: float = 25.0) -> DataFrame:
    """What the nearest road along a street says, by vote of points on it: name, class, road number.

    ``roads``: id, classification, distinctive_name, road_number and segments.  The name's share is of
    the points with a name, the class's of all points that found a road.
    """
    from ..functions.keys import normalise_name

    probes = sample_line_points(lines, "USRN", spacing).withColumn("probe", F.struct("id", "x", "y"))
    hits = nearest_segment(probes, roads, cutoff, "probe", "id").select(F.col("point.id").alias("USRN"), F.col("segment").alias("id"))
    facts = roads.select("id", "classification", normalise_name("distinctive_name").alias("street"), "road_number").dropDuplicates(["id"])
    votes = hits.join(facts, "id")
    name = majority(votes, ["USRN"], "street", "street_n", "named").withColumn("street_agreement", F.col("street_n") / F.col("named"))
    kind = majority(votes, ["USRN"], "classification", "c").join(votes.groupBy("USRN").agg(F.count("*").alias("all")), "USRN")
    kind = kind.select("USRN", F.col("classification").alias("oml_classification"), (F.col("c") / F.col("all")).alias("oml_class_agreement"))
    inner = votes.join(kind.select("USRN", F.col("oml_classification").alias("classification")), ["USRN", "classification"])
    number = majority(inner, ["USRN"], "road_number", "rn").select("USRN", F.col("road_number").alias("oml_road_number"))
    return kind.join(name.drop("named"), "USRN", "left").join(number, "USRN", "left")


def uprn_parcels(uprns: DataFrame, parcels: DataFrame) -> DataFrame:
    """(UPRN, INSPIREID, n_uprn, single_uprn_parcel) for properties in parcels."""
    hits = points_in_polygons(uprns, parcels, "UPRN", "INSPIREID").select(F.col("point").alias("UPRN"), F.col("polygon").alias("INSPIREID"))
    counts = hits.groupBy("INSPIREID").agg(F.count("*").alias("n_uprn"))
    return hits.join(counts, "INSPIREID").withColumn("single_uprn_parcel", F.col("n_uprn") == 1).select("UPRN", "INSPIREID", "n_uprn", "single_uprn_parcel")


def infill_osm(candidates: DataFrame, buildings: DataFrame) -> DataFrame:
    """Candidates in exactly one addressed building, with its address columns (osm_*)."""
    numbered = buildings.filter("osm_housenumber is not null")
    hits = points_in_polygons(candidates, numbered, "UPRN", "osm_id").select(F.col("point").alias("UPRN"), F.col("polygon").alias("osm_id"))
    return once_only(hits, ["UPRN"]).join(numbered.drop("edges"), "osm_id")


def usrn_districts(streets: DataFrame, authorities: DataFrame) -> DataFrame:
    """The authority that holds a street's middle; the first name if several do."""
    hits = points_in_polygons(streets, authorities, "USRN", "name", 5000.0)
    return hits.groupBy(F.col("point").alias("USRN")).agg(F.min("polygon").alias("district"))


def substation_uprns(nodes: DataFrame, compounds: DataFrame, uprns: DataFrame, radius: float = 20.0) -> DataFrame:
    """(UPRN, osm_id): properties in one compound, else the only one near a node and near no other."""
    inside = points_in_polygons(uprns, compounds, "UPRN", "osm_id").select(F.col("point").alias("UPRN"), F.col("polygon").alias("osm_id"))
    inside = once_only(inside, ["UPRN"])
    left = nodes.join(inside.select("osm_id").distinct(), "osm_id", "left_anti")
    near = within(left, uprns, radius, "osm_id", "UPRN").select(F.col("point").alias("osm_id"), F.col("target").alias("UPRN"))
    near = once_only(once_only(near, ["osm_id"]), ["UPRN"]).select("UPRN", "osm_id")
    return inside.unionByName(near)


def postcode_points(vintages: DataFrame) -> DataFrame:
    """The newest of the points (postcode, year, x, y) of each postcode."""
    rows = vintages.filter("postcode is not null")
    return first_per_key(rows, ["postcode"], F.col("year").desc(), F.col("x"), F.col("y")).withColumnRenamed("year", "last_seen_year")


def newest_medoid(points: DataFrame, key: str = "key") -> DataFrame:
    """Of the points (key, USRN, year, x, y) of the newest year, the one nearest their mean, and how many streets they are on."""
    newest = points.groupBy(key).agg(F.max("year").alias("year"))
    rows = points.join(newest, [key, "year"])
    mean = rows.groupBy(key).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.countDistinct("USRN").alias("n_usrn"))
    joined = rows.join(mean, key)
    d = F.bround((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")) + (F.col("y") - F.col("my")) * (F.col("y") - F.col("my")), 6)
    best = joined.groupBy(key).agg(F.min(F.struct(d.alias("d"), F.col("x"), F.col("y"))).alias("b"), F.max("n_usrn").alias("n_usrn"), F.max("year").alias("last_seen_year"))
    return best.select(key, "b.x", "b.y", "n_usrn", "last_seen_year")


def _clipped(x1: float, y1: float, x2: float, y2: float, ring: list[tuple[float, float, float, float]]) -> list[tuple[float, float]]:
    """The parts (t0, t1) of a segment inside a polygon's edges."""
    cuts = {0.0, 1.0}
    dx, dy = x2 - x1, y2 - y1
    for ax, ay, bx, by in ring:
        ex, ey = bx - ax, by - ay
        det = dx * ey - dy * ex
        if det:
            t = ((ax - x1) * ey - (ay - y1) * ex) / det
            u = ((ax - x1) * dy - (ay - y1) * dx) / det
            if 0 < t < 1 and 0 <= u <= 1:
                cuts.add(t)
    at = sorted(cuts)
    out = []
    for a, b in zip(at, at[1:]):
        x, y = x1 + (a + b) / 2 * dx, y1 + (a + b) / 2 * dy
        odd = sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ax, ay, bx, by in ring) % 2
        if odd:
            out.append((a, b))
    return out


def streets_in_postcodes(segments: DataFrame, polygons: DataFrame, size: float = 500.0) -> DataFrame:
    """Where named streets run through postcode polygons: one point on the street per key, in the newest year.

    ``segments``: USRN, street, x1, y1, x2, y2.  ``polygons``: postcode, year, edges.  Key is
    postcode|street.  Segments and polygons that share a cell are clipped in Arrow batches, the middle
    of the longest part stands for a street in a polygon, and the medoid for all streets of a key.
    """
    # A segment and a polygon are paired in one cell only, the first that both have.
    seg = segments.withColumn("s", F.monotonically_increasing_id())
    s = seg.withColumn("c", _box(F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2"), size)).select("*", "c.cx", "c.cy").drop("c")
    low = lambda a, b: F.array_min(F.transform("edges", lambda e: F.least(e[a], e[b])))
    high = lambda a, b: F.array_max(F.transform("edges", lambda e: F.greatest(e[a], e[b])))
    p = polygons.withColumn("c", _box(low("x1", "x2"), low("y1", "y2"), high("x1", "x2"), high("y1", "y2"), size)).select("*", "c.cx", "c.cy").drop("c")
    p = p.withColumns({"px": F.min("cx").over(W.partitionBy("postcode", "year")), "py": F.min("cy").over(W.partitionBy("postcode", "year"))})
    first = (F.col("cx") == F.greatest(F.col("px"), G.cell(F.least("x1", "x2"), size))) & (F.col("cy") == F.greatest(F.col("py"), G.cell(F.least("y1", "y2"), size)))
    pairs = s.join(p, ["cx", "cy"]).filter(first).select("USRN", "street", "x1", "y1", "x2", "y2", "postcode", "year", "edges")

    def clip(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                ring = [(e["x1"], e["y1"], e["x2"], e["y2"]) for e in r.edges]
                parts = _clipped(r.x1, r.y1, r.x2, r.y2, ring)
                if parts:
                    a, b = max(parts, key=lambda q: q[1] - q[0])
                    m = (a + b) / 2
                    size_ = (b - a) * ((r.x2 - r.x1) ** 2 + (r.y2 - r.y1) ** 2) ** 0.5
                    out.append((f"{r.postcode}|{r.street}", r.USRN, r.year, size_, r.x1 + m * (r.x2 - r.x1), r.y1 + m * (r.y2 - r.y1)))
            yield pd.DataFrame(out, columns=["key", "USRN", "year", "len", "x", "y"])

    found = pairs.mapInPandas(clip, "key string, USRN long, year int, len double, x double, y double")
    longest = found.groupBy("key", "USRN", "year").agg(F.max(F.struct("len", "x", "y")).alias("m")).select("key", "USRN", "year", "m.x", "m.y")
    return newest_medoid(longest)


def merge_grid_parcels(parcels: DataFrame, step: float = 500.0) -> DataFrame:
    """Parcels that a survey grid has cut apart, put together again; per authority (``la``).

    ``parcels``: la, id, edges (one ring).  Pieces whose edges coincide on a grid line are one parcel: the
    common edges cancel.  Whole grid squares stay as they are.  Rows: la, id (the smallest of a parcel), n
    (pieces), edges, area.  An authority is one record group, as it is published.
    """

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        rings = {r.id: [(e["x1"], e["y1"], e["x2"], e["y2"]) for e in r.edges] for r in frame.itertuples(index=False)}
        root = {i: i for i in rings}

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def surface(ring):
            return abs(sum(a * d - c * b for a, b, c, d in ring)) / 2

        squares = {i for i, r in rings.items() if surface(r) == step * step and len(r) == 4}
        on_line = {}
        for i, ring in rings.items():
            if i in squares:
                continue
            for a, b, c, d in ring:
                if (a == c and a % step == 0) or (b == d and b % step == 0):
                    on_line.setdefault(tuple(sorted(((a, b), (c, d)))), []).append(i)
        for ids in on_line.values():
            if len(ids) == 2:  # exactly two neighbours
                x, y = find(ids[0]), find(ids[1])
                root[max(x, y)] = min(x, y)
        out = {}
        for i in rings:
            out.setdefault(find(i), []).append(i)
        rows = []
        for i, members in out.items():
            seen = {}
            for m in members:
                for a, b, c, d in rings[m]:
                    seen.setdefault(tuple(sorted(((a, b), (c, d)))), []).append((a, b, c, d))
            edges = [e for es in seen.values() if len(es) == 1 for e in es]
            rows.append((frame["la"].iloc[0], i, len(members), [dict(zip(("x1", "y1", "x2", "y2"), e)) for e in edges],
                         sum(surface(rings[m]) for m in members)))
        return pd.DataFrame(rows, columns=["la", "id", "n", "edges", "area"])

    schema = "la string, id long, n int, edges array<struct<x1:double,y1:double,x2:double,y2:double>>, area double"
    return parcels.select("la", "id", "edges").groupBy("la").applyInPandas(merge, schema)


def _hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The corners of the points' convex hull (monotone chain)."""
    points = sorted(set(points))
    if len(points) < 3:
        return points
    out: list[tuple[float, float]] = []
    for way in (points, points[::-1]):
        chain: list[tuple[float, float]] = []
        for p in way:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) <= (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]):
                chain.pop()
            chain.append(p)
        out += chain[:-1]
    return out


def diameters(rows: DataFrame, keys: list[str], parts: int = 64) -> DataFrame:
    """(keys, d): the greatest distance between two points (x, y) of a key.

    It lies between two corners of the convex hull, and the corners of a whole are corners of its parts: each
    key's points are dealt into parts, hulls of parts are merged, and only hull corners are compared.
    """
    kept = rows.select(*keys, F.col("x").cast("double"), F.col("y").cast("double")).filter("x is not null and y is not null")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keys).schema)

    def corners(frame: pd.DataFrame) -> pd.DataFrame:
        found = _hull(list(zip(frame["x"], frame["y"])))
        return pd.DataFrame({**{k: [frame[k].iloc[0]] * len(found) for k in keys}, "x": [p[0] for p in found], "y": [p[1] for p in found]})

    def widest(frame: pd.DataFrame) -> pd.DataFrame:
        found = _hull(list(zip(frame["x"], frame["y"])))
        d = max((((a - c) ** 2 + (b - e) ** 2) ** 0.5 for i, (a, b) in enumerate(found) for c, e in found[:i]), default=0.0)
        return pd.DataFrame({**{k: [frame[k].iloc[0]] for k in keys}, "d": [d]})

    dealt = kept.withColumn("part", F.pmod(F.xxhash64("x", "y"), F.lit(parts)))
    some = dealt.groupBy(*keys, "part").applyInPandas(corners, f"{schema}, x double, y double")
    return some.groupBy(*keys).applyInPandas(widest, f"{schema}, d double")


def centroids(streets: DataFrame, *keys: str, most: float | None = None) -> DataFrame:
    """Mean of street middles (x, y) and their number per key; with ``most``, only where they lie less than that apart.

    The diagonal of the box around them settles most keys; the others are settled by their exact
    greatest distance.
    """
    rows = streets.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    out = rows.groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n_usrn"))
    if most is None:
        return out
    spans = rows.groupBy(*keys).agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    diagonal = F.sqrt(F.col("w") * F.col("w") + F.col("h") * F.col("h"))
    narrow = spans.filter(diagonal < most).select(*keys)
    unsure = spans.filter((diagonal >= most) & (F.col("w") < most) & (F.col("h") < most)).select(*keys)
    far = diameters(rows.join(unsure, list(keys), "left_semi"), list(keys))
    good = narrow.unionByName(far.filter(F.col("d") < most).select(*keys))
    return out.join(good, list(keys), "left_semi")
