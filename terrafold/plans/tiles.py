"""Queries that explode features to tiles, filter, clip, encode and pack them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalar as S
from ..operators import classify as C
from ..operators import codec, labels, style, tiling
from ..sources.fixtures import table, with_sql
from . import features as features_plans
from .registry import Registry, longs, sql_x, sql_y

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle


# -- tile assignment -----------------------------------------------------------


def way_boxes(spark, sf_dir):
    """Ways with bounding box, layer, kind and least zoom."""
    p = features_plans.points(spark, sf_dir)
    box = p.groupBy("way_id").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"), F.count("*").alias("n")).filter("n >= 2")
    w = features_plans.ways(spark, sf_dir).withColumn("layer", C.layer()).filter("layer <> ''")
    w = w.select("way_id", "layer", C.highway_type().alias("highway_type"), F.coalesce(C.t("ref"), F.lit("")).alias("ref"), (F.col("way_id") % 8 + 6).alias("min_zoom"))
    return w.join(box, "way_id")


_WAY_LAYER = "CASE WHEN waterway IS NOT NULL THEN 'water' WHEN highway IS NOT NULL OR railway IS NOT NULL THEN 'roads' WHEN bridge IS NOT NULL OR tunnel IS NOT NULL OR aeroway IS NOT NULL OR coalesce(man_made = 'pier', FALSE) THEN 'infrastructure' WHEN \"natural\" IS NOT NULL THEN 'terrain' ELSE '' END"
_BOXES = f""", boxes AS (SELECT w.way_id, {_WAY_LAYER} AS layer, coalesce(highway, railway, aeroway, '') AS highway_type, coalesce(ref, '') AS ref, w.way_id % 8 + 6 AS min_zoom, west, south, east, north FROM fx_ways w
  JOIN (SELECT x.way_id, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM fx_way_nodes x JOIN fx_nodes n ON n.node_id = x.node_id GROUP BY x.way_id HAVING count(*) >= 2) b ON b.way_id = w.way_id WHERE {_WAY_LAYER} <> '')"""
_WAYS = with_sql("fx_ways", "fx_way_nodes", "fx_nodes") + _BOXES


def _tiles_sql(zooms: str, source: str = "boxes") -> str:
    return f"""(SELECT *, unnest(generate_series(CAST(floor({sql_y('north', 'z')}) AS BIGINT), CAST(floor({sql_y('south', 'z')}) AS BIGINT))) AS y FROM
      (SELECT *, unnest(generate_series(CAST(floor({sql_x('west', 'z')}) AS BIGINT), CAST(floor({sql_x('east', 'z')}) AS BIGINT))) AS x FROM (SELECT *, {zooms} AS z FROM {source})))"""


@query(_WAYS + f"SELECT CAST(12 AS BIGINT) AS z, x, y, layer, count(*) AS features FROM {_tiles_sql('CAST(12 AS BIGINT)')} GROUP BY x, y, layer")
def features_per_tile(spark, sf_dir):
    d = tiling.explode_tiles(way_boxes(spark, sf_dir).withColumn("z", F.lit(12).cast("long")))
    return d.groupBy("z", "x", "y", "layer").agg(F.count("*").alias("features"))


@query(_WAYS + "SELECT z, highway_type, count(*) AS features FROM (SELECT *, unnest(generate_series(greatest(min_zoom, 6), 14)) AS z FROM boxes) WHERE NOT (z = 9 AND highway_type = 'secondary' AND ref = '') GROUP BY 1, 2")
def feature_zoom_explode(spark, sf_dir):
    d = tiling.explode_zooms(way_boxes(spark, sf_dir), 6, 14)
    return longs(d.groupBy("z", "highway_type").agg(F.count("*").alias("features")))


@query(_WAYS + f"SELECT way_id, x, y FROM {_tiles_sql('CAST(11 AS BIGINT)')}")
def feature_tile_explode(spark, sf_dir):
    return tiling.explode_tiles(way_boxes(spark, sf_dir).withColumn("z", F.lit(11).cast("long"))).select("way_id", "x", "y")


_LABELS = "labels AS (SELECT n.node_id, n.lon, n.lat FROM fx_nodes n JOIN fx_node_tags t ON t.node_id = n.node_id WHERE t.place IS NOT NULL)"


def _label_points(spark, sf_dir):
    named = table(spark, sf_dir, "fx_node_tags").filter("place IS NOT NULL").select("node_id")
    return table(spark, sf_dir, "fx_nodes").join(named, "node_id", "left_semi")


@query(
    with_sql("fx_ways", "fx_way_nodes", "fx_nodes", "fx_node_tags")
    + _BOXES
    + f""", {_LABELS} SELECT DISTINCT x, y FROM (SELECT x, y FROM {_tiles_sql('CAST(12 AS BIGINT)')} UNION ALL
    SELECT CAST(floor({sql_x('lon', '12')}) AS BIGINT) + dx, CAST(floor({sql_y('lat', '12')}) AS BIGINT) + dy FROM labels, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy))"""
)
def tile_union_distinct(spark, sf_dir):
    a = tiling.explode_tiles(way_boxes(spark, sf_dir).withColumn("z", F.lit(12).cast("long"))).select("x", "y")
    b = tiling.label_tiles(_label_points(spark, sf_dir).withColumn("z", F.lit(12))).select("x", "y")
    return a.unionByName(b).distinct()


@query(
    with_sql("fx_ways", "fx_way_nodes", "fx_nodes", "fx_node_tags")
    + _BOXES
    + f""" SELECT s.node_id, s.x, s.y FROM (SELECT n.node_id, CAST(floor({sql_x('lon', '13')}) AS BIGINT) AS x, CAST(floor({sql_y('lat', '13')}) AS BIGINT) AS y FROM fx_nodes n JOIN fx_node_tags t ON t.node_id = n.node_id WHERE t."natural" IS NOT NULL) s
    WHERE EXISTS (SELECT 1 FROM {_tiles_sql('CAST(13 AS BIGINT)')} b WHERE b.x = s.x AND b.y = s.y)"""
)
def tiles_semi_points(spark, sf_dir):
    n = table(spark, sf_dir, "fx_nodes").join(table(spark, sf_dir, "fx_node_tags").filter("`natural` IS NOT NULL").select("node_id"), "node_id", "left_semi")
    n = n.select("node_id", F.floor(S.lon_to_x("lon", 13)).cast("long").alias("x"), F.floor(S.lat_to_y("lat", 13)).cast("long").alias("y"))
    boxes = way_boxes(spark, sf_dir).withColumn("z", F.lit(13).cast("long"))
    return n.join(tiling.explode_tiles(boxes).select("x", "y").distinct(), ["x", "y"], "left_semi").select("node_id", "x", "y")


# -- per-zoom looks ------------------------------------------------------------

_STEPS = ", ".join(f"('{k}', {z}, {w})" for k, s in tiling.LINE_WIDTHS.items() for z, w in s.items())
_M2P = "CAST(least(15, greatest(1, floor(m / (156543.0::DOUBLE * cos(45.0::DOUBLE * 3.141592653589793::DOUBLE / 180.0) / pow(2.0::DOUBLE, z)) * CASE WHEN z >= 13 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END + 0.5::DOUBLE))) AS BIGINT)"


@query(
    with_sql("fx_ways")
    + f""", steps(kind, zoom, width) AS (VALUES {_STEPS}), d AS (SELECT way_id, coalesce(highway, railway, aeroway, '') AS kind, CAST(way_id % 40 AS DOUBLE) / 2 AS m, unnest([6, 10, 13, 16, 17]) AS z FROM fx_ways)
    SELECT way_id, CAST(z AS BIGINT) AS z, CAST(coalesce((SELECT max_by(width, zoom) FROM steps s WHERE s.kind = d.kind AND s.zoom <= d.z), CASE WHEN d.kind NOT IN (SELECT kind FROM steps) AND m > 0 THEN {_M2P} END, 1) AS BIGINT) AS width FROM d"""
)
def line_width_asof(spark, sf_dir):
    d = features_plans.ways(spark, sf_dir).select("way_id", C.highway_type().alias("kind"), ((F.col("way_id") % 40).cast("double") / 2).alias("m")).withColumn("z", F.explode(F.array(*[F.lit(v).cast("long") for v in (6, 10, 13, 16, 17)])))
    return d.select("way_id", "z", tiling.line_width(F.col("kind"), F.col("z"), F.col("m")).alias("width"))


_COLORS = ", ".join(f"('{k}', {z}, {((int(c[1:3], 16) >> 3) << 11) + ((int(c[3:5], 16) >> 2) << 5) + (int(c[5:7], 16) >> 3)})" for (k, z), c in tiling.LINE_COLORS.items())


@query(
    with_sql("fx_ways")
    + f""", over(kind, zoom, color) AS (VALUES {_COLORS}), d AS (SELECT way_id, coalesce(highway, '') AS kind, way_id % 65536 AS base, unnest([10, 12, 13, 15, 16]) AS z, coalesce(bridge = 'yes', FALSE) AS b FROM fx_ways)
    SELECT way_id, CAST(d.z AS BIGINT) AS z, CAST(coalesce(o.color, base) AS BIGINT) AS color, CAST(CASE WHEN b AND d.z >= 14 THEN 133 ELSE 5 END AS BIGINT) AS line_byte, CAST(CASE WHEN way_id % 2 = 0 AND d.z >= 16 THEN 128 ELSE 0 END AS BIGINT) AS polygon_byte FROM d LEFT JOIN over o ON o.kind = d.kind AND o.zoom = d.z"""
)
def line_color_override(spark, sf_dir):
    d = features_plans.ways(spark, sf_dir).withColumn("z", F.explode(F.array(*[F.lit(v).cast("long") for v in (10, 12, 13, 15, 16)])))
    no = F.lit(False)
    return longs(d.select("way_id", "z", tiling.line_color(C.highway_type(), F.col("z"), F.col("way_id") % 65536).alias("color"), tiling.width_byte(F.lit(2), F.lit(5), C.is_bridge(), no, F.col("z")).alias("line_byte"), tiling.width_byte(F.lit(3), F.lit(5), no, F.col("way_id") % 2 == 0, F.col("z")).alias("polygon_byte")))


# -- area filters --------------------------------------------------------------


def rings(spark, sf_dir):
    """Areas with their shell and hole rings in degrees."""
    corner = lambda a, b, h: F.struct((F.col("cx") + F.col("half") * h * a).alias("lon"), (F.col("cy") + F.col("half") * h * b).alias("lat"))
    ring = lambda h: F.array(*[corner(a, b, h) for a, b in ((-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0))])
    d = features_plans.areas(spark, sf_dir).withColumn("layer", C.layer())
    return d.withColumn("shell", ring(1.0)).withColumn("hole", F.when(F.col("has_hole"), ring(0.5)))


_AREA = "(2.0::DOUBLE * half) * (2.0::DOUBLE * half)"
_LEAST = "(360.0::DOUBLE / (pow(2.0::DOUBLE, z - 1) * 256.0::DOUBLE)) * (360.0::DOUBLE / (pow(2.0::DOUBLE, z - 1) * 256.0::DOUBLE))"
_FACTOR = "CASE WHEN z >= 14 THEN 0.0::DOUBLE WHEN z <= 7 THEN 2.5::DOUBLE WHEN z = 8 THEN 1.8::DOUBLE WHEN z = 9 THEN 2.5::DOUBLE ELSE 3.0::DOUBLE END"


@query(with_sql("fx_areas") + f"SELECT CAST(z AS BIGINT) AS z, count(*) AS kept, round(sum({_AREA}), 6) AS area FROM (SELECT *, unnest(generate_series(6, 15)) AS z FROM fx_areas) WHERE {_AREA} >= {_LEAST} * {_FACTOR} GROUP BY z")
def polygon_area_filter(spark, sf_dir):
    d = rings(spark, sf_dir).withColumn("area", S.ring_area("shell")).withColumn("z", F.explode(F.sequence(F.lit(6), F.lit(15))))
    return longs(d.filter(F.col("area") >= S.min_area_deg2("z")).groupBy("z").agg(F.count("*").alias("kept"), F.round(F.sum("area"), 6).alias("area")))


def _px(f: str, tile: str) -> str:
    return f"least(4096, greatest(0, CAST(trunc(({f} - {tile}) * 4096.0::DOUBLE) AS BIGINT)))"


@query(
    with_sql("fx_areas")
    + f""", boxes AS (SELECT area_id, cx - half AS west, cx + half AS east, cy - half AS south, cy + half AS north FROM fx_areas)
    SELECT z, x, y, count(*) AS kept FROM (SELECT z, x, y, ({_px(sql_x('east', 'z'), 'x')} - {_px(sql_x('west', 'z'), 'x')}) * ({_px(sql_y('south', 'z'), 'y')} - {_px(sql_y('north', 'z'), 'y')}) / 256.0::DOUBLE AS area FROM {_tiles_sql('CAST(unnest([10, 12, 14]) AS BIGINT)')})
    WHERE area >= 2.0::DOUBLE * CASE z WHEN 10 THEN 8.0::DOUBLE WHEN 12 THEN 5.0::DOUBLE ELSE 0.5::DOUBLE END GROUP BY z, x, y"""
)
def post_projection_filter(spark, sf_dir):
    c = F.col
    d = rings(spark, sf_dir).select("area_id", (c("cx") - c("half")).alias("west"), (c("cx") + c("half")).alias("east"), (c("cy") - c("half")).alias("south"), (c("cy") + c("half")).alias("north"))
    d = tiling.explode_tiles(d.withColumn("z", F.explode(F.array(*[F.lit(v).cast("long") for v in (10, 12, 14)]))))
    clamp = lambda f, tile: F.least(F.lit(4096), F.greatest(F.lit(0), S.tile_px(f, tile)))
    wide = clamp(S.lon_to_x("east", F.col("z")), c("x")) - clamp(S.lon_to_x("west", F.col("z")), c("x"))
    high = clamp(S.lat_to_y("south", F.col("z")), c("y")) - clamp(S.lat_to_y("north", F.col("z")), c("y"))
    return d.filter(wide * high / 256.0 >= S.min_area_px(F.col("z"))).groupBy("z", "x", "y").agg(F.count("*").alias("kept"))


@query(
    with_sql("fx_areas")
    + """SELECT area_id, CAST(z AS BIGINT) AS z, CAST(1 + CASE WHEN has_hole AND half * half >= pow(360.0::DOUBLE / pow(2.0::DOUBLE, z) / 256.0::DOUBLE, 2) * 2.0::DOUBLE * CASE WHEN z >= 13 THEN 1.5::DOUBLE ELSE 10.0::DOUBLE END THEN 1 ELSE 0 END AS BIGINT) AS rings FROM (SELECT *, unnest([10, 12, 13, 15]) AS z FROM fx_areas)"""
)
def hole_filter(spark, sf_dir):
    d = rings(spark, sf_dir).withColumn("z", F.explode(F.array(*[F.lit(v).cast("long") for v in (10, 12, 13, 15)])))
    pixel = F.lit(360.0) / F.pow(F.lit(2.0), F.col("z")) / 256.0
    big = S.ring_area("hole") >= F.pow(pixel, 2) * 2.0 * F.when(F.col("z") >= 13, 1.5).otherwise(10.0)
    return d.select("area_id", "z", (F.lit(1) + F.when(F.coalesce(big, F.lit(False)), 1).otherwise(0)).cast("long").alias("rings"))


# -- symbols, lines, polygons --------------------------------------------------



@query(
    with_sql("fx_nodes", "fx_node_tags")
    + f"""SELECT node_id, x, y, CAST(trunc(({sql_x('lon', '14')} - x) * 4096.0::DOUBLE) AS BIGINT) AS top_px, CAST(trunc(({sql_y('lat + h * 0.667::DOUBLE', '14')} - y) * 4096.0::DOUBLE) AS BIGINT) AS top_py,
    CAST(trunc(({sql_x('lon - s', '14')} - x) * 4096.0::DOUBLE) AS BIGINT) AS left_px, CAST(trunc(({sql_y('lat - h * 0.333::DOUBLE', '14')} - y) * 4096.0::DOUBLE) AS BIGINT) AS left_py
    FROM (SELECT *, 360.0::DOUBLE / pow(2.0::DOUBLE, 14) / 256.0::DOUBLE * 3 AS s, 360.0::DOUBLE / pow(2.0::DOUBLE, 14) / 256.0::DOUBLE * 3 / cos(radians(lat)) * 0.866::DOUBLE AS h, CAST(floor({sql_x('lon', '14')}) AS BIGINT) AS x, CAST(floor({sql_y('lat', '14')}) AS BIGINT) AS y
      FROM fx_nodes WHERE node_id IN (SELECT node_id FROM fx_node_tags WHERE "natural" IS NOT NULL))"""
)
def point_symbol_triangle(spark, sf_dir):
    n = table(spark, sf_dir, "fx_nodes").join(table(spark, sf_dir, "fx_node_tags").filter("`natural` IS NOT NULL").select("node_id"), "node_id", "left_semi")
    n = n.withColumn("x", F.floor(S.lon_to_x("lon", 14)).cast("long")).withColumn("y", F.floor(S.lat_to_y("lat", 14)).cast("long"))
    n = n.withColumn("t", tiling.triangle(F.col("lon"), F.col("lat"), F.lit(14), F.col("x"), F.col("y")))
    return n.select("node_id", "x", "y", F.col("t")[0]["px"].alias("top_px"), F.col("t")[0]["py"].alias("top_py"), F.col("t")[1]["px"].alias("left_px"), F.col("t")[1]["py"].alias("left_py"))


_SEGS = f"""segs AS (SELECT way_id, pos, (x0 - floor(x0)) * 4096 AS ax, (y0 - floor(y0)) * 4096 AS ay, (x1 - floor(x0)) * 4096 AS bx, (y1 - floor(y0)) * 4096 AS by_ FROM (SELECT w.way_id, w.pos, {sql_x('a.lon', '13')} AS x0, {sql_y('a.lat', '13')} AS y0, {sql_x('b.lon', '13')} AS x1, {sql_y('b.lat', '13')} AS y1
   FROM fx_way_nodes w JOIN fx_nodes a ON a.node_id = w.node_id JOIN fx_way_nodes v ON v.way_id = w.way_id AND v.pos = w.pos + 1 JOIN fx_nodes b ON b.node_id = v.node_id))"""


def _axis(a: str, b: str) -> str:
    return f"CASE WHEN {b} = {a} THEN CASE WHEN {a} < -410 OR {a} > 4506 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END ELSE least((-410 - {a}) / nullif({b} - {a}, 0), (4506 - {a}) / nullif({b} - {a}, 0)) END, CASE WHEN {b} = {a} THEN 1.0::DOUBLE ELSE greatest((-410 - {a}) / nullif({b} - {a}, 0), (4506 - {a}) / nullif({b} - {a}, 0)) END"


def _clip_sql() -> str:
    n0, f0 = _axis("ax", "bx").rsplit(", CASE", 1)
    n1, f1 = _axis("ay", "by_").rsplit(", CASE", 1)
    return f"SELECT *, greatest(0.0::DOUBLE, {n0}, {n1}) AS t0, least(1.0::DOUBLE, CASE{f0}, CASE{f1}) AS t1 FROM segs"


@query(with_sql("fx_way_nodes", "fx_nodes") + f", {_SEGS} SELECT way_id, pos, round(t0, 6) AS t0, round(t1, 6) AS t1, CAST(floor(ax + (bx - ax) * t1) AS BIGINT) AS exit_px FROM ({_clip_sql()}) WHERE t0 <= t1")
def line_clip_box(spark, sf_dir):
    w, n = table(spark, sf_dir, "fx_way_nodes"), table(spark, sf_dir, "fx_nodes")
    p = w.join(n, "node_id").select("way_id", "pos", S.lon_to_x("lon", 13).alias("fx"), S.lat_to_y("lat", 13).alias("fy"))
    q = p.select("way_id", (F.col("pos") - 1).alias("pos"), F.col("fx").alias("gx"), F.col("fy").alias("gy"))
    d = p.join(q, ["way_id", "pos"])
    place = lambda v, base: (F.col(v) - F.floor(base)) * 4096.0
    d = d.select("way_id", "pos", place("fx", "fx").alias("ax"), place("fy", "fy").alias("ay"), place("gx", "fx").alias("bx"), place("gy", "fy").alias("by"))
    t0, t1 = tiling.clip_segment(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), -410.0, 4506.0)
    d = d.withColumn("t0", t0).withColumn("t1", t1).filter("t0 <= t1")
    return d.select("way_id", "pos", F.round("t0", 6).alias("t0"), F.round("t1", 6).alias("t1"), F.floor(F.col("ax") + (F.col("bx") - F.col("ax")) * F.col("t1")).cast("long").alias("exit_px"))


def tile_polygons(spark, sf_dir, zoom: int):
    """Areas clipped to the tiles they touch, simplified and quantised, with holes."""
    c = F.col
    d = rings(spark, sf_dir).filter(S.ring_area("shell") >= S.min_area_deg2(F.lit(zoom)))
    d = d.withColumn("z", F.lit(zoom).cast("long")).withColumn("west", c("cx") - c("half")).withColumn("east", c("cx") + c("half")).withColumn("south", c("cy") - c("half")).withColumn("north", c("cy") + c("half"))
    d = tiling.explode_tiles(d).withColumn("nibble", C.polygon_nibble(c("layer")).cast("int"))
    place = lambda r: F.transform(r, lambda p: F.struct(((S.lon_to_x(p["lon"], F.col("z")) - c("x")) * 4096.0).alias("px"), ((S.lat_to_y(p["lat"], F.col("z")) - c("y")) * 4096.0).alias("py")))
    all_rings = F.when(c("hole").isNull(), F.array(place("shell"))).otherwise(F.array(place("shell"), place("hole")))
    d = d.select(c("z").cast("int").alias("z"), "x", "y", "area_id", "layer", "nibble", all_rings.alias("rings"))

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                cut = [G.clip_ring([(p["px"], p["py"]) for p in ring], -410.0, -410.0, 4506.0, 4506.0) for ring in r.rings]
                cut = [G.simplify_ring(ring, 4.0 if zoom < 14 and r.nibble <= 3 else 2.0) for ring in cut if ring]
                if cut:
                    out.append((r.z, r.x, r.y, r.area_id, r.layer, r.nibble, [[{"px": int(a), "py": int(b)} for a, b in ring] for ring in cut]))
            if out:
                yield pd.DataFrame(out, columns=["z", "x", "y", "area_id", "layer", "nibble", "rings"])

    return d.mapInPandas(run, "z int, x long, y long, area_id long, layer string, nibble int, rings array<array<struct<px:int,py:int>>>")


@query()
def polygon_clip_simplify(spark, sf_dir):
    d = tile_polygons(spark, sf_dir, 13)
    return longs(d.select("z", "x", "y", "area_id", "layer", "nibble", F.size("rings").alias("rings"), F.aggregate("rings", F.lit(0), lambda s, r: s + F.size(r)).alias("points")))


def _dissolve(key, pdf: pd.DataFrame) -> pd.DataFrame:
    boxes = [(min(p["px"] for p in r[0]), min(p["py"] for p in r[0]), max(p["px"] for p in r[0]), max(p["py"] for p in r[0])) for r in pdf.rings]
    united = G.union_rectangles(boxes)
    return pd.DataFrame([{"z": key[0], "x": key[1], "y": key[2], "inputs": len(boxes), "outputs": len(united), "area": float(sum((b[2] - b[0]) * (b[3] - b[1]) for b in united))}])


@query()
def building_dissolve(spark, sf_dir):
    d = tile_polygons(spark, sf_dir, 14).filter("layer = 'buildings'")
    return d.groupBy("z", "x", "y").applyInPandas(_dissolve, "z long, x long, y long, inputs long, outputs long, area double").withColumn("merged", F.col("inputs") - F.col("outputs"))


@query()
def bridge_decks(spark, sf_dir):
    """Decks of bridges at zoom 16: flat-capped buffers of the road's half width."""
    w = features_plans.ways(spark, sf_dir).filter(C.is_bridge() & (C.has("highway") | C.has("railway"))).select("way_id", C.highway_type().alias("kind"))
    p = features_plans.points(spark, sf_dir).join(w, "way_id").withColumn("width", tiling.line_width(F.col("kind"), F.lit(16), F.lit(0.0)))
    from ..operators import assemble

    lines = assemble.way_geometry(p).join(w, "way_id").withColumn("width", tiling.line_width(F.col("kind"), F.lit(16), F.lit(0.0)).cast("double"))
    line = F.transform("line", lambda q: F.struct((S.lon_to_x(q["lon"], F.lit(16)) * 4096.0).alias("px"), (S.lat_to_y(q["lat"], F.lit(16)) * 4096.0).alias("py")))
    rail = F.when(F.col("kind").isin("rail", "narrow_gauge", "funicular", "tram", "light_rail"), 2.0).otherwise(1.0)
    lines = lines.select("way_id", line.alias("line"), ((F.col("width") * 0.4 + rail) * 16.0).alias("half"))

    def run(batches):
        for pdf in batches:
            out = [(r.way_id, float(r.half), len(deck), float(sum(G.ring_area(x[:-1]) for x in deck))) for r in pdf.itertuples() for deck in [G.buffer_line([(p["px"], p["py"]) for p in r.line], r.half)]]
            if out:
                yield pd.DataFrame(out, columns=["way_id", "half", "parts", "area"])

    return lines.mapInPandas(run, "way_id long, half double, parts long, area double")


# -- labels --------------------------------------------------------------------


def label_rows(spark, sf_dir):
    n = table(spark, sf_dir, "fx_node_tags").filter("place IS NOT NULL AND name <> ''").withColumn("population", S.population("population"))
    n = n.select("node_id", "name", "population", C.place_zoom(F.col("place"), F.col("population")).alias("min_zoom")).join(table(spark, sf_dir, "fx_nodes"), "node_id")
    n = n.withColumn("z", F.explode(F.expr("filter(array(8, 11, 14), v -> v >= min_zoom)")))
    return n.select("z", F.col("node_id").alias("feature_id"), F.lit(False).alias("is_road"), "population", F.octet_length("name").cast("long").alias("n_bytes"), F.array("lon").alias("lons"), F.array("lat").alias("lats"))


@query()
def label_placement(spark, sf_dir):
    return longs(labels.place_labels(label_rows(spark, sf_dir)))


@query(
    with_sql("fx_nodes", "fx_node_tags")
    + f", {_LABELS} SELECT node_id, CAST(floor({sql_x('lon', '12')}) AS BIGINT) + dx AS x, CAST(floor({sql_y('lat', '12')}) AS BIGINT) + dy AS y FROM labels, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)"
)
def label_tile_explode(spark, sf_dir):
    return tiling.label_tiles(_label_points(spark, sf_dir).withColumn("z", F.lit(12))).select("node_id", "x", "y")


# -- packs ---------------------------------------------------------------------

_SIZED = f"sized AS (SELECT z, x, y, CAST(6 + 10 * count(*) AS BIGINT) AS size FROM {_tiles_sql('CAST(unnest([10, 12]) AS BIGINT)')} GROUP BY z, x, y)"


def _sized(spark, sf_dir):
    d = way_boxes(spark, sf_dir).withColumn("z", F.explode(F.array(*[F.lit(v).cast("long") for v in (10, 12)])))
    return tiling.explode_tiles(d).groupBy("z", "x", "y").agg((F.lit(6) + F.count("*") * 10).alias("size"))


@query(_WAYS + f", {_SIZED} SELECT z, min(x) AS min_x, min(y) AS min_y, max(x) - min(x) + 1 AS wide, max(y) - min(y) + 1 AS high, count(*) AS tiles FROM sized GROUP BY z")
def pack_bbox(spark, sf_dir):
    return tiling.pack_bounds(_sized(spark, sf_dir))


@query(_WAYS + f", {_SIZED} SELECT z, x, y, size, CAST(23 + (max(x) OVER w - min(x) OVER w + 1) * (max(y) OVER w - min(y) OVER w + 1) * 8 + 7 * 2 + coalesce(sum(size) OVER (PARTITION BY z ORDER BY y, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM sized WINDOW w AS (PARTITION BY z)")
def pack_index_offsets(spark, sf_dir):
    t = _sized(spark, sf_dir)
    return tiling.pack_offsets(t, t.select("z").distinct().withColumn("colors", F.lit(7)))


@query(_WAYS + ", c AS (SELECT DISTINCT z, (way_id * 7) % 50 AS color565 FROM (SELECT way_id, unnest([10, 12]) AS z FROM boxes)) SELECT CAST(z AS BIGINT) AS z, color565, row_number() OVER (PARTITION BY z ORDER BY color565) - 1 AS idx FROM c")
def palette_assign(spark, sf_dir):
    d = way_boxes(spark, sf_dir).select(((F.col("way_id") * 7) % 50).alias("color565"), F.explode(F.array(*[F.lit(v).cast("long") for v in (10, 12)])).alias("z"))
    return tiling.number_palette(d)


def encoded(spark, sf_dir, zoom: int = 13):
    """Ranked polygon features of a zoom with palette numbers."""
    d = tile_polygons(spark, sf_dir, zoom)
    tags = features_plans.areas(spark, sf_dir).select("area_id", "tags")
    looks = style.best_rule(tags, table(spark, sf_dir, "fx_rules"), "area_id")
    d = d.join(looks.select("area_id", "color565", "min_zoom"), "area_id").withColumn("ord", F.col("area_id"))
    palette = tiling.number_palette(d)
    d = tiling.order_in_tile(d).join(F.broadcast(palette.withColumn("z", F.col("z").cast("int"))), ["z", "color565"])
    d = d.select("z", "x", "y", "rank", F.lit(3).alias("geom_type"), F.col("idx").cast("int").alias("color_idx"), S.pack_zoom_priority("min_zoom", "nibble").cast("int").alias("zoom_priority"), tiling.width_byte(F.lit(3), F.lit(0), F.lit(False), F.col("layer") == "buildings", F.col("z")).cast("int").alias("width_byte"), "rings", F.lit(None).cast("string").alias("text"), "area_id", "color565")
    return d, palette


@query()
def tile_encode_hex(spark, sf_dir):
    tiles = codec.encode_tiles(encoded(spark, sf_dir)[0])
    return longs(tiles.select("z", "x", "y", "features", "size", F.md5("blob").alias("md5"), F.hex(F.substring("blob", 1, 6)).alias("head")))


@query()
def tile_decode_roundtrip(spark, sf_dir):
    """Every ring that went into a tile against what its blob decodes to."""
    d, palette = encoded(spark, sf_dir)
    back = codec.palette_colors(codec.decode_tiles(codec.encode_tiles(d)), palette)
    told = d.select("z", "x", "y", (F.col("rank") - 1).cast("int").alias("ord"), F.col("rings").alias("was"), F.col("color565").alias("was_color"))
    both = told.join(back, ["z", "x", "y", "ord"], "left")
    return longs(both.groupBy("z").agg(F.count("*").alias("features"), F.count_if((F.col("was") == F.col("rings")) & (F.col("was_color") == F.col("color565"))).alias("same")))


@query()
def tile_pack_files(spark, sf_dir):
    """Tile blobs packed into one file image a zoom, and its index read back."""
    from ..sources import packs

    d, palette = encoded(spark, sf_dir)
    made = packs.pack_tiles(codec.encode_tiles(d), palette)

    def run(batches):
        for pdf in batches:
            rows = []
            for z, data in zip(pdf["z"], map(bytes, pdf["pack"]), strict=True):
                head, index = packs.index_pack(data)
                rows += [(z, x, y, o, n, len(head["palette"]), data[o : o + 4] == b"NAV1") for x, y, o, n in index]
            yield pd.DataFrame(rows, columns=["z", "x", "y", "offset", "size", "colors", "magic"])

    return made.mapInPandas(run, "z long, x long, y long, offset long, size long, colors long, magic boolean")
