"""Queries over whole tiles: all records encoded together, packs looked up and summed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import assemble, classify as C, codec, labels, style, tiling, whole_tile
from ..session import cut
from ..sources.fixtures import table, with_sql
from . import features as features_plans
from . import tiles as tile_plans
from .registry import Registry, longs, sql_x, sql_y

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle
ZOOM = 12


def line_looks(spark, sf_dir):
    """Drawn ways: interesting, of a layer, not underground; their rule's zoom, color and priority."""
    w = features_plans.ways(spark, sf_dir).filter((C.layer() != "") & ~C.underground_line())
    looks = style.best_rule(w, table(spark, sf_dir, "fx_rules"), "way_id").filter("interesting").select("way_id", "min_zoom", "color565", "priority")
    return w.select("way_id", C.highway_type().alias("kind"), C.is_bridge().alias("is_bridge")).join(looks, "way_id")


def label_texts(spark, sf_dir):
    """Candidates and texts of place names and sampled road numbers."""
    n = table(spark, sf_dir, "fx_node_tags").filter("place IS NOT NULL AND name <> ''").withColumn("population", S.population("population"))
    n = n.join(table(spark, sf_dir, "fx_nodes"), "node_id")
    one = lambda c: F.array(F.col(c))
    places = n.select(F.col("node_id").alias("feature_id"), F.lit(False).alias("is_road"), "population", F.col("name").alias("text"), C.place_zoom(F.col("place"), F.col("population")).cast("int").alias("min_zoom"), C.place_priority(F.col("population")).cast("int").alias("priority"), F.lit(0).alias("color565"), C.place_font(F.col("place")).cast("int").alias("font"), F.lit(None).cast("array<int>").alias("shield"), one("lon").alias("lons"), one("lat").alias("lats"))
    w = features_plans.ways(spark, sf_dir).filter(C.road_label_wanted()).select("way_id", "seq", C.t("ref").alias("ref"))
    sampled = assemble.road_label_samples(w)
    lines = assemble.label_candidates(assemble.way_geometry(features_plans.points(spark, sf_dir)))
    roads = sampled.join(lines, "way_id").join(line_looks(spark, sf_dir).select("way_id", "color565", "priority"), "way_id")
    # Road ids lie behind those of places.
    roads = roads.select((F.col("way_id") + (1 << 40)).alias("feature_id"), F.lit(True).alias("is_road"), F.lit(0).alias("population"), F.col("ref").alias("text"), F.col("min_zoom").cast("int").alias("min_zoom"), F.least("priority", F.lit(15)).cast("int").alias("priority"), F.lit(0xFFFF).alias("color565"), F.lit(0).alias("font"), F.array(F.col("color565").cast("int"), F.lit(0)).alias("shield"), F.transform("candidates", lambda p: p["lon"]).alias("lons"), F.transform("candidates", lambda p: p["lat"]).alias("lats"))
    return places.unionByName(roads)


def whole_records(spark, sf_dir, zoom):
    """All records of a zoom's tiles."""
    points = features_plans.points(spark, sf_dir)
    looks = cut(line_looks(spark, sf_dir).filter(F.col("min_zoom") <= zoom))
    parts = cut(whole_tile.line_parts(points.join(looks.select("way_id"), "way_id", "left_semi"), zoom))
    lines = whole_tile.line_records(parts, looks, zoom)
    rules = table(spark, sf_dir, "fx_rules")
    area_looks = style.best_rule(features_plans.areas(spark, sf_dir).select("area_id", "tags"), rules, "area_id").filter(F.col("min_zoom") <= zoom).select("area_id", "min_zoom", "color565")
    polygons = whole_tile.polygon_records(tile_plans.tile_polygons(spark, sf_dir, zoom), area_looks)
    n = C.with_tags(table(spark, sf_dir, "fx_node_tags"), "natural").filter(C.one_of("natural", "peak", "volcano"))
    nodes = table(spark, sf_dir, "fx_nodes").join(style.best_rule(n, rules, "node_id").select("node_id", "min_zoom", "color565"), "node_id")
    drawn = cut(lines.unionByName(polygons).unionByName(whole_tile.deck_records(parts, looks, zoom)))
    texts = cut(label_texts(spark, sf_dir)).filter(F.col("min_zoom") <= zoom).withColumn("z", F.lit(zoom)).withColumn("n_bytes", F.octet_length("text").cast("long"))
    placed = labels.place_labels(texts)
    named = whole_tile.label_records(placed, texts.select("feature_id", "text", "min_zoom", "priority", "color565", "font", "shield"))
    return whole_tile.whole_tiles([drawn, cut(whole_tile.symbol_records(nodes, drawn, zoom)), cut(named)])


_P = with_sql("fx_way_nodes", "fx_nodes") + f""", pp AS (SELECT w.way_id, w.pos, {sql_x('n.lon', str(ZOOM))} AS fx, {sql_y('n.lat', str(ZOOM))} AS fy FROM fx_way_nodes w JOIN fx_nodes n ON n.node_id = w.node_id),
pl AS (SELECT *, lead(fx) OVER o AS gx, lead(fy) OVER o AS gy, min(fx) OVER v AS lox, max(fx) OVER v AS hix, min(fy) OVER v AS loy, max(fy) OVER v AS hiy FROM pp WINDOW v AS (PARTITION BY way_id), o AS (PARTITION BY way_id ORDER BY pos)),
px AS (SELECT *, unnest(generate_series(CAST(greatest(floor(least(fx, gx) - 0.10009765625::DOUBLE), floor(lox)) AS BIGINT), CAST(least(floor(greatest(fx, gx) + 0.10009765625::DOUBLE), floor(hix)) AS BIGINT))) AS x FROM pl WHERE gx IS NOT NULL),
py AS (SELECT *, unnest(generate_series(CAST(greatest(floor(least(fy, gy) - 0.10009765625::DOUBLE), floor(loy)) AS BIGINT), CAST(least(floor(greatest(fy, gy) + 0.10009765625::DOUBLE), floor(hiy)) AS BIGINT))) AS y FROM px),
segs AS (SELECT way_id, pos, x, y, (fx - x) * 4096.0::DOUBLE AS ax, (fy - y) * 4096.0::DOUBLE AS ay, (gx - x) * 4096.0::DOUBLE AS bx, (gy - y) * 4096.0::DOUBLE AS by_ FROM py),
cut AS (SELECT * FROM ({tile_plans._clip_sql()}) WHERE t0 <= t1),
runs AS (SELECT *, CASE WHEN coalesce(lag(pos) OVER o = pos - 1 AND lag(t1) OVER o = 1 AND t0 = 0, FALSE) THEN 0 ELSE 1 END AS new FROM cut WINDOW o AS (PARTITION BY way_id, x, y ORDER BY pos))"""


@query(f"{_P} SELECT way_id, x, y, CAST(sum(new) AS BIGINT) AS parts, count(*) AS segments FROM runs GROUP BY 1, 2, 3")
def tile_line_parts(spark, sf_dir):
    d = whole_tile.line_parts(features_plans.points(spark, sf_dir), ZOOM)
    return longs(d.groupBy("way_id", "x", "y").agg(F.count("*").alias("parts"), F.sum("segments").alias("segments")))


@query()
def tile_whole(spark, sf_dir):
    """Whole tiles of a zoom, encoded."""
    made = codec.encode_tiles(whole_tile.rank_records(cut(whole_records(spark, sf_dir, ZOOM)))[0])
    return longs(made.select("z", "x", "y", "features", "size", F.md5("blob").alias("md5")))


@query()
def tile_whole_decoded(spark, sf_dir):
    """Records of whole tiles by kind, and how many of them decode to what was written."""
    records, palette = whole_tile.rank_records(cut(whole_records(spark, sf_dir, ZOOM)))
    back = codec.palette_colors(codec.decode_tiles(codec.encode_tiles(records)), palette)
    told = records.select("z", "x", "y", "kind", (F.col("rank") - 1).cast("int").alias("ord"), *[F.col(c).alias(f"was_{c}") for c in ("geom_type", "rings", "text", "color565", "zoom_priority", "shield")])
    both = told.join(back, ["z", "x", "y", "ord"], "left")
    same = (F.col("was_geom_type") == F.col("geom_type")) & (F.col("was_rings") == F.col("rings")) & F.col("was_text").eqNullSafe(F.col("text")) & (F.col("was_color565") == F.col("color565")) & (F.col("was_zoom_priority") == F.col("zoom_priority")) & F.col("was_shield").eqNullSafe(F.col("shield"))
    return longs(both.groupBy("kind").agg(F.count("*").alias("records"), F.count_if(same).alias("same")))


@query()
def deck_tiles(spark, sf_dir):
    """Line and deck records of bridges at the first zoom that draws decks, by tile."""
    zoom = whole_tile.DECK_ZOOM
    looks = cut(line_looks(spark, sf_dir).filter(F.col("is_bridge")))
    parts = cut(whole_tile.line_parts(features_plans.points(spark, sf_dir).join(looks.select("way_id"), "way_id", "left_semi"), zoom))
    d = whole_tile.line_records(parts, looks, zoom).unionByName(whole_tile.deck_records(parts, looks, zoom))
    return longs(d.groupBy("x", "y").agg(F.count_if(F.col("kind") == "line").alias("lines"), F.count_if(F.col("kind") == "deck").alias("decks")))


_NIBBLES = with_sql("fx_ways", "fx_rules") + """, t AS (SELECT way_id, unnest(['highway', 'railway', 'waterway', 'aeroway', 'natural', 'man_made', 'bridge', 'tunnel', 'layer']) AS k, unnest([highway, railway, waterway, aeroway, "natural", man_made, bridge, tunnel, layer]) AS v FROM fx_ways),
m AS (SELECT t.way_id, r.priority, r.zoom, r."value" IS NULL AS generic, list_position(['highway', 'railway', 'aeroway', 'aerialway', 'waterway', 'water', 'natural', 'landuse', 'building', 'amenity', 'leisure', 'man_made', 'boundary', 'admin_level', 'place', 'bridge', 'tunnel', 'surface', 'layer'], t.k) AS rank FROM t JOIN fx_rules r ON r."key" = t.k AND (r."value" IS NULL OR r."value" = t.v) WHERE t.v IS NOT NULL)"""


@query(f"{_NIBBLES} SELECT way_id, CAST(arg_min(least(priority, 15), (generic, rank)) AS BIGINT) AS nibble, CAST(arg_min(zoom, (generic, rank)) AS BIGINT) AS min_zoom FROM m GROUP BY way_id")
def line_nibbles(spark, sf_dir):
    """The draw order of lines: their rule's priority."""
    looks = style.best_rule(features_plans.ways(spark, sf_dir), table(spark, sf_dir, "fx_rules"), "way_id").filter("interesting")
    return longs(looks.select("way_id", F.least("priority", F.lit(15)).alias("nibble"), "min_zoom"))


# -- packs: lookups and totals ----------------------------------------------------

_OFFSETS = with_sql("fx_ways", "fx_way_nodes", "fx_nodes", "fx_viewports") + tile_plans._BOXES + ", " + tile_plans._SIZED + """, placed AS (SELECT z, x, y, size, CAST(23 + (max(x) OVER w - min(x) OVER w + 1) * (max(y) OVER w - min(y) OVER w + 1) * 8 + 7 * 2 + coalesce(sum(size) OVER (PARTITION BY z ORDER BY y, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM sized WINDOW w AS (PARTITION BY z))"""


def _placed(spark, sf_dir):
    t = tile_plans._sized(spark, sf_dir)
    return tiling.pack_offsets(t, t.select("z").distinct().withColumn("colors", F.lit(7)))


@query(
    _OFFSETS
    + f""" SELECT v.view_id, v.z, v.x, v.y, coalesce(p.place, 0) AS "offset", CAST(coalesce(p.size, 0) AS BIGINT) AS size FROM (SELECT view_id, CAST(10 + 2 * (view_id % 2) AS BIGINT) AS z, CAST(floor({sql_x('lon', '(10 + 2 * (view_id % 2))')}) AS BIGINT) AS x, CAST(floor({sql_y('lat', '(10 + 2 * (view_id % 2))')}) AS BIGINT) AS y FROM fx_viewports) v LEFT JOIN placed p USING (z, x, y)"""
)
def tile_lookup(spark, sf_dir):
    """Place and size of the tile at each view's centre; zeros where the pack has none."""
    z = 10 + 2 * (F.col("view_id") % 2)
    v = table(spark, sf_dir, "fx_viewports").select("view_id", z.cast("long").alias("z"), F.floor(S.lon_to_x("lon", z)).cast("long").alias("x"), F.floor(S.lat_to_y("lat", z)).cast("long").alias("y"))
    return longs(tiling.find_tiles(v, _placed(spark, sf_dir)))


@query(
    _OFFSETS
    + """ SELECT z, count(*) AS tiles, max(x) - min(x) + 1 AS wide, max(y) - min(y) + 1 AS high, CAST(7 AS BIGINT) AS colors, CAST(23 + (max(x) - min(x) + 1) * (max(y) - min(y) + 1) * 8 + 14 + sum(size) AS BIGINT) AS bytes, round((23 + (max(x) - min(x) + 1) * (max(y) - min(y) + 1) * 8 + 14 + sum(size)) / 1048576.0::DOUBLE, 6) AS mb FROM placed GROUP BY z"""
)
def pack_stats(spark, sf_dir):
    """Tiles, corners, palette and size of each zoom's pack."""
    t = tile_plans._sized(spark, sf_dir)
    return longs(tiling.pack_totals(t, t.select("z").distinct().withColumn("colors", F.lit(7))))
