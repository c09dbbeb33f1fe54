"""Viewport queries over the tiled features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import classify as C
from ..operators import style, tiling, view
from ..sources.fixtures import STYLE_RULES, table, with_sql
from . import features as features_plans
from . import tiles
from .registry import Registry, longs, sql_x, sql_y

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle

_VTILES = f"""vtiles AS (SELECT view_id, CAST(zoom AS BIGINT) AS z, x, y FROM (SELECT *, unnest(generate_series(CAST(floor({sql_y('lat', 'zoom')} - 1.5::DOUBLE) AS BIGINT), CAST(floor({sql_y('lat', 'zoom')} + 1.5::DOUBLE) AS BIGINT))) AS y
  FROM (SELECT *, unnest(generate_series(CAST(floor({sql_x('lon', 'zoom')} - 1.5::DOUBLE) AS BIGINT), CAST(floor({sql_x('lon', 'zoom')} + 1.5::DOUBLE) AS BIGINT))) AS x FROM fx_viewports)))"""
_POINTS = """pf AS (SELECT n.node_id, n.lon, n.lat, CAST(1 + n.node_id % 4 AS BIGINT) AS geom_type, CAST(n.node_id % 16 AS BIGINT) AS priority, CAST(6 + n.node_id % 9 AS BIGINT) AS min_zoom, (n.node_id * 7) % 11 AS pick, n.node_id % 3 = 0 AS casing FROM fx_nodes n)"""
_PALETTE = [S_ for S_ in dict.fromkeys(r[2] for r in STYLE_RULES) if S_.startswith("#")][:11]
_C565 = [((int(c[1:3], 16) >> 3) << 11) + ((int(c[3:5], 16) >> 2) << 5) + (int(c[5:7], 16) >> 3) for c in _PALETTE]
_HEX565 = [f"#{(v >> 11 & 31) << 3:02x}{(v >> 5 & 63) << 2:02x}{(v & 31) << 3:02x}" for v in _C565]


def point_features(spark, sf_dir):
    """Nodes as drawn features with type, color, priority and least zoom."""
    n, k = table(spark, sf_dir, "fx_nodes"), F.col("node_id")
    color = F.element_at(F.array(*[F.lit(v) for v in _C565]), ((k * 7) % 11 + 1).cast("int"))
    return n.select("node_id", "lon", "lat", (k % 4 + 1).alias("geom_type"), (k % 16).alias("priority"), (k % 9 + 6).alias("min_zoom"), color.cast("long").alias("color565"), (k % 3 == 0).alias("casing"))


def _tiled(spark, sf_dir):
    d = point_features(spark, sf_dir).withColumn("z", F.explode(F.sequence(F.lit(10), F.lit(15)).cast("array<bigint>")))
    return d.withColumn("x", F.floor(S.lon_to_x("lon", F.col("z"))).cast("long")).withColumn("y", F.floor(S.lat_to_y("lat", F.col("z"))).cast("long"))


@query(with_sql("fx_viewports") + f", {_VTILES} SELECT view_id, z, x, y FROM vtiles")
def viewport_tiles(spark, sf_dir):
    return longs(view.viewport_tiles(table(spark, sf_dir, "fx_viewports")))


@query(
    with_sql("fx_viewports")
    + f"""SELECT view_id, round((x - 1.5::DOUBLE) / pow(2.0::DOUBLE, zoom) * 360 - 180, 6) AS west, round((x + 1.5::DOUBLE) / pow(2.0::DOUBLE, zoom) * 360 - 180, 6) AS east,
    round(degrees(atan(sinh(3.141592653589793::DOUBLE * (1 - 2.0::DOUBLE * (y - 1.5::DOUBLE) / pow(2.0::DOUBLE, zoom))))), 6) AS north FROM (SELECT *, {sql_x('lon', 'zoom')} AS x, {sql_y('lat', 'zoom')} AS y FROM fx_viewports)"""
)
def viewport_box(spark, sf_dir):
    return view.viewport_box(table(spark, sf_dir, "fx_viewports")).select("view_id", *[F.round(c, 6).alias(c) for c in ("west", "east", "north")])


_VFEATURES = f"""vf AS (SELECT v.view_id, v.z, v.x, v.y, f.* FROM vtiles v JOIN pf f ON v.x = CAST(floor({sql_x('f.lon', 'v.z')}) AS BIGINT) AND v.y = CAST(floor({sql_y('f.lat', 'v.z')}) AS BIGINT) WHERE f.min_zoom <= v.z AND f.priority BETWEEN 1 AND 14)"""
_VIEW = with_sql("fx_viewports", "fx_nodes") + f", {_VTILES}, {_POINTS}, {_VFEATURES}"


def _views(spark, sf_dir):
    return view.viewport_tiles(table(spark, sf_dir, "fx_viewports")).withColumn("z", F.col("z").cast("long"))


@query(_VIEW + " SELECT view_id, CAST(count(*) AS BIGINT) AS features, count(DISTINCT (x, y)) AS tiles_loaded, CAST(sum(node_id) AS BIGINT) AS ids FROM vf GROUP BY view_id")
def viewport_features(spark, sf_dir):
    return view.viewport_summary(_views(spark, sf_dir), _tiled(spark, sf_dir), "node_id", 1, 14)


@query(_VIEW + " SELECT pass, count(*) AS features FROM (SELECT CAST(unnest(CASE WHEN geom_type = 4 THEN [4] WHEN geom_type = 2 AND casing THEN [2, 3] ELSE [1] END) AS BIGINT) AS pass FROM vf) GROUP BY pass")
def render_pass(spark, sf_dir):
    return longs(view.pass_counts(_views(spark, sf_dir), _tiled(spark, sf_dir), 1, 14))


_HEX_PICK = "CASE pick " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(_HEX565)) + " END"


@query(
    with_sql("fx_nodes")
    + f""", {_POINTS} SELECT 'type' AS kind, CASE geom_type WHEN 1 THEN 'Point' WHEN 2 THEN 'Line' WHEN 3 THEN 'Polygon' ELSE 'Text' END AS value, count(*) AS n FROM pf GROUP BY 1, 2
    UNION ALL SELECT 'priority', CAST(priority AS VARCHAR), count(*) FROM pf GROUP BY 1, 2 UNION ALL SELECT 'color', {_HEX_PICK}, count(*) FROM pf GROUP BY 1, 2"""
)
def feature_stats(spark, sf_dir):
    return view.feature_stats(point_features(spark, sf_dir))


def _tags_of() -> str:
    by: dict[str, list[str]] = {}
    for selector, _, color, _ in STYLE_RULES:
        if color.startswith("#"):
            v = ((int(color[1:3], 16) >> 3) << 11) + ((int(color[3:5], 16) >> 2) << 5) + (int(color[5:7], 16) >> 3)
            by.setdefault(f"#{(v >> 11 & 31) << 3:02x}{(v >> 5 & 63) << 2:02x}{(v & 31) << 3:02x}", []).append(selector)
    return ", ".join(f"('{h}', '{', '.join(sorted(s)[:3])}')" for h, s in by.items())


@query(with_sql("fx_nodes") + f", {_POINTS}, names(color_hex, tags) AS (VALUES {_tags_of()}), c AS (SELECT {_HEX_PICK} AS color_hex, count(*) AS n FROM pf GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15) SELECT c.color_hex, n, coalesce(tags, 'unknown') AS tags FROM c LEFT JOIN names USING (color_hex)")
def legend_top15(spark, sf_dir):
    return view.legend(point_features(spark, sf_dir), style.tags_of_colors(table(spark, sf_dir, "fx_rules")))


_CELL = "CAST(floor({}) AS BIGINT)"


@query(
    with_sql("fx_areas", "fx_nodes")
    + f""", boxes AS (SELECT area_id, area_id % 16 AS priority, cx - half AS west, cx + half AS east, cy - half AS south, cy + half AS north FROM fx_areas)
    SELECT node_id AS point_id, arg_max(area_id, priority * 10000000 - area_id) AS feature_id, max(priority) AS priority FROM fx_nodes n JOIN boxes b ON n.lon >= west AND n.lon < east AND n.lat >= south AND n.lat < north GROUP BY node_id"""
)
def hit_test(spark, sf_dir):
    a = tiles.rings(spark, sf_dir).select(F.col("area_id").alias("feature_id"), (F.col("area_id") % 16).alias("priority"), F.col("shell").alias("ring"), (F.col("cx") - F.col("half")).alias("west"), (F.col("cx") + F.col("half")).alias("east"), (F.col("cy") - F.col("half")).alias("south"), (F.col("cy") + F.col("half")).alias("north"))
    a = tiling.explode_tiles(a.withColumn("z", F.lit(14).cast("long")))
    p = table(spark, sf_dir, "fx_nodes").select(F.col("node_id").alias("point_id"), F.col("lon").alias("px"), F.col("lat").alias("py"), F.lit(14).cast("long").alias("z"))
    p = p.withColumn("x", F.floor(S.lon_to_x("px", F.col("z"))).cast("long")).withColumn("y", F.floor(S.lat_to_y("py", F.col("z"))).cast("long"))
    return view.hit_test(p, a, ["z", "x", "y"])


@query(with_sql("fx_ocean", "fx_nodes") + "SELECT poly_id FROM fx_ocean o, (SELECT min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM fx_nodes) b WHERE o.west <= b.e AND o.east >= b.w AND o.south <= b.n AND o.north >= b.s")
def ocean_bbox_filter(spark, sf_dir):
    """Ocean polygons whose box meets the data's; the single-row bounds are pushed as a filter."""
    box = table(spark, sf_dir, "fx_nodes").agg(F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).first()
    return table(spark, sf_dir, "fx_ocean").filter((F.col("west") <= box[1]) & (F.col("east") >= box[0]) & (F.col("south") <= box[3]) & (F.col("north") >= box[2])).select("poly_id")


@query("SELECT DISTINCT CAST(10 + event_id % 6 AS BIGINT) AS z, TRUE AS available FROM events")
def available_zooms(spark, sf_dir):
    have = _tiled(spark, sf_dir).select("z").distinct()
    asked = table(spark, sf_dir, "fx_viewports").select(F.col("zoom").cast("long").alias("z")).distinct()
    return asked.join(have, "z", "left_semi").withColumn("available", F.lit(True))
