"""Viewport queries: tiles, features, hit test, statistics, legend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

TYPE_NAMES = ("?", "Point", "Line", "Polygon", "Text")


def viewport_tiles(views: DataFrame) -> DataFrame:
    """``view_id, z, x, y``: tiles of the 3 x 3 tile window around each centre."""
    z = F.col("zoom")
    top = (F.pow(F.lit(2.0), z) - 1).cast("long")
    span = lambda c: F.sequence(F.floor(c - 1.5).cast("long"), F.floor(c + 1.5).cast("long"))
    d = views.select("view_id", z.alias("z"), span(S.lon_to_x("lon", z)).alias("xs"), span(S.lat_to_y("lat", z)).alias("ys"), top.alias("top"))
    d = d.withColumn("x", F.explode("xs")).withColumn("y", F.explode("ys"))
    return d.filter("x BETWEEN 0 AND top AND y BETWEEN 0 AND top").select("view_id", "z", "x", "y")


def viewport_box(views: DataFrame) -> DataFrame:
    z, x, y = F.col("zoom"), S.lon_to_x("lon", F.col("zoom")), S.lat_to_y("lat", F.col("zoom"))
    return views.select("view_id", S.tile_x_to_lon(x - 1.5, z).alias("west"), S.tile_y_to_lat(y + 1.5, z).alias("south"), S.tile_x_to_lon(x + 1.5, z).alias("east"), S.tile_y_to_lat(y - 1.5, z).alias("north"))


def drawn(features: DataFrame, low: int = 0, high: int = 15) -> DataFrame:
    """Tiled features that a view shows: up to their zoom and inside the priority range."""
    return features.filter((F.col("min_zoom") <= F.col("z")) & F.col("priority").between(low, high))


def viewport_features(tiles: DataFrame, features: DataFrame, low: int = 0, high: int = 15) -> DataFrame:
    """Features of the tiles in view, one row for each view and feature."""
    return tiles.join(drawn(features, low, high), ["z", "x", "y"])


def viewport_summary(tiles: DataFrame, features: DataFrame, id_col: str, low: int = 0, high: int = 15) -> DataFrame:
    """``view_id, features, tiles_loaded, ids``: counts and the sum of ids a view.

    Features are counted by tile before tiles meet views, so the join has one
    row for each view and tile, however many features a tile holds.
    """
    by_tile = drawn(features, low, high).groupBy("z", "x", "y").agg(F.count("*").alias("features"), F.sum(id_col).alias("ids"))
    met = tiles.join(by_tile, ["z", "x", "y"]).groupBy("view_id")
    return met.agg(F.sum("features").alias("features"), F.count("*").alias("tiles_loaded"), F.sum("ids").alias("ids"))


def pass_counts(tiles: DataFrame, features: DataFrame, low: int = 0, high: int = 15) -> DataFrame:
    """``pass, features``: how often all views draw a feature in each pass."""
    by_tile = drawn(features, low, high).select("z", "x", "y", F.explode(render_pass(F.col("geom_type"), F.col("casing"))).alias("pass"))
    by_tile = by_tile.groupBy("z", "x", "y", "pass").agg(F.count("*").alias("n"))
    views = tiles.groupBy("z", "x", "y").agg(F.count("*").alias("views"))
    return by_tile.join(views, ["z", "x", "y"]).groupBy("pass").agg(F.sum(F.col("n") * F.col("views")).alias("features"))


def render_pass(geom_type: Column, casing: Column) -> Column:
    """Passes in which a feature is drawn: 1 plain, 2 casing and 3 core of bridges, 4 text."""
    return F.when(geom_type == 4, F.array(F.lit(4))).when((geom_type == 2) & casing, F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))


def type_name(geom_type: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in TYPE_NAMES]), F.when(geom_type.between(1, 4), geom_type + 1).otherwise(1).cast("int"))


def feature_stats(features: DataFrame) -> DataFrame:
    """Counts by type, priority and color in one pass."""
    parts = [("type", type_name(F.col("geom_type"))), ("priority", F.col("priority").cast("string")), ("color", S.rgb565_hex("color565"))]
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in parts])
    return features.select(F.explode(kinds).alias("s")).groupBy("s.kind", "s.value").agg(F.count("*").alias("n"))


def legend(features: DataFrame, tags: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent colors with up to three selectors each."""
    n = features.groupBy(S.rgb565_hex("color565").alias("color_hex")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "color_hex").limit(top)
    names = F.coalesce(F.array_join(F.slice("tags", 1, 3), ", "), F.lit("unknown"))
    return n.join(tags, "color_hex", "left").select("color_hex", "n", names.alias("tags"))


def hit_test(points: DataFrame, polygons: DataFrame, keys: list[str]) -> DataFrame:
    """Of each point the feature with the highest priority that holds it."""
    d = points.join(polygons, keys).filter(S.point_in_ring("px", "py", "ring"))
    return d.groupBy("point_id").agg(F.max_by(F.struct("feature_id", "priority"), F.struct("priority", F.negative("feature_id"))).alias("f")).select("point_id", "f.feature_id", "f.priority")
