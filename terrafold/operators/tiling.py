"""Features to zooms and tiles, per-zoom widths and colors, packs and palettes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import scalar as S

# Half-pixel widths by the zooms from which they hold.
LINE_WIDTHS = {
    "motorway": {6: 2, 10: 3, 12: 4, 13: 5, 14: 6, 15: 7, 16: 10, 17: 18, 18: 22, 19: 28}, "motorway_link": {10: 2, 13: 3, 15: 5, 16: 8, 17: 14, 19: 16},
    "trunk": {6: 2, 10: 3, 12: 4, 13: 5, 14: 6, 15: 7, 16: 10, 17: 18, 18: 22, 19: 28}, "trunk_link": {10: 2, 13: 3, 15: 5, 16: 8, 17: 14, 19: 16},
    "primary": {8: 2, 10: 3, 13: 4, 14: 5, 15: 6, 16: 10, 17: 16, 18: 22, 19: 28}, "primary_link": {10: 2, 13: 3, 15: 4, 16: 8, 17: 12, 18: 14, 19: 16},
    "secondary": {10: 2, 12: 3, 14: 4, 15: 5, 16: 10, 17: 14, 18: 22, 19: 28}, "secondary_link": {10: 2, 13: 3, 14: 2, 15: 3, 16: 8, 17: 10, 18: 14, 19: 16},
    "tertiary": {11: 2, 13: 3, 15: 4, 16: 10, 17: 12, 18: 19, 19: 28}, "tertiary_link": {12: 2, 15: 3, 16: 8, 17: 10, 18: 12, 19: 16},
    "pedestrian": {13: 2, 15: 3, 16: 8, 17: 12, 18: 15, 19: 18}, "residential": {13: 2, 15: 3, 16: 5, 17: 8, 18: 11, 19: 18}, "living_street": {13: 2, 15: 3, 16: 5, 17: 8, 18: 11, 19: 18},
    "unclassified": {12: 2, 14: 3, 16: 5, 17: 12, 18: 11, 19: 18}, "service": {13: 2, 16: 3, 17: 6, 18: 8, 19: 10}, "track": {15: 2, 17: 4, 19: 6},
    "footway": {13: 2}, "cycleway": {13: 2}, "path": {13: 2}, "bridleway": {13: 2},
    "rail": {9: 2, 16: 3, 18: 4, 19: 6}, "tram": {15: 2, 18: 3, 19: 4}, "narrow_gauge": {13: 2, 18: 3, 19: 4}, "funicular": {13: 2, 18: 3, 19: 4}, "cable_car": {12: 2, 18: 3, 19: 4},
    "runway": {12: 4, 13: 6, 14: 8, 15: 12, 16: 16, 17: 22, 18: 28}, "taxiway": {12: 2, 13: 3, 14: 4, 15: 5, 16: 6, 17: 10, 18: 14}, "helipad": {12: 2, 13: 4, 15: 5, 16: 6, 17: 8, 18: 10},
}
# Line colors that replace the style's at single zooms.
LINE_COLORS = {("residential", 13): "#cccccc", ("unclassified", 12): "#cccccc", ("living_street", 12): "#cccccc", ("track", 15): "#ffffff", ("track", 16): "#ffffff", ("service", 16): "#cccccc", ("secondary", 10): "#bababa", ("secondary", 11): "#bababa"}
MAX_ZOOM = 17
TILE_RECORDS = 0xFFFE


def explode_zooms(features: DataFrame, low: int = 6, high: int = MAX_ZOOM) -> DataFrame:
    """A row for each zoom from the feature's own on; secondary roads without a number skip zoom 9."""
    if not 0 <= low <= high <= MAX_ZOOM:
        raise ValueError(f"zooms must lie in 0..{MAX_ZOOM}")
    from_zoom = F.greatest(F.col("min_zoom").cast("int"), F.lit(low))
    d = features.filter(F.col("min_zoom") <= high).withColumn("z", F.explode(F.sequence(from_zoom, F.lit(high))))
    if {"highway_type", "ref"} <= set(d.columns):
        d = d.filter(~((F.col("z") == 9) & (F.col("highway_type") == "secondary") & (F.coalesce("ref", F.lit("")) == "")))
    return d


def clamp_tile(v: Column, z: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(v, (F.pow(F.lit(2.0), z) - 1).cast("long")))


def explode_tiles(features: DataFrame, west="west", south="south", east="east", north="north") -> DataFrame:
    """A row for each tile of the bounding box at zoom ``z`` (columns x and y)."""
    z = F.col("z")
    tile = lambda f: clamp_tile(F.floor(f).cast("long"), z)
    d = features.withColumn("x", F.explode(F.sequence(tile(S.lon_to_x(west, z)), tile(S.lon_to_x(east, z)))))
    return d.withColumn("y", F.explode(F.sequence(tile(S.lat_to_y(north, z)), tile(S.lat_to_y(south, z)))))


def label_tiles(labels: DataFrame) -> DataFrame:
    """The nine tiles around each placed label, inside the map."""
    z = F.col("z")
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    d = labels.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    d = d.withColumn("x", F.floor(S.lon_to_x("lon", z)).cast("long") + F.col("dx")).withColumn("y", F.floor(S.lat_to_y("lat", z)).cast("long") + F.col("dy"))
    side = F.pow(F.lit(2.0), z)
    return d.filter((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") < side) & (F.col("y") < side)).drop("dx", "dy")


def line_width(highway: Column, z: Column, metres: Column) -> Column:
    """Half pixels: the widest-zoom entry at or below z, else from metres, else 1."""
    table, known = F.lit(None).cast("int"), F.lit(False)
    for kind, steps in LINE_WIDTHS.items():
        of_kind = F.lit(None).cast("int")
        for zoom, width in sorted(steps.items()):
            of_kind = F.when(z >= zoom, width).otherwise(of_kind)
        table = F.when(highway == kind, of_kind).otherwise(table)
        known = known | (highway == kind)
    measured = F.when(~known & (metres > 0), S.meters_to_pixels(metres, z))
    return F.coalesce(table.cast("long"), measured, F.lit(1).cast("long"))


def line_color(highway: Column, z: Column, color565: Column) -> Column:
    out = color565
    for (kind, zoom), value in LINE_COLORS.items():
        out = F.when((highway == kind) & (z == zoom), S.hex_to_rgb565(F.lit(value))).otherwise(out)
    return out


def width_byte(geom_type: Column, width: Column, is_bridge: Column, is_building: Column, z: Column) -> Column:
    """Width and the casing bit: lines keep bridges from zoom 14, polygons buildings from 16."""
    line = F.least(width, F.lit(127)) + F.when(is_bridge & (z >= 14), 128).otherwise(0)
    return F.when(geom_type == 3, F.when(is_building & (z >= 16), 128).otherwise(0)).otherwise(line)


def number_palette(colors: DataFrame) -> DataFrame:
    """``z, color565, idx``: distinct colors of each zoom, numbered by color."""
    return colors.select("z", "color565").distinct().withColumn("idx", (F.row_number().over(W.partitionBy("z").orderBy("color565")) - 1).cast("long"))


def pack_bounds(tiles: DataFrame) -> DataFrame:
    """Corner and size of each zoom's pack, and its number of tiles."""
    d = tiles.groupBy("z").agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"), F.count("*").alias("tiles"))
    return d.select("z", "min_x", "min_y", (F.col("max_x") - F.col("min_x") + 1).alias("wide"), (F.col("max_y") - F.col("min_y") + 1).alias("high"), "tiles")


def pack_offsets(tiles: DataFrame, palette_sizes: DataFrame) -> DataFrame:
    """``z, x, y, size, offset``: places of tile blobs behind header, index and palette.

    ``tiles``: z, x, y, size; ``palette_sizes``: z, colors.  Running sums go row
    by row of tiles and then inside the row, so no zoom is one sorted task.
    """
    rows = tiles.groupBy("z", "y").agg(F.sum("size").alias("row"))
    rows = rows.withColumn("before", F.coalesce(F.sum("row").over(W.partitionBy("z").orderBy("y").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("row")
    base = pack_bounds(tiles).join(palette_sizes, "z").select("z", (F.lit(23) + F.col("wide") * F.col("high") * 8 + F.col("colors") * 2).alias("start"))
    inner = F.coalesce(F.sum("size").over(W.partitionBy("z", "y").orderBy("x").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    d = tiles.join(rows, ["z", "y"]).withColumn("inner", inner).join(F.broadcast(base), "z")
    return d.select("z", "x", "y", "size", (F.col("start") + F.col("before") + F.col("inner")).alias("offset"))


def find_tiles(wanted: DataFrame, placed: DataFrame) -> DataFrame:
    """``wanted`` rows (z, x, y) with the offset and size of their tile; zeros for a tile that is not there."""
    d = wanted.join(placed.select("z", "x", "y", "offset", "size"), ["z", "x", "y"], "left")
    return d.withColumn("offset", F.coalesce("offset", F.lit(0))).withColumn("size", F.coalesce("size", F.lit(0)))


def pack_totals(tiles: DataFrame, palette_sizes: DataFrame) -> DataFrame:
    """``z, tiles, wide, high, colors, bytes, mb`` of each zoom's pack."""
    sizes = tiles.groupBy("z").agg(F.sum("size").alias("blobs"))
    d = pack_bounds(tiles).join(sizes, "z").join(palette_sizes, "z")
    total = F.lit(23) + F.col("wide") * F.col("high") * 8 + F.col("colors") * 2 + F.col("blobs")
    return d.withColumn("bytes", total).select("z", "tiles", "wide", "high", "colors", "bytes", F.round(F.col("bytes") / 1048576.0, 6).alias("mb"))


def order_in_tile(features: DataFrame) -> DataFrame:
    """Draw order: nibble, then arrival; at most TILE_RECORDS records a tile."""
    rank = F.row_number().over(W.partitionBy("z", "x", "y").orderBy("nibble", "ord"))
    return features.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= TILE_RECORDS)


def triangle(lon: Column, lat: Column, z: Column, x: Column, y: Column, pixels: int = 3) -> Column:
    """Closed triangle symbol around a point, in tile units."""
    size = F.lit(360.0) / F.pow(F.lit(2.0), z) / 256.0 * pixels
    h = size / F.cos(F.radians(lat)) * 0.866
    corner = lambda lo, la: F.struct(S.tile_px(S.lon_to_x(lo, z), x).alias("px"), S.tile_px(S.lat_to_y(la, z), y).alias("py"))
    top = corner(lon, lat + h * 0.667)
    return F.array(top, corner(lon - size, lat - h * 0.333), corner(lon + size, lat - h * 0.333), top)


def clip_segment(x0: Column, y0: Column, x1: Column, y1: Column, lo: float, hi: float) -> tuple[Column, Column]:
    """Entry and exit parameters of a segment in the box [lo, hi]^2 (entry > exit: outside)."""
    t0, t1 = F.lit(0.0), F.lit(1.0)
    for a, b in ((x0, x1), (y0, y1)):
        d = b - a
        near, far = (F.lit(lo) - a) / F.nullif(d, F.lit(0.0)), (F.lit(hi) - a) / F.nullif(d, F.lit(0.0))
        outside = (a < lo) | (a > hi)
        t0 = F.greatest(t0, F.when(d == 0, F.when(outside, 2.0).otherwise(0.0)).otherwise(F.least(near, far)))
        t1 = F.least(t1, F.when(d == 0, 1.0).otherwise(F.greatest(near, far)))
    return t0, t1
