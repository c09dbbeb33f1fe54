"""All records of a tile: background, polygons, line parts, bridge decks, symbols and labels.

Each maker returns rows of ``RECORD`` columns; ``rank_records`` puts them in draw
order and gives them palette numbers, so that ``codec.encode_tiles`` can write them.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import geometry as G
from ..functions import scalar as S
from . import tiling

RECORD = ["z", "x", "y", "kind", "id", "part", "geom_type", "nibble", "min_zoom", "color565", "width_byte", "rings", "text", "shield"]
# Colors of the background and of decks, the decks' place in the draw order,
# and the clip margin in tile units.
BACKGROUND, DECK, DECK_NIBBLE, MARGIN = "#f2efe9", "#b8b8b8", 14, 410
#: Decks are drawn from this zoom on.
DECK_ZOOM = 16
#: Labels of neighbouring tiles are written while their place lies in this range (fixed values).
LABEL_LOW, LABEL_HIGH = -8192, 12288
_KINDS = ("background", "polygon", "line", "deck", "symbol", "label")
_RINGS, _SHIELD = "array<array<struct<px:int,py:int>>>", "array<int>"


def _record(d: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """Rows in the common form; what is not given is zero or null."""
    c = {"kind": F.lit(kind), "part": F.lit(0), "width_byte": F.lit(0), "min_zoom": F.lit(0), "text": F.lit(None), "shield": F.lit(None), **columns}
    kinds = {"z": "int", "x": "bigint", "y": "bigint", "id": "bigint", "part": "int", "geom_type": "int", "nibble": "int", "min_zoom": "int", "color565": "int", "width_byte": "int", "rings": _RINGS, "text": "string", "shield": _SHIELD, "kind": "string"}
    return d.select(*[c.get(name, F.col(name)).cast(kinds[name]).alias(name) for name in RECORD])


def background(tiles: DataFrame) -> DataFrame:
    """A square under everything else, for each of ``z, x, y``."""
    corner = lambda a, b: F.struct(F.lit(a).alias("px"), F.lit(b).alias("py"))
    square = F.array(F.array(*[corner(a, b) for a, b in ((0, 0), (4096, 0), (4096, 4096), (0, 4096), (0, 0))]))
    return _record(tiles, "background", id=F.lit(0), geom_type=F.lit(3), nibble=F.lit(0), color565=S.hex_to_rgb565(F.lit(BACKGROUND)), rings=square)


def line_segments(points: DataFrame, zoom: int) -> DataFrame:
    """``way_id, pos, x, y, t0, t1`` and ends ``ax, ay, bx, by`` in tile units: segments in the tiles they meet.

    ``points``: way_id, pos, lon, lat.  Tiles are those of the way's bounding
    box that the segment reaches with the clip margin, found by the segment's
    own box, so a long way is not tried against all its tiles.
    """
    way, edge = W.partitionBy("way_id"), MARGIN / 4096.0
    p = points.select("way_id", "pos", S.lon_to_x("lon", zoom).alias("fx"), S.lat_to_y("lat", zoom).alias("fy"))
    for c in ("fx", "fy"):
        p = p.withColumn(f"lo_{c}", F.min(c).over(way)).withColumn(f"hi_{c}", F.max(c).over(way))
    d = p.withColumn("gx", F.lead("fx").over(way.orderBy("pos"))).withColumn("gy", F.lead("fy").over(way.orderBy("pos"))).filter("gx IS NOT NULL")
    top = (1 << zoom) - 1
    for tile, a, b in (("x", "fx", "gx"), ("y", "fy", "gy")):
        first = F.greatest(F.floor(F.least(a, b) - edge), F.floor(f"lo_{a}"), F.lit(0)).cast("long")
        last = F.least(F.floor(F.greatest(a, b) + edge), F.floor(f"hi_{a}"), F.lit(top)).cast("long")
        d = d.withColumn("first", first).withColumn("last", last).filter("first <= last").withColumn(tile, F.explode(F.sequence("first", "last")))
    place = lambda v, tile: (F.col(v) - F.col(tile)) * 4096.0
    d = d.select("way_id", "pos", "x", "y", place("fx", "x").alias("ax"), place("fy", "y").alias("ay"), place("gx", "x").alias("bx"), place("gy", "y").alias("by"))
    t0, t1 = tiling.clip_segment(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), -float(MARGIN), 4096.0 + MARGIN)
    return d.withColumn("t0", t0).withColumn("t1", t1).filter("t0 <= t1")


def line_parts(points: DataFrame, zoom: int) -> DataFrame:
    """``way_id, x, y, part, segments, line``: runs of connected clipped segments in each tile."""
    one = W.partitionBy("way_id", "x", "y").orderBy("pos")
    d = line_segments(points, zoom)
    joined = (F.lag("pos").over(one) == F.col("pos") - 1) & (F.lag("t1").over(one) == 1) & (F.col("t0") == 0)
    d = d.withColumn("new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn("part", F.sum("new").over(one) - 1)
    at = lambda c, t: (F.col(f"a{c}") + (F.col(f"b{c}") - F.col(f"a{c}")) * F.col(t)).cast("int")
    spot = lambda t: F.struct(at("x", t).alias("px"), at("y", t).alias("py"))
    d = d.select("way_id", "x", "y", "part", F.struct("pos", spot("t0").alias("a"), spot("t1").alias("b")).alias("s"))
    d = d.groupBy("way_id", "x", "y", "part").agg(F.array_sort(F.collect_list("s")).alias("s"))
    line = F.concat(F.array(F.element_at("s", 1)["a"]), F.transform("s", lambda s: s["b"]))
    # A place that repeats the one before it is left out.
    line = F.filter(line, lambda p, i: (i == 0) | (p != F.get(line, i - 1)))
    return d.select("way_id", "x", "y", F.col("part").cast("int").alias("part"), F.size("s").alias("segments"), line.alias("line"))


def line_records(parts: DataFrame, looks: DataFrame, zoom: int) -> DataFrame:
    """Line records: ``looks`` has way_id, min_zoom, priority (the nibble), color565, kind, is_bridge."""
    d = parts.filter(F.size("line") >= 2).join(looks, "way_id").withColumn("z", F.lit(zoom))
    width = tiling.line_width(F.col("kind"), F.col("z"), F.lit(0.0))
    color = tiling.line_color(F.col("kind"), F.col("z"), F.col("color565"))
    byte = tiling.width_byte(F.lit(2), width, F.col("is_bridge"), F.lit(False), F.col("z"))
    return _record(d, "line", id=F.col("way_id"), geom_type=F.lit(2), nibble=F.least("priority", F.lit(15)), color565=color, width_byte=byte, rings=F.array("line"))


def deck_records(parts: DataFrame, looks: DataFrame, zoom: int) -> DataFrame:
    """Decks of bridges: pieces of the flat-capped buffer of each line part, cut to the tile; none below ``DECK_ZOOM``."""
    d = parts.filter(F.size("line") >= 2).join(looks.filter("is_bridge"), "way_id")
    if zoom < DECK_ZOOM:
        d = d.limit(0)
    rail = F.when(F.col("kind").isin("rail", "narrow_gauge", "funicular", "tram", "light_rail"), 2.0).otherwise(1.0)
    half = (tiling.line_width(F.col("kind"), F.lit(zoom), F.lit(0.0)) * 0.4 + rail) * 16.0
    d = d.select("way_id", "x", "y", "part", "line", "min_zoom", half.alias("half"))

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                for k, ring in enumerate(G.buffer_line([(p["px"], p["py"]) for p in r.line], r.half)):
                    cut = G.clip_ring(ring, -MARGIN, -MARGIN, 4096 + MARGIN, 4096 + MARGIN)
                    if cut:
                        out.append((r.way_id, r.x, r.y, r.part * 4096 + k, r.min_zoom, [[{"px": int(a), "py": int(b)} for a, b in cut]]))
            yield pd.DataFrame(out, columns=["id", "x", "y", "part", "min_zoom", "rings"])

    d = d.mapInPandas(run, f"id long, x long, y long, part int, min_zoom int, rings {_RINGS}").withColumn("z", F.lit(zoom))
    return _record(d, "deck", part=F.col("part"), min_zoom=F.col("min_zoom"), geom_type=F.lit(3), nibble=F.lit(DECK_NIBBLE), color565=S.hex_to_rgb565(F.lit(DECK)))


def polygon_records(polygons: DataFrame, looks: DataFrame) -> DataFrame:
    """``polygons``: z, x, y, area_id, layer, nibble, rings; ``looks``: area_id, min_zoom, color565."""
    d = polygons.join(looks, "area_id")
    byte = tiling.width_byte(F.lit(3), F.lit(0), F.lit(False), F.col("layer") == "buildings", F.col("z"))
    return _record(d, "polygon", id=F.col("area_id"), min_zoom=F.col("min_zoom"), geom_type=F.lit(3), width_byte=byte)


def symbol_records(nodes: DataFrame, tiles: DataFrame, zoom: int) -> DataFrame:
    """Triangles of point symbols in those of ``tiles`` that exist; ``nodes``: node_id, lon, lat, min_zoom, color565."""
    z = F.lit(zoom)
    d = nodes.filter(F.col("min_zoom") <= zoom).withColumn("z", z).withColumn("x", F.floor(S.lon_to_x("lon", z)).cast("long")).withColumn("y", F.floor(S.lat_to_y("lat", z)).cast("long"))
    d = d.join(tiles.select("x", "y").distinct(), ["x", "y"], "left_semi")
    shape = tiling.triangle(F.col("lon"), F.col("lat"), z, F.col("x"), F.col("y"))
    return _record(d, "symbol", id=F.col("node_id"), min_zoom=F.col("min_zoom"), geom_type=F.lit(3), nibble=F.lit(15), rings=F.array(shape))


def label_records(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Text records of placed labels in the nine tiles around them.

    ``placed``: z, feature_id, lon, lat; ``texts``: feature_id, text, min_zoom,
    priority, color565, font, shield.
    """
    d = tiling.label_tiles(placed.select("z", "feature_id", "lon", "lat").join(texts, "feature_id"))
    d = d.withColumn("px", S.label_px("lon", F.col("x"), F.col("z"))).withColumn("py", S.label_py("lat", F.col("y"), F.col("z")))
    d = d.filter(F.col("px").between(LABEL_LOW, LABEL_HIGH) & F.col("py").between(LABEL_LOW, LABEL_HIGH))
    spot = F.array(F.array(F.struct(F.col("px").cast("int").alias("px"), F.col("py").cast("int").alias("py"))))
    return _record(d, "label", id=F.col("feature_id"), min_zoom=F.col("min_zoom"), geom_type=F.lit(4), nibble=F.col("priority"), width_byte=F.col("font"), rings=spot, text=F.col("text"), shield=F.col("shield"))


def whole_tiles(records: list[DataFrame]) -> DataFrame:
    """All records and a background for each tile that has any."""
    d = reduce(DataFrame.unionByName, records)
    return d.unionByName(background(d.select("z", "x", "y").distinct()))


def rank_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records ready for ``codec.encode_tiles``, and the palette ``z, color565, idx``.

    Draw order: background, then decks, polygons, lines and symbols by nibble,
    then labels; within a nibble by kind, id and part.
    """
    kind = F.array_position(F.array(*[F.lit(k) for k in _KINDS]), F.col("kind"))
    stage = F.when(F.col("kind") == "background", 0).when(F.col("kind") == "label", 2).otherwise(1)
    order = W.partitionBy("z", "x", "y").orderBy("stage", "nibble", "kind_no", "id", "part")
    d = records.withColumn("stage", stage).withColumn("kind_no", kind).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= tiling.TILE_RECORDS)
    palette = tiling.number_palette(records)
    d = d.join(palette.select(F.col("z").cast("int").alias("z"), F.col("color565").cast("int").alias("color565"), F.col("idx").cast("int").alias("color_idx")), ["z", "color565"])
    return d.withColumn("zoom_priority", S.pack_zoom_priority("min_zoom", F.greatest(F.col("nibble"), F.lit(0))).cast("int")).drop("stage", "kind_no"), palette
