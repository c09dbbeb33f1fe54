"""Geometry assembly: ways to node places, boundary levels, relation rings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def way_points(way_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``way_id, pos, node_id, lon, lat``: references without a node are dropped."""
    return way_nodes.join(nodes.select("node_id", "lon", "lat"), "node_id").select("way_id", "pos", "node_id", "lon", "lat")


def way_geometry(points: DataFrame) -> DataFrame:
    """One row a way with its points in order; ways of fewer than two are dropped.

    A way's references are bounded by its format (2000 in the source data), so
    gathering one way in a row is safe.
    """
    line = F.array_sort(F.collect_list(F.struct("pos", "lon", "lat")))
    g = points.groupBy("way_id").agg(line.alias("p")).filter("size(p) >= 2")
    line = F.transform("p", lambda x: F.struct(x["lon"].alias("lon"), x["lat"].alias("lat")))
    first, last = F.element_at("line", 1), F.element_at("line", -1)
    return g.select("way_id", line.alias("line")).withColumn("closed", (F.size("line") >= 4) & (first == last))


def boundary_levels(members: DataFrame, relations: DataFrame, top: int = 6, absent: int = 10) -> DataFrame:
    """``way_id, admin_level``: least level of the boundaries a way belongs to, up to ``top``."""
    levels = relations.filter("boundary = 'administrative'").select("rel_id", F.coalesce("admin_level", F.lit(absent)).cast("long").alias("admin_level"))
    return members.join(levels.filter(F.col("admin_level") <= top), "rel_id").groupBy("way_id").agg(F.min("admin_level").alias("admin_level"))


def inject_boundary(ways: DataFrame, levels: DataFrame) -> DataFrame:
    """Ways with tag ``admin_level`` of their boundary; an own level stays, an own boundary tag goes."""
    own = F.try_element_at("tags", F.lit("admin_level"))
    d = ways.join(levels.withColumnRenamed("admin_level", "boundary_level"), "way_id", "left")
    level = F.coalesce(own, F.col("boundary_level").cast("string"))
    rest = F.map_filter("tags", lambda k, _: ~k.isin("boundary", "admin_level"))
    return d.withColumn("tags", F.when(F.col("boundary_level").isNull(), F.col("tags")).otherwise(F.map_concat(rest, F.create_map(F.lit("admin_level"), level)))).drop("boundary_level")


def without_water_members(polygons: DataFrame, water_ways: DataFrame) -> DataFrame:
    """Water polygons of ways that a water relation will emit are left out."""
    members = water_ways.select("way_id").distinct().withColumn("in_relation", F.lit(True))
    return polygons.join(members, "way_id", "left").filter("in_relation IS NULL OR layer <> 'water'").drop("in_relation")


def without_done_areas(areas: DataFrame, done: DataFrame) -> DataFrame:
    """Areas made from ways that already gave a polygon are left out."""
    key = (areas["from_way"]) & (areas["orig_id"] == done["way_id"])
    return areas.join(done.select("way_id").distinct(), key, "left_anti")


def _stitch(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rings of one relation's member ways by shared end points, inner rings to their outer."""
    from ..functions.geometry import inside_ring

    out = []
    for role in ("outer", "inner"):
        parts = [[tuple(p.values()) if isinstance(p, dict) else tuple(p) for p in line] for line in pdf.loc[pdf.role == role].sort_values("way_id")["line"]]
        rings = []
        while parts:
            ring = list(parts.pop(0))
            while ring[0] != ring[-1]:
                for i, p in enumerate(parts):
                    if p[0] == ring[-1] or p[-1] == ring[-1]:
                        ring += (p if p[0] == ring[-1] else p[::-1])[1:]
                        parts.pop(i)
                        break
                else:
                    break
            if ring[0] == ring[-1] and len(ring) >= 4:
                rings.append(ring)
        out.append(rings)
    outers, inners = out
    holes: list[list] = [[] for _ in outers]
    for h in inners:
        for i, o in enumerate(outers):
            if inside_ring(*h[0], o):
                holes[i].append(h)
                break
    rel = pdf["rel_id"].iloc[0]
    rows = [{"rel_id": rel, "part": i, "rings": [[{"lon": x, "lat": y} for x, y in r] for r in [o, *holes[i]]]} for i, o in enumerate(outers)]
    return pd.DataFrame(rows, columns=["rel_id", "part", "rings"])


def relation_rings(members: DataFrame, lines: DataFrame) -> DataFrame:
    """``rel_id, part, rings``: one row for each outer ring with its inner rings.

    ``members``: rel_id, way_id, role; ``lines``: way_id, line.  Ways that close
    no ring are left out.
    """
    parts = members.join(lines.select("way_id", "line"), "way_id").select("rel_id", "way_id", F.when(F.col("role") == "inner", "inner").otherwise("outer").alias("role"), "line")
    return parts.groupBy("rel_id").applyInPandas(_stitch, "rel_id long, part int, rings array<array<struct<lon:double,lat:double>>>")


def road_label_samples(ways: DataFrame, spacing: int = 75) -> DataFrame:
    """One of every ``spacing`` ways of a reference: label index and zoom.

    ``ways``: way_id, seq, ref.  A reference's ways are counted in stretches of
    1024 sequence numbers first, so that a long road is not one sorted task.
    """
    d = ways.withColumn("stretch", F.floor(F.col("seq") / 1024))
    per = d.groupBy("ref", "stretch").count()
    per = per.withColumn("base", F.coalesce(F.sum("count").over(W.partitionBy("ref").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("count")
    n = F.col("base") + F.row_number().over(W.partitionBy("ref", "stretch").orderBy("seq"))
    d = d.join(per, ["ref", "stretch"]).withColumn("n", n).filter(F.col("n") % spacing == 1)
    index = F.floor(F.col("n") / spacing)
    zoom = F.when(index % 3 == 0, 10).when(index % 2 == 0, 12).otherwise(13)
    return d.select("way_id", "ref", index.cast("long").alias("label_index"), zoom.cast("long").alias("min_zoom"))


def label_candidates(lines: DataFrame) -> DataFrame:
    """Points at a quarter, half and three quarters of a line's vertices."""
    at = lambda r: F.element_at("line", (F.least(F.floor(F.size("line") * r), F.size("line") - 1) + 1).cast("int"))
    return lines.withColumn("candidates", F.array(*[at(r) for r in (0.25, 0.5, 0.75)]))
