"""Routing graphs: segments, cell split, node index, edges and statistics.

All three profiles are built in one plan from one scan.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import scalar as S
from .classify import ROUTABLE, accessible, maxspeed, route_oneway, t

PROFILES = ("CAR", "BIKE", "WALK")


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in PROFILES], "profile string")


def routable_ways(ways: DataFrame) -> DataFrame:
    """``way_id, profile, highway, hw_class, oneway, maxspeed, name``: a row for each profile that may use the way."""
    w = ways.filter(t("highway").isin(*ROUTABLE))
    w = w.select("way_id", t("highway").alias("highway"), route_oneway().cast("long").alias("oneway"), maxspeed().cast("long").alias("maxspeed"), F.coalesce(t("name"), t("ref"), F.lit("")).alias("name"))
    w = w.withColumn("profile", F.explode(F.array(*[F.lit(p) for p in PROFILES]))).filter(accessible(F.col("profile"), F.col("highway")))
    return w.withColumn("hw_class", S.road_class("highway").cast("long"))


def node_references(points: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """How often ways visit each node; a closed way counts its end twice."""
    return points.groupBy(*keys, "node_id").agg(F.count("*").alias("refs"))


def route_points(ways: DataFrame, way_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``way_id, pos, node_id, lon, lat, shared``: places of routable ways' references.

    ``shared`` has a bit for each of ``PROFILES`` whose ways visit the node
    twice or more.  References meet nodes once for all profiles.
    """
    bit = lambda of: F.element_at(F.create_map(*[x for k, p in enumerate(PROFILES) for x in (F.lit(p), F.lit(1 << k))]), of)
    masks = ways.groupBy("way_id").agg(F.bit_or(bit(F.col("profile"))).alias("may"))
    p = way_nodes.join(masks, "way_id").select("way_id", "pos", "node_id", "may").join(nodes.select("node_id", "lon", "lat"), "node_id")
    one = W.partitionBy("node_id")
    shared = lambda k: F.when(F.sum(F.col("may").bitwiseAND(1 << k)).over(one) >= 2 << k, 1 << k).otherwise(0)
    p = p.select("way_id", "pos", "node_id", "lon", "lat", *[shared(k).alias(f"s{k}") for k in range(len(PROFILES))])
    return p.select("way_id", "pos", "node_id", "lon", "lat", sum((F.col(f"s{k}") for k in range(1, len(PROFILES))), F.col("s0")).alias("shared"))


def segments(ways: DataFrame, way_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Way pieces between vertices (ends and shared nodes), with their length.

    A window over one way's points finds the last vertex; ways are bounded, so
    no partition of the window is.  Points are dealt out by way once; profiles
    share them until then.
    """
    p = route_points(ways, way_nodes, nodes).join(ways.select("way_id", "profile", "hw_class", "oneway", "maxspeed"), "way_id")
    one = W.partitionBy("way_id", "profile").orderBy("pos")
    p = p.withColumn("step", F.when(F.lag("pos").over(one).isNotNull(), S.haversine_m(F.lag("lat").over(one), F.lag("lon").over(one), F.col("lat"), F.col("lon"))).otherwise(0.0))
    bit = F.element_at(F.create_map(*[x for k, name in enumerate(PROFILES) for x in (F.lit(name), F.lit(1 << k))]), F.col("profile"))
    p = p.withColumn("vertex", (F.col("shared").bitwiseAND(bit) > 0) | F.lead("pos").over(one).isNull() | F.lag("pos").over(one).isNull())
    p = p.withColumn("seg", F.coalesce(F.sum(F.col("vertex").cast("int")).over(one.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    p = p.withColumn("dist", F.sum("step").over(W.partitionBy("way_id", "profile", "seg").orderBy("pos")))
    ends = p.filter("vertex")
    ends = ends.withColumn("from_id", F.lag("node_id").over(one)).withColumn("from_lon", F.lag("lon").over(one)).withColumn("from_lat", F.lag("lat").over(one)).filter("from_id IS NOT NULL")
    return ends.select("profile", "way_id", F.col("seg").cast("long").alias("seg"), "from_id", "from_lon", "from_lat", F.col("node_id").alias("to_id"), F.col("lon").alias("to_lon"), F.col("lat").alias("to_lat"), "dist", "hw_class", "oneway", "maxspeed")


def directed(segs: DataFrame) -> DataFrame:
    """Forward pieces, and backward ones unless the way is one way forward."""
    ends = lambda a, b: [F.col(f"{a}_{k}").alias(f"src_{k}") for k in ("id", "lon", "lat")] + [F.col(f"{b}_{k}").alias(f"dst_{k}") for k in ("id", "lon", "lat")]
    forth = F.struct(*ends("from", "to"), F.when(F.col("oneway") == 1, 1).otherwise(0).cast("long").alias("flag"), F.lit(False).alias("back"))
    back = F.struct(*ends("to", "from"), F.when(F.col("oneway") == 2, 1).otherwise(0).cast("long").alias("flag"), F.lit(True).alias("back"))
    both = F.when(F.col("oneway") == 1, F.array(forth)).otherwise(F.array(forth, back))
    return segs.withColumn("d", F.explode(both)).select("profile", "way_id", "seg", "hw_class", "maxspeed", "dist", "d.*")


def costed(edges: DataFrame) -> DataFrame:
    """Cost in tenths of a second, length in whole metres; impassable and self-loop edges go."""
    d = edges.withColumn("speed", S.speed_ms("profile", "hw_class", "maxspeed")).filter((F.col("speed") > 0) & (F.col("src_id") != F.col("dst_id")))
    return d.withColumn("cost", S.edge_cost("dist", "speed")).withColumn("dist_m", F.least(F.floor("dist"), F.lit(65535)).cast("long"))


def split_cells(edges: DataFrame) -> DataFrame:
    """Straight edges cut at the lines of the 0.05 degree grid.

    The cut parameters of both axes are computed at once; pieces follow from
    their sorted distinct list.  Adds piece, t0, t1 and the cell of the piece.
    """

    def cuts(axis: str) -> Column:
        a, b = F.col(f"src_{axis}") * 20.0, F.col(f"dst_{axis}") * 20.0
        low, high = F.floor(F.least(a, b)).cast("long") + 1, F.floor(F.greatest(a, b)).cast("long")
        lines = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(lines, lambda i: (i.cast("double") / 20.0 - F.col(f"src_{axis}")) / (F.col(f"dst_{axis}") - F.col(f"src_{axis}")))

    ends = F.array(F.lit(0.0), F.lit(1.0))
    d = edges.withColumn("t", F.array_sort(F.array_distinct(F.filter(F.concat(ends, cuts("lat"), cuts("lon")), lambda v: (v >= 0.0) & (v <= 1.0)))))
    pairs = F.zip_with(F.slice("t", F.lit(1), F.size("t") - 1), F.slice("t", F.lit(2), F.size("t") - 1), lambda a, b: F.struct(a.alias("t0"), b.alias("t1")))
    d = d.withColumn("p", F.explode(F.filter(pairs, lambda p: p["t1"] - p["t0"] > 1e-9))).withColumn("t0", F.col("p.t0")).withColumn("t1", F.col("p.t1")).drop("p", "t")
    mid = lambda k: F.col(f"src_{k}") + (F.col(f"dst_{k}") - F.col(f"src_{k}")) * (F.col("t0") + F.col("t1")) / 2.0
    d = d.withColumn("lat_e4", F.floor(mid("lat") * 20.0).cast("long") * 500).withColumn("lon_e4", F.floor(mid("lon") * 20.0).cast("long") * 500)
    return d.withColumn("piece_m", F.col("dist") * (F.col("t1") - F.col("t0")))


def unsigned_order(*cells: str) -> list[Column]:
    """Cell order of the graph file: coordinates as unsigned 32-bit numbers."""
    return [F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in cells]


def index_nodes(nodes: DataFrame) -> DataFrame:
    """``node_idx`` over sorted cells: the place inside the cell plus the nodes of earlier cells.

    ``nodes``: profile, lat_e4, lon_e4, node_id.  Only the table of cells, one
    row for each 0.05 degree square, is ordered as a whole.
    """
    cells = nodes.groupBy("profile", "lat_e4", "lon_e4").agg(F.count("*").alias("n"))
    order = W.partitionBy("profile").orderBy(*unsigned_order("lat_e4", "lon_e4")).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    inner = F.row_number().over(W.partitionBy("profile", "lat_e4", "lon_e4").orderBy("node_id")) - 1
    return nodes.join(cells, ["profile", "lat_e4", "lon_e4"]).withColumn("node_idx", (F.col("base") + inner).cast("long")).drop("base")


def edge_offsets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``edge_offset``: edges of earlier nodes of the cell, by node index."""
    degree = edges.groupBy("profile", F.col("src_id").alias("node_id")).agg(F.count("*").alias("degree"))
    return offsets(nodes.join(degree, ["profile", "node_id"], "left").withColumn("degree", F.coalesce("degree", F.lit(0))))


def offsets(nodes: DataFrame) -> DataFrame:
    """``edge_offset`` of nodes that have their ``degree``."""
    before = W.partitionBy("profile", "lat_e4", "lon_e4").orderBy("node_idx").rowsBetween(W.unboundedPreceding, -1)
    return nodes.withColumn("edge_offset", F.coalesce(F.sum("degree").over(before), F.lit(0)).cast("long"))


def indexed_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``profile, lat_e4, lon_e4, src_idx, dst_idx, cost, dist_m, flags`` in the cell of the start.

    ``nodes``: as ``index_nodes`` gives them; flags are the one-way bit and the
    road class behind it.
    """
    start = nodes.select("profile", F.col("node_id").alias("src_id"), F.col("node_idx").alias("src_idx"), "lat_e4", "lon_e4")
    end = nodes.select("profile", F.col("node_id").alias("dst_id"), F.col("node_idx").alias("dst_idx"))
    d = edges.select("profile", "src_id", "dst_id", "cost", "dist_m", (F.col("hw_class") * 2 + F.col("flag")).cast("long").alias("flags"))
    return d.join(start, ["profile", "src_id"]).join(end, ["profile", "dst_id"]).drop("src_id", "dst_id")


#: Bytes of a node and of an edge in a graph file.
NODE_BYTES, EDGE_BYTES = 12, 12


def cell_index(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``profile, lat_e4, lon_e4, node_offset, nodes, data_offset, edges``: the index of a graph file.

    Offsets run over the cells in unsigned order; only the table of cells is
    ordered as a whole.  ``edges``: as ``indexed_edges`` gives them.
    """
    cell = ["profile", "lat_e4", "lon_e4"]
    m = edges.groupBy(*cell).agg(F.count("*").alias("edges"))
    d = nodes.groupBy(*cell).agg(F.count("*").alias("nodes")).join(m, cell, "left").withColumn("edges", F.coalesce("edges", F.lit(0)).cast("long"))
    before = W.partitionBy("profile").orderBy(*unsigned_order("lat_e4", "lon_e4")).rowsBetween(W.unboundedPreceding, -1)
    size = F.col("nodes") * NODE_BYTES + F.col("edges") * EDGE_BYTES
    return d.withColumn("node_offset", F.coalesce(F.sum("nodes").over(before), F.lit(0))).withColumn("data_offset", F.coalesce(F.sum(size).over(before), F.lit(0))).select(*cell, "node_offset", "nodes", "data_offset", "edges")


def cell_statistics(pieces: DataFrame) -> DataFrame:
    """Edges, share of one-way edges and edges of each class by cell."""
    classes = [F.count_if(F.col("hw_class") == k).alias(f"class_{k}") for k in range(7)]
    return pieces.groupBy("profile", "lat_e4", "lon_e4").agg(F.count("*").alias("edges"), F.count_if(F.col("flag") == 1).alias("oneway_edges"), *classes)


def _reached(pdf: pd.DataFrame) -> pd.DataFrame:
    links: dict[int, list[int]] = {}
    for a, b in zip(pdf.src_id, pdf.dst_id, strict=True):
        links.setdefault(a, []).append(b)
        links.setdefault(b, [])
    first = min(links)
    seen, todo = {first}, [first]
    while todo:
        for n in links[todo.pop()]:
            if n not in seen:
                seen.add(n)
                todo.append(n)
    cell = pdf.iloc[0]
    return pd.DataFrame([{"profile": cell.profile, "lat_e4": cell.lat_e4, "lon_e4": cell.lon_e4, "nodes": len(links), "reached": len(seen)}])


def cell_reach(pieces: DataFrame) -> DataFrame:
    """Of each cell how many of its nodes its least node reaches inside it."""
    return pieces.select("profile", "lat_e4", "lon_e4", "src_id", "dst_id").groupBy("profile", "lat_e4", "lon_e4").applyInPandas(_reached, "profile string, lat_e4 long, lon_e4 long, nodes long, reached long")
