"""Queries of the routing graph and of routes on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import classify as C
from ..operators import graph, route
from ..session import Stage
from ..sources import packs
from ..sources.fixtures import table, with_sql
from . import features as features_plans
from .registry import Registry, longs

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle

_ROUTABLE = ", ".join(f"'{h}'" for h in C.ROUTABLE)
_CLASS = "CASE WHEN highway IN ('motorway', 'motorway_link') THEN 6 WHEN highway IN ('trunk', 'trunk_link') THEN 5 WHEN highway IN ('primary', 'primary_link') THEN 4 WHEN highway IN ('secondary', 'secondary_link') THEN 3 WHEN highway IN ('tertiary', 'tertiary_link', 'unclassified') THEN 2 WHEN highway IN ('residential', 'living_street') THEN 1 ELSE 0 END"
_FAST = "highway IN ('motorway', 'motorway_link', 'trunk', 'trunk_link')"
_MAY = f"CASE profile WHEN 'WALK' THEN NOT {_FAST} WHEN 'BIKE' THEN NOT {_FAST} AND highway NOT IN ('footway', 'steps') ELSE highway NOT IN ('footway', 'cycleway', 'pedestrian', 'steps', 'path') END"
_RWAYS = f"""rways AS (SELECT way_id, profile, highway, CAST({_CLASS} AS BIGINT) AS hw_class, CAST(CASE WHEN oneway = 'yes' THEN 1 WHEN oneway = '-1' THEN 2 WHEN {_FAST.replace(", 'trunk', 'trunk_link'", '')} THEN 1 ELSE 0 END AS BIGINT) AS oneway,
  CAST(least(255, coalesce(TRY_CAST(nullif(regexp_extract(maxspeed, '^([0-9]+)', 1), '') AS INT), 0)) AS BIGINT) AS maxspeed FROM fx_ways, (SELECT unnest(['CAR', 'BIKE', 'WALK']) AS profile) WHERE highway IN ({_ROUTABLE}) AND {_MAY})"""
_PTS = "pts AS (SELECT r.profile, r.way_id, w.pos, n.node_id, n.lon, n.lat FROM rways r JOIN fx_way_nodes w ON w.way_id = r.way_id JOIN fx_nodes n ON n.node_id = w.node_id)"
_H = "sin(radians(lat - plat) / 2) * sin(radians(lat - plat) / 2) + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) * sin(radians(lon - plon) / 2)"
_SEGMENTS = f"""steps AS (SELECT p.*, count(*) OVER (PARTITION BY p.profile, p.node_id) AS refs, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lead(pos) OVER w IS NULL OR lag(pos) OVER w IS NULL AS tip FROM pts p WINDOW w AS (PARTITION BY p.profile, p.way_id ORDER BY p.pos)),
marked AS (SELECT *, refs >= 2 OR tip AS vertex, CASE WHEN plat IS NULL THEN 0 ELSE 12742000.0::DOUBLE * atan2(sqrt({_H}), sqrt(1 - ({_H}))) END AS step, coalesce(sum((refs >= 2 OR tip)::INT) OVER (PARTITION BY profile, way_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM steps),
ends AS (SELECT profile, way_id, seg, lag(node_id) OVER w AS from_id, lag(lon) OVER w AS from_lon, lag(lat) OVER w AS from_lat, node_id AS to_id, lon AS to_lon, lat AS to_lat FROM marked WHERE vertex WINDOW w AS (PARTITION BY profile, way_id ORDER BY pos)),
segs AS (SELECT e.profile, e.way_id, CAST(e.seg AS BIGINT) AS seg, from_id, from_lon, from_lat, to_id, to_lon, to_lat, l.dist, r.hw_class, r.oneway, r.maxspeed FROM ends e JOIN (SELECT profile, way_id, seg, sum(step) AS dist FROM marked GROUP BY 1, 2, 3) l ON l.profile = e.profile AND l.way_id = e.way_id AND l.seg = e.seg JOIN rways r ON r.profile = e.profile AND r.way_id = e.way_id WHERE from_id IS NOT NULL)"""
_EDGES = """directed AS (SELECT profile, way_id, seg, hw_class, maxspeed, dist, from_id AS src_id, from_lon AS src_lon, from_lat AS src_lat, to_id AS dst_id, to_lon AS dst_lon, to_lat AS dst_lat, CASE WHEN oneway = 1 THEN 1 ELSE 0 END AS flag, FALSE AS back FROM segs
  UNION ALL SELECT profile, way_id, seg, hw_class, maxspeed, dist, to_id, to_lon, to_lat, from_id, from_lon, from_lat, CASE WHEN oneway = 2 THEN 1 ELSE 0 END, TRUE FROM segs WHERE oneway <> 1),
speeds(profile, hw_class, kmh) AS (VALUES {rows}),
edges AS (SELECT d.*, speed, CAST(floor(dist / speed * 10) AS BIGINT) AS cost, CAST(least(floor(dist), 65535) AS BIGINT) AS dist_m FROM (SELECT d.*, CASE WHEN d.profile = 'CAR' AND maxspeed > 0 AND maxspeed < 255 THEN CAST(maxspeed AS DOUBLE) ELSE CAST(kmh AS DOUBLE) END / 3.6::DOUBLE AS speed FROM directed d JOIN speeds s ON s.profile = d.profile AND s.hw_class = d.hw_class) d WHERE speed > 0 AND src_id <> dst_id)""".format(
    rows=", ".join(f"('{p}', {k}, {v})" for p, row in S.SPEEDS_KMH.items() for k, v in enumerate(row))
)
_CUTS = """cut AS (SELECT *, list_sort(list_distinct(list_filter(list_concat([0.0::DOUBLE, 1.0::DOUBLE], list_concat(
   list_transform(generate_series(CAST(floor(least(src_lat * 20.0::DOUBLE, dst_lat * 20.0::DOUBLE)) AS BIGINT) + 1, CAST(floor(greatest(src_lat * 20.0::DOUBLE, dst_lat * 20.0::DOUBLE)) AS BIGINT)), lambda i: (CAST(i AS DOUBLE) / 20.0::DOUBLE - src_lat) / (dst_lat - src_lat)),
   list_transform(generate_series(CAST(floor(least(src_lon * 20.0::DOUBLE, dst_lon * 20.0::DOUBLE)) AS BIGINT) + 1, CAST(floor(greatest(src_lon * 20.0::DOUBLE, dst_lon * 20.0::DOUBLE)) AS BIGINT)), lambda i: (CAST(i AS DOUBLE) / 20.0::DOUBLE - src_lon) / (dst_lon - src_lon)))), lambda v: v >= 0 AND v <= 1))) AS t FROM edges),
pieces AS (SELECT *, CAST(floor((src_lat + (dst_lat - src_lat) * (t0 + t1) / 2.0::DOUBLE) * 20.0::DOUBLE) AS BIGINT) * 500 AS lat_e4, CAST(floor((src_lon + (dst_lon - src_lon) * (t0 + t1) / 2.0::DOUBLE) * 20.0::DOUBLE) AS BIGINT) * 500 AS lon_e4
  FROM (SELECT c.* EXCLUDE (t), t[i] AS t0, t[i + 1] AS t1 FROM (SELECT *, unnest(generate_series(1, len(t) - 1)) AS i FROM cut) c) WHERE t1 - t0 > 1e-9::DOUBLE)"""
_BASE = with_sql("fx_ways", "fx_way_nodes", "fx_nodes")
_GRAPH = f"{_BASE}, {_RWAYS}, {_PTS}, {_SEGMENTS}, {_EDGES}"


def _ways(spark, sf_dir):
    return graph.routable_ways(features_plans.ways(spark, sf_dir))


def _segments(spark, sf_dir):
    return graph.segments(_ways(spark, sf_dir), table(spark, sf_dir, "fx_way_nodes"), table(spark, sf_dir, "fx_nodes"))


def _edges(spark, sf_dir):
    return graph.costed(graph.directed(_segments(spark, sf_dir)))


@query(with_sql("fx_way_nodes", "fx_nodes") + "SELECT n.node_id, count(*) AS refs FROM fx_way_nodes w JOIN fx_nodes n ON n.node_id = w.node_id GROUP BY n.node_id")
def node_refcount(spark, sf_dir):
    return graph.node_references(features_plans.points(spark, sf_dir))


@query(_BASE + f", {_RWAYS} SELECT way_id, profile, hw_class, oneway, maxspeed FROM rways")
def route_access_filter(spark, sf_dir):
    return _ways(spark, sf_dir).select("way_id", "profile", "hw_class", "oneway", "maxspeed")


@query(_BASE + f", {_RWAYS} SELECT profile, highway, count(*) AS ways FROM rways GROUP BY 1, 2")
def highway_histogram(spark, sf_dir):
    return _ways(spark, sf_dir).groupBy("profile", "highway").agg(F.count("*").alias("ways"))


@query(f"{_BASE}, {_RWAYS}, {_PTS}, {_SEGMENTS} SELECT profile, way_id, seg, from_id, to_id, round(dist, 3) AS dist FROM segs")
def segment_lengths(spark, sf_dir):
    return _segments(spark, sf_dir).select("profile", "way_id", "seg", "from_id", "to_id", F.round("dist", 3).alias("dist"))


@query(f"{_GRAPH} SELECT profile, way_id, seg, src_id, dst_id, CAST(flag AS BIGINT) AS flag, back FROM directed")
def reverse_edges(spark, sf_dir):
    return graph.directed(_segments(spark, sf_dir)).select("profile", "way_id", "seg", "src_id", "dst_id", "flag", "back")


@query(f"{_GRAPH} SELECT profile, way_id, seg, back, src_id, dst_id, cost, dist_m FROM edges")
def edge_costs(spark, sf_dir):
    return _edges(spark, sf_dir).select("profile", "way_id", "seg", "back", "src_id", "dst_id", "cost", "dist_m")


@query(f"{_GRAPH}, {_CUTS} SELECT profile, lat_e4, lon_e4, count(*) AS pieces, round(sum(t1 - t0), 6) AS parts, round(sum(dist * (t1 - t0)), 1) AS metres FROM pieces GROUP BY 1, 2, 3")
def cell_split_segments(spark, sf_dir):
    d = graph.split_cells(_edges(spark, sf_dir))
    return d.groupBy("profile", "lat_e4", "lon_e4").agg(F.count("*").alias("pieces"), F.round(F.sum(F.col("t1") - F.col("t0")), 6).alias("parts"), F.round(F.sum("piece_m"), 1).alias("metres"))


def _nodes(spark, sf_dir):
    used = _edges(spark, sf_dir)
    both = used.select("profile", F.col("src_id").alias("node_id")).unionByName(used.select("profile", F.col("dst_id").alias("node_id"))).distinct()
    n = table(spark, sf_dir, "fx_nodes").withColumn("lat_e4", S.cell_e4("lat")).withColumn("lon_e4", S.cell_e4("lon"))
    return both.join(n, "node_id").select("profile", "lat_e4", "lon_e4", "node_id", "lon", "lat")


_NODES = """gnodes AS (SELECT u.profile, n.node_id, CAST(floor(CAST(lat AS FLOAT) * 20::FLOAT) AS BIGINT) * 500 AS lat_e4, CAST(floor(CAST(lon AS FLOAT) * 20::FLOAT) AS BIGINT) * 500 AS lon_e4 FROM (SELECT profile, src_id AS node_id FROM edges UNION SELECT profile, dst_id FROM edges) u JOIN fx_nodes n ON n.node_id = u.node_id),
inodes AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY lat_e4, lon_e4, node_id) - 1 AS node_idx FROM gnodes)"""


@query(f"{_GRAPH}, {_NODES} SELECT profile, lat_e4, lon_e4, node_id, node_idx FROM inodes")
def graph_node_index(spark, sf_dir):
    return graph.index_nodes(_nodes(spark, sf_dir).drop("lon", "lat"))


@query(
    f"""{_GRAPH}, {_NODES} SELECT profile, node_id, CAST(coalesce(degree, 0) AS BIGINT) AS degree, CAST(coalesce(sum(coalesce(degree, 0)) OVER (PARTITION BY profile, lat_e4, lon_e4 ORDER BY node_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS edge_offset,
    lead(node_idx) OVER (PARTITION BY profile, lat_e4, lon_e4 ORDER BY node_idx) IS NULL AS last FROM (SELECT i.*, g.degree FROM inodes i LEFT JOIN (SELECT profile, src_id, count(*) AS degree FROM edges GROUP BY 1, 2) g ON g.profile = i.profile AND g.src_id = i.node_id)"""
)
def edge_offsets(spark, sf_dir):
    from pyspark.sql.window import Window as W

    d = graph.edge_offsets(graph.index_nodes(_nodes(spark, sf_dir).drop("lon", "lat")), _edges(spark, sf_dir))
    cell = W.partitionBy("profile", "lat_e4", "lon_e4").orderBy("node_idx")
    return d.select("profile", "node_id", "degree", "edge_offset", F.lead("node_idx").over(cell).isNull().alias("last"))


def _placed_nodes(spark, sf_dir):
    return graph.index_nodes(_nodes(spark, sf_dir))


_INDEXED = "xedges AS (SELECT e.profile, s.lat_e4, s.lon_e4, s.node_idx AS src_idx, d.node_idx AS dst_idx, e.cost, e.dist_m, CAST(e.hw_class * 2 + e.flag AS BIGINT) AS flags FROM edges e JOIN inodes s ON s.profile = e.profile AND s.node_id = e.src_id JOIN inodes d ON d.profile = e.profile AND d.node_id = e.dst_id)"


@query(
    f"""{_GRAPH}, {_NODES}, {_INDEXED}, cells AS (SELECT n.profile, n.lat_e4, n.lon_e4, n.nodes, coalesce(e.edges, 0) AS edges FROM (SELECT profile, lat_e4, lon_e4, count(*) AS nodes FROM inodes GROUP BY 1, 2, 3) n LEFT JOIN (SELECT profile, lat_e4, lon_e4, count(*) AS edges FROM xedges GROUP BY 1, 2, 3) e USING (profile, lat_e4, lon_e4))
    SELECT profile, lat_e4, lon_e4, CAST(coalesce(sum(nodes) OVER w, 0) AS BIGINT) AS node_offset, nodes, CAST(coalesce(sum(nodes * 12 + edges * 12) OVER w, 0) AS BIGINT) AS data_offset, edges FROM cells WINDOW w AS (PARTITION BY profile ORDER BY lat_e4, lon_e4 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def graph_cell_index(spark, sf_dir):
    n = _placed_nodes(spark, sf_dir)
    return longs(graph.cell_index(n, graph.indexed_edges(n, _edges(spark, sf_dir))))


@query(f"{_GRAPH}, {_NODES}, {_INDEXED} SELECT * FROM xedges")
def graph_file_edges(spark, sf_dir):
    """Edges read back from the graph files that the tables were written to.

    Both directions of a piece share a row until the files are made, and each
    step is written before the next, so that its shuffle files are gone by then.
    """
    stage = Stage(spark)
    ends = [F.col(f"{a}_{k}").alias(f"{b}_{k}") for a, b in (("from", "src"), ("to", "dst")) for k in ("id", "lon", "lat")]
    both = graph.costed(_segments(spark, sf_dir).select("profile", *ends, "dist", "hw_class", "oneway", "maxspeed"))
    both = stage.save(both.select("profile", "src_id", "dst_id", "cost", "dist_m", F.col("hw_class").cast("int").alias("hw_class"), F.col("oneway").cast("int").alias("oneway")), "both")

    # Nodes of the graph with the edges that start at them.
    used = both.select("profile", F.explode(F.array(F.struct(F.col("src_id").alias("node_id"), F.lit(1).alias("n")), F.struct(F.col("dst_id").alias("node_id"), (F.col("oneway") != 1).cast("int").alias("n")))).alias("u"))
    degree = used.groupBy("profile", "u.node_id").agg(F.sum("u.n").alias("degree"))
    n = table(spark, sf_dir, "fx_nodes").withColumn("lat_e4", S.cell_e4("lat")).withColumn("lon_e4", S.cell_e4("lon"))
    n = stage.save(graph.index_nodes(degree.join(n, "node_id")), "nodes")
    n = stage.save(packs.cell_parts(graph.offsets(n)), "parts")

    # Their numbers for the nodes at both ends.
    end = lambda side, *more: n.select("profile", F.col("node_id").alias(f"{side}_id"), F.col("node_idx").alias(f"{side}_idx"), F.col("part").alias(f"{side}_part"))
    e = stage.save(both.join(end("src"), ["profile", "src_id"]).drop("src_id"), "src")
    stage.drop("both")
    e = stage.save(e.join(end("dst"), ["profile", "dst_id"]).drop("dst_id"), "dst")
    stage.drop("src")
    go = lambda a, b, flag: F.struct(F.col(f"{a}_part").alias("part"), F.col(f"{a}_idx").alias("src_idx"), F.col(f"{b}_idx").alias("dst_idx"), (F.col("hw_class") * 2 + (F.col("oneway") == flag).cast("int")).alias("flags"))
    ways = F.filter(F.array(F.struct(go("src", "dst", 1).alias("d"), F.lit(True).alias("may")), F.struct(go("dst", "src", 2).alias("d"), (F.col("oneway") != 1).alias("may"))), lambda x: x["may"])
    e = e.withColumn("w", F.explode(ways)).select("profile", "w.d.*", "cost", "dist_m")
    cells = stage.save(packs.graph_cells(n, e), "cells")
    stage.drop("dst")
    return packs.read_graph_pieces(packs.graph_pieces(cells))


@query(with_sql("fx_ways") + f", {_RWAYS} SELECT profile, r.way_id, coalesce(w.ref, '') AS name FROM rways r JOIN fx_ways w ON w.way_id = r.way_id")
def route_names(spark, sf_dir):
    """Names of routable ways: the name, else the number."""
    return _ways(spark, sf_dir).select("profile", "way_id", F.coalesce("name", F.lit("")).alias("name"))


@query(f"{_GRAPH}, {_CUTS} SELECT profile, lat_e4, lon_e4, count(*) AS edges, count(*) FILTER (flag = 1) AS oneway_edges, " + ", ".join(f"count(*) FILTER (hw_class = {k}) AS class_{k}" for k in range(7)) + " FROM pieces GROUP BY 1, 2, 3")
def cell_stats(spark, sf_dir):
    return graph.cell_statistics(graph.split_cells(_edges(spark, sf_dir)))


@query(
    _GRAPH.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", {_CUTS}, links AS (SELECT DISTINCT profile, lat_e4, lon_e4, src_id, dst_id FROM pieces),
    ends2 AS (SELECT profile, lat_e4, lon_e4, src_id AS node FROM links UNION SELECT profile, lat_e4, lon_e4, dst_id FROM links),
    sizes AS (SELECT profile, lat_e4, lon_e4, count(*) AS nodes, min(node) AS first FROM ends2 GROUP BY 1, 2, 3),
    reach AS (SELECT profile, lat_e4, lon_e4, first AS node FROM sizes UNION SELECT l.profile, l.lat_e4, l.lon_e4, l.dst_id FROM reach r JOIN links l ON l.profile = r.profile AND l.lat_e4 = r.lat_e4 AND l.lon_e4 = r.lon_e4 AND l.src_id = r.node)
    SELECT s.profile, s.lat_e4, s.lon_e4, s.nodes, r.reached FROM sizes s JOIN (SELECT profile, lat_e4, lon_e4, count(*) AS reached FROM reach GROUP BY 1, 2, 3) r USING (profile, lat_e4, lon_e4)"""
)
def cell_reachability(spark, sf_dir):
    return graph.cell_reach(graph.split_cells(_edges(spark, sf_dir)))


# -- routes --------------------------------------------------------------------

_CELLS = """cells AS (SELECT request_id, profile, lat_e4, lon_e4 FROM (SELECT *, unnest(generate_series(CAST(floor(least(from_lon, to_lon) * 10000.0::DOUBLE / 500) AS BIGINT) * 500 - 500, CAST(floor(greatest(from_lon, to_lon) * 10000.0::DOUBLE / 500) AS BIGINT) * 500 + 500, 500)) AS lon_e4
  FROM (SELECT *, unnest(generate_series(CAST(floor(least(from_lat, to_lat) * 10000.0::DOUBLE / 500) AS BIGINT) * 500 - 500, CAST(floor(greatest(from_lat, to_lat) * 10000.0::DOUBLE / 500) AS BIGINT) * 500 + 500, 500)) AS lat_e4 FROM fx_route_requests)))"""
_GRAPH_R = with_sql("fx_ways", "fx_way_nodes", "fx_nodes", "fx_route_requests") + f", {_RWAYS}, {_PTS}, {_SEGMENTS}, {_EDGES}"


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "fx_route_requests")


def _celled_edges(spark, sf_dir):
    """Edges keyed by the cell of their start."""
    return _edges(spark, sf_dir).withColumn("lat_e4", S.snap_e4("src_lat")).withColumn("lon_e4", S.snap_e4("src_lon"))


_ECELL = "ecell AS (SELECT *, CAST(floor(src_lat * 10000.0::DOUBLE / 500) AS BIGINT) * 500 AS lat_e4, CAST(floor(src_lon * 10000.0::DOUBLE / 500) AS BIGINT) * 500 AS lon_e4 FROM edges)"


@query(f"{_GRAPH_R}, {_CELLS}, {_ECELL} SELECT c.request_id, count(*) AS edges, CAST(sum(cost) AS BIGINT) AS cost FROM cells c JOIN ecell e ON e.profile = c.profile AND e.lat_e4 = c.lat_e4 AND e.lon_e4 = c.lon_e4 GROUP BY 1")
def route_subgraph(spark, sf_dir):
    return route.subgraph_totals(_requests(spark, sf_dir), _celled_edges(spark, sf_dir))


_NEAR = """near AS (SELECT request_id, arg_min(node_id, (d, node_id)) AS node_id, min(d) AS dist_m FROM (SELECT r.request_id, n.node_id, round(sqrt(pow((n.lon - r.lon) * 111319.0::DOUBLE * cos(radians((r.lat + n.lat) / 2)), 2) + pow((n.lat - r.lat) * 111319.0::DOUBLE, 2)), 6) AS d
  FROM (SELECT request_id, from_lon + 0.0007::DOUBLE AS lon, from_lat - 0.0011::DOUBLE AS lat FROM fx_route_requests) r JOIN fx_nodes n ON abs(CAST(floor(n.lat * 10000.0::DOUBLE / 500) AS BIGINT) - CAST(floor(r.lat * 10000.0::DOUBLE / 500) AS BIGINT)) <= 1 AND abs(CAST(floor(n.lon * 10000.0::DOUBLE / 500) AS BIGINT) - CAST(floor(r.lon * 10000.0::DOUBLE / 500) AS BIGINT)) <= 1) GROUP BY request_id)"""


@query(with_sql("fx_nodes", "fx_route_requests") + f", {_NEAR} SELECT request_id, node_id FROM near")
def nearest_node(spark, sf_dir):
    p = _requests(spark, sf_dir).select("request_id", (F.col("from_lon") + 0.0007).alias("lon"), (F.col("from_lat") - 0.0011).alias("lat"))
    return route.nearest_nodes(p, table(spark, sf_dir, "fx_nodes"), "request_id").select("request_id", "node_id")


def _placed(spark, sf_dir):
    """Requests with the nodes at their ends."""
    n = table(spark, sf_dir, "fx_nodes")
    r = _requests(spark, sf_dir)
    at = lambda side: route.nearest_nodes(r.select("request_id", F.col(f"{side}_lon").alias("lon"), F.col(f"{side}_lat").alias("lat")), n, "request_id").select("request_id", F.col("node_id").alias("source" if side == "from" else "target"))
    return r.join(at("from"), "request_id").join(at("to"), "request_id")


def _paths(spark, sf_dir):
    r = _placed(spark, sf_dir)
    return route.shortest_paths(r, _celled_edges(spark, sf_dir), both_ends=True)


@query(
    with_sql("fx_ways", "fx_way_nodes", "fx_nodes", "fx_route_requests").replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", {_RWAYS}, {_PTS}, {_SEGMENTS}, {_EDGES}, {_CELLS}, {_ECELL},
    ends_at AS (SELECT request_id, a.node_id AS source, b.node_id AS target FROM fx_route_requests r JOIN fx_nodes a ON a.lon = r.from_lon AND a.lat = r.from_lat JOIN fx_nodes b ON b.lon = r.to_lon AND b.lat = r.to_lat),
    sub AS (SELECT c.request_id, e.src_id, e.dst_id, min(e.cost) AS cost FROM cells c JOIN ecell e ON e.profile = c.profile AND e.lat_e4 = c.lat_e4 AND e.lon_e4 = c.lon_e4 GROUP BY 1, 2, 3),
    d(request_id, node, cost) USING KEY (request_id, node) AS (SELECT request_id, source, CAST(0 AS BIGINT) FROM ends_at
      UNION SELECT s.request_id, s.dst_id, min(x.cost + s.cost) FROM d x JOIN sub s ON s.request_id = x.request_id AND s.src_id = x.node LEFT JOIN recurring.d o ON o.request_id = s.request_id AND o.node = s.dst_id WHERE o.cost IS NULL OR x.cost + s.cost < o.cost GROUP BY s.request_id, s.dst_id)
    SELECT e.request_id, d.cost FROM ends_at e LEFT JOIN d ON d.request_id = e.request_id AND d.node = e.target"""
)
def shortest_path_cost(spark, sf_dir):
    return _paths(spark, sf_dir).select("request_id", "cost")


@query()
def route_length(spark, sf_dir):
    p = _paths(spark, sf_dir)
    return route.path_length(p, table(spark, sf_dir, "fx_nodes")).withColumn("length_m", F.round("length_m", 1))
