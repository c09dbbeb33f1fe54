"""Map tables derived from the star-schema tables, in SQL that Spark and DuckDB share.

Integer arithmetic and double division only, so both engines make equal rows.
``table`` gives a fixture as a Spark DataFrame, ``with_sql`` the WITH clause
that puts fixtures in front of a DuckDB query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

_KINDS = "motorway trunk primary secondary tertiary unclassified residential living_street service track footway cycleway path pedestrian steps motorway_link".split()
_HIGHWAY = "CASE o_orderkey % 24 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"

#: Own style rules: selector, key, value, zoom, color, priority.
STYLE_RULES = [
    ("highway=motorway", 6, "#e892a2", 14), ("highway=trunk", 6, "#f9b29c", 13), ("highway=primary", 8, "#fcd6a4", 12), ("highway=secondary", 9, "#f7fabf", 11), ("highway=tertiary", 11, "#ffffff", 10),
    ("highway", 12, "#eeeeee", 9), ("railway=rail", 8, "#707070", 15), ("railway", 13, "#808080", 15), ("waterway=river", 8, "#aad3df", 7), ("waterway", 12, "#aad3df", 7), ("aeroway=runway", 10, "#bbbbcc", 8),
    ("natural=water", 7, "#aad3df", 7), ("natural=wood", 8, "#add19e", 2), ("natural=peak", 11, "#d08f55", 15), ("natural=volcano", 10, "#d40000", 15), ("natural", 12, "#eeeeee", 20),
    ("landuse=industrial", 10, "#ebdbe8", 1), ("landuse=residential", 10, "#e0dfdf", 1), ("landuse", 12, "#f0f0f0", 2), ("building", 14, "#d9d0c9", 7), ("amenity=parking", 14, "#eeeeee", 2), ("amenity=school", 13, "#ffffe5", 4),
    ("leisure=park", 11, "#c8facc", 1), ("place=city", 6, "#555555", 15), ("place=town", 8, "#555555", 14), ("man_made=pier", 13, "bad", 6), ("admin_level=2", 6, "#8d618b", 3), ("admin_level=4", 7, "#8d618b", 3), ("admin_level=6", 9, "#8d618b", 3), ("boundary", 9, "#8d618b", 3),
]


def _rule(selector: str, zoom: int, color: str, priority: int) -> str:
    key, _, value = selector.partition("=")
    return f"('{selector}', '{key}', {repr(value) if value else 'NULL'}, {zoom}, '{color}', {priority})"


_BOX = "CAST({0} AS DOUBLE) + CAST(({1}) % {2} AS DOUBLE) / 10000"
_CX, _CY = _BOX.format("1.40", "c_custkey * 6007", 3967), _BOX.format("42.40", "c_custkey * 9001", 2971)
_TAGS = {
    "natural": ["water", "bay", "wood", "beach", "wetland", "grassland", "scrub", "peak", "cliff"], "landuse": ["reservoir", "grass", "meadow", "forest", "commercial", "retail", "residential", "industrial", "farmland", "garages", "cemetery", "quarry"],
    "leisure": ["park", "pitch", "playground", "track", "garden"], "amenity": ["parking", "parking_space", "school", "grave_yard", "cafe"], "place": ["island", "islet", "city", "square"], "man_made": ["tower", "bridge", "pier", "mast"],
    "aeroway": ["hangar", "aerodrome", "apron", "runway"], "bridge": ["yes", "viaduct", "no"], "highway": ["primary", "path"], "waterway": ["river"], "water": ["lake"], "building": ["yes"], "railway": ["rail"], "boundary": ["administrative"],
}
#: Of each tag: modulus and multiplier of the rule that gives it to a tag set.
_RULES = {"natural": (17, 5), "landuse": (19, 7), "leisure": (23, 11), "amenity": (29, 13), "place": (31, 3), "man_made": (37, 17), "aeroway": (41, 19), "bridge": (13, 2), "highway": (43, 23), "waterway": (47, 29), "water": (53, 31), "building": (7, 1), "railway": (59, 37), "boundary": (61, 41)}


def _tag(name: str) -> str:
    modulus, times = _RULES[name]
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_TAGS[name]))
    return f"CASE (p_partkey * {times}) % {modulus} {arms} END AS {name}"


FIXTURES = {
    "fx_nodes": "SELECT p_partkey AS node_id, " + _BOX.format("1.40", "p_partkey * 7919", 3989) + " AS lon, " + _BOX.format("42.40", "p_partkey * 104729", 2999) + " AS lat FROM {part}",
    "fx_node_tags": """SELECT p_partkey AS node_id, CASE WHEN p_size IN (25, 50) THEN 'peak' WHEN p_size = 1 THEN 'volcano' END AS "natural",
        CASE p_size WHEN 2 THEN 'city' WHEN 3 THEN 'town' WHEN 4 THEN 'village' WHEN 5 THEN 'suburb' WHEN 6 THEN 'hamlet' END AS place,
        CASE WHEN p_size BETWEEN 2 AND 6 THEN concat(p_name, ' ', CAST(p_partkey AS STRING)) END AS name,
        CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 2 = 0 AND (p_partkey * 3701) % 2000000 >= 1000
             THEN concat(CAST(((p_partkey * 3701) % 2000000 - (p_partkey * 3701) % 1000) / 1000 AS INT), ',', lpad(CAST((p_partkey * 3701) % 1000 AS STRING), 3, '0'))
             ELSE CAST((p_partkey * 3701) % 2000000 AS STRING) END AS population FROM {part}""",
    "fx_tagsets": "SELECT p_partkey AS id, " + ", ".join(_tag(t) for t in _TAGS) + " FROM {part}",
    "fx_ways": f"""SELECT o_orderkey AS way_id, o_orderkey AS seq, {_HIGHWAY} AS highway,
        CASE o_orderkey % 24 WHEN 16 THEN 'rail' WHEN 17 THEN 'tram' END AS railway, CASE o_orderkey % 24 WHEN 18 THEN 'river' WHEN 19 THEN 'stream' END AS waterway,
        CASE o_orderkey % 24 WHEN 20 THEN 'runway' END AS aeroway, CASE o_orderkey % 24 WHEN 21 THEN 'cliff' END AS "natural", CASE o_orderkey % 24 WHEN 22 THEN 'pier' END AS man_made,
        CASE o_orderstatus WHEN 'O' THEN 'yes' WHEN 'P' THEN '-1' END AS oneway,
        CASE WHEN o_orderkey % 13 = 0 THEN 'walk' ELSE concat(CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) * 20 AS STRING), CASE WHEN o_orderkey % 5 = 0 THEN ' mph' ELSE '' END) END AS maxspeed,
        CASE WHEN o_orderkey % 10 = 0 THEN concat('D', CAST(1000 + o_orderkey % 1500 AS STRING)) WHEN o_orderkey % 24 <= 3 THEN concat('N', CAST(o_orderkey % 7 AS STRING)) END AS ref,
        CASE WHEN o_orderkey % 10 = 0 THEN 'N20' END AS old_ref, CASE WHEN o_orderkey % 31 = 0 THEN 'yes' END AS bridge, CASE WHEN o_orderkey % 37 = 0 THEN 'yes' END AS tunnel,
        CASE WHEN o_orderkey % 41 = 0 THEN '-1' END AS layer, CASE WHEN o_orderkey % 24 = 16 AND o_orderkey % 5 = 0 THEN 'yard' END AS service FROM {{orders}}""",
    "fx_way_nodes": """SELECT l_orderkey AS way_id, l_partkey AS node_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS BIGINT) AS pos FROM {lineitem}""",
    "fx_areas": f"""SELECT c_custkey AS area_id, {_CX} AS cx, {_CY} AS cy, CAST(1 + c_custkey % 40 AS DOUBLE) / 20000 AS half, c_custkey % 7 = 0 AS has_hole, c_custkey % 3 = 0 AS from_way, c_custkey % 8 = 0 AS in_water_relation,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'yes' END AS building, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'parking' END AS amenity, CASE c_mktsegment WHEN 'MACHINERY' THEN 'industrial' WHEN 'HOUSEHOLD' THEN 'residential' END AS landuse,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN CASE WHEN c_custkey % 2 = 0 THEN 'water' ELSE 'wood' END END AS "natural", CASE WHEN c_custkey % 29 = 0 THEN '-1' END AS level FROM {{customer}}""",
    "fx_relations": "SELECT CAST(n_nationkey AS BIGINT) AS rel_id, 'administrative' AS boundary, CASE WHEN n_nationkey % 13 <> 0 THEN 2 * (1 + n_nationkey % 4) END AS admin_level FROM {nation}",
    "fx_relation_members": """SELECT CAST(c.c_nationkey AS BIGINT) AS rel_id, o.o_orderkey AS way_id FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 9 = 0
        UNION ALL SELECT CAST((c.c_nationkey + 1) % 25 AS BIGINT), o.o_orderkey FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 18 = 0""",
    "fx_ocean": "SELECT CAST(-1000000000 - r_regionkey AS BIGINT) AS poly_id, CAST(1.30 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) / 10 AS west, CAST(1.40 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) / 10 AS east, CAST(42.35 AS DOUBLE) AS south, CAST(42.65 AS DOUBLE) AS north FROM {region}",
    "fx_viewports": """SELECT event_id AS view_id, CAST(10 + event_id % 6 AS INT) AS zoom, n.lon, n.lat
        FROM (SELECT event_id, (event_id * 13) % (SELECT count(*) FROM {part}) AS at FROM {events}) e JOIN fx_nodes n ON n.node_id = e.at""",
    "fx_route_requests": """SELECT s_suppkey AS request_id, CASE s_suppkey % 3 WHEN 0 THEN 'CAR' WHEN 1 THEN 'BIKE' ELSE 'WALK' END AS profile, a.lon AS from_lon, a.lat AS from_lat, b.lon AS to_lon, b.lat AS to_lat
        FROM (SELECT s_suppkey, (s_suppkey * 17) % (SELECT count(*) FROM {part}) AS at, (s_suppkey * 101 + 7) % (SELECT count(*) FROM {part}) AS goal FROM {supplier}) e
        JOIN fx_nodes a ON a.node_id = e.at JOIN fx_nodes b ON b.node_id = e.goal""",
    "fx_rules": 'SELECT * FROM (VALUES ' + ", ".join(_rule(*r) for r in STYLE_RULES) + ') AS t(selector, "key", "value", zoom, color, priority)',
}
_NEEDS = {"fx_viewports": ["fx_nodes"], "fx_route_requests": ["fx_nodes"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame over the Parquet tables of ``sf_dir``."""
    ship_package(spark)
    text = FIXTURES[name]
    for need in _NEEDS.get(name, []):
        text = re.sub(rf"\b{need}\b", f"({FIXTURES[need]})", text)
    text = re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", text)
    return spark.sql(text.replace('"', "`"))


def with_sql(*names: str) -> str:
    """``WITH`` clause of the named fixtures (and those they need) for DuckDB."""
    order = list(dict.fromkeys(x for n in names for x in [*_NEEDS.get(n, []), n]))
    return "WITH " + ",\n".join(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', FIXTURES[n])})" for n in order) + "\n"
