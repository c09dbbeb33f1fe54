"""Queries that classify, style and assemble entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import assemble, classify as C, style
from ..sources.fixtures import _TAGS, table, with_sql
from .registry import Registry, longs

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle
WAY_TAGS = ("highway", "railway", "waterway", "aeroway", "natural", "man_made", "oneway", "maxspeed", "ref", "old_ref", "bridge", "tunnel", "layer", "service")
AREA_TAGS = ("building", "amenity", "landuse", "natural", "level")


def ways(spark, sf_dir):
    return C.with_tags(table(spark, sf_dir, "fx_ways"), *WAY_TAGS).select("way_id", "seq", "tags")


def areas(spark, sf_dir):
    return C.with_tags(table(spark, sf_dir, "fx_areas"), *AREA_TAGS).drop(*AREA_TAGS)


def tagsets(spark, sf_dir):
    return C.with_tags(table(spark, sf_dir, "fx_tagsets"), *_TAGS).select("id", "tags")


def points(spark, sf_dir):
    return assemble.way_points(table(spark, sf_dir, "fx_way_nodes"), table(spark, sf_dir, "fx_nodes"))


@query(with_sql("fx_nodes") + "SELECT count(*) AS nodes, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM fx_nodes")
def dataset_bbox(spark, sf_dir):
    return table(spark, sf_dir, "fx_nodes").agg(F.count("*").alias("nodes"), F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))


_LAYER = """CASE WHEN coalesce("natural" IN ('water', 'bay'), FALSE) OR waterway IS NOT NULL OR water IS NOT NULL OR coalesce(landuse = 'reservoir', FALSE) THEN 'water'
    WHEN highway IS NOT NULL OR railway IS NOT NULL THEN 'roads' WHEN boundary IS NOT NULL THEN '' WHEN place IN ('island', 'islet') THEN 'islands' WHEN place IS NOT NULL THEN 'places'
    WHEN building IS NOT NULL OR coalesce(aeroway = 'hangar', FALSE) OR coalesce(man_made = 'tower', FALSE) THEN 'buildings' WHEN aeroway = 'aerodrome' THEN 'aeroways'
    WHEN amenity IN ('parking', 'parking_space') THEN 'parking' WHEN amenity IS NOT NULL THEN 'amenities' WHEN leisure = 'pitch' THEN 'pitch' WHEN leisure IS NOT NULL THEN 'leisure'
    WHEN coalesce("natural" = 'grassland', FALSE) OR coalesce(landuse IN ('grass', 'meadow'), FALSE) THEN 'surface' WHEN landuse IS NOT NULL THEN 'landuse'
    WHEN bridge IS NOT NULL OR aeroway IS NOT NULL OR coalesce(man_made IN ('bridge', 'embankment', 'pier'), FALSE) THEN 'infrastructure' WHEN "natural" IS NOT NULL THEN 'terrain' ELSE '' END"""


@query(with_sql("fx_tagsets") + f"SELECT id, {_LAYER} AS layer FROM fx_tagsets")
def layer_classify(spark, sf_dir):
    return tagsets(spark, sf_dir).select("id", C.layer().alias("layer"))


@query(
    with_sql("fx_tagsets")
    + f"""SELECT id, layer, CAST(CASE WHEN bridge IN ('yes', 'viaduct') OR man_made = 'bridge' THEN 9 WHEN leisure = 'track' THEN 6 WHEN aeroway = 'apron' THEN 2 WHEN aeroway = 'aerodrome' THEN 1
    WHEN amenity = 'school' THEN 3 WHEN "natural" = 'wood' OR landuse = 'forest' THEN 5 WHEN "natural" IN ('grassland', 'scrub') THEN 5 WHEN landuse IN ('grass', 'meadow') THEN 5 WHEN "natural" IN ('beach', 'wetland') THEN 4
    WHEN leisure = 'playground' THEN 4 WHEN leisure = 'park' THEN 1 WHEN landuse = 'cemetery' OR amenity = 'grave_yard' THEN 3 WHEN landuse = 'garages' THEN 3 WHEN landuse = 'farmland' THEN 4
    WHEN landuse IN ('residential', 'industrial') THEN 1 WHEN landuse = 'retail' THEN 3 WHEN landuse = 'commercial' THEN 1
    WHEN layer = 'aeroways' THEN 1 WHEN layer IN ('leisure', 'amenities') THEN 3 WHEN layer IN ('pitch', 'surface') THEN 4 WHEN layer = 'infrastructure' THEN 6 WHEN layer IN ('buildings', 'water') THEN 7 ELSE 2 END AS BIGINT) AS nibble
    FROM (SELECT *, {_LAYER} AS layer FROM fx_tagsets)"""
)
def polygon_nibble(spark, sf_dir):
    d = tagsets(spark, sf_dir).withColumn("layer", C.layer())
    return longs(d.select("id", "layer", C.polygon_nibble(F.col("layer")).alias("nibble")))


_KEYED = " UNION ALL ".join(f"SELECT id, '{k}' AS k, \"{k}\" AS v, {style.KEY_ORDER.index(k) + 1 if k in style.KEY_ORDER else 99} AS rank FROM fx_tagsets WHERE \"{k}\" IS NOT NULL" for k in _TAGS)


@query(
    with_sql("fx_tagsets", "fx_rules")
    + f""", keyed AS ({_KEYED}), met AS (SELECT k.id, r.*, k.rank, row_number() OVER (PARTITION BY k.id ORDER BY r."value" IS NULL, k.rank) AS n FROM keyed k JOIN fx_rules r ON r."key" = k.k AND (r."value" IS NULL OR r."value" = k.v))
    SELECT t.id, m.selector, CAST(coalesce(m.zoom, 6) AS BIGINT) AS min_zoom, CAST(coalesce(CASE WHEN m.selector IS NULL THEN NULL WHEN regexp_matches(h, '^#[0-9A-Fa-f]{{6}}') THEN ((('0x' || substr(h, 2, 2))::INT >> 3) << 11) + ((('0x' || substr(h, 4, 2))::INT >> 2) << 5) + (('0x' || substr(h, 6, 2))::INT >> 3) END, 65535) AS BIGINT) AS color565,
    CAST(coalesce(m.priority, 50) AS BIGINT) AS priority, m.selector IS NOT NULL AS interesting FROM fx_tagsets t LEFT JOIN (SELECT *, color AS h FROM met WHERE n = 1) m ON m.id = t.id"""
)
def style_match_best(spark, sf_dir):
    return style.best_rule(tagsets(spark, sf_dir), table(spark, sf_dir, "fx_rules"), "id")


@query(
    with_sql("fx_ways")
    + """SELECT way_id, coalesce(tunnel IN ('yes', 'culvert'), FALSE) OR coalesce(layer = '-1', FALSE) AS under, (coalesce(tunnel IN ('yes', 'culvert'), FALSE) OR coalesce(layer = '-1', FALSE)) AND (waterway IS NOT NULL OR coalesce(highway IN ('pedestrian', 'footway', 'cycleway', 'steps', 'platform'), FALSE)) AS dropped,
    coalesce(bridge = 'yes', FALSE) AS bridge FROM fx_ways"""
)
def underground_filter(spark, sf_dir):
    return ways(spark, sf_dir).select("way_id", C.underground_line().alias("under"), C.underground_dropped(C.layer()).alias("dropped"), C.is_bridge().alias("bridge"))


@query(
    with_sql("fx_areas")
    + """SELECT area_id, coalesce(level = '-1', FALSE) AS under, TRUE AS kept, CASE WHEN "natural" = 'water' THEN 'water' WHEN building IS NOT NULL THEN 'buildings' WHEN amenity = 'parking' THEN 'parking' WHEN landuse IS NOT NULL THEN 'landuse' ELSE 'terrain' END AS layer FROM fx_areas"""
)
def area_filter(spark, sf_dir):
    d = areas(spark, sf_dir).withColumn("layer", C.layer())
    return d.select("area_id", C.underground_polygon().alias("under"), C.area_kept(F.col("layer")).alias("kept"), "layer")


@query(
    with_sql("fx_tagsets")
    + f"""SELECT id, (building IS NOT NULL OR landuse IS NOT NULL OR water IS NOT NULL OR amenity IS NOT NULL OR leisure IS NOT NULL OR "natural" IS NOT NULL OR waterway IS NOT NULL OR man_made IS NOT NULL OR aeroway IS NOT NULL)
    AND coalesce(highway NOT IN ('motorway', 'trunk', 'primary', 'secondary', 'tertiary'), TRUE) AND place IS NULL AND coalesce(aeroway NOT IN ('runway', 'taxiway', 'helipad'), TRUE) AND ({_LAYER}) NOT IN ('boundaries', 'places') AND id % 2 = 0 AS is_area FROM fx_tagsets"""
)
def area_vs_line(spark, sf_dir):
    return tagsets(spark, sf_dir).select("id", C.is_area(F.col("id") % 2 == 0, C.layer()).alias("is_area"))


_JOINED = "SELECT w.way_id, w.pos, n.node_id, n.lon, n.lat FROM fx_way_nodes w JOIN fx_nodes n ON n.node_id = w.node_id"


@query(
    with_sql("fx_way_nodes", "fx_nodes")
    + f"SELECT way_id, count(*) AS points, count(*) >= 4 AND min_by(node_id, pos) = max_by(node_id, pos) AS closed, round(min(lon), 6) AS west, round(max(lat), 6) AS north, round(min_by(lon, pos), 6) AS first_lon FROM ({_JOINED}) GROUP BY way_id HAVING count(*) >= 2"
)
def way_geometry_join(spark, sf_dir):
    g = assemble.way_geometry(points(spark, sf_dir))
    lon, lat = F.transform("line", lambda p: p["lon"]), F.transform("line", lambda p: p["lat"])
    return g.select("way_id", F.size("line").cast("long").alias("points"), "closed", F.round(F.array_min(lon), 6).alias("west"), F.round(F.array_max(lat), 6).alias("north"), F.round(F.element_at(lon, 1), 6).alias("first_lon"))


_LEVELS = "levels AS (SELECT m.way_id, min(coalesce(r.admin_level, 10)) AS level FROM fx_relation_members m JOIN fx_relations r ON r.rel_id = m.rel_id WHERE coalesce(r.admin_level, 10) <= 6 GROUP BY m.way_id)"


@query(with_sql("fx_relations", "fx_relation_members", "fx_ways") + f", {_LEVELS} SELECT w.way_id, CAST(l.level AS STRING) AS admin_level, CASE WHEN l.level IS NULL THEN NULL WHEN l.level < 8 THEN 'boundaries' ELSE 'places' END AS layer FROM fx_ways w LEFT JOIN levels l ON l.way_id = w.way_id")
def boundary_min_level(spark, sf_dir):
    levels = assemble.boundary_levels(table(spark, sf_dir, "fx_relation_members"), table(spark, sf_dir, "fx_relations"))
    d = assemble.inject_boundary(ways(spark, sf_dir), levels)
    level = C.t("admin_level")
    return d.select("way_id", level.alias("admin_level"), F.when(level.isNotNull(), F.when(level.cast("int") < 8, "boundaries").otherwise("places")).alias("layer"))


@query(with_sql("fx_areas") + """SELECT area_id AS way_id, CASE WHEN "natural" = 'water' THEN 'water' ELSE 'other' END AS layer FROM fx_areas WHERE NOT (in_water_relation AND coalesce("natural" = 'water', FALSE))""")
def water_ways_anti(spark, sf_dir):
    a = areas(spark, sf_dir)
    polygons = a.select(F.col("area_id").alias("way_id"), F.when(C.layer() == "water", "water").otherwise("other").alias("layer"))
    return assemble.without_water_members(polygons, a.filter("in_water_relation").select(F.col("area_id").alias("way_id")))


@query(with_sql("fx_areas", "fx_ways") + "SELECT area_id FROM fx_areas a WHERE NOT (from_way AND EXISTS (SELECT 1 FROM fx_ways w WHERE w.way_id = a.area_id AND w.highway IS NOT NULL))")
def area_dedup_anti(spark, sf_dir):
    a = areas(spark, sf_dir).select("area_id", "from_way", F.col("area_id").alias("orig_id"))
    return assemble.without_done_areas(a, ways(spark, sf_dir).filter(C.has("highway")).select("way_id")).select("area_id")


_POP = "coalesce(TRY_CAST(nullif(regexp_extract(regexp_replace(population, '[, ]', '', 'g'), '^([+-]?[0-9]+)', 1), '') AS INT), 0)"


@query(
    with_sql("fx_node_tags")
    + f"""SELECT node_id, place, CAST(p AS BIGINT) AS people, CAST(CASE place WHEN 'city' THEN 2 WHEN 'town' THEN 1 ELSE 0 END AS BIGINT) AS font,
    CAST(CASE place WHEN 'city' THEN CASE WHEN p >= 1000000 THEN 4 WHEN p >= 500000 THEN 5 WHEN p >= 100000 THEN 6 ELSE 8 END WHEN 'town' THEN CASE WHEN p >= 50000 THEN 8 WHEN p >= 15000 THEN 9 WHEN p >= 5000 THEN 10 ELSE 11 END
      WHEN 'village' THEN CASE WHEN p >= 2000 THEN 11 WHEN p >= 500 THEN 12 ELSE 13 END WHEN 'suburb' THEN 12 ELSE 14 END AS BIGINT) AS min_zoom,
    CAST(CASE WHEN p >= 500000 THEN 15 WHEN p >= 100000 THEN 14 WHEN p >= 15000 THEN 13 ELSE 12 END AS BIGINT) AS priority FROM (SELECT *, {_POP} AS p FROM fx_node_tags WHERE place IS NOT NULL AND name <> '')"""
)
def place_label_rules(spark, sf_dir):
    n = table(spark, sf_dir, "fx_node_tags").filter("place IS NOT NULL AND name <> ''").withColumn("people", S.population("population"))
    p = F.col("place")
    return longs(n.select("node_id", "place", "people", C.place_font(p).alias("font"), C.place_zoom(p, F.col("people")).alias("min_zoom"), C.place_priority(F.col("people")).alias("priority")))


_WANTED = "highway IN ('motorway', 'trunk', 'primary', 'secondary') AND (ref LIKE 'A%' OR ref LIKE 'N%' OR (ref LIKE 'D%' AND coalesce(TRY_CAST(substr(ref, 2) AS INT) BETWEEN 1000 AND 1999, FALSE) AND coalesce(old_ref LIKE 'N%', FALSE)))"


@query(
    with_sql("fx_ways")
    + f"""SELECT way_id, ref, n // 75 AS label_index, CAST(CASE WHEN (n // 75) % 3 = 0 THEN 10 WHEN (n // 75) % 2 = 0 THEN 12 ELSE 13 END AS BIGINT) AS min_zoom
    FROM (SELECT way_id, ref, row_number() OVER (PARTITION BY ref ORDER BY seq) AS n FROM fx_ways WHERE {_WANTED}) WHERE n % 75 = 1"""
)
def road_label_sampling(spark, sf_dir):
    w = ways(spark, sf_dir).filter(C.road_label_wanted()).select("way_id", "seq", C.t("ref").alias("ref"))
    return assemble.road_label_samples(w)


@query(
    with_sql("fx_way_nodes", "fx_nodes")
    + f"""SELECT way_id, round(list_extract(l, least(floor(n * 0.25::DOUBLE)::INT, n - 1) + 1), 6) AS lon_25, round(list_extract(l, least(floor(n * 0.5::DOUBLE)::INT, n - 1) + 1), 6) AS lon_50, round(list_extract(l, least(floor(n * 0.75::DOUBLE)::INT, n - 1) + 1), 6) AS lon_75
    FROM (SELECT way_id, list(lon ORDER BY pos) AS l, CAST(count(*) AS INT) AS n FROM ({_JOINED}) GROUP BY way_id HAVING count(*) >= 2)"""
)
def label_candidates(spark, sf_dir):
    d = assemble.label_candidates(assemble.way_geometry(points(spark, sf_dir)))
    return d.select("way_id", *[F.round(F.col("candidates")[i]["lon"], 6).alias(f"lon_{p}") for i, p in enumerate((25, 50, 75))])


@query(
    with_sql("fx_ways", "fx_way_nodes", "fx_nodes")
    + """SELECT coalesce(highway, railway, aeroway, '') AS kind, count(*) AS ways, count(*) FILTER (p.n IS NULL OR p.n < 2) AS short, CAST(sum(CASE WHEN oneway = 'yes' THEN 1 ELSE 0 END) AS BIGINT) AS oneway,
    CAST(sum(CASE WHEN railway IS NOT NULL AND service = 'yard' THEN 1 ELSE 0 END) AS BIGINT) AS yards
    FROM fx_ways w LEFT JOIN (SELECT way_id, count(*) AS n FROM fx_way_nodes x JOIN fx_nodes y ON x.node_id = y.node_id GROUP BY way_id) p ON p.way_id = w.way_id GROUP BY 1"""
)
def entity_counters(spark, sf_dir):
    n = points(spark, sf_dir).groupBy("way_id").agg(F.count("*").alias("n"))
    d = ways(spark, sf_dir).join(n, "way_id", "left")
    yard = C.service_zoom(F.lit(6)) == 13
    return d.groupBy(C.highway_type().alias("kind")).agg(F.count("*").alias("ways"), F.count_if(F.coalesce(F.col("n") < 2, F.lit(True))).alias("short"), F.count_if(C.oneway() == 1).alias("oneway"), F.count_if(yard).alias("yards"))


@query(with_sql("fx_node_tags") + """SELECT node_id, CASE WHEN "natural" IN ('peak', 'volcano') THEN 'point' ELSE 'label' END AS kind FROM fx_node_tags WHERE "natural" IN ('peak', 'volcano') OR (place IS NOT NULL AND name <> '')""")
def node_features(spark, sf_dir):
    d = C.with_tags(table(spark, sf_dir, "fx_node_tags"), "natural", "place", "name")
    symbol = C.one_of("natural", "peak", "volcano")
    return d.filter(symbol | (C.one_of("place", *C.PLACE_RULES) & (C.t("name") != ""))).select("node_id", F.when(symbol, "point").otherwise("label").alias("kind"))


@query(with_sql("fx_ways") + "SELECT way_id, CAST(CASE WHEN oneway = 'yes' THEN 1 WHEN oneway = '-1' THEN 2 ELSE 0 END AS BIGINT) AS oneway, CAST(CASE WHEN oneway = 'yes' THEN 1 WHEN oneway = '-1' THEN 2 WHEN highway IN ('motorway', 'motorway_link') THEN 1 ELSE 0 END AS BIGINT) AS route_oneway, CAST(least(255, coalesce(TRY_CAST(nullif(regexp_extract(maxspeed, '^([0-9]+)', 1), '') AS INT), 0)) AS BIGINT) AS maxspeed FROM fx_ways")
def oneway_maxspeed(spark, sf_dir):
    return longs(ways(spark, sf_dir).select("way_id", C.oneway().alias("oneway"), C.route_oneway().alias("route_oneway"), C.maxspeed().alias("maxspeed")))
