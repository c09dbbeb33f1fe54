"""Classification of tagged entities: layer, z-order nibble, filters, as native columns.

Tags are a ``MAP<STRING,STRING>`` column named ``tags``.  Cascades are CASE
expressions, so filters on them are pushed and nothing leaves code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S

# Fixed values of the classification.
AREA_KEYS = ("building", "landuse", "water", "amenity", "leisure", "natural", "waterway", "man_made", "aeroway")
MAJOR_ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary")
FOOT_WAYS = ("pedestrian", "footway", "cycleway", "steps", "platform")
UNDERGROUND_COLOR = 0xD69A
ROUTABLE = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "service", "track", "road", "footway", "path", "cycleway", "pedestrian", "steps")


def t(key: str) -> Column:
    return F.try_element_at(F.col("tags"), F.lit(key))


def has(key: str) -> Column:
    return t(key).isNotNull()


def one_of(key: str, *values: str) -> Column:
    return F.coalesce(t(key).isin(*values), F.lit(False))


def with_tags(df: DataFrame, *keys: str) -> DataFrame:
    """Gather the named columns (null: absent) into the map column ``tags``."""
    pairs = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])
    return df.withColumn("tags", F.map_filter(pairs, lambda _, v: v.isNotNull()))


def layer() -> Column:
    """First match of the layer cascade; '' where none holds."""
    return (
        F.when(one_of("natural", "water", "bay") | has("waterway") | has("water") | one_of("landuse", "reservoir"), "water")
        .when(has("highway"), "roads")
        .when(has("railway") | has("aerialway"), "roads")
        .when(has("boundary") | has("admin_level"), "")
        .when(one_of("place", "island", "islet"), "islands")
        .when(has("place"), "places")
        .when(has("building") | one_of("aeroway", "hangar") | one_of("man_made", "tower"), "buildings")
        .when(one_of("aeroway", "aerodrome"), "aeroways")
        .when(one_of("amenity", "parking", "parking_space"), "parking")
        .when(has("amenity"), "amenities")
        .when(one_of("leisure", "pitch"), "pitch")
        .when(has("leisure"), "leisure")
        .when(one_of("natural", "grassland") | one_of("landuse", "grass", "meadow"), "surface")
        .when(has("landuse"), "landuse")
        .when(has("bridge") | has("tunnel") | has("aeroway") | one_of("man_made", "bridge", "embankment", "pier"), "infrastructure")
        .when(has("natural"), "terrain")
        .otherwise("")
    )


def polygon_nibble(of: Column) -> Column:
    """Z-order nibble of a polygon: overrides from the strongest down, then the layer's own."""
    return (
        F.when(one_of("bridge", "yes", "viaduct") | one_of("man_made", "bridge"), 9)
        .when(one_of("leisure", "track"), 6)
        .when(one_of("aeroway", "apron"), 2)
        .when(one_of("aeroway", "aerodrome"), 1)
        .when(one_of("amenity", "school", "college", "university"), 3)
        .when(one_of("natural", "wood") | one_of("landuse", "forest"), 5)
        .when(one_of("natural", "grassland", "scrub"), 5)
        .when(one_of("landuse", "grass", "meadow", "village_green"), 5)
        .when(one_of("natural", "beach", "wetland"), 4)
        .when(one_of("leisure", "playground"), 4)
        .when(one_of("leisure", "park", "nature_reserve"), 1)
        .when(one_of("landuse", "cemetery") | one_of("amenity", "grave_yard"), 3)
        .when(one_of("landuse", "garages"), 3)
        .when(one_of("landuse", "farmland", "farmyard"), 4)
        .when(one_of("landuse", "residential", "industrial", "brownfield", "construction"), 1)
        .when(one_of("landuse", "retail"), 3)
        .when(one_of("landuse", "commercial"), 1)
        .when(of == "aeroways", 1)
        .when(of.isin("leisure", "amenities"), 3)
        .when(of.isin("pitch", "surface"), 4)
        .when(of == "infrastructure", 6)
        .when(of.isin("buildings", "water"), 7)
        .otherwise(2)
    )


def highway_type() -> Column:
    return F.coalesce(t("highway"), t("railway"), t("aeroway"), t("aerialway"), F.lit(""))


def width_m() -> Column:
    """Metres from ``width``, else 3.5 a lane, else 0."""
    tags = "try_element_at(tags, '%s')"
    lanes = S.leading_int(tags % "lanes").cast("double") * 3.5
    return F.coalesce(S.leading_double(tags % "width"), lanes, F.lit(0.0))


def _level(key: str) -> Column:
    return F.coalesce(S.leading_int(f"try_element_at(tags, '{key}')"), F.lit(0))


def underground_polygon() -> Column:
    return (_level("level") < 0) | ((has("tunnel") | has("covered")) & (_level("layer") < 0))


def underground_line() -> Column:
    return one_of("tunnel", "yes", "culvert") | (_level("layer") < 0) | (_level("level") < 0)


def underground_dropped(of: Column) -> Column:
    """Underground water and foot ways are not drawn; other lines only change color."""
    return underground_line() & ((of == "water") | one_of("highway", *FOOT_WAYS))


def is_bridge() -> Column:
    return one_of("bridge", "yes", "viaduct")


def is_area(closed: Column, of: Column) -> Column:
    """Whether a closed way of four or more points is a polygon."""
    keyed = one_of("area", "yes")
    for k in AREA_KEYS:
        keyed = keyed | has(k)
    return closed & keyed & ~one_of("highway", *MAJOR_ROADS) & ~has("place") & ~one_of("aeroway", "runway", "taxiway", "helipad") & ~of.isin("boundaries", "places")


def service_zoom(zoom: Column) -> Column:
    minor = has("railway") & one_of("service", "yard", "siding", "spur", "crossover")
    return F.when(minor, F.greatest(zoom, F.lit(13))).otherwise(zoom)


def oneway() -> Column:
    return F.when(one_of("oneway", "yes", "1", "true"), 1).when(one_of("oneway", "-1", "reverse"), 2).otherwise(0)


def route_oneway() -> Column:
    """For routing: an absent tag means one way on motorways."""
    return F.when(has("oneway"), oneway()).when(one_of("highway", "motorway", "motorway_link"), 1).otherwise(0)


def maxspeed() -> Column:
    """Leading integer, at most 255; 0 if there is none or it is negative."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.coalesce(S.leading_int("try_element_at(tags, 'maxspeed')"), F.lit(0))))


def area_kept(of: Column) -> Column:
    placed = ~has("place") | one_of("place", "island", "islet")
    return ~has("highway") & ~has("boundary") & placed & ~of.isin("", "boundaries")


def water_relation() -> Column:
    return one_of("type", "multipolygon") & (one_of("natural", "water", "bay") | has("waterway") | has("water") | one_of("landuse", "reservoir"))


def accessible(profile: Column, highway: Column) -> Column:
    fast = highway.isin("motorway", "motorway_link", "trunk", "trunk_link")
    return (
        F.when(profile == "WALK", ~fast)
        .when(profile == "BIKE", ~fast & ~highway.isin("footway", "steps"))
        .otherwise(~highway.isin("footway", "cycleway", "pedestrian", "steps", "path"))
    )


# -- places and road labels ----------------------------------------------------

# Font and (least population, zoom) rules of each kind of place.
PLACE_RULES = {
    "city": (2, ((1000000, 4), (500000, 5), (100000, 6), (0, 8))),
    "town": (1, ((50000, 8), (15000, 9), (5000, 10), (0, 11))),
    "village": (0, ((2000, 11), (500, 12), (0, 13))),
    "suburb": (0, ((0, 12),)),
    "hamlet": (0, ((0, 14),)),
}


def place_font(place: Column) -> Column:
    out = F.lit(None).cast("int")
    for kind, (font, _) in PLACE_RULES.items():
        out = F.when(place == kind, font).otherwise(out)
    return out


def place_zoom(place: Column, people: Column) -> Column:
    out = F.lit(None).cast("int")
    for kind, (_, rules) in PLACE_RULES.items():
        zoom = F.lit(None).cast("int")
        for least, z in reversed(rules):
            zoom = F.when(people >= least, z).otherwise(zoom)
        out = F.when(place == kind, zoom).otherwise(out)
    return out


def place_priority(people: Column) -> Column:
    return F.when(people >= 500000, 15).when(people >= 100000, 14).when(people >= 15000, 13).otherwise(12)


def road_label_wanted() -> Column:
    ref, number = t("ref"), S.leading_int("substring(try_element_at(tags, 'ref'), 2)")
    old = F.coalesce(t("old_ref").startswith("N"), F.lit(False))
    named = ref.startswith("A") | ref.startswith("N") | (ref.startswith("D") & F.coalesce(number.between(1000, 1999), F.lit(False)) & old)
    return F.coalesce(named, F.lit(False)) & one_of("highway", "motorway", "trunk", "primary", "secondary")
