"""Scalar functions as Spark columns; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = 3.141592653589793
#: Metres of the earth's radius and of one degree in flat distances.
EARTH_M, DEGREE_M = 6371000.0, 111319.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def _trunc(x: Column) -> Column:
    """Toward zero, as long."""
    return x.cast("long")


# -- integers on the wire ------------------------------------------------------


def zigzag_encode(n) -> Column:
    n = _c(n).cast("long")
    return F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63))


def zigzag_decode(z) -> Column:
    z = _c(z).cast("long")
    return F.shiftrightunsigned(z, 1).bitwiseXOR(-z.bitwiseAND(F.lit(1)))


def varint_length(v, most: int = 9) -> Column:
    """Bytes of the LEB128 form of a non-negative long, ``most`` where it has more; null for null."""
    v = _c(v).cast("long")
    out = F.when(v.isNotNull(), most)
    for k in range(most - 1, 0, -1):
        out = F.when(v < (1 << (7 * k)), k).otherwise(out)
    return out


def varint_hex(v, most: int = 9) -> Column:
    """LEB128 bytes in upper-case hex, the first ``most`` of them closed by the last."""
    v, n = _c(v).cast("long"), varint_length(v, most)
    byte = lambda i: F.call_function("shiftrightunsigned", v, (i * 7).cast("int")).bitwiseAND(F.lit(127)) + F.when(i < n - 1, 128).otherwise(0)
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lpad(F.hex(byte(i)), 2, "0")), "")


# -- projection ----------------------------------------------------------------


def lon_to_x(lon, z) -> Column:
    return (_c(lon) + 180.0) / 360.0 * F.pow(F.lit(2.0), _c(z))


def lat_to_y(lat, z) -> Column:
    return (F.lit(1.0) - F.asinh(F.tan(F.radians(_c(lat)))) / PI) / 2.0 * F.pow(F.lit(2.0), _c(z))


def tile_x_to_lon(x, z) -> Column:
    return _c(x) / F.pow(F.lit(2.0), _c(z)) * 360.0 - 180.0


def tile_y_to_lat(y, z) -> Column:
    return F.degrees(F.atan(F.sinh(F.lit(PI) * (F.lit(1.0) - F.lit(2.0) * _c(y) / F.pow(F.lit(2.0), _c(z))))))


def mercator_y(lat) -> Column:
    limit = 0.999 * PI / 2
    a = F.greatest(F.lit(-limit), F.least(F.lit(limit), F.radians(_c(lat))))
    return F.log(F.tan(a) + F.lit(1.0) / F.cos(a))


def tile_px(f, tile) -> Column:
    """Place inside a tile, 0 to 4096, toward zero."""
    return _trunc((_c(f) - _c(tile)) * 4096.0)


def label_px(lon, x, z) -> Column:
    west, east = tile_x_to_lon(x, z), tile_x_to_lon(_c(x) + 1, z)
    return _trunc((_c(lon) - west) / (east - west) * 4096.0)


def label_py(lat, y, z) -> Column:
    top, bottom = mercator_y(tile_y_to_lat(y, z)), mercator_y(tile_y_to_lat(_c(y) + 1, z))
    return _trunc((top - mercator_y(lat)) / (top - bottom) * 4096.0)


# -- colors --------------------------------------------------------------------


def hex_to_rgb565(h) -> Column:
    """RGB565 of ``#rrggbb``; 65535 for anything else."""
    h = _c(h)
    part = lambda i: F.conv(F.substring(h, i, 2), 16, 10).cast("long")
    packed = F.shiftleft(F.shiftright(part(2), 3), 11) + F.shiftleft(F.shiftright(part(4), 2), 5) + F.shiftright(part(6), 3)
    return F.when(h.rlike("^#[0-9A-Fa-f]{6}"), packed).otherwise(F.lit(65535))


def _channels(c: Column) -> tuple[Column, Column, Column]:
    c = c.cast("long")
    return F.shiftright(c, 11).bitwiseAND(F.lit(31)), F.shiftright(c, 5).bitwiseAND(F.lit(63)), c.bitwiseAND(F.lit(31))


def rgb565_hex(c) -> Column:
    """``#rrggbb`` with the low bits left zero."""
    r, g, b = _channels(_c(c))
    return F.lower(F.concat(F.lit("#"), *[F.lpad(F.hex(F.shiftleft(v, s)), 2, "0") for v, s in ((r, 3), (g, 2), (b, 3))]))


def _blend(c, change) -> Column:
    r, g, b = _channels(_c(c))
    full = [F.floor(r * 255 / 31), F.floor(g * 255 / 63), F.floor(b * 255 / 31)]
    r, g, b = [change(v) for v in full]
    return F.shiftleft(F.shiftright(r, 3), 11) + F.shiftleft(F.shiftright(g, 2), 5) + F.shiftright(b, 3)


def lighten_rgb565(c, factor: float = 0.4) -> Column:
    f = F.lit(factor).cast("float")
    return _blend(c, lambda v: F.least(F.lit(255).cast("long"), (v.cast("float") + (255 - v).cast("float") * f).cast("long")))


def darken_rgb565(c, factor: float = 0.4) -> Column:
    f = F.lit(1.0).cast("float") - F.lit(factor).cast("float")
    return _blend(c, lambda v: F.greatest(F.lit(0).cast("long"), (v.cast("float") * f).cast("long")))


def darken_channel(v, amount: float = 0.15) -> Column:
    return F.greatest(F.lit(0).cast("long"), (_c(v) * (1.0 - amount)).cast("long"))


# -- style numbers -------------------------------------------------------------


def pack_zoom_priority(zoom, priority) -> Column:
    return F.least(_c(zoom), F.lit(15)) * 16 + F.least(_c(priority), F.lit(15))


def meters_to_pixels(width, zoom) -> Column:
    """Half pixels of a width in metres at 45 degrees, 1 to 15."""
    z = _c(zoom)
    raw = _c(width) / (F.lit(156543.0) * F.cos(F.lit(45.0 * PI / 180.0)) / F.pow(F.lit(2.0), z)) * F.when(z >= 13, 0.7).otherwise(1.0)
    return F.least(F.lit(15), F.greatest(F.lit(1), F.floor(raw + 0.5))).cast("long")


def leading_int(s) -> Column:
    """The integer a text begins with, null if there is none."""
    return F.expr("try_cast(nullif(regexp_extract(%s, '^\\\\s*([+-]?[0-9]+)', 1), '') AS int)" % _name(s))


def _name(s) -> str:
    return s if isinstance(s, str) else s._jc.toString()


def leading_double(s) -> Column:
    return F.expr("try_cast(nullif(regexp_extract(%s, '^\\\\s*([+-]?[0-9]+[.]?[0-9]*)', 1), '') AS double)" % _name(s))


def population(s: str) -> Column:
    """Integer of a text without commas and blanks; 0 if it has none."""
    return F.coalesce(F.expr(f"try_cast(nullif(regexp_extract(regexp_replace({s}, '[, ]', ''), '^([+-]?[0-9]+)', 1), '') AS int)"), F.lit(0)).cast("long")


def split_place_name(name) -> Column:
    """A break at the blank, or after the hyphen, nearest to the middle byte of a long name.

    Works on bytes in Latin-1 form so that places count as in UTF-8.
    """
    raw = F.decode(F.encode(_c(name), "UTF-8"), "ISO-8859-1")
    n, mid = F.length(raw), F.floor(F.length(raw) / 2)
    at = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(raw, i + 1, F.lit(1)).isin(" ", "-"))
    best = F.array_min(F.transform(at, lambda i: F.struct(F.abs(i - mid).alias("far"), i.alias("i")))).getField("i")
    hyphen = F.substring(raw, best + 1, F.lit(1)) == "-"
    head = F.substring(raw, F.lit(1), F.when(hyphen, best + 1).otherwise(best))
    broken = F.concat(head, F.lit("\n"), F.substring(raw, best + 2, n))
    return F.when((n > 12) & (best > 0), F.decode(F.encode(broken, "ISO-8859-1"), "UTF-8")).otherwise(_c(name))


def byte_prefix(text, n: int) -> Column:
    """At most n bytes of the UTF-8 form, as binary."""
    return F.substring(F.encode(_c(text), "UTF-8"), F.lit(1), F.lit(n))


# -- distances and graph numbers -----------------------------------------------


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp, dl = F.radians(_c(lat2) - _c(lat1)), F.radians(_c(lon2) - _c(lon1))
    a = F.sin(dp / 2.0) * F.sin(dp / 2.0) + F.cos(p1) * F.cos(p2) * F.sin(dl / 2.0) * F.sin(dl / 2.0)
    return F.lit(2.0 * EARTH_M) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def flat_distance_m(lat1, lon1, lat2, lon2) -> Column:
    mean = F.radians((_c(lat1) + _c(lat2)) / 2.0)
    dy, dx = (_c(lat2) - _c(lat1)) * DEGREE_M, (_c(lon2) - _c(lon1)) * DEGREE_M * F.cos(mean)
    return F.sqrt(dx * dx + dy * dy)


def cell_e4(v) -> Column:
    """South or west border, in 1/10000 degree, of the 0.05 degree cell (single precision)."""
    return F.floor(_c(v).cast("float") * F.lit(20).cast("float")).cast("long") * 500


def snap_e4(v, step: int = 500) -> Column:
    return F.floor(_c(v) * 10000.0 / step).cast("long") * step


def road_class(highway) -> Column:
    h = _c(highway)
    return (
        F.when(h.isin("motorway", "motorway_link"), 6).when(h.isin("trunk", "trunk_link"), 5).when(h.isin("primary", "primary_link"), 4)
        .when(h.isin("secondary", "secondary_link"), 3).when(h.isin("tertiary", "tertiary_link", "unclassified"), 2).when(h.isin("residential", "living_street"), 1).otherwise(0)
    )


# km/h of each profile by road class 0 to 6.
SPEEDS_KMH = {"CAR": (20, 25, 50, 70, 90, 110, 130), "WALK": (5, 5, 5, 5, 5, 0, 0), "BIKE": (10, 15, 18, 20, 22, 0, 0)}


def speed_ms(profile, hw_class, maxspeed) -> Column:
    """Metres a second; 0 where the profile may not go."""
    p, k, m = _c(profile), _c(hw_class), _c(maxspeed)
    kmh = F.lit(0.0)
    for name, row in SPEEDS_KMH.items():
        kmh = F.when(p == name, F.element_at(F.array(*[F.lit(float(v)) for v in row]), (k + 1).cast("int"))).otherwise(kmh)
    return F.when((p == "CAR") & (m > 0) & (m < 255), m.cast("double")).otherwise(kmh) / 3.6


def edge_cost(dist, speed) -> Column:
    """Tenths of a second."""
    return F.floor(_c(dist) / _c(speed) * 10.0).cast("long")


# -- rings ---------------------------------------------------------------------


def ring_area(ring, x: str = "lon", y: str = "lat") -> Column:
    """Shoelace area of an array of points, closed or not."""
    r = _c(ring)
    turned = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))
    parts = F.zip_with(r, turned, lambda a, b: a.getField(x) * b.getField(y) - b.getField(x) * a.getField(y))
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)) / 2.0


def point_in_ring(x, y, ring) -> Column:
    """Parity of crossings of a ray to the east."""
    r, px, py = _c(ring), _c(x), _c(y)
    back = F.concat(F.slice(r, F.size(r), F.lit(1)), F.slice(r, F.lit(1), F.size(r) - 1))
    hit = F.zip_with(r, back, lambda a, b: F.when(((a["lat"] > py) != (b["lat"] > py)) & (px < (b["lon"] - a["lon"]) * (py - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"]), 1).otherwise(0))
    return F.aggregate(hit, F.lit(0), lambda s, v: s + v) % 2 == 1


def segment_distance(px, py, ax, ay, bx, by) -> Column:
    px, py, ax, ay, bx, by = map(_c, (px, py, ax, ay, bx, by))
    dx, dy = bx - ax, by - ay
    t = F.when((dx == 0) & (dy == 0), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)))))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def min_area_deg2(z) -> Column:
    """Least area of a polygon's shell, in square degrees, before projection."""
    z = _c(z)
    pixel = F.lit(360.0) / (F.pow(F.lit(2.0), z - 1) * 256.0)
    return F.when(z >= 14, 0.0).otherwise(pixel * pixel * F.when(z <= 7, 2.5).when(z == 8, 1.8).when(z == 9, 2.5).otherwise(3.0))


def min_area_px(z) -> Column:
    """Least area of a polygon in a tile, in square pixels."""
    z = _c(z)
    return F.lit(2.0) * F.when(z <= 7, 8.0).when(z == 8, 6.0).when(z <= 11, 8.0).when(z == 12, 5.0).when(z == 13, 2.0).when(z == 14, 0.5).otherwise(0.1)
