"""Geometry kernels, codecs and file formats, by property and by hand."""

import math
import struct
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.functions import geometry as G
from terrafold.operators import codec
from terrafold.sources import osm_pbf, packs, shapefile

place = st.integers(-5000, 9000)
point = st.tuples(place, place)


@given(st.integers(-(2**40), 2**40))
def test_zigzag_and_varint(n):
    z = codec.zigzag(n)
    assert codec.unzigzag(z) == n
    data = codec.varint(z)
    assert codec.read_varint(data, 0) == (z, len(data))


def test_known_codes():
    assert [codec.zigzag(n) for n in (0, -1, 1, -5)] == [0, 1, 2, 9]
    assert [codec.varint(n).hex() for n in (127, 128, 300)] == ["7f", "8001", "ac02"]


@settings(max_examples=50)
@given(st.lists(st.lists(point, min_size=3, max_size=20), min_size=1, max_size=3), st.integers(0, 255))
def test_tile_round_trip(rings, color):
    blob = codec.encode_tile([codec.encode_shape(3, color, 0x91, 0x80, rings), codec.encode_text(color, 0xFF, 2, -5, 4096, "Été".encode(), (7, 9))])
    shape, text = codec.decode_tile(blob)
    assert [[(p["px"], p["py"]) for p in r] for r in shape["rings"]] == rings
    assert (text["text"], text["shield"], text["font_size"]) == ("Été", [7, 9], 2)
    assert len(codec.decode_tile(blob[:-3])) == 1 and codec.decode_tile(b"NAV2") == []


@settings(max_examples=100)
@given(st.lists(point, min_size=3, max_size=12, unique=True))
def test_clip_stays_inside_and_repeats(ring):
    ring = [*ring, ring[0]]
    cut = G.clip_ring(ring, 0, 0, 4096, 4096)
    assert all(-1e-6 <= v <= 4096 + 1e-6 for p in cut for v in p)
    if cut:
        assert abs(G.ring_area(G.clip_ring(cut, 0, 0, 4096, 4096) or cut) - G.ring_area(cut)) < 1e-3 * (1 + G.ring_area(cut))


@settings(max_examples=100)
@given(st.lists(point, min_size=2, max_size=12))
def test_line_parts_stay_inside(line):
    for part in G.clip_line(line, 0, 0, 4096, 4096):
        assert len(part) >= 2 and all(-1e-6 <= v <= 4096 + 1e-6 for p in part for v in p)


@settings(max_examples=100)
@given(st.lists(point, min_size=2, max_size=30), st.floats(0.5, 500))
def test_simplify_error(line, tolerance):
    short = G.simplify(line, tolerance)
    assert short[0] == line[0] and short[-1] == line[-1]

    def far(p):
        best = math.inf
        for a, b in zip(short, short[1:]):
            dx, dy = b[0] - a[0], b[1] - a[1]
            n = dx * dx + dy * dy
            t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n)) if n else 0
            best = min(best, math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy))
        return best

    assert all(far(p) <= tolerance + 1e-6 for p in line)


@settings(max_examples=100)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12), st.integers(1, 5), st.integers(1, 5)), min_size=1, max_size=8))
def test_union_covers_the_same_cells(shapes):
    boxes = [(x, y, x + w, y + h) for x, y, w, h in shapes]
    cells = lambda b: {(i, j) for i in range(b[0], b[2]) for j in range(b[1], b[3])}
    united = G.union_rectangles(boxes)
    want = set().union(*map(cells, boxes))
    assert set().union(*map(cells, united)) == want and sum(len(cells(b)) for b in united) == len(want)


def test_buffer_covers_the_line():
    rings = G.buffer_line([(0, 0), (100, 0), (100, 50)], 10)
    assert len(rings) == 3 and any(G.inside_ring(50, 9, r[:-1]) for r in rings) and not any(G.inside_ring(50, 11, r[:-1]) for r in rings)


def test_pack_file():
    tiles = [(7, 4, b"NAV1aa"), (5, 3, b"NAV1b")]
    data = packs.build_pack(9, tiles, [1, 65535])
    head, index = packs.index_pack(data)
    assert (head["wide"], head["high"], head["palette"]) == (3, 2, [1, 65535])
    assert {(x, y): data[o : o + n] for x, y, o, n in index} == {(x, y): b for x, y, b in tiles}


def test_graph_file():
    cells = [(-500, 1000, [(1.5, 2.5, 0)], [(3, 40, 50, 2, 0)]), (500, 1000, [(1.0, 2.0, 0), (1.25, 2.25, 1)], [(0, 1, 2, 3, 0)])]
    back = packs.parse_graph(packs.build_graph(cells))
    assert [(c[0], c[2]) for c in back] == [(500, 0), (-500, 2)]  # unsigned order
    assert back[1][3:] == ([(1.5, 2.5, 0)], [(3, 40, 50, 2, 0)])
    assert [c[0] for c in packs.parse_graph(packs.build_graph(cells), (0, 0, 900, 2000))] == [500]


def test_graph_file_of_a_large_cell():
    """More nodes and edges than an entry holds, and a node with more edges than that."""
    import numpy as np

    degree = np.r_[np.ones(70000, int), 0, 140000, 0, 3]
    offset = np.cumsum(degree) - degree
    nodes = [(1.0, 2.0, int(o)) for o in offset]
    edges = [(int(k), int(k) % 7, 1, 2, 0) for k in range(degree.sum())]
    small = (0, 0, [(1.0, 2.0, 0)], [(1, 2, 3, 4, 0)])
    back = packs.parse_graph(packs.build_graph([(500, 500, nodes, edges), small]))
    assert len(back) == 7 and [c[2] for c in back[:2]] == [0, 1]
    got = {}
    for lat, lon, first, n, e in back[1:]:
        assert (lat, lon) == (500, 500) and len(n) <= 65535 and len(e) <= 65535
        for k, (a, b) in enumerate(zip(n, [*n[1:], (0, 0, len(e))])):
            got.setdefault(first + k - 1, []).extend(e[a[2] : b[2]])
    assert {k: len(v) for k, v in got.items()} == dict(enumerate(degree.tolist()))
    assert [x for k in sorted(got) for x in got[k]] == edges


def _field(n, v):
    if isinstance(v, int):
        return codec.varint(n << 3) + codec.varint(v)
    return codec.varint(n << 3 | 2) + codec.varint(len(v)) + v


def _packed(values):
    return b"".join(codec.varint(v) for v in values)


def _delta(values):
    return _packed(codec.zigzag(b - a) for a, b in zip([0, *values], values))


def test_pbf(spark, tmp_path):
    strings = b"".join(_field(1, s) for s in (b"", b"highway", b"primary", b"outer", b"type", b"multipolygon"))
    dense = _field(1, _delta([10, 12])) + _field(8, _delta([425000000, 425000100])) + _field(9, _delta([15000000, 15000300])) + _field(10, _packed([0, 1, 2, 0]))
    way = _field(1, 77) + _field(2, _packed([1])) + _field(3, _packed([2])) + _field(8, _delta([10, 12]))
    rel = _field(1, 5) + _field(2, _packed([4])) + _field(3, _packed([5])) + _field(8, _packed([3])) + _field(9, _delta([77])) + _field(10, _packed([1]))
    block = _field(1, strings) + _field(2, _field(2, dense) + _field(3, way) + _field(4, rel))
    blob = _field(2, len(block)) + _field(3, zlib.compress(block))
    head = _field(1, b"OSMData") + _field(3, len(blob))
    (tmp_path / "a.osm.pbf").write_bytes(struct.pack(">I", len(head)) + head + blob)
    e = osm_pbf.read_pbf(spark, str(tmp_path))
    n = {r["node_id"]: r for r in osm_pbf.nodes(e).collect()}
    assert abs(n[12]["lat"] - 42.50001) < 1e-9 and abs(n[12]["lon"] - 1.50003) < 1e-9 and n[12]["tags"] == {"highway": "primary"}
    assert osm_pbf.way_nodes(osm_pbf.ways(e)).collect() == [(77, 0, 10), (77, 1, 12)]
    r = osm_pbf.relations(e).first()
    assert r["tags"] == {"type": "multipolygon"} and [tuple(m) for m in r["members"]] == [("way", 77, "outer")]


def test_shapefile(spark, tmp_path):
    def record(number, ring):
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        body = struct.pack("<I4dIII", 5, min(xs), min(ys), max(xs), max(ys), 1, len(ring), 0) + b"".join(struct.pack("<2d", *p) for p in ring)
        return struct.pack(">II", number, len(body) // 2) + body

    near = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
    data = b"\0" * 100 + record(1, near) + record(2, [(x + 50, y) for x, y in near]) + record(3, near[:3])
    (tmp_path / "sea.shp").write_bytes(data)
    rows = shapefile.read_polygons(spark, str(tmp_path), (-1, -1, 2, 2)).collect()
    assert [r["poly_id"] for r in rows] == [-1000000001] and len(rows[0]["rings"][0]) == 5


def test_style_file(spark, tmp_path):
    from terrafold.operators import style

    (tmp_path / "s.json").write_text('{"_note": "x", "building": {"zoom": 14, "color": "#d9d0c9"}, "highway=primary": {"priority": 12}}')
    rows = {r["selector"]: r for r in style.read_rules(spark, str(tmp_path / "s.json")).collect()}
    assert set(rows) == {"building", "highway=primary"}
    assert (rows["building"]["zoom"], rows["building"]["priority"], rows["building"]["value"]) == (14, 50, None)
    assert (rows["highway=primary"]["value"], rows["highway=primary"]["zoom"]) == ("primary", 6)


def test_relation_rings(spark):
    from terrafold.operators import assemble

    pts = lambda *p: [{"lon": float(x), "lat": float(y)} for x, y in p]
    lines = spark.createDataFrame([(1, pts((0, 0), (9, 0), (9, 9))), (2, pts((0, 0), (0, 9), (9, 9))), (3, pts((2, 2), (4, 2), (4, 4), (2, 2))), (4, pts((20, 20), (21, 20)))], "way_id long, line array<struct<lon:double,lat:double>>")
    members = spark.createDataFrame([(8, 1, "outer"), (8, 2, ""), (8, 3, "inner"), (8, 4, "outer")], "rel_id long, way_id long, role string")
    (row,) = assemble.relation_rings(members, lines).collect()
    assert len(row["rings"]) == 2 and len(row["rings"][0]) == 5 and len(row["rings"][1]) == 4


def test_split_place_name(spark):
    from terrafold.functions import scalar as S

    got = spark.createDataFrame([("Saint-Jean-de-Luz",), ("Short",), ("Nullebreakhere",)], "n string").select(S.split_place_name("n")).collect()
    assert [r[0] for r in got] == ["Saint-Jean-\nde-Luz", "Short", "Nullebreakhere"]


def test_classification_by_hand(spark):
    from pyspark.sql import functions as F

    from terrafold.operators import classify as C

    cases = [({"building": "yes", "amenity": "school"}, "buildings"), ({"landuse": "reservoir"}, "water"), ({"landuse": "grass", "natural": "beach"}, "surface")]
    d = spark.createDataFrame([(i, tags) for i, (tags, _) in enumerate(cases)], "i int, tags map<string,string>").withColumn("layer", C.layer())
    rows = d.select("i", "layer", C.polygon_nibble(F.col("layer")).alias("n")).orderBy("i").collect()
    assert [r["layer"] for r in rows] == [x for _, x in cases] and [r["n"] for r in rows] == [3, 7, 5]


def test_import_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    assert subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) > 50"], cwd=root).returncode == 0
