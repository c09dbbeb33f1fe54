"""Every registered map query with SQL against DuckDB on the smallest tables."""

import pytest

from terrafold.plans import catalog


def compare(spark, duck, sf_dir, run, sql):
    df = run(spark, sf_dir)
    names = sorted(df.columns)
    rel = duck.sql(sql)
    assert sorted(rel.columns) == names
    got = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    cols = ", ".join(f'"{c}"' for c in names)
    assert got == sorted(map(repr, duck.sql(f"SELECT {cols} FROM ({sql})").fetchall()))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    compare(spark, duck, sf_dir, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


def test_every_sql_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_dissolve_conserves_what_it_covers(spark, sf_dir):
    rows = catalog.QUERIES["building_dissolve"](spark, sf_dir).collect()
    assert rows and all(r["outputs"] >= 1 and r["area"] >= 0 for r in rows)


def test_tiles_decode_to_what_was_encoded(spark, sf_dir):
    r = catalog.QUERIES["tile_decode_roundtrip"](spark, sf_dir).collect()
    assert r and all(x["features"] == x["same"] > 0 for x in r)


def test_pack_index_is_contiguous(spark, sf_dir):
    rows = sorted((r["z"], r["y"], r["x"], r["offset"], r["size"]) for r in catalog.QUERIES["tile_pack_files"](spark, sf_dir).collect())
    assert rows
    for a, b in zip(rows, rows[1:]):
        if a[0] == b[0]:
            assert a[3] + a[4] == b[3]


def test_labels_do_not_overlap(spark, sf_dir):
    rows = catalog.QUERIES["label_placement"](spark, sf_dir).collect()
    for z in {r["z"] for r in rows}:
        pixel = 360.0 / 2**z / 256
        boxes = [(r["lon"], r["lat"], pixel * 7 * r["n_bytes"] / 2, pixel * 11) for r in rows if r["z"] == z]
        for i, a in enumerate(boxes):
            for b in boxes[:i]:
                assert abs(a[0] - b[0]) >= a[2] + b[2] - 1e-9 or abs(a[1] - b[1]) >= a[3] + b[3] - 1e-9


def test_reach_counts(spark, sf_dir):
    rows = catalog.QUERIES["cell_reachability"](spark, sf_dir).collect()
    assert rows and all(1 <= r["reached"] <= r["nodes"] for r in rows)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(5).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())


def test_whole_tiles_decode_to_what_was_encoded(spark, sf_dir):
    rows = {r["kind"]: r for r in catalog.QUERIES["tile_whole_decoded"](spark, sf_dir).collect()}
    assert set(rows) == {"background", "polygon", "line", "symbol", "label"}
    assert all(r["same"] == r["records"] > 0 for r in rows.values())


def test_decks_lie_where_bridges_do(spark, sf_dir):
    rows = catalog.QUERIES["deck_tiles"](spark, sf_dir).collect()
    # Each line record of a bridge has a deck of one quad a segment at least.
    assert rows and all(r["decks"] >= r["lines"] > 0 for r in rows)


def test_route_searches(spark, sf_dir):
    """Lengths of paths against a plain search over the same edges; the guided search settles no more nodes."""
    import heapq


    from terrafold.operators import route
    from terrafold.plans import graph

    asked, edges = graph._placed(spark, sf_dir), graph._celled_edges(spark, sf_dir)
    cells = {}
    for r in route.request_cells(asked).select("request_id", "lat_e4", "lon_e4").collect():
        cells.setdefault(r["request_id"], set()).add((r["lat_e4"], r["lon_e4"]))
    links = edges.select("profile", "lat_e4", "lon_e4", "src_id", "dst_id", "cost", "dist_m").collect()
    found = {r["request_id"]: r for r in route.shortest_paths(asked, edges).collect()}
    guided = {r["request_id"]: r for r in route.shortest_paths(asked, edges, speed=36.1).collect()}
    places = {r["node_id"]: (r["lon"], r["lat"]) for r in graph.table(spark, sf_dir, "fx_nodes").collect()}
    lengths = {r["request_id"]: r["length_m"] for r in catalog.QUERIES["route_length"](spark, sf_dir).collect()}
    rows = asked.collect()
    assert len(rows) == len(found) == len(guided) == 10
    for r in rows:
        out = {}
        for e in links:
            if e["profile"] == r["profile"] and (e["lat_e4"], e["lon_e4"]) in cells[r["request_id"]]:
                out.setdefault(e["src_id"], []).append((e["dst_id"], e["cost"]))
        best, todo, done = {r["source"]: 0}, [(0, r["source"])], set()
        while todo:
            c, n = heapq.heappop(todo)
            if n not in done:
                done.add(n)
                for b, w in out.get(n, ()):
                    if c + w < best.get(b, 1 << 60):
                        best[b] = c + w
                        heapq.heappush(todo, (c + w, b))
        got, led = found[r["request_id"]], guided[r["request_id"]]
        assert got["cost"] == (best[r["target"]] if r["target"] in done else None)
        if got["cost"] is None:
            continue
        assert led["visited"] <= got["visited"] and led["cost"] >= got["cost"]
        total = 0
        for a, b in zip(got["path"], got["path"][1:]):
            total += min(w for x, w in out[a] if x == b)
        assert total == got["cost"]
        import math

        metres = 0.0
        for a, b in zip(got["path"], got["path"][1:]):
            (x0, y0), (x1, y1) = places[a], places[b]
            metres += math.hypot((x1 - x0) * 111319.0 * math.cos(math.radians((y0 + y1) / 2)), (y1 - y0) * 111319.0)
        assert abs(lengths[r["request_id"]] - metres) <= 0.06


def test_varints_beyond_six_bytes(spark, tmp_path):
    """Null and large ids, as many times the smallest tables have them, against the query's SQL."""
    import duckdb

    from pyspark.sql import functions as F

    from terrafold.functions import scalar as S

    con = duckdb.connect()
    ids = "(VALUES (NULL), (0), (70086), (70087), (792656), (792657), (5999999), (90000000)) AS t(event_id)"
    con.sql(f"COPY (SELECT CAST(event_id AS BIGINT) AS event_id FROM {ids}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    compare(spark, con, str(tmp_path), catalog.QUERIES["varint_length"], catalog.ORACLE_SQL["varint_length"])
    # The function itself is not bounded by the query's six bytes.
    row = spark.range(1).select(S.varint_length(F.lit(1 << 42)).alias("n"), S.varint_hex(F.lit(1 << 42)).alias("hex")).first()
    assert (row["n"], row["hex"]) == (7, "80808080808001")


def joined_rows(df):
    """Rows that the joins of a collected frame have put out."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            rows += node.metrics().apply("numOutputRows").value() if "Join" in name else 0
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_nearest_nodes_of_dense_cells(spark):
    """Dense, sparse and repeated nodes against brute force, with fewer pairs than points times nodes."""
    import numpy as np
    import pandas as pd

    from terrafold.operators import route

    rng = np.random.default_rng(4)
    at = np.concatenate([rng.uniform((1.40, 42.40), (1.45, 42.45), (2500, 2)), rng.normal((1.7, 42.6), 1e-4, (500, 2)), rng.uniform((-1, -1), (1, 1), (60, 2)), rng.uniform((9, 69.9), (9.2, 70), (40, 2))])
    at = np.concatenate([at, at[:200], [[3.0, 10.0], [3.0, 10.002], [3.0, 10.002]]])
    ask = np.concatenate([rng.uniform((1.39, 42.39), (1.46, 42.46), (1500, 2)), rng.normal((1.7, 42.6), 3e-2, (100, 2)), rng.uniform((-1, -1), (1, 1), (80, 2)), rng.uniform((9, 69.9), (9.2, 70), (40, 2)), at[:50], [[3.0, 10.001], [100.0, 80.0]]])
    ids = rng.permutation(len(at))
    nodes = spark.createDataFrame(pd.DataFrame({"node_id": ids, "lon": at[:, 0], "lat": at[:, 1]}))
    points = spark.createDataFrame(pd.DataFrame({"request_id": range(len(ask)), "lon": ask[:, 0], "lat": ask[:, 1]}))
    cells = lambda v: np.floor(v * 10000.0 / 500)
    want = {}
    for i, (lon, lat) in enumerate(ask):
        near = np.flatnonzero((abs(cells(at[:, 0]) - cells(lon)) <= 1) & (abs(cells(at[:, 1]) - cells(lat)) <= 1))
        if len(near):
            dy, dx = (at[near, 1] - lat) * 111319.0, (at[near, 0] - lon) * 111319.0 * np.cos(np.radians((at[near, 1] + lat) / 2))
            want[i] = min(zip(np.round(np.sqrt(dx * dx + dy * dy), 6), ids[near]))[1]
    found = route.nearest_nodes(points, nodes, "request_id")
    assert {r["request_id"]: r["node_id"] for r in found.collect()} == want
    assert joined_rows(found) < 0.25 * len(ask) * len(at)


def test_searches_from_both_ends():
    """Costs from both ends against one way, with free, parallel and one-way edges and cells left out, in little memory."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from terrafold.operators import route

    def table(rng, nodes, n, most):
        src, dst = rng.integers(0, nodes, (2, n)) * 7
        return pa.table({"src_id": src, "dst_id": dst, "cost": rng.integers(0, most, n), "dist_m": rng.integers(0, 99, n).astype(np.int32), "lat_e4": src % 5 * 500, "lon_e4": src % 3 * 500})

    rng, reached = np.random.default_rng(8), 0
    for k in range(300):
        t = table(rng, 40, 20 + k % 100, 3 + k)
        roads, edges = route._Roads(t), t.to_pylist()
        box = {"lat_lo": 0, "lat_hi": 500 * int(rng.integers(2, 5)), "lon_lo": 0, "lon_hi": 500 * int(rng.integers(1, 3))}
        row = box | {"source": int(rng.integers(0, 41)) * 7, "target": int(rng.integers(0, 41)) * 7}
        one, both = (route._search(roads, row, None, x) for x in (False, True))
        assert one[0] == both[0]
        reached += one[0] is not None
        for cost, metres, _, path in (one, both):
            legs = [min((e["cost"], e["dist_m"]) for e in edges if (e["src_id"], e["dst_id"]) == ab and e["lat_e4"] <= box["lat_hi"] and e["lon_e4"] <= box["lon_hi"]) for ab in zip(path, path[1:])]
            assert (cost or 0, metres) == (sum(c for c, _ in legs), sum(m for _, m in legs))
            assert (path[:1], path[-1:]) == (([], []) if cost is None else ([row["source"]], [row["target"]]))
    assert reached > 30
    t = table(rng, 20000, 300000, 5000)
    tracemalloc.start()
    roads = route._Roads(t)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 50 * 300000 and peak < 120 * 300000
    row = {"lat_lo": 0, "lat_hi": 2500, "lon_lo": 0, "lon_hi": 1500, "source": int(roads.nodes[5]), "target": int(roads.nodes[9000])}
    one, both = (route._search(roads, row, None, x) for x in (False, True))
    assert one[0] == both[0] is not None and both[2] < 0.2 * one[2]


def test_graph_files_of_large_cells(spark, sf_dir, monkeypatch):
    """Edges come back from cells that take several entries, in pieces and from whole files."""
    from terrafold.sources import packs

    want = sorted(map(tuple, catalog.QUERIES["graph_file_edges"](spark, sf_dir).collect()))
    made = []
    monkeypatch.setattr(packs, "PART", 40)
    monkeypatch.setattr(packs, "graph_pieces", lambda cells, real=packs.graph_pieces: made.append(cells) or real(cells))
    assert sorted(map(tuple, catalog.QUERIES["graph_file_edges"](spark, sf_dir).collect())) == want
    cells = made[0]
    assert cells.count() > cells.select("profile", "lat_e4", "lon_e4").distinct().count()
    assert cells.agg({"nodes": "max"}).first()[0] <= 40
    assert sorted(map(tuple, packs.read_graph_files(packs.graph_files(cells)).collect())) == want
    box = (424000, 14000, 424500, 15000)
    assert sorted(map(tuple, packs.read_graph_files(packs.graph_files(cells), box).collect())) == [r for r in want if box[0] <= r[1] <= box[2] and box[1] <= r[2] <= box[3]]
