"""NPK2 tile packs and routing-graph files: writers and readers.

Parquet is the primary form of both; these are the exchange formats.  Files
are written and read through Hadoop's file systems or Spark's binaryFile
source, so they may lie in any store.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

GRAPH_HEADER, GRAPH_CELL, GRAPH_NODE, GRAPH_EDGE = struct.Struct("<4sII5I"), struct.Struct("<iiIHIH"), struct.Struct("<ffI"), struct.Struct("<IIHBB")
#: Nodes and edges in arrays of the same bytes.
NODES = np.dtype([("lat", "<f4"), ("lon", "<f4"), ("offset", "<u4")])
EDGES = np.dtype([("dst", "<u4"), ("cost", "<u4"), ("dist", "<u2"), ("flags", "u1"), ("zero", "u1")])
#: Most nodes, and edges, of an entry of the index.
ENTRY = 0xFFFF


def build_pack(z: int, tiles: list[tuple[int, int, bytes]], palette: list[int]) -> bytes:
    """One pack: header, flat index (gaps are zero), palette, blobs row by row."""
    xs, ys = [t[0] for t in tiles], [t[1] for t in tiles]
    x0, y0 = min(xs), min(ys)
    wide, high = max(xs) - x0 + 1, max(ys) - y0 + 1
    index, body = [(0, 0)] * (wide * high), bytearray()
    start = 23 + 8 * wide * high + 2 * len(palette)
    for x, y, blob in sorted(tiles, key=lambda t: (t[1], t[0])):
        index[(y - y0) * wide + x - x0] = (start + len(body), len(blob))
        body += blob
    head = b"NPK2" + struct.pack("<BIIIIH", z, wide, high, x0, y0, len(palette))
    return head + b"".join(struct.pack("<II", *e) for e in index) + struct.pack(f"<{len(palette)}H", *palette) + bytes(body)


def index_pack(data: bytes) -> tuple[dict, list[tuple[int, int, int, int]]]:
    """Header fields with the palette, and (x, y, offset, size) of the tiles present."""
    if data[:4] != b"NPK2":
        return {}, []
    z, wide, high, x0, y0, colors = struct.unpack_from("<BIIIIH", data, 4)
    palette = list(struct.unpack_from(f"<{colors}H", data, 23 + 8 * wide * high))
    entries = struct.iter_unpack("<II", data[23 : 23 + 8 * wide * high])
    return {"z": z, "wide": wide, "high": high, "palette": palette}, [(x0 + i % wide, y0 + i // wide, o, n) for i, (o, n) in enumerate(entries) if n]


def pack_tiles(tiles: DataFrame, palette: DataFrame) -> DataFrame:
    """``z, pack``: one pack a zoom from z, x, y, blob and z, idx, color565.

    The format asks for one file a zoom, so a zoom is one group; use the tile
    table itself where zooms are large.
    """
    p = palette.groupBy("z").agg(F.array_sort(F.collect_list(F.struct("idx", "color565"))).alias("p")).select("z", F.transform("p", lambda c: c["color565"]).alias("palette"))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(r.x), int(r.y), bytes(r.blob)) for r in pdf.itertuples()]
        return pd.DataFrame([{"z": key[0], "pack": build_pack(int(key[0]), rows, [int(c) for c in pdf["palette"].iloc[0]])}])

    return tiles.select("z", "x", "y", "blob").join(p, "z").groupBy("z").applyInPandas(run, "z int, pack binary")


def write_files(spark: SparkSession, rows: DataFrame, folder: str, name) -> None:
    """Write a binary column as files; ``name(row)`` gives each file's name below ``folder``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name(r)}")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytearray(r[1]))
        out.close()


def read_packs(spark: SparkSession, folder: str) -> DataFrame:
    """``z, x, y, offset, size, blob`` of all packs in a folder; other files give nothing."""

    def run(batches):
        for pdf in batches:
            out = []
            for data in map(bytes, pdf["content"]):
                head, tiles = index_pack(data)
                out += [(head["z"], x, y, o, n, data[o : o + n]) for x, y, o, n in tiles]
            if out:
                yield pd.DataFrame(out, columns=["z", "x", "y", "offset", "size", "blob"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.nav").load(folder)
    return files.select("content").mapInPandas(run, "z int, x long, y long, offset long, size long, blob binary")


def cell_entries(first: int, nodes: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """Entries (first node index, nodes, edges, body) of a cell, or of a run of its nodes.

    An entry holds at most ``ENTRY`` nodes and edges.  A larger cell has
    several, with its coordinates each; a node with more edges than that comes
    again, with the rest of them.  ``offset`` counts from the first edge given.
    """
    ends, at = np.append(nodes["offset"][1:], len(edges)).astype(np.int64), 0
    while at < len(nodes):
        lo = int(nodes["offset"][at])
        to = min(int(np.searchsorted(ends, lo + ENTRY, side="right")), at + ENTRY)
        part = nodes[at : max(to, at + 1)].copy()
        part["offset"] -= lo
        hi = int(ends[at + len(part) - 1])
        for k in range(lo, max(hi, lo + 1), ENTRY):
            some = edges[k : min(k + ENTRY, hi)]
            yield first + at, len(part), len(some), part.tobytes() + some.tobytes()
        at += len(part)


def build_graph(cells: list[tuple[int, int, list, list]]) -> bytes:
    """Graph file of cells (lat_e4, lon_e4, nodes (lat, lon, edge_offset), edges (dst, cost, dist, flags, 0)).

    Cells stand in the order of their unsigned coordinates; cells of more than
    65535 nodes or edges have several entries in the index.
    """
    made, first = [], 0
    for lat, lon, nodes, edges in sorted(cells, key=lambda c: (c[0] & 0xFFFFFFFF, c[1] & 0xFFFFFFFF)):
        made += [(lat, lon, *e) for e in cell_entries(first, np.array(nodes, NODES), np.array(edges, EDGES))]
        first += len(nodes)
    return graph_file(made)


def parse_graph(data: bytes, box: tuple[int, int, int, int] | None = None) -> list[tuple[int, int, int, list, list]]:
    """Cells (lat_e4, lon_e4, first node index, nodes, edges) of a file, those in ``box`` only."""
    out = []
    magic, _, count = GRAPH_HEADER.unpack_from(data, 0)[:3]
    if magic != b"ROUT":
        return out
    start = GRAPH_HEADER.size + GRAPH_CELL.size * count
    for i in range(count):
        lat, lon, first, n, at, m = GRAPH_CELL.unpack_from(data, GRAPH_HEADER.size + i * GRAPH_CELL.size)
        if box and not (box[0] <= lat <= box[2] and box[1] <= lon <= box[3]):
            continue
        at += start
        nodes = [GRAPH_NODE.unpack_from(data, at + k * GRAPH_NODE.size) for k in range(n)]
        at += n * GRAPH_NODE.size
        out.append((lat, lon, first, nodes, [GRAPH_EDGE.unpack_from(data, at + k * GRAPH_EDGE.size) for k in range(m)]))
    return out


def graph_head(entries: list[tuple[int, int, int, int, int, int]]) -> bytes:
    """Header and index of entries (lat_e4, lon_e4, first, nodes, offset, edges)."""
    return GRAPH_HEADER.pack(b"ROUT", 500, len(entries), 0, 0, 0, 0, 0) + b"".join(GRAPH_CELL.pack(*e) for e in entries)


def graph_file(entries: list[tuple]) -> bytes:
    """Graph file of entries (lat_e4, lon_e4, first, nodes, edges, body) in their order."""
    index, at = [], 0
    for lat, lon, first, nodes, edges, body in entries:
        index.append((lat, lon, first, nodes, at, edges))
        at += len(body)
    return graph_head(index) + b"".join(e[5] for e in entries)


#: Nodes and edges of a cell that are made into bytes together.
PART = 1 << 15


def cell_parts(nodes: DataFrame) -> DataFrame:
    """Nodes with ``part``, the first node index of their run: runs of about ``PART`` nodes and edges inside cells.

    ``nodes``: profile, lat_e4, lon_e4, node_idx, edge_offset.
    """
    cell = ["profile", "lat_e4", "lon_e4"]
    run = F.floor((F.col("edge_offset") + F.col("node_idx")) / PART)
    return nodes.withColumn("run", run).withColumn("part", F.min("node_idx").over(W.partitionBy(*cell, "run"))).drop("run")


_CELLS = pa.schema([("profile", pa.string()), ("lat_e4", pa.int64()), ("lon_e4", pa.int64()), ("first", pa.int64()), ("again", pa.int64()), ("nodes", pa.int64()), ("edges", pa.int64()), ("body", pa.binary())])


def graph_cells(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``profile, lat_e4, lon_e4, first, again, nodes, edges, body``: the entries of a graph file.

    ``nodes``: profile, part, lat_e4, lon_e4, node_idx, lat, lon; ``edges``:
    profile, part (of the start), src_idx, dst_idx, cost, dist_m, flags.  A
    group is a run of ``cell_parts``, so a cell of any size is made in pieces.
    """

    def run(n: pa.Table, e: pa.Table) -> pa.Table:
        if not len(n):
            return _CELLS.empty_table()
        n, c = n.sort_by("node_idx"), {k: e[k].to_numpy() for k in ("src_idx", "dst_idx", "cost", "dist_m", "flags")}
        order = np.lexsort((c["flags"], c["dist_m"], c["cost"], c["dst_idx"], c["src_idx"]))
        made, part = np.zeros(len(order), EDGES), np.zeros(len(n), NODES)
        for name, k in (("dst", "dst_idx"), ("cost", "cost"), ("dist", "dist_m"), ("flags", "flags")):
            if len(order) and not 0 <= c[k].min() <= c[k].max() <= np.iinfo(EDGES[name]).max:
                raise ValueError(f"{k} does not fit the file format")
            made[name] = c[k][order]
        part["lat"], part["lon"] = n["lat"].to_numpy(), n["lon"].to_numpy()
        part["offset"] = np.searchsorted(c["src_idx"][order], n["node_idx"].to_numpy())
        key = [n[k][0].as_py() for k in ("profile", "lat_e4", "lon_e4")]
        rows = [(*key, first, k, *more) for k, (first, *more) in enumerate(cell_entries(n["node_idx"][0].as_py(), part, made))]
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _CELLS, strict=True)], schema=_CELLS)

    # Both sides come from one graph, so the edges' keys get names of their own.
    e = edges.withColumnsRenamed({"profile": "of", "part": "of_part"})
    both = nodes.select("profile", "part", "lat_e4", "lon_e4", "node_idx", "lat", "lon").groupBy("profile", "part").cogroup(e.groupBy("of", "of_part"))
    return both.applyInArrow(run, "profile string, lat_e4 long, lon_e4 long, first long, again long, nodes long, edges long, body binary")


def graph_pieces(cells: DataFrame) -> DataFrame:
    """``profile, at, piece``: the graph file of each profile cut at its entries; ``at`` is the piece's place in the file.

    The first piece is the header with the index; only the table of entries,
    one for some ten thousand edges, is ordered as a whole.
    """
    key = ["profile", "first", "again"]
    order = W.partitionBy("profile").orderBy("first", "again").rowsBetween(W.unboundedPreceding, -1)
    size = F.col("nodes") * NODES.itemsize + F.col("edges") * EDGES.itemsize
    index = cells.drop("body").withColumn("at", F.coalesce(F.sum(size).over(order), F.lit(0)).cast("long"))
    start = GRAPH_HEADER.size + GRAPH_CELL.size * F.count("*").over(W.partitionBy("profile"))

    def head(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["first", "again"])
        if pdf["at"].max() > 0xFFFFFFFF:
            raise ValueError(f"the graph of {key[0]} is too large for the file format")
        entries = zip(*(pdf[c].tolist() for c in ("lat_e4", "lon_e4", "first", "nodes", "at", "edges")), strict=True)
        return pd.DataFrame([(key[0], 0, graph_head(list(entries)))], columns=["profile", "at", "piece"])

    heads = index.groupBy("profile").applyInPandas(head, "profile string, at long, piece binary")
    places = index.select(*key, (F.col("at") + start).alias("at"))
    bodies = cells.select(*key, F.col("body").alias("piece")).join(F.broadcast(places), key).select("profile", "at", "piece")
    return heads.unionByName(bodies)


def graph_files(cells: DataFrame) -> DataFrame:
    """``profile, file``: the pieces of each profile in one value, for graphs of up to some hundred MB."""
    pieces = graph_pieces(cells)
    return pieces.groupBy("profile").applyInPandas(lambda key, pdf: pd.DataFrame([(key[0], b"".join(pdf.sort_values("at")["piece"]))], columns=["profile", "file"]), "profile string, file binary")


_READ = "profile string, lat_e4 long, lon_e4 long, src_idx long, dst_idx long, cost long, dist_m long, flags long"


def _entry_rows(profile: str, lat: int, lon: int, first: int, n: int, m: int, data: bytes, at: int) -> pa.RecordBatch:
    """Edges of an entry.  A node's end where those of the next node begin, and the last node's where the entry's end."""
    nodes = np.frombuffer(data, NODES, n, at)
    edges = np.frombuffer(data, EDGES, m, at + n * NODES.itemsize)
    src = first + np.repeat(np.arange(n), np.diff(np.append(nodes["offset"], m).astype(np.int64)))
    same = lambda v: pa.array(np.full(m, v, np.int64))
    numbers = [src, *(edges[k].astype(np.int64) for k in ("dst", "cost", "dist", "flags"))]
    return pa.record_batch([pa.repeat(pa.scalar(profile, pa.string()), m), same(lat), same(lon), *map(pa.array, numbers)], names=[f.split()[0] for f in _READ.split(", ")])


def _index_of(data: bytes, box: tuple[int, int, int, int] | None) -> list[tuple[int, int, int, int, int, int]]:
    """(lat, lon, first, nodes, place in the file, edges) of the entries in ``box``."""
    magic, _, count = GRAPH_HEADER.unpack_from(data, 0)[:3]
    if magic != b"ROUT":
        return []
    start = GRAPH_HEADER.size + GRAPH_CELL.size * count
    entries = GRAPH_CELL.iter_unpack(data[GRAPH_HEADER.size : start])
    return [(lat, lon, first, n, start + at, m) for lat, lon, first, n, at, m in entries if not box or (box[0] <= lat <= box[2] and box[1] <= lon <= box[3])]


def read_graph_files(files: DataFrame, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Edges ``profile, lat_e4, lon_e4, src_idx, dst_idx, cost, dist_m, flags`` of graph files, of the cells in ``box`` only."""

    def run(batches):
        for batch in batches:
            for profile, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for lat, lon, first, n, at, m in _index_of(data, box):
                    yield _entry_rows(profile, lat, lon, first, n, m, data, at)

    return files.select("profile", "file").mapInArrow(run, _READ)


def read_graph_pieces(pieces: DataFrame, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """The same of files that lie in pieces: the index tells where each entry is, and entries are read apart."""

    def index(batches):
        for pdf in batches:
            rows = [(profile, *e) for profile, data in zip(pdf["profile"], map(bytes, pdf["piece"]), strict=True) for e in _index_of(data, box)]
            yield pd.DataFrame(rows, columns=["profile", "lat_e4", "lon_e4", "first", "nodes", "at", "edges"])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield _entry_rows(r["profile"], r["lat_e4"], r["lon_e4"], r["first"], r["nodes"], r["edges"], r["piece"], 0)

    entries = pieces.filter("at = 0").select("profile", "piece").mapInPandas(index, "profile string, lat_e4 long, lon_e4 long, first long, nodes long, at long, edges long")
    return pieces.filter("at > 0").join(F.broadcast(entries), ["profile", "at"]).mapInArrow(run, _READ)


def write_graph_tables(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """The graph as Parquet, partitioned by profile and cell, so that a request reads its cells only."""
    for name, df in (("nodes", nodes), ("edges", edges)):
        df.repartition("profile", "lat_e4", "lon_e4").write.partitionBy("profile", "lat_e4", "lon_e4").parquet(f"{folder}/{name}")


def read_graph_cells(spark: SparkSession, folder: str, profile: str, south: int, west: int, north: int, east: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the cells of a box; the bounds prune partitions."""
    want = (F.col("profile") == profile) & F.col("lat_e4").between(south, north) & F.col("lon_e4").between(west, east)
    return tuple(spark.read.parquet(f"{folder}/{name}").filter(want) for name in ("nodes", "edges"))
