"""NAV1 tile blobs: encoding and decoding, and NPK2 packs of them."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POINT, LINE, POLYGON, TEXT = 1, 2, 3, 4
FEATURE = "geom_type int, color_idx int, zoom_priority int, width_flags int, min_x int, min_y int, max_x int, max_y int, rings array<array<struct<px:int,py:int>>>, text string, shield array<int>, font_size int"


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def zigzag(n: int) -> int:
    return 2 * n if n >= 0 else -2 * n - 1


def unzigzag(z: int) -> int:
    return z >> 1 if z % 2 == 0 else -(z >> 1) - 1


def encode_shape(geom_type: int, color: int, zoom_priority: int, width: int, rings: list) -> bytes:
    """One line or polygon: deltas run on across rings, ring ends are cumulative."""
    body, x, y, ends = bytearray(), 0, 0, []
    for ring in rings:
        for px, py in ring:
            body += varint(zigzag(px - x)) + varint(zigzag(py - y))
            x, y = px, py
        ends.append((ends[-1] if ends else 0) + len(ring))
    inside = [(min(4096, max(0, px)), min(4096, max(0, py))) for r in rings for px, py in r]
    box = [min(255, f(p[k] for p in inside) // 16) for f in (min, max) for k in (0, 1)] if inside else [255, 255, 0, 0]
    if geom_type == POLYGON:
        body += struct.pack(f"<H{len(ends)}H", len(ends), *ends)
    return struct.pack("<8B", geom_type, color, zoom_priority, width, *box) + varint(len(inside)) + varint(len(body)) + bytes(body)


def encode_text(color: int, zoom_priority: int, font: int, px: int, py: int, text: bytes, shield: tuple[int, int] | None = None) -> bytes:
    body = struct.pack("<hhB", px, py, len(text)) + text + (struct.pack("<HH", *shield) if shield else b"")
    words = -(-len(body) // 4)
    body = body.ljust(4 * words, b"\0")
    x, y = min(255, max(0, px >> 4)), min(255, max(0, py >> 4))
    return struct.pack("<8B", TEXT, color, zoom_priority, font, x, y, x, y) + varint(words) + varint(len(body)) + body


def encode_tile(records: list[bytes]) -> bytes:
    records = records[:0xFFFE]
    return b"NAV1" + struct.pack("<H", len(records)) + b"".join(records)


def decode_tile(data: bytes) -> list[dict]:
    """Features of a blob; a cut-off blob gives those before the cut."""
    out: list[dict] = []
    if data[:4] != b"NAV1":
        return out
    count, at = struct.unpack_from("<H", data, 4)[0], 6
    try:
        for _ in range(count):
            kind, color, zp, width, x0, y0, x1, y1 = struct.unpack_from("<8B", data, at)
            points, at = read_varint(data, at + 8)
            size, at = read_varint(data, at)
            if at + size > len(data):
                break
            body = data[at : at + size]
            at += size
            f = {"geom_type": kind, "color_idx": color, "zoom_priority": zp, "width_flags": width, "min_x": x0, "min_y": y0, "max_x": x1, "max_y": y1, "rings": [], "text": None, "shield": None, "font_size": None}
            if kind == TEXT:
                px, py, n = struct.unpack_from("<hhB", body, 0)
                f |= {"rings": [[{"px": px, "py": py}]], "text": body[5 : 5 + n].decode("utf-8", "replace"), "font_size": width}
                if len(body) >= 9 + n:
                    f["shield"] = list(struct.unpack_from("<HH", body, 5 + n))
            else:
                flat, x, y, b = [], 0, 0, 0
                for _ in range(points):
                    dx, b = read_varint(body, b)
                    dy, b = read_varint(body, b)
                    x, y = x + unzigzag(dx), y + unzigzag(dy)
                    flat.append({"px": x, "py": y})
                ends = [points]
                if kind == POLYGON:
                    n = struct.unpack_from("<H", body, b)[0]
                    ends = list(struct.unpack_from(f"<{n}H", body, b + 2))
                f["rings"] = [flat[a:e] for a, e in zip([0, *ends[:-1]], ends, strict=True)]
            out.append(f)
    except (struct.error, IndexError):
        pass
    return out


def cut_text(text: str, most: int = 255) -> bytes:
    """UTF-8 of a text, at most ``most`` bytes, whole characters."""
    return text.encode()[:most].decode("utf-8", "ignore").encode()


def _blob(key, pdf: pd.DataFrame) -> pd.DataFrame:
    records = []
    for r in pdf.sort_values("rank").itertuples():
        rings = [[(p["px"], p["py"]) for p in ring] for ring in r.rings]
        if r.geom_type == TEXT:
            shield = None if r.shield is None else tuple(int(v) for v in r.shield)
            records.append(encode_text(r.color_idx, r.zoom_priority, r.width_byte, *rings[0][0], cut_text(r.text), shield))
        else:
            records.append(encode_shape(r.geom_type, r.color_idx, r.zoom_priority, r.width_byte, rings))
    data = encode_tile(records)
    return pd.DataFrame([{"z": key[0], "x": key[1], "y": key[2], "features": len(records), "size": len(data), "blob": data}])


def encode_tiles(features: DataFrame) -> DataFrame:
    """``z, x, y, features, size, blob`` from ranked features with palette numbers.

    A tile is bounded by its record limit, so one group fits a task.
    """
    shield = F.col("shield") if "shield" in features.columns else F.lit(None)
    cols = features.select("z", "x", "y", "rank", "geom_type", "color_idx", "zoom_priority", "width_byte", "rings", "text", shield.cast("array<int>").alias("shield"))
    return cols.groupBy("z", "x", "y").applyInPandas(_blob, "z int, x long, y long, features long, size long, blob binary")


def decode_tiles(tiles: DataFrame) -> DataFrame:
    """A row for each feature of each blob (columns z, x, y and FEATURE)."""

    def run(batches):
        for pdf in batches:
            rows = [{"z": r.z, "x": r.x, "y": r.y, "ord": i} | f for r in pdf.itertuples() for i, f in enumerate(decode_tile(bytes(r.blob)))]
            if rows:
                yield pd.DataFrame(rows)

    return tiles.select("z", "x", "y", "blob").mapInPandas(run, f"z int, x long, y long, ord int, {FEATURE}")


def palette_colors(features: DataFrame, palette: DataFrame) -> DataFrame:
    """Colors of palette numbers; a number outside the palette is white."""
    p = palette.select("z", F.col("idx").cast("int").alias("color_idx"), "color565")
    return features.join(p, ["z", "color_idx"], "left").withColumn("color565", F.coalesce("color565", F.lit(65535)))
