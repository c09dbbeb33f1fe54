"""Media columns: Netpbm and BMP decoded to arrays, resized, hashed, kept as NPY tiles.

``decode_image`` turns the bytes of a file into a numpy array, ``area_resize``
averages exact areas by integral images, ``difference_hash`` compares
neighbours of the 9 x 8 reduction, ``to_tiles`` and ``from_tiles`` write and
read NPY.  ``decode_media`` applies them to an image column; ``text_media``
stores texts as pictures without loss and reads them back.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

#: Pixels across of a text picture; with three channels a row holds 192 bytes.
TEXT_WIDTH = 64
#: Rows of one NPY tile.
TILE_ROWS = 4096
_HEADER = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)")


# -- codecs --------------------------------------------------------------------


def encode_netpbm(a: np.ndarray) -> bytes:
    """Binary PGM (2 dimensions) or PPM (3) of an 8-bit array."""
    kind = b"P6" if a.ndim == 3 else b"P5"
    return b"%s\n%d %d\n255\n" % (kind, a.shape[1], a.shape[0]) + np.ascontiguousarray(a, dtype=np.uint8).tobytes()


def encode_bmp(a: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP, rows from the bottom up, of an (h, w, 3) array."""
    h, w = a.shape[:2]
    stride = (3 * w + 3) // 4 * 4
    rows = np.zeros((h, stride), dtype=np.uint8)
    rows[:, : 3 * w] = a[::-1, :, ::-1].reshape(h, 3 * w)
    head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + rows.size, 0, 0, 54, 40, w, h, 1, 24, 0, rows.size, 2835, 2835, 0, 0)
    return head + rows.tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6: (h, w) or (h, w, 3); 16-bit samples where maxval exceeds 255."""
    kind, at, want = data[1] - 48, 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        m = _HEADER.match(data, at)
        if not m:
            raise ValueError("short Netpbm header")
        want.append(int(m[1]))
        at = m.end()
    w, h = want[:2]
    high = want[2] if len(want) > 2 else 1
    if not (w and h and 1 <= high <= 65535):
        raise ValueError("Netpbm header out of range")
    depth = 3 if kind in (3, 6) else 1
    if kind <= 3:
        body = re.sub(rb"#[^\n]*", b"", data[at:])
        cells = list(body.translate(None, b" \t\r\n\v\f")[: w * h]) if kind == 1 else body.split()[: w * h * depth]
        cells = [int(c) - (48 if kind == 1 else 0) for c in cells]
        if any(not 0 <= c <= high for c in cells):
            raise ValueError("a sample exceeds the greatest value")
        flat = np.array(cells, dtype=np.uint16 if high > 255 else np.uint8)
    elif kind == 4:
        stride = (w + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, stride * h, at + 1).reshape(h, stride), axis=1)
        flat = bits[:, :w].reshape(-1)
    else:
        flat = np.frombuffer(data, ">u2" if high > 255 else np.uint8, w * h * depth, at + 1)
    if kind in (1, 4):
        flat = (1 - flat).astype(np.uint8) * 255
    return flat.reshape((h, w, 3) if depth == 3 else (h, w))


def decode_bmp(data: bytes) -> np.ndarray:
    """8-bit palette, 24-bit and 32-bit uncompressed BMP, either row order."""
    start, size, w, h, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if packed not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError("BMP form is not supported")
    if w < 1 or not h:
        raise ValueError("BMP header out of range")
    stride = (w * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)
    rows = rows[::-1] if h > 0 else rows
    if bits == 8:
        colors = np.frombuffer(data, np.uint8, (start - 14 - size) // 4 * 4, 14 + size).reshape(-1, 4)
        return colors[rows[:, :w]][:, :, 2::-1]
    return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]


def decode_image(data: bytes) -> np.ndarray:
    """By its first bytes; ValueError for what is neither Netpbm nor BMP."""
    if data[:2] == b"BM":
        return decode_bmp(data)
    if re.match(rb"P[1-6]\s", data[:3]):
        return decode_netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


# -- features ------------------------------------------------------------------


def gray(a: np.ndarray) -> np.ndarray:
    return a if a.ndim == 2 else a.astype(np.int64) @ np.array([299, 587, 114])


def area_resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the exact areas of the target pixels, in double precision.

    The integral image of pixel squares is bilinear between its grid points,
    so its value at fractional borders is an interpolation.
    """
    total = np.zeros((a.shape[0] + 1, a.shape[1] + 1))
    np.cumsum(np.cumsum(a, axis=0, dtype=np.int64), axis=1, out=total[1:, 1:])

    def at(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.arange(m + 1) * (n / m)
        low = np.minimum(x.astype(np.int64), n - 1)
        return low, x - low

    y, fy = at(a.shape[0], height)
    x, fx = at(a.shape[1], width)
    rows = total[y] + (total[y + 1] - total[y]) * fy[:, None]
    grid = rows[:, x] + (rows[:, x + 1] - rows[:, x]) * fx
    return np.diff(np.diff(grid, axis=0), axis=1) * (height * width / (a.shape[0] * a.shape[1]))


def difference_hash(a: np.ndarray) -> str:
    """64 bits: whether each cell of the 8 x 9 reduction is less than its right neighbour."""
    if not a.size:
        return "0" * 16
    small = area_resize(gray(a), 8, 9).round(6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


# -- tiles ---------------------------------------------------------------------


def to_tiles(a: np.ndarray, rows: int = TILE_ROWS) -> list[bytes]:
    """NPY files of at most ``rows`` rows each."""
    out = []
    for at in range(0, max(1, len(a)), rows):
        part = np.ascontiguousarray(a[at : at + rows])
        to = io.BytesIO()
        np.lib.format.write_array(to, part, version=(1, 0), allow_pickle=False)
        out.append(to.getvalue())
    return out


def from_tiles(tiles: list[bytes]) -> np.ndarray:
    return np.concatenate([np.lib.format.read_array(io.BytesIO(t), allow_pickle=False) for t in tiles])


# -- columns -------------------------------------------------------------------


def decode_media(images: DataFrame, *, id_col: str, image_col: str) -> DataFrame:
    """``id, height, width, channels, tiles array<binary>, feature, error`` of an image column.

    Bytes that cannot be decoded (null and empty ones too) give an error text
    and null columns; no row is lost.  Repeated rows are decoded each, a null
    id stays null, an empty table gives no rows, other columns are ignored, and
    an image is held in memory whole, whatever its size.
    """
    ship_package(images.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for key, data in zip(batch.column("id").to_pylist(), batch.column("image").to_pylist(), strict=True):
                try:
                    a = decode_image(data or b"")
                    shape = (a.shape[0], a.shape[1], 1 if a.ndim == 2 else a.shape[2])
                    out.append((key, *shape, to_tiles(a), difference_hash(a), None))
                except (ValueError, OverflowError, struct.error, IndexError) as why:
                    out.append((key, None, None, None, None, None, str(why)))
            kinds = (batch.column("id").type, pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.string(), pa.string())
            cols = zip(*out, strict=True) if out else [[]] * 7
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["id", "height", "width", "channels", "tiles", "feature", "error"])

    src = images.select(F.col(id_col).alias("id"), F.col(image_col).cast("binary").alias("image"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, height int, width int, channels int, tiles array<binary>, feature string, error string")


def write_tiles(media: DataFrame, path: str) -> None:
    """Write decoded media as one row a tile, ``id, tile, npy``, in Parquet at ``path``."""
    media.filter("tiles IS NOT NULL").select("id", F.posexplode("tiles").alias("tile", "npy")).write.parquet(path)


def text_picture(data: bytes) -> bytes:
    """A text's bytes as a picture file: padded with blanks, 64 pixels across.

    Pictures of an even number of rows are PPM, the others BMP.
    """
    row = 3 * TEXT_WIDTH
    n = max(row, -(-len(data) // row) * row)
    a = np.frombuffer(data.ljust(n, b" "), np.uint8).reshape(-1, TEXT_WIDTH, 3)
    return encode_bmp(a) if len(a) % 2 else encode_netpbm(a)


def text_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_tiles: bool = False) -> DataFrame:
    """Every text as a picture, decoded and stored as NPY tiles, read back and described.

    Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256, feature, rows (and ``tiles`` if kept).  Null and
    empty texts are one row of blanks; null ids stay null; repeated rows are
    stored each, with equal values; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "rows"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if keep_tiles:
        names, kinds = [*names, "tiles"], [*kinds, pa.list_(pa.binary())]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
            for at in range(0, len(ids), 512):
                out = []
                for key, data in zip(ids[at : at + 512], texts[at : at + 512], strict=True):
                    data = data or b""
                    tiles = to_tiles(decode_image(text_picture(data)))
                    back = from_tiles(tiles)
                    payload, media = back.tobytes(), hashlib.sha256()
                    for t in tiles:
                        media.update(t)
                    row = (key, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), sum(map(len, tiles)), media.hexdigest(), difference_hash(back), len(back))
                    out.append((*row, tiles) if keep_tiles else row)
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark_kind = {pa.int64(): "long", pa.string(): "string"}
    return src.mapInArrow(run, ", ".join(f"{n} {spark_kind.get(k, 'array<binary>')}" for n, k in zip(names, kinds, strict=True)))
