"""Polygon shapefiles (the ``.shp`` part) on Spark, with a bounding-box filter.

Records outside the box are skipped before their points are decoded.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

POLYGON = 5
RINGS = "poly_id long, part int, west double, south double, east double, north double, rings array<array<struct<lon:double,lat:double>>>"


def _turn(ring: list) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))


def polygons(data: bytes, box: tuple[float, float, float, float] | None) -> Iterator[tuple[int, tuple, list]]:
    """(record number, box, polygons) where a polygon is its shell and holes.

    Shells turn clockwise in the format; a hole belongs to the shell before it.
    Rings of fewer than four points are dropped.
    """
    at = 100
    while at + 12 <= len(data):
        number, words = struct.unpack_from(">II", data, at)
        body, at = at + 8, at + 8 + 2 * words
        if struct.unpack_from("<I", data, body)[0] != POLYGON:
            continue
        own = struct.unpack_from("<4d", data, body + 4)
        if box and (own[0] > box[2] or own[2] < box[0] or own[1] > box[3] or own[3] < box[1]):
            continue
        parts, points = struct.unpack_from("<II", data, body + 36)
        starts = [*struct.unpack_from(f"<{parts}I", data, body + 44), points]
        flat = list(struct.iter_unpack("<2d", data[body + 44 + 4 * parts : body + 44 + 4 * parts + 16 * points]))
        out: list[list] = []
        for a, b in zip(starts, starts[1:], strict=False):
            ring = flat[a:b]
            if len(ring) < 4:
                continue
            if _turn(ring) <= 0 or not out:
                out.append([ring])
            else:
                out[-1].append(ring)
        yield number, own, out


def read_polygons(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Polygons of the files at ``path`` that meet ``box`` (west, south, east, north).

    Ids count down from -1000000001 by record number.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for data in pdf["content"]:
                for number, own, shapes in polygons(bytes(data), box):
                    rows += [(-1000000000 - number, i, *own, [[{"lon": x, "lat": y} for x, y in r] for r in shape]) for i, shape in enumerate(shapes)]
            if rows:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RINGS.split(", ", 6)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path)
    return files.select("content").mapInPandas(run, RINGS)
