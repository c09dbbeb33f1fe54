"""Greedy label placement without overlaps.

Placement is sequential by nature: a label is kept if its box is free of those
kept before it, so each zoom is one group.  Only label rows (no geometry) take
part; they are a small share of a map's features.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAR_PX, HEIGHT_PX = 7.0, 11.0
PLACED = "z int, feature_id long, rank long, lon double, lat double, n_bytes long"


def label_boxes(labels: DataFrame) -> DataFrame:
    """Half sizes of each label's box in degrees at zoom ``z``."""
    pixel = F.lit(360.0) / F.pow(F.lit(2.0), "z") / 256.0
    return labels.withColumn("half_w", pixel * CHAR_PX * F.col("n_bytes") / 2.0).withColumn("half_h", pixel * HEIGHT_PX)


def place_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """Places first by population, then roads in order, each at its first free candidate.

    Boxes are kept in a grid as wide as the widest label, so a label meets its
    neighbours only.
    """
    wide, tall = 2 * pdf.half_w.max(), 2 * pdf.half_h.max()
    grid: dict[tuple[int, int], list] = {}
    kept = []
    d = pdf.sort_values(["is_road", "population", "feature_id"], ascending=[True, False, True])
    for r in d.itertuples():
        for lon, lat in zip(r.lons, r.lats, strict=True):
            x0, x1, y0, y1 = lon - r.half_w, lon + r.half_w, lat - r.half_h, lat + r.half_h
            gx, gy = int(lon // wide), int(lat // tall)
            near = (b for i in (-1, 0, 1) for j in (-1, 0, 1) for b in grid.get((gx + i, gy + j), ()))
            if not any(x0 < b[1] and x1 > b[0] and y0 < b[3] and y1 > b[2] for b in near):
                grid.setdefault((gx, gy), []).append((x0, x1, y0, y1))
                kept.append((r.z, r.feature_id, len(kept), lon, lat, r.n_bytes))
                break
    return pd.DataFrame(kept, columns=["z", "feature_id", "rank", "lon", "lat", "n_bytes"])


def place_labels(labels: DataFrame) -> DataFrame:
    """Kept labels of each zoom.

    ``labels``: z, feature_id, is_road, population, n_bytes, and arrays lons,
    lats of the candidate places (one for a place name).
    """
    d = label_boxes(labels).select("z", "feature_id", "is_road", "population", "n_bytes", "half_w", "half_h", "lons", "lats")
    return d.groupBy("z").applyInPandas(place_group, PLACED)
