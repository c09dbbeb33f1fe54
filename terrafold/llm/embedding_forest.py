"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits along random directions, at the widest gap near the middle of
a bounded sample's projections, so that dense groups are not cut; a vector
close to a split goes to both sides (spill).  A node with a good part of its
pairs linked is not split: that would lose links, and comparing all its pairs
costs a few comparisons a link.  Vectors that meet in a leaf of
any tree are compared in double precision.  A pair that meets in several
leaves belongs to the least of them, so links are counted once and no pair is
ever written out: a leaf gives each vector's number of links and a spanning
set of edges, whose components are found over all leaves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import Workspace, connected_components

#: Bound of the sample that the splits are fitted on.
SAMPLE = 16384
#: Vectors of a leaf aimed at; leaves above BLOCK rows are compared in blocks.
LEAF, BLOCK = 1024, 4096
MAX_DEPTH = 40
#: Share of linked pairs from which a node is a leaf, and rows that it is measured on.
DENSE, DENSE_ROWS = 0.25, 256


def _linked_share(x: np.ndarray, cosine: float) -> float:
    """Share of linked pairs among DENSE_ROWS rows spread over ``x``."""
    some = x[:: max(1, -(-len(x) // DENSE_ROWS))]
    n = len(some)
    return ((some @ some.T >= cosine).sum() - n) / max(1, n * (n - 1))


class Tree:
    """Splits as arrays: direction, threshold and children of each node (leaf: -1)."""

    def __init__(self, x: np.ndarray, weight: float, leaf: int, rng: np.random.Generator, cosine: float, least: int = 8):
        self.direction, self.threshold, self.child = [], [], []
        todo = [(np.arange(len(x)), 0, self._node())]
        while todo:
            rows, depth, node = todo.pop()
            if len(rows) * weight <= leaf or len(rows) < least or depth >= MAX_DEPTH or _linked_share(x[rows], cosine) >= DENSE:
                continue
            for _ in range(3):
                r = rng.standard_normal(x.shape[1])
                r /= np.linalg.norm(r)
                p = np.sort(x[rows] @ r)
                mid = p[len(p) // 4 : len(p) - len(p) // 4 + 1]
                gap = np.diff(mid)
                if len(gap) and gap.max() > 1e-9:
                    k = int(gap.argmax())
                    cut = (mid[k] + mid[k + 1]) / 2
                    break
            else:
                continue  # all alike: a leaf, whatever its size
            left, right = self._node(), self._node()
            self.direction[node], self.threshold[node], self.child[node] = r, cut, (left, right)
            side = x[rows] @ r < cut
            todo += [(rows[side], depth + 1, left), (rows[~side], depth + 1, right)]

    def _node(self) -> int:
        self.direction.append(None)
        self.threshold.append(0.0)
        self.child.append(None)
        return len(self.child) - 1

    def leaves(self, x: np.ndarray, spill: float, copies: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a row reaches at most ``copies`` leaves."""
        out_rows, out_leaf = [], []
        room = np.full(len(x), copies - 1)
        todo = [(np.arange(len(x)), 0)]
        while todo:
            rows, node = todo.pop()
            if self.child[node] is None or not len(rows):
                out_rows.append(rows)
                out_leaf.append(np.full(len(rows), node))
                continue
            d = x[rows] @ self.direction[node] - self.threshold[node]
            both = (np.abs(d) < spill) & (room[rows] > 0)
            room[rows[both]] -= 1
            left, right = self.child[node]
            todo += [(rows[(d < 0) | both], left), (rows[(d >= 0) | both], right)]
        return np.concatenate(out_rows), np.concatenate(out_leaf)


def compare(unit: np.ndarray, weight: np.ndarray, near: np.ndarray, cosine: float, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Of one leaf: each row's weight of owned links, and a label that spans linked rows.

    ``near`` is the incidence of rows and lesser leaves; pairs that share one
    belong there.  ``weight`` counts the equal vectors behind a row.
    """
    n = len(unit)
    count, label, linked = np.zeros(n, dtype=np.int64), np.arange(n), []
    for at in range(0, n, block):
        hit = unit[at : at + block] @ unit.T >= cosine
        hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
        own = hit & (near[at : at + block] @ near.T < 0.5) if near.shape[1] else hit
        count[at : at + block] = own @ weight
        linked.append(np.nonzero(hit))
    rows = np.concatenate([r + at for (r, _), at in zip(linked, range(0, n, block), strict=True)])
    cols = np.concatenate([c for _, c in linked])
    while len(rows):
        low = label.copy()
        np.minimum.at(low, rows, label[cols])
        low = low[low]
        if (low == label).all():
            break
        label = low
    return count, label


def _assign(forest: list[Tree], dim: int, spill: float, copies: int, kind: str):
    def run(batches):
        for batch in batches:
            flat = batch.column("v").combine_chunks() if isinstance(batch.column("v"), pa.ChunkedArray) else batch.column("v")
            raw = np.zeros((len(flat), dim), dtype=kind)
            sizes = np.diff(flat.offsets.to_numpy())
            values, at = flat.flatten().to_numpy(zero_copy_only=False), 0
            for i, k in enumerate(sizes):
                raw[i, :k] = values[at : at + k]
                at += k
            x = raw.astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            found = [t.leaves(x, spill, copies) for t in forest]
            rows = np.concatenate([r for r, _ in found])
            leaf = np.concatenate([(k << 40) + v for k, (_, v) in enumerate(found)])
            order = np.lexsort((leaf, rows))
            rows, leaf = rows[order], leaf[order]
            cut = np.searchsorted(rows, np.arange(len(x) + 1))
            sigs = [leaf[a:b].astype("<i8").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            vecs = [r.tobytes() for r in raw]
            pick = pa.array(rows)
            yield pa.record_batch([pa.array(leaf), batch.column("cid").take(pick), batch.column("copies").take(pick), pa.array([vecs[r] for r in rows], pa.binary()), pa.array([sigs[r] for r in rows], pa.binary())], names=["leaf", "cid", "copies", "vec", "sig"])

    return run


def _leaf_links(kind: str, cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, lo, hi = key
        pdf = pdf.sort_values("cid")
        x = np.frombuffer(b"".join(pdf["vec"]), dtype=kind).reshape(len(pdf), -1).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sigs = [np.frombuffer(s, "<i8") for s in pdf["sig"]]
        owner = np.repeat(np.arange(len(sigs)), [len(s) for s in sigs])
        ids = np.concatenate(sigs)
        less = ids < leaf
        names, column = np.unique(ids[less], return_inverse=True)
        near = np.zeros((len(pdf), len(names)), dtype=np.float32)
        near[owner[less], column] = 1
        cid, weight = pdf["cid"].to_numpy(), pdf["copies"].to_numpy()
        if lo == hi:
            count, label = compare(x, weight, near, cosine)
        else:  # two blocks of a large leaf: pairs across only
            side = pdf["block"].to_numpy() == lo
            a, b = np.flatnonzero(side), np.flatnonzero(~side)
            hit = x[a] @ x[b].T >= cosine
            own = hit & (near[a] @ near[b].T < 0.5) if near.shape[1] else hit
            count, label = np.zeros(len(cid), dtype=np.int64), np.arange(len(cid))
            count[a], count[b] = own @ weight[b], own.T @ weight[a]
            rows, cols = np.nonzero(hit)
            while len(rows):
                low = label.copy()
                np.minimum.at(low, a[rows], label[b[cols]])
                np.minimum.at(low, b[cols], label[a[rows]])
                low = low[low]
                if (low == label).all():
                    break
                label = low
        keep = (count > 0) | (label != np.arange(len(label)))
        return pd.DataFrame({"cid": cid[keep], "links": count[keep], "to": cid[label[keep]]})

    return run


def embedding_near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, trees: int = 6, spill: float = 0.03, copies: int = 4, seed: int = 5, workspace: Workspace | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` with one row for each input row.

    Defined cases: a vector that is null, empty, all zero or holds a null or
    non-finite component links with nothing and is its own component (null id:
    null); vectors of different lengths compare as if padded with zeros; equal
    vectors are always linked; null ids join components but name none; repeated
    rows are vectors of their own; other columns are ignored.
    """
    ws = workspace or Workspace(vectors.sparkSession, "forest")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    kind = "<f4" if isinstance(src.schema["v"].dataType.elementType, FloatType) else "<f8"
    src = src.withColumn("v", F.col("v").cast("array<float>" if kind == "<f4" else "array<double>"))
    good = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    src = src.withColumn("good", good)
    classes = src.filter("good").groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = ws.save(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    total, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return src.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    space = 1 << 40
    some = classes.filter(F.expr(f"pmod(xxhash64(cid, {seed}), {space}) < {min(space, space * SAMPLE // total + 1)}")).select("cid", "v").orderBy("cid").limit(2 * SAMPLE).collect()
    x = np.zeros((len(some), dim))
    for i, r in enumerate(some):
        x[i, : len(r["v"])] = r["v"]
    if len(x):
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    forest = [Tree(x, total / max(1, len(x)), LEAF, rng, cosine) for _ in range(trees)]

    placed = classes.select("cid", "copies", "v").mapInArrow(_assign(forest, dim, spill, copies, kind), "leaf long, cid long, copies long, vec binary, sig binary")
    placed = ws.save(placed, "placed")
    big = placed.groupBy("leaf").count().filter(F.col("count") > BLOCK).select("leaf", F.ceil(F.col("count") / (BLOCK // 2)).alias("blocks"))
    with_blocks = placed.join(big, "leaf", "left")
    block = F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.expr("pmod(xxhash64(cid), blocks)")).cast("int")
    dealt = with_blocks.withColumn("block", block).withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.expr("sequence(0, cast(blocks AS int) - 1)"))))
    dealt = dealt.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks")
    found = dealt.groupBy("leaf", "lo", "hi").applyInPandas(_leaf_links(kind, cosine), "cid long, links long, to long")
    found = ws.save(found, "links")
    comps = connected_components(found.select(F.col("cid").alias("a"), F.col("to").alias("b")), ws)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    tagged = classes.join(comps.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = tagged.groupBy("component").agg(F.min("least_id").alias("component_id"))
    tagged = tagged.join(least, "component").join(links, "cid", "left").select("v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    tagged = ws.save(tagged.withColumn("good", F.lit(True)), "tagged")
    out = src.join(tagged, ["good", "v"], "left")
    result = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    ws.drop(placed, found)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
