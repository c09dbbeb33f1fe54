"""Hierarchical multi-length packing of token sequences.

Documents are routed to tiers by their length (512, 1024, 2048, 4096 tokens);
what exceeds the largest tier is cut into whole windows first.  Each tier packs
its documents best-fit into windows of its own size; the gap that is left in a
window is filled from the next shorter tiers, whose last document is cut to
fit.  Windows of one length form step groups that hold the same number of
token places.  A task numbers the groups that it fills; the windows of those it
cannot fill are counted over all tasks and regrouped, so that only the last
group of each length is short.

Packing runs where the ids are made, so no ids are shuffled; what a task
cannot fill at its end (less than one window) goes on to a second, much
smaller packing of such remainders, which ends in windows of shorter powers of
two, without padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Workspace
from .tokens import tokenizer

TIERS = (512, 1024, 2048, 4096)
#: Token places of a step group, a multiple of every tier.
STEP_TOKENS = 65536
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long"
#: Of a placed piece also its window's place in the step group; of a group that a
#: task left short, a row with its window, step_group and number of windows (place) only.
_PLACED = PIECES + ", place long"
_COLUMNS = [c.split()[0] for c in _PLACED.split(", ")]


class Piece:
    """A stretch of a document's ids, not yet placed."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start: int, ids: memoryview, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> Piece:
        """Take the first n ids off this piece."""
        head = Piece(self.doc_id, self.start, self.ids[: 4 * n], self.total)
        self.start, self.ids = self.start + n, self.ids[4 * n :]
        return head


class TierPacker:
    """Packs a stream of pieces; ``rows`` collects what is placed.

    Memory: at most ``reserve`` waiting pieces and ``open_bins`` open windows a
    tier, whatever the length of the stream.
    """

    def __init__(self, base: int, tiers=TIERS, reserve: int = 64, open_bins: int = 32):
        self.tiers, self.reserve, self.open_bins = tiers, reserve, open_bins
        self.waiting = {t: deque() for t in tiers}
        self.bins: dict[int, list] = {t: [] for t in tiers}  # (room, number, pieces), by room
        self.base, self.count, self.number = base, 0, 0
        self.groups: dict[int, list[int]] = {}
        self.made = 0
        self.rows: list[tuple] = []

    def tier(self, n: int) -> int:
        return self.tiers[bisect_left(self.tiers, n)]

    def add(self, piece: Piece) -> None:
        top = self.tiers[-1]
        while len(piece) >= top:
            self.emit([piece.cut(top)], top)
        if len(piece):
            self.route(piece)

    def route(self, piece: Piece) -> None:
        t = self.tier(len(piece))
        if len(piece) == t:
            return self.emit([piece], t)
        self.waiting[t].append(piece)
        if len(self.waiting[t]) > self.reserve:
            self.place(self.waiting[t].popleft(), t)

    def place(self, piece: Piece, t: int) -> None:
        bins = self.bins[t]
        k = bisect_left(bins, (len(piece),))
        if k < len(bins):
            room, _, inside = bins.pop(k)
        else:
            if len(bins) >= self.open_bins:
                self.close(*bins.pop(0), t)
            room, inside = t, []
        inside.append(piece)
        room -= len(piece)
        self.number += 1
        if room:
            insort(bins, (room, self.number, inside))
        else:
            self.emit(inside, t)

    def close(self, room: int, _: int, inside: list[Piece], t: int) -> None:
        """Fill the gap of a window from shorter tiers, then from its own."""
        order = [x for x in reversed(self.tiers) if x < t] + [x for x in self.tiers if x >= t]
        for whole in (True, False):
            for x in order:
                queue = self.waiting[x]
                for _ in range(len(queue)):
                    if not room:
                        break
                    p = queue.popleft()
                    if len(p) <= room:
                        inside.append(p)
                        room -= len(p)
                    elif not whole:
                        inside.append(p.cut(room))
                        room = 0
                        self.waiting[self.tier(len(p))].append(p)
                    else:
                        queue.append(p)
        if room:  # nothing waits anywhere: what is inside waits for later documents
            for p in inside:
                self.waiting[t].append(p)
        else:
            self.emit(inside, t)

    def remainder(self) -> list[Piece]:
        """Everything not placed, with whole windows of the largest tier emitted."""
        rest = [p for t in reversed(self.tiers) for _, _, inside in self.bins[t] for p in inside]
        rest += [p for t in reversed(self.tiers) for p in self.waiting[t]]
        for t in self.tiers:
            self.bins[t], self.waiting[t] = [], deque()
        return self.windows(rest, self.tiers[-1])

    def windows(self, rest: list[Piece], size: int) -> list[Piece]:
        """Emit windows of ``size`` from a run of pieces while they last."""
        queue, inside, room = deque(rest), [], size
        total = sum(map(len, rest))
        while total >= size:
            while room:
                p = queue.popleft()
                if len(p) > room:
                    inside.append(p.cut(room))
                    queue.appendleft(p)
                    room = 0
                else:
                    inside.append(p)
                    room -= len(p)
            self.emit(inside, size)
            inside, room, total = [], size, total - size
        return list(queue)

    def finish(self) -> None:
        """Place the remainder too, in windows of shorter powers of two."""
        rest, size = self.remainder(), self.tiers[-1]
        while rest:
            size //= 2
            rest = self.windows(rest, size)

    def short_groups(self) -> list[tuple]:
        """A row for each step group that is begun and not full."""
        return [(None,) * 7 + (w, g, STEP_TOKENS // w - left) for w, (g, left) in self.groups.items() if left]

    def emit(self, pieces: list[Piece], window: int) -> None:
        sequence, at = self.base + self.count, 0
        self.count += 1
        group = self.groups.setdefault(window, [0, 0])
        if group[1] == 0:
            group[0], group[1] = self.base + self.made, STEP_TOKENS // window
            self.made += 1
        place = STEP_TOKENS // window - group[1]
        group[1] -= 1
        for p in pieces:
            n = len(p)
            self.rows.append((p.doc_id, p.start, n, zlib.crc32(p.ids), p.total, sequence, at, window, group[0], place))
            at += n


def _batch(rows: list[tuple], rest: list[Piece]):
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _COLUMNS]
    empty = [None] * len(rest)
    arrays = [pa.array([*c, *e], pa.int64()) for c, e in zip(cols, [[p.doc_id for p in rest], [p.start for p in rest], [len(p) for p in rest], empty, [p.total for p in rest], empty, empty, empty, empty, empty], strict=True)]
    return pa.record_batch([*arrays, pa.array([None] * len(rows) + [bytes(p.ids) for p in rest], pa.binary())], names=[*_COLUMNS, "ids"])


def _pack_texts(vocabulary: str, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches):
        tok, packer = tokenizer(vocabulary), TierPacker(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tok.encode(text) + end
                packer.add(Piece(doc_id, 0, memoryview(ids), len(ids) // 4))
                if len(packer.rows) >= 8192:
                    yield _batch(packer.rows, [])
                    packer.rows = []
        rest = packer.remainder()
        yield _batch(packer.rows + packer.short_groups(), rest)

    return run


def _pack_rest(batches):
    packer = TierPacker((TaskContext.get().partitionId() << 32) | (1 << 61))
    for batch in batches:
        for r in batch.to_pylist():
            packer.add(Piece(r["doc_id"], r["start"], memoryview(r["ids"]), r["doc_tokens"]))
        yield _batch(packer.rows, [])
        packer.rows = []
    packer.finish()
    yield _batch(packer.rows + packer.short_groups(), [])


def pack_documents(docs: DataFrame, *, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", workspace: Workspace | None = None) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens; every id lies in one piece.

    Columns as in ``PIECES``: window is the window's length, a power of two,
    and all windows are full; step_group is the group of windows of one length
    that have STEP_TOKENS places together (less in the last one of a length).

    Defined cases: a null or empty text is the end id alone; null ids stay
    null; repeated rows are packed each; other columns are ignored; an empty
    table gives no pieces.
    """
    ws = workspace or Workspace(docs.sparkSession, "packing")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = ws.save(src.mapInArrow(_pack_texts(vocabulary, end_id), _PLACED + ", ids binary"), "pieces")
    second = ws.save(first.filter("ids IS NOT NULL").mapInArrow(_pack_rest, _PLACED + ", ids binary"), "rest")
    placed = first.filter("ids IS NULL").unionByName(second).drop("ids")
    # The windows of short groups are numbered over all tasks: four or some more rows a task.
    before = F.sum("place").over(W.partitionBy("window").orderBy("step_group").rowsBetween(W.unboundedPreceding, -1))
    short = ws.save(placed.filter("length IS NULL").select("step_group", F.coalesce(before, F.lit(0)).alias("before")), "short")
    anew = F.lit(1 << 62) + F.shiftleft(F.col("window"), 44) + F.expr(f"(before + place) DIV ({STEP_TOKENS} DIV window)")
    pieces = placed.filter("length IS NOT NULL").join(short, "step_group", "left")
    return pieces.withColumn("step_group", F.when(F.col("before").isNull(), F.col("step_group")).otherwise(anew)).select(*_COLUMNS[:-1])
