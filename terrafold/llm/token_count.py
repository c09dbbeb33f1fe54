"""Token counts by overlap resynchronisation.

Texts up to ``chunk`` characters are encoded at once.  Longer texts are cut
into chunks that reach ``overlap`` characters into their neighbours; each chunk
is encoded on its own, with offsets, in any task.  Two neighbours are spliced
at the first token of their common zone that both saw at the same place with
the same id, after white space: no piece of the pre-tokeniser spans white
space, so nothing left of it can change what follows.  Where a zone has no
such boundary, the text is done again with wider overlaps (and longer chunks,
so that in the end one chunk holds a text that has no boundary at all).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .tokens import tokenizer


def _count_small(vocabulary: str):
    def run(batches):
        tok = tokenizer(vocabulary)
        for batch in batches:
            n = [tok.count(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def _chunks(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            for t1, t2, text in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "text")), strict=True):
                count = -(-len(text) // chunk)
                for i in range(count):
                    lo, hi = max(0, i * chunk - overlap), min(len(text), (i + 1) * chunk + overlap)
                    cols = [[t1], [t2], [i], [count], [lo], [text[lo:hi]]]
                    yield pa.record_batch([pa.array(v, k) for v, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["t1", "t2", "i", "count", "lo", "text"])

    return run


def _zones(vocabulary: str, chunk: int, overlap: int):
    """Of each chunk: its tokens if it is the last, and the stable starts of its zones."""
    rows = pa.struct([("at", pa.int64()), ("id", pa.int64())])

    def run(batches):
        tok = tokenizer(vocabulary)
        for batch in batches:
            out = {k: [] for k in ("t1", "t2", "zone", "side", "marks", "before", "tail")}
            for t1, t2, i, count, lo, text in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "i", "count", "lo", "text")), strict=True):
                starts, ids = tok.encode_with_starts(text)
                for zone, side in ((i, "R"), (i + 1, "L")):  # zone j lies around j * chunk
                    marks, before = [], []
                    if 0 < zone < count:
                        for k in range(*starts.searchsorted((zone * chunk - overlap - lo, zone * chunk + overlap - lo))):
                            at = int(starts[k])
                            if at and text[at - 1].isspace() and (k == 0 or starts[k - 1] < at):
                                marks.append({"at": at + lo, "id": int(ids[k])})
                                before.append(k)
                    elif side == "R" or zone < count:
                        continue
                    for key, v in zip(out, (t1, t2, zone, side, marks, before, len(ids) if zone == count else 0), strict=True):
                        out[key].append(v)
            yield pa.record_batch([pa.array(out[k], t) for k, t in (("t1", pa.int64()), ("t2", pa.int64()), ("zone", pa.int64()), ("side", pa.string()), ("marks", pa.list_(rows)), ("before", pa.list_(pa.int64())), ("tail", pa.int64()))], names=list(out))

    return run


def token_counts(docs: DataFrame, *, vocabulary: str = "word_bpe_49k.json", limit: int = 2048, chunk: int = 65536, overlap: int = 512, id_col: str = "doc_id", text_col: str = "text", workspace: Workspace | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` with one row for each input row.

    Defined cases: a null or empty text has 0 bytes and 0 tokens; a null id
    stays null; repeated rows are counted each; equal huge texts are encoded
    once and joined back; a text without white space is widened until one
    chunk holds it whole; other columns are ignored.
    """
    ws = workspace or Workspace(docs.sparkSession, "tokens")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    huge_rows = src.filter(F.length("text") > chunk).withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(17), "text"))
    small = src.filter(F.length("text") <= chunk).mapInArrow(_count_small(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    todo = ws.save(huge_rows.groupBy("t1", "t2").agg(F.first("text").alias("text")), "huge")
    done = None
    while todo.take(1):
        parts = todo.mapInArrow(_chunks(chunk, overlap), "t1 long, t2 long, i long, count long, lo long, text string").repartition("t1", "t2", "i")
        zones = ws.save(parts.mapInArrow(_zones(vocabulary, chunk, overlap), "t1 long, t2 long, zone long, side string, marks array<struct<at:long,id:long>>, before array<long>, tail long"), "zones")
        # Side R of zone j belongs to chunk j, which begins there; side L to the chunk that ends there.
        right = zones.filter("side = 'R'").select("t1", "t2", "zone", F.col("marks").alias("m2"), F.col("before").alias("b2"))
        left = zones.filter("side = 'L'")
        pair = left.join(right, ["t1", "t2", "zone"], "left").withColumn("cut", F.array_min(F.array_intersect("marks", "m2")))
        where = lambda m, b: F.element_at(b, F.array_position(m, F.col("cut")).cast("int"))
        pair = pair.withColumn("part", F.when(F.col("m2").isNull(), F.col("tail")).otherwise(where("marks", "before") - where("m2", "b2")))
        sums = ws.save(pair.groupBy("t1", "t2").agg(F.sum("part").alias("n_tokens"), F.count_if(F.col("part").isNull()).alias("open")), "sums")
        ok = sums.filter("open = 0").select("t1", "t2", "n_tokens")
        done = ok if done is None else done.unionByName(ok)
        rest = ws.save(todo.join(sums.filter("open > 0").select("t1", "t2"), ["t1", "t2"]), "huge")
        ws.drop(todo, zones)
        todo, chunk, overlap = rest, chunk * 2, overlap * 4
    counted = small
    if done is not None:
        counted = small.unionByName(huge_rows.select("doc_id", "n_bytes", "t1", "t2").join(done, ["t1", "t2"]).select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
