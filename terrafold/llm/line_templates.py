"""Line dedup by a log-template tree of fixed depth.

A line goes to the leaf of its token count and leading tokens (tokens with a
digit count as one variable).  Inside a leaf, a token that is frequent at its
position is constant and any other variable; lines with the same constants at
the same positions have the same template.  Lines that recur literally are
templates without variables.  A template whose instances stand in enough
different documents is boilerplate, and its lines are dropped.

All steps are aggregations and joins on hashes, so a leaf of any size spreads
over tasks and any number of templates is found at once.  Copies of whole
documents are not boilerplate: a holder of a line is known by least hashes of
its other lines (long lines weigh more), which near copies share.

Lines are parsed in numpy, in pieces of about 256 KB.  The first pass counts
leaves; the second gives hashes of the lines in leaves that can matter, which a
bitmap of bounded size tells (where it is too full, more lines take part).
Another one keeps texts that lose no line out of the last shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_bytes, bitmap, bitmap_hit, bytes_powers, slices, splitmix, tidy

#: Leading tokens of a leaf.
DEPTH = 4
#: Different documents that make a template recurring.
MIN_DOCS = 3
#: Different least hashes among all documents that hold the template: less means copies of documents.
MIN_SHARE = 0.3
#: The same, where documents count that share none of ``SKETCHES`` hashes with another holder.
MIN_ALONE, SKETCHES = 0.03, 4
#: Share of positions that must be constant in a template.
SIMILARITY = 0.7
#: Bytes parsed at once (their arrays take some 60 times as much).
PIECE = 1 << 18
#: Any character but the blanks of the contracts (space and U+0009-U+000D).
INK = r"[^\x20\x09-\x0D]"

_INK = np.ones(256, dtype=bool)
_INK[[32, 9, 10, 11, 12, 13]] = False
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
with np.errstate(over="ignore"):
    _VALUE = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VARIABLE = np.uint64(0x2545F4914F6CDD1D)
_STEP, _LEAF = np.uint64(0xD1342543DE82EF95), np.uint64(0xA0761D6478BD642F)


def _parse(data: bytes):
    """Of the lines of ``data`` that have tokens: line number, token count, leaf, form; and the tokens' hashes with their counts."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = _INK[b]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64)
    with np.errstate(over="ignore"):
        up, down = bytes_powers(len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[b] * up[: len(b)], out=total[1:])
        token = splitmix((total[ends] - total[starts]) * down[starts])
        digits = np.zeros(len(b) + 1, dtype=np.int32)
        np.cumsum(_DIGIT[b], out=digits[1:])
        token[digits[ends] > digits[starts]] = _VARIABLE
        line = np.searchsorted(np.flatnonzero(b == 10), starts)
        first = np.flatnonzero(np.diff(line, prepend=-1))
        n = np.diff(first, append=len(token))
        place = np.arange(len(token)) - np.repeat(first, n)
        placed = splitmix(token + place.astype(np.uint64) * _STEP)
        form = splitmix(np.add.reduceat(placed, first) + n.astype(np.uint64))
        placed[place >= DEPTH] = 0
        leaf = splitmix(np.add.reduceat(placed, first) ^ (n.astype(np.uint64) * _LEAF))
    return line[first], n, leaf, form, token


def _lines(texts):
    """``_parse`` over many texts at once; numbers of texts come first, line numbers are those in the text."""
    got, held, size = [], [], 0

    def flush():
        at = np.array([i for i, _, _ in held])
        base = np.array([o for _, o, _ in held])
        inner = np.array([d.count(b"\n") + 1 for _, _, d in held])
        begin = np.cumsum(inner) - inner
        line, *rest = _parse(b"\n".join(d for _, _, d in held))
        which = np.searchsorted(begin, line, side="right") - 1
        got.append((at[which], line - begin[which] + base[which], *rest))
        held.clear()

    for i, data in enumerate(texts):
        if not data:
            continue
        at, lines = 0, 0
        while at < len(data):  # long texts in pieces of whole lines
            end = len(data) if len(data) - at <= PIECE else data.find(b"\n", at + PIECE)
            end = len(data) if end < 0 else end
            part = data[at:end] if at or end < len(data) else data
            held.append((i, lines, part))
            size += len(part)
            lines += part.count(b"\n") + 1
            at = end + 1
            if size >= PIECE:
                flush()
                size = 0
    if held:
        flush()
    if not got:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*got, strict=True))


def _count_leaves(batches):
    for batch in slices(batches):
        leaf, n = np.unique(_lines(arrow_bytes(batch.column(0)))[3], return_counts=True)
        yield pa.record_batch([pa.array(leaf.view(np.int64)), pa.array(n)], names=["leaf", "n"])


def _sketches(text: np.ndarray, n: np.ndarray, form: np.ndarray) -> list[np.ndarray]:
    """Of each line ``SKETCHES`` least hashes of the other, different lines of its text (0: no other)."""
    out = []
    first = np.flatnonzero(np.diff(text, prepend=-1))
    count = np.diff(first, append=len(text))
    for k in range(SKETCHES):
        with np.errstate(over="ignore"):
            u = splitmix(form + np.uint64(k + 1) * _STEP)
        rank = -np.log((u >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / n
        least = np.repeat(np.minimum.reduceat(rank, first), count) if len(first) else rank
        mine = rank == least
        second = np.repeat(np.minimum.reduceat(np.where(mine, np.inf, rank), first), count) if len(first) else rank
        rest = np.where(mine, second, least)
        bits = splitmix(rest.view(np.uint64)) >> np.uint64(1)
        out.append(np.where(np.isinf(rest), 0, bits.view(np.int64)))
    return out


_SKETCHES = [f"s{k}" for k in range(SKETCHES)]


def _busy_lines(busy):
    def run(batches):
        for batch in slices(batches):
            text, pos, n, leaf, form, token = _lines(arrow_bytes(batch.column("text")))
            near = _sketches(text, n, form)
            keep = bitmap_hit(busy.value, leaf.view(np.int64))
            long = keep & (n > DEPTH)
            offsets = np.zeros(int(keep.sum()) + 1, dtype=np.int32)
            np.cumsum(np.where(long, n, 0)[keep], out=offsets[1:])
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token[np.repeat(long, n)].view(np.int64)))
            row = pa.array(text[keep])
            yield pa.record_batch(
                [batch.column("t1").take(row), batch.column("t2").take(row), pa.array(pos[keep].astype(np.int32)), pa.array(n[keep].astype(np.int32)), pa.array(leaf[keep].view(np.int64)), pa.array(form[keep].view(np.int64)), *[pa.array(s[keep]) for s in near], tokens],
                names=["t1", "t2", "pos", "n", "leaf", "form", *_SKETCHES, "tokens"],
            )

    return run


def _recurring(held: DataFrame, key: list[str], min_docs: int) -> DataFrame:
    """Keys whose holders, rows with ``t1`` and sketches, are enough different documents."""
    often = held.groupBy(*key).count().filter(F.col("count") >= min_docs).select(*key)
    one = held.join(often, key, "left_semi").groupBy(*key, "t1").agg(*[F.min(s).alias(s) for s in _SKETCHES])
    met = one.select(*key, "t1", F.posexplode(F.array(*_SKETCHES)).alias("k", "v")).groupBy(*key, "k", "v").agg(F.count("*").alias("holders"), F.min("t1").alias("t1"))
    docs = met.groupBy(*key).agg(F.sum(F.when(F.col("k") == 0, F.col("holders"))).alias("docs"), *[F.count_if(F.col("k") == k).alias(f"d{k}") for k in range(SKETCHES)])
    alone = met.filter("holders = 1").groupBy(*key, "t1").count().filter(F.col("count") == SKETCHES).groupBy(*key).agg(F.count("*").alias("alone"))
    seen = docs.filter(F.col("docs") >= min_docs).join(alone, key, "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    different = F.greatest(*[f"d{k}" for k in range(SKETCHES)])
    few = (different >= min_docs) & (different >= MIN_SHARE * F.col("docs"))
    return seen.filter(few | ((F.col("alone") >= min_docs) & (F.col("alone") >= MIN_ALONE * F.col("docs")))).select(*key)


def _masks(batches):
    """Positions to drop as booleans by position."""
    for batch in batches:
        masks = []
        for pos in batch.column("pos").to_pylist():
            mask = np.zeros(max(pos) + 1, dtype=bool)
            mask[pos] = True
            masks.append(mask)
        offsets = np.zeros(len(masks) + 1, dtype=np.int32)
        np.cumsum([len(m) for m in masks], out=offsets[1:])
        flat = pa.array(np.concatenate(masks) if masks else np.zeros(0, bool))
        yield pa.record_batch([batch.column("t1"), batch.column("t2"), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array([int(m.sum()) for m in masks], pa.int64())], names=["t1", "t2", "gone", "n_gone"])


def _texts(wanted, hit: bool):
    """Rows whose text may lose a line, or the others."""

    def run(batches):
        for batch in batches:
            keep = bitmap_hit(wanted.value, batch.column("__terrafold_t1").to_numpy())
            yield batch.filter(pa.array(keep if hit else ~keep))

    return run


def recurring_lines(docs: DataFrame, ws: Workspace, *, text_col: str = "text", min_docs: int = MIN_DOCS) -> tuple[DataFrame, dict]:
    """``t1, t2, gone, n_gone``: of each text (by two hashes) which lines recur, by position; and the number of rows."""
    spark = ws.spark
    src = docs.select(F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    # Leaves with fewer lines than documents asked for have no recurring template.
    busy, seen = ws.save_counted(src.mapInArrow(_count_leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("leaf"), "busy", n=F.count(F.lit(1)))
    with tidy(spark):
        sent = spark.sparkContext.broadcast(bitmap(busy, "leaf", seen["n"]))
    texts = src.select(F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(17), "text").alias("t2"), "text")
    schema = "t1 long, t2 long, pos int, n int, leaf long, form long, " + ", ".join(f"{s} long" for s in _SKETCHES) + ", tokens array<long>"
    shared = ws.save(texts.mapInArrow(_busy_lines(sent), schema), "shared")
    sent.destroy()
    key = ["leaf", "form"]
    exact = ws.save(_recurring(shared.select(*key, "t1", *_SKETCHES), key, min_docs), "exact")
    dropped = shared.select("t1", "t2", "pos", *key).join(exact, key, "left_semi").select("t1", "t2", "pos")

    # Frequent tokens of the other forms' leaves, by position.
    words = shared.filter(F.col("n") > DEPTH).join(exact, key, "left_anti").groupBy("leaf", "form").agg(F.count("*").alias("w"), F.min(F.struct("t1", "t2", "pos")).alias("first"))
    several = words.groupBy("leaf").agg(F.count("*").alias("forms"), F.sum("w").alias("all")).filter((F.col("forms") >= 2) & (F.col("all") >= min_docs)).select("leaf")
    words = words.join(several, "leaf", "left_semi").select("leaf", "form", "w", "first.*")
    words = words.join(shared.select("t1", "t2", "pos", "leaf", "form", "tokens"), ["t1", "t2", "pos", "leaf", "form"]).dropDuplicates(["leaf", "form"])
    words = ws.save(words.select("leaf", "form", "w", F.posexplode("tokens").alias("i", "token")), "words")
    constant = words.groupBy("leaf", "i", "token").agg(F.sum("w").alias("all")).filter(F.col("all") >= min_docs).select("leaf", "i", "token", F.lit(1).alias("one"))
    form = words.join(constant, ["leaf", "i", "token"], "left").groupBy("leaf", "form").agg(F.count("*").alias("places"), F.count("one").alias("same"), F.bit_xor(F.when(F.col("one") == 1, F.xxhash64("i", "token"))).alias("template"))
    form = ws.save(form.filter(F.col("same") >= SIMILARITY * F.col("places")).select("leaf", "form", "template"), "templates")
    held = ws.save(shared.select("t1", "t2", "pos", *key, *_SKETCHES).join(form, key).drop("form"), "held")
    found = _recurring(held.select("leaf", "template", "t1", *_SKETCHES), ["leaf", "template"], min_docs)
    dropped = dropped.unionByName(held.join(found, ["leaf", "template"], "left_semi").select("t1", "t2", "pos"))
    per_text = dropped.groupBy("t1", "t2").agg(F.collect_set("pos").alias("pos"))
    gone = ws.save_counted(per_text.mapInArrow(_masks, "t1 long, t2 long, gone array<boolean>, n_gone long"), "gone", n=F.count(F.lit(1)))
    ws.drop(busy, shared, exact, words, form, held)
    return gone


def drop_template_lines(docs: DataFrame, *, text_col: str = "text", min_docs: int = MIN_DOCS, workspace: Workspace | None = None) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text_col``, and ``n_lines``, ``n_dropped`` added.

    Lines are cut at newlines; n_lines counts all of them, blank ones too.
    Tokens are cut at space and U+0009-U+000D; a line without tokens is blank
    and never dropped.  A document that has nothing but recurring lines (or
    would keep only blank ones) stays as it is: copies of whole documents are
    not this operator's.

    Defined cases: a null text has no lines and stays null; an empty text is
    one blank line; a line must recur in ``min_docs`` different texts, so
    repeated rows and repeated lines of one text do not count; row count,
    order of lines and all other columns are kept.
    """
    spark = docs.sparkSession
    ws = workspace or Workspace(spark, "lines")
    gone, seen = recurring_lines(docs, ws, text_col=text_col, min_docs=min_docs)
    with tidy(spark):
        sent = spark.sparkContext.broadcast(bitmap(gone, "t1", seen["n"]))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    hashes = ["__terrafold_t1", "__terrafold_t2"]
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], F.xxhash64(text).alias(hashes[0]), F.xxhash64(F.lit(17), text).alias(hashes[1]))
    touched, rest = (keyed.mapInArrow(_texts(sent, hit), keyed.schema) for hit in (True, False))
    d = touched.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(hashes[0]).alias("t1"), F.col(hashes[1]).alias("t2")).join(gone, ["t1", "t2"], "left")
    text = F.col("row").getField(text_col).cast("string")
    d = d.withColumn("lines", F.split(text, "\n"))
    kept = F.filter("lines", lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    d = d.withColumn("new", F.when(F.col("gone").isNotNull(), F.array_join(kept, "\n")))
    whole = ~F.coalesce(F.col("new").rlike(INK), F.lit(False))
    n_dropped = F.when(whole, 0).otherwise(F.col("n_gone")).cast("long").alias("n_dropped")
    new = F.when(whole, text).otherwise(F.col("new"))
    d = d.select(*[(new.cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("row").getField(c).alias(c)) for c in names], n_dropped)
    d = d.unionByName(rest.drop(*hashes).withColumn("n_dropped", F.lit(0).cast("long")))
    # Dropped lines are counted with those that are left.
    left = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit("\n")) + 1, F.lit(0))
    return d.select(*[F.col(f"`{c}`") for c in names], (left + F.col("n_dropped")).cast("long").alias("n_lines"), "n_dropped")
