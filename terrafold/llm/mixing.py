"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a shuffled stream of words, cut into blocks of equal size.
Slot k of the schedule takes the golden-ratio point of k, which falls into the
interval of one source on the cumulative weights; the slots of a source are
ranked, and slot r plays block r modulo the number of its blocks.  A source
never plays a block more than ``max_repeats`` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD_RE, Workspace

#: Words of a block of a large source.
BLOCK = 1024
#: Blocks that a smaller source is cut into (at most one a word).
LEAST_BLOCKS = 4096
#: Buckets of the shuffle order of a source, each ordered and summed on its own:
#: at least 2^LEAST_BUCKET_BITS, and more where a bucket would exceed BUCKET_ROWS documents.
LEAST_BUCKET_BITS, BUCKET_ROWS = 12, 16384
#: Slots ranked together.
STRIDE = 8192
#: Cells of the unit interval by which points meet the intervals of sources.
CELLS = 4096
GOLDEN = 0.6180339887498949


def source_targets(totals: DataFrame, *, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3) -> DataFrame:
    """``source, source_size`` with ``target``: weights in code-point order of the sources, null last.

    The targets share the sum of all sizes; a source stops at ``max_repeats``
    times its size and its excess goes to the others by weight.  That is the
    level at which ``sum(min(cap, level * weight))`` is the whole sum; sources
    fill in the order of cap / weight.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    order = W.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    t = totals.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * float(max_repeats))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, every = fill.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    t = t.withColumn("total", F.sum("source_size").over(every).cast("double"))
    t = t.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("left", F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)))
    t = t.withColumn("level", (F.col("total") - F.col("full")) / F.col("left"))
    # Sources that reach their cap come first; the level of the first that does not holds for the rest.
    t = t.withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    t = t.withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return t.select("source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


_WIDE = "CAST({} AS DECIMAL(19, 0))"


def block_start(block: str) -> Column:
    """First word of a block: block i of n holds the words from floor(i * L / n) on.

    Products are decimals of 38 digits, so sources of any size fit.
    """
    return F.expr(f"({_WIDE.format(block)} * {_WIDE.format('source_size')}) DIV {_WIDE.format('blocks')}").cast("long")


def block_of(word: str) -> Column:
    """The block that holds a word."""
    return F.expr(f"({_WIDE.format(f'{word} + 1')} * {_WIDE.format('blocks')} - 1) DIV {_WIDE.format('source_size')}").cast("long")


def schedule(sources: DataFrame, slots: int, ws: Workspace) -> DataFrame:
    """``key, blocks, rank`` of each played slot, for sources ``key, blocks, plays, lo, hi``.

    ``lo`` and ``hi`` bound a source on the unit interval; points and intervals
    meet by cell.  Ranks add the slots of earlier strides, so that a source with
    most slots is ranked in many tasks.
    """
    spark = sources.sparkSession
    point = spark.range(slots).withColumn("x", F.expr(f"(id + 0.5D) * {GOLDEN}D - floor((id + 0.5D) * {GOLDEN}D)")).withColumn("cell", F.floor(F.col("x") * CELLS))
    cells = sources.filter("hi > lo").withColumn("cell", F.explode(F.expr(f"sequence(cast(floor(lo * {CELLS}) AS long), least({CELLS - 1}L, cast(floor(hi * {CELLS}) AS long)))")))
    hit = point.join(cells, "cell").filter("x >= lo AND x < hi").select("key", "blocks", "id", F.expr(f"id DIV {STRIDE}").alias("stride"))
    hit = ws.save(hit, "slots")
    per = hit.groupBy("key", "stride").count()
    per = per.withColumn("base", F.coalesce(F.sum("count").over(W.partitionBy("key").orderBy("stride").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranked = hit.join(per.select("key", "stride", "base"), ["key", "stride"])
    return ranked.select("key", "blocks", (F.col("base") + F.row_number().over(W.partitionBy("key", "stride").orderBy("id")) - 1).alias("rank"))


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_repeats: int = 3, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = (), workspace: Workspace | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and ``keep``) for each input row.

    taken is the number of the document's words that the mix plays, repeats
    counted; it never exceeds ``max_repeats`` times the size.  The sources'
    sums are within a few blocks of their targets.  Reruns agree: order and
    schedule depend on ids, sizes and the seed only.

    Defined cases: a null or blank text has size 0 and takes 0; a null source
    is a source of its own, the last one; a source without words has target 0;
    null ids stay null; repeated rows are documents of their own, taking by
    their own places in the stream; other columns are ignored.
    """
    ws = workspace or Workspace(docs.sparkSession, "mixing")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    base = ws.save(src.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).withColumn("h", F.xxhash64("doc_id", F.lit(seed))), "sizes")

    # Sources: sizes, targets, blocks and intervals.
    totals = base.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    totals = ws.save(totals, "totals")
    most = totals.agg(F.max("rows")).first()[0] or 1
    bits = max(LEAST_BUCKET_BITS, (-(-most // BUCKET_ROWS) - 1).bit_length())
    s = source_targets(totals.drop("rows"), weights=weights, max_repeats=max_repeats).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    s = s.withColumn("blocks", F.least(F.col("source_size"), F.greatest(F.ceil(F.col("source_size") / BLOCK), F.lit(LEAST_BLOCKS))))
    s = s.withColumn("plays", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks")).otherwise(0.0))
    line = W.orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    s = s.withColumn("hi", F.sum("plays").over(line)).withColumn("all", F.sum("plays").over(W.partitionBy()))
    s = s.withColumn("lo", F.when(F.col("all") > 0, (F.col("hi") - F.col("plays")) / F.col("all")).otherwise(0.0)).withColumn("hi", F.when(F.col("all") > 0, F.col("hi") / F.col("all")).otherwise(0.0))
    s = ws.save(s.select("key", "source_size", "target", "blocks", "plays", "lo", "hi"), "sources")
    slots = int(round(s.agg(F.sum("plays")).first()[0] or 0))

    # How often each block is played.
    played = schedule(s, slots, ws).filter(F.col("rank") < max_repeats * F.col("blocks"))
    times = played.groupBy("key", F.expr("rank % blocks").alias("block")).agg(F.count("*").alias("times"))

    # The shuffled stream of each source: places by hash order, summed bucket by bucket.
    b = base.filter("size > 0").withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    width = b.groupBy("key", "bucket").agg(F.sum("size").alias("width"))
    width = width.withColumn("from", F.coalesce(F.sum("width").over(W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inner = W.partitionBy("key", "bucket").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = b.withColumn("start", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(width.select("key", "bucket", "from"), ["key", "bucket"])
    placed = placed.withColumn("start", F.col("from") + F.col("start")).drop("from", "bucket", "h", "source")
    placed = placed.join(s.select("key", "source_size", "target", "blocks"), "key")

    piece = placed.withColumn("block", F.explode(F.sequence(block_of("start"), block_of("start + size - 1"))))
    piece = piece.withColumn("words", F.least(F.expr("start + size"), block_start("block + 1")) - F.greatest("start", block_start("block")))
    mixed = piece.join(times, ["key", "block"], "left").withColumn("words", F.col("words") * F.coalesce("times", F.lit(0)))
    carried = [f"keep_{i}" for i in range(len(keep))]
    taken = mixed.groupBy("key", "start", "doc_id", "size", "source_size", "target").agg(F.sum("words").alias("taken"), *[F.first(c).alias(c) for c in carried])
    cols = ["doc_id", "size", "source_size", "target", "taken", *carried]
    empty = base.filter("size = 0").join(s.select("key", "source_size", "target"), "key").withColumn("taken", F.lit(0).cast("long"))
    out = taken.select(*cols).unionByName(empty.select(*cols))
    return out.select("doc_id", "size", "source_size", "target", "taken", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])
