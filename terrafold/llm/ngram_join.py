"""Grouped prefix join: exact Jaccard self-join of documents on word shingles.

Sets are ordered globally by how full the sketch bucket of a shingle is (very
common shingles last) and then by hash.  Two sets of sizes n and m that are to
be linked share at least ``alpha`` members, so their first ``n - alpha + 1``
and ``m - alpha + 1`` members meet, and their whole prefixes share
``alpha + 1 - ceil(t * larger size)`` members; both filters are exact.
Documents with equal sets collapse into classes, classes with equal prefix and
size into groups; groups are paired over their prefixes, pairs are expanded to
the members and verified on the whole texts.  A member that its group's leader
is not linked to is paired on its own.

No group of copies is expanded into all its pairs: the first round links each
group with the groups that come earliest in its postings (copies with few own
edits) and each member with its group's leader.  The second, exhaustive round
looks only at pairs of different components; for each prefix shingle, pairs
start from nodes outside its most frequent component.  Components, the result,
are the same as those of all links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Workspace, arrow_bytes, bitmap, bitmap_hit, connected_components, set_signature, shingle_set, slices, tidy

#: Buckets of the frequency sketch (one byte each when sent to the executors).
SKETCH_BITS = 18
#: Pairs of one hub that are verified together.
HUB_PAIRS = 256
#: Hubs that a group is held against in the first round.
HUBS = 3
#: Earlier shingles that a posting of the exhaustive round carries.
BEFORE = 3


def _bucket_counts(width: int):
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        parts, held = [], 0

        def add():
            if parts:
                np.add(total, np.bincount(np.concatenate(parts), minlength=len(total)), out=total)
                parts.clear()

        for batch in slices(batches):
            for data in arrow_bytes(batch.column(0)):
                u = shingle_set(data, width)
                parts.append((u & mask).astype(np.int64))
                held += len(u)
                if held > 1 << 20:
                    add()
                    held = 0
        add()
        hit = np.flatnonzero(total)
        for i in range(0, len(hit), 65536):
            part = hit[i : i + 65536]
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["bucket", "df"])

    return run


def _prefixes(width: int, percent: int, levels):
    def run(batches):
        level = np.frombuffer(levels.value, dtype=np.uint8).astype(np.uint64) << np.uint64(56)
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            size, sigs, prefix, offsets = [], [], [], [0]
            for data in arrow_bytes(batch.column("text")):
                u = shingle_set(data, width)
                n = len(u)
                size.append(n)
                keep = n - (percent * n + 99) // 100 + 1 if n else 0
                if n:
                    rank = np.argsort(level[(u & mask).astype(np.int64)] | (u >> np.uint64(8)), kind="stable")
                    prefix.append(u[rank[:keep]].view(np.int64))
                    sigs.append((*set_signature(u), *set_signature(u[rank[:keep]])))
                else:
                    sigs.append((0, 0, 0, 0))
                offsets.append(offsets[-1] + keep)
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            rid = pa.array(np.arange(number, number + len(size)))
            number += len(size)
            columns = [pa.array(list(c), pa.int64()) for c in zip(*sigs)] if sigs else [pa.array([], pa.int64())] * 4
            yield pa.record_batch(
                [rid, batch.column("doc_id"), batch.column("t1"), batch.column("t2"), pa.array(size, pa.int64()), *columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["rid", "doc_id", "t1", "t2", "n", "sig_a", "sig_b", "g1", "g2", "prefix"],
            )

    return run


def _postings(bits):
    """A row for each prefix shingle that may be wanted, with its place in the prefix."""

    def run(batches):
        for batch in batches:
            prefix = batch.column("prefix")
            tok = prefix.flatten().to_numpy()
            width = np.diff(prefix.offsets.to_numpy())
            first = np.cumsum(width) - width
            keep = np.flatnonzero(bitmap_hit(bits.value, tok))
            row = np.repeat(np.arange(len(width)), width)[keep]
            at = pa.array(row)
            yield pa.record_batch([batch.column("node").take(at), batch.column("n").take(at), pa.array((keep - first[row]).astype(np.int32)), pa.array(tok[keep])], names=["node", "n", "pos", "tok"])

    return run


def _passing(bits):
    """Rows whose t1 may be wanted; a wrong pass costs a row, no row is lost."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(bitmap_hit(bits.value, batch.column("t1").to_numpy())))

    return run


def _verified(width: int, percent: int):
    """Links among rows sorted by (a, salt, side): a hub's text, then those of its partners."""

    def run(batches):
        hub, hub_set = None, None
        for batch in slices(batches):
            a, b = [], []
            for x, y, side, data in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("side").to_pylist(), arrow_bytes(batch.column("text")), strict=True):
                other = shingle_set(data, width)
                if side == 0:
                    hub, hub_set = x, other
                    continue
                if hub != x:
                    raise RuntimeError("a partner came before its hub")
                both = len(np.intersect1d(hub_set, other, assume_unique=True))
                if 100 * both >= percent * (len(hub_set) + len(other) - both):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def ngram_jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, keys: bool = False, workspace: Workspace | None = None) -> DataFrame:
    """Documents linked when ``100 * intersection >= percent * union`` of shingle sets.

    Returns ``doc_id, n_shingles, component_id`` with one row for each input
    row; component_id is the least id reachable by links, itself included.
    With ``keys`` also ``t1, t2`` (hashes of the text, xxhash64 plain and after
    17) and ``component``, a number of the component (null without shingles).

    Defined cases: a null or blank text has no shingles and links with nothing
    (component_id is its own id, null if that is null); a null id joins
    components but is never their least id (all null: null); repeated rows and
    repeated ids are documents of their own; other columns are ignored.
    """
    spark = docs.sparkSession
    ws = workspace or Workspace(spark, "ngram")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    # 1. Sketch of document frequencies over all documents (2^18 counters).
    with tidy(spark):
        counts = src.select("text").mapInArrow(_bucket_counts(width), "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toArrow()
    df_of = np.zeros(1 << SKETCH_BITS)
    df_of[counts["bucket"].to_numpy()] = counts["df"].to_numpy()
    levels = spark.sparkContext.broadcast(np.minimum(255, 4 * np.log2(1 + df_of)).astype(np.uint8).tobytes())

    # 2. Set sizes, signatures and prefixes of all documents.
    hashed = src.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(17), "text"))
    schema = "rid long, doc_id long, t1 long, t2 long, n long, sig_a long, sig_b long, g1 long, g2 long, prefix array<long>"
    sets = ws.save(hashed.select("doc_id", "text", "t1", "t2").mapInArrow(_prefixes(width, percent, levels), schema), "sets")
    levels.destroy()

    # 3. Classes of equal sets, then groups of equal size and prefix.
    key = ["n", "sig_a", "sig_b"]
    classes = sets.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("least_id"), F.min("rid").alias("cid"), F.min("g1").alias("g1"), F.min("g2").alias("g2"))
    classes = ws.save(classes, "classes")
    groups = classes.groupBy("n", "g1", "g2").agg(F.min("cid").alias("lead"), F.count("*").alias("members"))
    nodes = classes.join(groups, ["n", "g1", "g2"]).select("cid", "n", "lead", "members")
    nodes, found = ws.save_counted(nodes.join(sets.select(F.col("rid").alias("cid"), "t1", "t2", "prefix"), "cid"), "nodes", crowd=F.count_if(F.col("members") > 1))
    many = bool(found["crowd"])
    ids = ws.save(sets.select("doc_id", *key, *(["t1", "t2"] if keys else [])), "ids")
    ws.drop(sets)
    crowd = nodes.filter("members > 1").select("lead", "cid")

    # 4. Postings of the groups' prefixes.  A bitmap of the shingles that more
    # than one group has, or a group of several members, keeps the others out
    # (a wrong pass costs a row); each shingle's hub is the group that has it earliest.
    led = nodes.filter("cid = lead").select(F.col("cid").alias("node"), F.col("n").cast("int").alias("n"), (F.col("members") > 1).alias("several"), "prefix")
    met = led.select("several", F.explode("prefix").alias("tok")).groupBy("tok").agg(F.count("*").alias("df"), F.max("several").alias("any")).filter("df > 1 OR any")
    met, seen = ws.save_counted(met.select("tok"), "met", n=F.count(F.lit(1)))
    with tidy(spark):
        bits = spark.sparkContext.broadcast(bitmap(met, "tok", seen["n"]))
    post = led.select("node", "n", "prefix").mapInArrow(_postings(bits), "node long, n int, pos int, tok long")
    post = ws.save(post, "postings")
    bits.destroy()
    per = post.groupBy("tok").agg(F.min_by(F.struct("node", "n"), F.struct(F.col("pos") / F.col("n"), "node")).alias("hub"))
    items = post.join(per, "tok")

    # 5. Verification on whole texts, fetched for the classes of the pairs only.
    # A bitmap of the wanted keys keeps most other texts out of the shuffle; a
    # hub with many partners is dealt out with its text repeated.
    def verify(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select("a", "b")
        sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PAIRS).alias("parts"))
        pairs = pairs.join(sizes, "a").withColumn("salt", F.expr("pmod(xxhash64(b), parts)")).drop("parts")
        rows = pairs.select("a", "salt", F.lit(1).alias("side"), "b", F.col("b").alias("cid")).unionByName(pairs.select("a", "salt", F.lit(0).alias("side"), F.col("a").alias("b"), F.col("a").alias("cid")).distinct())
        rows, seen = ws.save_counted(rows.join(nodes.select("cid", "t1", "t2"), "cid").drop("cid"), "wanted", n=F.count(F.lit(1)))
        with tidy(spark):
            bits = spark.sparkContext.broadcast(bitmap(rows, "t1", seen["n"]))
        near = hashed.filter("text IS NOT NULL").select("t1", "t2", "text").mapInArrow(_passing(bits), "t1 long, t2 long, text string")
        near = near.groupBy("t1", "t2").agg(F.first("text").alias("text"))
        dealt = rows.join(near, ["t1", "t2"]).select("a", "salt", "side", "b", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "side")
        edges = ws.save(dealt.mapInArrow(_verified(width, percent), "a long, b long"), "edges")
        bits.destroy()
        ws.drop(rows)
        return edges

    # The members that a linked pair shares, and the least number among prefixes.
    alpha = F.expr(f"(({percent} * total + {99 + percent}) DIV {100 + percent})")
    shared_least = F.greatest(F.lit(1), alpha + 1 - F.expr(f"(({percent} * big + 99) DIV 100)"))

    def labelled(df: DataFrame, comps: DataFrame, node: str, name: str) -> DataFrame:
        return df.join(comps.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))

    # 6. First round: each group with its best hubs, each member with its leader.
    # Hubs see only a part of what a pair shares, so half the least number will do.
    met = items.filter((F.col("node") != F.col("hub.node")) & (F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent))
    met = met.groupBy("node", F.col("hub.node").alias("hub"), F.greatest("n", "hub.n").alias("big"), (F.col("n") + F.col("hub.n")).alias("total")).count()
    best = W.partitionBy("node").orderBy(F.desc("count"), "hub")
    met = met.filter(2 * F.col("count") >= shared_least).withColumn("k", F.row_number().over(best)).filter(F.col("k") <= HUBS)
    star = met.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    if many:
        star = star.unionByName(crowd.filter("cid <> lead").select(F.col("lead").alias("a"), F.col("cid").alias("b")))
    edges = verify(ws.save(star, "star"))
    comps = ws.save(connected_components(edges, ws), "comps")

    # 7. A member apart from its leader has the leader's postings as a node of
    # its own: the leader's component says nothing about whom it met.
    member = crowd
    items = post
    if many:
        astray = labelled(labelled(crowd.filter("cid <> lead"), comps, "cid", "comp"), comps, "lead", "home").filter("comp <> home")
        astray = ws.save(astray.select("lead", "cid"), "astray")
        member = crowd.join(astray.select("cid"), "cid", "left_anti")
        items = items.unionByName(items.join(astray, F.col("node") == F.col("lead")).select("tok", F.col("cid").alias("node"), "n", "pos"))

    # 8. Exhaustive round over pairs of different components, which meet in
    # shingles of several.  Each posting has the shingles before it: a pair that
    # shares one of them has met there.
    line = W.partitionBy("node").orderBy("pos")
    before = [f"before_{k}" for k in range(BEFORE)]
    items = ws.save(labelled(items, comps, "node", "comp"), "labelled")
    per = items.groupBy("tok", "comp").count().groupBy("tok").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.count("*").alias("comps")).filter("comps > 1")
    mixed = ws.save(items.join(per.select("tok", "main"), "tok").withColumn("minor", F.col("comp") != F.col("main")).drop("main"), "mixed")
    ws.drop(post, items)
    mixed = mixed.select("*", *[F.lag("tok", k + 1).over(line).alias(b) for k, b in enumerate(before)])
    x, y = mixed.filter("minor").alias("x"), mixed.alias("y")
    least = F.expr(f"(({percent} * (x.n + y.n) + {99 + percent}) DIV {100 + percent})")
    meets = (F.col("x.tok") == F.col("y.tok")) & (F.col("x.comp") != F.col("y.comp")) & (~F.col("y.minor") | (F.col("x.node") < F.col("y.node")))
    meets = meets & (F.col("x.pos") <= F.col("x.n") - least) & (F.col("y.pos") <= F.col("y.n") - least)
    for b in before:
        meets = meets & ~F.coalesce(F.col(f"x.{b}").isin(*[F.col(f"y.{c}") for c in before]), F.lit(False))
    shared = x.join(y, meets).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), F.greatest("x.n", "y.n").alias("big"), (F.col("x.n") + F.col("y.n")).alias("total")).distinct()
    for side in ("a", "b"):
        shared = shared.join(nodes.select(F.col("cid").alias(side), F.col("prefix").alias(f"prefix_{side}")), side)
    pairs = ws.save(shared.filter(F.size(F.array_intersect("prefix_a", "prefix_b")) >= shared_least).select("a", "b"), "pairs")
    edges = verify(pairs)

    def joined(comps: DataFrame, edges: DataFrame) -> DataFrame:
        """Components after more edges between them."""
        between = labelled(labelled(edges, comps, "a", "ca"), comps, "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        top = connected_components(between, ws).withColumnsRenamed({"node": "of", "component": "top"})
        ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
        known = comps.unionByName(ends.join(comps.select("node"), "node", "left_anti").select("node", F.col("node").alias("component")))
        return ws.save(known.join(top, F.col("component") == F.col("of"), "left").select("node", F.coalesce("top", "component").alias("component")), "comps")

    if edges.take(1):
        comps = joined(comps, edges)
    if many:
        expand = pairs.join(member.select(F.col("lead").alias("a"), F.col("cid").alias("ma")), "a", "left").join(member.select(F.col("lead").alias("b"), F.col("cid").alias("mb")), "b", "left")
        expand = expand.filter("ma IS NOT NULL OR mb IS NOT NULL").select(F.coalesce("ma", "a").alias("a"), F.coalesce("mb", "b").alias("b"))
        expand = ws.save(labelled(labelled(expand, comps, "a", "ca"), comps, "b", "cb").filter("ca <> cb").select("a", "b").distinct(), "expand")
        if expand.take(1):
            edges = verify(expand)
            if edges.take(1):
                comps = joined(comps, edges)

    # 9. Least document id of each component, back to all documents.
    tagged = labelled(classes.select("cid", "least_id", *key), comps, "cid", "component")
    least = tagged.groupBy("component").agg(F.min("least_id").alias("component_id"))
    tagged = ws.save(tagged.join(least, "component").select(*key, "component_id", "component"), "tagged")
    ws.drop(nodes, pairs, classes, comps)
    more = ["t1", "t2"] if keys else []
    out = ids.join(tagged, key, "left")
    found = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), found, *more, *(["component"] if keys else []))
